"""Audit estimates, confusion, maps, search, clusters and data sets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, stats
from ..operators.boxes import greedy_match
from ..operators.dedup import keep_first, latest
from ..operators.graph import components
from ..operators.vectors import similar_pairs, top_k
from ..session import table
from .registry import query, sql
from .roles import DET, DET_ROWS, IMG, REG

BANDED = f"{DET}, b AS (SELECT *, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band, tax >= 0.04 AS truth FROM det), j AS (SELECT * FROM b WHERE suppkey % 5 = 0)"

sql("agg20_weighted_bins", "SELECT CAST(floor(c_acctbal / 500) * 500 + 250 AS DOUBLE) AS x, CAST(sum(c_custkey) AS BIGINT) AS weight FROM {customer} GROUP BY 1 HAVING sum(c_custkey) > 0")
sql("agg21_counts_with_two_thresholds", f"WITH {DET} SELECT image_id, count(*) FILTER (WHERE conf >= 0.5) AS above, count(*) FILTER (WHERE conf < 0.5) AS below, count(*) AS total FROM det GROUP BY image_id")
sql("agg22_distinct_label_list", f"WITH {DET_ROWS} SELECT suppkey, array_join(sort_array(collect_set(concat(drive, cell))), '+') AS label FROM det_rows GROUP BY suppkey", f"WITH {DET_ROWS} SELECT suppkey, array_to_string(list_sort(list(DISTINCT concat(drive, cell))), '+') AS label FROM det_rows GROUP BY suppkey")
sql("agg28_confusion_matrix", "WITH v AS (SELECT d.source, l.quality = 1 AS human, d.n_chars >= 1000 AS says FROM {labels} l JOIN {documents} d USING (doc_id)) SELECT source, count(*) FILTER (WHERE human AND says) AS tp, count(*) FILTER (WHERE human AND NOT says) AS fn, count(*) FILTER (WHERE NOT human AND says) AS fp, count(*) FILTER (WHERE NOT human AND NOT says) AS tn FROM v GROUP BY source UNION ALL SELECT 'overall', count(*) FILTER (WHERE human AND says), count(*) FILTER (WHERE human AND NOT says), count(*) FILTER (WHERE NOT human AND says), count(*) FILTER (WHERE NOT human AND NOT says) FROM v")
sql("agg29_weighted_error_rate", f"WITH {BANDED}, w AS (SELECT band, count(*) AS boxes FROM b GROUP BY band), r AS (SELECT band, count(*) AS judged, count(*) FILTER (WHERE truth <> (conf >= 0.5)) AS wrong FROM j GROUP BY band) SELECT band >= 5 AS side, round(sum(CAST(wrong AS DOUBLE) / judged * boxes) / sum(boxes), 6) AS rate, CAST(sum(boxes) AS BIGINT) AS covered FROM w JOIN r USING (band) GROUP BY 1")
sql("agg30_per_band_dense", f"WITH {BANDED}, bands AS (SELECT DISTINCT CAST(o_orderkey % 10 AS INT) AS band FROM {{orders}}), s AS (SELECT band, count(*) AS shown FROM b WHERE suppkey % 3 = 0 GROUP BY band), r AS (SELECT band, count(*) AS judged, count(*) FILTER (WHERE truth) AS positives FROM j GROUP BY band) SELECT bands.band, coalesce(shown, 0) AS shown, coalesce(judged, 0) AS judged, coalesce(positives, 0) AS positives FROM bands LEFT JOIN s ON s.band = bands.band LEFT JOIN r ON r.band = bands.band")
sql("agg31_class_split_mine", "SELECT event_type AS answer, count(*) AS everyone, count(*) FILTER (WHERE user_id = 7) AS mine FROM {events} GROUP BY event_type")
sql("agg32_versions_on_file", "SELECT event_type AS version, count(*) AS records, count(*) FILTER (WHERE value > 20) AS answered FROM {events} GROUP BY event_type")
sql("agg33_first_present_label", "SELECT coalesce(nullif(o_orderpriority, '3-MEDIUM'), nullif(o_orderstatus, 'O'), 'none') AS label, count(*) AS n FROM {orders} GROUP BY 1")
sql("agg34_inventory_by_split", "SELECT coalesce(split, 'all') AS split, coalesce(class, 'all') AS class, count(*) AS n, round(avg(CASE WHEN background THEN 1.0 ELSE 0.0 END), 6) AS background_share FROM (SELECT CASE WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END AS split, o_orderpriority AS class, o_orderstatus = 'P' AS background FROM {orders}) t GROUP BY ROLLUP (split, class)".replace("1.0 ELSE 0.0", "CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE)"))
sql("agg35_canonical_spelling", "WITH n AS (SELECT lower(p_brand) AS k, p_brand AS shown, count(*) AS n FROM {part} GROUP BY 1, 2) SELECT k, shown FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, shown) AS r FROM n) t WHERE r = 1")
sql("agg37_roc_auc", "WITH s AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS score FROM {labels} l JOIN {documents} d USING (doc_id)), g AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE y = 1) AS p FROM s GROUP BY score), r AS (SELECT *, sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (n - 1) / 2.0 AS mid FROM g) SELECT round((sum(CAST(p AS DOUBLE) * CAST(mid AS DOUBLE)) - CAST(sum(p) AS DOUBLE) * (CAST(sum(p) AS DOUBLE) + 1) / 2) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) - sum(p) AS DOUBLE)), 9) AS auc FROM r")
sql("agg37b_average_precision", "WITH s AS (SELECT l.quality AS y, d.n_chars AS score, d.doc_id AS k FROM {labels} l JOIN {documents} d USING (doc_id)), r AS (SELECT y, sum(y) OVER w AS hits, count(*) OVER w AS seen FROM s WINDOW w AS (ORDER BY score DESC, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT round(avg(CAST(hits AS DOUBLE) / CAST(seen AS DOUBLE)), 9) AS ap FROM r WHERE y = 1")
sql("agg40_recall_by_threshold", f"WITH {BANDED}, t AS (SELECT DISTINCT CAST(band AS DOUBLE) / 10 AS cut FROM b), s AS (SELECT band, truth, count(*) AS n FROM j GROUP BY 1, 2) SELECT cut, round(CAST(sum(CASE WHEN truth AND band / 10.0 >= cut THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(CASE WHEN truth THEN n ELSE 0 END) AS DOUBLE), 6) AS recall, round(CAST(sum(CASE WHEN NOT truth AND band / 10.0 < cut THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(CASE WHEN NOT truth THEN n ELSE 0 END) AS DOUBLE), 6) AS specificity FROM t JOIN s ON 1 = 1 GROUP BY cut")
sql("agg42_nested_label_histogram", "WITH t AS (SELECT conv_id, explode(regexp_extract_all(text, '([A-Z][a-z]*)', 1)) AS label FROM {conversations}), n AS (SELECT label, count(*) AS n FROM t GROUP BY label) SELECT count(*) AS labels, CAST(sum(n) AS BIGINT) AS boxes, max(n) AS most FROM n", "WITH t AS (SELECT conv_id, unnest(regexp_extract_all(text, '([A-Z][a-z]*)', 1)) AS label FROM {conversations}), n AS (SELECT label, count(*) AS n FROM t GROUP BY label) SELECT count(*) AS labels, CAST(sum(n) AS BIGINT) AS boxes, max(n) AS most FROM n")
sql("agg44_family_by_containment", "WITH have AS (SELECT user_id, collect_set(event_type) AS s FROM {events} GROUP BY user_id) SELECT user_id, CASE WHEN size(array_except(array('click', 'view', 'error'), s)) = 0 THEN 'full' WHEN size(array_except(array('click', 'view'), s)) = 0 THEN 'basic' ELSE 'none' END AS family FROM have", "WITH have AS (SELECT user_id, list(DISTINCT event_type) AS s FROM {events} GROUP BY user_id) SELECT user_id, CASE WHEN list_has_all(s, ['click', 'view', 'error']) THEN 'full' WHEN list_has_all(s, ['click', 'view']) THEN 'basic' ELSE 'none' END AS family FROM have")
sql("agg45_recall_anchored_threshold", f"WITH {DET}, p AS (SELECT conf, row_number() OVER (ORDER BY conf, image_id, det_idx) AS r, count(*) OVER () AS n FROM det WHERE tax >= 0.04) SELECT conf AS threshold FROM p WHERE r = floor(0.05 * n) + 1")

sql("prj17_map_bins_three_levels", "WITH pts AS (SELECT c_custkey, c_acctbal / 60 AS lon, (c_custkey % 170) - 85 + 0.03 AS lat FROM {customer}), lv AS (SELECT CAST(0.5 AS DOUBLE) AS r UNION ALL SELECT CAST(0.15 AS DOUBLE) UNION ALL SELECT CAST(0.05 AS DOUBLE)) SELECT r AS level, count(DISTINCT concat(cast(CAST(floor(lon / r) AS BIGINT) AS STRING), ':', cast(CAST(floor(lat / r) AS BIGINT) AS STRING))) AS bins, count(*) AS n FROM pts JOIN lv ON 1 = 1 GROUP BY r".replace("+ 0.03", "+ CAST(0.03 AS DOUBLE)"), "WITH pts AS (SELECT c_custkey, c_acctbal / 60 AS lon, (c_custkey % 170) - 85 + CAST(0.03 AS DOUBLE) AS lat FROM {customer}), lv AS (SELECT CAST(0.5 AS DOUBLE) AS r UNION ALL SELECT CAST(0.15 AS DOUBLE) UNION ALL SELECT CAST(0.05 AS DOUBLE)) SELECT r AS level, count(DISTINCT concat(cast(CAST(floor(lon / r) AS BIGINT) AS VARCHAR), ':', cast(CAST(floor(lat / r) AS BIGINT) AS VARCHAR))) AS bins, count(*) AS n FROM pts JOIN lv ON 1 = 1 GROUP BY r")
sql("prj27_cell_verdict_ladder", "WITH c AS (SELECT n_name, n_regionkey, count(c_custkey) AS land, avg(c_acctbal) AS share FROM {nation} LEFT JOIN {customer} ON c_nationkey = n_nationkey GROUP BY 1, 2) SELECT n_name, CASE WHEN land = 0 THEN 'ocean-no-land' WHEN n_regionkey = 0 THEN 'ocean-label-kept' WHEN share > 4700 THEN 'ok' WHEN share < 4000 THEN 'MISASSIGNED' ELSE 'straddles' END AS verdict FROM c")
sql("joi18_bbox_overlap", "WITH a AS (SELECT s_suppkey, s_acctbal AS lo, s_acctbal + 50 AS hi FROM {supplier}), q AS (SELECT n_nationkey, n_nationkey * 400.0 AS lo, n_nationkey * 400.0 + 300 AS hi FROM {nation}) SELECT n_nationkey, s_suppkey FROM a JOIN q ON a.lo <= q.hi AND a.hi >= q.lo")

sql("pip03_coverage_diff", f"WITH {IMG}, {REG}, have AS (SELECT DISTINCT l_orderkey AS image_id FROM {{lineitem}} WHERE l_returnflag <> 'A'), m AS (SELECT region, seq, count(*) AS total, count(*) FILTER (WHERE have.image_id IS NULL) AS missing FROM img JOIN reg USING (seq) LEFT JOIN have ON have.image_id = img.image_id GROUP BY region, seq) SELECT region, CAST(sum(total) AS BIGINT) AS images, CAST(sum(missing) AS BIGINT) AS missing, count(*) FILTER (WHERE missing = total) AS fully, count(*) FILTER (WHERE missing BETWEEN 1 AND total - 1) AS partly FROM m GROUP BY region")
sql("pip04_date_scope_split", f"WITH {IMG}, d AS (SELECT *, CASE WHEN image_id % 11 = 0 THEN NULL ELSE captured_at END AS cap FROM img) SELECT count(*) AS total, count(*) FILTER (WHERE cap IS NULL) AS undated, count(*) FILTER (WHERE cap <= TIMESTAMP_NTZ '1996-01-01 00:00:00') AS in_scope, count(*) FILTER (WHERE cap > TIMESTAMP_NTZ '1996-01-01 00:00:00') AS newer, count(*) FILTER (WHERE cap IS NULL AND captured_at <= TIMESTAMP_NTZ '1996-01-01 00:00:00') AS resolved_in_scope FROM d", f"WITH {IMG}, d AS (SELECT *, CASE WHEN image_id % 11 = 0 THEN NULL ELSE captured_at END AS cap FROM img) SELECT count(*) AS total, count(*) FILTER (WHERE cap IS NULL) AS undated, count(*) FILTER (WHERE cap <= TIMESTAMP '1996-01-01 00:00:00') AS in_scope, count(*) FILTER (WHERE cap > TIMESTAMP '1996-01-01 00:00:00') AS newer, count(*) FILTER (WHERE cap IS NULL AND captured_at <= TIMESTAMP '1996-01-01 00:00:00') AS resolved_in_scope FROM d")
sql("pip05_backfill_staleness", "SELECT count(*) AS listed, count(DISTINCT o_orderkey) AS images, count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM {lineitem})) AS present FROM {orders}")
sql("pip06_frozen_work_list", f"WITH {DET_ROWS}, d AS (SELECT DISTINCT image_id, drive, cell FROM det_rows), w AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY CASE drive WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, cell) AS r FROM d) SELECT cell, drive, image_id, CAST(row_number() OVER (PARTITION BY cell, drive ORDER BY image_id) - 1 AS BIGINT) AS pos FROM w WHERE r = 1")
sql("pip07_stage_plan", f"WITH {IMG}, {DET} SELECT drive, cell, det.image_id, det_idx, CAST(floor((row_number() OVER (PARTITION BY drive, cell ORDER BY det.image_id, det_idx) - 1) / 100) AS BIGINT) AS shard FROM det JOIN img ON img.image_id = det.image_id WHERE status = 0 AND conf >= 0.25")
sql("pip08_star_views", f"WITH {IMG}, {DET}, runs AS (SELECT s_suppkey AS run_id, s_name AS run FROM {{supplier}}) SELECT det.image_id, det_idx, run, status, img.image_id IS NOT NULL AS has_image, round(qty * qty, 4) AS area FROM det LEFT JOIN img ON img.image_id = det.image_id LEFT JOIN runs ON runs.run_id = det.suppkey")
sql("pip09_cross_run_corroboration", f"WITH {DET}, r AS (SELECT DISTINCT image_id, suppkey % 10 AS run, conf FROM det), k AS (SELECT image_id FROM r GROUP BY image_id HAVING count(DISTINCT run) > 1), s AS (SELECT r.* FROM r SEMI JOIN k ON k.image_id = r.image_id) SELECT a.run AS run_a, b.run AS run_b, count(*) FILTER (WHERE abs(a.conf - b.conf) < 0.05) AS agree, count(*) FILTER (WHERE NOT abs(a.conf - b.conf) < 0.05) AS differ FROM s a JOIN s b ON a.image_id = b.image_id AND a.run < b.run GROUP BY 1, 2")
sql("pip10_run_start_derivation", "WITH m AS (SELECT l_suppkey AS run_id, l_returnflag AS part, max(l_orderkey) AS off FROM {lineitem} GROUP BY 1, 2) SELECT run_id, round(median(off), 4) AS est, CAST(floor(median(off) / 64) * 64 + run_id % 64 AS BIGINT) AS snapped, max(off) - min(off) AS spread FROM m GROUP BY run_id")
sql("pip11_audit_pool", f"WITH {IMG}, {DET}, need AS (SELECT DISTINCT image_id FROM det WHERE conf >= 0.2), s AS (SELECT image_id, min(seq) AS seq FROM img SEMI JOIN need USING (image_id) GROUP BY image_id) SELECT det.image_id, det_idx, conf, coalesce(cast(seq AS STRING), concat('img:', cast(det.image_id AS STRING))) AS seq, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band FROM det LEFT JOIN s ON s.image_id = det.image_id WHERE conf >= 0.2", f"WITH {IMG}, {DET}, need AS (SELECT DISTINCT image_id FROM det WHERE conf >= 0.2), s AS (SELECT image_id, min(seq) AS seq FROM img WHERE image_id IN (SELECT image_id FROM need) GROUP BY image_id) SELECT det.image_id, det_idx, conf, coalesce(cast(seq AS VARCHAR), concat('img:', cast(det.image_id AS VARCHAR))) AS seq, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band FROM det LEFT JOIN s ON s.image_id = det.image_id WHERE conf >= 0.2")
sql("pip12_audit_sheet_draw", f"WITH {IMG}, {DET}, p AS (SELECT det.image_id, det_idx, img.seq, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band FROM det JOIN img ON img.image_id = det.image_id ANTI JOIN {{supplier}} ON s_suppkey = img.seq), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY image_id, det_idx) AS r FROM p) t WHERE r = 1) SELECT band, image_id, det_idx FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY image_id, det_idx) AS k FROM one) t WHERE k <= 4")
sql("pip15_incremental_country_index", f"WITH {IMG}, {REG}, known AS (SELECT image_id FROM img WHERE image_id % 4 = 0 UNION SELECT image_id FROM img WHERE image_id % 9 = 0), todo AS (SELECT img.* FROM img ANTI JOIN known ON known.image_id = img.image_id) SELECT country, count(*) AS n FROM todo LEFT JOIN reg ON reg.seq = todo.seq GROUP BY country")
sql("pip16_grid_region_audit", "WITH c AS (SELECT n_regionkey, n_nationkey, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS area FROM {nation} JOIN {customer} ON c_nationkey = n_nationkey GROUP BY 1, 2), t AS (SELECT *, sum(area) OVER (PARTITION BY n_regionkey) AS total, row_number() OVER (PARTITION BY n_regionkey ORDER BY area DESC, n_nationkey) AS r FROM c) SELECT r_name, n_nationkey AS dominant, round(CAST(area AS DOUBLE) / CAST(total AS DOUBLE), 6) AS share, CASE WHEN area * 2 > total THEN 'ok' ELSE 'straddles' END AS verdict FROM t JOIN {region} ON r_regionkey = n_regionkey WHERE r = 1")
sql("pip17_review_set", f"WITH {DET}, e AS (SELECT DISTINCT l_orderkey AS image_id FROM {{lineitem}} WHERE l_returnflag = 'R'), c AS (SELECT det.* FROM det ANTI JOIN e ON e.image_id = det.image_id WHERE conf BETWEEN 0.2 AND 0.7), one AS (SELECT * FROM (SELECT *, CAST(least(9, floor((conf + 1e-9 - 0.2) / 0.5 * 10)) AS INT) AS decile, row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_idx) AS ri FROM c) t WHERE ri = 1) SELECT decile, image_id, det_idx FROM (SELECT *, row_number() OVER (PARTITION BY decile ORDER BY image_id) AS rd FROM one) t WHERE rd <= 10")
sql("pip20_negatives_to_target_share", f"WITH {IMG}, {DET}, n AS (SELECT count(*) AS pos FROM det WHERE conf >= 0.5), k AS (SELECT CAST(floor(0.1 * pos / 0.9) AS BIGINT) AS want FROM n), neg AS (SELECT image_id, row_number() OVER (ORDER BY image_id) AS r FROM img ANTI JOIN {{lineitem}} ON l_orderkey = img.image_id WHERE status = 0) SELECT image_id FROM neg JOIN k ON r <= want")
sql("pip25_calibration_disagreements", "WITH a AS (SELECT doc_id, source AS pool, n_chars >= 2000 AS says FROM {documents}), h AS (SELECT doc_id, max(quality) AS quality FROM {labels} GROUP BY doc_id) SELECT pool, quality, says, count(*) AS n, count(*) FILTER (WHERE says <> (quality = 1)) AS disagree FROM a JOIN h ON h.doc_id = a.doc_id GROUP BY 1, 2, 3")
sql("pip27_manifest_disk_reconcile", "WITH m AS (SELECT o_orderkey AS id FROM {orders} WHERE o_orderstatus <> 'P'), d AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_linenumber <= 3) SELECT CASE WHEN m.id IS NULL THEN 'orphaned' WHEN d.id IS NULL THEN 'missing' ELSE 'matched' END AS state, count(*) AS n FROM m FULL OUTER JOIN d ON m.id = d.id GROUP BY 1")
sql("pip28_dead_row_drop", "WITH dead AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_discount = 0), hit AS (SELECT o.* FROM {orders} o SEMI JOIN dead ON dead.id = o.o_orderkey), kept AS (SELECT o.* FROM {orders} o ANTI JOIN dead ON dead.id = o.o_orderkey) SELECT (SELECT count(*) FROM hit) AS archived, (SELECT count(*) FROM kept) AS kept, (SELECT count(*) FROM {orders}) AS total")
sql("pip30_training_run_summary", "WITH c AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch, value FROM {events}) SELECT run, count(*) AS epochs, round(max(value), 4) AS peak, CAST(min_by(epoch, struct(-value, epoch)) AS BIGINT) AS best_epoch, round(sum(value), 4) AS loss FROM c GROUP BY run", "WITH c AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch, value FROM {events}) SELECT run, count(*) AS epochs, round(max(value), 4) AS peak, CAST(arg_min(epoch, (-value, epoch)) AS BIGINT) AS best_epoch, round(sum(value), 4) AS loss FROM c GROUP BY run")


# -- plans that use the library's operators -----------------------------------


@query(
    "pip13_error_rate_wilson",
    f"""WITH {BANDED.replace("{lineitem}", "lineitem")}, n AS (SELECT band, count(*) AS judged, count(*) FILTER (WHERE truth) AS positives FROM j GROUP BY band)
SELECT band, judged, positives, round(greatest(0, (p + z2 / 2) / (1 + z2) - sqrt(z2) / (1 + z2) * sqrt(p * (1 - p) + z2 / 4)), 9) AS lo, round(least(1, (p + z2 / 2) / (1 + z2) + sqrt(z2) / (1 + z2) * sqrt(p * (1 - p) + z2 / 4)), 9) AS hi
FROM (SELECT *, CAST(positives AS DOUBLE) / judged AS p, {stats.Z95**2!r} / judged AS z2 FROM n) t""",
)
def pip13_error_rate_wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_tax", "l_discount"])
    judged = det.filter("l_suppkey % 5 = 0").groupBy(stats.band(F.round(F.col("l_discount") * 10, 1)).alias("band")).agg(F.count("*").alias("judged"), F.count_if(F.col("l_tax") >= 0.04).alias("positives"))
    lo, hi = stats.wilson(F.col("positives"), F.col("judged"))
    return judged.select("band", "judged", "positives", F.round(lo, 9).alias("lo"), F.round(hi, 9).alias("hi"))


@query("str10_ledger_as_current_state", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) t WHERE r = 1 AND event_type <> 'error'")
def str10_ledger_as_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("verdict", F.nullif(F.col("event_type"), F.lit("error")))
    return latest(events, ["user_id"], ["ts", "event_id"], verdict="verdict").select("user_id", "event_type", "event_id")


@query("srt04_top_k_search", "SELECT q.vec_id AS query_id, e.vec_id, rank FROM (SELECT q0.vec_id, e0.vec_id AS other, row_number() OVER (PARTITION BY q0.vec_id ORDER BY round(list_dot_product(q0.embedding::DOUBLE[], e0.embedding::DOUBLE[]), 9) DESC, e0.vec_id) AS rank FROM (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q0 JOIN embeddings e0 ON 1 = 1) q JOIN embeddings e ON e.vec_id = q.other WHERE rank <= 10")
def srt04_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of each stated query; the queries are every hundredth vector."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "embeddings")
    stated = [(r[0], list(r[1])) for r in rows.filter("vec_id % 100 = 0").select("vec_id", "embedding").orderBy("vec_id").toLocalIterator()]
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "vec_id")
    return top_k(rows, stated, 10).select("query_id", "vec_id", F.row_number().over(order).cast("long").alias("rank"))


@query("joi23_similar_pairs", "SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.35")
def joi23_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(table(spark, sf_dir, "embeddings"), 0.35).select("a", "b")


@query(
    "set10_connected_components",
    "WITH RECURSIVE e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4), r AS (SELECT a AS id, a AS component FROM e UNION SELECT e.b, r.component FROM r JOIN e ON e.a = r.id AND r.component < e.b) SELECT id, min(component) AS component FROM r GROUP BY id",
)
def set10_connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(similar_pairs(table(spark, sf_dir, "embeddings"), 0.4).select(F.col("a").alias("u"), F.col("b").alias("v")))


@query("joi22_greedy_box_matching")
def joi22_greedy_box_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of drive A against those of drive R as truth; greedy, so only a brute-force test holds it."""
    rows = keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"], ["l_linestatus", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount"])
    box = rows.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("idx"), F.col("l_discount").alias("conf"), "l_returnflag", F.col("l_quantity").alias("x1"), F.lit(0.0).alias("y1"), (F.col("l_quantity") + 20).alias("x2"), F.lit(10.0).alias("y2"))
    return greedy_match(box.filter("l_returnflag = 'A'").drop("l_returnflag"), box.filter("l_returnflag = 'R'").drop("conf", "l_returnflag"), 0.5)


@query("pip24_detector_discordance")
def pip24_detector_discordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sign test between two detectors' discordant answers, per source."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    a, b, y = F.col("n_chars") >= 800, F.col("n_chars") % 7 < 4, F.col("quality") == 1
    per = rows.groupBy("source").agg(F.count_if((a == y) & (b != y)).cast("int").alias("only_a"), F.count_if((a != y) & (b == y)).cast("int").alias("only_b"))
    return per.withColumn("p_value", F.round(stats.binomial_two_sided(F.col("only_a"), F.col("only_a") + F.col("only_b")), 9))


@query(
    "joi19_point_in_polygon",
    "WITH p AS (SELECT c_custkey, c_acctbal / 100 AS x, CAST(c_custkey % 100 AS DOUBLE) AS y FROM customer) SELECT c_custkey, CASE WHEN x > 0 AND y > 0 AND x + y < 60 THEN 'triangle' WHEN x >= 60 AND x < 90 AND y > 20 AND y < 70 THEN 'box' END AS area FROM p WHERE (x + y) <> 60",
)
def joi19_point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to areas, first match kept; a bounding box goes before the exact test."""
    rings = {"triangle": [(0, 0), (60, 0), (0, 60)], "box": [(60, 20), (90, 20), (90, 70), (60, 70)]}
    pts = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 100).alias("x"), (F.col("c_custkey") % 100).cast("double").alias("y")).filter("x + y <> 60")
    area = F.lit(None).cast("string")
    for name, ring in reversed(rings.items()):
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        corners = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ring])
        near = F.col("x").between(min(xs), max(xs)) & F.col("y").between(min(ys), max(ys))
        inside = near & (F.col("y") > min(ys)) & geo.in_polygon(F.col("x"), F.col("y"), corners)
        area = F.when(inside, name).otherwise(area)
    return pts.select("c_custkey", area.alias("area"))


@query("joi20_cell_area_overlay", "SELECT n_nationkey, round(6371008.8 * 6371008.8 * radians(CAST(3 AS DOUBLE)) * (sin(radians(CAST(n_nationkey * 3 + 4 AS DOUBLE))) - sin(radians(CAST(n_nationkey * 3 AS DOUBLE)))) / 1000000, 3) AS km2 FROM nation")
def joi20_cell_area_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area that a cell shares with a land box, in closed form on the sphere."""
    south = (F.col("n_nationkey") * 3).cast("double")
    west, east = F.greatest(F.lit(0.0), F.lit(2.0)), F.least(F.lit(5.0), F.lit(9.0))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.round(geo.box_area_m2(west, south, east, south + 4) / 1e6, 3).alias("km2"))


@query("agg14b_n_unique_approximate")
def agg14b_n_unique_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch that stands in for an exact count on very large inputs; the error is bounded, not nil."""
    return table(spark, sf_dir, "lineitem").agg(F.approx_count_distinct("l_partkey", 0.02).alias("n_unique"))


@query("pip29_live_rate_extrapolation", "WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS hits FROM orders WHERE o_orderkey % 7 = 0), p AS (SELECT count(*) AS population FROM orders) SELECT n, hits, population, round(population * greatest(0, p - w), 4) AS lo, round(population * least(1, p + w), 4) AS hi FROM (SELECT *, CAST(hits AS DOUBLE) / n AS p, 1.959963984540054 * sqrt(CAST(hits AS DOUBLE) / n * (1 - CAST(hits AS DOUBLE) / n) / n) AS w FROM s JOIN p ON 1 = 1) t")
def pip29_live_rate_extrapolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    one = orders.agg(F.count_if(F.col("o_orderkey") % 7 == 0).alias("n"), F.count_if((F.col("o_orderkey") % 7 == 0) & (F.col("o_orderstatus") == "F")).alias("hits"), F.count("*").alias("population"))
    lo, hi = stats.wald_band(F.col("hits"), F.col("n"), F.col("population"))
    return one.select("n", "hits", "population", F.round(lo, 4).alias("lo"), F.round(hi, 4).alias("hi"))


@query("set11_greedy_hamming_clusters")
def set11_greedy_hamming_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy clusters of sign hashes within each label; order-dependent, so a brute-force test holds it."""
    from ..operators.clusters import greedy_hamming

    bits = F.aggregate(F.transform(F.slice("embedding", 1, 62), lambda x: (x > 0).cast("long")), F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1) + b)
    return greedy_hamming(table(spark, sf_dir, "embeddings").select("label", "vec_id", bits.alias("h")), "label", "vec_id", "h", 22)


@query("pip23_term_search", "SELECT b.vec_id, rank FROM (SELECT e.vec_id, row_number() OVER (ORDER BY round(list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) DESC, e.vec_id) AS rank FROM embeddings e JOIN (SELECT embedding FROM embeddings WHERE vec_id = 0) q ON 1 = 1) b WHERE rank <= 20")
def pip23_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty rows nearest to one term's vector."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "embeddings")
    term = [(0, list(r[0])) for r in rows.filter("vec_id = 0").select("embedding").limit(1).collect()]
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "vec_id")
    return top_k(rows, term, 20).select("vec_id", F.row_number().over(order).cast("long").alias("rank"))
