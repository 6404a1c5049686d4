"""Catalog, progress and store marts: scans rolled up by drive, kind, region and cell."""

from .registry import sql
from .roles import DET, DET_ROWS, IMG, REG

# -- the slice that the whole engine hangs on ---------------------------------

sql(
    "slice_progress_by_region",
    f"""WITH {IMG}, {DET}, {REG}, n AS (SELECT image_id, count(*) AS n_det FROM det WHERE conf >= 0.5 GROUP BY image_id)
SELECT region, count(*) AS scanned, count(*) FILTER (WHERE status = 0 AND n_det > 0) AS positive,
  count(*) FILTER (WHERE status = 0 AND n_det IS NULL) AS negative, count(*) FILTER (WHERE status <> 0) AS errored,
  CAST(sum(coalesce(n_det, 0)) AS BIGINT) AS detections
FROM img LEFT JOIN n USING (image_id) JOIN reg USING (seq) GROUP BY region ORDER BY positive DESC NULLS LAST""",
)

# -- aggregations over the catalog --------------------------------------------

sql("agg01_global_totals", "SELECT count(*) AS n_files, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM {orders}")
sql(
    "agg02_filter_pivot_by_region",
    f"""WITH {IMG}, {REG} SELECT region, CAST(sum(image_id) FILTER (WHERE kind = '1-URGENT') AS BIGINT) AS ga, CAST(sum(image_id) FILTER (WHERE kind = '5-LOW') AS BIGINT) AS all_data,
CAST(sum(image_id) FILTER (WHERE kind = 'none') AS BIGINT) AS nothing FROM img JOIN reg USING (seq) GROUP BY region""",
)
sql("agg03_group_by_two_nulls_last", f"WITH {IMG} SELECT kind, status, count(*) AS n FROM img GROUP BY 1, 2 ORDER BY n DESC NULLS LAST, kind, status")
sql("agg04_bool_or_per_drive", f"WITH {DET_ROWS} SELECT drive, cell, bool_or(conf >= 1.0) AS any_sure FROM det_rows GROUP BY drive, cell")
sql("agg05_any_value_as_min", f"WITH {DET_ROWS} SELECT image_id, min(cell) AS cell, min_by(drive, struct(partkey, suppkey, qty, price, shipdate)) AS drive FROM det_rows GROUP BY image_id", f"WITH {DET_ROWS} SELECT image_id, min(cell) AS cell, arg_min(drive, (partkey, suppkey, qty, price, shipdate)) AS drive FROM det_rows GROUP BY image_id")
sql("agg06_count_distinct", f"WITH {DET_ROWS} SELECT drive, count(DISTINCT image_id) AS images FROM det_rows GROUP BY drive")
sql("agg07_distinct_tuples_vs_rows", f"WITH {DET_ROWS} SELECT count(*) AS n_rows, count(DISTINCT (image_id, det_idx)) AS n_keys, count(*) - count(DISTINCT (image_id, det_idx)) AS twins FROM det_rows")
sql("agg08_progress_boolean_sums", f"WITH {IMG}, {DET}, n AS (SELECT image_id, count(*) AS n_det FROM det GROUP BY image_id) SELECT count(*) AS scanned, CAST(sum(CAST(status = 0 AND n_det > 0 AS INT)) AS BIGINT) AS positive, CAST(sum(CAST(status = 0 AND n_det IS NULL AS INT)) AS BIGINT) AS negative, CAST(sum(CAST(status <> 0 AS INT)) AS BIGINT) AS errored FROM img LEFT JOIN n USING (image_id)")
sql("agg09_count_filter_and_sum", f"WITH {DET_ROWS} SELECT cell, count(*) FILTER (WHERE conf > 0.9) AS sure, coalesce(CAST(sum(det_idx) FILTER (WHERE conf > 2) AS BIGINT), 0) AS none FROM det_rows GROUP BY cell")
sql("agg10_having_duplicates_with_list", f"WITH {DET_ROWS} SELECT image_id, det_idx, count(*) AS n, array_join(sort_array(collect_set(drive)), ',') AS drives FROM det_rows GROUP BY image_id, det_idx HAVING count(*) > 1", f"WITH {DET_ROWS} SELECT image_id, det_idx, count(*) AS n, array_to_string(list_sort(list(DISTINCT drive)), ',') AS drives FROM det_rows GROUP BY image_id, det_idx HAVING count(*) > 1")
sql("agg11_having_several_runs", f"WITH {DET_ROWS} SELECT image_id, count(DISTINCT suppkey) AS runs FROM det_rows GROUP BY image_id HAVING count(DISTINCT suppkey) > 5")
sql("agg12_distinct_row_count", "SELECT count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_discount FROM {lineitem}) t")
sql(
    "agg13_parent_rollup_conditional",
    f"""WITH {IMG}, {REG}, {DET}, c AS (SELECT region, country, count(DISTINCT img.image_id) AS images, count(det.image_id) AS animals FROM img JOIN reg USING (seq) LEFT JOIN det ON det.image_id = img.image_id AND conf >= 0.9 GROUP BY region, country),
p AS (SELECT region, CAST(sum(CASE WHEN animals > 0 THEN images ELSE 0 END) AS BIGINT) AS images, CAST(sum(animals) AS BIGINT) AS animals, count(*) AS cells FROM c GROUP BY region)
SELECT * FROM p UNION ALL SELECT 'GLOBAL TOTAL', CAST(sum(images) AS BIGINT), CAST(sum(animals) AS BIGINT), CAST(sum(cells) AS BIGINT) FROM p""",
)
sql("agg14_n_unique_exact", "SELECT count(DISTINCT l_partkey) AS n_unique FROM {lineitem}")
sql("agg15_one_pass_date_counts", "SELECT count(*) FILTER (WHERE l_shipdate IS NULL) AS undated, count(*) FILTER (WHERE l_shipdate <= TIMESTAMP_NTZ '1995-06-17 00:00:00') AS in_scope, count(*) FILTER (WHERE l_shipdate > TIMESTAMP_NTZ '1995-06-17 00:00:00') AS newer FROM {lineitem}", "SELECT count(*) FILTER (WHERE l_shipdate IS NULL) AS undated, count(*) FILTER (WHERE l_shipdate <= TIMESTAMP '1995-06-17 00:00:00') AS in_scope, count(*) FILTER (WHERE l_shipdate > TIMESTAMP '1995-06-17 00:00:00') AS newer FROM {lineitem}")
sql(
    "agg16_sequence_completeness",
    f"WITH {IMG}, have AS (SELECT DISTINCT l_orderkey AS image_id FROM {{lineitem}}), s AS (SELECT seq, count(*) AS total, count(*) FILTER (WHERE have.image_id IS NULL) AS missing FROM img LEFT JOIN have USING (image_id) GROUP BY seq) SELECT count(*) AS sequences, count(*) FILTER (WHERE missing = total) AS fully_missing, count(*) FILTER (WHERE missing > 0 AND missing < total) AS partly_missing, CAST(sum(missing) AS BIGINT) AS missing FROM s",
)
sql("agg17_max_per_file_then_median", "SELECT round(percentile(m, 0.5), 6) AS median_of_max FROM (SELECT l_suppkey, max(l_quantity) AS m FROM {lineitem} GROUP BY l_suppkey) t", "SELECT round(quantile_cont(m, 0.5), 6) AS median_of_max FROM (SELECT l_suppkey, max(l_quantity) AS m FROM {lineitem} GROUP BY l_suppkey) t")
sql("agg18_pairwise_agreement", f"WITH {DET_ROWS} SELECT a.drive AS drive_a, b.drive AS drive_b, count(*) FILTER (WHERE a.conf = b.conf) AS agree, count(*) FILTER (WHERE NOT a.conf = b.conf) AS differ FROM det_rows a JOIN det_rows b ON a.image_id = b.image_id AND a.det_idx = b.det_idx AND a.drive < b.drive GROUP BY 1, 2")
sql("agg19_min_max_per_run", f"WITH {DET_ROWS} SELECT suppkey AS run_id, min(qty) AS lo, max(qty) AS hi, count(*) AS n, min(drive) AS drive FROM det_rows GROUP BY suppkey")
sql("agg23_min_sequence_per_id", f"WITH {IMG} SELECT image_id, min(CASE WHEN seq % 7 = 0 THEN NULL ELSE seq END) AS seq FROM img GROUP BY image_id HAVING min(CASE WHEN seq % 7 = 0 THEN NULL ELSE seq END) IS NOT NULL")
sql("agg24_group_counts_by_label", "SELECT q.quality, count(l.doc_id) AS n FROM (SELECT 0 AS quality UNION ALL SELECT 1 UNION ALL SELECT 2) q LEFT JOIN {labels} l ON l.quality = q.quality GROUP BY q.quality")
sql("agg25_count_distinct_not_null", "SELECT count(DISTINCT nullif(lang, 'en')) AS langs, count(DISTINCT source) AS sources FROM {documents}")
sql("agg26_value_counts", "SELECT event_type, count(*) AS n FROM {events} GROUP BY event_type ORDER BY n DESC, event_type")
sql(
    "agg27_dominant_category_share",
    f"WITH {IMG}, {REG}, a AS (SELECT region, country, CAST(sum(CAST(round(bytes * 100) AS BIGINT)) AS BIGINT) AS area FROM img JOIN reg USING (seq) GROUP BY region, country), t AS (SELECT *, sum(area) OVER (PARTITION BY region) AS total, row_number() OVER (PARTITION BY region ORDER BY area DESC, country) AS r FROM a) SELECT region, country AS dominant, round(CAST(area AS DOUBLE) / CAST(total AS DOUBLE), 6) AS share FROM t WHERE r = 1",
)
sql("agg38_expected_vs_present", "SELECT p_brand, count(*) AS markers, CAST(ceil(max(p_size) / 3.0) * ceil(min(p_size) / 3.0) AS BIGINT) AS expected, count(*) >= ceil(max(p_size) / 3.0) * ceil(min(p_size) / 3.0) AS complete FROM {part} GROUP BY p_brand")
sql("agg39_checkpoint_completeness", "WITH t AS (SELECT o_orderkey AS sub_id, 1 AS topo FROM {orders}), d AS (SELECT l_orderkey AS sub_id, count(*) AS records FROM {lineitem} GROUP BY l_orderkey), f AS (SELECT l_orderkey AS sub_id, count(*) AS flagged FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey) SELECT count(*) AS subs, count(*) FILTER (WHERE records IS NULL) AS silent, count(*) FILTER (WHERE flagged IS NULL AND records IS NOT NULL) AS no_flag, CAST(sum(coalesce(records, 0)) AS BIGINT) AS records FROM t LEFT JOIN d USING (sub_id) LEFT JOIN f USING (sub_id)")
sql("agg41_percent_capped", "SELECT l_returnflag AS drive, round(least(CAST(100 AS DOUBLE), CAST(100 AS DOUBLE) * count(*) / 15000), 4) AS pct FROM {lineitem} GROUP BY l_returnflag")
sql("agg43_status_report", "SELECT state, count(*) AS n, CAST(sum(items) AS BIGINT) AS items FROM (SELECT l_orderkey, count(*) AS items, CASE WHEN bool_or(l_returnflag = 'R') AND bool_or(l_returnflag = 'A') THEN 'failed' WHEN bool_or(l_linestatus = 'O') AND bool_or(l_linestatus = 'F') THEN 'incomplete' WHEN max(l_linenumber) = 1 THEN 'legacy' ELSE 'clean' END AS state FROM {lineitem} GROUP BY l_orderkey) t GROUP BY state")
sql("agg36_missing_work_summary", f"WITH {DET_ROWS} SELECT cell, count(*) AS n_rows, count(DISTINCT image_id) AS images, count(*) FILTER (WHERE drive <> 'N') AS has_url FROM det_rows GROUP BY cell")

# -- catalog composites -------------------------------------------------------

sql("joi04_left_on_aggregated_dimension", "WITH d AS (SELECT s_nationkey, count(*) AS suppliers, bool_or(s_acctbal < 0) AS any_debt FROM {supplier} GROUP BY s_nationkey) SELECT n_name, coalesce(suppliers, 0) AS suppliers, any_debt FROM {nation} LEFT JOIN d ON n_nationkey = s_nationkey")
sql("srt01_top_n_nulls_last", f"WITH {IMG}, {REG} SELECT country, CAST(sum(image_id) FILTER (WHERE kind = '1-URGENT') AS BIGINT) AS urgent FROM img JOIN reg USING (seq) GROUP BY country ORDER BY urgent DESC NULLS LAST, country LIMIT 10")
sql(
    "pip01_catalog_summary",
    f"""WITH {DET_ROWS} SELECT 'total' AS section, '' AS name, count(*) AS n, CAST(sum(det_idx) AS BIGINT) AS items FROM det_rows
UNION ALL SELECT 'drive', drive, count(*), CAST(sum(det_idx) AS BIGINT) FROM det_rows GROUP BY drive
UNION ALL SELECT 'kind', cell, count(*), CAST(sum(det_idx) AS BIGINT) FROM det_rows GROUP BY cell
UNION ALL SELECT 'combination', concat(drive, '/', cell), count(*), CAST(sum(det_idx) AS BIGINT) FROM det_rows GROUP BY drive, cell""",
)
sql("pip01b_catalog_all_breakdowns", "SELECT coalesce(l_returnflag, '*') AS drive, coalesce(l_linestatus, '*') AS cell, count(*) AS n, grouping(l_returnflag) + 2 * grouping(l_linestatus) AS level FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)", "SELECT coalesce(l_returnflag, '*') AS drive, coalesce(l_linestatus, '*') AS cell, count(*) AS n, CAST(grouping(l_returnflag) + 2 * grouping(l_linestatus) AS INT) AS level FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)")
sql(
    "pip02_dedup_across_drives",
    f"""WITH {DET_ROWS}, per AS (SELECT cell, drive, count(DISTINCT image_id) AS n FROM det_rows GROUP BY cell, drive), plain AS (SELECT cell, CAST(sum(n) AS BIGINT) AS summed, count(*) AS drives FROM per GROUP BY cell),
uni AS (SELECT cell, count(DISTINCT image_id) AS n_unique FROM det_rows GROUP BY cell) SELECT cell, summed, drives, CASE WHEN drives > 1 THEN n_unique ELSE summed END AS n_unique, drives > 1 AS deduped FROM plain JOIN uni USING (cell)""",
)
sql("pip26_progress_per_parent", f"WITH {IMG}, {REG}, {DET}, c AS (SELECT region, country, count(DISTINCT img.image_id) AS images, count(DISTINCT det.image_id) AS done FROM img JOIN reg USING (seq) LEFT JOIN det ON det.image_id = img.image_id GROUP BY region, country) SELECT region, count(*) AS cells, count(*) FILTER (WHERE done = images) AS complete, CAST(sum(images) AS BIGINT) AS images, CAST(sum(done) AS BIGINT) AS done, round(100.0 * CAST(sum(done) AS DOUBLE) / CAST(sum(images) AS DOUBLE), 4) AS pct FROM c GROUP BY region")
sql("pip32_missing_work_list", f"WITH {IMG}, {REG}, have AS (SELECT DISTINCT l_orderkey AS image_id FROM {{lineitem}}) SELECT region, country AS cell, img.image_id, CAST(row_number() OVER (PARTITION BY region, country ORDER BY img.image_id) AS BIGINT) AS pos FROM img JOIN reg USING (seq) ANTI JOIN have ON have.image_id = img.image_id")
sql("pip31_consolidation_plan", f"WITH {DET_ROWS}, a AS (SELECT image_id, det_idx, max(qty) AS size FROM det_rows WHERE drive = 'A' GROUP BY 1, 2), b AS (SELECT image_id, det_idx, max(qty) AS size FROM det_rows WHERE drive = 'R' GROUP BY 1, 2) SELECT CASE WHEN a.image_id IS NULL THEN 'move' WHEN b.image_id IS NULL THEN 'keep' WHEN a.size = b.size THEN 'identical' WHEN a.size > b.size THEN 'merge' ELSE 'conflict' END AS action, count(*) AS n FROM a FULL OUTER JOIN b ON a.image_id = b.image_id AND a.det_idx = b.det_idx GROUP BY 1")

# -- integrity contracts ------------------------------------------------------

sql("inv01_counts_add_up", f"WITH {IMG}, {DET}, n AS (SELECT image_id, count(*) AS n_det FROM det GROUP BY image_id) SELECT count(*) - count(*) FILTER (WHERE status = 0 AND n_det > 0) - count(*) FILTER (WHERE status = 0 AND n_det IS NULL) - count(*) FILTER (WHERE status <> 0) AS violations FROM img LEFT JOIN n USING (image_id)")
sql("inv02_no_duplicate_placement", f"WITH {DET_ROWS} SELECT count(*) AS violations FROM (SELECT image_id, det_idx, cell, drive FROM det_rows GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) t")
sql("inv03_cell_twins_reported", f"WITH {DET_ROWS} SELECT count(*) AS twin_images FROM (SELECT image_id FROM det_rows GROUP BY image_id HAVING count(DISTINCT cell) > 1) t")
sql("inv04_no_orphan_detections", f"WITH {IMG}, {DET_ROWS} SELECT count(*) AS violations FROM det_rows ANTI JOIN img ON img.image_id = det_rows.image_id")
sql("inv05_n_det_matches", f"WITH {IMG}, {DET}, n AS (SELECT image_id, count(*) AS n, max(det_idx) AS claimed FROM det GROUP BY image_id) SELECT count(*) FILTER (WHERE n <> claimed) AS violations, count(*) AS tested, (SELECT count(*) FROM img) AS images FROM n")
sql("inv06_null_score_iff_none", f"WITH {IMG}, {DET}, s AS (SELECT img.image_id, count(det.image_id) AS n_det, max(conf) AS max_conf FROM img LEFT JOIN det ON det.image_id = img.image_id WHERE status = 0 GROUP BY img.image_id) SELECT count(*) FILTER (WHERE (max_conf IS NULL) <> (n_det = 0)) AS violations FROM s")
sql("inv07_intake_contract", f"WITH {DET_ROWS} SELECT count(*) FILTER (WHERE image_id IS NULL OR det_idx IS NULL) AS null_keys, count(*) FILTER (WHERE det_idx < 0 OR det_idx > 255) AS idx_range, count(*) FILTER (WHERE isnan(conf)) AS nan_scores, count(*) FILTER (WHERE conf < 0 OR conf > 1) AS score_range FROM det_rows")
sql("inv08_part_row_counts", "WITH p AS (SELECT l_orderkey AS part, count(*) AS n, count(DISTINCT l_linenumber) AS d, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM {lineitem} GROUP BY l_orderkey) SELECT count(*) FILTER (WHERE n <> hi - lo + 1) AS wrong_count, count(*) FILTER (WHERE d <> hi - lo + 1) AS gaps FROM p")
sql("inv10_work_list_equals_catalog", "WITH w AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM {lineitem} GROUP BY 1), c AS (SELECT o_orderkey AS k, 1 AS n FROM {orders}) SELECT coalesce(w.k, c.k) AS cell, coalesce(w.n, 0) - coalesce(c.n, 0) AS delta FROM w FULL OUTER JOIN c ON w.k = c.k WHERE coalesce(w.n, 0) <> coalesce(c.n, 0)", "WITH w AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM {lineitem} GROUP BY 1), c AS (SELECT o_orderkey AS k, 1 AS n FROM {orders}) SELECT coalesce(w.k, c.k) AS cell, CAST(coalesce(w.n, 0) - coalesce(c.n, 0) AS BIGINT) AS delta FROM w FULL OUTER JOIN c ON w.k = c.k WHERE coalesce(w.n, 0) <> coalesce(c.n, 0)")
sql("inv11_derived_level", "WITH a AS (SELECT l_suppkey AS src, count(*) AS n FROM {lineitem} GROUP BY 1), d AS (SELECT l_suppkey AS src, count(*) AS n FROM {lineitem} WHERE l_returnflag <> 'N' GROUP BY 1) SELECT CASE WHEN coalesce(d.n, 0) = a.n THEN 'level' WHEN coalesce(d.n, 0) < a.n THEN 'behind' ELSE 'over' END AS state, count(*) AS n FROM a LEFT JOIN d USING (src) GROUP BY 1")
sql("inv12_kept_plus_hit", "SELECT source, count(*) AS total, count(*) FILTER (WHERE lang = 'en') AS hit, count(*) FILTER (WHERE lang <> 'en') AS kept, count(*) <> count(*) FILTER (WHERE lang = 'en') + count(*) FILTER (WHERE lang <> 'en') AS violated FROM {documents} GROUP BY source")
sql("inv13_output_name_collision", "SELECT concat(cast(l_orderkey AS STRING), '_', cast(l_linenumber AS STRING)) AS name, count(*) AS n FROM {lineitem} GROUP BY 1 HAVING count(*) > 1", "SELECT concat(cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR)) AS name, count(*) AS n FROM {lineitem} GROUP BY 1 HAVING count(*) > 1")
sql("inv15_upstream_complete", "SELECT (SELECT count(DISTINCT l_orderkey) FROM {lineitem}) AS judged, (SELECT count(*) FROM {orders}) AS planned, (SELECT count(DISTINCT l_orderkey) FROM {lineitem}) >= (SELECT count(*) FROM {orders}) AS may_run")
sql("inv16_job_list_equals_plan", "WITH plan AS (SELECT CAST(floor(o_orderkey / 1000.0) AS BIGINT) AS shard, count(*) AS planned FROM {orders} GROUP BY 1), job AS (SELECT CAST(floor(l_orderkey / 1000.0) AS BIGINT) AS shard, count(DISTINCT l_orderkey) AS jobs FROM {lineitem} GROUP BY 1) SELECT plan.shard, planned, coalesce(jobs, 0) AS jobs, coalesce(jobs, 0) <> planned AS refused FROM plan LEFT JOIN job ON job.shard = plan.shard")
sql("inv17_one_open_assignment", "SELECT user_id, event_type, count(*) AS n FROM {events} WHERE value > 100 GROUP BY user_id, event_type HAVING count(*) > 1")
sql("inv18_hard_caps", "SELECT count(*) AS n_rows, count(*) <= 200000000 AS within_cap FROM {lineitem}")
sql("inv19_run_id_congruence", "WITH r AS (SELECT o_orderkey, o_custkey, timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', o_orderdate) AS started FROM {orders}), m AS (SELECT started, (started + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 65536 AS run_id, started + o_custkey * 40 AS estimate FROM r) SELECT count(*) FILTER (WHERE started % 65536 <> run_id) AS violations, count(*) FILTER (WHERE abs(estimate - started) > 32768) AS too_far, count(*) AS runs FROM m", "WITH r AS (SELECT o_orderkey, o_custkey, CAST(epoch(o_orderdate) AS BIGINT) AS started FROM {orders}), m AS (SELECT started, (started + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 65536 AS run_id, started + o_custkey * 40 AS estimate FROM r) SELECT count(*) FILTER (WHERE started % 65536 <> run_id) AS violations, count(*) FILTER (WHERE abs(estimate - started) > 32768) AS too_far, count(*) AS runs FROM m")
