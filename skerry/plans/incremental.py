"""Incremental and streaming plans over ``events`` and over part listings."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize, new_path
from ..session import table
from ..sources import manifests, sinks, tiles
from ..streaming import events as streams
from .registry import query, sql

sql("str01_changed_parts", "WITH now AS (SELECT l_suppkey AS path, count(*) AS size, max(l_orderkey) AS modified FROM {lineitem} GROUP BY 1), was AS (SELECT l_suppkey AS path, count(*) AS size, max(l_orderkey) AS modified FROM {lineitem} WHERE l_suppkey % 3 > 0 OR l_linenumber < 3 GROUP BY 1) SELECT now.path FROM now ANTI JOIN was ON was.path = now.path AND was.size = now.size AND was.modified = now.modified")
sql("str02_delete_by_source_reinsert", "WITH changed AS (SELECT DISTINCT l_suppkey AS src FROM {lineitem} WHERE l_suppkey % 4 = 0), kept AS (SELECT l_suppkey AS src, l_quantity AS v FROM {lineitem} ANTI JOIN changed ON changed.src = l_suppkey), fresh AS (SELECT l_suppkey AS src, l_quantity + 1 AS v FROM {lineitem} SEMI JOIN changed ON changed.src = l_suppkey) SELECT src, count(*) AS n, round(sum(v), 2) AS total FROM (SELECT * FROM kept UNION ALL SELECT * FROM fresh) u GROUP BY src")
sql("str03_prune_vanished_parts", "SELECT count(*) AS n FROM {lineitem} SEMI JOIN (SELECT s_suppkey FROM {supplier} WHERE s_acctbal > 0) s ON s.s_suppkey = l_suppkey")
sql("str04_offline_aware_prune", "WITH online AS (SELECT 'A' AS drive UNION ALL SELECT 'R'), listed AS (SELECT DISTINCT l_orderkey FROM {lineitem} WHERE l_linenumber <= 2) SELECT l_returnflag AS drive, count(*) AS n FROM {lineitem} l WHERE l_returnflag NOT IN (SELECT drive FROM online) OR EXISTS (SELECT 1 FROM listed WHERE listed.l_orderkey = l.l_orderkey AND l.l_linenumber <= 2) GROUP BY 1")
sql("str05_reuse_counts_by_mtime", "WITH snap AS (SELECT o_custkey AS dir, count(*) AS n FROM {orders} WHERE o_custkey % 2 = 0 GROUP BY 1), now AS (SELECT o_custkey AS dir, count(*) AS n FROM {orders} GROUP BY 1) SELECT now.dir, coalesce(snap.n, now.n) AS n, snap.n IS NOT NULL AS reused FROM now LEFT JOIN snap ON snap.dir = now.dir")
sql("str06_signature_gate", "SELECT md5(array_join(array_sort(collect_list(concat(cast(n_nationkey AS STRING), ':', n_name))), '|')) AS signature FROM {nation}", "SELECT md5(array_to_string(list_sort(list(concat(cast(n_nationkey AS VARCHAR), ':', n_name))), '|')) AS signature FROM {nation}")
sql("str07_refuse_on_missing_inputs", "SELECT count(*) FILTER (WHERE l.l_suppkey IS NULL) AS missing, count(*) FILTER (WHERE l.l_suppkey IS NULL) = 0 AS may_publish FROM {supplier} LEFT JOIN (SELECT DISTINCT l_suppkey FROM {lineitem}) l ON l.l_suppkey = s_suppkey")
sql("str08_row_offset_shards", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS total FROM {orders}) SELECT CAST(floor((i * 4 + 3) / total) AS BIGINT) AS shard, count(*) AS n, min(o_orderkey) AS first_id FROM r GROUP BY 1")
sql("str12_resume_by_committed_ranges", "WITH r AS (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM {conversations}) SELECT conv_id, min(turn + 1) AS resume_at FROM r WHERE after IS NULL OR after <> turn + 1 GROUP BY conv_id")
sql("str13_contiguous_committed_prefix", "WITH c AS (SELECT l_orderkey AS shard, count(*) >= 3 AS complete FROM {lineitem} GROUP BY 1), f AS (SELECT min(shard) AS first_open FROM c WHERE NOT complete) SELECT count(*) AS committed FROM c JOIN f ON shard < first_open")
sql("str14_late_reconciliation", "SELECT count(*) FILTER (WHERE l.n IS NULL) AS never_seen, count(*) FILTER (WHERE l.n < 2) AS short FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM {lineitem} GROUP BY 1) l ON l.l_orderkey = o_orderkey")
sql("str16_negative_cache", "WITH known AS (SELECT doc_id FROM {labels} UNION SELECT doc_id FROM {documents} WHERE n_chars < 200) SELECT count(*) AS todo FROM {documents} d ANTI JOIN known ON known.doc_id = d.doc_id")
#: Failures of a source count up until a day of quiet; from the third on each doubles the lockout, from 30 s to 15 minutes.
sql("str19_failure_throttle", "WITH f AS (SELECT user_id, event_id, timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS sec FROM {events} WHERE event_type = 'error'), g AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) <= 86400 THEN 0 ELSE 1 END AS fresh FROM f), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM g), n AS (SELECT *, row_number() OVER (PARTITION BY user_id, streak ORDER BY sec, event_id) AS fails, row_number() OVER (PARTITION BY user_id ORDER BY sec DESC, event_id DESC) AS back FROM s) SELECT user_id, CAST(fails AS BIGINT) AS fails, CAST(sec + CASE WHEN fails < 3 THEN 0 ELSE least(900, 30 * power(2, fails - 3)) END AS BIGINT) AS locked_until FROM n WHERE back = 1", "WITH f AS (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM {events} WHERE event_type = 'error'), g AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) <= 86400 THEN 0 ELSE 1 END AS fresh FROM f), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM g), n AS (SELECT *, row_number() OVER (PARTITION BY user_id, streak ORDER BY sec, event_id) AS fails, row_number() OVER (PARTITION BY user_id ORDER BY sec DESC, event_id DESC) AS back FROM s) SELECT user_id, CAST(fails AS BIGINT) AS fails, CAST(sec + CASE WHEN fails < 3 THEN 0 ELSE least(900, 30 * power(2, fails - 3)) END AS BIGINT) AS locked_until FROM n WHERE back = 1")
sql("str20_work_state", "SELECT o_orderkey, CASE WHEN l.n IS NULL THEN 'fresh' WHEN l.n < 4 THEN 'resume' ELSE 'done' END AS state FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM {lineitem} GROUP BY 1) l ON l.l_orderkey = o_orderkey")


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream: its rows in a folder of parts, with times as instants."""
    src = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartition(4, "user_id")
    parts = materialize(src, "events")
    return streams.read_events(spark, parts.inputFiles()[0].rsplit("/", 1)[0], parts.schema)


@query("str15_tumbling_windows", "SELECT strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def str15_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streams.replay(streams.tumbling(_stream(spark, sf_dir), "1 day"), f"tumbling_{uuid.uuid4().hex}")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("str15b_sliding_windows", "WITH w AS (SELECT time_bucket(INTERVAL '12 hours', ts) - to_hours(12 * k) AS start, event_type FROM events JOIN (SELECT 0 AS k UNION ALL SELECT 1) s ON 1 = 1) SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM w GROUP BY 1, 2")
def str15b_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streams.replay(streams.sliding(_stream(spark, sf_dir), "24 hours", "12 hours"), f"sliding_{uuid.uuid4().hex}")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("str15c_session_windows", "WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL '6 hours' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, session")
def str15c_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streams.replay(streams.sessions(_stream(spark, sf_dir), "6 hours"), f"sessions_{uuid.uuid4().hex}")
    return out.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("str10b_streaming_ledger_state", "SELECT cast(user_id AS VARCHAR) AS key, event_type AS verdict, event_id AS ord FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) t WHERE r = 1 AND event_type <> 'error'")
def str10b_streaming_ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _stream(spark, sf_dir).select(F.col("user_id").cast("string").alias("key"), F.nullif(F.col("event_type"), F.lit("error")).alias("verdict"), F.col("event_id").alias("ord"))
    changes = streams.replay(streams.ledger_state(feed), f"ledger_{uuid.uuid4().hex}", mode="update")
    return changes.groupBy("key").agg(F.max_by(F.struct("verdict"), "ord").alias("v"), F.max("ord").alias("ord")).select("key", F.col("v.verdict").alias("verdict"), "ord").filter("verdict is not null")


@query("snk01_chunked_writer", "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS images FROM lineitem")
def snk01_chunked_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes back from parts of at most 10,000 rows."""
    path = new_path(spark, "chunked")
    sinks.write_chunked(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), path, 10_000)
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.countDistinct("l_orderkey").alias("images"))


@query("snk10_report_with_total", "SELECT r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name UNION ALL SELECT 'GLOBAL TOTAL', count(*) FROM nation JOIN region ON n_regionkey = r_regionkey")
def snk10_report_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("nations"))
    return sinks.with_total(per, "r_name", ["nations"])


@query("src02_row_index_scan", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index FROM orders")
def src02_row_index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.with_row_index(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query("src08_rows_per_file", "SELECT count(*) AS n_rows FROM lineitem")
def src08_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.rows_by_file(table(spark, sf_dir, "lineitem")).agg(F.sum("n_rows").alias("n_rows"))


@query("src11_absent_column_as_null", "SELECT l_orderkey AS image_id, CAST(NULL AS VARCHAR) AS model_sha8 FROM lineitem")
def src11_absent_column_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.coerce(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "image_id"), manifests.schema("image_id BIGINT, model_sha8 STRING"))


@query("src24_sub_grid", "SELECT n_nationkey, sub, CAST(n_nationkey + sub % 3 AS DOUBLE) AS west, CAST(floor(sub / 3) AS DOUBLE) AS south FROM nation JOIN (SELECT CAST(unnest(range(6)) AS INT) AS sub) s ON 1 = 1")
def src24_sub_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell of 3 by 2 degrees as six 1-degree boxes."""
    x = F.col("n_nationkey").cast("double")
    cells = table(spark, sf_dir, "nation").select("n_nationkey", x.alias("sw_lon"), F.lit(0.0).alias("sw_lat"), (x + 3).alias("ne_lon"), F.lit(2.0).alias("ne_lat"))
    return tiles.sub_grid(cells).select("n_nationkey", "sub", "west", "south")
