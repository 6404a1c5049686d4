"""Scans and sinks over files that each plan writes first, into the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_path
from ..session import table
from ..sources import manifests, sinks
from .registry import query


def _lines(df: DataFrame, name: str, **options: str) -> str:
    """Writes the column ``value`` as text; the folder."""
    path = new_path(df.sparkSession, name)
    df.select("value").write.options(**options).text(path)
    return path


@query("src01_csv_grid_scan", "SELECT CAST(n_nationkey AS DOUBLE) AS sw_lon, CAST(n_nationkey + 1 AS DOUBLE) AS ne_lon, n_name AS region FROM nation")
def src01_csv_grid_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, x = new_path(spark, "grid"), F.col("n_nationkey")
    table(spark, sf_dir, "nation").select(x.alias("sw_lon"), F.lit(0).alias("sw_lat"), (x + 1).alias("ne_lon"), F.lit(1).alias("ne_lat"), F.col("n_name").alias("region")).write.option("header", True).csv(path)
    return manifests.read_grid(spark, path).select("sw_lon", "ne_lon", "region")


@query("src05_manifests_one_by_one", "SELECT CAST(o_orderkey AS VARCHAR) AS image_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS make, CAST(NULL AS BIGINT) AS width, CAST(1 AS BIGINT) AS unreadable FROM orders")
def src05_manifests_one_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of different columns and one that is no Parquet, as one frame; how many could not be read."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("make"))
    paths = [new_path(spark, "manifest") for _ in range(2)]
    orders.filter("image_id % 2 = 0").write.parquet(paths[0])
    orders.filter("image_id % 2 = 1").select("image_id").write.parquet(paths[1])
    torn = _lines(spark.range(1).select(F.lit("torn").alias("value")), "torn")
    df, bad = manifests.read_manifests(spark, [*paths, torn], "image_id STRING, make STRING, width BIGINT")
    return df.withColumn("unreadable", F.lit(len(bad)).cast("long"))


def _by_drive(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "store")
    sinks.write_by_parent(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("drive")), path, "drive")
    return path


@query("src06_hive_store", "SELECT l_returnflag AS drive, count(*) AS n, count(DISTINCT l_orderkey) AS images, 0 AS old FROM lineitem GROUP BY 1")
def src06_hive_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned store by a schema with a column that its files lack."""
    df = manifests.read_store(spark, _by_drive(spark, sf_dir), "l_orderkey BIGINT, l_linenumber INT, model_sha8 STRING, drive STRING")
    return df.groupBy("drive").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("images"), F.count("model_sha8").cast("int").alias("old"))


@query("src07_row_provenance", "SELECT l_returnflag AS drive, count(*) AS n_rows FROM lineitem GROUP BY 1")
def src07_row_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per folder, by the path that each row came from."""
    rows = manifests.rows_by_file(spark.read.parquet(_by_drive(spark, sf_dir)))
    return rows.groupBy(F.regexp_extract("path", "/drive=([^/]+)/", 1).alias("drive")).agg(F.sum("n_rows").alias("n_rows"))


@query("src12_json_map_scan", "SELECT cast(n_nationkey AS VARCHAR) AS key, n_name AS value FROM nation")
def src12_json_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "nation").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name")))).alias("value"))  # the 25 nations
    return manifests.read_json_map(spark, _lines(one, "map", compression="gzip"))


@query("src13_jsonl_with_torn_tail", "SELECT o_orderkey AS image_id, o_orderpriority AS make FROM orders WHERE o_orderkey % 5 < 2")
def src13_jsonl_with_torn_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed lines of which some are blank, torn, no objects or have broken values."""
    good = F.to_json(F.struct(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("make")))
    kind = F.col("o_orderkey") % 5
    value = F.when(kind < 2, good).when(kind == 2, F.substring(good, 1, 14)).when(kind == 3, F.lit("  ")).otherwise(F.lit("[1, 2]"))
    return manifests.read_jsonl(spark, _lines(table(spark, sf_dir, "orders").select(value.alias("value")), "ledger", compression="gzip"), "image_id BIGINT, make STRING")


@query("src14b_ids_of_raw_lines", "SELECT cast(o_orderkey AS VARCHAR) AS image_id FROM orders WHERE o_orderkey % 3 > 0")
def src14b_ids_of_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit('{"x": 1, "image_id" : "'), F.col("o_orderkey"), F.lit('", "torn'))).otherwise(F.lit('{"x": 2}'))
    return manifests.read_ids(spark, _lines(table(spark, sf_dir, "orders").select(text.alias("value")), "raw"))


@query("src16_json_documents", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def src16_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document over several lines a file."""
    path = new_path(spark, "documents")
    whole = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.struct(F.col("n_regionkey").alias("region")).alias("at")), {"pretty": "true"})
    table(spark, sf_dir, "nation").select(whole.alias("value"), F.col("n_nationkey").alias("k")).write.partitionBy("k").text(path)
    return manifests.read_documents(spark, path, "id INT, name STRING, at STRUCT<region: INT>").select("id", "name", "at.region")


@query("src17b_line_set", "SELECT DISTINCT o_orderpriority AS line FROM orders")
def src17b_line_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lit("# a comment")).when(F.col("o_orderkey") % 4 == 1, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("  # why")))
    return manifests.read_lines(spark, _lines(o.select(text.alias("value")).union(o.select("o_orderpriority").distinct()), "set"))


def _listed(spark: SparkSession, sf_dir: str) -> str:
    """A folder a nation, with its name as a file's only line."""
    path = new_path(spark, "listing")
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("k")).write.partitionBy("k").text(path)
    return path


@query("src18_directory_listing", "SELECT n_nationkey AS dir, CAST(strlen(n_name) + 1 AS BIGINT) AS size, CAST(1 AS BIGINT) AS files FROM nation")
def src18_directory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifests.list_files(spark, _listed(spark, sf_dir), "part-*").filter("modified is not null")
    return found.groupBy(F.regexp_extract("path", "/k=([0-9]+)/", 1).cast("int").alias("dir")).agg(F.sum("size").alias("size"), F.count("*").alias("files"))


@query("src20_digit_stems", "SELECT count(*) FILTER (WHERE n_nationkey % 3 > 0) AS ids, count(*) FILTER (WHERE n_nationkey % 3 = 0) AS skipped, CAST(sum(CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey ELSE 0 END) AS BIGINT) AS total FROM nation")
def src20_digit_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images by their file names; names that are no ids are counted."""
    path = new_path(spark, "stems")
    fs, at = sinks._fs(spark, path)
    for r in table(spark, sf_dir, "nation").select("n_nationkey").collect():  # the 25 nations
        file = fs.create(spark._jvm.org.apache.hadoop.fs.Path(at, f"{'' if r[0] % 3 else 'x'}{r[0]}.jpg"))
        file.write(0)  # scans leave out files without bytes
        file.close()
    return manifests.digit_stems(manifests.list_files(spark, path, "*.jpg")).agg(F.count("id").alias("ids"), F.count_if(F.col("id").isNull()).alias("skipped"), F.sum("id").alias("total"))


@query("src21_catalog_or_listing", "SELECT cast(n_nationkey AS VARCHAR) AS name, true AS degraded FROM nation")
def src21_catalog_or_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that can't be read after some tries: the folders stand in for it."""
    root = _listed(spark, sf_dir)
    listed = lambda: manifests.list_files(spark, root, "part-*").select(F.regexp_extract("path", "/k=([0-9]+)/", 1).alias("name"))
    df, degraded = manifests.read_or_else(lambda: spark.read.parquet(f"{root}/no-such-catalog").select("name"), listed, tries=2, wait=0)
    return df.withColumn("degraded", F.lit(degraded))


@query("src25_training_curve", "SELECT CAST(c_custkey AS DOUBLE) AS epoch, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS loss FROM customer")
def src25_training_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "curve")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("  epoch"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("nan?")).alias(" loss ")).write.option("header", True).csv(path)
    return manifests.read_curve(spark, path)


@query("src26_yolo_labels", "SELECT l_linenumber AS label, count(*) AS n, round(sum(l_discount - 0.125), 6) AS x1, round(sum(l_discount + 0.125), 6) AS x2 FROM lineitem WHERE l_orderkey % 3 > 0 GROUP BY 1")
def src26_yolo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.concat_ws(" ", "l_linenumber", "l_discount", F.lit(0.5), F.lit(0.25), F.lit(0.125))
    text = F.when(F.col("l_orderkey") % 3 > 0, good).otherwise(F.lit("1 0.5 x"))
    boxes = manifests.read_yolo(spark, _lines(table(spark, sf_dir, "lineitem").select(text.alias("value")), "yolo"))
    return boxes.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum("x1"), 6).alias("x1"), F.round(F.sum("x2"), 6).alias("x2"))


@query("snk04_sorted_parts", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS overlaps, count(DISTINCT l_orderkey) AS images FROM lineitem")
def snk04_sorted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by key range: no two hold the same keys, so readers can skip them."""
    path = new_path(spark, "sorted")
    sinks.write_sorted(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), path, ["l_orderkey"], 8)
    part = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"), F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("d"))
    return part.alias("a").join(part.select("f", "lo", "hi").alias("b"), (F.col("a.f") < F.col("b.f")) & (F.col("a.lo") <= F.col("b.hi")) & (F.col("b.lo") <= F.col("a.hi")), "left").agg(F.sum("a.n").alias("n_rows"), F.count("b.f").alias("overlaps"), F.sum("a.d").alias("images"))  # the 8 parts


@query("snk06_verify_before_swap", "SELECT count(*) AS n_rows, true AS refused, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders")
def snk06_verify_before_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced after its rows were counted; a short one is refused and changes nothing."""
    path, orders = new_path(spark, "swap"), table(spark, sf_dir, "orders")
    sinks.swap_verified(orders.limit(0), path)
    sinks.swap_verified(orders, path)
    try:
        sinks.swap_verified(orders.limit(3), path, expect_rows=4)
        refused = False
    except ValueError:
        refused = True
    return sinks.read_swapped(spark, path).agg(F.count("*").alias("n_rows"), F.lit(refused).alias("refused"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))


@query("snk08_csv_by_group", "SELECT l_returnflag AS drive, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def snk08_csv_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "split")
    sinks.write_by_parent(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("drive")), path, "drive", "csv")
    return spark.read.schema("l_orderkey BIGINT, l_linenumber INT, drive STRING").option("header", True).csv(path).groupBy("drive").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("total"))


@query("snk12_append_with_author", "SELECT count(*) AS n, true AS refused FROM events WHERE user_id % 2 = 0")
def snk12_append_with_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a ledger; a third without authors fails and adds nothing."""
    path = new_path(spark, "events")
    events = table(spark, sf_dir, "events").filter("user_id % 2 = 0").select("event_id", F.col("user_id").cast("string").alias("by"))
    for part in (0, 1):
        sinks.append_events(events.filter(F.col("event_id") % 2 == part), path)
    try:
        sinks.append_events(events.drop("by"), path)
        refused = False
    except ValueError:
        refused = True
    return manifests.read_jsonl(spark, path, "event_id BIGINT, by STRING").filter("by is not null").agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query("snk13_jsonl_export", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def snk13_jsonl_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "export")
    sinks.export_jsonl(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), path)
    return manifests.read_jsonl(spark, path, "id INT, name STRING")


@query("snk14_merge_archive", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'new' END AS origin FROM orders")
def snk14_merge_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added to an archive: of a key that it has, the archived row stays."""
    path, keys = new_path(spark, "archive"), table(spark, sf_dir, "orders").select("o_orderkey")
    sinks.merge_archive(keys.filter("o_orderkey % 3 = 0").withColumn("origin", F.lit("old")), path, ["o_orderkey"], ["origin"])
    sinks.merge_archive(keys.withColumn("origin", F.lit("new")), path, ["o_orderkey"], ["origin"])
    return sinks.read_swapped(spark, path)
