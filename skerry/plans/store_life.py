"""Plans over a store's life: ordered commits, compaction, undo, payloads, footers, map layers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import round_scaled
from ..scratch import new_path
from ..session import table
from ..sources import lifecycle, manifests, sinks
from .registry import query


def _sides(spark: SparkSession, sf_dir: str, part: int) -> tuple[DataFrame, DataFrame]:
    """Every fourth image and its detections."""
    det = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 4 == part).select("l_orderkey", "l_linenumber", "l_returnflag")
    return det, table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 4 == part).select("o_orderkey", "o_orderstatus")


def _state(spark: SparkSession, root: str, name: str) -> DataFrame:
    det, img = (lifecycle.read_part_kind(spark, root, k) for k in (lifecycle.DET, lifecycle.IMG))
    counts = det.agg(F.count("*").alias("dets")).join(img.agg(F.count("*").alias("images")))  # a row each
    return counts.select(F.lit(name).alias("state"), F.lit(len(lifecycle.live_parts(spark, root))).cast("long").alias("parts"), "dets", "images")


def _duck_state(name: str, parts: int, kept: str) -> str:
    return f"SELECT '{name}' AS state, CAST({parts} AS BIGINT) AS parts, (SELECT count(*) FROM lineitem WHERE l_orderkey % 4 IN ({kept})) AS dets, (SELECT count(*) FROM orders WHERE o_orderkey % 4 IN ({kept})) AS images"


@query("snk05_durable_commit", _duck_state("committed", 2, "0, 1"))
def snk05_durable_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts are committed; two more stop after their detections and after their images, and don't count."""
    root = new_path(spark, "parts")
    for part, stop in ((0, None), (2, lifecycle.DET), (1, None), (3, lifecycle.IMG)):
        lifecycle.commit_part(*_sides(spark, sf_dir, part), root, stop_after=stop)
    return _state(spark, root, "committed")


@query("str17_compaction", "SELECT l_returnflag AS drive, count(*) AS n, count(DISTINCT l_orderkey) AS images, CAST(1 AS BIGINT) AS parts, CAST(4 AS BIGINT) AS swept FROM lineitem WHERE l_orderkey % 4 < 3 GROUP BY 1")
def str17_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts as one pair, after a compaction that stopped half-way; the swept folders are the three and its leavings."""
    root = new_path(spark, "parts")
    for part in range(3):
        lifecycle.commit_part(*_sides(spark, sf_dir, part), root)
    order = (["l_orderkey", "l_linenumber"], ["o_orderkey"])
    lifecycle.compact(spark, root, *order, stop_after=lifecycle.DET)
    lifecycle.compact(spark, root, *order, files=4)
    swept = lifecycle.sweep(spark, root)
    det = lifecycle.read_part_kind(spark, root, lifecycle.DET)
    n = len(lifecycle.live_parts(spark, root))
    return det.groupBy(F.col("l_returnflag").alias("drive")).agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("images"), F.lit(n).cast("long").alias("parts"), F.lit(swept).cast("long").alias("swept"))


@query("str18_journalled_undo", _duck_state("before", 2, "0, 1") + " UNION ALL " + _duck_state("migrated", 1, "2") + " UNION ALL " + _duck_state("undone", 2, "0, 1"))
def str18_journalled_undo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry that replaces two parts by another, and its undoing."""
    root = new_path(spark, "parts")
    old = [lifecycle.commit_part(*_sides(spark, sf_dir, part), root) for part in (0, 1)]
    before = _state(spark, root, "before")
    lifecycle.commit_part(*_sides(spark, sf_dir, 2), root, replaces=old)
    after = _state(spark, root, "migrated")
    lifecycle.undo(spark, root)
    return before.union(after).union(_state(spark, root, "undone"))


@query("snk11_json_payload", "SELECT r_regionkey AS id, r_name AS name, (SELECT count(*) FROM region) AS total FROM region")
def snk11_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions as one document, read back; a second writer of the name is refused."""
    root = new_path(spark, "payload")
    rows = [r.asDict() for r in table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")).collect()]  # the 5 regions
    lifecycle.write_payload(spark, f"{root}/layers.json", {"total": len(rows), "layers": rows})
    try:
        lifecycle.write_payload(spark, f"{root}/layers.json", {"total": 0, "layers": []})
    except FileExistsError:
        pass
    doc = manifests.read_documents(spark, root, "total BIGINT, layers ARRAY<STRUCT<id: INT, name: STRING>>")
    return doc.select("total", F.inline("layers")).select("id", "name", "total")


@query("snk03_row_group_bound", "SELECT count(*) AS n_rows, true AS bounded, CAST(3 AS BIGINT) AS files FROM lineitem")
def snk03_row_group_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files of row groups of at most 500 rows, by their footers."""
    path = new_path(spark, "groups")
    sinks.write_row_groups(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), path, 500, files=3)
    return sinks.row_groups(spark, path).agg(F.sum("n_rows").alias("n_rows"), (F.max("n_rows") <= 500).alias("bounded"), F.countDistinct("path").alias("files"))


@query("src10_footer_health", "SELECT CAST(3 AS BIGINT) AS n_ok, CAST(1 AS BIGINT) AS broken, count(*) AS n_rows FROM lineitem")
def src10_footer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a readable footer and others, by a distributed scan of the footers."""
    path = new_path(spark, "health")
    sinks.write_row_groups(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), path, files=3)
    fs, torn = sinks._fs(spark, f"{path}/torn.parquet")
    out = fs.create(torn)
    out.write(bytearray(b"PAR1 torn"))
    out.close()
    found = sinks.row_groups(spark, path)
    return found.agg(F.countDistinct(F.when(F.col("n_rows").isNotNull(), F.col("path"))).alias("n_ok"), F.countDistinct(F.when(F.col("n_rows").isNull(), F.col("path"))).alias("broken"), F.sum("n_rows").alias("n_rows"))


#: Degrees a map cell is wide at each zoom.
RESOLUTIONS = (2.0, 0.5, 0.1)


def map_layers(points: DataFrame, layer: str, lon: str, lat: str, weight: str, resolutions: tuple[float, ...] = RESOLUTIONS) -> DataFrame:
    """Per layer, resolution and cell centre: points and weight; a row a layer with null centres holds what has no valid place.

    Nulls and coordinates out of range are unlocated, and counted once, at
    resolution null.  Cells whose weight is not positive are left out, as is
    nothing else.  One exchange for all resolutions.
    """
    placed = F.coalesce(F.col(lon).between(-180, 180) & F.col(lat).between(-90, 90), F.lit(False))
    at = F.when(placed, F.array(*[F.lit(float(r)) for r in resolutions])).otherwise(F.array(F.lit(None).cast("double")))
    cells = points.select(F.col(layer).alias("layer"), F.col(lon).alias("x"), F.col(lat).alias("y"), F.col(weight).alias("w"), F.explode(at).alias("resolution"))
    centre = lambda c: F.when(F.col("resolution").isNotNull(), F.round(F.floor(F.col(c) / F.col("resolution")) * F.col("resolution") + F.col("resolution") / 2, 4))
    out = cells.groupBy("layer", "resolution", centre("x").alias("lon"), centre("y").alias("lat")).agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).cast("long").alias("weight"))
    return out.filter("resolution is null or weight > 0")


_POINTS = "SELECT c_mktsegment AS layer, CASE WHEN c_custkey % 11 > 0 THEN round(c_acctbal / 40 - 60, 3) END AS x, round((c_custkey * 37 % 2000) / 10.0 - 99, 3) AS y, c_custkey % 5 AS w FROM customer"


@query(
    "pip14_map_layers",
    f"WITH p AS ({_POINTS}), o AS (SELECT *, coalesce(x BETWEEN -180 AND 180 AND y BETWEEN -90 AND 90, false) AS placed FROM p), z AS (SELECT unnest([{', '.join(f'{r}::DOUBLE' for r in RESOLUTIONS)}]) AS r) "
    "SELECT layer, r AS resolution, round(floor(x / r) * r + r / 2, 4) AS lon, round(floor(y / r) * r + r / 2, 4) AS lat, count(*) AS n, CAST(sum(w) AS BIGINT) AS weight FROM o JOIN z ON placed GROUP BY ALL HAVING sum(w) > 0 "
    "UNION ALL SELECT layer, NULL, NULL, NULL, count(*), CAST(sum(w) AS BIGINT) FROM o WHERE NOT placed GROUP BY layer",
)
def pip14_map_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three resolutions of every layer, and what could not be placed."""
    key = F.col("c_custkey")
    x, y = round_scaled(F.col("c_acctbal") / 40 - 60, 3), round_scaled((key * 37 % 2000) / 10.0 - 99, 3)
    points = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("layer"), F.when(key % 11 > 0, x).alias("x"), y.alias("y"), (key % 5).alias("w"))
    return map_layers(points, "layer", "x", "y", "w")
