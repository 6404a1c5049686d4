"""A stop between any two steps leaves a store readable; map layers lose no point."""

import duckdb
import pytest
from pyspark.sql import functions as F

from skerry.plans.registry import ORACLES
from skerry.plans.store_life import map_layers, pip14_map_layers
from skerry.scratch import new_path
from skerry.sources import lifecycle as life

ORDER = (["image", "det"], ["image"])


def sides(spark, ids):
    img = spark.createDataFrame([(i,) for i in ids], "image long")
    return img.withColumn("det", F.lit(0)).union(img.withColumn("det", F.lit(1))), img


def images(spark, root):
    return sorted(r[0] for r in life.read_part_kind(spark, root, life.IMG).collect())


def test_a_stop_anywhere_leaves_a_whole_store(spark):
    root = new_path(spark, "store")
    assert life.live_parts(spark, root) == [] and not life.undo(spark, root)
    life.commit_part(*sides(spark, [1, 2]), root)
    for stop in (life.DET, life.IMG):
        assert life.commit_part(*sides(spark, [9]), root, stop_after=stop) is None
        assert images(spark, root) == [1, 2]
    assert life.compact(spark, root, *ORDER) is None
    life.commit_part(*sides(spark, [2, 3, None]), root)
    for stop in (life.DET, life.IMG):
        assert life.compact(spark, root, *ORDER, stop_after=stop) is None
        assert len(life.live_parts(spark, root)) == 2
    life.compact(spark, root, *ORDER)
    assert len(life.live_parts(spark, root)) == 1
    assert [r[0] for r in life.read_part_kind(spark, root, life.IMG).filter("image is not null").orderBy("image").collect()] == [1, 2, 2, 3]
    assert life.undo(spark, root) and len(life.live_parts(spark, root)) == 2
    life.compact(spark, root, *ORDER)
    assert life.sweep(spark, root) == 7  # two parts, two stopped commits, two stopped compactions, one undone
    assert life.sweep(spark, root) == 0 and not life.undo(spark, root)
    assert life.read_part_kind(spark, root, life.DET).count() == 10


def test_a_compaction_that_lost_rows_is_refused(spark, monkeypatch):
    root = new_path(spark, "store")
    for ids in ([1], [2]):
        life.commit_part(*sides(spark, ids), root)
    seen = iter([(1, 5), (2, 5)])
    monkeypatch.setattr(life, "_digest", lambda df: next(seen))
    with pytest.raises(ValueError):
        life.compact(spark, root, *ORDER)
    assert images(spark, root) == [1, 2] and len(life.live_parts(spark, root)) == 2


def test_a_payload_is_whole_or_absent(spark):
    root = new_path(spark, "payload")
    life.write_payload(spark, f"{root}/a.json", {"k": [1, None, "é"]})
    with pytest.raises(FileExistsError):
        life.write_payload(spark, f"{root}/a.json", {})
    assert [r[0] for r in spark.read.text(root).collect()] == ['{"k": [1, null, "\\u00e9"]}']


def test_layers_count_every_point_at_every_resolution(spark):
    pts = [("a", 1.0, 1.0, 2), ("a", 1.2, 1.4, 3), ("a", None, 1.0, 1), ("a", 200.0, 0.0, 1), ("b", float("nan"), 0.0, 1), ("b", -180.0, -90.0, 0), ("b", 0.0, None, None)]
    df = spark.createDataFrame(pts, "layer string, x double, y double, w int")
    got = sorted(map(tuple, map_layers(df, "layer", "x", "y", "w", (2.0, 0.5)).collect()), key=repr)
    none = (None, None, None, 2)
    assert got == sorted([("a", 2.0, 1.0, 1.0, 2, 5), ("a", 0.5, 1.25, 1.25, 2, 5), ("a", *none, 2), ("b", *none, 1)], key=repr)
    assert map_layers(df.limit(0), "layer", "x", "y", "w").count() == 0


def test_map_layers_at_cell_borders_as_in_sql(spark, tmp_path):
    key = F.col("id")
    near = (key * 4).cast("double") - 0.02  # a tie of the third digit just below a border
    rows = spark.range(1, 4000).select(key.alias("c_custkey"), near.alias("c_acctbal"), (key % 3).cast("string").alias("c_mktsegment"))
    rows.write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = con.execute(f"SELECT layer, resolution, lon, lat, n, weight FROM ({ORACLES['pip14_map_layers']})").fetchall()
    got = pip14_map_layers(spark, str(tmp_path)).select("layer", "resolution", "lon", "lat", "n", "weight").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
