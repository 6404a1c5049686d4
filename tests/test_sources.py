"""Scans, sinks, tiles and streams over files made here."""

import json
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skerry.sources import manifests, sinks, tiles
from skerry.streaming import events as streams


def test_manifests_with_null_typed_missing_and_torn_files(spark, tmp_path):
    pq.write_table(pa.table({"image_id": ["1", "2"], "make": pa.nulls(2), "height": [5, 6]}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"image_id": ["3"], "make": ["x"], "height": ["seven"]}), tmp_path / "b.parquet")
    (tmp_path / "c.parquet").write_bytes(b"PAR1 torn")
    df, bad = manifests.read_manifests(spark, [f"file://{tmp_path}/{n}.parquet" for n in "abc"], "image_id STRING, make STRING, height BIGINT, sequence STRING")
    assert {tuple(r) for r in df.collect()} == {("1", None, 5, None), ("2", None, 6, None), ("3", "x", None, None)}
    assert [p.rsplit("/", 1)[1] for p, _ in bad] == ["c.parquet"]


def test_hive_store_by_name_and_missing_root(spark, tmp_path):
    root = tmp_path / "store"
    for cell, cols in (("a", {"image_id": [1]}), ("b", {"image_id": [2], "model_sha8": ["f"]})):
        (root / f"cell={cell}").mkdir(parents=True)
        pq.write_table(pa.table(cols), root / f"cell={cell}" / "x.img.parquet")
    ddl = "image_id BIGINT, model_sha8 STRING, cell STRING"
    got = manifests.read_store(spark, f"file://{root}", ddl, "*.img.parquet")
    assert {tuple(r) for r in got.collect()} == {(1, None, "a"), (2, "f", "b")}
    assert manifests.read_store(spark, f"file://{tmp_path}/none", ddl).count() == 0


def test_text_scans(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"key": "a", "n": 1}\n\n[1]\n{"key": "b", "n"\n{"key": "c", "n": 3}\n')
    assert {tuple(r) for r in manifests.read_jsonl(spark, f"file://{tmp_path}/l.jsonl", "key STRING, n BIGINT").collect()} == {("a", 1), ("c", 3)}
    (tmp_path / "m.json").write_text(json.dumps({"i1": "s1", "i2": "s2"}))
    assert {tuple(r) for r in manifests.read_json_map(spark, f"file://{tmp_path}/m.json").collect()} == {("i1", "s1"), ("i2", "s2")}
    (tmp_path / "x.txt").write_text("# head\n a \nb # note\n\na\n")
    assert {r[0] for r in manifests.read_lines(spark, f"file://{tmp_path}/x.txt").collect()} == {"a", "b"}
    (tmp_path / "i.jsonl").write_text('{"image_id": "77", "data": {}}\n{"image_id": 78}\nbad\n')
    assert {r[0] for r in manifests.read_ids(spark, f"file://{tmp_path}/i.jsonl").collect()} == {"77", "78"}
    (tmp_path / "g.csv").write_text("sw_lon,sw_lat,ne_lon,ne_lat,region\n-10,0,-7.5,2,A & B\n")
    cells = manifests.read_grid(spark, f"file://{tmp_path}/g.csv")
    got = tiles.sub_grid(cells).orderBy("sub").select("sub", "west", "south", "east").collect()
    assert [tuple(r) for r in got] == [(0, -10, 0, -9), (1, -9, 0, -8), (2, -8, 0, -7.5), (3, -10, 1, -9), (4, -9, 1, -8), (5, -8, 1, -7.5)]
    (tmp_path / "y.txt").write_text("0 0.5 0.5 0.2 0.4\nbad line\n")
    assert [round(v, 6) for v in manifests.read_yolo(spark, f"file://{tmp_path}/y.txt").first()[2:]] == [0.4, 0.3, 0.6, 0.7]
    (tmp_path / "c.csv").write_text(" epoch , loss\n 1, 0.5\n 2, nan?\n")
    assert [tuple(r) for r in manifests.read_curve(spark, f"file://{tmp_path}/c.csv").orderBy("epoch").collect()] == [(1.0, 0.5), (2.0, None)]
    assert {r["stem"] for r in manifests.list_files(spark, f"file://{tmp_path}", "*.json*").collect()} == {"l", "m", "i"}


def varint(n):
    out = b""
    while True:
        n, b = n >> 7, n & 127
        out += bytes([b | (128 if n else 0)])
        if not n:
            return out


def block(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def test_vector_tile(spark):
    values = [block(4, varint(4 << 3) + varint(99)), block(4, block(1, b"seq")), block(4, varint(4 << 3) + varint((1 << 64) - 5)), block(4, varint(3 << 3 | 1) + struct.pack("<d", 1.5))]
    feature = block(2, block(2, b"".join(map(varint, (0, 0, 1, 1, 2, 2)))))
    layer = block(3, block(1, b"image") + feature + block(3, b"id") + block(3, b"sequence_id") + block(3, b"captured_at") + b"".join(values))
    df = spark.createDataFrame([("t", bytearray(layer)), ("torn", bytearray(layer[:-3])), ("none", bytearray())], "path string, content binary")
    got = {tuple(r) for r in tiles.tile_features(df).collect()}
    assert ("t", "99", "seq", -5, None) in got
    assert {r[0] for r in got} <= {"t", "torn"}


def test_swap_keeps_the_old_table_on_a_wrong_count(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert sinks.swap_verified(spark.range(3), path) == 3
    with pytest.raises(ValueError):
        sinks.swap_verified(spark.range(5), path, expect_rows=4)
    assert sinks.read_swapped(spark, path).count() == 3
    spark.range(9).write.parquet(f"{path}/v000000002-torn")  # as a crash before the mark leaves it
    assert sinks.read_swapped(spark, path).count() == 3
    assert sinks.merge_archive(spark.range(2, 6), path, ["id"], ["id"]) == 6


def test_contract_split(spark):
    good, bad = sinks.split_by_contract(spark.createDataFrame([(1, 0.5), (2, None), (None, 2.0)], "id long, p double"), {"id": F.col("id").isNotNull(), "p": F.col("p").between(0, 1)})
    assert good.count() == 1 and {tuple(r["broken"]) for r in bad.collect()} == {("p",), ("id", "p")}


def test_parts_that_changed_or_went(spark):
    was = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)], "path string, size long, modified long")
    now = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("d", 1, 1)], "path string, size long, modified long")
    changed, gone = streams.changed_parts(now, was)
    assert {r[0] for r in changed.collect()} == {"b", "d"} and {r[0] for r in gone.collect()} == {"c"}


def test_signature_ignores_order(spark):
    a, b = spark.range(10), spark.range(10).orderBy(F.desc("id"))
    assert streams.signature(a, ["id"]) == streams.signature(b, ["id"]) != streams.signature(spark.range(9), ["id"])


def test_upsert_replays_harmlessly(spark, tmp_path):
    body = streams.upsert_latest(f"file://{tmp_path}/u", ["k"], ["ord"])
    first, second = (spark.createDataFrame(x, "k string, v string, ord long") for x in ([("a", "x", 1), ("b", "y", 1)], [("a", "z", 2)]))
    for batch in (first, second, second):
        body(batch, 0)
    assert {tuple(r) for r in sinks.read_swapped(spark, f"file://{tmp_path}/u").collect()} == {("a", "z", 2), ("b", "y", 1)}
