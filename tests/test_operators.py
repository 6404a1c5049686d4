"""Operators and functions against brute force and hand-counted cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.functions import geo, stats, text
from skerry.operators import boxes, clusters, dedup, graph, ranking, vectors
from skerry.sources import manifests


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(5, 3), (3, 9), (7, 8), (8, 7), (2, 2)], [(0, k) for k in range(1, 50)]])
def test_components(spark, edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_rank_in_cells_is_gapless_for_a_hot_and_a_null_key(spark):
    rnd = random.Random(1)
    data = [(None if k % 7 == 0 else "hot" if k % 3 else str(k % 5), k, rnd.randint(0, 9)) for k in range(300)]
    df = spark.createDataFrame(data, "key string, id long, w long").withColumn("cell", (F.col("id") / 10).cast("int"))
    got = ranking.rank_in_cells(df, ["key"], "cell", ["id"], "r").collect()
    sums = {(r["key"], r["id"]): r["s"] for r in ranking.rank_in_cells(df, ["key"], "cell", ["id"], "s", weight="w").collect()}
    for key in {r["key"] for r in got}:
        mine = sorted((r["id"], r["r"], r["w"]) for r in got if r["key"] == key)
        assert [m[1] for m in mine] == list(range(len(mine)))
        total = 0
        for i, _, w in mine:
            assert sums[key, i] == total
            total += w


def test_wilson_known_values(spark):
    for hits, n in ((0, 0), (0, 100), (3, 400), (1, 1), (0, 1), (50, 100)):
        lo, hi = (one(spark, c) for c in stats.wilson(F.lit(hits), F.lit(n)))
        if not n:
            assert lo is None or lo == 0.0
            continue
        p, z = hits / n, stats.Z95
        mid, half = (p + z * z / 2 / n) / (1 + z * z / n), z / (1 + z * z / n) * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)
        assert lo == pytest.approx(max(0, mid - half)) and hi == pytest.approx(min(1, mid + half))


def test_exact_binomial(spark):
    for k, n in ((0, 0), (0, 1), (1, 5), (5, 10), (2, 12)):
        want = min(1.0, 2 * sum(math.comb(n, i) for i in range(min(k, n - k) + 1)) / 2**n)
        assert one(spark, stats.binomial_two_sided(F.lit(k), F.lit(n))) == pytest.approx(want)


def test_bands_are_half_open_and_exact_at_edges(spark):
    edges = [k / 10 for k in range(11)]
    got = [r[0] for r in spark.createDataFrame([(e,) for e in edges], "p double").select(stats.band(F.col("p"))).collect()]
    assert got == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]


def test_names_and_cells(spark):
    assert one(spark, text.sanitise(F.lit("_Trinidad & Tobago! "))) == "Trinidad_and_Tobago"
    got = one(spark, text.parse_cell(F.lit("S_America_-70_-20.5_-65_-15")))
    assert tuple(got) == ("S_America", -70.0, -20.5, -65.0, -15.0)
    assert one(spark, text.parse_cell(F.lit("no cell"))) is None
    assert one(spark, text.parent_region(F.lit("E_10_45_15_50"))) == "E"
    assert one(spark, text.wrap_to_signed(F.lit("18446744073709551615").cast("decimal(20,0)"))) == -1
    assert one(spark, text.last_answer(F.lit("No... then Yes."))) == "yes"


def test_geometry(spark):
    square = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0))])
    assert one(spark, geo.in_polygon(F.lit(1.0), F.lit(1.0), square)) and not one(spark, geo.in_polygon(F.lit(3.0), F.lit(1.0), square))
    lits = lambda *v: tuple(F.lit(float(x)) for x in v)
    assert one(spark, geo.iou(lits(0, 0, 2, 2), lits(2, 0, 4, 2))) == 0
    assert one(spark, geo.iou(lits(0, 0, 2, 2), lits(1, 0, 3, 2))) == pytest.approx(1 / 3)
    assert one(spark, geo.boxes_meet(lits(0, 0, 1, 1), lits(1, 1, 2, 2)))
    x, y = geo.mercator_tile(F.lit(13.4), F.lit(52.5), 14)
    assert (one(spark, x), one(spark, y)) == (8801, 5374)
    assert one(spark, geo.box_area_m2(*lits(-180, -90, 180, 90))) == pytest.approx(4 * math.pi * geo.EARTH_M**2)


def test_latest_with_retraction(spark):
    df = spark.createDataFrame([("a", "dog", 1), ("a", None, 2), ("b", "dog", 1), ("b", "cat", 3), ("c", None, 1), ("c", "dog", 2)], "k string, verdict string, ord long")
    got = {r["k"]: r["verdict"] for r in dedup.latest(df, ["k"], ["ord"], "verdict").collect()}
    assert got == {"b": "cat", "c": "dog"}


def test_twins_collapse_by_box_not_by_image(spark):
    df = spark.createDataFrame([(111, 0, "E", "b"), (111, 0, "S", "a"), (111, 1, "S", "a")], "image_id long, det_idx int, cell string, drive string")
    assert {tuple(r) for r in dedup.collapse_twins(df).collect()} == {(111, 0, "S", "a"), (111, 1, "S", "a")}


def test_greedy_match_against_brute_force(spark):
    rnd = random.Random(2)
    box = lambda: (x := rnd.randint(0, 8), y := rnd.randint(0, 8), x + rnd.randint(1, 6), y + rnd.randint(1, 6))
    pred = [(i, k, rnd.random(), *map(float, box())) for i in range(12) for k in range(rnd.randint(0, 4))]
    truth = [(i, k, *map(float, box())) for i in range(14) for k in range(rnd.randint(0, 4))]

    def over(a, b):
        w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)

    want = set()
    for i in {p[0] for p in pred} | {t[0] for t in truth}:
        free = {t[1]: t[2:] for t in truth if t[0] == i}
        for p in sorted((p for p in pred if p[0] == i), key=lambda p: (-p[2], p[1])):
            best = max(free, key=lambda k: (over(p[3:], free[k]), -k), default=None)
            if best is not None and over(p[3:], free[best]) >= 0.3:
                want.add((i, p[1], best))
                free.pop(best)
            else:
                want.add((i, p[1], None))
        want |= {(i, None, k) for k in free}
    got = boxes.greedy_match(spark.createDataFrame(pred, "image_id long, idx int, conf double, x1 double, y1 double, x2 double, y2 double"), spark.createDataFrame(truth, "image_id long, idx int, x1 double, y1 double, x2 double, y2 double"), 0.3)
    assert {tuple(r)[:3] for r in got.collect()} == want


def test_greedy_hamming_follows_the_order(spark):
    df = spark.createDataFrame([("s", 1, 0), ("s", 2, 1), ("s", 3, 3), ("s", 4, 7), ("t", 1, 7)], "g string, o long, h long")
    assert {(r[0], r[1]): r[2] for r in clusters.greedy_hamming(df, "g", "o", "h", 1).collect()} == {("s", 1): 0, ("s", 2): 0, ("s", 3): 1, ("s", 4): 1, ("t", 1): 0}


def test_similar_pairs_empty(spark):
    assert vectors.similar_pairs(spark.createDataFrame([], "vec_id long, embedding array<float>"), 0.5).count() == 0


def test_box_matching_with_a_side_without_rows(spark):
    pred = spark.createDataFrame([(1, 0, 0.9, 0.0, 0.0, 2.0, 2.0), (2, 0, 0.5, 0.0, 0.0, 1.0, 1.0)], "image_id long, idx int, conf double, x1 double, y1 double, x2 double, y2 double")
    truth = pred.drop("conf")
    got = lambda p, t: {(r["image_id"], r["pred_idx"], r["truth_idx"]) for r in boxes.greedy_match(p, t).collect()}
    assert got(pred, truth) == {(1, 0, 0), (2, 0, 0)}
    assert got(pred, truth.limit(0)) == {(1, 0, None), (2, 0, None)}
    assert got(pred.limit(0), truth) == {(1, None, 0), (2, None, 0)}
    assert got(pred, truth.filter("image_id = 1")) == {(1, 0, 0), (2, 0, None)}


def test_box_matching_of_many_images_at_once(spark, monkeypatch):
    rnd = random.Random(5)
    box = lambda: (x := rnd.choice([None, *map(float, range(8))]), 0.0, (x or 0.0) + rnd.randint(1, 6), 4.0)
    ids = [None, -3, *range(60)]
    pred = [(i, k, rnd.choice([None, 0.25, 0.5, 0.75]), *box()) for i in ids for k in range(rnd.choice([0, 1, 5, 40]))]
    truth = [(i, k, *box()) for i in ids for k in range(rnd.choice([0, 1, 5, 40]))]

    def over(a, b):
        if None in a or None in b:
            return 0.0
        w = max(0, min(a[2], b[2]) - max(a[0], b[0]))
        return w * 4 / ((a[2] - a[0]) * 4 + (b[2] - b[0]) * 4 - w * 4)

    want = []
    for i in ids:
        free = {t[1]: t[2:] for t in truth if t[0] == i}
        for p in sorted((p for p in pred if p[0] == i), key=lambda p: (-(p[2] or 0), p[1])):
            best = max(free, key=lambda k: (over(p[3:], free[k]), -k), default=None)
            found = best is not None and over(p[3:], free[best]) >= 0.5
            want.append((i, p[1], best, round(over(p[3:], free.pop(best)), 9)) if found else (i, p[1], None, None))
        want += [(i, None, k, None) for k in free]
    p = spark.createDataFrame(pred, "image_id long, idx int, conf double, x1 double, y1 double, x2 double, y2 double")
    t = spark.createDataFrame(truth, "image_id long, idx int, x1 double, y1 double, x2 double, y2 double")
    try:
        for rows in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            df = boxes.greedy_match(p, t)
            assert "CoGroup" not in df._jdf.queryExecution().optimizedPlan().toString()  # no call of Python an image
            assert sorted(((*r[:3], r[3] and round(r[3], 9)) for r in df.collect()), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    image, b = np.repeat([0, 1, 2], [9, 14, 3]), np.array([[x % 5, 0, x % 5 + 3, 4] for x in range(26)], float)
    is_truth = np.array([0] * 4 + [1] * 5 + [0] * 6 + [1] * 8 + [0] * 3, bool)
    whole = boxes.match_images(image, is_truth, b, 0.4)
    monkeypatch.setattr(boxes, "PAIRS", 6)
    for x, y in zip(whole, boxes.match_images(image, is_truth, b, 0.4), strict=True):
        np.testing.assert_array_equal(x, y)


def test_ranks_follow_text_keys(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "", None, "ab", "é", "z", "aa"]], "k string")
    got = [r["k"] for r in manifests.with_row_index(df, ["k"]).orderBy("row_index").collect()]
    assert got == [r["k"] for r in df.orderBy("k").collect()]
