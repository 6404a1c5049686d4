"""Claims, retries, merged groups and the rebuilt split on small tables, edge cases included."""

import random

import pytest
from pyspark.sql import functions as F

from skerry.operators.claims import claim_in_order, claim_nearest, retry_until_no_progress
from skerry.operators.clusters import merge_groups
from skerry.plans.datasets import joi28_exclusive_best_claim, rebuild_split, targeted_draw

SCORES = "site int, proc long, run long, score double"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_claims_by_force(spark):
    rng = random.Random(4)
    data = [(s, p, r, float(rng.randrange(4))) for s in range(3) for p in range(7) for r in range(5) if rng.random() < 0.7]
    want = []
    for s in range(3):
        taken = set()
        for p in range(7):
            free = [(-x[3], x[2]) for x in data if x[0] == s and x[1] == p and x[2] not in taken]
            if free:
                taken.add(min(free)[1])
                want.append((s, p, min(free)[1]))
    got = claim_in_order(spark.createDataFrame(data, SCORES), "site", "proc", "run", "score")
    assert rows(got) == sorted(want, key=repr)


def test_claims_of_nulls_and_none(spark):
    odd = spark.createDataFrame([(None, 1, 5, 1.0), (1, None, 5, 1.0), (1, 2, None, 1.0), (1, 3, 6, None), (1, 4, 6, 0.5), (1, 4, 6, 0.5)], SCORES)
    assert rows(claim_in_order(odd, "site", "proc", "run", "score")) == [(1, 4, 6), (None, 1, 5)]
    assert rows(claim_in_order(odd.limit(0), "site", "proc", "run", "score")) == []


def test_nearest_claims_as_over_all_pairs(spark):
    rng = random.Random(9)
    place = lambda: rng.choice([None, 0.1, *(rng.randrange(-9, 9) / 4 for _ in range(9)), 5e-5])
    procs = [(rng.choice([None, 0, 1, 2]), p, place()) for p in (*range(30), 3, 5, None)] + [(8, 99, 0.0)]
    runs = [(rng.choice([None, 0, 1, 2]), r, place()) for r in (*range(26), 3, 3, 9, None)] + [(9, 98, 0.0)]
    want = []
    for site in range(3):
        taken = set()
        for p in sorted({p for s, p, _ in procs if s == site and p is not None}):
            pairs = [((float("inf"), 1) if x is None or y is None else (round(abs(x - y), 4), 0), r) for s, q, x in procs for z, r, y in runs if s == z == site and q == p and r is not None and r not in taken]
            if pairs:
                taken.add(min(pairs)[1])
                want.append((site, p, min(pairs)[1]))
    c, t = spark.createDataFrame(procs, "site int, proc long, x double"), spark.createDataFrame(runs, "site int, run long, x double")
    assert rows(claim_nearest(c, t, "site", "proc", "run", "x")) == sorted(want, key=repr) and len(want) > 15
    assert rows(claim_nearest(c.limit(0), t, "site", "proc", "run", "x")) == rows(claim_nearest(c, t.limit(0), "site", "proc", "run", "x")) == []


def test_exclusive_claim_makes_no_pairs(spark, sf):
    plan = joi28_exclusive_best_claim(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_retry_stops_without_progress(spark):
    items = spark.range(8).withColumnRenamed("id", "item")
    calls = []

    def attempt(left, k):
        calls.append(k)
        return left.filter((F.col("item") % 4 == k) & (F.col("item") > 0))

    assert rows(retry_until_no_progress(items, "item", attempt)) == sorted([(i, i % 4 or None) for i in range(8)], key=repr)
    assert calls == [1, 2, 3, 4]
    assert rows(retry_until_no_progress(items.limit(0), "item", attempt)) == []
    with pytest.raises(RuntimeError):
        retry_until_no_progress(items, "item", lambda left, k: left.limit(1), most=3)


def test_merged_groups_bridge_each_other(spark):
    df = spark.createDataFrame([(5, "a", None), (2, "a", 1), (9, None, 1), (7, None, None), (8, None, None), (4, "b", 2), (3, "c", 2), (6, "c", None)], "id long, x string, y int")
    got = merge_groups(df, "id", ["x", "y"]).select("id", "component")
    assert rows(got) == sorted([(5, 2), (2, 2), (9, 2), (7, 7), (8, 8), (4, 3), (3, 3), (6, 3)], key=repr)
    assert rows(merge_groups(df.limit(0), "id", ["x", "y"])) == []


def test_rebuilt_split_never_shares_a_sequence(spark):
    rng = random.Random(7)
    frames = [(i, rng.choice([None, *range(30)]), rng.choice(["train", "train", "val"])) for i in range(60)]
    frames += [(100 + i, 100 + i % 3, "val") for i in range(9)]
    adds = [(200 + i, rng.choice([None, 100, *range(30)]), rng.choice([1, 1, 2])) for i in range(40)] + [(0, 1, 1)]
    f, a = spark.createDataFrame(frames, "image_id long, seq long, split string"), spark.createDataFrame(adds, "image_id long, seq long, n_det long")
    got = {r.image_id: (r.split, r.why) for r in rebuild_split(f, a, target=20).collect()}
    assert len(got) == len(frames) + len(adds) - 1
    seq = {i: s for i, s, _ in frames} | {i: s for i, s, _ in adds[:-1]}
    val = {seq[i] for i, (s, _) in got.items() if s == "val"}
    assert None not in val and not val & {seq[i] for i, (s, _) in got.items() if s == "train"}
    n_val = [i for i, (s, _) in got.items() if s == "val"]
    last = max(sum(seq[i] == s for i in n_val) for s in val)
    assert 20 <= len(n_val) < 20 + last
    assert all(got[100 + i] == ("val", "held out") for i in range(9))
    for i, s, n in adds[:-1]:
        assert got[i] == ((None, "several detections") if n != 1 else (None, "held-out sequence") if s in val else ("train", "added"))
    assert rows(rebuild_split(f.limit(0), a.limit(0), target=20)) == []


def test_targeted_draw_takes_turns_and_one_a_sequence(spark):
    pool = [(1, 0, 1, 0.5), (2, 0, 1, 0.6), (3, 0, 2, 0.45), (4, 0, 3, 0.1), (5, 0, 4, 0.9), (6, 0, None, 0.55), (7, 0, None, 0.7), (8, 0, 5, None), (9, 0, 6, 0.5), (9, 1, 6, 0.2)]
    pool = spark.createDataFrame(pool, "image_id long, det_idx int, seq long, conf double")
    seen = spark.createDataFrame([(6,), (6,), (None,)], "seq long")
    assert [r[0] for r in targeted_draw(pool, seen, 4, 0.5).collect()] == [1, 3, 6, 4]
    assert [r[0] for r in targeted_draw(pool, seen, 3, 0.5, surest=True).collect()] == [4, 5, 7]
    assert targeted_draw(pool.limit(0), seen, 3, 0.5).count() == 0 and targeted_draw(pool, seen.limit(0), 50, 0.5).count() == 7
