"""Quality, rules and language: held-out accuracy and brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.llm import langid, quality, queries, rules
from skerry.session import table

BIG = "/root/testdata/sf0.01"


def test_quality_holds_out_and_is_right(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_rule_ensemble_quality"](spark, BIG).collect()}
    assert len(got) == table(spark, BIG, "documents").count()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, BIG, "labels").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for k, r in got.items())
    held = [(got[k]["predicted"], y) for k, y in labels.items() if got[k]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.95


def test_compiled_rules_equal_their_numpy_form(spark):
    rng = np.random.default_rng(0)
    x = rng.random((300, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.7)).astype(float)
    model = quality.fit_rules(x, y, ["a", "b", "c"])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = [r[0] for r in df.select(model.score()).collect()]
    want = model.bias + sum(r.weight * r.holds(x) for r in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-want)))
    assert ((np.array(got) > 0.5) == y).mean() > 0.97 and len(model.rules) < 150


def test_quality_of_edges(spark, edge, none):
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(5)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(edge, labels)
    assert quality.classify(edge.withColumn("score", F.lit("x")), model).filter("score between 0 and 1").count() == edge.count()
    assert quality.classify(none, quality.fit(none, labels.limit(0))).count() == 0


def base_by_force(text):
    import re

    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(i, i + 8))
    n = len(covered)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), n, len(w) < 20 or 100 * n > 30 * len(w)


def test_base_rules_by_force(spark, edge, edge_texts):
    texts = [*edge_texts, "a b c d e f g h " * 4 + "x y z", "x " + "a b c d e f g h i " * 2 + "tail " * 40, " ".join(map(str, range(50)))]
    df = spark.createDataFrame([(k, t, -1) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    for r in rules.measure(df).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base_by_force(texts[r["doc_id"]])


def test_ratio_is_the_mean_over_grams(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, "c c"), (2, None)], "doc_id long, text string")
    buckets = 1 << 12
    ratios = rules.fit(df, spark.createDataFrame([(0,)], "doc_id long"), buckets=buckets)
    word = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in "abc"], "w string").select("w", F.xxhash64("w")).collect()}
    pair = {r[0] + r[1]: r[2] for r in spark.createDataFrame([tuple(x) for x in ("ab", "ba", "cc")], "a string, b string").select("a", "b", F.xxhash64(F.xxhash64("a"), F.xxhash64("b"))).collect()}
    g = [[word[x] % 2048 for x in "aba"] + [pair[x] % 2048 + 2048 for x in ("ab", "ba")], [word["c"] % 2048] * 2 + [pair["cc"] % 2048 + 2048]]
    good, raw = Counter(g[0]), Counter(g[0]) + Counter(g[1])
    want = lambda b: math.log(good[b] + rules.PRIOR) - math.log(raw[b] * 5 / 8 + rules.PRIOR)
    got = {r["doc_id"]: r["llr"] for r in rules.quality_rules(df, ratios).collect()}
    assert got[0] == pytest.approx(sum(map(want, g[0])) / 5, abs=1e-5) and got[1] == pytest.approx(sum(map(want, g[1])) / 3, abs=1e-5) and got[2] == 0


def test_rules_judge_labelled_documents_that_they_did_not_learn_from(spark):
    docs, labels = table(spark, BIG, "documents").select("doc_id", "text"), table(spark, BIG, "labels")
    ratios = rules.fit(docs, rules.trusted_sample(labels.filter("doc_id % 2 = 0")))
    got = rules.quality_rules(docs, ratios).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    good, bad = got.filter("quality = 1 and toxic = 0"), got.filter("quality = 0")
    assert good.count() > 100 and bad.count() > 15
    assert good.filter("kept").count() >= 0.97 * good.count() and bad.filter("kept").count() < 0.2 * bad.count()


def test_rules_of_nothing_and_repeated_rows(spark, none, edge):
    ids = spark.createDataFrame([(5,), (5,)], "doc_id long")
    assert rules.quality_rules(none, rules.fit(none, ids)).count() == 0
    got = rules.quality_rules(edge.union(edge), rules.fit(edge.union(edge), ids)).groupBy("doc_id").agg(F.countDistinct("llr", "kept").alias("n"), F.count("*").alias("c")).collect()
    assert all((r["n"], r["c"]) == (1, 2) for r in got)


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op7_byte_cnn_language"](spark, BIG).join(table(spark, BIG, "documents"), "doc_id").select("doc_id", "held_out", "lang", "lang_pred", "score").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_edges(spark, edge, edge_texts, none):
    net = langid.fit(edge, per_lang=5, per_doc=3)
    for r in langid.identify(edge.withColumn("score", F.lit(1)), net).collect():
        t = edge_texts[r["doc_id"]] or ""
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, t)))
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.identify(edge, None).collect()} == {"und"}


def test_language_of_repeated_rows(spark, edge):
    net = langid.fit(edge.union(edge), per_lang=5, per_doc=3)
    got = langid.identify(edge.union(edge).withColumn("lang_pred", F.lit("x")), net).collect()
    seen = {}
    for r in got:
        assert seen.setdefault(r["doc_id"], (r["lang_pred"], r["score"])) == (r["lang_pred"], r["score"])
    assert len(got) == 2 * len(seen)
