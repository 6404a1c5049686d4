"""The pipeline's stages on a small corpus, each on its own input."""

import corpus_pipeline
from skerry.llm import minhash
from skerry.scratch import materialize
from skerry.session import table


def test_stages_decide_and_hand_on_the_documents_columns(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf), name)
        before, after = docs.select("doc_id").distinct(), out.select("doc_id").distinct()
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name != "pack_sequences":
            assert out.columns == columns
        if name == "quality_classifier":
            labels = table(spark, sf, "labels")
            good = labels.filter("quality = 1").join(before, "doc_id")
            bad = labels.filter("quality = 0").join(before, "doc_id")
            assert good.join(after, "doc_id", "left_anti").count() <= 0.03 * good.count()
            assert bad.join(after, "doc_id").count() <= 0.2 * bad.count()
        if name == "minhash_near_dedup":
            assert out.count() == after.count() <= docs.count()
            again = minhash.near_duplicates(out, words=5)
            assert again.filter("not kept").count() == 0
        if name == "mix_sources":
            assert out.groupBy("doc_id").count().filter("count > 2").count() == 0
        docs = out
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").count() == 0


def test_stages_on_nothing(spark, none, sf):
    docs = none
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
        assert docs.count() == 0


def test_stages_on_nulls_repeated_rows_and_long_texts(spark, sf):
    """Rows that share an id are documents of their own: of equal ones a stage that removes copies keeps one."""
    words = [f"word{k}" for k in range(4000)]
    rows = [(1, " ".join(words[:60]), "en", "a", 1), (1, " ".join(words[:60]), "en", "a", 1), (1, " ".join(words[100:160]), "en", "b", 1), (2, " ".join(words[:60]), None, None, None)]
    rows += [(3, None, None, None, None), (None, " ".join(words[:60]), "en", "a", 1), (4, "", "en", "", 0), (5, " ".join(words), "en", "a", 1), (6, "\n \n", None, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    left = materialize(stages["minhash_near_dedup"](spark, docs, sf), "left")
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:8]) for r in left.collect())
    assert got == [("1", "word0 wo"), ("1", "word100 "), ("3", ""), ("4", ""), ("5", "word0 wo"), ("6", "\n \n"), ("None", "word0 wo")]
    lines = materialize(stages["line_dedup"](spark, docs, sf), "left")
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:8]) for r in lines.collect()) == got
    mixed = materialize(stages["mix_sources"](spark, docs, sf), "left")
    assert mixed.groupBy("doc_id", "text", "source").count().filter("count > 4").count() == 0 and mixed.count() > 0
    packed = stages["pack_sequences"](spark, docs, sf)
    assert packed.count() == len(rows) + packed.filter("piece > 0").count()
    assert stages["quality_classifier"](spark, docs, sf).columns == docs.columns
