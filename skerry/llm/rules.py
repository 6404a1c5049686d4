"""Quality rules and a hashed n-gram likelihood ratio, natively in SQL functions.

Base rules measure each whole text: characters in words, symbols, duplicate
lines, and words inside 8-word windows that occur twice or more.  On top, two
multinomials over ``buckets`` hashed word 1- and 2-grams are counted over all
documents, one for the trusted target and one for the raw corpus; a document's
score is the mean log ratio of its n-grams (natural units per n-gram).  A fixed
threshold decides every document, so reruns and any partitioning agree.

Scale: the raw counts come from one pass over all texts with map-side combining
and shuffle at most ``buckets`` rows a task; they are ``buckets`` numbers on the
driver, whatever the corpus.  The target is a bounded sample of trusted ids, which
is broadcast at any size.  Scoring is a scan without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, literal_array, words

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
BUCKETS, PRIOR = 65_536, 3.0
#: Documents that the trusted target is learnt from, at most.
MAX_TRUSTED = 20_000
#: Mean log ratio a document needs, in natural units per n-gram.
THRESHOLD = -0.2


def _joined(hashes: Column, step: int) -> Column:
    """A hash of every element with the one ``step`` places on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _repeat_words(windows: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes."""

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(a: Column) -> Column:
            twice = lambda x, k: ((k > 0) & (F.get(a, k - 1)["h"] == x["h"])) | F.coalesce(F.get(a, k + 1)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(a, twice), lambda x: x["i"]))

        gaps = let(let(pairs, places), lambda p: F.transform(p, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(p, k - 1)))))
        return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__hashes`` of the text's words in order and ``__pairs`` of neighbouring ones."""
    df = df.withColumn("__words", words(F.col(text)))
    return df.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w))).withColumn("__pairs", _joined(F.col("__hashes"), 1))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base columns, ``__hashes`` and ``__pairs`` (see ``_hashed``).

    Null and empty texts have no words and fail the base rules.  Columns named
    like the new ones are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.ltrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    df = _hashed(df, text).withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(body, "[^" + SYMBOLS + "]+", "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    ).drop("__words")
    # Hashes of windows of 8 words from those of 2 and 4.
    df = df.withColumn("__four", _joined(F.col("__pairs"), 2)).withColumn("__eight", _joined(F.col("__four"), 4))
    df = df.withColumn("n_repeat_words", _repeat_words(F.col("__eight")).cast("long")).drop("__four", "__eight")
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """How often each bucket occurs: words in the lower half, pairs of neighbouring words in the upper; ``buckets`` numbers."""
    half = buckets // 2
    seen = _hashed(df.select(text), text).select(F.explode(F.concat(F.transform("__hashes", lambda h: F.pmod(h, F.lit(half))), F.transform("__pairs", lambda h: F.pmod(h, F.lit(half)) + half))).alias("b"))
    out = [0] * buckets
    for r in seen.groupBy("b").agg(F.count("*").alias("n")).collect():  # `buckets` rows at most
        out[r[0]] = r[1]
    return out


def fit(df: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS) -> list[float]:
    """The log ratio of each bucket: raw counts from every row of ``df``, the target's from the rows whose ``key`` is in ``trusted``.

    ``trusted`` has one column ``key`` and a bounded number of rows (see
    ``trusted_sample``): it is broadcast, so texts are never shuffled.  The target
    is smoothed towards the raw corpus with a weight of ``PRIOR`` n-grams a bucket,
    so that what was seen a few times says little.  Without trusted rows (or any
    rows) all ratios are 0; repeated rows count each time.
    """
    raw = counts(df, text, buckets)
    good = counts(df.join(F.broadcast(trusted.distinct()), key, "left_semi"), text, buckets)
    if not sum(good):
        return [0.0] * buckets
    share = sum(good) / sum(raw)
    return [round(math.log(g + PRIOR) - math.log(r * share + PRIOR), 6) for g, r in zip(good, raw, strict=True)]


def trusted_sample(labels: DataFrame, most: int = MAX_TRUSTED, key: str = "doc_id") -> DataFrame:
    """At most ``most`` ids that all their labels call good and not toxic: those with the smallest hashes."""
    good = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good")).filter("good")
    return good.select(key).orderBy(F.xxhash64(key), key).limit(most)


def score(ratios: list[float]) -> Column:
    """Mean log ratio of a text's n-grams, from ``__hashes`` and ``__pairs``; 0 for a text without words."""
    half = len(ratios) // 2

    def total(hashes: str, part: list[float]) -> Column:
        table = literal_array(part, "double")
        return F.aggregate(hashes, F.lit(0.0), lambda acc, h: acc + F.get(table, F.pmod(h, F.lit(half)).cast("int")))

    both = total("__hashes", ratios[:half]) + total("__pairs", ratios[half:])
    return F.when(F.size("__hashes") == 0, F.lit(0.0)).otherwise(both / (2 * F.size("__hashes") - 1))


def quality_rules(df: DataFrame, ratios: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds the base columns, ``llr`` and ``kept``: base rules passed and ``llr >= threshold``.

    Every row is judged by its own text: repeated rows get the same verdict, an
    empty table stays empty, columns named like the new ones are replaced.
    """
    out = measure(df, text).withColumn("llr", F.round(score(ratios), 9))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).drop("__hashes", "__pairs")
