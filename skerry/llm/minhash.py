"""Near-duplicate documents by fast similarity sketching.

A sketch has ``SIZE`` coordinates.  In round i of the first SIZE rounds every
element of a set is hashed into a bin; in round SIZE + i every element goes to
bin i.  A bin keeps the element of the earliest round, and in it the smallest
hash.  Rounds end once every bin is filled, which the second half guarantees, so
a large set needs one or two rounds and a tiny one still fills every coordinate;
two sets agree in a coordinate with the probability of their similarity, with
concentration bounds as for independent hashes.

Coordinates are banded; documents that share a band are candidates, and a link
is confirmed on the full sets.  A band is a fixed draw of 7 coordinates; of the
48 bands a pair at similarity 0.8 shares none with a probability of about 2e-5,
and one at 0.3 shares any with a probability of 0.01.

Scale: equal sets collapse to one representative first.  A band's members are
compared with its leader, linked ones become one component, and only members
of bands that still hold several components go on, so a band with a million near
copies costs a million comparisons and not their square.  Leaders come from
map-side combined aggregates and skew-splittable joins; no band is ever gathered
in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import discard, materialize
from .linking import link_buckets, shared_buckets

BANDS, ROWS, SIZE = 48, 7, 256
CACHE_WORDS = 300_000
#: Classes of shingles whose parities bound the difference of two sets.
CLASSES = 1024

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


BAND_COORDINATES = np.stack([np.random.default_rng(k).permutation(SIZE)[:ROWS] for k in range(BANDS)])
ROUND_KEYS = np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * _GOLD


class Shingler:
    """Distinct word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: bytes) -> np.ndarray:
        parts = text.lower().split()
        known = self.known
        if len(known) >= CACHE_WORDS:
            known.clear()
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        if len(h) <= self.words:
            out = np.full(min(1, len(h)), len(h), np.uint64)
            for k in range(len(h)):
                out = mix(out * _GOLD + h[k : k + 1])
            return out
        out = np.full(len(h) - self.words + 1, self.words, np.uint64)
        for k in range(self.words):
            out = mix(out * _GOLD + h[k : k + len(out)])
        return np.unique(out)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The coordinates of a non-empty set of 64-bit hashes."""
    size = SIZE
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(size, top)
    for i in range(2 * size):
        h = mix(elements ^ ROUND_KEYS[i])
        value = (h >> np.uint64(16)) | (np.uint64(i) << np.uint64(48))
        if i < size:
            np.minimum.at(out, ((h & np.uint64(0xFFFF)) * np.uint64(size) >> np.uint64(16)).astype(np.int64), value)
        else:
            out[i - size] = min(out[i - size], value.min())
        if i % 4 == 0 or len(elements) > size or i >= size:
            if (out != top).all():
                break
    return out


def sketches(df: DataFrame, words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: set size, a 128-bit hash of the set, and bands."""
    schema = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(c, T.LongType()) for c in ("n", "h1", "h2")], T.StructField("bands", T.ArrayType(T.LongType()))])
    salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for b in batches:
            n, hashes, bands = [], [], []
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                s = shingles(t.encode()) if t else np.empty(0, np.uint64)
                n.append(len(s))
                if not len(s):
                    hashes.append((0, 0))
                    bands.append(np.empty(0, np.int64))
                    continue
                d = xxhash.xxh3_128_digest(s.tobytes())
                hashes.append(np.frombuffer(d, np.int64))
                c = sketch(s)
                key = salt.copy()
                for k in range(ROWS):
                    key = mix(key * _GOLD + c[BAND_COORDINATES[:, k]])
                bands.append(key.view(np.int64))
            h = np.array(hashes, np.int64).reshape(-1, 2)
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            at = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=schema.names)

    return df.select(F.col(id_col).cast("long"), text).mapInArrow(run, schema)


def shingle_sets(df: DataFrame, words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its full set of shingle hashes, as an array, and the parities of their ``CLASSES`` as ``q0``, ``q1``, ..."""
    bits = [f"q{k}" for k in range(CLASSES // 64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                sets = [shingles(t.encode()).view(np.int64) if (t := part.column(1)[i].as_py()) else np.empty(0, np.int64) for i in range(part.num_rows)]
                sizes, flat = [len(x) for x in sets], np.concatenate(sets)
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                cell = np.repeat(np.arange(len(sets)) * CLASSES, sizes) + (flat & (CLASSES - 1))
                odd = np.packbits((np.bincount(cell, minlength=CLASSES * len(sets)) & 1).astype(np.uint8)).view(np.int64).reshape(len(sets), -1)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), *map(pa.array, odd.T)], names=["id", "set", *bits])

    return df.select(F.col(id_col).cast("long"), text).mapInArrow(run, "id long, set array<long>, " + ", ".join(f"{x} long" for x in bits))


def _alike(percent: int):
    both = F.size(F.array_intersect("sx", "sy"))
    return 100 * both >= percent * (F.size("sx") + F.size("sy") - both)


def _near(percent: int):
    """Whether set sizes, shingles that occur in one set only, and parities allow a link; never wrong about a link.

    Of a set's shingles ``own`` occur in no other candidate, so no intersection
    can be larger than what the smaller rest of the two sets leaves.  Each class
    whose parity differs holds a shingle of one set only, so the sets differ in
    as many shingles at least.
    """

    def allowed(x: str, y: str) -> Column:
        small, large = F.least(f"{x}n", f"{y}n"), F.greatest(f"{x}n", f"{y}n")
        apart = sum((F.bit_count(F.col(f"{x}q{k}").bitwiseXOR(F.col(f"{y}q{k}"))) for k in range(CLASSES // 64)), F.lit(0))
        both = F.least(F.col(f"{x}n") - F.col(f"{x}own"), F.col(f"{y}n") - F.col(f"{y}own"))
        return (100 * small >= percent * large) & (100 * both >= percent * (small + large - both)) & ((100 + percent) * (small + large - apart) >= 2 * percent * (small + large))

    return allowed


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: id, ``n_shingles``, ``component_id``, ``kept``.

    Texts are lower-cased in A-Z and split at ASCII white space; a set holds the
    distinct shingles of ``words`` words, or the whole sequence where there are
    fewer.  Two documents are linked where ``100 * intersection >= percent *
    union``; ``component_id`` is the smallest id that links reach, and ``kept``
    marks its document.  Null, empty and blank texts are linked with nothing;
    rows of one id count as linked; a null id stays alone and is kept; an empty
    table stays empty.  Only the two columns are read.  Ids have to be whole numbers.
    ``percent`` below 80 needs other bands.
    """
    if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} has to be a whole number")
    known = materialize(sketches(df, words, id_col, text), "sketch")
    real = known.filter("n > 0 and id is not null")
    first = real.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep"))
    member = materialize(real.select("id", "n", "h1", "h2").join(first, ["n", "h1", "h2"]).select("id", "n", "rep"), "member")
    reps = member.select(F.col("rep").alias("id")).distinct()
    info = real.join(reps, "id", "left_semi").dropDuplicates(["id"])
    # Rows of one id with different texts: their classes hold together.
    same = member.filter("id <> rep").select("id", "rep").join(reps, "id", "left_semi").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    bands = materialize(info.select("id", F.explode("bands").alias("band")), "band")
    alone = materialize(known.filter("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component_id")), "alone", drop=(known,))
    bucket = shared_buckets(bands)
    near = materialize(bucket.select("id").distinct(), "near")
    sets = materialize(shingle_sets(df.join(near.select(F.col("id").alias(id_col)), id_col, "left_semi").dropDuplicates([id_col]), words, id_col, text), "sets", drop=(bands,))

    def confirm(pairs: DataFrame, whole: DataFrame) -> DataFrame:
        side = lambda s: whole.select(F.col("id").alias(s), F.col("set").alias(f"s{s}"))
        return pairs.join(side("x"), "x").join(side("y"), "y").filter(_alike(percent)).select(F.col("x").alias("u"), F.col("y").alias("v"))

    once = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("id").alias("id")).filter("c = 1")
    own = once.groupBy("id").agg(F.count("*").alias("own"))
    info = sets.withColumn("n", F.size("set").cast("long")).drop("set").join(own, "id", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    info = materialize(info, "info")
    label = link_buckets(bucket, info, _near(percent), confirm, sets.select("id", "set"), same)
    discard(info, sets, near)
    found = member.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component_id"))
    return found.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
