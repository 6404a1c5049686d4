"""Components of verified links among rows that share a bucket.

Buckets of few ids compare all their pairs.  In larger ones every id meets a few
leaders, drawn by a hash from some of its buckets; what is linked becomes one
component.  Only buckets that then hold several components go on: their strays
meet other leaders, and what is still apart after that meets every member of
another component that ``near`` allows; at once, if those are few a row.  Links inside a component need no check,
so a bucket of n rows that are all alike costs a few n comparisons.  Every pair of
a bucket is either inside one component or compared, so no link is lost.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import components
from ..scratch import discard, materialize

#: Ids of a bucket whose pairs are all compared at once.
SMALL = 16
#: Rounds of drawn leaders; leaders of a bucket, buckets of an id and partners of an id in a round.
ROUNDS, LEADERS, TRIED, PARTNERS = 2, 8, 3, 4
#: Pairs for each row of the buckets still open, up to which all are compared without another round of leaders.
DIRECT = 512
#: Bands of an id that are looked at so that a pair is made once.
FIRST = 64


def shared_buckets(members: DataFrame) -> DataFrame:
    """``(band, id)`` rows -> those of bands with two ids or more, with ``many``, the number of their rows; written out.

    Of bands with the same members one is enough: like rows share many.  They are
    told by their smallest and largest id, their number and two sums of hashes.
    """
    piece = lambda seed: F.try_sum(F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 24))
    most = members.groupBy("band").agg(F.min("id").alias("__lo"), F.max("id").alias("__hi"), F.count("*").alias("many"), piece(1).alias("__a"), piece(2).alias("__b")).filter("__lo <> __hi")
    # A sum that overflows is null: such a band stands for itself.
    own = F.when(F.col("__a").isNull() | F.col("__b").isNull(), F.col("band"))
    most = most.groupBy("__lo", "__hi", "many", "__a", "__b", own.alias("__own")).agg(F.min("band").alias("band")).select("band", "many")
    return materialize(members.join(most, "band"), "bucket")


def _flat(df: DataFrame) -> DataFrame:
    """A row for each band of each id."""
    return df.select(*[c for c in df.columns if c != "bands"], F.inline("bands"))


def _side(df: DataFrame, s: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{s}{c}") for c in df.columns])


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (deleted) with the components that ``links`` connect as one; only those are walked anew."""
    of = lambda s: label.select(F.col("id").alias(s), F.col("component").alias(f"{s}c"))
    between = links.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("uc", "u").alias("u"), F.coalesce("vc", "v").alias("v"))
    between = materialize(between.filter("u <> v").distinct(), "link")
    moved = components(between)
    to = moved.select(F.col("id").alias("component"), F.col("component").alias("to"))
    out = label.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return materialize(out.union(moved.join(label, "id", "left_anti")), "label", drop=(label, between, moved))


def link_buckets(bucket: DataFrame, info: DataFrame, near: Callable[[str, str], Column], confirm: Callable[[DataFrame, DataFrame], DataFrame], whole: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` of every id with a link.

    ``bucket`` comes from ``shared_buckets`` and is deleted once it has been read.
    ``info`` has one row an id; ``near`` gets two prefixes of its columns and says
    whether a pair could be linked.  ``confirm`` takes ``(x, y)`` pairs and a table
    like ``whole``, which has what decides of each id, and returns the linked pairs
    as ``(u, v)``.  ``links`` are links known before.
    """
    # An id is one row with all its bands; a label is joined once an id, and rows of bands only exist between exchanges.
    held = bucket.groupBy("id").agg(F.collect_list(F.struct("band", "many")).alias("bands"))
    rows = materialize(held.join(info, "id"), "wide", drop=(bucket,))
    allowed = near("x_", "y_") & (F.col("x_band") == F.col("y_band"))
    of_size = lambda is_large: rows.withColumn("bands", F.filter("bands", lambda b: (b["many"] > SMALL) == F.lit(is_large))).filter(F.size("bands") > 0)
    few, large = _flat(of_size(False)), of_size(True)
    pairs = _side(few, "x_").join(_side(few, "y_"), (F.col("x_id") < F.col("y_id")) & allowed).select(F.col("x_id").alias("x"), F.col("y_id").alias("y"))

    def draw(strays: DataFrame, members: DataFrame, turn: int) -> DataFrame:
        """Some partners of each stray among the leaders of some of its bands."""
        dealt = F.array_sort(F.transform("bands", lambda b: F.struct(F.xxhash64(b["band"], F.lit(turn)).alias("h"), b["band"].alias("band"), b["many"].alias("many"))))
        tried = _flat(strays.withColumn("bands", F.slice(dealt, 1, TRIED))).drop("h")
        lead = _flat(members).filter(F.pmod(F.xxhash64("id", F.lit(turn)), F.col("many")) < LEADERS)
        met = _side(tried, "x_").join(_side(lead, "y_"), (F.col("x_tag") != F.col("y_tag")) & allowed).select(F.col("x_id").alias("x"), F.col("y_id").alias("y")).distinct()
        return met.withColumn("__k", F.row_number().over(Window.partitionBy("x").orderBy(F.xxhash64("x", "y", F.lit(turn)), "y"))).filter(F.col("__k") <= PARTNERS).select("x", "y")

    alone = large.withColumn("tag", F.col("id"))
    pairs = pairs.union(draw(alone, alone, 0)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    found = confirm(pairs, whole)
    found = materialize(found if links is None else found.union(links), "link")
    label = components(found)
    discard(found)
    some = None
    for turn in range(1, ROUNDS + 1):
        tagged = large.join(label, "id", "left").withColumn("tag", F.coalesce("component", "id")).drop("component")
        band = _flat(tagged.select("id", "tag", "bands"))
        open_ = band.groupBy("band").agg(F.min("tag").alias("lo"), F.max("tag").alias("hi"), F.min_by("tag", F.xxhash64("id", F.lit(turn))).alias("main")).filter("lo <> hi").select("band", "main")
        still = band.select("id", "band", "many").join(open_, "band").groupBy("id").agg(F.collect_list(F.struct("band", "many", "main")).alias("bands"))
        # The bands' tags were decided by the label before: those of `large` are written anew.
        mixed = materialize(tagged.drop("bands").join(still, "id"), "mixed", drop=(rows,))
        discard(large)
        strays = F.filter("bands", lambda b: b["main"] != F.col("tag"))
        open_rows, meets = mixed.agg(F.sum(F.size("bands")), F.sum(F.aggregate(strays, F.lit(0.0), lambda n, b: n + b["many"]))).first()
        if not open_rows:
            large = mixed
            break
        last = turn == ROUNDS or meets <= DIRECT * open_rows
        if some is None and not last:
            some = materialize(whole.join(mixed.select("id"), "id", "left_semi"), "some")
        if not last:
            more = confirm(draw(mixed.withColumn("bands", strays).filter(F.size("bands") > 0), mixed, turn), some)
        else:
            # A pair is made in the smallest band that both hold among their first FIRST ones; where there is none, in all they share.
            first = F.slice(F.array_sort(F.transform("bands", lambda b: b["band"])), 1, FIRST)
            known = mixed.withColumn("first", first)
            y = _side(_flat(known), "y_")
            x = _side(_flat(known).filter("tag <> main"), "x_")
            apart = (F.col("x_tag") != F.col("y_tag")) & ((F.col("y_tag") == F.col("y_main")) | (F.col("y_id") < F.col("x_id")))
            once = F.coalesce(F.array_min(F.array_intersect("x_first", "y_first")) == F.col("x_band"), F.lit(True))
            more = confirm(x.join(y, apart & allowed & once).select(F.col("x_id").alias("x"), F.col("y_id").alias("y")).distinct(), whole if some is None else some)
        label = _joined(label, more)
        gc.collect()  # frames in cycles hold plans in the driver's JVM
        large = mixed.drop("tag").withColumn("bands", F.transform("bands", lambda b: F.struct(b["band"].alias("band"), b["many"].alias("many"))))
        large._scratch = mixed._scratch
        if last:
            break
    discard(rows, large, *(() if some is None else (some,)))
    return label
