"""Mixing overlapping sources to target weights as a min-cost flow.

Documents are summed up by membership pattern (the set of sources that a
document belongs to).  Every pattern can send its tokens once at the cost of a
first reading, once more at the dearer cost of a second reading, and so on: the
cost of repetition is convex, so flow never repeats a token while a fresh one
can reach the same quota.  Capacity is routed from patterns to source quotas by
successive shortest paths.  Each pattern's flow is then filled with documents
in the order of a seeded hash: every document as often as the whole readings
say, and a seeded part of them once more.

Scale: the flow network has one node per pattern and per source.  Choosing
documents is a running sum in hash order, taken in cells so that a pattern with
a third of all rows is summed by many tasks; only the cell in which a pattern's
flow ends is decided row by row.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import hash_cell, rank_in_cells
from ..scratch import materialize
from .common import literal_rows

#: Rows that one cell of a running sum should hold at most, on average.
CELL_ROWS, MIN_CELLS = 200_000, 256
#: Patterns that the driver's flow network may have; more is an error, not a cut.
MAX_PATTERNS = 100_000
#: Patterns of which some name several sources: these go through a flow on the driver.
MAX_OVERLAPPING = 2_000


def water_fill(sizes: Sequence[float], weights: Sequence[float], total: float, repeat: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``repeat`` times its size; the excess is reshared."""
    target = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes)]
    left = total
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > repeat * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / weight
            break
        for i in full:
            target[i] = float(repeat * sizes[i])
            left -= target[i]
        open_ = [i for i in open_ if i not in full]
    return target


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], readings: int) -> list[dict[int, int]]:
    """Min-cost flow of whole tokens from patterns to quotas.

    ``patterns``: member sources and token sum of each.  The k-th reading of a
    token costs k*k, and a network edge for it has the pattern's sum as its
    capacity; a quota left open costs more than any reading.  Returns for each
    pattern the tokens that it gives to each source.
    """
    alone = [members[0] for members, _ in patterns if len(set(members)) == 1]
    if len(set(alone)) == len(patterns):  # no overlap: each source has documents of its own only
        return [{s: min(quotas[s], readings * size)} for s, (_, size) in zip(alone, patterns, strict=True)]
    if len(patterns) > MAX_OVERLAPPING:
        raise ValueError(f"more than {MAX_OVERLAPPING} patterns of overlapping sources")
    n, m = len(patterns), len(quotas)
    start, end = n + m, n + m + 1
    edges: list[list] = []  # [to, room, cost]; edge i's reverse is i ^ 1
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, room, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    links: list[dict[int, int]] = []
    for p, (members, size) in enumerate(patterns):
        for k in range(1, readings + 1):
            edge(start, p, size, k * k)
        links.append({s: edge(p, n + s, readings * size, 0) for s in sorted(set(members))})
    for s, q in enumerate(quotas):
        edge(n + s, end, q, 0)
    height = [0] * (n + m + 2)
    while True:
        far, via = [None] * len(out), [-1] * len(out)
        far[start] = 0
        heap = [(0, start)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i in out[a]:
                b, room, cost = edges[i]
                if room and (far[b] is None or d + cost + height[a] - height[b] < far[b]):
                    far[b], via[b] = d + cost + height[a] - height[b], i
                    heapq.heappush(heap, (far[b], b))
        if far[end] is None:
            break
        height = [h + (far[end] if f is None else min(f, far[end])) for h, f in zip(height, far, strict=True)]
        path, a = [], end
        while a != start:
            path.append(via[a])
            a = edges[via[a] ^ 1][0]
        flow = min(edges[i][1] for i in path)
        for i in path:
            edges[i][1] -= flow
            edges[i ^ 1][1] += flow
    return [{s: edges[i ^ 1][1] for s, i in own.items()} for own in links]


def select(df: DataFrame, key: str, size: str, pattern: str, flow: dict[int, int], totals: dict[int, int], seed: int, order: Sequence[str], cells: int) -> DataFrame:
    """Adds ``copies``: how often each row is read so that its pattern's sum meets its flow.

    Whole readings go to every row; of the rest, rows in seeded order while the
    running sum stays within it.  A second round gives the room that is left to
    the one row that comes nearest to filling it.
    """
    spark = df.sparkSession  # cells: a power of two
    plan = []
    for p, f in flow.items():
        whole, rest = divmod(f, totals[p]) if totals[p] else (0, 0)
        plan.append((p, whole, rest))
    table = literal_rows(spark, plan, "__p int,__whole int,__rest long")
    seeded = df.withColumn("__h", F.xxhash64(F.lit(seed), *order)).withColumn("__cell", F.shiftrightunsigned("__h", 64 - cells.bit_length() + 1).cast("int"))
    ranked = rank_in_cells(seeded, [pattern], "__cell", ["__h", *order], "__sum", weight=size)
    # One row a pattern: bounded by MAX_PATTERNS.
    ranked = ranked.join(F.broadcast(table), F.col(pattern) == F.col("__p"), "left")
    rest = F.coalesce("__rest", F.lit(0))
    ranked = materialize(ranked.withColumn("__fits", F.col("__sum") + F.col(size) <= rest), "mix")
    room = ranked.groupBy(F.col(pattern).alias("__q")).agg(F.max(rest).alias("__r"), F.sum(F.when(F.col("__fits"), F.col(size)).otherwise(0)).alias("__t"))
    open_ = {r[0]: r[1] - r[2] for r in room.collect() if r[0] is not None}  # one row a pattern
    gaps = literal_rows(spark, sorted(open_.items()), "__g int,__gap long")
    near = F.abs(F.col(size) - F.col("__gap"))
    free = ranked.filter(~F.col("__fits")).join(F.broadcast(gaps), F.col(pattern) == F.col("__g"))
    best = free.filter(near < F.col("__gap")).groupBy("__g").agg(F.min(F.struct(near.alias("d"), F.col("__h").alias("h"), F.col("__sum").alias("k"))).alias("b"))
    # Rows that are equal differ by their running sums, so one row is picked; rows of size 0 never are.
    picks = best.select(F.col("__g").alias("__bp"), F.col("b.h").alias("__bh"), F.col("b.k").alias("__bk"))
    ranked = ranked.join(F.broadcast(picks), (F.col(pattern) == F.col("__bp")) & (F.col("__h") == F.col("__bh")) & (F.col("__sum") == F.col("__bk")) & ~F.col("__fits"), "left")
    more = (F.col("__fits") & (rest > 0)) | F.col("__bp").isNotNull()
    return ranked.select(*df.columns, (F.coalesce("__whole", F.lit(0)) + more.cast("int")).alias("copies"))


def mix(df: DataFrame, key: str, size: str, members: str, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2, seed: int = 17) -> DataFrame:
    """Adds ``copies``, how often the mix reads each row: 0 to ``repeat``.

    ``members`` is an array of source names, one or more a row; a null or empty
    array is the source null.  A source's size is the sum over all rows that
    name it.  Sources by code point, null last, weigh ``weights`` repeating and
    share ``share`` of all sizes; a target stops at ``repeat`` times the size of
    its source.  Rows of size 0 may get any number of copies, an empty table
    stays empty, repeated rows are separate rows.  ``df`` is read several times:
    materialize it first.
    """
    return _mix(df, key, size, members, targets(df, size, members, weights, share, repeat), repeat, seed)


def _mix(df: DataFrame, key: str, size: str, members: str, goals: tuple, repeat: int, seed: int) -> DataFrame:
    names, sums, goal, patterns, count = goals
    cells = MIN_CELLS
    while cells * CELL_ROWS < count:
        cells *= 2
    index = {n: i for i, n in enumerate(names)}
    found = [([index[s] for s in who], total) for who, total in patterns]
    flows = route(found, [round(g) for g in goal], repeat)
    out = df.withColumn("__who", _canon(members))
    pairs = [(i, *who) for i, (who, _) in enumerate(patterns)]
    spark = df.sparkSession
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(_json([{"p": p[0], "w": list(p[1:])} for p in pairs])), "array<struct<p:int,w:array<string>>>")).alias("x")).select(F.col("x.p").alias("__pattern"), F.col("x.w").alias("__w"))
    out = out.join(F.broadcast(rows), F.col("__who") == F.col("__w")).drop("__who", "__w")
    order = [key, size]
    got = select(out, key, size, "__pattern", {i: sum(f.values()) for i, f in enumerate(flows)}, {i: t for i, (_, t) in enumerate(patterns)}, seed, order, cells)
    return got.drop("__pattern")


def _json(x) -> str:
    import json

    return json.dumps(x, ensure_ascii=False)


def _canon(members: str):
    """The distinct sources of a row in order, null as such; never empty."""
    who = F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array(F.lit(None).cast("string")))))
    return F.when(F.size(who) == 0, F.array(F.lit(None).cast("string"))).otherwise(who)


def targets(df: DataFrame, size: str, members: str, weights: Sequence[float], share: float, repeat: int) -> tuple[list, dict, list[float], list, int]:
    """Source names in order, their sizes, their targets, ``(members, tokens)`` of each pattern, the rows."""
    rows = df.groupBy(_canon(members).alias("w")).agg(F.sum(size).cast("long").alias("n"), F.count("*").alias("c")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = sorted(((list(r[0]), int(r[1] or 0)) for r in rows), key=lambda x: [(s is None, s or "") for s in x[0]])
    sums: dict = {}
    for who, n in patterns:
        for s in who:
            sums[s] = sums.get(s, 0) + n
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    total = share * sum(n for _, n in patterns)
    goal = water_fill([sums[s] for s in names], [weights[i % len(weights)] for i in range(len(names))], total, repeat)
    return names, sums, goal, patterns, sum(r[2] for r in rows)


def mix_documents(df: DataFrame, key: str = "doc_id", size: str = "size", source: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeat: int = 2, seed: int = 17) -> DataFrame:
    """``mix`` for rows with one source each; adds ``source_size``, ``target`` and ``copies``."""
    df = df.withColumn("__members", F.array(F.col(source)))
    goals = targets(df, size, "__members", weights, share, repeat)
    names, sums, goal = goals[:3]
    rows = [{"s": n, "n": sums[n], "t": g} for n, g in zip(names, goal, strict=True)]
    # One row a source, and there are no more sources than patterns.
    table = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(_json(rows)), "array<struct<s:string,n:long,t:double>>"))).select(F.col("s").alias("__s"), F.col("n").alias("source_size"), F.col("t").alias("target"))
    out = _mix(df, key, size, "__members", goals, repeat, seed).drop("__members")
    return out.join(F.broadcast(table), F.col(source).eqNullSafe(F.col("__s"))).drop("__s")
