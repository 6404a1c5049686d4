"""Consistent-hash ring with virtual nodes and bounded loads, natively in SQL.

Keys hash to a ring of ``cells``; every shard owns ``vnodes`` places on it, and
a key's home is the next place clockwise.  A shard admits its own keys up to
its capacity; the rest continue clockwise to the next place whose shard still
has room.  Capacities sum to the number of rows and differ by one at most, so
every shard is filled exactly: balance is guaranteed, and only the overflow of
the fuller shards moves away from its home.

Scale: one pass counts keys per ring cell (map-side combined, ``cells`` rows in
all), the walk itself runs over those counts on the driver (its size is set by
``cells``, never by the data), and a second pass ranks rows inside their cell.
No task ever holds more than one cell's keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import literal_rows

CELLS, VNODES = 8192, 64


def ring(shards: int, cells: int = CELLS, vnodes: int = VNODES) -> list[int]:
    """For each cell the shard that owns it: that of the next virtual node clockwise.

    A virtual node's cell only depends on its shard and number, so that one more
    shard adds nodes and moves none.  Nodes that fall on one cell: the lowest
    hash wins.
    """
    at: dict[int, tuple[int, int]] = {}
    for s in range(shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big")
            cell = h % cells
            at[cell] = min(at.get(cell, (h, s)), (h, s))
    owner, last = [0] * cells, at[min(at)][1]
    for c in range(cells - 1, -1, -1):
        last = at[c][1] if c in at else last
        owner[c] = last
    return owner


def walk(counts: dict[int, int], owner: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """Where each cell's keys go, as ``(cell, first rank, shard, first slot)``.

    ``counts``: keys by cell.  Home keys are admitted first, in ring order; then
    what overflowed walks clockwise, in ring order, to shards with room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    plan, over = [], []
    for c in sorted(counts):
        s = owner[c]
        n = min(counts[c], room[s] - filled[s])
        if n:
            plan.append((c, 0, s, filled[s]))
            filled[s] += n
        if n < counts[c]:
            over.append((c, n))
    cells = len(owner)
    for c, rank in over:
        at, left = c, counts[c] - rank
        while left:
            at = (at + 1) % cells
            s = owner[at]
            n = min(left, room[s] - filled[s])
            if n:
                plan.append((c, rank, s, filled[s]))
                filled[s] += n
                rank, left = rank + n, left - n
    return plan


def shard(df: DataFrame, key: str, shards: int = 16, cells: int = CELLS, vnodes: int = VNODES) -> DataFrame:
    """Adds ``shard`` (0 to shards-1), ``slot`` (gapless from 0 in a shard) and ``home``.

    Row counts of shards differ by one at most.  A null key is hashed like any
    other; repeated keys are placed row by row; rows whose key and every other
    column are equal are interchangeable.  An empty table stays empty.  Columns
    named like the new ones are replaced.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot", "home")
    placed = df.withColumn("__pos", F.xxhash64(key)).withColumn("__cell", F.pmod("__pos", F.lit(cells)).cast("int"))
    counts = {r[0]: r[1] for r in placed.groupBy("__cell").count().collect()}  # at most `cells` rows
    owner = ring(shards, cells, vnodes)
    plan: dict[int, list] = {}
    for c, rank, s, slot in walk(counts, owner, shards):
        plan.setdefault(c, []).append((rank, s, slot))
    rows = [(c, rank, parts[i + 1][0] if i + 1 < len(parts) else 1 << 62, s, slot, owner[c]) for c, parts in plan.items() for i, (rank, s, slot) in enumerate(parts)]
    table = literal_rows(spark, rows, "__c int,__lo long,__hi long,shard int,__slot long,home int")
    order = Window.partitionBy("__cell").orderBy("__pos", *[c for c in df.columns if c != "text"])
    ranked = placed.withColumn("__rank", F.row_number().over(order).cast("long") - 1)
    # The table has about `cells` rows: cells with keys plus the cuts of overflowing ones.
    joined = ranked.join(F.broadcast(table), (F.col("__cell") == F.col("__c")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
    return joined.select(*df.columns, "shard", (F.col("__slot") + F.col("__rank") - F.col("__lo")).alias("slot"), "home")
