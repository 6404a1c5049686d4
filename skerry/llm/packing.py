"""Best-fit packing of token pieces into fixed-length sequences.

Documents above capacity are cut into full pieces and a rest.  Pieces above a
third of the capacity fit at most twice in a bin: they are matched greedily,
the longest first, each with the longest partner that still fits beside it.
Smaller pieces then go, longest first, into the tightest gap that takes them,
and open a bin only where no gap does.

Scale: pieces of one length are interchangeable, so the whole matching runs
over the histogram of lengths (at most ``capacity`` numbers) with multiplicities
on the driver, whatever the number of pieces.  It yields ranges "the pieces of
length L ranked lo to hi go to bins from b on, so many a bin, at this offset";
the pieces are ranked inside their length by ``rank_in_cells``, so a length
that a third of all pieces share is spread over many tasks.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import hash_cell, rank_in_cells
from ..scratch import materialize
from .common import literal_rows

CAPACITY, END_ID = 4096, 1
#: Pieces of one length that a task should rank at most, on average.
CELL_ROWS, MIN_CELLS = 200_000, 64
#: Words, and pieces of words, whose ids a worker remembers at most; beyond, a table starts anew.
CACHE_WORDS = 300_000

#: Words that the short way below covers: printable ASCII and the Latin-1 letters.
PLAIN = re.compile("[!-~\u00c0-\u00ff]+")
#: Fixed value: the vocabulary's pre-tokenizer pattern, for such words in lower case.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def byte_symbols() -> dict[int, str]:
    """Byte-level vocabularies' symbol for each byte: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class WordIds:
    """Ids of a text by a ``tokenizers`` file, each distinct blank-separated word encoded once.

    For lower-casing word vocabularies with ``PIECES`` as their pre-tokenizer,
    whose pieces never contain or look across a space or a line feed.  Words of
    plain letters and signs are cut into pieces here, and only pieces not seen
    before go to the vocabulary's merges; any other word goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.symbols = byte_symbols()

    def piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= 2 * CACHE_WORDS:
                self.pieces.clear()
            text = piece if piece.isascii() else "".join(map(self.symbols.__getitem__, piece.encode()))
            got = self.pieces[piece] = b"".join([t.id.to_bytes(4, "little") for t in self.merge(text)])
        return got

    def word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.piece, PIECES.findall(word.lower())))
        return np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        known = self.words
        if len(known) >= CACHE_WORDS:
            known.clear()
        parts = text.replace("\n", " ").split(" ")
        for w in set(parts).difference(known):
            known[w] = self.word(w)
        return b"".join(map(known.__getitem__, parts))


@functools.lru_cache(2)
def word_ids(path: str) -> WordIds:
    """One table a worker process, kept from task to task."""
    return WordIds(path)


def tokenize(df: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its text's ids and then the end id, so null and empty texts
    give one piece of length 1.  ``path`` is the tokenizer's file, readable on
    every executor.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = word_ids(path), np.asarray([END_ID], dtype="<u4").tobytes()
        for b in batches:
            rows: dict[str, list] = {"at": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for i, t in enumerate(b.column(1).to_pylist()):
                ids = (ids_of(t) if t else b"") + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    for name, v in zip(rows, (i, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        rows[name].append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows.pop("at"), pa.int64())), pa.array(rows["piece"], pa.int32()), *[pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32")]], names=[id_col, "piece", "start", "length", "ids_crc32"])

    return df.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges ``(length, lo, hi, first bin, pieces a bin, offset)`` of a histogram's pieces.

    Pieces of ``length`` ranked lo to hi-1 go, ``pieces a bin`` at a time, to
    consecutive bins from ``first bin`` on, the first of a bin at ``offset``.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    rank = dict.fromkeys(counts, 0)
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, bins)]
    widths: list[int] = []  # sorted gaps > 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(widths, gap)
            heapq.heappush(gaps[gap], (first, n))

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        out.append((length, rank[length], rank[length] + n, first, each, offset))
        rank[length] += n

    large = sorted((x for x in counts if 3 * x > capacity and counts[x]), reverse=True)
    left = {x: counts[x] for x in large}
    for a in large:
        while left[a]:
            # Lengths still free and at most the room beside `a`, the longest first.
            b = next((x for x in large if x <= a and x + a <= capacity and left[x] > (x == a)), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, n, bins, 1, 0)
            left[a] -= n
            if b is not None:
                put(b, n, bins, 1, a)
                left[b] -= n
            leave(capacity - a - (b or 0), bins, n)
            bins += n
    for x in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        n = counts[x]
        while n:
            k = bisect_left(widths, x)
            if k == len(widths):
                each = capacity // x
                m = -(-n // each)
                leave(capacity, bins, m)
                bins += m
                continue
            gap = widths[k]
            first, m = heapq.heappop(gaps[gap])
            if not gaps[gap]:
                del gaps[gap]
                widths.pop(k)
            each = gap // x
            whole = min(m, n // each)
            if whole:
                put(x, whole * each, first, each, capacity - gap)
                leave(gap - each * x, first, whole)
                n -= whole * each
            elif n:
                put(x, n, first, n, capacity - gap)
                leave(gap - n * x, first, 1)
                whole, n = 1, 0
            leave(gap, first + whole, m - whole)
    return out


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    ``order`` is a total order of the pieces (rows that tie are interchangeable);
    the result does not depend on partitioning.  Read twice: materialize first.
    An empty table stays empty.
    """
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # `capacity` rows at most
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    ranges = literal_rows(pieces.sparkSession, plan(counts, capacity), "__l long,__lo long,__hi long,__bin long,__each long,__off long")
    cells = max(MIN_CELLS, max(counts.values(), default=0) // CELL_ROWS)
    ranked = rank_in_cells(pieces.withColumn("__cell", hash_cell(cells, *order)), ["length"], "__cell", order, "__rank")
    # A few ranges a length: bounded by the capacity, not by the data.
    at = ranked.join(F.broadcast(ranges), (F.col("length") == F.col("__l")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
    step = F.col("__rank") - F.col("__lo")
    return at.select(*pieces.columns, (F.col("__bin") + F.floor(step / F.col("__each"))).cast("long").alias("sequence_id"), (F.col("__off") + (step % F.col("__each")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(df: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents to pieces with their sequence and place."""
    return pack(materialize(tokenize(df, path, capacity, id_col, text), "pieces"), [id_col, "piece", "start", "ids_crc32"], capacity)
