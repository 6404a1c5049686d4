"""Repeated byte strings by a distributed merge sort of sampled suffixes.

Goal: every byte that a ``length``-byte string covers which also starts earlier
(in a smaller document, or earlier in the same one) goes.

1. Sampling.  Of the ``K``-byte strings inside each ``length``-byte window the
   one with the smallest hash is the window's anchor.  Equal windows have the
   same anchor at the same offset, so windows need only be compared between
   anchors with equal ``K`` bytes.  Anchors whose K bytes occur once are dropped
   after an exchange of their hashes.
2. Sorting.  Every task sorts the suffixes at its anchors, front-codes them (the
   bytes shared with the predecessor are sent as a number) and sends each range
   of the sorted run to one task.  There a loser tree merges the runs: its nodes
   know how many bytes a suffix shares with the last one that was put out, so a
   prefix that is known to be equal is never compared again, and the merge also
   yields the shared prefix of all neighbours.
3. Deciding.  For offset o two windows are equal if the suffixes share
   ``length - o`` bytes and the o bytes before the anchors are equal.  Neighbours
   that share that much form a run; in it, anchors are grouped by a hash of their
   o bytes, and all but the first occurrence are repeats.
4. Cutting.  Repeated windows go back to their document by a join.

Scale: a K-byte string that occurs often inside one map batch, and contexts that
are equal in full, are settled before the exchange: each batch sends one of
them, so a passage in a third of all documents arrives once a batch.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import numbered

LENGTH, K = 100, 40
REACH = LENGTH - K  # largest offset of an anchor in its window; at most 62, as offsets are bits
BATCH_BYTES, BATCH_SUFFIXES = 8 << 20, 250_000
#: Documents whose anchors set the ranges of the exchange (the first by a hash of their id).
RANGE_DOCS, PARTS_PER_TASK = 400, 3

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLOCK = 1 << 15
_UP = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, _BASE))])
_DOWN = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, _INVERSE))])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gram_hashes(flat: np.ndarray, k: int = K) -> np.ndarray:
    """A 64-bit hash of every k-byte string of a byte array, by a rolling polynomial."""
    out = np.zeros(len(flat) + 1, np.uint64)
    for i in range(0, len(flat), _BLOCK):
        part = flat[i : i + _BLOCK].astype(np.uint64) + np.uint64(1)
        n = len(part)
        out[i + 1 : i + n + 1] = (np.cumsum(part * _DOWN[1 : n + 1]) + out[i]) * _UP[1 : n + 1]
    return _mix(out[k:] - out[:-k] * _UP[k])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(place, smallest offset, largest offset, hash)`` of every anchor of a text."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = gram_hashes(np.frombuffer(data, np.uint8))
    best, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < REACH + 1:  # minima of windows of hashes by doubling; the leftmost of ties
        step = min(span, REACH + 1 - span)
        right = best[step:]
        left = best[: len(right)]
        take = right < left
        best, at = np.where(take, right, left), np.where(take, at[step:], at[: len(right)])
        span += step
    at = at[:n].astype(np.int64)
    edge = np.flatnonzero(np.diff(at, prepend=-1))
    place = at[edge]
    last = np.append(edge[1:], n) - 1
    return place, place - last, place - edge, h[place]


# -- exchange of anchor hashes ------------------------------------------------


def _six(h: np.ndarray) -> bytes:
    """The lower six bytes of each hash: candidates are compared in full later."""
    return h.astype("<u8").view("u1").reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), "u1")
    out[:, :6] = raw.reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _pack_hashes(h: np.ndarray, doc: np.ndarray, docs: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, probes: np.ndarray) -> bytes:
    """Occurrences and, of hashes settled already, ``probes`` that only say "repeated"."""
    parts = [struct.pack("<III", len(h), len(docs), len(probes)), docs.astype("<i8").tobytes(), _six(h), _six(probes), doc.astype("<u2" if len(docs) < 1 << 16 else "<u4").tobytes()]
    parts += [(place & 0xFFFF).astype("<u2").tobytes(), (place >> 16).astype("<u2").tobytes(), low.astype("u1").tobytes(), high.astype("u1").tobytes()]
    return b"".join(parts)


def _unpack_hashes(blob: bytes) -> tuple[np.ndarray, ...]:
    n, d, p = struct.unpack_from("<III", blob)
    at, out = 12, []
    for kind, count in (("<i8", d), ("u1", 6 * n), ("u1", 6 * p), ("<u2" if d < 1 << 16 else "<u4", n), ("<u2", n), ("<u2", n), ("u1", n), ("u1", n)):
        out.append(np.frombuffer(blob, kind, count, at))
        at += out[-1].nbytes
    docs, h, probes, doc, p0, p1, low, high = out
    h, probes = _from_six(h), _from_six(probes)
    return h, docs[doc] if n else np.empty(0, np.int64), p0.astype(np.int64) | p1.astype(np.int64) << 16, low, high, probes


def _batches(batches: Iterator[pa.RecordBatch], weigh, most: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in lists that weigh about ``most``."""
    part, size = [], 0
    for b in batches:
        for i in range(b.num_rows):
            row = tuple(c[i].as_py() for c in b.columns)
            part.append(row)
            size += weigh(row)
            if size >= most:
                yield part
                part, size = [], 0
    if part:
        yield part


def _send_hashes(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches, lambda r: len(r[1] or "")):
            docs, found = [], []
            for d, t in rows:
                got = anchors((t or "").encode())
                if len(got[0]):
                    found.append((np.full(len(got[0]), len(docs)), *got))
                    docs.append(d)
            if not found:
                continue
            docs = np.array(docs, np.int64)
            doc, place, low, high, h = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(h, kind="stable")
            doc, place, low, high, h = (x[order] for x in (doc, place, low, high, h))
            again = np.zeros(len(h), bool)
            again[1:] = h[1:] == h[:-1]
            again[:-1] |= again[1:].copy()
            part = (h & np.uint64(0xFFFFFFFFFFFF)) % np.uint64(parts)  # settled ones may go anywhere: they are spread by their place
            part[again] = np.arange(int(again.sum()), dtype=np.uint64) % np.uint64(parts)
            probe = np.unique(h[again])
            probe_part = (probe & np.uint64(0xFFFFFFFFFFFF)) % np.uint64(parts)
            out_part, blobs = [], []
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            for k in range(parts):
                mine = order[cuts[k] : cuts[k + 1]]
                for sure in (False, True):
                    own = mine[again[mine] == sure]
                    probes = np.empty(0, np.uint64) if sure else probe[probe_part == k]
                    if len(own) or len(probes):
                        used, index = np.unique(doc[own], return_inverse=True)
                        out_part.append(k)
                        blobs.append((b"\1" if sure else b"\0") + _pack_hashes(h[own], index, docs[used], place[own], low[own], high[own], probes))
            yield pa.RecordBatch.from_arrays([pa.array(out_part, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of hashes that occur twice or were settled as repeated."""
    names = ["doc", "place", "low", "high"]
    some, probes = [], []
    give = lambda doc, place, low, high: pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(place, pa.int64()), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16))], names=names)
    for b in batches:
        for blob in b.column(1):
            raw = blob.as_py()
            h, doc, place, low, high, more = _unpack_hashes(raw[1:])
            if raw[0]:
                yield give(doc, place, low, high)
            else:
                some.append((h, doc, place, low, high))
                probes.append(more)
    if some:
        h, doc, place, low, high = (np.concatenate(x) for x in zip(*some, strict=True))
        order = np.argsort(h, kind="stable")
        s = h[order]
        again = np.zeros(len(s), bool)
        again[1:] = s[1:] == s[:-1]
        again[:-1] |= again[1:].copy()
        again |= np.isin(s, np.concatenate(probes))
        keep = order[again]
        for i in range(0, len(keep), 100_000):
            k = keep[i : i + 100_000]
            yield give(doc[k], place[k], low[k], high[k])


# -- sorted runs --------------------------------------------------------------


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


def encode_run(items: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """Front-codes sorted ``(suffix, bytes before, low, doc, place)`` rows."""
    n = len(items)
    lcp, tails, before = bytearray(n), [], b""
    for i, x in enumerate(items):
        k = shared(before, x[0]) if i else 0
        lcp[i] = k
        tails.append(x[0][k:])
        before = x[0]
    nums = [np.array([len(t) for t in tails], "u1"), np.array([len(x[1]) for x in items], "u1"), np.array([x[2] for x in items], "u1"), np.array([x[3] for x in items], "<i8"), np.array([x[4] for x in items], "<i8")]
    return struct.pack("<I", n) + bytes(lcp) + b"".join(x.tobytes() for x in nums) + b"".join(tails) + b"".join(x[1] for x in items)


class Run:
    """A front-coded run, read one suffix at a time."""

    def __init__(self, blob: bytes):
        (self.n,) = struct.unpack_from("<I", blob)
        n, at = self.n, 4
        cols = []
        for kind in ("u1", "u1", "u1", "u1", "<i8", "<i8"):
            cols.append(np.frombuffer(blob, kind, n, at))
            at += cols[-1].nbytes
        self.lcp, self.tail, self.left_size, self.low, self.doc, self.place = cols
        self.blob, self.at, self.i, self.now = blob, at, -1, b""
        self.lcps, self.tails = self.lcp.tolist(), self.tail.tolist()
        self.lefts_at = at + int(self.tail.sum(dtype=np.int64))

    def step(self) -> int:
        """Moves to the next suffix; what it shares with the one before, or -1 at the end."""
        self.i += 1
        if self.i >= self.n:
            return -1
        k, t = self.lcps[self.i], self.tails[self.i]
        self.now = self.now[:k] + self.blob[self.at : self.at + t]
        self.at += t
        return k


def merge(runs: list[Run]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loser-tree merge: ``(run, place in it, prefix shared with the one put out before)``.

    ``have[r]`` is what run r's suffix shares with the last one put out.  Of two
    runs the one that shares more comes first, and the other keeps its number;
    only at equal numbers are bytes compared, from there on.
    """
    total = sum(r.n for r in runs)
    out_run, out_at, out_lcp = np.empty(total, np.int32), np.empty(total, np.int64), np.empty(total, np.int64)
    size = 1
    while size < len(runs):
        size *= 2
    have = [r.step() for r in runs] + [-1] * (size - len(runs))
    have = [0 if h >= 0 else -1 for h in have]
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        ha, hb = have[a], have[b]
        if ha != hb:
            return (a, b) if ha > hb else (b, a)
        if ha < 0:
            return a, b
        x, y = runs[a].now, runs[b].now
        k = shared(x, y, ha)
        if x[k : k + 1] <= y[k : k + 1]:
            have[b] = k
            return a, b
        have[a] = k
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, lose = play(build(2 * node), build(2 * node + 1))
        loser[node] = lose
        return win

    win = build(1) if size > 1 else 0
    for n in range(total):
        out_run[n], out_at[n], out_lcp[n] = win, runs[win].i, have[win]
        have[win] = runs[win].step()
        node = (win + size) >> 1
        while node:
            other = loser[node]
            mine, its = have[win], have[other]
            if its > mine:
                loser[node], win = win, other
            elif its == mine and its >= 0:
                x, y = runs[win].now, runs[other].now
                k = shared(x, y, its)
                if x[k : k + 1] <= y[k : k + 1]:
                    have[other] = k
                else:
                    have[win] = k
                    loser[node], win = win, other
            node >>= 1
    return out_run, out_at, out_lcp


def decide(runs: list[Run]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, place, offsets)``: bit o is set where the window at place - o is a repeat."""
    which, at, lcp = merge(runs)
    base = np.concatenate([[0], np.cumsum([r.n for r in runs])])[:-1]
    pick = base[which] + at
    cat = lambda name: np.concatenate([getattr(r, name) for r in runs])[pick]
    doc, place, low, high = cat("doc"), cat("place"), cat("low").astype(np.int64), cat("left_size").astype(np.int64)
    n = len(doc)
    lcp[0] = 0 if n else lcp
    mask = np.zeros(n, np.uint64)
    # Only suffixes that share K bytes with a neighbour take part.
    near = np.zeros(n, bool)
    near[1:] = lcp[1:] >= K
    near[:-1] |= near[1:].copy()
    rows = np.flatnonzero(near)
    if not len(rows):
        return doc[:0], place[:0], mask[:0]
    starts = np.concatenate([r.lefts_at + np.cumsum(r.left_size, dtype=np.int64) + o for r, o in zip(runs, np.concatenate([[0], np.cumsum([len(r.blob) for r in runs])])[:-1], strict=True)])[pick]  # ends of the bytes before
    flat = np.frombuffer(b"".join(r.blob for r in runs), np.uint8)
    order = rows[np.lexsort((place[rows], doc[rows]))]  # by first occurrence
    left = np.zeros(n, np.uint64)
    for o in range(REACH + 1):
        if o:
            has = rows[high[rows] >= o]
            left[has] = _mix(left[has] * _BASE + flat[starts[has] - o].astype(np.uint64) + np.uint64(1))
        run = np.cumsum(lcp < LENGTH - o).astype(np.uint64)
        live = order[(low[order] <= o) & (high[order] >= o)]
        if len(live) < 2:
            continue
        key = _mix(_mix(left[live]) * _BASE + run[live])  # not symmetric in the two
        by = np.argsort(key, kind="stable")
        s = key[by]
        again = np.zeros(len(s), bool)
        again[1:] = s[1:] == s[:-1]
        mask[live[by[again]]] |= np.uint64(1 << o)
    hit = np.flatnonzero(mask)
    hit = hit[np.argsort(doc[hit], kind="stable")]
    return doc[hit], place[hit], mask[hit]


def _runs(splits: list[bytes], keep: bool):
    """Texts with their anchors -> texts kept for the cut, sorted runs, and windows settled here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(6)
        names = ["kind", "doc", "part", "place", "mask", "blob"]
        kinds = [pa.int8(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for rows in _batches(batches, lambda r: 1 + len(r[2] or ()), BATCH_SUFFIXES):
            out: list[tuple] = []
            best: dict[tuple, tuple[int, int]] = {}
            settled: dict[int, list[tuple[int, int]]] = {}
            for doc, text, places in rows:
                data = (text or "").encode()
                if not places:
                    out.append((0, doc, None, len(data), None, data if keep else hashlib.sha256(data).digest()))
                    continue
                out.append((1, doc, None, None, None, squeeze.compress(data)))
                for p in places:
                    a, low, high = p["place"], p["low"], p["high"]
                    key = (data[a : a + LENGTH - low], data[a - high : a], low)
                    was = best.get(key)
                    if was is None:
                        best[key] = (doc, a)
                        continue
                    if (doc, a) < was:
                        best[key], (gone, at) = (doc, a), was
                    else:
                        gone, at = doc, a
                    settled.setdefault(gone, []).append((at - high, at - low + LENGTH))
            for doc, spans in settled.items():
                out += [(3, doc, None, lo, hi, None) for lo, hi in _joined(spans)]
            items = sorted((r, le, low, d, a) for (r, le, low), (d, a) in best.items())
            ends = [bisect_right(items, s, key=lambda x: x[0][:K]) for s in splits] + [len(items)]
            at = 0
            for k, e in enumerate(ends):
                for i in range(at, e, 1 << 16):
                    out.append((2, None, k, None, None, encode_run(items[i : min(e, i + (1 << 16))])))
                at = e
            for i in range(0, len(out), 5000):
                cols = list(zip(*out[i : i + 5000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def repeats(place: np.ndarray, mask: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the windows of anchors, one for each run of set offsets, and the anchor's row."""
    lows, highs, rows = [], [], []
    before = np.zeros(len(mask), bool)
    start = np.zeros(len(mask), np.int64)
    for o in range(REACH + 2):
        now = (mask >> np.uint64(o) & np.uint64(1)).astype(bool)
        start[now & ~before] = o
        end = before & ~now
        lows.append(place[end] - (o - 1))
        highs.append(place[end] - start[end] + LENGTH)
        rows.append(row[end])
        before = now
    return np.concatenate(lows), np.concatenate(highs), np.concatenate(rows)


def joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document that touch or overlap as one."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    rank = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(hi.max()) + 1)  # ends of later documents are larger
    reach = np.maximum.accumulate(hi + rank)
    new = np.append(True, lo[1:] + rank[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], lo[first], reach[np.append(first[1:], len(doc)) - 1] - rank[first]


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, bytes removed, and maximal runs removed."""
    gone = _joined(spans)
    left, at = [], 0
    for lo, hi in gone:
        left.append(data[at:lo])
        at = hi
    left.append(data[at:])
    return b"".join(left), sum(hi - lo for lo, hi in gone), len(gone)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list[bytes]] = {}
    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            parts.setdefault(k, []).append(blob.as_py())
    for k in sorted(parts):
        doc, place, mask = decide([Run(x) for x in parts.pop(k)])
        at = np.arange(len(doc))
        lo, hi, row = repeats(place, mask, at)
        doc, lo, hi = joined(doc[row], lo, hi)
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(hi)], names=["doc", "lo", "hi"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for b in batches:
        cols: list[list] = [[] for _ in range(5)]
        for i in range(b.num_rows):
            data = expand.decompress(b.column(1)[i].as_py())
            left, n, spans = cut(data, [(s["lo"], s["hi"]) for s in b.column(2)[i].as_py() or ()])
            for c, v in zip(cols, (len(data), n, spans, hashlib.sha256(left).hexdigest(), left), strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _splitters(docs: DataFrame, parts: int) -> list[bytes]:
    """Even quantiles of the anchors' first bytes, from RANGE_DOCS documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for t in b.column(0):
                data = (t.as_py() or "").encode()
                place = anchors(data)[0]
                got += [data[a : a + K] for a in place[:: max(1, len(place) // 200)].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], names=["b"])

    some = docs.orderBy(F.xxhash64("__id"), "__id").limit(RANGE_DOCS).select("__text")
    found = sorted(bytes(r[0]) for r in some.mapInArrow(run, "b binary").collect())
    return sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; with ``keep`` also ``kept``, the bytes left.

    Matches are judged on the input and never cross documents; texts shorter
    than 100 bytes lose nothing; null counts as empty.  Rows that share an id are
    documents of their own, in the order of a hash of their texts: of rows that are
    equal one stays whole.  A row with a null id is left whole and matches nothing.
    An empty table stays empty; only the two columns are read.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS_PER_TASK * tasks
    rows, repeated = numbered(df.select(id_col, text), id_col, text)
    docs = rows.select(F.col("__row").alias("__id"), F.col(text).alias("__text"))
    real = docs.filter("__id is not null")
    splits = _splitters(real, parts)
    found = real.mapInArrow(_send_hashes(parts), "part int, blob binary").repartition(tasks, "part").mapInArrow(_repeated, "doc long, place long, low smallint, high smallint")
    by_doc = found.groupBy("doc").agg(F.collect_list(F.struct("place", "low", "high")).alias("places"))
    joined = docs.join(by_doc, F.col("__id") == F.col("doc"), "left").select("__id", "__text", "places")
    stored = materialize(joined.mapInArrow(_runs(splits, keep), "kind byte, doc long, part int, place long, mask long, blob binary"), "runs")
    merged = stored.filter("kind = 2").select("part", "blob").repartition(tasks, "part").mapInArrow(_merged, "doc long, lo long, hi long")
    settled = stored.filter("kind = 3").select("doc", F.col("place").alias("lo"), F.col("mask").alias("hi"))
    spans = materialize(merged.union(settled), "spans")
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    some = stored.filter("kind = 1").select("doc", "blob").join(spans, "doc", "left").mapInArrow(_finish, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    none = F.lit(0).cast("long")
    whole = stored.filter("kind = 0").select("doc", F.col("place").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2("blob", 256).alias("kept_sha256") if keep else F.lower(F.hex("blob")).alias("kept_sha256"), F.col("blob").alias("kept"))
    out = some.union(whole)
    if repeated:  # null ids have no number, and keep none
        out = out.join(rows.select(F.col("__row").alias("doc"), F.col(id_col).alias("__of")).filter("doc is not null"), "doc", "left").withColumn("doc", F.col("__of")).drop("__of")
    out = out.withColumn("doc", F.col("doc").cast(df.schema[id_col].dataType)).withColumnRenamed("doc", id_col)
    return out if keep else out.drop("kept")
