"""Near-duplicate lines by a segment-partition edit join.

A line is cut into ``edits + 1`` segments of even length.  Whatever lies within
``edits`` edits of it contains one of the segments unchanged, at a place that
the two lengths limit: a line therefore probes, for each length it could have
been edited from, the few substrings that the multi-match-aware bound leaves.
Segments and probes are hashed with their length and number; lines that share
a hash are candidates, and a banded bit-parallel edit distance decides.

Edits are of characters.  With ``rate``, edits of whole words count too, and
their number grows with the length: ``word_edits`` of the shorter line.  Where
that is one, the words of a line go through the same segments and probes.  From
two on, the shorter line keeps a run of ``_run`` untouched words at least, and
the smallest hash of ``SHINGLE`` words of each such run is a key of both lines;
their number is in proportion to the line and no link is lost.  Each letter of a
script without spaces is a word.

Lines shorter than ``min_bytes`` never join by edits: so
few letters are no evidence of copying.  With ``short`` their exact repeats form
classes if they hold a word; blank lines and rules always stay.  Of each class of linked lines the first
occurrence stays (smallest document, then smallest line); the others go.

Scale: words, segments and probes of a part of lines are hashed as vectors, each
line once a part, and reach the task that collects a key as packed arrays; only
keys that lines share become rows.  Candidates go through ``link_buckets``, so a
family of like lines costs comparisons in proportion to its size.  Lines count as
equal by a 128-bit hash; near ones are compared letter by letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import discard, materialize
from .common import numbered
from .linking import link_buckets, shared_buckets

EDITS, MIN_BYTES = 2, 32
#: Words of a line that may have one edit, and of a hashed run of words.
MIN_WORDS, SHINGLE = 8, 5
#: Classes of words whose parities bound the edits of words.
CLASSES = 512
#: Bytes of distinct lines whose keys are made at a time.
PART_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers never vanish modulo 2**64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BLOCK = 1 << 15
_UP = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, _BASE))])
_DOWN = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, np.uint64(pow(int(_BASE), -1, 1 << 64))))])


def edit_distance(a: bytes | str | tuple, b: bytes | str | tuple, most: int) -> int:
    """Edits between two sequences, or ``most + 1`` if there are more.

    Common ends are cut off; the rest runs column by column over a band of
    ``2 * most + 1`` rows around the diagonal, held as bits of two integers (up
    and down steps of the column).
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    if a == b:
        return 0
    lo, hi = 0, len(a)
    while lo < hi:  # longest common prefix by halving
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(a)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] == b[len(b) - mid :] else (lo, mid - 1)
    a, b = a[: len(a) - lo], b[: len(b) - lo]
    if not a:
        return len(b)
    m, n, k = len(a), len(b), most
    # Row i of the table is bit i - (j - k) of column j; rows above 1 never match.
    match: dict[int | str, int] = {}
    for i, c in enumerate(a):
        match[c] = match.get(c, 0) | 1 << (i + k)
    full = (1 << (2 * k + 1)) - 1
    up = full & ~((1 << k) - 1) if k else full  # column 0: each row below the first is one more
    down = 0
    score = min(k, m)  # of the band's lowest row, k below the diagonal, or the table's last
    end = m - k  # from here on the lowest row would be below the table: the last row moves up the band
    for j in range(n):
        eq = (match.get(b[j], 0) >> j) & full
        d = ((((eq & up) + up) ^ up) | eq | down) & full
        hp = (down | ~(d | up)) & full
        hn = d & up
        if j < end:
            score += not d >> (2 * k) & 1
        else:
            bit = 2 * k - 1 - (j - end)
            if bit < 0:
                return most + 1
            score += (hp >> bit & 1) - (hn >> bit & 1)
        if score > most + (n - j - 1 if j >= end else 2 * k):
            return most + 1
        up = (hn | ~((d >> 1) | hp)) & full
        down = (d >> 1) & hp
    return min(score, most + 1)


def segments(length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the ``edits + 1`` segments of lines, one row a line; the last ones are longer."""
    parts = edits + 1
    short, longer = np.divmod(length[:, None], parts)
    k = np.arange(parts)[None]
    shift = np.maximum(k - (parts - longer), 0)
    return k * short + shift, short + (k >= parts - longer)


def _hash(prefix: np.ndarray, power: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return prefix[start + size] - prefix[start] * power[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))])


def _prefix(flat: np.ndarray) -> np.ndarray:
    """Sums ``prefix[i + 1] = prefix[i] * BASE + flat[i] + 1``; blocks of sums over inverse powers."""
    out = np.zeros(len(flat) + 1, np.uint64)
    for i in range(0, len(flat), _BLOCK):
        part = flat[i : i + _BLOCK].astype(np.uint64) + np.uint64(1)
        n = len(part)
        out[i + 1 : i + n + 1] = (np.cumsum(part * _DOWN[1 : n + 1]) + out[i]) * _UP[1 : n + 1]
    return out


def keys(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line number, key)`` of every segment and probe of the lines, as two arrays."""
    flat = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    size = np.array([len(x) for x in lines], np.int64)
    return _keys(_prefix(flat), np.cumsum(size) - size, size, edits)


def _keys(prefix: np.ndarray, at: np.ndarray, size: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """``keys`` of the sequences that start at ``at`` and have ``size`` numbers."""
    power = _powers(int(size.max(initial=0)) + 1)
    rows, found = [], []
    parts = edits + 1

    def put(who: np.ndarray, k: int, length: np.ndarray, start: np.ndarray, wide: np.ndarray) -> None:
        h = _hash(prefix, power, at[who] + start, wide)
        rows.append(who)
        found.append(_mix(h ^ _mix(length.astype(np.uint64) * np.uint64(parts) + np.uint64(k))))

    for less in range(edits + 1):  # the other line is shorter by this
        other = size - less
        ok = np.flatnonzero(other >= parts)
        start, wide = segments(other[ok], edits)
        for k in range(parts):
            # Places a segment can have moved to, seen from the left and from the right end.
            for move in range(-edits, edits + 1):
                if not (-k <= move <= k and less - (edits - k) <= move <= less + (edits - k)):
                    continue
                s = start[:, k] + move
                fits = (s >= 0) & (s + wide[:, k] <= size[ok])
                put(ok[fits], k, other[ok][fits], s[fits], wide[fits, k])
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(rows), np.concatenate(found)


def word_edits(words: int, rate: int) -> int:
    """Word edits that a line of so many words may have: one from ``MIN_WORDS`` on, more with each ``rate`` words."""
    return max(1, words // rate) if words >= MIN_WORDS else 0


def _run(times: int, rate: int) -> int:
    """Words in a row that ``word_edits`` leave in a line of ``times * rate`` words or more."""
    return -(-times * (rate - 1) // (times + 1))


#: Code points of scripts without spaces, of which each is a word.
_ALONE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_LETTER = "".join(f"{chr(a)}-{chr(b)}" for a, b in _ALONE)
_WORDS = re.compile(f"[{_LETTER}]|[^\\s{_LETTER}]+")
#: By code point: 0 is part of a word, 1 a space, 2 a word by itself.
_KIND = np.zeros(0x110000, np.uint8)
_KIND[[c for c in range(0x3001) if chr(c).isspace()]] = 1
for _a, _b in _ALONE:
    _KIND[_a : _b + 1][_KIND[_a : _b + 1] == 0] = 2


def line_words(line: bytes) -> list[str]:
    """The words of a line; each letter of a script without spaces is one."""
    return line.decode().split() if line.isascii() else _WORDS.findall(line.decode())


class Letters:
    """Lines as one array of code points with sums for hashing, and the hashes of their words."""

    def __init__(self, lines: list[bytes]):
        self.flat = flat = np.frombuffer((b"\n".join(lines) + b"\n").decode().encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(flat == 10)
        self.at = np.concatenate([[0], ends[:-1] + 1])
        self.size = ends - self.at
        self.prefix = _prefix(flat)
        kind = _KIND[flat]
        inside = np.zeros(len(flat) + 2, bool)
        inside[1:-1] = kind == 0
        start = np.flatnonzero((inside[1:-1] & ~inside[:-2]) | (kind == 2))
        end = start + 1
        end[kind[start] == 0] = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        power = _powers(int((end - start).max(initial=0)) + 1)
        self.words = _mix(_hash(self.prefix, power, start, end - start))
        self.count = np.diff(np.searchsorted(start, np.append(self.at, len(flat))))


def word_keys(flat: np.ndarray, size: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """``(line number, key)`` such that lines within ``word_edits`` of the shorter one share a key."""
    number, owner = np.arange(len(size)), np.repeat(np.arange(len(size)), size)
    few = (size >= MIN_WORDS) & (size <= 2 * rate)  # the shorter line has one edit
    short = size[few]
    row, key = _keys(_prefix(flat[few[owner]]), np.cumsum(short) - short, short, 1)
    rows, found = [number[few][row]], [_mix(key ^ _M1)]
    # Lines of 2 * rate to 3 * rate words, which keep shorter runs, and those of more; an other line can be longer by the edits.
    for times, least, most in ((2, 2 * rate, 3 * rate + 1), (3, 3 * rate, None)):
        run = _run(times, rate)
        some = (size >= least) & (size <= most if most else True)
        h, who = flat[some[owner]], owner[some[owner]]
        if len(h) < run:
            continue
        n = len(h) - SHINGLE + 1
        shingle = np.full(n, times, np.uint64)
        for k in range(SHINGLE):
            shingle = _mix(shingle * _BASE + h[k : k + n])
        low, wide, window = shingle, 1, run - SHINGLE + 1
        while wide < window:  # minima of windows by doubling
            step = min(wide, window - wide)
            low, wide = np.minimum(low[step:], low[:-step]), wide + step
        inside = who[: len(low)] == who[run - 1 : run - 1 + len(low)]
        low, who = low[inside], who[: len(low)][inside]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (who[1:] != who[:-1])
        rows.append(who[new])
        found.append(low[new])
    return np.concatenate(rows), np.concatenate(found)


def _split(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().split(b"\n")


def _ids(lines: list[bytes]) -> np.ndarray:
    """A 128-bit hash of each line, as two numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), "<i8").reshape(-1, 2)


_WORD = re.compile("[^\\W_]")


def holds_word(line: bytes) -> bool:
    """Whether a line has a letter or a digit."""
    return _WORD.search(line.decode()) is not None


def _occurrences(df: DataFrame, text: str, min_bytes: int, short: bool) -> DataFrame:
    """``(doc, line, id, more, own)`` of every line that is long enough or, with ``short``, holds a word.

    ``id`` and ``more`` are the halves of its hash; ``own`` is the first such line
    of its document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, nums, lines, own = [], [], [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seen: dict[bytes, int] = {}
                for k, x in enumerate(_split(t.as_py())):
                    if len(x) >= min_bytes or short and holds_word(x):
                        docs.append(d)
                        nums.append(k)
                        lines.append(x)
                        own.append(seen.setdefault(x, k))
            h = _ids(lines)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(nums, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(own, pa.int32())], names=["doc", "line", "id", "more", "own"])

    return df.filter(F.col("__row").isNotNull()).select("__row", text).mapInArrow(run, "doc long, line int, id long, more long, own int")


def _distinct(batches: Iterator[pa.RecordBatch], min_bytes: int, column: int, limit: int = PART_BYTES) -> Iterator[list[bytes]]:
    """Lines in parts of about ``limit`` bytes, each line once a part."""
    part, size = {}, 0
    for b in batches:
        for t in b.column(column):
            for x in _split(t.as_py()):
                if len(x) >= min_bytes and x not in part:
                    part[x] = None
                    size += len(x)
                    if size > limit:
                        yield list(part)
                        part, size = {}, 0
    if part:
        yield list(part)


def line_keys(lines: list[bytes], edits: int, rate: int | None) -> tuple[np.ndarray, np.ndarray]:
    """``(line number, key)`` such that lines within the edits of letters or words share a key."""
    have = Letters(lines)
    if not rate:
        return _keys(have.prefix, have.at, have.size, edits)
    row, key = word_keys(have.words, have.count, rate)
    # An edit of a letter is three of words at most (it can split one), so that long lines have links by words alone.
    few = np.flatnonzero(have.count < rate * 3 * edits + 3 * edits)
    more = _keys(have.prefix, have.at[few], have.size[few], edits)
    return np.concatenate([row, few[more[0]]]), np.concatenate([key, more[1]])


def _repeated(band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts bands, and which places of it hold one that occurs twice."""
    order = np.argsort(band)
    same = np.concatenate([[False], np.diff(band[order]) == 0, [False]])
    return order, same[1:] | same[:-1]


def _runs(band: np.ndarray, who: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs by band and id, each once with its flag if any has it: bands, ids, flags, and where bands begin."""
    order = np.lexsort((~flag, who, band))
    band, who, flag = band[order], who[order], flag[order]
    new = np.append(True, band[1:] != band[:-1])[: len(band)]
    keep = new | np.append(True, who[1:] != who[:-1])[: len(band)]
    return band[keep], who[keep], flag[keep], np.flatnonzero(new[keep])


def _send_keys(min_bytes: int, edits: int, rate: int | None, parts: int):
    """Keys of each part of lines, packed by the task that collects them.

    A key that two lines of a part share is settled there: its rows need no
    exchange and are spread evenly; the collecting task only gets its smallest
    line.  So a key of a third of all lines arrives there once a part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _distinct(batches, min_bytes, 0):
            row, key = line_keys(lines, edits, rate)
            ids = _ids(lines)[:, 0]
            order, again = _repeated(key)
            band, who, _, start = _runs(key[order[again]], ids[row[order[again]]], np.zeros(int(again.sum()), bool))
            many = np.diff(np.append(start, len(band)))
            sure, alone, once = np.repeat(many > 1, many), start[many == 1], order[~again]
            out: list[tuple[int, bytes]] = []
            for kind, b, w in ((0, np.append(key[once], band[alone]), np.append(ids[row[once]], who[alone])), (1, band[start[many > 1]], who[start[many > 1]])):
                task = (b % np.uint64(parts)).astype(np.int32)
                at = np.argsort(task, kind="stable")
                cut = np.searchsorted(task[at], np.arange(parts + 1))
                b, w = b[at], w[at]
                out += [(k, bytes([kind]) + b[cut[k] : cut[k + 1]].tobytes() + w[cut[k] : cut[k + 1]].tobytes()) for k in range(parts) if cut[k] < cut[k + 1]]
            rest = np.flatnonzero(sure)
            first = int(key[0] % np.uint64(parts)) if len(key) else 0
            out += [((first + i) % parts, b"\2" + band[x].tobytes() + who[x].tobytes()) for i, x in enumerate(np.array_split(rest, max(1, len(rest) >> 14))) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["part", "blob"])

    return run


def _collect_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys with two lines or more.  Repeated pairs are dropped while they are gathered."""
    give = lambda band, who: pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), pa.array(who)], names=["band", "id"])
    have: list[list[np.ndarray]] = [[], [], []]  # bands, ids, whether the band is settled

    def gather() -> tuple[np.ndarray, ...]:
        band, who, flag = (np.concatenate(x) for x in have)
        order, again = _repeated(band)
        once, twice = order[~again], order[again]
        found = _runs(band[twice], who[twice], flag[twice])
        for k, (x, y) in enumerate(zip((band, who, flag), found[:3], strict=True)):
            have[k] = [x[once], y]
        return found

    size, last = 0, 0
    for b in batches:
        for x in b.column(1):
            raw = x.as_py()
            both = np.frombuffer(raw, "<u8", offset=1).reshape(2, -1)
            band, who = both[0], both[1].view(np.int64)
            if raw[0] == 2:
                yield give(band, who)
                continue
            for k, y in enumerate((band, who, np.full(len(band), raw[0] == 1))):
                have[k].append(y)
            size += len(band)
            if size > 2 * last + (1 << 21):
                gather()
                size = last = sum(map(len, have[0]))
    if size:
        band, who, flag, start = gather()
        if len(band):  # a settled band that came once has all its rows out already
            many = np.diff(np.append(start, len(band)))
            more = (many > 1) | np.logical_or.reduceat(flag, start)
            keep = np.flatnonzero(np.repeat(more, many))
            for i in range(0, len(keep), 1 << 17):
                yield give(band[keep[i : i + (1 << 17)]], who[keep[i : i + (1 << 17)]])


def _shared(df: DataFrame, text: str, min_bytes: int, edits: int, rate: int | None) -> DataFrame:
    """``(band, id)`` of the keys that two lines or more share; a row can come more than once."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(text).mapInArrow(_send_keys(min_bytes, edits, rate, tasks), "part int, blob binary").repartition(tasks, "part").mapInArrow(_collect_keys, "band long, id long")


def _odd(cell: np.ndarray, owner: np.ndarray, lines: int, wide: int) -> np.ndarray:
    """Whether each of ``wide`` classes occurs an odd number of times in a line, as bits of ``wide // 64`` numbers."""
    odd = np.bincount(owner * wide + cell.astype(np.int64), minlength=wide * lines).reshape(lines, wide) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def parities(have: Letters) -> np.ndarray:
    """Parities of characters and pairs of them, in 64 classes each, and of words in ``CLASSES``.

    One edit of a character changes at most two classes of characters and four of
    pairs, one of a word two classes of words, which bounds the edits between two
    lines from below.  The first, second, ... occurrence of a word count as
    different words, so that repeated ones don't cancel out.
    """
    lines = len(have.size)
    owner = np.repeat(np.arange(lines), have.size + 1)
    inside = have.flat != 10
    a = have.flat.astype(np.int64)
    pair = inside[:-1] & inside[1:]
    who = np.repeat(np.arange(lines), have.count)
    value = np.sort(who.astype(np.uint64) << np.uint64(40) | have.words >> np.uint64(24))  # a part has less than 2**24 lines
    new = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
    rank = np.arange(len(value)) - np.repeat(new, np.diff(np.append(new, len(value))))
    cell = _mix((value & np.uint64((1 << 40) - 1)) + rank.astype(np.uint64) * _BASE) % np.uint64(CLASSES)
    return np.concatenate([_odd((a & 63)[inside], owner[inside], lines, 64), _odd(((a[:-1] * 31 + a[1:] * 17) & 63)[pair], owner[:-1][pair], lines, 64), _odd(cell, who, lines, CLASSES)], axis=1)


def _send_texts(min_bytes: int, parts: int):
    """Lines of each part of them with their hashes, packed by the task that collects them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _distinct(batches, min_bytes, 0):
            ids = _ids(lines)
            task = ids[:, 0] % parts
            order = np.argsort(task, kind="stable")
            cut = np.searchsorted(task[order], np.arange(parts + 1)).tolist()
            ids, at = ids[order], order.tolist()
            out = [(k, np.int64(j - i).tobytes() + ids[i:j].tobytes() + b"\n".join([lines[x] for x in at[i:j]])) for k, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if i < j]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.nulls(len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())], names=["part", "id", "blob"])

    return run


def _bounds(texts: list[tuple[int, int, bytes]], rate: int | None) -> pa.RecordBatch:
    """``(id, more, bytes)`` and what bounds the edits of lines: ``n`` characters, ``w`` words, ``t`` word edits, and parities."""
    ids, more, lines = map(list, zip(*texts, strict=True))
    have = Letters(lines)
    odd = parities(have)
    most = [word_edits(x, rate) if rate else 0 for x in have.count.tolist()]
    sizes = [pa.array(have.size.astype(np.int32)), pa.array(have.count.astype(np.int32)), pa.array(most, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(more, pa.int64()), pa.array(lines, pa.binary()), *sizes, *[pa.array(x) for x in odd.T]], names=["id", "more", "bytes", "n", "w", "t", *[f"p{k}" for k in range(odd.shape[1])]])


def _collect_texts(rate: int | None):
    """Each line of which the id comes before all texts, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[np.ndarray] = []
        ids, seen, out = None, np.zeros(0, bool), []
        for b in batches:
            some.append(b.column(1).drop_null().to_numpy())
            for x in b.column(2).drop_null():
                if ids is None:
                    ids = np.unique(np.concatenate(some))
                    seen = np.zeros(len(ids), bool)
                raw = x.as_py()
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                both = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
                place = np.minimum(np.searchsorted(ids, both[:, 0]), len(ids) - 1)
                new = np.flatnonzero((ids[place] == both[:, 0]) & ~seen[place]) if len(ids) else ()
                if not len(new):
                    continue
                lines = raw[8 + 16 * n :].split(b"\n")
                for k in new.tolist():
                    if not seen[place[k]]:
                        seen[place[k]] = True
                        out.append((int(both[k, 0]), int(both[k, 1]), lines[k]))
                while len(out) >= 2000:
                    yield _bounds(out[:2000], rate)
                    out = out[2000:]
        if out:
            yield _bounds(out, rate)

    return run


def _texts(df: DataFrame, text: str, min_bytes: int, some: DataFrame, rate: int | None) -> DataFrame:
    """A row for each line of which ``some`` has the id, with its bounds (see ``_bounds``)."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = df.select(text).mapInArrow(_send_texts(min_bytes, tasks), "part int, id long, blob binary")
    wanted = some.select(F.pmod("id", F.lit(tasks)).cast("int").alias("part"), "id", F.lit(None).cast("binary").alias("blob"))
    fields = "id long, more long, bytes binary, n int, w int, t int, " + ", ".join(f"p{k} long" for k in range(2 + CLASSES // 64))
    return wanted.union(sent).repartition(tasks, "part").sortWithinPartitions(F.col("id").isNull()).mapInArrow(_collect_texts(rate), fields)


def linked(a: bytes, b: bytes, edits: int, rate: int | None = None) -> bool:
    """Whether two lines are within ``edits`` edits of characters or, with ``rate``, the shorter one's edits of words."""
    if rate:
        x, y = line_words(a), line_words(b)
        most = word_edits(min(len(x), len(y)), rate)
        if most and abs(len(x) - len(y)) <= most:
            # Most copies have words replaced in place; those need no table.
            if len(x) == len(y) and sum(map(ne, x, y)) <= most or edit_distance(tuple(x), tuple(y), most) <= most:
                return True
    return edit_distance(a.decode(), b.decode(), edits) <= edits


def _near(pairs: DataFrame, edits: int, rate: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [linked(x.as_py(), y.as_py(), edits, rate) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("x", "y", "tx", "ty").mapInArrow(run, "u long, v long")


def repeated_lines(df: DataFrame, edits: int = EDITS, min_bytes: int = MIN_BYTES, text: str = "text", rate: int | None = None, short: bool = False) -> DataFrame:
    """``(doc, line, first_doc, first_line)`` of every line that goes, and the line of its class that stays.

    ``df`` has a column ``__row``, a number of its own for each row in document
    order (see ``numbered``); null texts and null numbers have no lines here.
    """
    if min_bytes < 2 * edits + 1:
        raise ValueError("lines must be longer than twice the edits")
    if rate is not None and _run(2, rate) < SHINGLE:
        raise ValueError("too many word edits for their length")
    with_row = df.filter(F.col("__row").isNotNull())
    keys_ = materialize(_shared(with_row, text, min_bytes, edits, rate).distinct(), "keys")
    bucket = shared_buckets(keys_)
    discard(keys_)
    texts = materialize(_texts(with_row, text, min_bytes, bucket.select("id"), rate), "linetext")

    def confirm(pairs: DataFrame, whole: DataFrame) -> DataFrame:
        side = lambda s: whole.select(F.col("id").alias(s), F.col("bytes").alias(f"t{s}"))
        return _near(pairs.join(side("x"), "x").join(side("y"), "y"), edits, rate)

    def near(x: str, y: str) -> Column:
        flips = lambda c: F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}")))
        letters = (F.abs(F.col(f"{x}n") - F.col(f"{y}n")) <= edits) & (flips("p0") <= 2 * edits) & (flips("p1") <= 4 * edits)
        if not rate:
            return letters
        most = F.least(f"{x}t", f"{y}t")
        return letters | ((most > 0) & (F.abs(F.col(f"{x}w") - F.col(f"{y}w")) <= most) & (sum((flips(f"p{k}") for k in range(2, 2 + CLASSES // 64)), F.lit(0)) <= 2 * most))

    # The half of the hash that `more` holds tells lines apart that share the other; one of them was linked.
    label = link_buckets(bucket, texts.drop("bytes", "more"), near, confirm, texts.select("id", "bytes"))
    linked_ids = materialize(label.join(texts.select("id", "more"), "id"), "label", drop=(label, texts))
    where = materialize(_occurrences(with_row, text, min_bytes, short), "lines")
    once = where.filter("line = own")
    classes = once.groupBy("id", "more").agg(F.min("doc").alias("fd"), F.min_by("line", "doc").alias("fl"), F.count("*").alias("c")).join(linked_ids, ["id", "more"], "left").filter("c > 1 or component is not null")
    classes = materialize(classes, "class", drop=(linked_ids,))
    near_first = classes.filter("component is not null").groupBy("component").agg(F.min(F.struct("fd", "fl")).alias("first"))
    found = classes.join(near_first, "component", "left").select("id", "more", F.coalesce("first", F.struct("fd", "fl")).alias("first"))
    kept = F.coalesce("first", F.struct(F.col("doc").alias("fd"), F.col("own").alias("fl")))
    gone = where.join(found, ["id", "more"], "left").select("doc", "line", kept.alias("first")).filter(F.struct("doc", "line") != F.col("first"))
    return gone.select("doc", "line", F.col("first.fd").alias("first_doc"), F.col("first.fl").alias("first_line"))


def dedup_lines(df: DataFrame, edits: int = EDITS, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text: str = "text", rate: int | None = None, short: bool = False) -> DataFrame:
    """``df`` with ``text`` cut to the lines that stay; adds ``n_lines`` and ``n_removed``.

    Null texts stay null (no lines), as do rows with a null id, which are left
    alone.  A text of which every line goes becomes empty.  Rows that share an id
    are documents of their own, in the order of a hash of their texts; of rows that
    are equal one stays whole.  An empty table stays empty; columns named like the
    new ones are replaced.
    """
    df, _ = numbered(df.drop("n_lines", "n_removed"), id_col, text)
    gone = repeated_lines(df, edits, min_bytes, text, rate, short).groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("line").alias("__gone"))
    out = df.join(gone, F.col("__row") == F.col("__doc"), "left")
    lines = F.split(text, "\n", -1)
    left = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(F.filter(lines, lambda x, k: ~F.array_contains("__gone", k)), "\n"))
    # Only texts that lose a line are split.
    count = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    return out.select(*[left.alias(text) if c == text else F.col(c) for c in df.columns if c != "__row"], count.cast("long").alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"))
