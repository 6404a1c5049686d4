"""TIFF media columns: writing texts as images, and reading any baseline TIFF back.

``decode`` walks the chain of image directories in either byte order, gathers
strips or tiles, undoes PackBits, LZW or deflate and the horizontal predictor,
and gives one page per directory.  ``encode`` writes the same forms.
``tiff_pages`` turns a binary column into one row per page.

Damage is data, not an exception: a page that cannot be read has its reason in
``error`` and no pixels; bytes that are no TIFF give one such page; null gives
none.  A directory chain that loops ends where it would repeat.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Tag numbers, compression codes and field sizes of the TIFF 6.0 format.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
NONE, LZW, ADOBE_DEFLATE, PACKBITS, DEFLATE = 1, 5, 8, 32773, 32946
FIELD_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
CLEAR, END, FIRST_FREE = 256, 257, 258

MAX_DIMENSION = 1 << 31


class TiffError(ValueError):
    """What is wrong with a page or a file."""


@dataclass
class Page:
    page: int
    width: int = 0
    height: int = 0
    samples: int = 0
    compression: int = 0
    predictor: int = 1
    tiled: bool = False
    chunks: int = 0
    pixels: bytes | None = None
    error: str | None = None


def packbits_encode(data: bytes) -> bytes:
    """Runs of three or more equal bytes become a repeat, the rest literals of 128 at most."""
    out = bytearray()
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    edges = np.flatnonzero(np.diff(a)) + 1
    starts = np.concatenate([[0], edges])
    lengths = np.diff(np.concatenate([starts, [len(a)]]))
    long_ = lengths >= 3
    at = 0

    def literal(end: int) -> None:
        nonlocal at
        while at < end:
            n = min(128, end - at)
            out.append(n - 1)
            out.extend(data[at : at + n])
            at += n

    for s, n in zip(starts[long_].tolist(), lengths[long_].tolist(), strict=True):
        literal(s)
        while n:
            k = min(128, n)
            out.extend((257 - k, data[s]) if k > 1 else (0, data[s]))
            n -= k
            at += k
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < size:
        c = data[i]
        if c < 128:
            out += data[i + 1 : i + 2 + c]
            i += c + 2
        elif c > 128:
            out += data[i + 1 : i + 2] * (257 - c)
            i += 2
        else:
            i += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first, codes widened one entry early, as the format asks."""
    codes: list[int] = [CLEAR]
    widths: list[int] = [9]
    table = {bytes([k]): k for k in range(256)}
    base = dict(table)
    free, width, now = FIRST_FREE, 9, b""
    for k in range(len(data)):
        c = data[k : k + 1]
        longer = now + c
        if longer in table:
            now = longer
            continue
        codes.append(table[now])
        widths.append(width)
        table[longer] = free
        free += 1
        if free > (1 << width) - 1:
            width += 1
        if free == 4095:
            codes.append(CLEAR)
            widths.append(min(width, 12))
            table, free, width = dict(base), FIRST_FREE, 9
        now = c
    if now:
        codes.append(table[now])
        widths.append(width)
        if free + 1 > (1 << width) - 1:
            width = min(width + 1, 12)
    codes.append(END)
    widths.append(width)
    w = np.array(widths)
    spread = (np.array(codes)[:, None] >> (w[:, None] - 1 - np.arange(12))) & 1
    return np.packbits(spread.astype(np.uint8)[np.arange(12) < w[:, None]]).tobytes()


def lzw_decode(data: bytes, size: int) -> bytes:
    out: list[bytes] = []
    base = [bytes([k]) for k in range(256)] + [b"", b""]
    table, width, before, total = list(base), 9, None, 0
    bits, have, i, n = 0, 0, 0, len(data)
    while total < size:
        while have < width:
            if i >= n:
                return b"".join(out)
            bits = (bits << 8) | data[i]
            have += 8
            i += 1
        code = (bits >> (have - width)) & ((1 << width) - 1)
        have -= width
        bits &= (1 << have) - 1
        if code == CLEAR:
            table, width, before = list(base), 9, None
            continue
        if code == END:
            break
        if code < len(table):
            entry = table[code]
        elif code == len(table) and before is not None:
            entry = before + before[:1]
        else:
            raise TiffError("an LZW code before its entry")
        if before is not None:
            table.append(before + entry[:1])
        elif code > 255:
            raise TiffError("an LZW stream that starts with no byte")
        out.append(entry)
        total += len(entry)
        before = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def _squeeze(data: bytes, compression: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return packbits_encode(data)
    if compression == LZW:
        return lzw_encode(data)
    if compression in (ADOBE_DEFLATE, DEFLATE):
        return zlib.compress(data, 6)
    raise TiffError(f"compression {compression}")


def _expand(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return packbits_decode(data, size)
    if compression == LZW:
        return lzw_decode(data, size)
    if compression in (ADOBE_DEFLATE, DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, size)
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from None
    raise TiffError(f"compression {compression}")


def encode(payload: bytes, width: int = 64, samples: int = 3, compression: int = ADOBE_DEFLATE, predictor: int = 1, rows_per_strip: int = 64, tile: int = 0, max_rows: int = 4096) -> bytes:
    """8-bit samples, row by row, as a little-endian TIFF of one page per ``max_rows`` rows.

    ``payload`` must fill whole rows, one at least.  ``tile``: side of square
    tiles (a multiple of 16) instead of strips; tiles that overhang are padded
    with zeros.
    """
    row = width * samples
    if not payload or len(payload) % row:
        raise TiffError(f"a payload must fill rows of {row} bytes")
    image = np.frombuffer(payload, np.uint8).reshape(-1, width, samples)
    out = bytearray(struct.pack("<2sHI", b"II", 42, 0))
    link = 4
    for top in range(0, len(image), max_rows):
        page = image[top : top + max_rows]
        high = len(page)
        if tile:
            full = np.zeros((-(-high // tile) * tile, -(-width // tile) * tile, samples), np.uint8)
            full[:high, :width] = page
            parts = [full[y : y + tile, x : x + tile] for y in range(0, len(full), tile) for x in range(0, full.shape[1], tile)]
        else:
            parts = [page[y : y + rows_per_strip] for y in range(0, high, rows_per_strip)]
        at, sizes = [], []
        for part in parts:
            if predictor == 2:
                part = part.copy()
                part[:, 1:] -= part[:, :-1].copy()
            data = _squeeze(part.tobytes(), compression)
            at.append(len(out))
            sizes.append(len(data))
            out += data
            out += b"\0" * (len(out) % 2)
        fields = [(WIDTH, 4, [width]), (LENGTH, 4, [high]), (BITS, 3, [8] * samples), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [2 if samples == 3 else 1]), (SAMPLES, 3, [samples]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor])]
        fields += [(TILE_WIDTH, 4, [tile]), (TILE_LENGTH, 4, [tile]), (TILE_OFFSETS, 4, at), (TILE_COUNTS, 4, sizes)] if tile else [(STRIP_OFFSETS, 4, at), (ROWS_PER_STRIP, 4, [rows_per_strip]), (STRIP_COUNTS, 4, sizes)]
        entries = b""
        for tag, kind, values in sorted(fields):
            raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                where = len(out)
                out += raw
                out += b"\0" * (len(out) % 2)
                raw = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        link = len(out) + 2 + 12 * len(fields)
        out += struct.pack("<H", len(fields)) + entries + struct.pack("<I", 0)
    return bytes(out)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, list[int]], int]:
    """The number fields of a directory, and where the next one is."""
    try:
        (n,) = struct.unpack_from(order + "H", data, at)
        fields: dict[int, list[int]] = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            size = FIELD_SIZE.get(kind, 0) * count
            where = at + 10 + 12 * k
            if size > 4:
                (where,) = struct.unpack_from(order + "I", data, where)
            if kind in (1, 3, 4):
                if where + size > len(data):
                    raise TiffError(f"tag {tag} points outside the file")
                fields[tag] = list(struct.unpack_from(f"{order}{count}{'BxHI'[kind - 1] if kind != 1 else 'B'}", data, where))
        (after,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    except struct.error:
        raise TiffError("a directory outside the file") from None
    return fields, after


def _read_page(data: bytes, f: dict[int, list[int]], page: Page) -> None:
    one = lambda tag, default=None: f.get(tag, [default])[0] if f.get(tag, [default]) else default
    page.width, page.height, page.samples = one(WIDTH, 0), one(LENGTH, 0), one(SAMPLES, 1)
    page.compression, page.predictor, page.tiled = one(COMPRESSION, NONE), one(PREDICTOR, 1), TILE_OFFSETS in f
    if not 0 < page.width * page.height * page.samples < MAX_DIMENSION:
        raise TiffError("a page without area, or too large")
    if set(f.get(BITS, [1])) != {8}:
        raise TiffError("only 8-bit samples are read")
    if page.predictor not in (1, 2):
        raise TiffError(f"predictor {page.predictor}")
    planar = one(PLANAR, 1) == 2 and page.samples > 1
    deep, planes = (1, page.samples) if planar else (page.samples, 1)
    if page.tiled:
        tall, wide = one(TILE_LENGTH, 0), one(TILE_WIDTH, 0)
        offsets, counts = f[TILE_OFFSETS], f.get(TILE_COUNTS, [])
    else:
        tall, wide = min(one(ROWS_PER_STRIP, page.height), page.height), page.width
        offsets, counts = f.get(STRIP_OFFSETS, []), f.get(STRIP_COUNTS, [])
    if not tall or not wide:
        raise TiffError("strips or tiles without area")
    down, across = -(-page.height // tall), -(-page.width // wide)
    page.chunks = len(offsets)
    if len(offsets) < down * across * planes or len(counts) < len(offsets):
        raise TiffError("strips or tiles are missing")
    image = np.zeros((page.height, page.width, page.samples), np.uint8)
    for k in range(down * across * planes):
        plane, rest = divmod(k, down * across)
        y, x = rest // across * tall, rest % across * wide
        high = tall if page.tiled else min(tall, page.height - y)
        size = high * wide * deep
        if offsets[k] + counts[k] > len(data):
            raise TiffError("a strip or tile outside the file")
        raw = _expand(data[offsets[k] : offsets[k] + counts[k]], page.compression, size)
        if len(raw) < size:
            raise TiffError("a strip or tile is too short")
        part = np.frombuffer(raw[:size], np.uint8).reshape(high, wide, deep)
        if page.predictor == 2:
            part = np.cumsum(part, axis=1, dtype=np.uint8)
        part = part[: page.height - y, : page.width - x]
        image[y : y + high, x : x + wide, plane : plane + deep] = part
    page.pixels = image.tobytes()


def decode(data: bytes) -> list[Page]:
    """Every page of a TIFF, in the order of its directories."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        return [Page(0, error="not a TIFF")]
    (at,) = struct.unpack_from(order + "I", data, 4)
    pages, seen = [], set()
    while at and at not in seen:
        seen.add(at)
        page = Page(len(pages))
        pages.append(page)
        try:
            fields, at = _directory(data, at, order)
        except TiffError as e:
            page.error = str(e)
            break
        try:
            _read_page(data, fields, page)
        except TiffError as e:
            page.pixels, page.error = None, str(e)
    return pages or [Page(0, error="no directory")]


PAGE_FIELDS = [("page", T.IntegerType()), ("width", T.IntegerType()), ("height", T.IntegerType()), ("samples", T.IntegerType()), ("compression", T.IntegerType()), ("predictor", T.IntegerType()), ("tiled", T.BooleanType()), ("chunks", T.IntegerType()), ("pixels", T.BinaryType()), ("error", T.StringType())]


def _arrow(kind: T.DataType) -> pa.DataType:
    return {T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.StringType: pa.string()}[type(kind)]


def tiff_pages(df: DataFrame, media: str, chunk_bytes: int = 16 << 20) -> DataFrame:
    """One row per page: the other columns of ``df`` and the page's fields.

    Clashing columns of ``df`` are replaced.  Pages are handed on once they fill
    ``chunk_bytes``, so a batch of large files needs no more memory than one.
    """
    names = [n for n, _ in PAGE_FIELDS]
    keep = [c for c in df.columns if c != media and c not in names]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, k) for n, k in PAGE_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, pages, size = [], [], 0
            for i in range(b.num_rows):
                data = b.column(0)[i].as_py()
                for p in decode(data) if data is not None else []:
                    rows.append(i)
                    pages.append(p)
                    size += len(p.pixels or b"")
                if size > chunk_bytes or i == b.num_rows - 1:
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([*[b.column(1 + k).take(at) for k in range(len(keep))], *[pa.array([getattr(p, n) for p in pages], _arrow(t)) for n, t in PAGE_FIELDS]], names=[*keep, *names])
                    rows, pages, size = [], [], 0

    return df.select(media, *keep).mapInArrow(run, schema)


UNIT = 192  # bytes of a row of 64 RGB pixels

#: How the text archive stores a payload, by its crc32 modulo the table's
#: length: mostly deflate, and every other form the format knows beside it.
FORMS = (
    {"compression": LZW},
    {"compression": PACKBITS},
    {"compression": DEFLATE, "predictor": 2},
    {"compression": ADOBE_DEFLATE, "tile": 32, "predictor": 2},
    {"compression": ADOBE_DEFLATE, "tile": 64},
    {"compression": ADOBE_DEFLATE},
    {"compression": ADOBE_DEFLATE, "rows_per_strip": 16},
    {"compression": ADOBE_DEFLATE, "rows_per_strip": 256},
)
PAGE_ROWS = 256


def pad(raw: bytes, unit: int = UNIT) -> bytes:
    """Blanks up to a positive multiple of ``unit``."""
    return raw + b" " * (-len(raw) % unit if raw else unit)


def store(payload: bytes) -> bytes:
    """A payload as a TIFF whose form depends on the payload alone."""
    return encode(payload, **FORMS[zlib.crc32(payload) % len(FORMS)], max_rows=PAGE_ROWS)


def feature(pages: list[Page], payload: bytes) -> str:
    """Pages, form, and a 64-bit hash of which parts of the image are brighter than its mean."""
    a = np.frombuffer(payload, np.uint8)
    edges = np.arange(64) * len(a) // 64
    sums = np.add.reduceat(a.astype(np.int64), edges)
    counts = np.diff(np.append(edges, len(a)))
    bits = sums * len(a) > int(a.sum(dtype=np.int64)) * counts
    p = pages[0]
    return f"{len(pages)}p-c{p.compression}-d{p.predictor}-{'t' if p.tiled else 's'}{p.chunks}-{np.packbits(bits).tobytes().hex()}"


def archive(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Stores every text as a TIFF, reads the stored bytes back, and describes both.

    Null counts as empty, which is one row of blanks.  Other columns are left
    out.  Equal texts give equal values.
    """
    schema = T.StructType([df.schema[id_col], *[T.StructField(n, k) for n, k in (("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()), ("pages", T.IntegerType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for i in range(b.num_rows):
                raw = (b.column(1)[i].as_py() or "").encode()
                media = store(pad(raw))
                pages = decode(media)
                if bad := next((p.error for p in pages if p.error), None):
                    raise TiffError(bad)
                back = b"".join(p.pixels for p in pages)
                for c, v in zip(cols, (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(pages, back), len(pages)), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.string() if isinstance(f.dataType, T.StringType) else pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.int64()) for c, f in zip(cols, schema.fields[1:], strict=True)]], names=schema.names)

    return df.select(id_col, text).mapInArrow(run, schema)
