"""Grid and tile generators, and a decoder for vector tiles."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sub_grid(cells: DataFrame, step: float = 1.0) -> DataFrame:
    """Each cell cut into ``step``-degree boxes, numbered row by row from the south-west; the last ones may be narrower."""
    span = lambda a, b: F.greatest(F.ceil((F.col(b) - F.col(a)) / step).cast("int"), F.lit(0))
    nx, ny = span("sw_lon", "ne_lon"), span("sw_lat", "ne_lat")
    rows = cells.withColumn("__nx", nx).filter((nx > 0) & (ny > 0)).withColumn("sub", F.explode(F.sequence(F.lit(0), nx * ny - 1)))
    x, y = F.col("sub") % F.col("__nx"), F.floor(F.col("sub") / F.col("__nx"))
    west, south = F.col("sw_lon") + x * step, F.col("sw_lat") + y * step
    return rows.select(*cells.columns, "sub", west.alias("west"), south.alias("south"), F.least(west + step, F.col("ne_lon")).alias("east"), F.least(south + step, F.col("ne_lat")).alias("north"))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """The ``(number, wire type, value)`` fields of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            value, at = data[at : at + n], at + n
        elif wire == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {wire}")
        yield key >> 3, wire, value


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _value(data: bytes):
    """A tag value: string, float, double, int, uint, sint or bool by field number."""
    for number, _, v in _fields(data):
        match number:
            case 1:
                return v.decode("utf-8", "replace")
            case 2:
                return struct.unpack("<f", v)[0]
            case 3:
                return struct.unpack("<d", v)[0]
            case 4:
                return _signed(v)
            case 5:
                return v
            case 6:
                return (v >> 1) ^ -(v & 1)
            case 7:
                return bool(v)
    return None


def decode_tile(data: bytes, layer: str | None = None) -> list[dict]:
    """Properties of every feature of a vector tile, of one layer or of all."""
    out = []
    for number, _, body in _fields(data):
        if number != 3:
            continue
        name, keys, values, features = "", [], [], []
        for k, _, v in _fields(body):
            if k == 1:
                name = v.decode()
            elif k == 2:
                features.append(v)
            elif k == 3:
                keys.append(v.decode())
            elif k == 4:
                values.append(_value(v))
        if layer is not None and name != layer:
            continue
        for f in features:
            tags: list[int] = []
            for k, _, v in _fields(f):
                if k == 2:
                    at = 0
                    while at < len(v):
                        t, at = _varint(v, at)
                        tags.append(t)
            out.append({keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=False) if a < len(keys) and b < len(values)})
    return out


def tile_features(tiles: DataFrame, layer: str = "image") -> DataFrame:
    """``(path, content)`` rows -> ``(path, id, sequence_id, captured_at)``; a tile that can't be decoded has an ``error``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    for p in decode_tile(bytes(content), layer):
                        rows.append((path, None if p.get("id") is None else str(p["id"]), p.get("sequence_id"), p.get("captured_at"), None))
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((path, None, None, None, str(e)[:200] or "torn tile"))
            yield pd.DataFrame(rows, columns=["path", "id", "sequence_id", "captured_at", "error"]).astype({"captured_at": "Int64"})

    return tiles.select("path", "content").mapInPandas(run, "path string, id string, sequence_id string, captured_at long, error string")
