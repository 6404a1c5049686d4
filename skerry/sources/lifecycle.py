"""A store of part pairs: ordered commits, compaction, and a journal that can be undone.

A part is a folder of detections and one of images.  Neither counts until an entry
of the journal names it; an entry is written to a hidden file and renamed, and so is
whole or absent.  An entry may replace earlier parts.  The table is what entries
name and no entry replaces: a stop between any two steps leaves the state before or
after, never a mixture.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import _fs

DET, IMG = "det", "img"


def write_payload(spark: SparkSession, path: str, payload: object) -> None:
    """A small object as one JSON document: a hidden file first, then one rename; an existing file stays."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps(payload, sort_keys=True).encode()))
    out.hsync()
    out.close()
    if not fs.rename(hidden, _fs(spark, path)[1]):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def journal(spark: SparkSession, root: str) -> list[dict]:
    """The entries, oldest first; a folder without a journal has none."""
    fs, at = _fs(spark, f"{root}/journal")
    if not fs.exists(at):
        return []
    names = sorted(x.getPath().getName() for x in fs.listStatus(at))
    names = [n for n in names if n.endswith(".json") and not n.startswith(".")]
    text = spark.read.text([f"{root}/journal/{n}" for n in names], wholetext=True) if names else None
    return sorted((json.loads(r[0]) for r in text.collect()), key=lambda e: e["number"]) if names else []


def live_parts(spark: SparkSession, root: str) -> list[str]:
    entries = journal(spark, root)
    gone = {p for e in entries for p in e["replaces"]}
    return [e["part"] for e in entries if e["part"] not in gone]


def commit_part(det: DataFrame, img: DataFrame, root: str, replaces: list[str] | None = None, stop_after: str | None = None) -> str | None:
    """Detections, then images, then the entry that makes them count; the part's name.

    ``stop_after`` (``det`` or ``img``) leaves off there, as a crash would.
    """
    spark = det.sparkSession
    entries = journal(spark, root)
    number = entries[-1]["number"] + 1 if entries else 0
    part = f"p{number:09d}-{uuid.uuid4().hex}"
    for kind, df in ((DET, det), (IMG, img)):
        df.write.option("compression", "zstd").parquet(f"{root}/{part}/{kind}")
        if stop_after == kind:
            return None
    fs, at = _fs(spark, f"{root}/journal")
    fs.mkdirs(at)
    write_payload(spark, f"{root}/journal/{number:09d}.json", {"number": number, "part": part, "replaces": replaces or []})
    return part


def read_part_kind(spark: SparkSession, root: str, kind: str, parts: list[str] | None = None) -> DataFrame:
    """Detections or images of the live parts; an error where there is none."""
    parts = live_parts(spark, root) if parts is None else parts
    return spark.read.parquet(*[f"{root}/{p}/{kind}" for p in parts])


def _digest(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


def compact(spark: SparkSession, root: str, det_order: list[str], img_order: list[str], files: int = 1, stop_after: str | None = None) -> str | None:
    """All live parts as one pair, each side ordered by key; counts once it holds the same rows.

    Rows are compared by their number and the sum of their hashes before the entry
    is written.  Replaced parts stay for ``undo`` until ``sweep``.
    """
    old = live_parts(spark, root)
    if len(old) < 2:
        return None
    entries = journal(spark, root)
    number = entries[-1]["number"] + 1
    part = f"p{number:09d}-{uuid.uuid4().hex}"
    for kind, order in ((DET, det_order), (IMG, img_order)):
        whole = read_part_kind(spark, root, kind, old)
        whole.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(f"{root}/{part}/{kind}")
        if _digest(spark.read.parquet(f"{root}/{part}/{kind}")) != _digest(whole):
            raise ValueError(f"the compacted {kind} rows differ; the store is unchanged")
        if stop_after == kind:
            return None
    write_payload(spark, f"{root}/journal/{number:09d}.json", {"number": number, "part": part, "replaces": old})
    return part


def undo(spark: SparkSession, root: str) -> bool:
    """Takes back the newest entry; false where there is none or what it replaced was swept."""
    entries = journal(spark, root)
    if not entries:
        return False
    fs, at = _fs(spark, f"{root}/journal/{entries[-1]['number']:09d}.json")
    if not all(fs.exists(_fs(spark, f"{root}/{p}/{IMG}")[1]) for p in entries[-1]["replaces"]):
        return False
    return fs.delete(at, False)


def sweep(spark: SparkSession, root: str) -> int:
    """Deletes every folder that is no live part: replaced ones and what crashes left; how many."""
    keep = {"journal", *live_parts(spark, root)}
    fs, at = _fs(spark, root)
    names = [x.getPath() for x in fs.listStatus(at) if x.getPath().getName() not in keep]
    for p in names:
        fs.delete(p, True)
    return len(names)
