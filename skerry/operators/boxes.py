"""Greedy one-to-one matching of boxes, per image."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELDS = "image_id long, pred_idx int, truth_idx int, iou double"
_BOX = ["x1", "y1", "x2", "y2"]
#: Pairs of boxes that are held at once.
PAIRS = 1_000_000


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of the boxes of ``a`` and ``b``, row by row; 0 where the union has no area."""
    w = np.clip(np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]), 0, None)
    h = np.clip(np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]), 0, None)
    area = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = area(a) + area(b) - w * h
    return np.divide(w * h, union, out=np.zeros_like(w), where=union > 0)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``counts`` of rows: the owner of each row, and its number there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def match_images(image: np.ndarray, truth: np.ndarray, box: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row the row it is matched with, or -1, and their overlap.

    Rows are sorted by ``image`` (numbers from 0); an image's predictions come
    first, in the order in which they choose, then its truths.  All images choose
    at once, a turn for each place in that order.
    """
    n_images = int(image[-1]) + 1 if len(image) else 0
    preds, truths = np.flatnonzero(~truth), np.flatnonzero(truth)
    n_pred, n_truth = np.bincount(image[preds], minlength=n_images), np.bincount(image[truths], minlength=n_images)
    first_truth = np.cumsum(n_truth) - n_truth
    _, turn = _spread(n_pred)
    partner, over, free = np.full(len(image), -1), np.full(len(image), np.nan), np.ones(len(image), bool)
    order = np.argsort(turn, kind="stable")
    most = np.cumsum(n_truth[image[preds[order]]])
    at = 0
    while at < len(order):
        # As many predictions, earlier turns first, as make a bounded number of pairs.
        end = max(at + 1, int(np.searchsorted(most, (most[at - 1] if at else 0) + PAIRS, "right")))
        who = preds[order[at:end]]
        owner, k = _spread(n_truth[image[who]])
        with_ = truths[first_truth[image[who]][owner] + k]
        iou = _overlaps(box[who][owner], box[with_])
        keep = iou >= threshold
        owner, with_, iou = owner[keep], with_[keep], iou[keep]
        by = np.lexsort((with_, -iou, owner))
        owner, with_, iou = owner[by], with_[by], iou[by]
        turns = turn[order[at:end]]
        cuts = np.searchsorted(turns[owner], np.unique(turns))
        for lo, hi in zip(cuts, [*cuts[1:], len(owner)], strict=True):
            left = lo + np.flatnonzero(free[with_[lo:hi]])
            best = left[np.flatnonzero(np.diff(owner[left], prepend=-1))]
            p, t = who[owner[best]], with_[best]
            free[t] = False
            partner[p], partner[t], over[p] = t, p, iou[best]
        at = end
    return partner, over


def greedy_match(pred: DataFrame, truth: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Predictions in descending confidence take the best free truth at ``threshold`` or more.

    ``pred``: image_id, idx, conf, x1, y1, x2, y2; ``truth``: the same without
    conf.  Unmatched predictions have a null ``truth_idx``, unmatched truths a null
    ``pred_idx``.  Images are sorted inside a partition and matched many at a time;
    an image's boxes are one task's work: their number is bounded by the detector,
    not by the corpus.
    """
    known = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    side = lambda df, is_truth, conf: df.select(F.col("image_id").cast("long").alias("image_id"), F.lit(is_truth).alias("truth"), conf.alias("conf"), F.col("idx").cast("int").alias("idx"), *[known(c).alias(c) for c in _BOX])
    order: list[str | Column] = ["image_id", "truth", F.desc_nulls_last("conf"), F.asc_nulls_last("idx"), *_BOX]
    rows = side(pred, False, known("conf")).union(side(truth, True, F.lit(None).cast("double")))

    def matched(b: pa.Table) -> pa.RecordBatch:
        ids = b.column("image_id").combine_chunks()
        null, value = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
        new = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
        is_truth = np.asarray(b.column("truth").combine_chunks().to_numpy(zero_copy_only=False), bool)
        box = np.stack([b.column(c).to_numpy().astype(float) for c in _BOX], axis=1)
        partner, over = match_images(np.concatenate([[0], np.cumsum(new)]), is_truth, box, threshold)
        out = np.flatnonzero(~is_truth | (partner < 0))
        here, other = pa.array(out), pa.array(partner[out], mask=partner[out] < 0)
        idx, t = b.column("idx").combine_chunks(), is_truth[out]
        own, theirs = idx.take(here), idx.take(other)
        none = pa.nulls(len(out), pa.int32())
        pick = lambda a, c: pc.if_else(pa.array(t), a, c)
        return pa.RecordBatch.from_arrays([ids.take(here), pick(none, own), pick(own, theirs), pa.array(over[out], mask=partner[out] < 0)], names=["image_id", "pred_idx", "truth_idx", "iou"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            # The last image of a batch may go on in the next one.
            ids = b.column("image_id")
            last = ids[b.num_rows - 1].as_py()
            if held and held[0].column("image_id")[0].as_py() == last and ids[0].as_py() == last:
                held.append(b)
                continue
            same = np.asarray(ids.is_null()) if last is None else np.asarray(ids.fill_null(last + 1 if last < 0 else last - 1)) == last
            cut = int(np.argmax(same))
            if held or cut:
                yield matched(pa.Table.from_batches([*held, b.slice(0, cut)]))
            held = [b.slice(cut)]
        if held:
            yield matched(pa.Table.from_batches(held))

    return rows.repartition("image_id").sortWithinPartitions(*order).mapInArrow(run, _FIELDS)
