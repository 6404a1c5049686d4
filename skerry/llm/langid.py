"""Language identification by a byte convolutional network, in numpy.

A text's UTF-8 bytes are cut into fixed windows (the last one padded with
zeros).  Bytes are embedded, filters of several widths slide over the window
with stride 2, each filter keeps its maximum, and a softmax layer gives a
distribution for the window.  A text's distribution is the mean over all of its
windows, weighted by their bytes.

The network is trained on the driver on a bounded sample: ``per_lang`` documents
of each language, the first by a hash of their id, and at most ``per_doc``
windows spread over each.  Applying it is a map over batches without a shuffle;
a batch is worked off in slices, so memory does not follow the text length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW, WIDTHS, FILTERS, DIM, STRIDE = 240, (3, 4, 6), 10, 8, 2
BLOCK = max(WIDTHS)
PER_LANG, PER_DOC, EPOCHS, BATCH, SEED = 400, 12, 8, 128, 11
SLICE_BYTES = 1 << 20


def cut(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as rows of bytes, and how many each text has (one at least)."""
    padded = [t + b"\0" * (-len(t) % window or (0 if t else window)) for t in texts]
    flat = np.frombuffer(b"".join(padded), dtype=np.uint8)
    return flat.reshape(-1, window), np.array([len(p) // window for p in padded])


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray  # (256, DIM); byte 0 stays at zero
    kernel: np.ndarray  # (BLOCK * DIM, filters)
    bias: np.ndarray
    top: np.ndarray
    top_bias: np.ndarray

    def pooled(self, win: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each filter's maximum per window, and where it stood.

        Filters start at every STRIDE-th byte: one matrix product for each phase
        of the widest filter, on views of the embedded stream.
        """
        n, width = win.shape
        flat = np.concatenate([win.reshape(-1), np.zeros(BLOCK, np.uint8)])
        x = self.embed[flat]
        k = width // BLOCK
        best = at = None
        for p in range(0, BLOCK, STRIDE):
            out = (x[p : p + n * width].reshape(-1, BLOCK * DIM) @ self.kernel).reshape(n, k, -1)
            if p:
                out = out[:, :-1]  # the last block reaches into the next window
            top = out.max(1)
            if where:
                pos = out.argmax(1) * BLOCK + p
                at = pos if at is None else np.where(top > best, pos, at)
            best = top if best is None else np.maximum(best, top)
        return best, at

    def probabilities(self, win: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(win)[0] + self.bias, 0) @ self.top + self.top_bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index and mean probability of the likeliest language of each text."""
        win, counts = cut(texts)
        p = np.concatenate([self.probabilities(win[i : i + SLICE_BYTES // WINDOW]) for i in range(0, len(win), SLICE_BYTES // WINDOW)])
        p *= np.maximum((win != 0).sum(1), 1)[:, None]
        total = np.add.reduceat(p, np.concatenate([[0], counts.cumsum()[:-1]]))
        total /= total.sum(1, keepdims=True)
        best = total.argmax(1)
        return best, total[np.arange(len(best)), best]


def train(win: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = EPOCHS) -> Net:
    """Adam on the mean cross-entropy of the windows; the same input gives the same net."""
    rng = np.random.default_rng(SEED)
    filters = FILTERS * len(WIDTHS)
    mask = np.zeros((BLOCK * DIM, filters), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[: w * DIM, i * FILTERS : (i + 1) * FILTERS] = 1
    f32 = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    net = Net(langs, f32(256, DIM, scale=0.5), f32(BLOCK * DIM, filters, scale=0.2) * mask, np.zeros(filters, np.float32), f32(filters, len(langs), scale=0.2), np.zeros(len(langs), np.float32))
    net.embed[0] = 0
    weight = (len(y) / len(langs) / np.maximum(np.bincount(y, minlength=len(langs)), 1)).astype(np.float32)
    params = ["embed", "kernel", "bias", "top", "top_bias"]
    m1, m2, step = {k: 0.0 for k in params}, {k: 0.0 for k in params}, 0
    steps = max(1, -(-len(y) // BATCH))
    for epoch in range(max(epochs, -(-200 // steps))):
        order = rng.permutation(len(y))
        rate = 0.01 * 0.5 ** (epoch * 4 / max(epochs, 1))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            best, at = net.pooled(win[rows], where=True)
            h = np.maximum(best + net.bias, 0)
            z = h @ net.top + net.top_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (weight[y[rows]] / len(rows))[:, None]
            dh = (p @ net.top.T) * (h > 0)
            taken = win[rows][np.arange(len(rows))[:, None, None], np.minimum(at[:, :, None] + np.arange(BLOCK), win.shape[1] - 1)]  # (rows, filters, BLOCK) bytes
            x = net.embed[taken].reshape(len(rows), filters, -1)
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, taken, (dh[:, :, None] * net.kernel.T[None]).reshape(*taken.shape, DIM))
            d_embed[0] = 0
            grads = {"embed": d_embed, "kernel": np.einsum("nf,nfk->kf", dh, x) * mask, "bias": dh.sum(0), "top": h.T @ p, "top_bias": p.sum(0)}
            step += 1
            for k in params:
                m1[k] = 0.9 * m1[k] + 0.1 * grads[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grads[k] ** 2
                move = rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - move).astype(np.float32))
    return net


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text is divisible by 5; a null id isn't one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Net | None:
    """Trains on ``per_lang`` documents a language; None where no row has a language and text.

    Ranks are cut to ``per_lang`` before the shuffle, so that a language with
    most of the rows costs no more than others.  Rows without an id, a text or a
    language, and held-out rows, are left out.
    """
    rank = F.row_number().over(Window.partitionBy(lang).orderBy(F.xxhash64(id_col), id_col))
    ids = docs.filter(F.col(lang).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col, lang).withColumn("__r", rank).filter(F.col("__r") <= per_lang)
    ids = ids.select(F.col(id_col).alias("__id"), F.col(lang).alias("__lang")).distinct()
    some = docs.filter(F.length(text) > 0).join(F.broadcast(ids), (F.col(id_col) == F.col("__id")) & (F.col(lang) == F.col("__lang")))  # per_lang ids a language

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, got = [], []
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = cut([t.encode()])[0]
                for k in np.unique(np.linspace(0, len(w) - 1, per_doc).astype(int)):
                    names.append(name)
                    got.append(w[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(got, pa.binary())], names=["lang", "bytes"])

    rows = sorted(tuple(r) for r in some.select("__lang", text).mapInArrow(windows, "lang string, bytes binary").collect())
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    win = np.frombuffer(b"".join(bytes(r[1]) for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(win, np.array([langs.index(r[0]) for r in rows]), langs)


def identify(docs: DataFrame, net: Net | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learnt.  Whole texts are read; every other column is handed through.
    """
    docs = docs.drop("lang_pred", "score")
    schema = docs.drop(text).withColumns({"lang_pred": F.lit("x"), "score": F.lit(0.0)}).schema
    names = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(names_all.index(text))
            langs, scores = ["und"] * b.num_rows, np.zeros(b.num_rows)
            at, part, size = [], [], 0
            for i in range(b.num_rows + 1):
                if part and (i == b.num_rows or size > SLICE_BYTES):
                    best, p = net.predict(part)
                    for k, j, s in zip(at, best, p, strict=True):
                        langs[k], scores[k] = net.langs[j], s
                    at, part, size = [], [], 0
                if i < b.num_rows and net is not None and (t := column[i].as_py()) and any(map(str.isalpha, t)):
                    at.append(i)
                    part.append(t.encode())
                    size += len(part[-1])
            yield pa.RecordBatch.from_arrays([*[b.column(names_all.index(c)) for c in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    names_all = docs.columns
    return docs.mapInArrow(run, schema)
