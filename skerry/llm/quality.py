"""Quality classifier: a sparse rule ensemble compiled into Column expressions.

Statistics of a text are plain SQL expressions.  A few hundred small regression
trees are boosted on a bounded sample of labelled rows; every path from a root
to a node is a conjunction of comparisons, that is a rule.  A lasso logistic
regression over the rules' 0/1 values keeps the few that matter, and the kept
rules with their weights become one Column expression: scoring is a scan with
neither Python nor a shuffle.

Only the sample (``max_rows`` labelled rows, the first by a hash of their id)
reaches the driver; its size does not grow with the corpus.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, words
from .rules import SYMBOLS

MAX_ROWS, TREES, DEPTH, BINS, SEED = 4000, 60, 3, 24, 7
PENALTIES = (0.03, 0.01, 0.003, 0.001)


def _count(text: Column, keep: str) -> Column:
    """Characters of the class ``keep``."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", ""))


def _per(a: Column, b: Column) -> Column:
    return F.coalesce(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))


def statistics(df: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """Adds the statistics as ``__s_*`` columns; names them.  Null counts as empty: all are 0."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({"__w": words(body), "__l": F.filter(F.split(body, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")), "__c": F.length(F.regexp_replace(body, SPACE, ""))})
    n = F.size("__w")
    same = F.filter(F.zip_with(F.slice("__w", 1, F.greatest(n - 1, F.lit(0))), F.slice("__w", 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b), lambda x: x)
    letters = _count(body, "\\p{L}")
    found = {
        "words": F.log1p(n.cast("double")),
        "word_chars": _per(F.col("__c"), n),
        "distinct": _per(F.size(F.array_distinct("__w")), n),
        "repeats_previous": _per(F.size(same), n),
        "one_char": _per(F.size(F.filter("__w", lambda w: F.length(w) == 1)), n),
        "upper": _per(_count(body, "\\p{Lu}"), letters),
        "letters": _per(letters, F.col("__c")),
        "digits": _per(_count(body, "0-9"), F.col("__c")),
        "symbols": _per(_count(body, SYMBOLS), n),
        "bangs": _per(_count(body, "!?"), n),
        "stops": _per(_count(body, ".,;:"), n),
        "line_words": _per(n, F.size("__l")),
        "duplicate_lines": _per(F.size("__l") - F.size(F.array_distinct("__l")), F.size("__l")),
        "other_bytes": _per(F.octet_length(body) - F.length(body), F.col("__c")),
    }
    names = [f"__s_{k}" for k in found]
    return df.withColumns(dict(zip(names, found.values(), strict=True))).drop("__w", "__l", "__c"), names


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(feature, above, threshold)`` and its weight."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        return functools.reduce(operator.and_, ((x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in self.terms))

    def column(self, names: list[str]) -> Column:
        return functools.reduce(operator.and_, ((F.col(names[f]) > t) if above else (F.col(names[f]) <= t) for f, above, t in self.terms))


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    rules: tuple[Rule, ...]
    bias: float

    def score(self) -> Column:
        total = functools.reduce(operator.add, (F.when(r.column(list(self.names)), r.weight).otherwise(0.0) for r in self.rules), F.lit(self.bias))
        return 1.0 / (1.0 + F.exp(-total))


def _tree(x: np.ndarray, grad: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, path: tuple, out: list, step: np.ndarray) -> None:
    """Grows a regression tree on ``grad``; every node but the root becomes a rule."""
    if path:
        out.append(Rule(path))
    mean = grad[rows].mean()
    best = (1e-9, -1, 0.0)
    if len(path) < DEPTH and len(rows) >= 10:
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            at = np.searchsorted(cut, x[rows, f], side="left")  # value <= cut[k] iff at <= k
            n = np.bincount(at, minlength=len(cut) + 1).cumsum()[:-1]
            g = np.bincount(at, weights=grad[rows] - mean, minlength=len(cut) + 1).cumsum()[:-1]
            ok = (n >= 4) & (n <= len(rows) - 4)
            gain = np.where(ok, g * g * (1 / np.maximum(n, 1) + 1 / np.maximum(len(rows) - n, 1)), 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, float(cut[k]))
    if best[1] < 0:
        step[rows] = mean
        return
    _, f, t = best
    low = x[rows, f] <= t
    _tree(x, grad, cuts, rows[low], (*path, (f, False, t)), out, step)
    _tree(x, grad, cuts, rows[~low], (*path, (f, True, t)), out, step)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lasso(m: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression with an absolute-value penalty, by accelerated proximal steps."""
    n, k = m.shape
    full = np.hstack([m, np.ones((n, 1))])
    rate = 4 * n / (np.linalg.norm(full, 2) ** 2 + 1e-9)
    w = v = np.zeros(k + 1)
    w[-1] = 0.0
    t = 1.0
    for _ in range(rounds):
        new = v - rate * (full.T @ (_sigmoid(full @ v) - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w[:-1], float(w[-1])


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    """Trees on half-samples, their paths as rules, lasso weights by hold-out loss."""
    n = len(y)
    if n < 20 or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2)
        return Model(tuple(names), (), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        mids = (v[1:] + v[:-1]) / 2
        cuts.append(mids if len(mids) <= BINS else np.unique(mids[np.linspace(0, len(mids) - 1, BINS).astype(int)]))
    found: list[Rule] = []
    z = np.zeros(n)
    for _ in range(TREES):
        rows = np.sort(rng.choice(n, n // 2, replace=False))
        grad, step, new = y - _sigmoid(z), np.zeros(n), []
        some = [c if rng.random() < 0.7 else c[:0] for c in cuts]
        _tree(x, grad, some, rows, (), new, step)
        found += new
        leaves = [r for r in new if not any(o.terms[: len(r.terms)] == r.terms and len(o.terms) > len(r.terms) for o in new)]
        for r in leaves:
            inside = r.holds(x)
            if inside[rows].any():
                z[inside] += 0.8 * step[rows[inside[rows]][0]]
    unique = list({r.terms: r for r in found}.values())
    m = np.stack([r.holds(x) for r in unique], 1).astype(float) if unique else np.zeros((n, 0))
    seen: dict[bytes, int] = {}
    for k in range(m.shape[1]):  # rules that hold for the same rows: the first stays
        seen.setdefault(m[:, k].tobytes(), k)
    keep = sorted(seen.values())
    m, unique = m[:, keep], [unique[k] for k in keep]
    test = np.arange(n) % 5 == 0
    losses = []
    for p in PENALTIES:
        w, b = _lasso(m[~test], y[~test], p)
        q = np.clip(_sigmoid(m[test] @ w + b), 1e-6, 1 - 1e-6)
        losses.append((-(y[test] * np.log(q) + (1 - y[test]) * np.log(1 - q)).mean(), p))
    w, b = _lasso(m, y, min(losses)[1])
    return Model(tuple(names), tuple(Rule(r.terms, float(c)) for r, c in zip(unique, w, strict=True) if abs(c) > 1e-6), b)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 by 4; a null id isn't one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False)) if isinstance(doc_id, str) else F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from at most ``max_rows`` labelled rows that aren't held out.

    Rows are the first by a hash of their id; where ids repeat in ``docs``, the
    first ``2 * max_rows`` rows of those ids in that order.  Of repeated labels of
    an id the lowest counts; null labels and ids are left out.  With one class only, or
    fewer than 20 rows, the model is the smoothed share of label 1.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.min(label).alias("__y"))
    sample = known.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    rows, names = statistics(docs.select(id_col, text).join(F.broadcast(sample), id_col), text)  # max_rows ids
    got = rows.select(id_col, "__y", *names).orderBy(F.xxhash64(id_col), id_col, *names).limit(2 * max_rows).collect()
    got.sort(key=lambda r: tuple(r))
    x = np.array([r[2:] for r in got], dtype=float).reshape(len(got), len(names))
    return fit_rules(x, np.array([float(r[1] == 1) for r in got]), names)


def classify(docs: DataFrame, model: Model, text: str = "text", cut: float = 0.7) -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on) to every row, empty and null texts too.

    Repeated rows get the same score; an empty table stays empty; columns named like
    the new ones are replaced.  The score passes a generator of one row: a filter on
    it isn't pushed below, where each rule would compute its statistics again.
    """
    rows, names = statistics(docs.drop("score", "predicted"), text)
    scored = rows.withColumn("__s", model.score()).drop(*names)
    return scored.select("*", F.explode(F.array("__s")).alias("score")).drop("__s").withColumn("predicted", (F.col("score") >= cut).cast("int"))
