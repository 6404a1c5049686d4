"""Exclusive claims, and attempts that go on while they get anywhere."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize


def claim_in_order(scores: DataFrame, group: str, claimant: str, target: str, score: str) -> DataFrame:
    """Claimants of a group, by id, each take the best target that no earlier one took.

    ``scores`` has a row for each admissible pair; the highest score wins, ties go
    to the smallest target.  A claimant whose targets are all taken gets no row.
    The rule is sequential, so a group is one task's work; group by what bounds
    the claimants (a host, a site).
    """
    kind = {f.name: f.dataType.simpleString() for f in scores.schema.fields}

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        taken: dict = {}
        for who, own in g.sort_values([claimant, score, target], ascending=[True, False, True]).groupby(claimant, sort=True):
            free = next((t for t in own[target] if t not in taken), None)
            if free is not None:
                taken[free] = who
        return pd.DataFrame({group: [key[0]] * len(taken), claimant: list(taken.values()), target: list(taken)})

    rows = scores.select(group, claimant, target, score).filter(" and ".join(f"{c} is not null" for c in (claimant, target, score)))
    return rows.groupBy(group).applyInPandas(run, ", ".join(f"{c} {kind[c]}" for c in (group, claimant, target)))


def claim_nearest(claimants: DataFrame, targets: DataFrame, group: str, claimant: str, target: str, at: str, digits: int = 4) -> DataFrame:
    """``claim_in_order`` where every pair of a group is admissible and the nearest ``at`` wins; pairs are never made.

    Both sides have ``group`` and ``at``.  Distances are rounded to ``digits``, ties
    go to the smallest target, and a distance that is null comes after all others.
    Rows without a group, claimant or target are left out; one key may have
    several rows.  A group's targets are sorted by place once and what is taken is
    stepped over, so its work grows with its rows and not with their product.
    """
    kind = {f.name: f.dataType.simpleString() for df in (claimants, targets) for f in df.schema.fields}
    unit = float(10**digits)

    def run(key: tuple, c: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        taken: dict = {}
        if len(c) and len(t):
            # Places with their targets, smallest first; targets without a place are a place of their own.
            t = t.sort_values([at, target])
            known = t[t[at].notna()]
            place, start = np.unique(known[at].to_numpy(float), return_index=True)
            at_place = [list(x[::-1]) for x in np.split(known[target].to_numpy(), start[1:])] if len(place) else []
            unplaced, anywhere = list(t.loc[t[at].isna(), target])[::-1], sorted(set(t[target]), reverse=True)
            left, right = list(range(len(place) + 1)), list(range(len(place) + 1))  # the nearest place on that side that may hold a free target; of the left one, plus 1

            def top(own: list):
                while own and own[-1] in taken:
                    own.pop()
                return own[-1] if own else None

            def find(jump: list, k: int) -> int:
                while jump[k] != k:
                    jump[k] = k = jump[jump[k]]
                return k

            def below(k: int) -> int:
                """The last place before ``k`` with a free target, or -1."""
                while (k := find(left, k)) and top(at_place[k - 1]) is None:
                    left[k] = k - 1
                return k - 1

            def above(k: int) -> int:
                """The first place from ``k`` on with a free target, or their number."""
                while (k := find(right, k)) < len(place) and top(at_place[k]) is None:
                    right[k] = k + 1
                return k

            def best(here: float) -> tuple | None:
                if here != here:
                    who = top(anywhere)
                    return None if who is None else (np.inf, 1, who)
                k, found = int(np.searchsorted(place, here)), []

                def away(j: int) -> float:
                    far = abs(here - place[j]) * unit
                    low = np.floor(far)
                    return float((low + (far - low >= 0.5)) / unit) if far < np.inf else np.inf

                a, b = below(k), above(k)
                near = min([away(j) for j in (a, b) if 0 <= j < len(place)], default=None)
                if near is None:
                    who = top(unplaced)
                    return None if who is None else (np.inf, 1, who)
                while a >= 0 and away(a) == near:
                    found.append(top(at_place[a]))
                    a = below(a)
                while b < len(place) and away(b) == near:
                    found.append(top(at_place[b]))
                    b = above(b + 1)
                return near, 0, min(found)

            for who, own in c.sort_values(claimant).groupby(claimant, sort=True)[at]:
                found = [x for x in map(best, own.to_numpy(float)) if x is not None]
                if not found:
                    break  # every target is admissible, so none is left for anyone
                taken[min(found)[2]] = who
        return pd.DataFrame({group: [key[0]] * len(taken), claimant: list(taken.values()), target: list(taken)})

    side = lambda df, who: df.select(group, who, F.col(at).cast("double").alias(at)).filter(f"{group} is not null and {who} is not null").groupBy(group)
    return side(claimants, claimant).cogroup(side(targets, target)).applyInPandas(run, ", ".join(f"{c} {kind[c]}" for c in (group, claimant, target)))


def retry_until_no_progress(items: DataFrame, id_col: str, attempt: Callable[[DataFrame, int], DataFrame], most: int = 100) -> DataFrame:
    """Tries what is left until a round brings nothing: ``items`` with ``round``, null where all rounds failed.

    ``attempt(left, round)`` returns the ids that succeed.  What a round brought is
    a table of its own and is merged into the earlier ones; only a yes or no comes
    back to the driver.
    """
    left, parts = items, []
    for k in range(1, most + 1):
        got = materialize(attempt(left, k).select(id_col).distinct().withColumn("round", F.lit(k)), "round")
        if got.isEmpty():
            break
        parts.append(got)
        left = left.join(got, id_col, "left_anti")
    else:
        raise RuntimeError(f"still getting on after {most} rounds")
    done = left.select(id_col, F.lit(None).cast("int").alias("round"))
    for p in parts:
        done = done.union(p)
    return items.join(done.filter("round is not null"), id_col, "left")
