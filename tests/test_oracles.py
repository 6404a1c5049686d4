"""Every plan with an oracle gives the oracle's rows at the smallest scale factor."""

import datetime
import decimal

import duckdb
import pytest

from skerry import plans
from skerry.plans.registry import TABLES

ORACLES = plans.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(repr(tuple(plain(r[k]) for k in order)) for r in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_matches_oracle(name, spark, sf, duck):
    df = plans.queries()[name](spark, sf)
    got = duck.execute(ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, got.fetchall())


def test_every_name_is_registered_once_and_has_rows_where_it_has_no_oracle(spark, sf):
    alone = set(plans.queries()) - set(ORACLES)
    assert alone == {"joi22_greedy_box_matching", "pip24_detector_discordance", "agg14b_n_unique_approximate", "set11_greedy_hamming_clusters"}
    for name in alone:
        assert plans.queries()[name](spark, sf).limit(1).count() == 1
