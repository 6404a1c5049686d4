"""The lake's tables as views over the star schema, shared by plans and oracles.

``img``: images (orders), ``det``: one row per detection after collapsing twins
(lineitem), ``det_rows``: all placements, ``reg``: sequence -> region.
"""

#: A total order of lineitem rows, for deterministic survivors.
TOTAL = "partkey, suppkey, qty, price, shipdate, tax, conf"

IMG = """img AS (SELECT o_orderkey AS image_id, o_custkey AS seq, CASE o_orderstatus WHEN 'P' THEN 3 ELSE 0 END AS status,
  o_orderdate AS captured_at, o_totalprice AS bytes, o_orderpriority AS kind FROM {orders})"""

DET_ROWS = """det_rows AS (SELECT l_orderkey AS image_id, l_linenumber AS det_idx, l_linestatus AS cell, l_returnflag AS drive,
  round(l_discount * 10, 1) AS conf, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS qty,
  l_extendedprice AS price, l_shipdate AS shipdate, l_tax AS tax FROM {lineitem})"""

DET = (
    DET_ROWS
    + f""", det AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, det_idx ORDER BY drive, cell, {TOTAL}) AS rn FROM det_rows) t WHERE rn = 1)"""
)

REG = """reg AS (SELECT c_custkey AS seq, n_name AS country, r_name AS region FROM {customer}
  JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey)"""

WITH = "WITH "
