"""Registry and the SQL views of the two demo samples."""

from __future__ import annotations

from riskweave.sources.demo import NUMERIC

QUERIES: dict = {}
SQL: dict[str, str] = {}

RISK = """
li AS (
  SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_lines, sum(l_quantity) AS sum_qty, max(l_discount) AS max_disc
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.*, c.c_acctbal, c.c_nationkey, c.c_mktsegment,
    CAST(year(o.o_orderdate)*10000 + month(o.o_orderdate)*100 + day(o.o_orderdate) AS BIGINT) AS dt,
    CAST((o.o_orderkey * 7919) % 1000 + CASE WHEN o.o_orderstatus = 'O' THEN 150 ELSE 0 END AS DOUBLE) AS sg
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
risk_samples AS (
SELECT o_orderkey AS id, o_custkey AS cust, dt AS date,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL
       WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS label,
  o_orderpriority AS channel,
  o_totalprice AS amt,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN CAST(-9999 AS DOUBLE)
       WHEN o_orderkey % 23 = 0 THEN CAST(-9998 AS DOUBLE) ELSE c_acctbal END AS bal,
  c_acctbal * 2 + 1 AS bal_dup,
  CAST(c_nationkey AS BIGINT) AS nation,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ''
       WHEN o_orderkey % 31 = 0 THEN '-9998' ELSE c_mktsegment END AS seg,
  li.n_lines, li.sum_qty, li.max_disc,
  CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice ELSE CAST(-9999 AS DOUBLE) END AS sparse,
  CAST(1 AS DOUBLE) AS konst,
  sg + CASE WHEN dt >= 19990101 THEN 600 ELSE 0 END AS drift,
  sg AS sig,
  sg * 2 + 5 AS sig_dup
FROM base LEFT JOIN li ON li.l_orderkey = o_orderkey)"""

SCORED = """
scored AS (
SELECT id, date, label, channel, bal, sig,
       (CAST(sig AS BIGINT) * 8 + h) / CAST(10000 AS DOUBLE) AS prob_
FROM (SELECT r.*, (id * 31) % 800 AS h FROM risk_samples r WHERE label IN (0, 1)) t)"""

TOKEN_NUM, TOKEN_TEXT = -9999, "-9998"
SENTINEL_LIST = "(-99999, -9999, -9998, -9997, -9996)"


def with_risk(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([RISK, *ctes]) + "\n" + body


def with_scored(*ctes: str, body: str) -> str:
    return with_risk(SCORED, *ctes, body=body)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def long_numeric(features=NUMERIC, source: str = "risk_samples", keep: str = "id, label, date") -> str:
    """feature, v rows for numeric features."""
    return union(f"SELECT {keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {source}" for f in features)


def interpolated(listed: str, p: str) -> str:
    """Linear quantile at share ``p`` of the sorted list column ``listed``."""
    pos = f"(({p}) * (len({listed}) - 1))"
    low = f"{listed}[CAST(floor({pos}) AS BIGINT) + 1]"
    high = f"{listed}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return f"({low} + ({high} - {low}) * ({pos} - floor({pos})))"


def query(name: str, sql: str | None = None):
    """Registers the decorated (spark, sf_dir) callable under ``name``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
