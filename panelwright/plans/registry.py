"""The query catalogue: name -> Spark plan over the given tables, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.sources.readers import scan_parquet

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Plan
    sql: str | None


CATALOG: dict[str, Query] = {}


def rounded(x: Column, digits: int) -> Column:
    """Rounding that both engines compute with the same two float operations. The offset is a little
    above one half, so that exact ties do not depend on the last bit of a sum."""
    return F.floor(x * F.lit(float(10 ** digits)) + F.lit(0.5003)).cast("double") / F.lit(float(10 ** digits))


def rounded_sql(x: str, digits: int) -> str:
    return f"floor({x} * {10 ** digits}.0::DOUBLE + 0.5003::DOUBLE) / {10 ** digits}.0::DOUBLE"


def query(name: str, sql: str | None = None, digits: dict[str, int] | None = None):
    """Register a plan. ``digits`` rounds the named double columns on both sides."""
    digits = digits or {}

    def register(fn: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df.withColumns({c: rounded(F.col(c), d) for c, d in digits.items()}) if digits else df

        text = sql
        if sql is not None and digits:
            outer = ", ".join(f"{rounded_sql(c, d)} AS {c}" for c, d in digits.items())
            text = f"SELECT * REPLACE ({outer}) FROM ({sql})"
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(run, text)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


# The panel and the scored sets in SQL, as built in panelwright.plans.panel.
PANEL = """panel AS (
  SELECT o.entity, o.period, o.n_orders, o.amt,
         CASE WHEN o.entity % 10 <> o.period % 10 THEN o.avg_amt END AS avg_amt, o.max_amt,
         c.c_acctbal AS acctbal, c.c_mktsegment AS segment, n.n_name AS nation,
         CAST(o.n_urgent >= 1 AS INTEGER) AS label
  FROM (SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n_orders,
               sum(o_totalprice) AS amt, avg(o_totalprice) AS avg_amt, max(o_totalprice) AS max_amt,
               count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
        FROM orders GROUP BY 1, 2) o
  JOIN customer c ON c.c_custkey = o.entity JOIN nation n ON n.n_nationkey = c.c_nationkey)"""
SCORED = PANEL + """, scored AS (
  SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred
  FROM (SELECT *, round(1.0 / (1.0 + exp(-((amt - 300000.0) / 150000.0))), 4) AS score FROM panel))"""
DOCS = """docs AS (
  SELECT *, CAST(score >= 0.05 AS INTEGER) AS pred
  FROM (SELECT doc_id, lang, source, quality AS label, toxic,
               round(greatest(least(n_chars / 20000.0::DOUBLE, 1.0), 0.0), 3) AS score
        FROM documents JOIN labels USING (doc_id)))"""
