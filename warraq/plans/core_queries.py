"""The registered queries of the core, and their equivalents in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warraq.operators.intervals import periods_and_gaps
from warraq.plans.materialize import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Page periods and gaps of every (table, book, event or surah)."""

    def of(tab: str, entity: str) -> DataFrame:
        return table(spark, d, tab).select(F.lit(tab).alias("tab"), "source", F.col(entity).cast("string").alias("entity"), "from_page", "to_page")

    rows = of("segments", "surah").unionByName(of("event_segments", "event_id"))
    found = periods_and_gaps(rows, [F.col("tab"), F.col("source"), F.col("entity")], F.col("from_page"), F.col("to_page"))
    return found.withColumnsRenamed({"from_unit": "from_page", "to_unit": "to_page"})


ORACLE["p1_found"] = """
WITH r AS (
  SELECT 'segments' AS tab, source, CAST(surah AS VARCHAR) AS entity, from_page AS f, to_page AS t FROM segments
  UNION ALL SELECT 'event_segments', source, event_id, from_page, to_page FROM event_segments),
v AS (SELECT DISTINCT * FROM r WHERE f <= t),
m AS (SELECT *, max(t) OVER (PARTITION BY tab, source, entity ORDER BY f, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM v),
g AS (SELECT *, sum(CASE WHEN f <= p + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY tab, source, entity ORDER BY f, t) AS run FROM m),
q AS (SELECT tab, source, entity, min(f) AS f, max(t) AS t FROM g GROUP BY tab, source, entity, run),
n AS (SELECT *, lead(f) OVER (PARTITION BY tab, source, entity ORDER BY f) AS nx FROM q)
SELECT tab, source, entity, 'period' AS kind, f AS from_page, t AS to_page FROM q
UNION ALL SELECT tab, source, entity, 'gap', CAST(t + 1 AS INTEGER), CAST(nx - 1 AS INTEGER) FROM n WHERE nx IS NOT NULL
"""
