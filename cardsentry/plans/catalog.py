"""Registry of the runnable queries: each name maps to a Spark plan and, where SQL can say the same, to that SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def r6(x: Column | str) -> Column:
    """Six decimals, without a negative zero; both sides of every comparison are rounded alike."""
    return F.round(x, 6) + F.lit(0.0)


def s6(x: str) -> str:
    return f"(round(({x})::DOUBLE, 6) + 0::DOUBLE)"


# The same mapping of the test tables to transactions as sources.tables, for a plain SQL engine.
TXN = """SELECT e.event_id::VARCHAR trans_num, e.event_id, e.ts trans_date_trans_time, e.user_id cc_num,
 'merchant_' || ((e.event_id*31)%200)::VARCHAR merchant, e.event_type category, e.value amt,
 c.c_name AS first, NULL::VARCHAR AS last, CASE WHEN e.user_id%2=0 THEN 'F' ELSE 'M' END gender,
 'city_' || (e.user_id%60)::VARCHAR city, n.n_name state, c.c_mktsegment job,
 25::DOUBLE + ((e.user_id*977)%2500)/100::DOUBLE lat, -125::DOUBLE + ((e.user_id*1543)%5800)/100::DOUBLE long,
 (e.user_id*7919)%1000000 city_pop, DATE '1940-01-01' + ((e.user_id*9973)%24000)::INT dob,
 25::DOUBLE + ((e.user_id*977)%2500)/100::DOUBLE + (((e.event_id*13)%200)-100)/100::DOUBLE merch_lat,
 -125::DOUBLE + ((e.user_id*1543)%5800)/100::DOUBLE + (((e.event_id*29)%200)-100)/100::DOUBLE merch_long,
 'NATION_' || (e.event_id%25)::VARCHAR merch_state,
 CASE WHEN json_extract_string(e.props,'$.k')::INT=0 OR e.value>200 THEN 1 ELSE 0 END is_fraud,
 least(e.value/300::DOUBLE,1::DOUBLE) iso_score, json_extract_string(e.props,'$.k')::INT/99::DOUBLE ae_score,
 ((e.event_id*7919)%1000)/999::DOUBLE xgb_score, 5::DOUBLE + ((e.event_id*37)%997)/100::DOUBLE processing_time_ms
FROM events e LEFT JOIN customer c ON e.user_id=c.c_custkey LEFT JOIN nation n ON c.c_nationkey=n.n_nationkey"""

# chronological 70 / 15 / 15
PARTS = """numbered AS (SELECT *, row_number() OVER (ORDER BY trans_date_trans_time, event_id) rn, count(*) OVER () n FROM txn),
parts AS (SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(n*0.70::DOUBLE) THEN 'train'
 WHEN rn <= floor(n*0.70::DOUBLE) + floor(n*0.15::DOUBLE) THEN 'val' ELSE 'test' END split FROM numbered)"""


def with_txn(final: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([f"txn AS ({TXN})", *ctes]) + "\n" + final


def load_all() -> None:
    from cardsentry.plans import (  # noqa: F401
        catalog_data,
        catalog_features,
        catalog_models,
        catalog_monitoring,
        catalog_profile,
        catalog_scoring,
        catalog_streaming,
    )
