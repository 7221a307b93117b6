"""Registry of named queries (one per operator id of the inventory) and their
DuckDB oracle statements.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables or the
views Spark derives from them.  Its oracle is one SQL statement for DuckDB;
the fixture views it mentions are prepended as CTEs automatically.  Floats
are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.fixtures import VIEWS, duckdb_with, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_VIEW_RE = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            used = sorted(set(_VIEW_RE.findall(oracle)))
            text = oracle.strip()
            prefix = duckdb_with(*used)
            if prefix and text[:5].upper() == "WITH ":
                text = prefix.rstrip() + ",\n" + text[5:]
            else:
                text = prefix + text
            ORACLE[name] = text
        return fn
    return deco


def V(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return views(spark, sf_dir, name)[name]


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def dbl(x: float) -> str:
    """A DuckDB DOUBLE literal (plain decimals would be DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


# ---- SQL fragments shared by oracle statements (DuckDB dialect) ----

FEATURES_SQL = """
 floor(date_diff('second', CAST(dob AS TIMESTAMP), "current_time") / 86400) / 365.25 AS customer_age,
 hour("current_time") AS transaction_hour,
 isodow("current_time") - 1 AS transaction_dayofweek,
 month("current_time") AS transaction_month,
 CASE WHEN isodow("current_time") - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
 6371.0 * (2.0 * asin(sqrt(pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
   + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin((radians(merch_long) - radians("long")) / 2), 2))))
   AS distance_customer_merchant_km
"""


def feat_cte(source: str = "transactions") -> str:
    return f"feat AS (SELECT t.*, {FEATURES_SQL} FROM {source} t)"


def scored_cte(threshold: float = 0.9, model_name: str = "txguard_linear",
               alias: str = "champion") -> str:
    """``scored``: transactions + features + the default linear model's score."""
    from txguard.operators.scoring import DEFAULT_LINEAR_MODEL as M

    z = " + ".join([dbl(M.intercept)] + [f"{dbl(w)} * \"{f}\"" for f, w in M.weights.items()])
    return (f"{feat_cte()},\n scored AS (SELECT feat.*, 1.0 / (1.0 + exp(-({z}))) AS fraud_probability,"
            f" {dbl(threshold)} AS fraud_alert_threshold, '{model_name}' AS model_name,"
            f" '{alias}' AS model_alias FROM feat),\n"
            f" scored2 AS (SELECT *, CASE WHEN fraud_probability >= {dbl(threshold)} THEN 1 ELSE 0 END"
            f" AS is_fraud_predicted FROM scored)")


def with_ctes(*ctes: str) -> str:
    """Extra CTEs appended after the fixture views (which ``register`` adds)."""
    return ", ".join(ctes)
