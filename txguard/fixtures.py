"""Derived transaction views over the driver's TPC-H-like tables.

The view bodies are written once as SQL templates and rendered for both
engines: Spark (back-quoted names, ``STRING``, ``make_dt_interval``) and
DuckDB (double-quoted names, ``VARCHAR``, ``to_seconds``).  The rendered
texts give identical rows in both engines, which is what makes the DuckDB
oracle of ``__spark_entry__`` possible.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

_TRANSACTIONS = """
SELECT CAST(o.o_orderkey AS {s}) AS trans_num,
 4000000000000000 + o.o_custkey AS cc_num,
 s.s_name AS merchant, p.p_type AS category,
 o.o_totalprice / 100.0 AS amt,
 concat('F', CAST(c.c_custkey % 97 AS {s})) AS {q}first{q},
 concat('L', CAST(c.c_custkey % 89 AS {s})) AS {q}last{q},
 CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
 concat(CAST(c.c_custkey AS {s}), ' Main St') AS street,
 n.n_name AS city, r.r_name AS state,
 10000 + (c.c_custkey * 37) % 90000 AS zip,
 CAST((c.c_custkey * 7919) % 18001 AS DOUBLE) / 100.0 - 90.0 AS lat,
 CAST((c.c_custkey * 7907) % 36001 AS DOUBLE) / 100.0 - 180.0 AS {q}long{q},
 1000 + (c.c_custkey * 9973) % 1000000 AS city_pop,
 c.c_mktsegment AS job,
 make_date(1940 + CAST(c.c_custkey % 60 AS INT), 1 + CAST(c.c_custkey % 12 AS INT), 1 + CAST(c.c_custkey % 28 AS INT)) AS dob,
 CAST((s.s_suppkey * 6007) % 18001 AS DOUBLE) / 100.0 - 90.0 AS merch_lat,
 CAST((s.s_suppkey * 5003) % 36001 AS DOUBLE) / 100.0 - 180.0 AS merch_long,
 CASE WHEN o.o_totalprice > 400000 AND o.o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS is_fraud,
 o.o_orderdate + {iv} AS {q}current_time{q}
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
JOIN {supplier} s ON s.s_suppkey = (o.o_orderkey * 31) % (SELECT count(*) FROM {supplier})
JOIN {part} p ON p.p_partkey = (o.o_orderkey * 17) % (SELECT count(*) FROM {part})
"""

_TRANSACTIONS_DIRTY = """
SELECT * FROM (SELECT CASE WHEN k % 127 = 0 THEN NULL ELSE trans_num END AS trans_num, cc_num, merchant,
 CASE WHEN k % 137 = 0 THEN NULL ELSE category END AS category,
 CASE WHEN k % 101 = 0 THEN -amt ELSE amt END AS amt,
 CASE WHEN k % 103 = 0 THEN NULL WHEN k % 107 = 0 THEN 95.0 ELSE lat END AS lat, {q}long{q}, merch_lat, merch_long,
 {q}first{q}, {q}last{q}, street,
 CASE WHEN k % 139 = 0 THEN NULL ELSE gender END AS gender, CASE WHEN k % 149 = 0 THEN NULL ELSE city END AS city,
 CASE WHEN k % 151 = 0 THEN NULL ELSE state END AS state, CASE WHEN k % 157 = 0 THEN NULL ELSE zip END AS zip,
 CASE WHEN k % 163 = 0 THEN NULL ELSE city_pop END AS city_pop, CASE WHEN k % 167 = 0 THEN NULL ELSE job END AS job,
 CASE WHEN k % 173 = 0 THEN NULL ELSE dob END AS dob,
 CASE WHEN k % 109 = 0 THEN 3 ELSE is_fraud END AS is_fraud,
 CASE WHEN k % 131 = 0 THEN 'bad-date' ELSE CAST({q}current_time{q} AS {s}) END AS current_time_raw, copy_no
 FROM (SELECT t.*, CAST(t.trans_num AS BIGINT) AS k, c.copy_no FROM {transactions} t
       CROSS JOIN (SELECT 1 AS copy_no UNION ALL SELECT 2 AS copy_no) c) x
 WHERE copy_no = 1 OR k % 113 = 0) y
"""

_SCORES = """
SELECT trans_num, is_fraud,
 CAST((CAST(trans_num AS BIGINT) * 7919) % 601 + CASE WHEN is_fraud = 1 OR CAST(trans_num AS BIGINT) % 97 = 0 THEN 400 ELSE 0 END AS DOUBLE) / 1000.0 AS champion_score,
 CAST((CAST(trans_num AS BIGINT) * 6007) % 561 + CASE WHEN is_fraud = 1 OR CAST(trans_num AS BIGINT) % 211 = 0 THEN 440 ELSE 0 END AS DOUBLE) / 1000.0 AS challenger_score
FROM {transactions}
"""

_TRAINING_BASE = """
SELECT trans_num, amt, is_fraud FROM {transactions} WHERE CAST(trans_num AS BIGINT) % 10 < 6
"""

_LABELED_NEW = """
SELECT trans_num, amt, is_fraud, merchant FROM {transactions} WHERE CAST(trans_num AS BIGINT) % 10 >= 5
"""

# Spark text of transactions_dirty: the same rows, but the two copies come from
# a generator over each row instead of a cross join with a two-row table
_TRANSACTIONS_DIRTY_SPARK = _TRANSACTIONS_DIRTY.replace(
    """ FROM (SELECT t.*, CAST(t.trans_num AS BIGINT) AS k, c.copy_no FROM {transactions} t
       CROSS JOIN (SELECT 1 AS copy_no UNION ALL SELECT 2 AS copy_no) c) x""",
    """ FROM (SELECT t.*, CAST(t.trans_num AS BIGINT) AS k, copy_no FROM {transactions} t
       LATERAL VIEW explode(array(1, 2)) c AS copy_no) x""")
assert _TRANSACTIONS_DIRTY_SPARK != _TRANSACTIONS_DIRTY

# view name -> (template, views it reads)
VIEWS = {
    "transactions": (_TRANSACTIONS, ["orders", "customer", "nation", "region", "supplier", "part"]),
    "transactions_dirty": (_TRANSACTIONS_DIRTY, ["transactions"]),
    "scores": (_SCORES, ["transactions"]),
    "training_base": (_TRAINING_BASE, ["transactions"]),
    "labeled_new": (_LABELED_NEW, ["transactions"]),
}

_SPARK_DIALECT = {
    "q": "`", "s": "STRING",
    "iv": "make_dt_interval(0, 0, 0, (o.o_orderkey * 7919) % 86400)",
}
_DUCKDB_DIALECT = {
    "q": '"', "s": "VARCHAR",
    "iv": "to_seconds((o.o_orderkey * 7919) % 86400)",
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_SPARK_TEMPLATES = {"transactions_dirty": _TRANSACTIONS_DIRTY_SPARK}


def _spark_text(name: str) -> str:
    template, deps = VIEWS[name]
    template = _SPARK_TEMPLATES.get(name, template)
    return template.format(**_SPARK_DIALECT, **{d: "{" + d + "}" for d in deps})


def view(spark: SparkSession, sf_dir: str, name: str,
         _cache: dict | None = None) -> DataFrame:
    """Build a derived view (or read a base table) as a Spark DataFrame."""
    cache = {} if _cache is None else _cache
    if name in cache:
        return cache[name]
    if name not in VIEWS:
        df = read_table(spark, sf_dir, name)
    else:
        deps = VIEWS[name][1]
        frames = {d: view(spark, sf_dir, d, cache) for d in deps}
        df = spark.sql(_spark_text(name), **frames)
    cache[name] = df
    return df


def views(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    cache: dict = {}
    return {n: view(spark, sf_dir, n, cache) for n in names}


def _deps_in_order(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n not in VIEWS or n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the given views (and their dependencies) for DuckDB."""
    parts = []
    for n in _deps_in_order(names):
        template, deps = VIEWS[n]
        body = template.format(**_DUCKDB_DIALECT, **{d: d for d in deps})
        # MATERIALIZED: keeps DuckDB from pushing outer filters into the view
        # body (which trips an internal dictionary-cache error in some plans)
        parts.append(f"{n} AS MATERIALIZED ({body.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
