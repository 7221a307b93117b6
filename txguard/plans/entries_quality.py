"""Registered queries: data-quality validators (Q2–Q20) over ``transactions_dirty``.

The dirty view carries the raw time text in ``current_time_raw``; it is the
time column of every rule here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard.operators.quality import (
    expectation_names, unexpected_values,
    COLUMNS_RULE, business_report, business_rules, expectation_report, expectation_results, expectation_rules, quarantine,
)
from txguard.plans.catalog import V, register
from txguard.schemas import CRITICAL_COLUMNS

TIME = "current_time_raw"


def dirty(spark, sf):
    return V(spark, sf, "transactions_dirty")


def _missing_sql(c, is_float):
    c = f'"{c}"'
    return f"({c} IS NULL OR isnan({c}))" if is_float else f"{c} IS NULL"


_FLOATS = {"amt", "lat", "long", "merch_lat", "merch_long"}
_BUSINESS_NULL_COLS = [TIME if c == "current_time" else c for c in CRITICAL_COLUMNS]
_RANGES = [("lat", 90), ("long", 180), ("merch_lat", 90), ("merch_long", 180)]


def _safe(name: str) -> str:
    return name.replace(":", "_")


@register("q2_null_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {_missing_sql(c, c in _FLOATS)}) AS null_{'current_time' if c == TIME else c}"
    for c in _BUSINESS_NULL_COLS) + " FROM transactions_dirty")
def q2(spark, sf):
    d = dirty(spark, sf)
    rep = business_report(d, TIME)
    names = [r.name for r in business_rules(d, TIME) if r.name.startswith("not_null:")]
    return rep.select(*[F.col(f"`{n}`").alias("null_" + n.split(":")[1]) for n in names])


@register("q3_negative_amount",
          "SELECT count(*) FILTER (WHERE amt < 0) AS violations FROM transactions_dirty")
def q3(spark, sf):
    return business_report(dirty(spark, sf), TIME).select(F.col("amt_non_negative").alias("violations"))


@register("q4_coordinate_ranges", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE NOT COALESCE(\"{c}\" IS NOT NULL AND NOT isnan(\"{c}\") AND \"{c}\" BETWEEN -{b} AND {b}, false)) AS range_{c}"
    for c, b in _RANGES) + " FROM transactions_dirty")
def q4(spark, sf):
    rep = business_report(dirty(spark, sf), TIME)
    return rep.select(*[F.col(f"`range:{c}`").alias(f"range_{c}") for c, _ in _RANGES])


@register("q5_unparseable_time", f"""SELECT count(*) FILTER (WHERE {TIME} IS NOT NULL
 AND TRY_CAST({TIME} AS TIMESTAMP) IS NULL) AS violations FROM transactions_dirty""")
def q5(spark, sf):
    return business_report(dirty(spark, sf), TIME).select(
        F.col("current_time_parseable").alias("violations"))


# expectation suite: one query per rule, each a single counter
_EXPECT = [
    ("q7_trans_num_not_null", "ExpectColumnValuesToNotBeNull:trans_num", "trans_num IS NULL"),
    ("q8_trans_num_unique", "ExpectColumnValuesToBeUnique:trans_num", None),
    ("q9_cc_num_not_null", "ExpectColumnValuesToNotBeNull:cc_num", "cc_num IS NULL"),
    ("q10_merchant_not_null", "ExpectColumnValuesToNotBeNull:merchant", "merchant IS NULL"),
    ("q11_category_not_null", "ExpectColumnValuesToNotBeNull:category", "category IS NULL"),
    ("q12_amt_not_null", "ExpectColumnValuesToNotBeNull:amt", "(amt IS NULL OR isnan(amt))"),
    ("q13_amt_non_negative", "ExpectColumnValuesToBeBetween:amt", "amt < 0"),
    ("q14_lat_range", "ExpectColumnValuesToBeBetween:lat",
     "(lat IS NOT NULL AND NOT isnan(lat) AND (lat < -90 OR lat > 90))"),
    ("q15_long_range", "ExpectColumnValuesToBeBetween:long",
     "(\"long\" IS NOT NULL AND NOT isnan(\"long\") AND (\"long\" < -180 OR \"long\" > 180))"),
    ("q16_merch_lat_range", "ExpectColumnValuesToBeBetween:merch_lat",
     "(merch_lat IS NOT NULL AND NOT isnan(merch_lat) AND (merch_lat < -90 OR merch_lat > 90))"),
    ("q17_merch_long_range", "ExpectColumnValuesToBeBetween:merch_long",
     "(merch_long IS NOT NULL AND NOT isnan(merch_long) AND (merch_long < -180 OR merch_long > 180))"),
    ("q18_current_time_not_null", "ExpectColumnValuesToNotBeNull:current_time", f"{TIME} IS NULL"),
    ("q19_is_fraud_in_set", "ExpectColumnValuesToBeInSet:is_fraud",
     "(is_fraud IS NOT NULL AND is_fraud NOT IN (0, 1))"),
]

_DUP_SQL = """(SELECT COALESCE(sum(n), 0) FROM (SELECT trans_num, count(*) AS n FROM transactions_dirty
 WHERE trans_num IS NOT NULL GROUP BY trans_num HAVING count(*) > 1) g)"""


def _expect_sql(cond):
    if cond is None:
        return f"SELECT CAST({_DUP_SQL} AS BIGINT) AS violations"
    return f"SELECT count(*) FILTER (WHERE {cond}) AS violations FROM transactions_dirty"


def _expect_query(rule):
    def fn(spark, sf):
        return expectation_report(dirty(spark, sf), TIME).select(F.col(f"`{rule}`").alias("violations"))
    return fn


for _name, _rule, _cond in _EXPECT:
    register(_name, _expect_sql(_cond))(_expect_query(_rule))


_ALL_EXPECT_SQL = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{rule}' AS rule, "
    + (f"CAST({_DUP_SQL} AS BIGINT)" if cond is None
       else f"(SELECT count(*) FILTER (WHERE {cond}) FROM transactions_dirty)")
    + " AS violations" for i, (_n, rule, cond) in enumerate(_EXPECT, 1))


@register("q20_expectation_results", f"""SELECT CAST(ordinal AS INTEGER) AS ordinal, rule, violations,
 total, violations = 0 AS success,
 CASE WHEN ordinal = 0 THEN 'all columns present' ELSE violations || ' of ' || total || ' rows' END AS details
 FROM (SELECT 0 AS ordinal, '{COLUMNS_RULE}' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL {_ALL_EXPECT_SQL}) r
 CROSS JOIN (SELECT count(*) AS total FROM transactions_dirty) n""")
def q20(spark, sf):
    return expectation_results(dirty(spark, sf), TIME)


_ROW_FLAGS = [(rule, cond) for _n, rule, cond in _EXPECT]


@register("q20_row_quarantine", """WITH dups AS (SELECT trans_num FROM transactions_dirty
 WHERE trans_num IS NOT NULL GROUP BY trans_num HAVING count(*) > 1)
SELECT d.trans_num, d.copy_no, array_to_string(list_filter([""" + ", ".join(
    f"CASE WHEN {cond} THEN '{rule}' END" if cond is not None
    else f"CASE WHEN dd.trans_num IS NOT NULL THEN '{rule}' END"
    for rule, cond in _ROW_FLAGS).replace('"long"', 'd."long"').replace("trans_num IS NULL", "d.trans_num IS NULL") + """], lambda x: x IS NOT NULL), ',') AS violations
FROM transactions_dirty d LEFT JOIN dups dd ON d.trans_num = dd.trans_num""")
def q20_rows(spark, sf):
    d = dirty(spark, sf)
    q = quarantine(d, expectation_rules(d, TIME))
    return q.select("trans_num", "copy_no", F.array_join("dq_violations", ",").alias("violations"))


_UNEXPECTED_SQL = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, CAST({column} AS VARCHAR) AS value FROM transactions_dirty WHERE {cond}" if cond is not None else
    f"SELECT '{rule}' AS rule, trans_num AS value FROM (SELECT *, count(*) OVER (PARTITION BY trans_num) AS copies FROM transactions_dirty) WHERE trans_num IS NOT NULL AND copies > 1"
    for (rule, cond), column in zip(_ROW_FLAGS, [f'"{c}"' for _, c in expectation_names(TIME)], strict=True))


@register("q20_unexpected_values", f"""SELECT rule, CAST(rank AS INT) AS rank, value, n FROM (
 SELECT rule, value, count(*) AS n, row_number() OVER (PARTITION BY rule ORDER BY count(*) DESC, value NULLS FIRST) AS rank
 FROM ({_UNEXPECTED_SQL}) u GROUP BY rule, value) r WHERE rank <= 20""")
def q20_values(spark, sf):
    """The values behind each broken expectation, as the report names them."""
    return unexpected_values(dirty(spark, sf), TIME)
