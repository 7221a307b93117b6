"""Data-quality validators (Q1–Q21).

Each validator exists in three forms:

* a **report**: every rule's violation count from ONE aggregation.  Row rules
  alone need no shuffle of rows; with the uniqueness rule all counters ride on
  its grouping by ``trans_num`` (partially aggregated map-side, so a hot key is
  combined before the shuffle) and are then summed globally;
* a **row quarantine**: an array of the rules each row breaks.  Of a repeated
  key either every copy breaks the uniqueness rule (as in the report), or all
  but the first by ingest order (``keep_first``);
* a **gate**: ``raise_if_failed`` collects the few result rows and raises.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.functions.parsing import to_timestamp_lenient
from txguard.schemas import CRITICAL_COLUMNS, INCOMING_REQUIRED_COLUMNS, RAW_INPUT_COLUMNS


class DataQualityError(ValueError):
    """A batch failed its data-quality checks."""


@dataclass(frozen=True)
class Rule:
    name: str
    column: str | None
    violated: Callable[[DataFrame], Column] | None   # per-row predicate; None = key uniqueness


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for floating columns (pandas ``isnull``)."""
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _is_float(df, c) else col.isNull()


def _present(df: DataFrame, c: str) -> Column:
    return ~_missing(df, c)


def _outside(c: str, lo: float | None, hi: float | None) -> Column:
    col = F.col(c)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (col < F.lit(lo))
    if hi is not None:
        cond = cond | (col > F.lit(hi))
    return cond


def _unparseable(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (T.StringType,)):
        return F.col(c).isNotNull() & to_timestamp_lenient(F.col(c)).isNull()
    return F.lit(False)


# ---- business validator (Q1–Q5): fails at the first broken rule ----

COORDINATE_RANGES = [("lat", -90.0, 90.0), ("long", -180.0, 180.0),
                     ("merch_lat", -90.0, 90.0), ("merch_long", -180.0, 180.0)]


def business_rules(df: DataFrame, time_column: str = "current_time") -> list[Rule]:
    rules = [Rule(f"not_null:{c}", c, lambda d, c=c: _missing(d, c))
             for c in CRITICAL_COLUMNS if c in df.columns and c != "current_time"]
    if time_column in df.columns:
        rules.append(Rule("not_null:current_time", time_column,
                          lambda d: _missing(d, time_column)))
    if "amt" in df.columns:
        rules.append(Rule("amt_non_negative", "amt", lambda d: F.col("amt") < 0))
    for c, lo, hi in COORDINATE_RANGES:
        if c in df.columns:
            # NULL / NaN coordinates are invalid here (``between`` is False)
            rules.append(Rule(f"range:{c}", c,
                              lambda d, c=c, lo=lo, hi=hi: ~F.coalesce(
                                  _present(d, c) & F.col(c).between(lo, hi), F.lit(False))))
    if time_column in df.columns:
        rules.append(Rule("current_time_parseable", time_column,
                          lambda d: _unparseable(d, time_column)))
    return rules


# ---- expectation suite (Q6–Q20): every failure is reported ----

def expectation_rules(df: DataFrame, time_column: str = "current_time") -> list[Rule]:
    def not_null(c):
        return Rule(f"ExpectColumnValuesToNotBeNull:{c}", c, lambda d: _missing(d, c))

    def between(c, lo, hi):
        # NULL (and NaN) values are ignored by range expectations
        return Rule(f"ExpectColumnValuesToBeBetween:{c}", c,
                    lambda d: F.coalesce(_present(d, c) & _outside(c, lo, hi), F.lit(False)))

    return [r for r in _expectations(not_null, between, time_column) if r.column in df.columns]


def expectation_names(time_column: str = "current_time") -> list[tuple[str, str]]:
    """(rule name, column) of the whole suite in declared order."""
    named = lambda kind: lambda c, *_: Rule(f"{kind}:{c}", c, None)
    rules = _expectations(named("ExpectColumnValuesToNotBeNull"), named("ExpectColumnValuesToBeBetween"), time_column)
    return [(r.name, r.column) for r in rules]


def _expectations(not_null, between, time_column: str) -> list[Rule]:
    return [
        not_null("trans_num"),
        Rule("ExpectColumnValuesToBeUnique:trans_num", "trans_num", None),
        not_null("cc_num"), not_null("merchant"), not_null("category"), not_null("amt"),
        between("amt", 0, None),
        between("lat", -90, 90), between("long", -180, 180),
        between("merch_lat", -90, 90), between("merch_long", -180, 180),
        Rule("ExpectColumnValuesToNotBeNull:current_time", time_column,
             lambda d: _missing(d, time_column)),
        Rule("ExpectColumnValuesToBeInSet:is_fraud", "is_fraud",
             lambda d: F.coalesce(F.col("is_fraud").isNotNull()
                                  & ~F.col("is_fraud").isin(0, 1), F.lit(False))),
    ]


def _report(df: DataFrame, rules: list[Rule], key: str = "trans_num") -> DataFrame:
    """One-row report ``total`` + one violation counter per rule, one shuffle
    with a uniqueness rule and none of rows without."""
    row_rules = [r for r in rules if r.violated is not None]
    uniq_rules = [r for r in rules if r.violated is None]
    if not uniq_rules:
        return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(r.violated(df)).alias(r.name) for r in row_rules])
    per_row = df.select(
        F.col(key).alias("_key") if key in df.columns else F.lit(None).alias("_key"),
        *[r.violated(df).cast("int").alias(f"_r{i}") for i, r in enumerate(row_rules)])
    per_key = per_row.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(row_rules))])
    dup = F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.col("_n")).otherwise(F.lit(0))
    exprs = [F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total")]
    for i, r in enumerate(row_rules):
        exprs.append(F.coalesce(F.sum(f"_r{i}"), F.lit(0)).cast("long").alias(r.name))
    for r in uniq_rules:
        exprs.append(F.coalesce(F.sum(dup), F.lit(0)).cast("long").alias(r.name))
    report = per_key.agg(*exprs)
    return report.select("total", *[r.name for r in rules])


def business_report(df: DataFrame, time_column: str = "current_time") -> DataFrame:
    """Q2–Q5 counters (one row)."""
    return _report(df, business_rules(df, time_column))


def expectation_report(df: DataFrame, time_column: str = "current_time") -> DataFrame:
    """Q7–Q19 counters (one row)."""
    return _report(df, expectation_rules(df, time_column))


COLUMNS_RULE = "ExpectTableColumnsToMatchSet:columns"
UNIQUE_RULE = "ExpectColumnValuesToBeUnique:trans_num"


def expectation_results(df: DataFrame, time_column: str = "current_time",
                        required: list[str] | None = None) -> DataFrame:
    """Q20: ``(ordinal, rule, violations, total, success, details)`` in declared
    order: the column set first, then every expectation.  The expectation of an
    absent column fails with NULL violations."""
    required = INCOMING_REQUIRED_COLUMNS if required is None else required
    missing = check_columns(df, [time_column if c == "current_time" else c for c in required])
    report = expectation_report(df, time_column)
    lines = [f"0, '{COLUMNS_RULE}', {len(missing)}L, '{'missing: ' + ', '.join(missing) if missing else 'all columns present'}'"]
    for i, (rule, column) in enumerate(expectation_names(time_column), 1):
        lines.append(f"{i}, '{rule}', `{rule}`, concat(`{rule}`, ' of ', total, ' rows')" if rule in report.columns
                     else f"{i}, '{rule}', CAST(NULL AS BIGINT), 'column {column} is absent'")
    return report.selectExpr(
        "total", f"stack({len(lines)}, {', '.join(lines)}) AS (ordinal, rule, violations, details)"
    ).select(F.col("ordinal").cast("int"), "rule", "violations", "total",
             F.coalesce(F.col("violations") == 0, F.lit(False)).alias("success"), "details")


def quarantine(df: DataFrame, rules: list[Rule] | None = None, key: str = "trans_num",
               keep_first: bool = False, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Row form: ``dq_violations`` (array of broken rule names) on every row.

    Uniqueness joins the batch with one row per repeated key; rows without a
    key stay out of that join.  With ``keep_first``, the smallest
    ``order_cols`` (then the row's place in the batch) among the copies that
    break no other rule is kept and every later one is flagged."""
    rules = expectation_rules(df) if rules is None else rules
    flags = [F.when(r.violated(df), F.lit(r.name)) for r in rules if r.violated is not None]
    uniq = [r for r in rules if r.violated is None]
    if not uniq or key not in df.columns:
        return df.withColumn("dq_violations", F.array_compact(F.array(*flags)))
    out = df.withColumns({"dq_violations": F.array_compact(F.array(*flags)), "_seq": F.monotonically_increasing_id()})
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order_cols, "_seq"])])
    out = out.withColumn("_place", place)
    counted = out.where(F.size("dq_violations") == 0) if keep_first else out
    repeated = (counted.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_dup_key"))
                .agg(F.count(F.lit(1)).alias("_copies"), F.min("_place").alias("_first")).where("_copies > 1"))
    keyed = out.where(F.col(key).isNotNull()).join(repeated, F.col(key) == F.col("_dup_key"), "left")
    later = F.col("_dup_key").isNotNull()
    if keep_first:
        later = later & (F.size("dq_violations") == 0) & (F.col("_place") != F.col("_first"))
    v = F.col("dq_violations")
    keyed = keyed.withColumn("dq_violations", F.when(later, F.concat(F.array(F.lit(uniq[0].name)), v)).otherwise(v))
    helpers = ("_seq", "_place", "_dup_key", "_copies", "_first")
    return keyed.drop(*helpers).unionByName(out.where(F.col(key).isNull()).drop(*helpers))


def split_quarantine(df: DataFrame, rules: list[Rule] | None = None, **options):
    q = quarantine(df, rules, **options)
    good = q.where(F.size("dq_violations") == 0).drop("dq_violations")
    bad = q.where(F.size("dq_violations") > 0)
    return good, bad


MAX_UNEXPECTED = 20


def unexpected_values(df: DataFrame, time_column: str = "current_time", most: int = MAX_UNEXPECTED) -> DataFrame:
    """Q20: ``(rule, rank, value, n)``: the ``most`` most frequent values (as
    text, ties in their order) that break each expectation.

    Only broken rows become rows here, one per rule; a value is counted before
    the shuffle and a task sends ``most`` values of a rule at the most, so a rule that a third
    of the batch breaks costs no more than another."""
    rules = expectation_rules(df, time_column)
    text = lambda c: F.col(c).cast("string")
    broken = F.array_compact(F.array(*[
        F.when(r.violated(df), F.struct(F.lit(r.name).alias("rule"), text(r.column).alias("value")))
        for r in rules if r.violated is not None]))
    counts = df.select(F.explode(broken).alias("b")).groupBy("b.rule", "b.value").agg(F.count(F.lit(1)).alias("n"))
    for r in rules:
        if r.violated is None:
            key = text(r.column)
            twice = df.where(key.isNotNull()).groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            counts = counts.unionByName(twice.select(F.lit(r.name).alias("rule"), "value", "n"))
    place = Window.partitionBy("rule").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most).select("rule", "rank", "value", "n")


def raise_if_failed(results: DataFrame, context: str, values: DataFrame | None = None) -> None:
    """Q21: collect the (few) result rows; raise listing every failure, with
    the values that broke it."""
    rows = results.where(~F.col("success")).orderBy("ordinal").collect()
    if rows:
        seen: dict[str, list[str]] = {}
        if values is not None:
            for v in values.orderBy("rule", "rank").collect():     # MAX_UNEXPECTED per rule
                seen.setdefault(v["rule"], []).append(f"{'NULL' if v['value'] is None else v['value']} ({v['n']})")
        lines = "\n".join(f"- {r['rule']}: {r['details']}" + (f": {', '.join(seen[r['rule']])}" if r["rule"] in seen else "") for r in rows)
        raise DataQualityError(f"validation failed: {context}\n{lines}")


def require_non_empty(df: DataFrame, context: str) -> None:
    """S3: an empty batch is an error (reads at most one row)."""
    if df.isEmpty():
        raise DataQualityError(f"empty batch: {context}")


def check_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Q1 / Q6: required columns absent from the frame (plan time)."""
    return [c for c in required if c not in df.columns]


def validate_transactions(df: DataFrame, time_column: str = "current_time") -> None:
    """Business validator: raises at the first failing rule (Q1–Q5)."""
    missing = check_columns(df, [time_column if c == "current_time" else c
                                 for c in RAW_INPUT_COLUMNS])
    if missing:
        raise DataQualityError(f"missing columns: {missing}")
    report = business_report(df, time_column).first().asDict()
    nulls = [r.column if r.column != time_column else "current_time"
             for r in business_rules(df, time_column)
             if r.name.startswith("not_null:") and report[r.name] > 0]
    if nulls:
        raise DataQualityError(f"null values in: {nulls}")
    for name, message in [("amt_non_negative", "negative amounts in amt"),
                          ("range:lat", "invalid customer latitude in lat"),
                          ("range:long", "invalid customer longitude in long"),
                          ("range:merch_lat", "invalid merchant latitude in merch_lat"),
                          ("range:merch_long", "invalid merchant longitude in merch_long"),
                          ("current_time_parseable", "current_time is not parseable")]:
        if report.get(name, 0) > 0:
            raise DataQualityError(message)


def validate_incoming_transactions(df: DataFrame, time_column: str = "current_time") -> None:
    """Expectation suite: empty batch fails; all failures are listed (Q6–Q21)."""
    if df.isEmpty():
        raise DataQualityError("incoming transaction batch is empty")
    raise_if_failed(expectation_results(df, time_column), "incoming_transactions", unexpected_values(df, time_column))
