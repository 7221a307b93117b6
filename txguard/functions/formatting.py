"""Text formatting for alert messages (F13–F22), as native column expressions.

Spark's ``format_string('%.2f', x)`` rounds half-up on the shortest decimal
form of ``x`` (1736.655 -> "1736.66"), whereas the reference formats the
exact binary value (1736.655 is 1736.65499999... -> "1736.65").  ``fixed``
reproduces the exact rounding with an error-free product (Dekker), all in
codegen'd arithmetic.

The rounding refers to its input about twenty times.  On a column reference
that is free; on a computed expression Catalyst would inline the expression
at every reference.  The ``with_*`` helpers therefore stage the work as
successive projections over named columns (CollapseProject keeps an
expensive expression that is referenced more than once in its own
projection), so every value is computed once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.functions.parsing import to_number
from txguard.schemas import ALERT_FIELD_ALTERNATIVES

# --- Fixed values: the alert message layout must equal the reference's. ---
NA = "N/A"
MESSAGE_HEADER = "\U0001F6A8 Fraud alert detected"
MESSAGE_LABELS = [
    "Transaction ID: ", "Fraud probability: ", "Alert threshold: ",
    "Amount: ", "Merchant: ", "Category: ", "Customer ID: ",
    "Customer location: ", "Customer coordinates: ", "Merchant coordinates: ",
    "Customer ↔ merchant distance: ", "Transaction datetime: ",
]
AMOUNT_UNIT = " USD"
DISTANCE_UNIT = " km"
CUSTOMER_COORD_DECIMALS = 4
MERCHANT_COORD_DECIMALS = 6
# --- end of fixed values ---

_SPLITTER = 134217729.0  # 2**27 + 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def _scaled_round(x: Column, decimals: int) -> Column:
    """Integer nearest to ``x * 10**decimals`` computed on the exact binary
    value of ``x``; exact ties go to the even integer."""
    k = F.lit(float(10 ** decimals))
    c = x * F.lit(_SPLITTER)
    hi = c - (c - x)
    lo = x - hi
    p = x * k
    err = (hi * k - p) + lo * k          # x*k == p + err exactly
    fl = F.floor(p)
    s = (p - fl - F.lit(0.5)) + err
    bump = (F.when(s > 0, F.lit(1))
            .when(s < 0, F.lit(0))
            .otherwise(F.when(F.pmod(fl, F.lit(2)) == 0, F.lit(0)).otherwise(F.lit(1))))
    return fl + bump


def round_half_even(c, decimals: int) -> Column:
    """Python-style ``round(x, n)`` of a double: correctly rounded, NULL-safe."""
    x = to_number(_col(c))
    r = _scaled_round(x, decimals).cast("double") / F.lit(float(10 ** decimals))
    return F.when(_finite(x), r).otherwise(x)


def fixed(c, decimals: int) -> Column:
    """``f"{x:.{d}f}"`` of the exact double value; NULL for NULL/NaN/inf."""
    x = to_number(_col(c))
    r = _scaled_round(x, decimals)
    mag = F.abs(r)
    k = 10 ** decimals
    # the sign bit, -0.0 included (printed "-0"): its text form starts with '-'
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    if decimals == 0:
        body = mag.cast("string")
    else:
        body = F.concat(
            (mag / F.lit(k)).cast("long").cast("string"), F.lit("."),
            F.lpad(F.pmod(mag, F.lit(k)).cast("string"), decimals, "0"))
    return F.when(_finite(x), F.concat(sign, body))


def _q(name: str) -> str:
    """Back-quoted column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def _sql_str(text: str) -> str:
    """SQL string literal (backslash escapes on, the Spark default)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _dbl(v: float) -> str:
    return repr(float(v)) + "D"


def _sql_finite(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT isnan({x}) AND abs({x}) != CAST('Infinity' AS DOUBLE))"


def _staged_round(df: DataFrame, specs: dict[str, tuple], tag: str) -> tuple[DataFrame, list[str]]:
    """Stages ``x`` (finite double or NULL), the exact product ``x·10^d = p + err``
    and the rounded integer ``r`` for every ``out -> (value, decimals)``.

    The stages after the numeric coercion are SQL expression text: one parse
    per column on the driver instead of dozens of expression-builder calls."""
    temps = []
    stage0 = {f"__i{tag}_{out}": to_number(_col(value)) for out, (value, _d) in specs.items()}
    df = df.withColumns(stage0)
    stage1 = {}
    for out in specs:
        i = _q(f"__i{tag}_{out}")
        stage1[f"__x{tag}_{out}"] = F.expr(f"CASE WHEN {_sql_finite(i)} THEN {i} END")
    df = df.withColumns(stage1)
    stage2 = {}
    for out, (_v, d) in specs.items():
        x, k = _q(f"__x{tag}_{out}"), _dbl(10 ** d)
        c = f"({x} * {_dbl(_SPLITTER)})"
        hi = f"({c} - ({c} - {x}))"
        lo = f"({x} - {hi})"
        p = f"({x} * {k})"
        stage2[f"__p{tag}_{out}"] = F.expr(p)
        stage2[f"__e{tag}_{out}"] = F.expr(f"(({hi} * {k} - {p}) + {lo} * {k})")
    df = df.withColumns(stage2)
    stage3 = {}
    for out in specs:
        p, e = _q(f"__p{tag}_{out}"), _q(f"__e{tag}_{out}")
        fl = f"floor({p})"
        s_ = f"(({p} - {fl} - 0.5D) + {e})"
        bump = (f"CASE WHEN {s_} > 0 THEN 1 WHEN {s_} < 0 THEN 0 "
                f"ELSE CASE WHEN pmod({fl}, 2) = 0 THEN 0 ELSE 1 END END")
        stage3[f"__r{tag}_{out}"] = F.expr(f"{fl} + {bump}")
        temps += [f"__i{tag}_{out}", f"__x{tag}_{out}", f"__p{tag}_{out}",
                  f"__e{tag}_{out}", f"__r{tag}_{out}"]
    return df.withColumns(stage3), temps


def with_rounded(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """Python ``round(x, d)`` for every ``out -> (value, decimals)``, staged."""
    staged, temps = _staged_round(df, specs, "r")
    outs = {out: F.expr(f"CAST({_q(f'__rr_{out}')} AS DOUBLE) / {_dbl(10 ** d)}")
            for out, (_v, d) in specs.items()}
    return staged.withColumns(outs).drop(*temps)


def _sql_text_of_rounded(r: str, negative: str, decimals: int) -> str:
    sign = f"CASE WHEN {negative} THEN '-' ELSE '' END"
    mag = f"abs({r})"
    if decimals == 0:
        return f"concat({sign}, CAST({mag} AS STRING))"
    k = 10 ** decimals
    return (f"concat({sign}, CAST(CAST({mag} / {k} AS BIGINT) AS STRING), '.', "
            f"lpad(CAST(pmod({mag}, {k}) AS STRING), {decimals}, '0'))")


def with_fixed(df: DataFrame, specs: dict[str, tuple]) -> DataFrame:
    """``f"{x:.{d}f}"`` text (NULL when missing) for every ``out -> (value, decimals)``, staged."""
    staged, temps = _staged_round(df, specs, "f")
    outs = {}
    for out, (_v, d) in specs.items():
        x = _q(f"__xf_{out}")
        negative = f"startswith(CAST({x} AS STRING), '-')"
        text = _sql_text_of_rounded(_q(f"__rf_{out}"), negative, d)
        outs[out] = F.expr(f"CASE WHEN {x} IS NOT NULL THEN {text} END")
    return staged.withColumns(outs).drop(*temps)


def _or_na(text: Column) -> Column:
    return F.coalesce(text, F.lit(NA))


def format_probability(c) -> Column:
    """F14."""
    return _or_na(fixed(c, 4))


def format_threshold(c) -> Column:
    """F15."""
    return _or_na(fixed(c, 2))


def format_amount(c) -> Column:
    """F16."""
    return _or_na(F.concat(fixed(c, 2), F.lit(AMOUNT_UNIT)))


def format_coordinates(lat, lon, decimals: int = 6) -> Column:
    """``lat, lon`` when both are present."""
    return _or_na(F.concat(fixed(lat, decimals), F.lit(", "), fixed(lon, decimals)))


def format_distance(c) -> Column:
    """F18."""
    return _or_na(F.concat(fixed(c, 2), F.lit(DISTANCE_UNIT)))


def format_datetime(c, dtype: T.DataType | None = None) -> Column:
    """ISO form with ``T``; microseconds only when present; text as is."""
    col = _col(c)
    if isinstance(dtype, T.StringType):
        return _or_na(col)
    ts = col.cast("timestamp_ntz")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return _or_na(F.when(frac == F.lit("000000"), base)
                  .otherwise(F.concat(base, F.lit("."), frac)))


def location_text(city, state) -> Column:
    """``city, state`` / the one present / N/A; empty text counts as missing."""
    cty = F.nullif(_col(city).cast("string"), F.lit(""))
    st = F.nullif(_col(state).cast("string"), F.lit(""))
    return _or_na(F.nullif(F.concat_ws(", ", cty, st), F.lit("")))


def first_present(df: DataFrame, names: Sequence[str], as_type: str | None = None) -> Column:
    """first non-null, non-NaN value over the alternative columns that exist."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for n in names:
        if n not in fields:
            continue
        c = F.col(n)
        if isinstance(fields[n], (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if as_type:
            c = c.cast(as_type)
        parts.append(c)
    if not parts:
        return F.lit(None).cast(as_type or "string")
    return parts[0] if len(parts) == 1 else F.coalesce(*parts)


def _first_dtype(df: DataFrame, names: Sequence[str]) -> T.DataType | None:
    fields = {f.name: f.dataType for f in df.schema.fields}
    for n in names:
        if n in fields:
            return fields[n]
    return None


_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _first_present_sql(fields: dict, names: Sequence[str], as_type: str) -> str:
    """F13 as SQL text (see ``first_present``)."""
    parts = []
    for n in names:
        if n not in fields:
            continue
        c = _q(n)
        if isinstance(fields[n], (T.DoubleType, T.FloatType)):
            c = f"CASE WHEN NOT isnan({c}) THEN {c} END"
        parts.append(f"CAST({c} AS {as_type})")
    if not parts:
        return f"CAST(NULL AS {as_type})"
    return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"


def with_alert_message(df: DataFrame, out: str = "message") -> DataFrame:
    """adds the 13-line alert text, built from whichever alternative
    columns exist (F13), in staged projections of SQL expression text."""
    alt = ALERT_FIELD_ALTERNATIVES
    fields = {f.name: f.dataType for f in df.schema.fields}
    dt_names = alt["transaction_datetime"]
    dt_is_text = isinstance(_first_dtype(df, dt_names), T.StringType)
    values = {
        "__m_tn": _first_present_sql(fields, alt["trans_num"], "STRING"),
        "__m_merchant": _first_present_sql(fields, alt["merchant"], "STRING"),
        "__m_category": _first_present_sql(fields, alt["category"], "STRING"),
        "__m_customer": _first_present_sql(fields, alt["customer_id"], "STRING"),
        "__m_city": _first_present_sql(fields, alt["city"], "STRING"),
        "__m_state": _first_present_sql(fields, alt["state"], "STRING"),
        "__m_dt": _first_present_sql(fields, dt_names, "STRING" if dt_is_text else "TIMESTAMP_NTZ"),
    }
    numbers = {
        "__m_prob": ("fraud_probability", 4), "__m_thr": ("fraud_alert_threshold", 2),
        "__m_amt": ("amount", 2), "__m_clat": ("customer_lat", CUSTOMER_COORD_DECIMALS),
        "__m_clon": ("customer_lon", CUSTOMER_COORD_DECIMALS),
        "__m_mlat": ("merchant_lat", MERCHANT_COORD_DECIMALS),
        "__m_mlon": ("merchant_lon", MERCHANT_COORD_DECIMALS), "__m_dist": ("distance_km", 2),
    }
    for name, (key, _d) in numbers.items():
        values[name + "_v"] = _first_present_sql(fields, alt[key], "DOUBLE")
    staged = with_fixed(df.withColumns({k: F.expr(v) for k, v in values.items()}),
                        {name: (F.col(name + "_v"), d) for name, (_k, d) in numbers.items()})

    na = _sql_str(NA)

    def or_na(text: str) -> str:
        return f"coalesce({text}, {na})"

    def coords(lat: str, lon: str) -> str:
        return or_na(f"concat({_q(lat)}, ', ', {_q(lon)})")

    dt = _q("__m_dt")
    if dt_is_text:
        when_text = or_na(dt)
    else:
        base = f"date_format({dt}, {_sql_str(_ISO_SECONDS)})"
        frac = f"date_format({dt}, 'SSSSSS')"
        when_text = or_na(f"CASE WHEN {frac} = '000000' THEN {base} ELSE concat({base}, '.', {frac}) END")
    city = f"nullif(CAST({_q('__m_city')} AS STRING), '')"
    state = f"nullif(CAST({_q('__m_state')} AS STRING), '')"
    location = or_na(f"nullif(concat_ws(', ', {city}, {state}), '')")
    lab = MESSAGE_LABELS
    pieces = [
        _sql_str(MESSAGE_HEADER + "\n\n" + lab[0]), or_na(_q("__m_tn")),
        _sql_str("\n" + lab[1]), or_na(_q("__m_prob")),
        _sql_str("\n" + lab[2]), or_na(_q("__m_thr")),
        _sql_str("\n\n" + lab[3]), or_na(f"concat({_q('__m_amt')}, {_sql_str(AMOUNT_UNIT)})"),
        _sql_str("\n" + lab[4]), or_na(_q("__m_merchant")),
        _sql_str("\n" + lab[5]), or_na(_q("__m_category")),
        _sql_str("\n" + lab[6]), or_na(_q("__m_customer")),
        _sql_str("\n\n" + lab[7]), location,
        _sql_str("\n" + lab[8]), coords("__m_clat", "__m_clon"),
        _sql_str("\n" + lab[9]), coords("__m_mlat", "__m_mlon"),
        _sql_str("\n" + lab[10]), or_na(f"concat({_q('__m_dist')}, {_sql_str(DISTANCE_UNIT)})"),
        _sql_str("\n\n" + lab[11]), when_text,
    ]
    temps = [n for n in staged.columns if n.startswith("__m_")]
    return staged.withColumn(out, F.expr(f"concat({', '.join(pieces)})")).drop(*temps)


def threshold_label(t) -> Column:
    """``str(0.9).replace('.', '_')`` -> ``0_9``."""
    return F.replace(_col(t).cast("string"), F.lit("."), F.lit("_"))
