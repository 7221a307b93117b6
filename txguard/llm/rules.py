"""Rule ledger for document quality, with DataFrame functions only.

``measure`` takes every measurement of a document once; ``ledger`` evaluates
every rule once and stores the failures as bits of one long beside the
measurements.  Policies are versioned sets of rules: applying one is a
bitwise AND, so a new policy needs no second look at the texts.  ``ablation``
first counts documents per distinct set of failures, then reads from these
counts, bit by bit, what each rule rejects, rejects alone, and would let pass
if it were dropped.

Rows.  A NULL text has no words and no lines; it fails ``few_words`` like the
empty one.  Repeated rows are judged each.  NULLs in other columns are not
looked at, an empty table gives an empty ledger, and further columns of the
input are ignored (``measure`` reads two columns by name).

Three-word windows are told apart by 64 hash bits, of which the lowest hold
the window's position (as many as the document's length needs); equal
neighbours in hash order are confirmed by their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.common import WORD

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3

# Rule -> failing condition over the measurements.  The position is the bit;
# append only, so that stored ledgers keep their meaning.
RULES: dict[str, str] = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols_per_word": "10 * n_symbols > 4 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 60 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "bullet_lines": "100 * n_bullet_lines > 90 * n_lines",
    "ellipsis_lines": "100 * n_ellipsis_lines > 30 * n_lines",
    "giant_word": "max_word_chars > 1000",
}
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols_per_word", "duplicate_lines"),
    "v2": tuple(RULES),
}
DEFAULT_POLICY = "v2"


def bits(names) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def _repeat_words(df: DataFrame) -> DataFrame:
    """+ n_repeat_words: words inside 3-word windows that occur twice or more."""
    equal = "shiftrightunsigned(x ^ _sorted[{j}], _bits) = 0 AND " + " AND ".join(
        f"_words[cast(x & _low as int) + {k}] = _words[cast(_sorted[{{j}}] & _low as int) + {k}]" for k in range(WINDOW))
    hashed = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    return (
        df.withColumn("_bits", F.expr("cast(ceil(log2(_n + 1)) as int)"))
        .withColumn("_low", F.expr("shiftleft(1L, _bits) - 1"))
        .withColumn("_windows", F.expr(
            f"CASE WHEN _n >= {WINDOW} THEN transform(sequence(0, _n - {WINDOW}), i -> xxhash64({hashed})) ELSE array() END"))
        # most documents repeat no window: only the others are looked at by position
        .withColumn("_sorted", F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN"
            " sort_array(transform(_windows, (h, i) -> shiftleft(h, _bits) | i)) ELSE array() END"))
        .withColumn("_at", F.expr(
            "sort_array(transform(filter(_sorted, (x, k) ->"
            f" (k > 0 AND {equal.format(j='k - 1')}) OR (k < size(_sorted) - 1 AND {equal.format(j='k + 1')})), x -> x & _low))"))
        .withColumn("n_repeat_words", F.expr(
            f"aggregate(transform(_at, (p, k) -> least({WINDOW}L, coalesce(get(_at, k + 1) - p, {WINDOW}L))), 0L, (a, x) -> a + x)"))
    )


def measure(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id_col and the measurements of every document, all long."""
    df = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))).withColumn("_n", F.size("_words"))
    df = _repeat_words(df)
    has_word = F.lit(r"[^\x20\x09-\x0D]")
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.regexp_like(x, has_word)))
    long = {
        "n_words": F.col("_n"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_lines": F.size("_lines"),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: F.substring(F.ltrim(x, F.lit(" \t\x0b\x0c\r")), 1, 1).isin("-", "*", "•"))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda x: F.endswith(F.rtrim(x, F.lit(" \t\x0b\x0c\r")), F.lit("...")))),
        "max_word_chars": F.coalesce(F.array_max(F.transform("_words", F.length)), F.lit(0)),
    }
    return df.select(id_col, *[c.cast("long").alias(n) for n, c in long.items()])


def ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``measure`` plus ``failed``: bit r is set if rule r fails."""
    failed: Column = F.lit(0).cast("long")
    for r, condition in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << r).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text, id_col).withColumn("failed", failed)


def passes(policy: str = DEFAULT_POLICY, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(bits(POLICIES[policy])).cast("long")) == 0


def ablation(led: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """One row per rule of the policy: documents it rejects, those it alone
    rejects, and those kept without it."""
    mask = bits(POLICIES[policy])
    sets = led.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("set")).agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(n).alias("rule"), F.lit(bits([n])).cast("long").alias("bit")) for n in POLICIES[policy]]
    each = sets.select("set", "n", F.explode(F.array(*rules)).alias("r")).select("set", "n", "r.rule", "r.bit")
    others = F.col("set").bitwiseAND(F.bitwise_not("bit"))
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(F.col("set").bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("set") == F.col("bit"), F.col("n"))), F.lit(0)).alias("rejected_alone"),
        F.coalesce(F.sum(F.when(others == 0, F.col("n"))), F.lit(0)).alias("kept_without"),
    )
