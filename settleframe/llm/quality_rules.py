"""Quality rules: a threshold table compiled into Spark projections.

``RULES`` is the table: one line per rule with the measured column (or a ratio
of two) and its bounds. ``quality_columns`` measures a text with built-in
functions only; ``verdict`` turns the table into one boolean expression. There
is no shuffle and no user function: the scan, the measures and the verdict run
in the same stage.

Defined results: a null or empty text has zero of everything, fails
``min_words`` and is not kept. Repeated rows give repeated results. Extra
columns of the input pass through ``filter_documents`` untouched; the helper
columns carry a prefix no input column may use (``_q_``, checked).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The character classes of the contract.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
NOT_IN_WORD = r"[\x20\x09-\x0D]"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in a is that it on was with as be by for at from or an are "
    "der die und das in den von zu mit ist des auf ein eine dem im nicht als "
    "le la les de et des en un une du est dans que pour qui sur par au "
    "el los las y del se una por con para al lo como su mi"
).split()

PREFIX = "_q_"


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator counts as
    ratio 0, a missing bound is open."""
    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


# The threshold table. Lengths in words, the rest as ratios.
RULES: tuple[Rule, ...] = (
    Rule("min_words", "n_words", None, low=20),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=0.30),
    Rule("mean_word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.50),
)

# The two rules of the contract's ``base_failed``.
BASE_RULES = ("min_words", "repeated_windows")


def _check_names(docs: DataFrame) -> None:
    taken = [c for c in docs.columns if c.lower().startswith(PREFIX)]
    if taken:
        raise ValueError(f"columns {taken} use the reserved prefix {PREFIX!r}")


def _pairs(left: Column, shift: int) -> Column:
    """Hash each element with the one ``shift`` places on: a list of hashes of
    windows becomes one of windows that are ``shift`` words longer."""
    n = F.greatest(F.size(left) - F.lit(shift), F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(left, F.lit(shift + 1), n),
                      lambda a, b: F.xxhash64(a, b))


def quality_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measures (``_q_`` prefix): n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_stop_words, n_repeat_words.

    Repeated windows: the hashes of all 8-word windows (by doubling: 1, 2, 4, 8
    words) are sorted with their positions; a window whose neighbour in that
    order has the same hash occurs at least twice. The positions of such
    windows, sorted again, cover ``min(8, next - this)`` words each. All of it
    is O(n log n) in the words of one text.
    """
    _check_names(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    p = PREFIX
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD))
    out = (docs
           .withColumns({
               f"{p}words": F.array_remove(F.split(text, WORD_SPLIT, -1), ""),
               f"{p}lines": lines,
               f"{p}word_chars": F.length(F.regexp_replace(text, WORD_SPLIT, "")).cast("long"),
               f"{p}n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
           })
           .withColumns({
               f"{p}n_words": F.size(f"{p}words").cast("long"),
               f"{p}n_lines": F.size(f"{p}lines").cast("long"),
               f"{p}n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
               f"{p}n_stop_words": F.size(F.filter(f"{p}words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
               f"{p}h": F.transform(f"{p}words", lambda w: F.xxhash64(w)),
           })
           .withColumn(f"{p}h", _pairs(F.col(f"{p}h"), 1))
           .withColumn(f"{p}h", _pairs(F.col(f"{p}h"), 2))
           .withColumn(f"{p}h", _pairs(F.col(f"{p}h"), 4)))
    h, s, at = F.col(f"{p}h"), F.col(f"{p}s"), F.col(f"{p}at")
    # Only texts with an equal pair of windows are sorted.
    n = F.size(s)
    neighbours = F.zip_with(F.slice(s, F.lit(1), F.greatest(n - 1, F.lit(0))),
                            F.slice(s, F.lit(2), F.greatest(n - 1, F.lit(0))),
                            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    m = F.size(at)
    covered = F.aggregate(
        F.zip_with(F.slice(at, F.lit(1), F.greatest(m - 1, F.lit(0))), F.slice(at, F.lit(2), F.greatest(m - 1, F.lit(0))),
                   lambda a, b: F.least(b - a, F.lit(WINDOW))),
        F.lit(0), lambda acc, x: acc + x)
    out = (out
           .withColumn(f"{p}s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
               F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
           .withColumn(f"{p}at", F.when(s.isNotNull(), F.sort_array(F.array_distinct(
               F.flatten(F.filter(neighbours, lambda x: x.isNotNull()))))))
           .withColumn(f"{p}n_repeat_words",
                       F.when(at.isNull() | (F.size(at) == 0), F.lit(0)).otherwise(covered + F.lit(WINDOW)).cast("long")))
    return out.drop(*(f"{p}{c}" for c in ("words", "lines", "h", "s", "at")))


def rule_passes(rule: Rule, prefix: str = PREFIX) -> Column:
    """One line of the table as a boolean column, never null. Bounds are
    compared without division: ``numerator <= high * denominator``."""
    x = F.col(f"{prefix}{rule.numerator}").cast("double")
    y = F.col(f"{prefix}{rule.denominator}").cast("double") if rule.denominator else F.lit(1.0)
    tests = []
    if rule.low is not None:
        tests.append(x * 100 >= F.lit(rule.low * 100) * y)
    if rule.high is not None:
        tests.append(x * 100 <= F.lit(rule.high * 100) * y)
    return reduce(Column.__and__, tests, F.lit(True))


def verdict(rules: tuple[Rule, ...] = RULES, prefix: str = PREFIX) -> Column:
    """The whole table as one boolean expression: true when every rule holds."""
    return reduce(Column.__and__, (rule_passes(r, prefix) for r in rules), F.lit(True))


def failed_rules(rules: tuple[Rule, ...] = RULES, prefix: str = PREFIX) -> Column:
    """Names of the rules a text breaks, comma-joined in table order."""
    return F.concat_ws(",", *(F.when(~rule_passes(r, prefix), F.lit(r.name)) for r in rules))


def score_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and ``failed_rules`` per document."""
    p = PREFIX
    x = quality_columns(docs, text_col)
    base = (F.col(f"{p}n_words") < 20) | (F.col(f"{p}n_repeat_words") * 100 > F.col(f"{p}n_words") * 30)
    keep = ~base & verdict(tuple(r for r in rules if r.name not in BASE_RULES))
    return x.select(
        F.col("doc_id"),
        *(F.col(f"{p}{c}").alias(c) for c in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")),
        base.alias("base_failed"), keep.alias("kept"), failed_rules(rules).alias("failed_rules"))


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents that pass every rule, with exactly the input's columns.

    The verdict is a generator (one row or none) and not a filter: a filter would
    be pushed below the projections, each measure written out again in it.
    """
    measured = quality_columns(docs, text_col)
    one = F.when(verdict(rules), F.array(F.lit(True))).otherwise(F.expr("cast(array() as array<boolean>)"))
    return measured.withColumn(f"{PREFIX}pass", F.explode(one)).select(*(F.col(f"`{c}`") for c in docs.columns))
