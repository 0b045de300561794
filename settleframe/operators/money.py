"""Exact sums of money held as doubles: no range, no place at which digits are cut, no
overflow, and the same result whatever the order of rows, tasks or partitions.

A value counts with the decimal digits of its shortest text, an integer of at most 17
digits times a power of ten. Almost all amounts lie between a cent's fraction and
1e20 and go into two decimal sums: the part below a thousand with 18 places, and the
thousands. Any other value (a *far* one) is added to the sum of its bin, three powers
of ten wide; the bin is one more grouping key, so for such a row one more row goes
through the aggregate, and a group ends with at most 217 bins. Bins and both sums are
one number in base 1000: carries run through it from the lowest place, and the digits
are read as a double, which rounds once.

Sums hold 1e17 rows of any size. NaN and infinities follow the rules of double sums.
All expressions are built in; aggregates combine map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACES, THOUSAND = 18, 1000
NEAR_FROM, NEAR_BELOW = 0.01, 1e20   # at most 18 places, at most 20 digits before them
BIN = "__bin"
_WIDE, _FINE = "decimal(38,0)", f"decimal(38,{PLACES})"
_NO_BINS = "array<struct<bin:int,v:decimal(38,0)>>"


_LONG = 17   # a text of more characters may hold a digit or two more than the value needs


def shortest_text(v: Column) -> Column:
    """The shortest decimal that reads as a double, as text."""
    text = v.cast("string")
    short = F.coalesce(*(F.when(t.cast("double") == v, t) for t in (F.format_string(f"%.{n - 1}E", v) for n in (15, 16, 17))), text)
    return F.when((F.length(text) > _LONG) & (F.abs(v) < F.lit(float("inf"))), short).otherwise(text)


def digits(text: Column) -> tuple[Column, Column]:
    """(integer, power of ten) of a finite double's text."""
    parts = F.split(text, "E")
    mantissa = parts[0]
    places = F.length(mantissa) - F.instr(mantissa, ".")
    return (F.replace(mantissa, F.lit("."), F.lit("")).cast("decimal(20,0)"),
            F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0)) - places)


def power_of_ten(k: Column) -> Column:
    """10**k for 0 <= k <= 37."""
    return F.rpad(F.lit("1"), k + 1, "0").cast(_WIDE)


PARTS = ("hi", "lo", "rest", "bin", "far")


def with_money_parts(df: DataFrame, amount: str) -> DataFrame:
    """Adds a value's share in the two sums (``__hi``, ``__lo``), in ``__rest`` (not
    finite), or its ``__bin`` and integer ``__far`` there. Step by step, so that no
    expression is written out many times."""
    v = F.col(amount)
    df = df.withColumn("__text", shortest_text(v))
    df = df.withColumn("__d", F.col("__text").try_cast(_FINE))
    size, d = F.abs(v), F.col("__d")
    finite = size < F.lit(float("inf"))
    df = df.withColumn("__near", F.when(size < NEAR_FROM, d.cast("double") == v).otherwise(size < NEAR_BELOW))
    number, power = digits(F.col("__text"))
    far = finite & ~F.col("__near")
    df = df.withColumns({"__number": F.when(far, number), "__power": F.when(far, power), "__lo": F.when(F.col("__near"), d % THOUSAND)})
    df = df.withColumn("__bin", F.floor(F.col("__power") / 3).cast("int"))
    step = power_of_ten(F.col("__power") - 3 * F.col("__bin")).cast("decimal(3,0)")
    return df.withColumns({"__hi": F.when(F.col("__near"), (d - F.col("__lo")).cast(_WIDE)), "__lo": F.col("__lo").cast(_FINE),
                           "__rest": F.when(~finite, v), "__far": (F.col("__number") * step).cast(_WIDE)}) \
        .drop("__text", "__d", "__near", "__number", "__power")


def _normal(sums: Column) -> Column:
    """(carry, text): digits in base 1000, lowest place first in, and what is left above."""
    start = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.lit("").alias("text"))

    def step(acc: Column, s: Column) -> Column:
        total = (acc["carry"] + s).cast(_WIDE)
        place = F.pmod(total, F.lit(THOUSAND).cast("decimal(4,0)")).cast("decimal(4,0)")
        # a multiple of 1000: its last three digits are zeros
        above = (total - place).cast(_WIDE).cast("string")
        carry = F.when(F.length(above) > 3, F.substring(above, F.lit(1), F.length(above) - 3)).otherwise(F.lit("0"))
        return F.struct(carry.cast(_WIDE).alias("carry"), F.concat(F.lpad(place.cast("string"), 3, "0"), acc["text"]).alias("text"))

    return F.aggregate(sums, start, step)


def money_total(hi: Column, lo: Column, rest: Column, far: Column) -> Column:
    """One double from the sums of ``money_parts``; ``far`` holds structs (bin, v) and
    may hold a bin more than once. Null if nothing was summed."""
    whole = F.floor(lo)
    fraction = F.pmod(lo, F.lit(1).cast("decimal(1,0)")).cast("decimal(18,18)")
    nine = F.lit(10**9).cast("decimal(10,0)")
    units = ((fraction * nine).cast("decimal(18,9)") * nine).cast(_WIDE)   # the 18 places as an integer
    entry = lambda b, v: F.struct(F.lit(b).cast("int").alias("bin"), F.coalesce(v, F.lit(0)).cast(_WIDE).alias("v"))
    entries = F.concat(F.array(entry(0, hi), entry(0, whole), entry(-PLACES // 3, units)), F.coalesce(far, F.array().cast(_NO_BINS)))
    bins = F.transform(entries, lambda e: e["bin"])
    zero = F.lit(0).cast(_WIDE)
    sums = F.transform(F.sequence(F.array_min(bins), F.array_max(bins)), lambda b: F.aggregate(
        F.filter(entries, lambda e: e["bin"] == b), zero, lambda acc, e: (acc + e["v"]).cast(_WIDE)))
    up = _normal(sums)
    down = _normal(F.transform(sums, lambda s: (-s).cast(_WIDE)))
    read = lambda n: F.concat(n["carry"].cast("string"), n["text"], F.lit("E"), (3 * F.array_min(bins)).cast("string")).cast("double")
    exact = F.when(up["carry"] >= 0, read(up)).otherwise(-read(down))
    # The usual case without arrays: what a decimal of 38 digits holds, also rounded once.
    usual = (F.size(F.coalesce(far, F.array().cast(_NO_BINS))) == 0) & (F.abs(hi) < 10**18) & (F.abs(lo) < 10**18)
    narrow = f"decimal(37,{PLACES})"   # a sum of two keeps its places
    total = F.when(usual, (hi.cast(narrow) + lo.cast(narrow)).cast("double")).otherwise(exact)
    return F.when(rest.isNotNull(), rest).when(hi.isNotNull() | (F.size(far) > 0), total)


_KIND, _TAG = "__kind", "__tag"   # of a row that goes through the aggregate: itself, a distinct count, a bin
_OWN, _FAR = 0, -1
Aggregate = tuple[str, str | Column]
_FIRST = {"count": F.count, "min": F.min, "max": F.max}
_AGAIN = {"count": F.sum, "min": F.min, "max": F.max}


def _spread(df: DataFrame, amount: str, sums: Mapping[str, Column | None], keys: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Rows with the columns to be summed. A row goes once as itself, tagged with the
    first column to be counted distinctly, once for each further such column, and, if
    its amount is a far one, once for its bin. Only itself holds the other columns."""
    wide = with_money_parts(df, amount)
    cut = lambda c, cond: c if cond is None else F.when(cond, c)
    wide = wide.withColumns({f"__{n}_{p}": cut(F.col(f"__{p}"), cond) for n, cond in sums.items() for p in ("hi", "lo", "rest", "far")})
    entry = lambda kind, b: F.struct(F.lit(kind).alias(_KIND), b.cast("int").alias(BIN))
    usual = [entry(k, F.lit(None)) for k in range(max(1, len(distinct)))]
    rows = wide.withColumnRenamed(BIN, "__of").withColumn("__entry", F.explode(
        F.when(F.col("__of").isNull(), F.array(*usual)).otherwise(F.array(*usual, entry(_FAR, F.col("__of"))))))
    kind = F.col(f"__entry.{_KIND}")
    tag = F.coalesce(*(F.when(kind == k, F.col(c).cast("string")) for k, c in enumerate(distinct)), F.lit(None).cast("string"))
    far = {f"__{n}_far" for n in sums}
    kept = [F.col(c) if c in keys else F.when(kind == (_FAR if c in far else _OWN), F.col(c)).alias(c)
            for c in rows.columns if c not in {"__of", "__entry", "__hi", "__lo", "__rest", "__far"}]
    return rows.select(*kept, kind.alias(_KIND), F.col(f"__entry.{BIN}").alias(BIN), tag.alias(_TAG))


def _states(sums: Sequence[str]) -> list[Column]:
    return [F.sum(f"__{n}_{p}").alias(f"__{n}_{p}") for n in sums for p in ("hi", "lo", "rest", "far")]


def money_states(df: DataFrame, keys: Sequence[str], amount: str, sums: Mapping[str, Column | None],
                 aggregates: Mapping[str, Aggregate] | None = None, distinct: Mapping[str, str] | None = None) -> DataFrame:
    """Sums that are still mergeable: one row per group and bin. Arguments as in
    ``exact_sums``; a row of a bin holds nothing but the bin's sums.

    Distinct counts take one more grouping, by the tags, below the other: plain hash
    aggregates throughout, and a hot group's rows meet only when few are left."""
    aggregates, distinct = dict(aggregates or {}), dict(distinct or {})
    rows = _spread(df, amount, sums, keys, list(distinct.values()))
    first = [_FIRST[op](c).alias(n) for n, (op, c) in aggregates.items()]
    if not distinct:
        return rows.groupBy(*keys, BIN).agg(*first, *_states(list(sums)))
    by_tag = rows.groupBy(*keys, BIN, _KIND, _TAG).agg(*first, *_states(list(sums)))
    counts = [F.count(F.when(F.col(_KIND) == k, F.col(_TAG))).alias(n) for k, n in enumerate(distinct)]
    again = [_AGAIN[op](n).alias(n) for n, (op, _) in aggregates.items()]
    return by_tag.groupBy(*keys, BIN).agg(*again, *counts, *_states(list(sums)))


def merge_states(states: DataFrame, keys: Sequence[str], sums: Sequence[str], aggregates: Mapping[str, Column],
                 sets: Sequence[Sequence[str]] | None = None, told_by: Sequence[str] = ()) -> DataFrame:
    """States of small groups to totals of larger ones, by keys or by grouping sets of
    them; ``told_by``: the aggregates that tell the sets apart."""
    grouped = states.groupBy(*keys, BIN) if sets is None else states.groupingSets([[*s, BIN] for s in sets], *keys, BIN)
    first = grouped.agg(*(c.alias(n) for n, c in aggregates.items()), *_states(sums))
    return money_totals(first, [*keys, *told_by], sums, [n for n in aggregates if n not in told_by])


def money_totals(states: DataFrame, keys: Sequence[str], sums: Sequence[str], others: Sequence[str]) -> DataFrame:
    """Totals from states of the same keys. A group has one row without a bin, which
    holds everything but the bins."""
    bins = {n: F.collect_list(F.when(F.col(f"__{n}_far").isNotNull(), F.struct(F.col(BIN).alias("bin"), F.col(f"__{n}_far").alias("v"))))
            for n in sums}
    one = [F.max(c).alias(c) for c in [*others, *(f"__{n}_{p}" for n in sums for p in ("hi", "lo", "rest"))]]
    whole = states.groupBy(*keys).agg(*one, *(b.alias(f"__{n}_far") for n, b in bins.items()))
    return whole.select(*keys, *others, *(
        money_total(*(F.col(f"__{n}_{p}") for p in ("hi", "lo", "rest", "far"))).alias(n) for n in sums))


def exact_sums(df: DataFrame, keys: Sequence[str], amount: str, sums: Mapping[str, Column | None],
               aggregates: Mapping[str, Aggregate] | None = None, distinct: Mapping[str, str] | None = None) -> DataFrame:
    """``groupBy(keys)`` with exact sums of ``amount``.

    ``sums``: result name to a condition on the rows (None: all). ``aggregates``: other
    aggregates by name, each "count", "min" or "max" and what it is taken of.
    ``distinct``: exact distinct counts by name, each of a column."""
    states = money_states(df, keys, amount, sums, aggregates, distinct)
    return money_totals(states, keys, list(sums), [*(aggregates or {}), *(distinct or {})])


def running_sum(df: DataFrame, amount: str, over: Window, out: str) -> DataFrame:
    """Exact sum of ``amount`` over a window of rows."""
    far = F.when(F.col("__bin").isNotNull(), F.struct(F.col("__bin").alias("bin"), F.col("__far").alias("v")))
    sums = [F.sum(f"__{p}").over(over).alias(f"__sum_{p}") for p in ("hi", "lo", "rest")]
    wide = with_money_parts(df, amount).select(*df.columns, *sums, F.collect_list(far).over(over).alias("__sum_far"))
    return wide.select(*df.columns, money_total(*(F.col(f"__sum_{p}") for p in ("hi", "lo", "rest", "far"))).alias(out))


def with_cents_product(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds a x b of two doubles by their digits, rounded half up to two places. Values
    that are not finite follow the rules of doubles."""
    x, y = F.col(a), F.col(b)
    df = df.withColumns({"__tx": shortest_text(x), "__ty": shortest_text(y),
                         "__finite": (F.abs(x) < F.lit(float("inf"))) & (F.abs(y) < F.lit(float("inf")))})
    (m, p), (n, q) = digits(F.col("__tx")), digits(F.col("__ty"))
    df = df.withColumns({"__m": F.when(F.col("__finite"), (m.cast("decimal(19,0)") * n.cast("decimal(19,0)")).cast(_WIDE)),
                         "__p": F.when(F.col("__finite"), p + q)})
    product, over = F.col("__m"), F.lit(-2) - F.col("__p")      # places beyond the cents
    half = F.lit(5).cast("decimal(1,0)") * F.rpad(F.lit("1"), over, "0").cast("decimal(36,0)")
    df = df.withColumn("__up", F.when((over > 0) & (over <= 36), (F.abs(product) + half).cast(_WIDE).cast("string")))
    up = F.col("__up")
    cents = F.when(F.length(up) > over, F.substring(up, F.lit(1), F.length(up) - over)).otherwise(F.lit("0"))
    sign = F.when(product < 0, F.lit("-")).otherwise(F.lit(""))
    text = (F.when(over <= 0, F.concat(product.cast("string"), F.lit("E"), F.col("__p").cast("string")))
            .when(over <= 36, F.concat(sign, cents, F.lit("E-2"))).otherwise(F.lit("0")))
    return df.withColumn(out, F.when(F.col("__finite"), text.cast("double")).otherwise(x * y)) \
        .drop("__tx", "__ty", "__finite", "__m", "__p", "__up")
