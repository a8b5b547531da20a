"""Column arithmetic of a high-dynamic-range histogram.

Values keep ``precision`` significant decimal digits: below 2^m they are exact, above that each power
of two is cut in 2^(m-1) equal buckets. A bucket is named by its lowest value, which makes bucket
counts plain grouping keys: they merge by addition over tasks, minutes and services.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.options import HistogramOptions

LONG_MAX = 2**63 - 1


def exact_bits(precision: int) -> int:
    """m: values below 2^m keep their exact value."""
    return (2 * 10**precision - 1).bit_length()


def bucket_limit(opts: HistogramOptions) -> int:
    """Upper bound on the number of buckets one trend window can fill."""
    m = exact_bits(opts.precision)
    return 2**m + max(0, opts.max_value.bit_length() - m) * 2 ** (m - 1)


def to_long(value: Column) -> Column:
    """Truncate towards zero; values beyond the range of a long stop at its end."""
    return F.when(value >= float(LONG_MAX), F.lit(LONG_MAX)).otherwise(value.cast("bigint"))


def recorded(value_us: Column, opts: HistogramOptions) -> Column:
    """Microseconds, held to the highest trackable value, in histogram units."""
    held = F.least(value_us, F.lit(opts.max_value * opts.unit_us).cast("bigint"))
    return F.call_function("div", held, F.lit(opts.unit_us).cast("bigint"))


def _shift(value: Column, opts: HistogramOptions) -> Column:
    """Power of two of the width of a value's bucket.

    The logarithm of value + 1/2 stays clear of whole numbers, by more than a double can be wrong, for
    every value below 2^31; options allow no larger ones. It is one short expression on purpose: it is
    copied into filters and groupings, and the JVM does not compile methods that grow too long.
    """
    top_bit = F.floor(F.log2(value + F.lit(0.5))).cast("int")
    return F.greatest(top_bit - F.lit(exact_bits(opts.precision) - 1), F.lit(0))


def bucket_low(value: Column, opts: HistogramOptions) -> Column:
    """Lowest value of the bucket a recorded value falls in."""
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), _shift(value, opts))
    return value.bitwiseAND(F.negative(width))


def bucket_middle(low: Column, opts: HistogramOptions) -> Column:
    """Middle of the bucket with this lowest value."""
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), _shift(low, opts))
    return low + F.shiftright(width, 1)


def rank_of(percent: int, n: Column, rule: str) -> Column:
    """Rank, from 1, of a percentile among n recorded values."""
    if rule == "half_up":
        rank = F.floor(F.lit(percent / 100.0) * n + F.lit(0.5)).cast("bigint")
    else:
        rank = F.call_function("div", n * percent + 99, F.lit(100).cast("bigint"))
    return F.greatest(rank, F.lit(1).cast("bigint"))


def truncated_std_steps(n: str, total: str, squares: str, name: str) -> list[dict[str, Column]]:
    """Whole parts of mean and population standard deviation, from exact sums, as columns to add in turn.

    The result is in ``{name}_mean`` and ``name``. ``total`` and ``squares`` are decimals, ``n`` is
    bigint. With q = total div n and r = total mod n, the squared distances from q add up to
    d = squares - q (total + r), and the variance is d/n - (r/n)^2. Only the whole part of d/n decides
    the root, unless it is a square and the fractions leave the variance below it. Every value stays in
    the size of the sums, and each step is used more than once, so Spark keeps the steps apart.
    """
    wide, count_type = "decimal(38,0)", "decimal(18,0)"
    mean, rest, whole, guess, root = (f"{name}_{part}" for part in ("mean", "rest", "whole", "guess", "root"))
    count = F.col(n).cast(count_type)
    q = F.col(mean).cast("decimal(19,0)")
    r = F.col(rest)
    v = F.col(whole)
    g = F.col(guess)
    spread = F.col(f"{name}_spread")
    left = spread - v.cast("decimal(19,0)") * count
    below = (left.cast(count_type) * count).cast(wide) < (r.cast(count_type) * r.cast(count_type)).cast(wide)
    return [
        {mean: F.call_function("div", F.col(total), count)},
        {rest: F.col(total) - q * count},
        {f"{name}_spread": F.col(squares) - q * (F.col(total) + r)},
        {whole: F.call_function("div", spread, count)},
        {guess: F.floor(F.sqrt(v.cast("double"))).cast("bigint")},
        {root: F.when(g * g > v, g - 1).when((g + 1) * (g + 1) <= v, g + 1).otherwise(g)},
        {name: F.when((F.col(root) * F.col(root) == v) & below, F.col(root) - 1).otherwise(F.col(root))},
    ]
