"""Tolerant numerics, buckets and score vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(text: Column) -> Column:
    """'' and unparsable text become null instead of failing."""
    return F.nullif(text, F.lit("")).try_cast("double")


def half_even(value: Column, digits: int) -> Column:
    """Rounds the exact binary value, ties to the even digit, as Python's round does.

    The built-in round goes by the shortest decimal text and rounds its ties up: 0.45175, which is
    stored a little below, becomes 0.4518 there and 0.4517 here. The decimal formatter works on the
    exact value. Infinities and NaN stay as they are.
    """
    exact = value.cast("double")
    pattern = F.lit("0." + "0" * digits)
    rounded = F.call_function("format_number", exact, pattern).try_cast("double")
    return F.when(F.isnan(exact) | (F.abs(exact) == float("inf")), exact).otherwise(rounded)


def safe_round(text: Column, digits: int = 4) -> Column:
    return half_even(safe_double(text), digits)


def safe_long(text: Column) -> Column:
    """'5.0' is 5."""
    return safe_double(text).try_cast("bigint")


def millis_to_iso(millis: Column) -> Column:
    """ISO-8601 in UTC with the offset; six fraction digits, none for a whole second. Needs no session
    time zone."""
    days = F.floor(millis / F.lit(86_400_000)).cast("int")
    rest = F.pmod(millis, F.lit(86_400_000))
    day = F.date_add(F.lit("1970-01-01").cast("date"), days)
    part = rest % 1_000
    return F.concat(
        F.date_format(day, "yyyy-MM-dd"),
        F.format_string(
            "T%02d:%02d:%02d",
            F.floor(rest / 3_600_000),
            F.floor(rest / 60_000) % 60,
            F.floor(rest / 1_000) % 60,
        ),
        F.when(part == 0, "").otherwise(F.format_string(".%03d000", part)),
        F.lit("+00:00"),
    )


def bucket_1_5(value: Column, bounds: Sequence[float]) -> Column:
    """5 up to the first bound, then 4, 3, 2; 1 above the last."""
    out = None
    for score, bound in zip((5, 4, 3, 2), bounds, strict=True):
        out = (F if out is None else out).when(value <= bound, score)
    return F.when(value.isNotNull(), out.otherwise(1))


def softmax(logits: Column) -> Column:
    peak = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - peak))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based place of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def named_scores(names: Sequence[str], probs: Column, digits: int = 4) -> Column:
    """array<struct<class_name, confidence>> in class order."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.transform(
        probs,
        lambda p, i: F.struct(
            F.get(labels, i).alias("class_name"), half_even(p, digits).alias("confidence")
        ),
    )


def ratio(num: Column, den: Column) -> Column:
    """Division with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(num, F.nullif(den, F.lit(0))), F.lit(0.0))
