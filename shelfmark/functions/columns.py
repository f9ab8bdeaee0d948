"""Column expressions shared by the reports. All of them are built-in functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket bounds (inclusive upper ends) and labels of the distribution report.
PRICE_BOUNDS = [100000, 200000, 500000, 1000000]
PRICE_LABELS = ["0-100k", "100k-200k", "200k-500k", "500k-1M", "Over 1M"]
STOCK_BOUNDS = [10, 25, 50, 100]
STOCK_LABELS = ["0-10", "11-25", "26-50", "51-100", "Over 100"]
DISCOUNT_BOUNDS = [0, 10, 25, 50]
DISCOUNT_LABELS = ["No Discount", "1-10%", "11-25%", "26-50%", "Over 50%"]


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(value: Column | str, bounds: Sequence, labels: Sequence[str]) -> Column:
    """Label of the first bound that holds the value; NULL falls to the last label."""
    value = column(value)
    ladder = F.when(value <= F.lit(bounds[0]), F.lit(labels[0]))
    for bound, label in zip(bounds[1:], labels[1:]):
        ladder = ladder.when(value <= F.lit(bound), F.lit(label))
    return ladder.otherwise(F.lit(labels[len(bounds)]))


def discount_bucket(pct: Column | str, labels: Sequence = DISCOUNT_LABELS) -> Column:
    """The first discount bucket is equality with zero, the others are upper bounds."""
    pct = column(pct)
    return discount_ladder(pct == 0, lambda bound: pct <= F.lit(bound), labels)


def discount_ladder(none: Column, at_most: Callable[[int], Column], labels: Sequence) -> Column:
    ladder = F.when(none, F.lit(labels[0]))
    for bound, label in zip(DISCOUNT_BOUNDS[1:], labels[1:]):
        ladder = ladder.when(at_most(bound), F.lit(label))
    return ladder.otherwise(F.lit(labels[-1]))


def discount_pct(price: str = "price", special: str = "special_price") -> Column:
    """Percent off the list price for a SKU on sale, else 0."""
    return F.when(on_sale(special), pct(F.col(price) - F.col(special), price)).otherwise(0)


def discount_range(price: str = "price", special: str = "special_price",
                   labels: Sequence = DISCOUNT_LABELS) -> Column:
    """`discount_bucket(discount_pct())` without a division per row.

    A percentage rounded to two digits is at most `b` when it is below `b + 0.005` before rounding.
    """
    p = F.col(price)
    off = (p - F.col(special)) * 20000
    ladder = discount_ladder(F.abs(off) < p, lambda bound: off < p * (200 * bound + 1), labels)
    return (
        F.when(~on_sale(special), F.lit(labels[0]))
        .when(p > 0, ladder)
        .otherwise(discount_bucket(discount_pct(price, special), labels))
    )


def label_of(number: Column | str, labels: Sequence[str]) -> Column:
    """Label of a bucket number (from 0)."""
    return F.get(F.array(*[F.lit(x) for x in labels]), column(number))


def on_sale(special: Column | str = "special_price") -> Column:
    """True only for a positive sale price; NULL and zero mean no sale."""
    return F.coalesce(column(special) > 0, F.lit(False))


def sale_price(price: Column | str = "price", special: Column | str = "special_price",
               zero_is_no_sale: bool = False) -> Column:
    """Sale price or list price. By default a stored zero counts as a price."""
    special = column(special)
    if zero_is_no_sale:
        special = F.nullif(special, F.lit(0))
    return F.coalesce(special, column(price))


def ratio(num: Column | str, den: Column | str, times: int = 1, digits: int = 2) -> Column:
    """`round(num / den * times, digits)`, half away from zero, NULL for a zero divisor.

    Decimal division keeps too few digits for wide sums, so the quotient is taken in whole units
    of the last digit. Inputs must be integers or decimals with at most two fraction digits.
    """
    n = column(num).cast("decimal(38,2)")
    d = column(den).cast("decimal(38,2)")
    half = F.when(n < 0, -F.abs(d)).otherwise(F.abs(d))
    units = F.call_function("div", n * F.lit(2 * times * 10**digits) + half, F.nullif(d, F.lit(0)) * 2)
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(20,{digits})")


def wide_sum(value: Column, bits: int = 20) -> Column:
    """Exact sum of whole numbers beyond the range of a bigint, at bigint speed.

    High and low bits are summed apart. Holds for 2^43 rows of up to 2^40 on average; more raises an
    overflow error under ANSI.
    """
    high = F.sum(F.shiftright(value, bits)).cast("decimal(38,0)")
    return high * F.lit(1 << bits) + F.sum(value.bitwiseAND(F.lit((1 << bits) - 1)))


def pct(num: Column | str, den: Column | str) -> Column:
    return ratio(num, den, times=100)


def growth(now: Column | str, before: Column | str, integer: bool = False) -> Column:
    """Percent change; `integer` truncates the quotient before it is scaled."""
    diff = column(now) - column(before)
    if integer:
        quotient = F.call_function("div", diff, F.nullif(column(before), F.lit(0)))
        return (quotient * 100).cast("decimal(20,2)")
    return pct(diff, before)


def round2(value: Column | str) -> Column:
    return F.round(column(value), 2)


def whole_number(value: Column | str) -> Column:
    """Fraction to int by rounding half to even (a plain cast would truncate)."""
    return F.bround(column(value)).cast("int")


def epoch_ms(text: Column | str) -> Column:
    """Epoch milliseconds as text, floored to whole seconds; NULL for anything else."""
    millis = column(text).try_cast("bigint")
    return F.timestamp_seconds(F.call_function("div", millis, F.lit(1000)))


def iso_text(ts: Column | str) -> Column:
    """ISO text; the fraction is written only when there is one."""
    ts = column(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % 1000000 == 0, whole).otherwise(fraction)


def hour_of_day_cycle(ts: Column | str) -> Column:
    """Position in the day on a sine wave of 24 hours."""
    return F.sin(F.hour(column(ts)) / 24.0 * 2.0 * F.pi())


def cycle_label(number: Column | str, labels: Sequence[str]) -> Column:
    """`labels[number % k]`."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]),
                        (F.pmod(column(number), F.lit(len(labels))) + 1).cast("int"))


def first_element(arr: Column | str) -> Column:
    """First element or NULL; plain indexing of an empty array raises under ANSI."""
    return F.get(column(arr), F.lit(0))


def decay_depth(decay: float, span: int) -> int:
    """How many spans back a weight `decay ** span` still matters in double precision."""
    return max(1, math.ceil(math.log(1e-30) / (span * math.log(decay))))
