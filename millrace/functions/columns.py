"""Column expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Doubles rounded for reports: sums over partitions differ in the last bits.

    The small shift keeps exact halves, common in means of prices, from going either way by such a bit.
    """
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)


def safe_div(n: Column, d: Column) -> Column:
    """n / d as double; 0 where d is not positive."""
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def clean_text(c: Column) -> Column:
    """Trimmed; blank becomes null."""
    return F.nullif(F.btrim(c), F.lit(""))


def to_bigint(c: Column, strict: bool = False) -> Column:
    """Digits to bigint. Strict raises on bad text; otherwise anything but digits, or too many of them, is null."""
    text = F.btrim(c)
    return text.cast("bigint") if strict else F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def to_number(c: Column) -> Column:
    """Decimal from text, scientific notation allowed; NaN, infinities and other text are null."""
    return F.btrim(c).try_cast("decimal(38,10)")


def to_ts(c: Column, sentinels: tuple[str, ...] = (), guard: bool = False) -> Column:
    """Timestamp from text; blank, unreadable and sentinel values are null. guard wants a yyyy-mm-dd start."""
    text = clean_text(c)
    if sentinels:
        text = F.when(~text.isin(*sentinels), text)
    if guard:
        text = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text)
    return text.try_cast("timestamp_ntz")


def null_nonfinite(c: Column) -> Column:
    return F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)


def plain_line(c: Column) -> Column:
    """NUL and CR removed, tab and newline become a blank."""
    return F.translate(F.translate(c, "\t\n", "  "), "\x00\r", "")


def map_code(c: Column, mapping: dict[str, str], default: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c], F.lit(default))


def days_between(ts: Column, as_of: Column) -> Column:
    """Whole days from ts to as_of, rounded down also before zero; fractions of a second count."""
    micros, day = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp")), F.lit(86_400_000_000)
    return ((micros - F.pmod(micros, day)) / day).cast("long")


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b, with fractions."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1e6


def is_distinct(a: list[str], b: list[str]) -> Column:
    """Null-safe: any of the paired columns differs."""
    return ~F.struct(*[F.col(x).alias(f"c{i}") for i, x in enumerate(a)]).eqNullSafe(F.struct(*[F.col(x).alias(f"c{i}") for i, x in enumerate(b)]))
