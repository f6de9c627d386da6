"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from flowlake.contract import MISSING_TOKENS

# Alert thresholds.
HIGH, MEDIUM = 0.90, 0.70


def order_key(id_column: str, seed: int = 42) -> Column:
    """A digest that orders rows pseudo-randomly, the same on every run and layout."""
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}")))


def severity(probability: Column) -> Column:
    """Alert grade of a double probability (a 32-bit 0.90 would fall below the bound)."""
    return F.when(probability >= HIGH, "High").when(probability >= MEDIUM, "Medium").otherwise("Low")


def ratio(numerator: Column, denominator: Column) -> Column:
    """IEEE division: a zero denominator gives infinity, or NaN for 0/0."""
    return F.when(denominator != 0, numerator / denominator).otherwise(
        numerator.cast("double") * F.lit(float("inf"))
    )


def log_volume(value: Column) -> Column:
    return F.log1p(F.greatest(value.cast("double"), F.lit(0.0)))


def indicator_tcp(proto: Column) -> Column:
    return F.coalesce((proto == "tcp").cast("int"), F.lit(0))


def indicator_reply(ttl: Column) -> Column:
    return ttl.isNotNull().cast("int")


def finite(value: Column) -> Column:
    """Null instead of NaN or infinity, which JSON cannot carry."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def json_safe(name: str, kind: T.DataType) -> Column:
    """A column as JSON can carry it: numbers stay, NaN and infinity go, the rest is text."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite(column)
    if isinstance(kind, (T.IntegralType, T.BooleanType, T.StringType)):
        return column
    return column.cast("string")


def event_id(*content: Column, number: Column | None = None) -> Column:
    """``evt_<8 digits>_<24 hex>``: a number among equal rows, and a digest of the content.

    The id is the row's own: a replay, another layout of the files or another capture
    beside it do not change it. Nulls are written as a sign of their own.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in content]
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)
    return F.format_string("evt_%08d_%s", (F.lit(0) if number is None else number).cast("long"), F.substring(digest, 1, 24))


def missing_to_null(text: Column) -> Column:
    return F.when(~F.trim(text).isin(*MISSING_TOKENS), text)


def typed(text: Column, kind: str) -> Column:
    """Text to a contract type; what does not parse becomes null."""
    text = missing_to_null(text)
    if kind == "category":
        return text
    number = text.try_cast("double")
    if kind == "float":
        return number
    return F.coalesce(text.try_cast("bigint"), number.try_cast("bigint"))


def failure_summary(names: list[str]) -> str:
    """All failed checks as one log string."""
    return "; ".join(names)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
