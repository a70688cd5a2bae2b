"""Scalar helpers as Column expressions; all of them run in the JVM (those over arrays and maps outside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.schemas import MONEY

# fixed values: texts and patterns whose results must match
ELLIPSIS = "..."
REDACTED = "***REDACTED***"
EMAIL_PATTERN = r"^.+@.+\..+$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)[\x00-\x20]*$"
)


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value) if isinstance(value, str) else F.lit(value)


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def valid_positive(value) -> Column:
    """A number above zero; null and NaN are not (NaN sorts above every number in Spark)."""
    value = as_column(value)
    return F.coalesce((value > 0) & is_number(value), F.lit(False))


def valid_natural(value) -> Column:
    value = as_column(value)
    return F.coalesce((value >= 0) & is_number(value), F.lit(False))


def within_range(value, low, high) -> Column:
    value = as_column(value)
    return (value >= low) & (value <= high) & ~F.isnan(value.cast("double"))


def round_half_up(value, decimals: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on doubles: halves go up, also below zero."""
    factor = F.lit(float(10 ** decimals))
    return F.floor(as_column(value).cast("double") * factor + F.lit(0.5)) / factor


def percentage(part, total) -> Column:
    part, total = as_column(part).cast("double"), as_column(total).cast("double")
    return F.when(total == 0, F.lit(0.0)).otherwise(round_half_up(F.try_divide(part, total) * 100, 2))


def truncate(text, max_length: int) -> Column:
    """Cut to max_length characters, ending in an ellipsis where there is room for one.

    Length counts code points, as Spark strings do.
    """
    text = as_column(text)
    if max_length <= len(ELLIPSIS):
        shortened = F.substring(text, 1, max_length)
    else:
        shortened = F.concat(F.substring(text, 1, max_length - len(ELLIPSIS)), F.lit(ELLIPSIS))
    return F.when(F.length(text) <= max_length, text).otherwise(shortened)


def kebab_to_snake(text) -> Column:
    return F.translate(as_column(text), "-", "_")


def snake_to_kebab(text) -> Column:
    return F.translate(as_column(text), "_", "-")


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace("-", "_") for name in df.columns])


def kebab_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace("_", "-") for name in df.columns])


def valid_email(text) -> Column:
    """The whole string must look like a@b.c; a dot does not match a line break."""
    return F.coalesce(as_column(text).rlike(EMAIL_PATTERN.replace("$", r"\z")), F.lit(False))


def try_parse_int(text) -> Column:
    """32-bit integer or null. The pattern guard is needed as try_cast trims blanks."""
    text = as_column(text)
    return F.when(text.rlike(INTEGER_PATTERN.replace("$", r"\z")), text.try_cast("int"))


def try_parse_double(text) -> Column:
    text = as_column(text)
    return F.when(text.rlike(NUMBER_PATTERN.replace("$", r"\z")), text.try_cast("double"))


def safe_get(mapping, key, default) -> Column:
    """Map look-up; the default is used only where the key is absent, a stored null stays null."""
    mapping, key = as_column(mapping), F.lit(key)
    return F.when(F.map_contains_key(mapping, key), F.try_element_at(mapping, key)).otherwise(F.lit(default))


def filter_null_values(mapping) -> Column:
    return F.map_filter(as_column(mapping), lambda _, value: value.isNotNull())


def redact_map(mapping, keys: Iterable[str]) -> Column:
    hidden = list(keys)
    return F.transform_values(
        as_column(mapping), lambda key, value: F.when(key.isin(hidden), F.lit(REDACTED)).otherwise(value)
    )


def redact_columns(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Replace the named columns that exist; names that do not exist are ignored."""
    present = [name for name in keys if name in df.columns]
    return df.withColumns({name: F.lit(REDACTED) for name in present}) if present else df


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def millis_to_timestamp(millis) -> Column:
    return F.timestamp_millis(as_column(millis))


def epoch_millis(ntz) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC, whatever the session time zone is."""
    ntz = as_column(ntz).cast("timestamp_ntz")
    days = F.datediff(ntz.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(ntz) * 3600 + F.minute(ntz) * 60
    fraction = (F.extract(F.lit("SECOND"), ntz) * 1000).cast("bigint")
    return days * 86_400_000 + seconds.cast("bigint") * 1000 + fraction


def iso_instant(millis) -> Column:
    """ISO-8601 UTC text; the fraction is written only when it is not zero."""
    millis = as_column(millis)
    wall = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(millis / F.lit(1000)).cast("decimal(18,6)")
    )
    whole = F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(millis, F.lit(1000))
    fraction = F.when(part == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(part.cast("string"), 3, "0")))
    return F.concat(whole, fraction, F.lit("Z"))


def order_id_text() -> Column:
    """A surrogate id of the form ORDER-{epoch ms}-{0..9999}."""
    return F.concat_ws("-", F.lit("ORDER"), now_millis().cast("string"),
                       F.floor(F.rand() * 10_000).cast("string"))


def money_sum(amount) -> Column:
    """Sum of doubles holding money, in cents-exact decimals, returned as DOUBLE.

    A decimal sum does not depend on the order in which partitions arrive. Amounts too large for the
    decimal are added as doubles, so one absurd row neither fails the job nor gets lost.
    """
    amount = as_column(amount).cast("double")
    cents = amount.try_cast(MONEY)
    outsized = F.sum(F.when(cents.isNull() & amount.isNotNull(), amount))
    return F.coalesce(F.sum(cents).cast("double"), F.lit(0.0)) + F.coalesce(outsized, F.lit(0.0))


def average(total, count) -> Column:
    """total / count as DOUBLE, 0.0 for an empty group."""
    total, count = as_column(total), as_column(count)
    return F.coalesce(F.try_divide(total.cast("double"), count.cast("double")), F.lit(0.0))
