"""Counts and identifiers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import let, strip

_DIGITS = r"[0-9](?:_?[0-9])*"
_FLOAT = rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
_PLAIN_FLOAT = r"\A[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_PLAIN_INT = r"\A[+-]?[0-9]+\z"
# Short enough that the cast cannot fail and a double holds the number exactly. A cast is only
# tried on text that fits: a failing one costs far more than the check.
_SHORT_INT = r"\A-?[0-9]{1,15}\z"


def _no_thousands(col: Column) -> Column:
    """Drop commas and narrow no-break spaces."""
    return F.translate(col, ",\u202f", "")


def _count_of(text: Column) -> Column:
    """Whole part of already stripped text without thousands separators."""
    whole = F.when(text.rlike(_PLAIN_INT), text.try_cast("bigint"))
    real = F.when(text.rlike(_PLAIN_FLOAT), text.try_cast("double"))
    return F.coalesce(whole, real.try_cast("bigint"))


def to_int(col: Column) -> Column:
    """Whole part of a count-like text; text that is no number gives 0.

    Short plain digits are cast at once; only other text goes through the longer way.
    """
    text = col.cast("string")
    general = _count_of(strip(_no_thousands(text)))
    plain = F.when(text.rlike(_SHORT_INT), text.cast("bigint")).otherwise(general)
    return F.coalesce(plain, F.lit(0).cast("bigint"))


def to_rate(col: Column) -> Column:
    """A number as double, or null when the text is none."""
    text = strip(col.cast("string"))
    return F.when(text.rlike(_PLAIN_FLOAT), text.try_cast("double"))


def _number_of(text: Column) -> Column:
    return F.when(text.rlike(_FLOAT), F.translate(text, "_", "").try_cast("double"))


def _digits_of(value: Column) -> Column:
    """The digits of a finite whole number, else null."""
    whole = F.coalesce(value.try_cast("bigint").cast("string"), value.try_cast("decimal(38,0)").cast("string"))
    return F.when(value == F.floor(value).cast("double"), whole)


def normalize_id_key(col: Column) -> Column:
    """Identifier as a stable text key.

    A finite whole number in any notation becomes its digits ('007' and '7.0' are '7',
    '1e5' is '100000'); other text is only trimmed; null gives the empty key. Over many rows
    ``with_id_keys`` is faster: its steps are columns, so nothing is worked out twice.
    """
    text = col.cast("string")
    general = let(
        F.struct(_no_thousands(strip(text)).alias("t")),
        lambda s: F.coalesce(let(_number_of(s["t"]), _digits_of), s["t"]),
    )
    digits_only = text.cast("bigint").cast("string")
    return F.when(text.rlike(_SHORT_INT), digits_only).otherwise(F.coalesce(general, F.lit("")))


def with_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add to_int of {new name: source column}; every step is a column, so each is worked out once."""
    text = {new: F.col(source).cast("string") for new, source in columns.items()}
    stripped = df.withColumns({f"_stripped_{new}": strip(_no_thousands(t)) for new, t in text.items()})
    counts = {}
    for new, raw in text.items():
        plain = F.when(raw.rlike(_SHORT_INT), raw.cast("bigint")).otherwise(_count_of(F.col(f"_stripped_{new}")))
        counts[new] = F.coalesce(plain, F.lit(0).cast("bigint"))
    return stripped.withColumns(counts).drop(*[f"_stripped_{new}" for new in columns])


def with_id_keys(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add normalize_id_key of {new name: source column}; every step is a column of its own.

    Spark is shown that a key is never null: a join on it then adds no filter, which would be pushed
    below an aggregate of the source and work the key out for every raw row.
    """
    text = {new: F.col(source).cast("string") for new, source in columns.items()}
    staged = df.withColumns({f"_text_{new}": _no_thousands(strip(t)) for new, t in text.items()})
    staged = staged.withColumns({f"_number_{new}": _number_of(F.col(f"_text_{new}")) for new in columns})
    keys = {}
    for new, raw in text.items():
        general = F.coalesce(_digits_of(F.col(f"_number_{new}")), F.col(f"_text_{new}"), F.lit(""))
        key = F.when(raw.rlike(_SHORT_INT), raw.cast("bigint").cast("string")).otherwise(general)
        keys[new] = F.coalesce(key, F.lit(""))
    return staged.withColumns(keys).drop(*[f"_{step}_{new}" for step in ("text", "number") for new in columns])
