"""Column functions shared by the operators; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Surrogate keys must equal those of existing warehouse tables.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

MONEY = "decimal(19,4)"
WIDE_MONEY = "decimal(38,4)"
EPOCH = "1970-01-01 00:00:00"

_OFFSET_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"
_UUID = r"^[0-9a-fA-F]{1,8}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,12}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_blank(c: str | Column) -> Column:
    """The text itself, or NULL when it is empty or only whitespace."""
    return F.when(col(c).rlike(r"\S"), col(c))


def or_unknown(c: str | Column) -> Column:
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit("unknown"))


def surrogate_key(*cols: str | Column) -> Column:
    parts = [F.coalesce(col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def money(c: str | Column) -> Column:
    """Two decimals, half up, held as decimal(19,4)."""
    return F.round(col(c).cast("decimal(28,9)"), 2).cast(MONEY)


def wide_sum(c: str | Column) -> Column:
    return F.sum(col(c)).cast(WIDE_MONEY)


def clamp01(c: str | Column) -> Column:
    return F.least(F.greatest(col(c), F.lit(0.0)), F.lit(1.0))


def is_uuid(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(_UUID), F.lit(False))


def millis(c: str | Column) -> Column:
    return F.date_trunc("millisecond", col(c))


def instant(c: str | Column) -> Column:
    """Date-time with a zone offset, cut to milliseconds; anything else is NULL."""
    text = col(c)
    return F.when(text.rlike(_OFFSET_TIME), millis(text.try_cast("timestamp")))


def lenient_time(c: str | Column) -> Column:
    """Best effort: any date-time Spark reads, or epoch seconds; NULL when nothing fits."""
    text = F.trim(col(c))
    seconds = F.when(text.rlike(r"^\d{9,10}$"), F.timestamp_seconds(text.try_cast("long")))
    return millis(F.coalesce(seconds, text.try_cast("timestamp")))


def time_or_zero(c: str | Column) -> Column:
    return F.coalesce(lenient_time(c), F.lit(EPOCH).cast("timestamp"))


def severity(score: str | Column) -> Column:
    return F.when(col(score) >= 0.9, "critical").when(col(score) >= 0.7, "high").otherwise("medium")


def literal_time(text: str) -> Column:
    return F.lit(text).cast("timestamp")
