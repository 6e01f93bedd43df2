"""Join helpers whose strategy depends on a checked size, never on hope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scale
from .ordered import UNKNOWN, hot_keys, with_hot_flag

BROADCAST_BYTES = 48 << 20
SALTS = 64


def data_bytes(df: DataFrame) -> int:
    """Size of the rows, from one distributed aggregate: text by its length, other fields by eight bytes."""
    fields = df.schema.fields
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in fields if isinstance(f.dataType, T.StringType)]
    width = 8 * (len(fields) + 2)
    return df.agg(F.sum(sum(texts, F.lit(width)).cast("long"))).first()[0] or 0


def is_small(df: DataFrame, most: int | None = None) -> bool:
    return data_bytes(df) <= (most or scale(df.sparkSession, "broadcast_bytes", BROADCAST_BYTES))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int | None = None,
    salts: int = SALTS,
    hot: DataFrame | None = UNKNOWN,
) -> DataFrame:
    """Equi join of a large left side whose keys may be hot.

    Rows of a hot key are spread over ``salts`` partitions and only the right rows of hot keys are
    copied; other keys join as usual. Pass ``hot`` when ``left`` is dear to compute: it can be found on
    the table that ``left`` came from.
    """
    hot = hot_keys(left, keys, limit) if hot is UNKNOWN else hot
    if hot is None:
        return left.join(right, list(keys), how)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    big = with_hot_flag(left, hot, keys).withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    small = with_hot_flag(right, hot, keys).withColumn("_salt", F.explode(copies)).drop("_hot")
    return big.drop("_hot").join(small, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    most: int | None = None,
    hot: DataFrame | None = UNKNOWN,
) -> DataFrame:
    """Broadcasts ``right`` when its measured bytes are few, else salts the hot keys of ``left``."""
    if is_small(right, most):
        return left.join(F.broadcast(right), list(keys), how)
    return salted_join(left, right, keys, how, hot=hot)


def with_first(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], limit: int | None = None) -> DataFrame:
    """Adds ``_first``: a struct of ``order`` and ``values`` of the first row of the key.

    Usual keys need one shuffle and a window. Hot keys are reduced by a partial aggregate, whose result
    (a row per hot key, so at most rows / limit) is broadcast back to their rows.
    """
    hot = hot_keys(df, keys, limit)
    struct = F.struct(order, *values)
    window = Window.partitionBy(*keys).orderBy(order)
    if hot is None:
        return df.withColumn("_first", F.first(struct).over(window))
    flagged = with_hot_flag(df, hot, keys)
    usual = flagged.filter(~F.col("_hot")).withColumn("_first", F.first(struct).over(window))
    crowd = flagged.filter(F.col("_hot"))
    firsts = crowd.groupBy(*keys).agg(F.min(struct).alias("_first"))
    return usual.unionByName(crowd.join(F.broadcast(firsts), list(keys))).drop("_hot")


def first_per_key(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns the rank filter into a group limit on the map side, so copies of one key are thinned
    before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
