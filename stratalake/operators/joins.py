"""Join helpers for sides of very different size and for hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its size, computed beforehand, stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


# Rows of one task where a step sorts them several times.
TASK_ROWS = 250_000


def spread(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` into tasks of about ``TASK_ROWS`` rows, at least one for a core.

    Without the number, adaptive execution joins partitions up to a size in compressed bytes, which steps that
    widen and sort the rows turn into many times as much memory.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def skew_join(probe: DataFrame, build: DataFrame, keys: list[str], how: str = "inner",
              share: float = 1 / 256, fanout: int = 64) -> DataFrame:
    """Equi-join that spreads every hot key of ``probe`` over ``fanout`` tasks.

    A key is hot when it holds more than ``share`` of the probe rows, so there are at most
    ``1 / share`` hot keys and their list is small whatever the data.  The salt of a probe row is a
    hash of the row, so a retried task sends its rows to the same place.  Build rows of hot keys are
    repeated ``fanout`` times, others once.  Rows of ``probe`` with a NULL key match nothing, so they are
    salted too, however many there are.
    """
    counts = probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_t"))
    hot = (counts.filter(F.col("_rows") > total.scalar() * F.lit(share))
                 .select(*keys, F.lit(True).alias("_hot")))
    hot = F.broadcast(hot)
    row_hash = F.pmod(F.xxhash64(*[F.col(c) for c in probe.columns]), F.lit(fanout)).cast("int")
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    left = probe.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | unmatched, row_hash).otherwise(F.lit(0))).drop("_hot")
    right = build.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(fanout - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def sized_join(probe: DataFrame, build: DataFrame, keys: list[str], build_bytes: int | None,
               how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``build`` when its known size is below ``limit``; otherwise join by shuffle with hot
    keys spread.  An unknown size counts as large."""
    if build_bytes is not None and build_bytes <= limit:
        return probe.join(F.broadcast(build), keys, how)
    return skew_join(probe, build, keys, how)
