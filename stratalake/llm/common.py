"""Helpers shared by the training-data operators: tables, words, stored intermediates, numbering."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One learned part in three is held out: rows whose crc32(doc_id as text) mod 3 is 1.
HOLDOUT_FOLDS, HOLDOUT_FOLD = 3, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.  Only a local session without that setting gets a
    temporary one; a cluster must name storage that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="stratalake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows once to shared storage and read them from there: lost executors recompute nothing
    before this point, and several readers don't repeat the work."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def held_out(doc_id: Column) -> Column:
    """False for a NULL id, which cannot be drawn."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLDOUT_FOLDS == HOLDOUT_FOLD, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def kinds(df: DataFrame, columns: list[str]) -> str:
    """Columns and types, as a schema string."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def texts_of(batch: pa.RecordBatch) -> list[bytes | None]:
    """UTF-8 bytes of every whole text."""
    return batch.column("text").cast(pa.binary()).to_pylist()


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str, buckets: int = 256) -> DataFrame:
    """``name``: a number for every row, gapless from 0 in each group, and no group in one task.

    Rows of a group fall into ``buckets`` by a hash of ``order`` (more when the table is large, so that a
    bucket stays small), are numbered there, and start at the count of the buckets before.  Rows equal in
    all of ``order`` are interchangeable, so a repeated task gives the same numbering.
    """
    total = df.count()
    buckets = max(buckets, total // 1_000_000)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = rows.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(*groups, "_bucket", (F.sum("_n").over(
        Window.partitionBy(*groups).orderBy("_bucket")) - F.col("_n")).alias("_before"))
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (rows.withColumn("_k", F.row_number().over(in_bucket))
            .join(before, [*groups, "_bucket"])
            .withColumn(name, F.col("_before") + F.col("_k") - 1).drop("_bucket", "_before", "_k"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``rows`` learning documents at most: not held out, with a non-NULL label and a text, those of smallest hash
    of the id.  A document labelled several times takes its lowest label; repeated ids count once."""
    marks = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(label).alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
            .join(F.broadcast(marks), "doc_id").dropDuplicates(["doc_id"]))
