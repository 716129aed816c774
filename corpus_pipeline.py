"""From raw documents to packed training sequences: five stages, each one of the operators in ``stratalake.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before has kept.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, packing, quality, simhash, substrings
from stratalake.llm.common import labelled_sample, stored, table


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and the other columns by number, so that no name clashes with an operator's."""
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in other(docs).items()])


def other(docs: DataFrame) -> dict[str, str]:
    return {c: f"_other{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}


def unpacked(done: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs``, as they were but for those changed."""
    return done.select(*[changed.get(c, F.col(other(docs).get(c, c))).alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", quality.LEARN_DOCS))
    return unpacked(quality.score(packed(docs), model, packed(docs).columns).filter(F.col("score") >= 0.5), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: that of the smallest doc_id, NULL first.

    Rows are told apart by two hashes of id and text, so a missing or repeated id loses no document; of rows
    equal in both, one stays.
    """
    keyed = packed(docs).withColumns({"_k": F.xxhash64("doc_id", "text"), "_h": F.xxhash64("text", "doc_id", F.lit(1))})
    found = simhash.near_duplicates(keyed.select(F.struct("doc_id", "_k", "_h").alias("doc_id"), "text"))
    keepers = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id._k", "doc_id._h").distinct()
    first = F.row_number().over(Window.partitionBy("_k", "_h").orderBy("_k"))
    return unpacked(keyed.join(keepers, ["_k", "_h"], "left_semi").withColumn("_n", first).filter("_n = 1"), docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages leave the texts; a text without any stays as it is.  Every document stays, if empty."""
    done = substrings.remove_repeats(packed(docs), keep_text=True)
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(other(docs)["n_chars"]))
    return unpacked(done, docs, **changed)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontaminate.benchmark_hits(packed(docs), table(spark, sf_dir, "benchmark"), keep_text=True)
    return unpacked(decontaminate.verdicts(found).filter(~F.col("contaminated")), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenized documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_classifier", quality_stage), ("simhash_near_dedup", near_duplicate_stage), ("substring_dedup", substring_stage),
          ("benchmark_decontamination", decontamination_stage), ("packing", packing_stage)]

#: SQL cannot express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
