"""URL filter: block and allow rules first, a logistic regression on hashed character n-grams for the rest.

The n-grams of host and path are made by SQL functions; the regression is Spark's own.  It learns from a
small labelled URL table, which in the query is drawn from the URLs that a rule decides: a bounded number
of distinct host and path pairs.

Defined results: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is judged by the
model's intercept alone.  Without learning rows of both verdicts, undecided urls take the only known verdict, or are
allowed.  Repeated rows are judged each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import lower_ascii, table

#: Fixed rules of the contract: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Labelled URLs used at most; dimensions of the hashed n-grams; n-gram lengths.
LEARN_URLS, DIMENSIONS, GRAMS = 4_000, 1 << 14, (3, 4)
REGULARIZATION = 0.001


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.withColumns({"host": lower_ascii(F.coalesce(F.regexp_extract("url", pattern, 1), F.lit(""))),
                              "path": F.coalesce(F.regexp_extract("url", pattern, 2), F.lit(""))})


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds ``rule`` (host and path of the longest that fits, NULL if none) and ``rule_verdict``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, name).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def grams(host: str = "host", path: str = "path") -> Column:
    """Distinct character n-grams of the marked host and of the marked path."""
    def of(mark: str, name: str, n: int) -> Column:
        text = F.concat(F.lit(mark), F.col(name), F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(starts, lambda k: F.concat(F.lit(mark), F.substring(text, k, F.lit(n))))

    parts = [of(mark, name, n) for mark, name in (("^", host), ("/", path)) for n in GRAMS]
    return F.array_distinct(F.concat(*parts))


def learn(labelled: DataFrame):
    """Model from ``host, path, verdict``; a verdict instead of a model where only one is known."""
    tf = HashingTF(numFeatures=DIMENSIONS, binary=True, inputCol="grams", outputCol="features")
    known = sorted(r[0] for r in labelled.select("verdict").distinct().collect())
    if len(known) < 2:
        return None, (known or ["allow"])[0]
    rows = labelled.select(grams().alias("grams"), (F.col("verdict") == "block").cast("double").alias("label"))
    # A bounded sample in one partition: the sums, and so the weights, come out the same each time.
    one = tf.transform(rows.repartition(1).sortWithinPartitions("grams")).select("features", "label")
    return LogisticRegression(maxIter=60, regParam=REGULARIZATION).fit(one), None


def judge(pages: DataFrame, model, only: str | None) -> DataFrame:
    """Adds ``verdict`` to rows with ``host``, ``path`` and ``rule_verdict``, and ``block_score`` where a model exists."""
    if model is None:
        return pages.withColumns({"block_score": F.lit(float(only == "block")), "verdict": F.coalesce("rule_verdict", F.lit(only))})
    tf = HashingTF(numFeatures=DIMENSIONS, binary=True, inputCol="_grams", outputCol="_features")
    seen = tf.transform(pages.withColumn("_grams", grams()))
    scored = model.setFeaturesCol("_features").setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("").transform(seen)
    score = vector_to_array("_p")[1]
    return (scored.withColumn("block_score", score)
            .withColumn("verdict", F.coalesce("rule_verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")))
            .drop("_grams", "_features", "_p"))


def labelled_urls(pages: DataFrame, rows: int = LEARN_URLS) -> DataFrame:
    """The small labelled table: distinct host and path pairs that a rule decides, those of smallest hash."""
    decided = pages.filter(F.col("rule_verdict").isNotNull()).select("host", "path", F.col("rule_verdict").alias("verdict"))
    return decided.distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(rows)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_rule(with_parts(table(spark, sf_dir, "pages").select("page_id", "url")))
    model, only = learn(labelled_urls(pages))
    return judge(pages, model, only).select("page_id", "host", "path", "rule", "verdict", "block_score")
