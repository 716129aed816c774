"""Learned quality rules: a decision list of threshold conjunctions, grown and pruned by sequential covering.

Text statistics are SQL expressions over the whole text.  Labelled documents are binned at quantiles of
each statistic; every step of growing a rule is one Spark aggregation of label counts by statistic and bin, so the
driver sees counts only.  A rule grows while its information gain is positive, is cut back to the
prefix that does best on rows kept apart for pruning, and covered rows leave before the next rule grows.
The list becomes one conditional expression.

Defined results: NULL, empty and wordless texts have zero statistics and fail the base rule (under 50 words).  Without
labelled rows of both labels the list is empty and the base rule alone decides.  Repeated rows are judged each; a
document labelled twice counts with its lowest label; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import any_of, labelled_sample, stored, table

SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Labelled documents used at most; cut points of a statistic; conditions of a rule; rules.
LEARN_DOCS, BINS, CONDITIONS, RULES = 20_000, 31, 4, 12
#: A rule needs this share of right rejections on the rows kept for pruning, and so many of them.
LEAST_PRECISION, LEAST_SUPPORT = 0.8, 3

#: Statistics that rules may use: name and expression over the counted columns.
RATIOS = {
    "mean_word_length": "word_chars / n_words", "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)", "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words", "upper_share": "n_upper / word_chars", "digit_share": "n_digits / word_chars",
    "mark_share": "n_marks / n_words", "adjacent_share": "n_adjacent / n_words", "log_words": "log2(n_words)",
}


def _repeat_words(grams: Column) -> Column:
    """Words covered by a window of three that the array of window hashes holds twice or more."""
    placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def from_sorted(p: Column) -> Column:
        same = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: a["g"].eqNullSafe(b["g"]))
        either = F.zip_with(same, F.concat(F.array(F.lit(False)), same), lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
        hit = F.zip_with(p, either, lambda a, flag: F.when(flag, a["i"]))
        places = F.array_sort(F.array_compact(hit))
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
        walked = F.aggregate(places, zero, lambda acc, i: F.struct(
            (acc["n"] + i + 3 - F.greatest(acc["end"], i.cast("bigint"))).alias("n"), (i + 3).cast("bigint").alias("end")))
        return walked["n"]

    # transform over a one-element array binds the sorted array once.
    found = F.transform(F.array(placed), from_sorted)[0]
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("bigint")).otherwise(found)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with the counts of the contract and more, all bigint."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    words = docs.select(*others, F.coalesce("text", F.lit("")).alias("_t")).select(
        "*", F.array_remove(F.split("_t", SPACE), "").alias("_w"), F.split("_t", "\n").alias("_lines"))
    hashed = words.select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    pairs = F.zip_with("_h", F.slice(F.col("_h"), 2, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    grams = F.slice(F.zip_with(pairs, F.slice(F.col("_h"), 3, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: F.xxhash64(a, b)),
                    1, F.greatest(F.size("_h") - 2, F.lit(0)))
    adjacent = F.size(F.filter(F.zip_with("_h", F.slice(F.col("_h"), 2, F.greatest(F.size("_h"), F.lit(1))), lambda a, b: a == b), lambda x: x))
    lines = F.filter("_lines", lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)
    counted = hashed.select("*", grams.alias("_g"), lines.alias("_filled"), adjacent.alias("n_adjacent"))
    kept = F.regexp_replace("_t", SPACE, "")
    out = {
        "n_words": F.size("_w"), "word_chars": F.length(kept), "n_symbols": F.regexp_count("_t", F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("_filled") - F.size(F.array_distinct("_filled")), "n_repeat_words": _repeat_words(F.col("_g")),
        "n_lines": F.size("_filled"), "n_distinct": F.size(F.array_distinct("_h")), "n_adjacent": F.col("n_adjacent"),
        "n_upper": F.regexp_count("_t", F.lit(r"\p{Lu}")), "n_digits": F.regexp_count("_t", F.lit("[0-9]")),
        "n_marks": F.regexp_count("_t", F.lit("[!?;:]")),
    }
    return counted.select(*others, *[c.cast("bigint").alias(n) for n, c in out.items()])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``above``: the statistic is greater than ``cut``, else at most ``cut``; ``bin`` is its place among the cut points."""

    name: str
    number: int
    above: bool
    bin: int
    cut: float

    def binned(self) -> Column:
        value = F.col("bins")[self.number]
        return value > self.bin if self.above else value <= self.bin

    def plain(self) -> Column:
        value = F.expr(RATIOS[self.name])
        return value > self.cut if self.above else value <= self.cut


def _all(conditions: list[Condition], form: str) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & getattr(c, form)()
    return out


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """First-order information gain of a condition that leaves bad of bad0 and good of good0."""
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0))) if bad else 0.0


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of highest gain on ``rows`` (``bins``, ``label``): one aggregation."""
    counts = (rows.select("label", F.posexplode("bins").alias("stat", "bin")).groupBy("stat", "bin")
              .agg(F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("bad"), F.count(F.lit(1)).alias("n")).collect())
    names, best, top = list(cuts), None, 1e-9
    by_stat = {k: sorted((r["bin"], r["bad"], r["n"] - r["bad"]) for r in counts if r["stat"] == k) for k in range(len(names))}
    for k, histogram in by_stat.items():
        bad0, good0 = sum(h[1] for h in histogram), sum(h[2] for h in histogram)
        if not bad0 or not good0:
            return None
        bad = good = 0
        for b, x, y in histogram[:-1]:
            bad, good = bad + x, good + y
            for above, p, n in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                if (g := _gain(p, n, bad0, good0)) > top and b < len(cuts[names[k]]):
                    top, best = g, Condition(names[k], k, above, b, cuts[names[k]][b])
    return best


def learn(statistics: DataFrame) -> list[list[Condition]]:
    """Ordered rules that reject, from rows with the statistics, ``doc_id`` and ``label`` (0 is bad)."""
    rows = stored(statistics.filter(~base_failed()).select(
        (F.col("label") != 0).cast("int").alias("label"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grows"),
        F.array(*[F.expr(e).cast("double") for e in RATIOS.values()]).alias("v")))
    points = [(k + 1) / (BINS + 1) for k in range(BINS)]
    found = rows.select(*[F.percentile(F.col("v")[k], F.array(*map(F.lit, points))).alias(n) for k, n in enumerate(RATIOS)]).first().asDict()
    if any(v is None for v in found.values()):
        return []
    cuts = {n: sorted(set(v)) for n, v in found.items()}
    # A bin is the number of cut points below the value: bin <= b says value <= cut[b].
    bins = [sum(((F.col("v")[k] > x).cast("int") for x in c), F.lit(0)) for k, c in enumerate(cuts.values())]
    left = stored(rows.select("label", "grows", F.array(*bins).alias("bins")).coalesce(1))
    rules: list[list[Condition]] = []
    while len(rules) < RULES:
        rule: list[Condition] = []
        while len(rule) < CONDITIONS and (more := _best(left.filter(F.col("grows") & _all(rule, "binned")), cuts)):
            rule.append(more)
        if not rule:
            break
        # Prune: keep the prefix that does best on the rows kept apart.
        prefixes = [_all(rule[:k + 1], "binned") for k in range(len(rule))]
        sums = left.filter(~F.col("grows")).agg(*[F.sum((p & (F.col("label") == want)).cast("int")).alias(f"{k}_{want}")
                                                  for k, p in enumerate(prefixes) for want in (0, 1)]).first()
        worth = [((sums[f"{k}_0"] or 0), (sums[f"{k}_1"] or 0)) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda k: ((worth[k][0] - worth[k][1]) / max(1, sum(worth[k])), worth[k][0]))
        if worth[k][0] < LEAST_SUPPORT or worth[k][0] < LEAST_PRECISION * sum(worth[k]):
            break
        rules.append(rule[:k + 1])
        left = left.filter(~_all(rules[-1], "binned"))
    return rules


def decision(rules: list[list[Condition]]) -> tuple[Column, Column]:
    """Verdict (True keeps) and the number of the rule that decided, NULL for the default."""
    number = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        number = F.when(_all(rule, "plain"), k).otherwise(number)
    return ~any_of([_all(r, "plain") for r in rules]), number


def apply_rules(statistics: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    verdict, number = decision(rules)
    return (statistics.withColumn("base_failed", base_failed())
            .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.coalesce(verdict, F.lit(True))))
            .withColumn("rule", F.when(~F.col("base_failed"), number)))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", LEARN_DOCS)
    rules = learn(with_statistics(sample))
    return apply_rules(with_statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
