"""A quality classifier of sparse rules: tree paths over text statistics, lasso weights, plain column expressions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import words, written

#: Statistics of a text, in the order of the rules' feature numbers.
STATISTICS = (
    "characters",
    "words",
    "word_length",
    "distinct_words",
    "symbols",
    "capitals",
    "digits",
    "blanks",
    "lines",
    "distinct_lines",
    "stops",
    "symbol_words",
)
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Condition = tuple[int, str, float]
Rule = tuple[Condition, ...]


def statistics(text: Column) -> Column:
    """array<double> of ``STATISTICS``: counts, and shares of words, characters or lines; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    length, lines = F.length(text).cast("double"), F.split(text, "\n")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)

    def of(w: Column) -> Column:
        n = F.size(w).cast("double")
        return F.array(
            F.log1p(length),
            F.log1p(n),
            share(length, n),
            share(F.size(F.array_distinct(w)).cast("double"), n),
            share(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")).cast("double"), length),
            share(length - F.length(F.translate(text, _CAPITALS, "")), length),
            share(length - F.length(F.translate(text, "0123456789", "")), length),
            share(F.regexp_count(text, F.lit(r"\s")).cast("double"), length),
            F.log1p(F.size(lines).cast("double")),
            share(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
            share(length - F.length(F.translate(text, ".", "")), n),
            share(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:'’-]+(?=\s|$)")).cast("double"), n),
        )

    return F.transform(F.array(words(text)), of)[0]  # words are split once


def tree_paths(debug: str) -> list[Rule]:
    """Conjunctions on the way to every node but the root, from a tree's printed form."""
    rules, path = [], []
    for line in debug.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+|Infinity)\)", line)
        if found:
            depth = len(found[1])
            path = [p for p in path if p[0] < depth] + [(depth, (int(found[2]), found[3], float(found[4])))]
            rules.append(tuple(sorted(set(p[1] for p in path))))
    return rules


@dataclass(frozen=True)
class RuleModel:
    """Rules with non-zero weights; no rules and a constant where nothing can be learnt."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, stats: Column) -> Column:
        """Probability of label 1 as one column expression over ``statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for feature, sign, value in rule:
        out = out & ((stats[feature] <= value) if sign == "<=" else (stats[feature] > value))
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    text_col: str = "text",
    id_col: str = "doc_id",
    trees: int = 16,
    depth: int = 3,
    penalty: float = 0.002,
    rows: int = 50_000,
    seed: int = 7,
) -> RuleModel:
    """Fit on about ``rows`` labelled rows at most (by the hash of the id; a documented bound on fitting, statistics
    and scores are of all texts).  Labels other than 0 and 1, and rows without an id, are not used; repeated rows
    count as often as they stand.  Without labels the score is 0.5, with one label its smoothed share."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    few = max(1.0, named.count() / rows)
    named = named.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) / few))
    stats = docs.select(F.col(id_col).alias("id"), statistics(F.col(text_col)).alias("stats"))
    table = written(stats.join(named, "id").select("stats", "label"), "quality-rows")
    count = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        ones, all_ = count.get(1.0, 0), sum(count.values())
        return RuleModel((), math.log((ones + 1) / (all_ - ones + 1)))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, subsamplingRate=0.7
    ).fit(table.select(array_to_vector("stats").alias("features"), "label"))
    rules = sorted({rule for tree in forest.trees for rule in tree_paths(tree.toDebugString)})
    if not rules:
        return RuleModel((), math.log(count[1.0] / count[0.0]))
    hit = F.array(*[holds(rule, F.col("stats")).cast("double") for rule in rules])
    fired = written(table.select(hit.alias("hit"), "label"), "quality-rules").select(array_to_vector("hit").alias("features"), "label")
    lasso = LogisticRegression(featuresCol="features", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(fired)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w)
    return RuleModel(kept, float(lasso.intercept))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``quality_score`` (0 to 1) and ``quality_label`` (1 from 0.5 on): column expressions only.
    Null and empty texts are scored like others; columns of these names are replaced."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("quality_score", "quality_label")]
    rows = docs.select(F.struct(*kept).alias("row"), statistics(F.col(text_col)).alias("stats"))
    scored = rows.select("row", model.score(F.col("stats")).alias("quality_score"))
    return scored.select("row.*", "quality_score", (F.col("quality_score") >= 0.5).cast("int").alias("quality_label"))
