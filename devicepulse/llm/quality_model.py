"""A quality classifier of sparse rules.

Small trees are grown on statistics of labelled texts; every path from a root to a node is a rule, a
conjunction of comparisons. A logistic regression with an L1 penalty weighs the rules and drops most
of them. What is left compiles into one column expression over the statistics, so scoring a table is a
single pass of built-in functions, with nothing shuffled.

The fit sees at most `Fit.sample` labelled rows, the ones with the smallest hashes of their ids.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicepulse.llm.common import stored
from devicepulse.llm.quality_rules import MEASURES, measure

STATISTICS = (
    "words",
    "word_length",
    "symbols",
    "repeated_lines",
    "repeated_windows",
    "capitals",
    "exclamations",
    "line_length",
)


@dataclass(frozen=True)
class Fit:
    sample: int = 20_000
    trees: int = 12
    depth: int = 3
    penalty: float = 0.003
    seed: int = 7


@dataclass(frozen=True)
class WeightedRule:
    """Holds where all of its (statistic, is_over, threshold) comparisons do."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float

    def column(self) -> Column:
        met = [F.col(s) > t if over else F.col(s) <= t for s, over, t in self.conditions]
        whole = met[0]
        for one in met[1:]:
            whole = whole & one
        return whole


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[WeightedRule, ...]

    def score(self) -> Column:
        """The chance of label 1, from the statistics' columns."""
        total = F.lit(self.bias)
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics as double columns in place of the text; shares of a blank text are 0."""
    measured = measure(df, text)
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    made = {
        "words": F.log1p(F.col("n_words").cast("double")),
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_windows": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "exclamations": share("n_exclamations", "n_words"),
        "line_length": share("n_words", "n_lines"),
    }
    kept = [c for c in df.columns if c not in (text, *MEASURES, *STATISTICS)]
    return measured.select(*[F.col(f"`{c}`") for c in kept], *[made[s].alias(s) for s in STATISTICS])


def _paths(node, so_far: tuple = ()) -> list[tuple]:
    """The conditions of every node below the root."""
    found = [so_far] if so_far else []
    if node.subtreeDepth() == 0:
        return found
    split = node.split()
    at, threshold = STATISTICS[split.featureIndex()], split.threshold()
    found += _paths(node.leftChild(), (*so_far, (at, False, threshold)))
    return found + _paths(node.rightChild(), (*so_far, (at, True, threshold)))


def _merged(conditions: tuple) -> tuple:
    """One upper and one lower comparison for each statistic, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for s, over, t in conditions:
        bounds[s, over] = (max if over else min)(t, bounds.get((s, over), t))
    return tuple((s, over, t) for (s, over), t in sorted(bounds.items()))


def fit(labelled: DataFrame, fit: Fit = Fit(), label: str = "label", doc_id: str = "doc_id") -> RuleModel:
    """Fit on rows of (doc_id, label 0 or 1, statistics). Rows without a label take no part.

    With no rows, or one class only, the model is that share alone: 0.5 without rows.
    """
    chosen = labelled.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("label"), F.xxhash64(doc_id).alias("draw"), *STATISTICS
    )
    # One bounded partition in a fixed order, so that the fit is the same however rows were spread.
    sample = stored(chosen.orderBy("draw", "label", *STATISTICS).limit(fit.sample).coalesce(1), "sample")
    n, ones = sample.select(F.count("*"), F.sum("label")).first()
    if n == 0 or ones in (0.0, float(n)):
        chance = 0.5 if n == 0 else (ones + 1) / (n + 2)
        return RuleModel(math.log(chance / (1 - chance)), ())
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    trees = GBTClassifier(maxIter=fit.trees, maxDepth=fit.depth, seed=fit.seed, labelCol="label").fit(rows)
    paths = [_merged(p) for tree in trees.trees for p in _paths(tree._java_obj.rootNode())]
    rules = [WeightedRule(p, 0.0) for p in dict.fromkeys(paths)]
    if not rules:
        return RuleModel(math.log(ones / (n - ones)), ())
    names = [f"r{i}" for i in range(len(rules))]
    held = sample.select("label", *[r.column().cast("double").alias(x) for r, x in zip(rules, names, strict=True)])
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(held).select("label", "features")
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=fit.penalty, standardization=False, maxIter=200, labelCol="label"
    ).fit(vectors)
    weights = lasso.coefficients.toArray()
    kept = tuple(WeightedRule(r.conditions, float(w)) for r, w in zip(rules, weights, strict=True) if w)
    return RuleModel(float(lasso.intercept), kept)


def score(df: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """Replace the text column by `score`, from 0 to 1. A null or empty text has the score of its
    statistics, which are all 0. Columns named like a statistic or a measurement are not carried along."""
    kept = [c for c in df.columns if c not in (text, "score", *MEASURES, *STATISTICS)]
    return with_statistics(df, text).select(*[F.col(f"`{c}`") for c in kept], model.score().alias("score"))
