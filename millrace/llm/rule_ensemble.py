"""Quality classifier: a sparse ensemble of rules over text statistics.

The shallow trees of a random forest are grown on a bounded sample of labelled rows; every path from a
root to a node becomes a conjunctive rule; an L1-penalised logistic regression over the
rules keeps few of them; and what is left is compiled into one Spark column expression.

Empty and null texts have statistics of 0 and are scored like any other; texts are read
whole, of any length. Repeated rows get repeated scores; of a repeated id in the labels one
label counts. Without labels of both kinds the score is 0.5 throughout; an empty table gives
no rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.kneser_ney import remainder
from millrace.llm.statistics import RATIOS, described, labelled
from millrace.session import materialise

#: Labelled rows that trees and weights are fitted on, at most.
SAMPLE = 20_000
TREES, DEPTH, LASSO = 24, 3, 0.001
THRESHOLD = 0.3

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


def paths(tree: str, names: tuple[str, ...] = RATIOS) -> list[Rule]:
    """The conditions that lead to each node below the root, from a tree's text form."""
    found, at = [], []
    for depth, kind, feature, sign, value in re.findall(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", tree, re.M):
        level = len(depth)
        at = [x for x in at if x[0] < level]
        at.append((level, (names[int(feature)], sign, float(value))))
        found.append(tuple(condition for _, condition in at))
    return found


def merged(rule: Rule) -> Rule:
    """The same rule with one bound per statistic and direction."""
    bounds: dict[tuple[str, str], float] = {}
    for name, sign, value in rule:
        tight = min if sign == "<=" else max
        bounds[name, sign] = tight(value, bounds.get((name, sign), value))
    return tuple((name, sign, value) for (name, sign), value in sorted(bounds.items()))


def as_column(rule: Rule) -> Column:
    out = F.lit(True)
    for name, sign, value in rule:
        out = out & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
    return out


def train(sample: DataFrame) -> tuple[float, list[tuple[float, Rule]]]:
    """Intercept and weighted rules from rows with ``label`` and the statistics."""
    classes = {row.label: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(classes) < 2:
        return 0.0, []
    assembled = VectorAssembler(inputCols=[*RATIOS], outputCol="features").transform(sample)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt", subsamplingRate=0.7
    ).fit(assembled)
    rules = sorted({merged(rule) for tree in forest.trees for rule in paths(tree.toDebugString)})
    if not rules:
        return 0.0, []
    inputs = sample.select("label", *(as_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))
    inputs = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(inputs)
    fit = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(inputs.select("label", "features"))
    weights = fit.coefficients.toArray()
    return float(fit.intercept), [(float(w), r) for w, r in zip(weights, rules, strict=True) if w]


def compiled(intercept: float, rules: list[tuple[float, Rule]]) -> Column:
    """The probability of a good text, as an expression over the statistics."""
    total = F.lit(intercept)
    for weight, rule in rules:
        total = total + F.when(as_column(rule), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out (crc32(doc_id) mod ``folds`` is 0: never learnt
    from), score and predicted (1 from a score of 0.3)."""
    learnt = labels.where(remainder(folds) != 0)
    chosen = labelled(docs, learnt, "quality", sample)
    intercept, rules = train(materialise(described(chosen, label=True), "rule-sample"))
    score = compiled(intercept, rules)
    return described(docs).select("doc_id", (remainder(folds) == 0).alias("held_out"), score.alias("score")).select(
        "*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
