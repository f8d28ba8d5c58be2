"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow random trees are fitted on statistics of labelled texts; every path from a root to a node is a
conjunctive rule.  A logistic regression with a lasso penalty weighs the rules, most of them at zero, and
the rest is compiled into one Spark column expression.  Scoring is a projection: no shuffle, no Python.

The trees and weights are fitted on every labelled text of the training part.  ``measured`` takes the statistics where the
texts are, once for fitting and scoring.  Defined results: NULL and empty texts have statistics of zero and the score of those; NULL
labels are left out; a repeated id is of quality only if all its labels are; without labels of both kinds
every score is the smoothed share of good ones.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.llm.common import stage, temp_name, text_of

TREES = 24
DEPTH = 4
PENALTY = 0.001
_SPACE = r"\s+"


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, F.lit(pattern), F.lit("")))


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, all zero for an empty one."""
    chars = F.length(text)
    trimmed = F.trim(text)
    words = F.filter(F.split(trimmed, _SPACE), lambda w: w != "")
    lines = F.split(text, "\n")
    n_words, n_lines = F.size(words), F.size(lines)
    letters = chars - _without(text, r"\p{L}+")
    upper = chars - _without(text, r"\p{Lu}+")
    digits = chars - _without(text, r"\p{Nd}+")
    spaces = chars - _without(text, _SPACE)
    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": _share(chars - spaces, n_words),
        "letters": _share(letters, chars - spaces),
        "upper": _share(upper, letters),
        "digits": _share(digits, chars - spaces),
        "symbols": _share(chars - spaces - letters - digits, chars - spaces),
        "bars": _share(chars - F.length(F.replace(text, F.lit("|"), F.lit(""))), n_words),
        "calls": _share(chars - F.length(F.replace(text, F.lit("!"), F.lit(""))), n_words),
        "stops": _share(chars - F.length(F.replace(text, F.lit("."), F.lit(""))), n_words),
        "distinct_words": _share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), n_lines),
        "line_words": _share(n_words, n_lines),
    }


@dataclass(frozen=True)
class Ensemble:
    """Rules (conjunctions of (statistic, is at most, threshold)) with weights, and a constant."""

    rules: tuple[tuple[tuple[tuple[str, bool, float], ...], float], ...]
    constant: float

    def score(self, statistic: dict[str, Column]) -> Column:
        z = F.lit(self.constant)
        for rule, weight in self.rules:
            z = z + F.when(_holds(rule, statistic), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _holds(rule, statistic: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [statistic[s] <= F.lit(t) if below else statistic[s] > F.lit(t) for s, below, t in rule])


def tree_rules(description: str, names: list[str]) -> list[tuple[tuple[str, bool, float], ...]]:
    """Every path of the trees in a model's printed form, as a conjunction with one bound per side."""
    rules, path = {}, []
    for line in description.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[3])], m[4] == "<=", float(m[5])))]
        bounds: dict[tuple[str, bool], float] = {}
        for _, (s, below, t) in path:
            known = bounds.get((s, below), t)
            bounds[s, below] = min(known, t) if below else max(known, t)
        rules[tuple(sorted((s, below, t) for (s, below), t in bounds.items()))] = None
    return list(rules)


def measured(df: DataFrame, text: str = "text", statistic: str = "statistics") -> DataFrame:
    """``df`` with each text's statistics instead of the text, so that what follows moves a few numbers a row."""
    held = F.struct(*[c.alias(n) for n, c in statistics(text_of(text)).items()])
    return df.select(*[f"`{c}`" for c in df.columns if c != text], held.alias(statistic))


def fit(training: DataFrame, label: str, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 11) -> Ensemble:
    """An ensemble from rows of ``text``, or without it of what ``measured`` has made of it, and a 0/1 ``label``."""
    rows = measured(training.select("text", label)) if "text" in training.columns else training
    names = rows.schema["statistics"].dataType.names
    rows = stage(rows.select(F.col(label).cast("double").alias("good"), *[F.col(f"statistics.{n}") for n in names]), "quality-statistics")
    good, total = rows.agg(F.coalesce(F.sum("good"), F.lit(0.0)), F.count("*")).first()
    prior = math.log((good + 1) / (total - good + 1))
    if not 0 < good < total:
        return Ensemble((), prior)
    vectors = rows.select("good", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(labelCol="good", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", minInstancesPerNode=3)
    rules = tree_rules(forest.fit(vectors).toDebugString, names)
    if not rules:
        return Ensemble((), prior)
    marks = F.array(*[_holds(r, {n: F.col(n) for n in names}).cast("double") for r in rules])
    lasso = LogisticRegression(labelCol="good", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100)
    model = lasso.fit(rows.select("good", array_to_vector(marks).alias("features")))
    weights = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if abs(w) > 1e-6]
    return Ensemble(tuple(weights), float(model.intercept))


def score_texts(df: DataFrame, ensemble: Ensemble, text: str = "text", score: str = "score", statistic: str | None = None) -> DataFrame:
    """``df`` with each text's probability of being good; its statistics are taken from column ``statistic``, if they are there already."""
    if score.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {score} exists already")
    held = statistic or temp_name(df, "statistics")
    rows = df if statistic else df.withColumn(held, F.struct(*[c.alias(n) for n, c in statistics(text_of(text)).items()]))
    cells = {n: F.col(f"{held}.{n}") for n in rows.schema[held].dataType.names}
    rows = rows.withColumn(score, ensemble.score(cells))
    return rows if statistic else rows.drop(held)
