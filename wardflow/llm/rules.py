"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts come from built-in functions. A small forest is fitted on labelled
rows; each path from a root to a node is a conjunctive rule. A lasso-penalised logistic fit gives
most rules no weight; the others become one Spark column expression, so a text is scored without
any model object or Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import stored
from wardflow.llm.outliers import SPACES, words_of

#: Labelled rows that a fit looks at, at most; chosen by a hash of doc_id.
SAMPLE = 20_000
TREES, DEPTH, SEED = 24, 3, 7
PENALTY = 0.002
THRESHOLD = 0.3
FOLDS = 5

STATISTICS = ("log_words", "word_length", "distinct_share", "repeat_share", "upper_share", "digit_share", "symbol_share",
              "mark_share", "line_words", "dup_lines", "other_share")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count(characters: str) -> Column:
    """How many of some characters a text has."""
    return F.length("text") - F.length(F.translate("text", characters, ""))


def with_statistics(docs: DataFrame) -> DataFrame:
    """`doc_id` and STATISTICS of each text. Shares are per word; a text without words has 0."""
    counted = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_words", words_of(F.col("text")))
        .withColumn("_lines", F.split("text", "\n"))
        .select(
            "doc_id", F.size("_words").alias("n"), F.size(F.array_distinct("_words")).alias("distinct"),
            F.size(F.filter(F.transform("_words", lambda w, i: (w == F.get("_words", i - 1)) & (i > 0)), lambda x: x)).alias("repeat"),
            F.length(F.translate("text", SPACES, "")).alias("chars"), _count(_UPPER).alias("upper"),
            _count("0123456789").alias("digit"), _count("#*$%&|<>").alias("symbol"), _count(".,;:!?'\"()-").alias("mark"),
            _count("@/=_+\\[]{}~^").alias("other"), F.size("_lines").alias("lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("dups")))
    n = F.greatest("n", F.lit(1)).cast("double")
    return counted.select(
        "doc_id", F.log1p(F.col("n").cast("double")).alias("log_words"), (F.col("chars") / n).alias("word_length"),
        (F.col("distinct") / n).alias("distinct_share"), (F.col("repeat") / n).alias("repeat_share"),
        (F.col("upper") / F.greatest("chars", F.lit(1))).alias("upper_share"), (F.col("digit") / n).alias("digit_share"),
        (F.col("symbol") / n).alias("symbol_share"), (F.col("mark") / n).alias("mark_share"),
        (F.col("n") / F.col("lines")).alias("line_words"), (F.col("dups") / F.col("lines")).alias("dup_lines"),
        (F.col("other") / n).alias("other_share"))


def held_out(doc_id: Column) -> Column:
    """A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def training_rows(statistics: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most `limit` labelled rows that are not held out, in one small stored table. Labels
    other than 0 and 1 are left out; a document with several labels counts with each."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")).where(
        F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(limit)
    return stored(statistics.join(chosen, "doc_id").coalesce(1).sortWithinPartitions("doc_id", "label", *STATISTICS))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, at most the value or above it, value) that all hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, at_most, value in self.conditions:
            holds = holds & ((F.col(name) <= value) if at_most else (F.col(name) > value))
        return F.when(holds, 1.0).otherwise(0.0)


_LINE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(described: str) -> list[Rule]:
    """Rules of all paths in a printed forest, without repeats, in order of appearance. Of
    several conditions of one kind on a statistic the tightest is kept."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in described.splitlines():
        m = _LINE.match(line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATISTICS[int(m[2])], m[3] == "<=", float(m[4]))))
        tight: dict[tuple[str, bool], float] = {}
        for _, (name, at_most, value) in path:
            pick = min if at_most else max
            tight[name, at_most] = pick(value, tight.get((name, at_most), value))
        found[Rule(tuple(sorted((n, a, v) for (n, a), v in tight.items())))] = None
    return list(found)


@dataclass(frozen=True)
class Model:
    """Weights of the rules that have one."""

    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, w in self.weights:
            total = total + w * rule.column()
        return 1 / (1 + F.exp(-total))


def fit(training: DataFrame) -> Model:
    """Forest, rules, lasso. Without rows the score is 0.5; with one class only, it is that
    class's share after one more row of each."""
    counts = {r.label: r.n for r in training.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(math.log((counts.get(1.0, 0) + 1) / (counts.get(0.0, 0) + 1)), ())
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(training)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5,
                                    featureSubsetStrategy="0.6").fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return Model(math.log((counts[1.0] + 1) / (counts[0.0] + 1)), ())
    table = stored(training.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("features")))
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, standardization=False, maxIter=80).fit(table)
    return Model(lasso.intercept, tuple((r, w) for r, w in zip(rules, lasso.coefficients.toArray().tolist()) if w))


def score_documents(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """`doc_id, held_out, score, predicted` per row of `docs(doc_id, text)`, and the model.

    Labels of held-out documents are never used, and only the text is an input of a score. A
    null text counts as empty and is scored like one; a null doc_id stays null and has no label;
    equal rows give equal rows; an empty table gives no rows, empty labels the score 0.5. Other
    columns are not read.
    """
    statistics = stored(with_statistics(docs))
    model = fit(training_rows(statistics, labels))
    scored = statistics.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")), model
