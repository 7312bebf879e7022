"""Quality rules: fixed limits on text statistics, then robust multivariate outliers per group.

Statistics come from built-in functions over whole texts. Per group (language and source) the
minimum-covariance-determinant estimate of the transformed statistics is found by concentration
steps: the rows with the smaller half or so of the distances give the next mean and covariance.
Rows beyond a Mahalanobis distance are rejected. Everything is grouping and column arithmetic:
a group of any size is reduced to counts per bin and sums before it is shuffled. Groups too small
for an estimate of their own are judged by that of their language or of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.common import stored

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "

#: Share of a group's rows that an estimate rests on.
SUPPORT = 0.75
STEPS = 4
#: Groups with fewer rows that pass the fixed limits take the estimate of their language, and
#: those of a language with fewer the estimate of the whole table.
MIN_ROWS = 40
#: Rejected beyond this squared distance: one row in 10^11 of 4 normal statistics.
MAX_SQUARED_DISTANCE = 60.0
#: Least standard deviation of each transformed statistic, so that small differences in a group
#: of near-equal rows are no outliers.
LEAST_SD = (0.5, 0.1, 0.3, 0.15)
#: Median of the chi-squared distribution with 4 degrees of freedom; puts distances to scale.
CHI2_MEDIAN = 3.3567

STATISTICS = ("_x0", "_x1", "_x2", "_x3")
GROUP = ("lang", "source")
#: What an estimate is of: 0 a group, 1 a language, 2 the whole table, the columns left out null.
SCOPE = ("_level", *GROUP)
_BIN = 64.0


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def with_statistics(docs: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """`doc_id, lang, source` and `more` with the five counts of each text (null: no words) and the
    transformed statistics. Each step is a projection, so that arrays are made once."""
    counted = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), *GROUP, *more,
                    F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_words", words_of(F.col("text")))
        .withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("_grams", F.when(F.col("n_words") >= 5, F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - 5).cast("int")),
            lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(5)]))))
        .select(
            "doc_id", *GROUP, *more, "n_words", "_grams",
            F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.length(F.translate("text", SPACES + "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÈÉÊÎÔÛÑÁÍÓÚ", "")).alias("_lower"))
        # Texts without a repeated window, nearly all, are done with one hash set.
        .withColumn("_found", F.when(
            F.size(F.array_distinct("_grams")) < F.size("_grams"),
            F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
        .withColumn("_at", F.sort_array(F.transform(
            F.filter("_found", lambda x, k:
                     F.coalesce(F.get("_found", k + 1)["g"] == x["g"], F.lit(False))
                     | F.coalesce(F.get("_found", k - 1)["g"] == x["g"], F.lit(False))),
            lambda x: x["i"]))))
    # A repeated window adds the words up to the next one, five at most.
    covered = F.aggregate(
        F.transform("_at", lambda i, k: F.least(F.lit(5), F.coalesce(F.get("_at", k + 1) - i, F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.col("n_words")
    some = F.greatest(n, F.lit(1)).cast("double")
    return (
        counted.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        .select("doc_id", *GROUP, *more, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
                F.log1p(n.cast("double")).alias("_x0"),
                F.log1p(F.col("word_chars") / some).alias("_x1"),
                F.log(0.02 + F.col("n_symbols") / some).alias("_x2"),
                F.log(0.2 + (F.col("word_chars") - F.col("_lower")) / some).alias("_x3")))


def _quantiles(rows: DataFrame, values: dict[str, Column], q: float, by: list[str]) -> DataFrame:
    """A quantile of each value per group, to within a bin of 1/64: bins are counted where the
    rows are, so that a group reaches a task as its bins and the result is the same every time."""
    bins = (
        rows.select(*by, F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.floor(v * _BIN).alias("b")) for k, v in values.items()])).alias("s"))
        .groupBy(*by, "s.k", "s.b").count())
    w = W.partitionBy(*by, "k")
    at = (bins.withColumn("below", F.sum("count").over(w.orderBy("b")))
          .withColumn("all", F.sum("count").over(w))
          .where(F.col("below") >= q * F.col("all")))
    return at.groupBy(*by).agg(*[
        ((F.min(F.when(F.col("k") == k, F.col("b"))) + 0.5) / _BIN).alias(k) for k in values])


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean and covariance per group, with the least deviation added to the variances."""
    x = STATISTICS
    return rows.groupBy(*by).agg(
        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(x)],
        *[(F.covar_pop(x[i], x[j]) + F.lit(LEAST_SD[i] ** 2 if i == j else 0.0)).alias(f"_c{i}{j}")
          for i in range(len(x)) for j in range(i + 1)])


def _factored(estimates: DataFrame, by: list[str]) -> DataFrame:
    """The Cholesky factor of each covariance, as columns `_l10` and the like."""
    done = estimates
    for i in range(len(STATISTICS)):
        for j in range(i + 1):
            rest = F.col(f"_c{i}{j}") - sum((F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)), F.lit(0.0))
            done = done.withColumn(f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"_l{j}{j}"))
    kept = [f"_l{i}{j}" for i in range(len(STATISTICS)) for j in range(i + 1)]
    return done.select(*by, *[f"_m{i}" for i in range(len(STATISTICS))], *kept)


def _squared_distance() -> Column:
    """Of a row joined with the estimate of its group, by forward substitution."""
    z: list[Column] = []
    for i, c in enumerate(STATISTICS):
        rest = F.col(c) - F.col(f"_m{i}") - sum((F.col(f"_l{i}{k}") * z[k] for k in range(i)), F.lit(0.0))
        z.append(rest / F.col(f"_l{i}{i}"))
    return sum((x * x for x in z), F.lit(0.0))


def _joined(rows: DataFrame, estimates: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Rows with the estimate of their group; null groups are groups of their own."""
    named = estimates.select(*[F.col(c).alias(f"_g_{c}") for c in by], *[c for c in estimates.columns if c not in by])
    on = [rows[c].eqNullSafe(F.col(f"_g_{c}")) for c in by]
    return rows.join(named, on, how).drop(*[f"_g_{c}" for c in by])


def estimates_of(rows: DataFrame, by: list[str]) -> DataFrame:
    """Robust mean, factor of the covariance and scale of the distances, one row per group."""
    values = {c: F.col(c) for c in STATISTICS}
    medians = _quantiles(rows, values, 0.5, by)
    centred = _joined(rows, medians.select(*by, *[F.col(c).alias(f"_med{i}") for i, c in enumerate(STATISTICS)]), by)
    spread = _quantiles(centred, {c: F.abs(F.col(c) - F.col(f"_med{i}")) for i, c in enumerate(STATISTICS)}, 0.5, by)
    start = _joined(spread.select(*by, *[F.col(c).alias(f"_mad{i}") for i, c in enumerate(STATISTICS)]),
                    medians.select(*by, *[F.col(c).alias(f"_m{i}") for i, c in enumerate(STATISTICS)]), by)
    estimate = stored(_factored(start.select(
        *by, *[f"_m{i}" for i in range(len(STATISTICS))],
        *[(F.pow(1.4826 * F.col(f"_mad{i}"), 2) + LEAST_SD[i] ** 2 if i == j else F.lit(0.0)).alias(f"_c{i}{j}")
          for i in range(len(STATISTICS)) for j in range(i + 1)]), by))
    log_distance = F.log(_squared_distance() + 1e-6)
    for _ in range(STEPS):
        near = _joined(rows, estimate, by).withColumn("_d", log_distance)
        limit = _quantiles(near, {"_limit": F.col("_d")}, SUPPORT, by)
        estimate = stored(_factored(_moments(
            _joined(near, limit, by).where(F.col("_d") <= F.col("_limit")), by), by))
    # The covariance of the nearer rows is too small; the median distance says by how much.
    scale = _quantiles(_joined(rows, estimate, by), {"_half": log_distance}, 0.5, by)
    return stored(_joined(estimate, scale, by).select(
        "*", F.greatest(F.exp("_half") / CHI2_MEDIAN, F.lit(1.0)).alias("_scale")))


def _scope(level: Column) -> list[Column]:
    """The columns of SCOPE at a level, for rows with those of GROUP."""
    lang, source = GROUP
    return [level.alias("_level"), F.when(level < 2, F.col(lang)).alias(lang), F.when(level < 1, F.col(source)).alias(source)]


def group_estimates(rows: DataFrame) -> DataFrame:
    """One row per group of `rows` of with_statistics: the estimate it is judged by, its own or
    that of its language or of the whole table. Only rows that pass the limits count, and only
    estimates that some group needs are made."""
    passed = ~F.col("base_failed")
    sizes = stored(rows.groupBy(*GROUP).agg(F.count_if(passed).alias("_n")))
    langs = stored(sizes.groupBy("lang").agg(F.sum("_n").alias("_of_lang"), F.min("_n").alias("_least")))
    level = F.when(F.col("_n") >= MIN_ROWS, 0).when(F.col("_of_lang") >= MIN_ROWS, 1).otherwise(2)
    groups = stored(_joined(sizes, langs, ["lang"]).withColumn("_at", level))
    whole = not groups.where(F.col("_at") == 2).isEmpty()
    used = F.array_compact(F.array(
        F.when(F.col("_at") == 0, 0), F.when((F.col("_least") < MIN_ROWS) & (F.col("_of_lang") >= MIN_ROWS), 1),
        F.when(F.lit(whole), 2)))
    dealt = _joined(rows.where(passed), groups.select(*GROUP, used.alias("_used")), list(GROUP)).select(
        *GROUP, *STATISTICS, F.explode("_used").alias("_for"))
    estimates = estimates_of(stored(dealt.select(*_scope(F.col("_for")), *STATISTICS)), list(SCOPE))
    named = groups.select(*[F.col(c).alias(f"_own_{c}") for c in GROUP], *_scope(F.col("_at")))
    return stored(_joined(named, estimates, list(SCOPE)).drop(*SCOPE).withColumnsRenamed({f"_own_{c}": c for c in GROUP}))


def judged(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """`rows` of with_statistics with `distance2` and `kept`. Estimates are one row per group, so
    Spark's size check broadcasts them; beyond that, skewed groups are split by adaptive execution."""
    with_estimate = _joined(rows, estimates, list(GROUP), "left").withColumn(
        "distance2", _squared_distance() / F.col("_scale"))
    return with_estimate.withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= MAX_SQUARED_DISTANCE, F.lit(True)))


def judge(docs: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Counts, `base_failed`, `distance2` and `kept` per row of `docs(doc_id, text, lang, source)`;
    the columns named in `more` are handed through.

    One row per input row, equal rows included; a null text has no words and fails. Null
    languages and sources are groups of their own; a null doc_id stays null. Groups with under
    MIN_ROWS passing rows are judged by the estimate of their language, or else of the whole
    table, however few rows that has; distances are null only in a table without a passing row.
    An empty table gives no rows. Other columns are not read.
    """
    rows = stored(with_statistics(docs, more))
    return judged(rows, group_estimates(rows)).select(
        "doc_id", *more, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance2", 6).alias("distance2"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `judge` keeps, all their columns with them, in their order.

    The statistics are made twice: once, stored without texts, for the estimates, once beside
    the texts for the verdicts. So no text is shuffled, however many rows are rejected.
    """
    statistics = stored(with_statistics(docs))
    estimates = group_estimates(statistics)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = with_statistics(docs.withColumn("_row", whole), ("_row",))
    # One condition over both sides of the join: a part of it that needs the counts alone would be
    # pushed below the steps that make them, and repeat these within one expression.
    distance = F.coalesce("distance2", F.lit(0.0)) + F.col("base_failed").cast("double") * (2 * MAX_SQUARED_DISTANCE)
    return judged(rows, estimates).where(distance <= MAX_SQUARED_DISTANCE).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
