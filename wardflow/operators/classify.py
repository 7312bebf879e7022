"""Classification of operational text into a structured record."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IDFModel, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardflow.schemas import CLASSIFICATION
from wardflow.session import bounded_batches

SEVERITIES = ("Low", "Medium", "High", "Critical")
PART_ROWS = 1000  # texts whose words a task looks up at once


def fit_text_models(texts: DataFrame, labels: Sequence[str], path: str, *, dims: int = 1 << 13,
                    max_iter: int = 10) -> PipelineModel:
    """One linear text model per 0/1 label column over shared word weights, stored at `path`
    and read back from there.

    Rows without all labels are left out. A model fresh from fitting holds on to its training
    session, which cannot always be sent to tasks; the stored one does not.
    """
    known = texts.na.drop(subset=[*labels, "text"])
    words = "SELECT *, filter(split(lower(text), '\\\\s+'), w -> w <> '') AS words FROM __THIS__"
    weigh = Pipeline(stages=[
        SQLTransformer(statement=words),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=dims),
        IDF(inputCol="counts", outputCol="weights", minDocFreq=2),
    ]).fit(known)
    weighed = weigh.transform(known).select("weights", *labels).persist()
    try:
        PipelineModel([weigh, *[
            LogisticRegression(
                featuresCol="weights", labelCol=label, predictionCol=f"is_{label}",
                probabilityCol=f"p_{label}", rawPredictionCol=f"raw_{label}",
                maxIter=max_iter, regParam=0.01).fit(weighed) for label in labels],
        ]).write().overwrite().save(path)
    finally:
        weighed.unpersist()
    return PipelineModel.load(path)


def _chance(label: str) -> Column:
    return vector_to_array(F.col(f"p_{label}"))[1]


def severity_of(p: Column) -> Column:
    """A probability in four equal steps from Low to Critical."""
    return (F.when(p < 0.25, SEVERITIES[0]).when(p < 0.5, SEVERITIES[1])
            .when(p < 0.75, SEVERITIES[2]).otherwise(SEVERITIES[3]))


def word_slots(words: pa.Array, dims: int) -> np.ndarray:
    """The slot of `dims` that HashingTF gives each word: MurmurHash3 (32 bits, seed 42) of its UTF-8 bytes."""
    raw = words.cast(pa.large_binary())
    data = np.frombuffer(b"".join(raw.to_pylist()) + bytes(4), np.uint8).astype(np.uint32)
    size = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    order = np.argsort(-size, kind="stable")
    at, size = (np.cumsum(size) - size)[order], size[order]
    h = np.full(len(size), 42, np.uint32)

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return (k << 15 | k >> 17) * np.uint32(0x1B873593)

    for i in range(int(size[0]) // 4 if len(size) else 0):
        live = int(np.searchsorted(-size, -4 * (i + 1), side="right"))  # longer words come first
        p = at[:live] + 4 * i
        g = h[:live] ^ mixed(data[p] | data[p + 1] << 8 | data[p + 2] << 16 | data[p + 3] << 24)
        h[:live] = (g << 13 | g >> 19) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = at + size // 4 * 4
    tail = sum(np.where(size % 4 > j, data[np.minimum(rest + j, len(data) - 1)], 0).astype(np.uint32) << 8 * j for j in range(3))
    h ^= mixed(tail) ^ size.astype(np.uint32)
    h = (h ^ h >> 16) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> 13) * np.uint32(0xC2B2AE35)
    out = np.empty(len(h), np.int64)
    out[order] = (h ^ h >> 16).astype(np.int32).astype(np.int64) % dims
    return out


def _weights(model: PipelineModel, label: str) -> np.ndarray:
    """What a word in each slot adds to the log-odds of `label`, asked of the linear model as a
    text of its own: less the intercept, that is the slot's weight."""
    idf = next(s.idf.toArray() for s in model.stages[0].stages if isinstance(s, IDFModel))
    linear = next(s for s in model.stages if s.hasParam("predictionCol") and s.getPredictionCol() == f"is_{label}")
    return linear.coefficients.toArray() * idf + linear.intercept - linear.intercept


def _said(words: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Each distinct word of each list: list, place in the words, the words, contribution."""
    flat = words.flatten().dictionary_encode()
    names, n = flat.dictionary, max(1, len(flat.dictionary))
    pairs = pc.list_parent_indices(words).to_numpy().astype(np.int64) * n + flat.indices.to_numpy()
    pairs, times = np.unique(pairs, return_counts=True)
    row, word = np.divmod(pairs, n)
    return row, word, names, weights[word_slots(names, len(weights))][word] * times


def _causes(words: pa.Array, weights: np.ndarray, top: int) -> list[str | None]:
    """Of each list the words that add most, ties by word; None where no word adds."""
    row, word, names, adds = _said(words, weights)
    row, word, adds = (x[adds > 0] for x in (row, word, adds))
    rank = np.empty(len(names), np.int64)
    rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
    order = np.lexsort((rank[word], -adds, row))
    row, word = row[order], word[order]
    first = np.searchsorted(row, np.arange(len(words) + 1))
    best = [names.take(pa.array(word[a:min(b, a + top)])).to_pylist() for a, b in zip(first[:-1], first[1:])]
    return [", ".join(x) or None for x in best]


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), "\\s+"), lambda w: w != "")


def contributions(texts: DataFrame, model: PipelineModel, label: str, by: str) -> DataFrame:
    """`by, word, contribution`: what each word of a text adds to the log-odds of `label`.

    A word's weight is multiplied by its occurrences in the text. The contributions of a text
    and the intercept add up to the text's log-odds. `by` tells the texts apart.
    """
    weights = _weights(model, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            row, word, names, adds = _said(batch.column("_words"), weights)
            yield pa.RecordBatch.from_arrays([batch.column(by).take(pa.array(row)), names.take(pa.array(word)), pa.array(adds)],
                                             names=[by, "word", "contribution"])

    bounded_batches(texts.sparkSession)
    out = StructType([texts.schema[by]]).add("word", "string").add("contribution", "double")
    return texts.select(by, _words("text").alias("_words")).mapInArrow(run, out)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: words take several times the memory of their text."""
    return (b.slice(at, PART_ROWS) for b in batches for at in range(0, b.num_rows, PART_ROWS))


def causes_of(found: DataFrame, by: str, top: int) -> DataFrame:
    """`by, root_cause`: the words that add most, ties by word; texts that no word speaks for have no row."""
    most = F.sort_array(F.collect_list(F.struct((-F.col("contribution")).alias("c"), "word")))
    return found.where(F.col("contribution") > 0).groupBy(by).agg(
        F.array_join(F.slice(F.transform(most, lambda x: x["word"]), 1, top), ", ").alias("root_cause"))


def sector_named(text: Column, sectors: Sequence[str]) -> Column:
    """The sector whose name stands first in a text as whole words, in either case; null if none."""
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    plain = [F.regexp_replace(F.lower(F.lit(s)), r"[^\p{L}\p{N}]+", " ") for s in sectors]
    places = F.array(*[F.struct(F.position(F.concat(F.lit(" "), p, F.lit(" ")), padded).alias("at"), F.lit(s).alias("name")) for s, p in zip(sectors, plain)])
    return F.array_min(F.filter(places, lambda x: x["at"] > 0))["name"]


def classify(texts: DataFrame, model: PipelineModel, kind_label: str, severity_label: str,
             kinds: tuple[str, str], sector: Column | None = None, *, sectors: Sequence[str] = (),
             causes: int = 3) -> DataFrame:
    """`texts` with a `classification` struct from the models of two labels.

    The models give category, severity and confidence; the action follows from the severity.
    `root_cause` names up to `causes` words that speak most for the severity label, null where none
    does. `impacted_sector` is `sector` if given and not null, else the first of `sectors` that the
    text names. One pass over the texts, without a shuffle.
    """
    weights, kept = _weights(model, severity_label), list(texts.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = pa.array(_causes(batch.column("_words"), weights, causes), pa.string())
            yield batch.select([*kept, "_kind", "_severe"]).append_column("_cause", found)

    bounded_batches(texts.sparkSession)
    out = StructType(list(texts.schema)).add("_kind", "double").add("_severe", "double").add("_cause", "string")
    scored = model.transform(texts).select(
        *[F.col(f"`{c}`") for c in kept], _chance(kind_label).alias("_kind"), _chance(severity_label).alias("_severe"),
        F.col("words").alias("_words")).mapInArrow(run, out)
    p_kind, severity = F.col("_kind"), severity_of(F.col("_severe"))
    given = (sector if sector is not None else F.lit(None)).cast("string")
    record = F.struct(
        F.when(p_kind >= 0.5, kinds[1]).otherwise(kinds[0]).alias("category"),
        severity.alias("severity"),
        F.col("_cause").alias("root_cause"),
        (F.coalesce(given, sector_named(F.col("text"), sectors)) if sectors else given).alias("impacted_sector"),
        F.when(severity.isin("High", "Critical"), "escalate to the duty manager")
        .otherwise("record and review").alias("suggested_action"),
        F.greatest(p_kind, 1 - p_kind).alias("confidence"))
    return scored.select(*[F.col(f"`{c}`") for c in kept], record.alias("classification"))


def classify_with(texts: DataFrame, make_client: Callable[[], Callable[[pd.Series], pd.DataFrame]],
                  text: str = "text") -> DataFrame:
    """`texts` with the record fields added by an external client.

    `make_client` runs once per task and returns a function from a batch of texts to a frame
    with the fields of the record.
    """
    columns, fields = texts.columns, CLASSIFICATION.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for pdf in batches:
            answers = client(pdf[text]).reset_index(drop=True)
            yield pd.concat([pdf[columns].reset_index(drop=True), answers[fields]], axis=1)

    return texts.mapInPandas(run, StructType(list(texts.schema) + list(CLASSIFICATION)))


def validate(records: DataFrame) -> DataFrame:
    """Records with `problem`: the first rule a record breaks, or null."""
    confidence = F.col("confidence")
    return records.withColumn(
        "problem",
        F.when(F.col("category").isNull(), "category missing")
        .when(F.col("severity").isNull() | ~F.col("severity").isin(*SEVERITIES), "severity not allowed")
        .when(F.col("suggested_action").isNull(), "action missing")
        .when(confidence.isNull() | ~confidence.between(0.0, 1.0) | F.isnan(confidence),
              "confidence out of range"))
