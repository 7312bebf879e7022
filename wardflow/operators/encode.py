"""Text to vectors, with an encoder that can be exchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType, StructType

from wardflow.session import bounded_batches

Encoder = Callable[[pd.Series], np.ndarray]

PART_ROWS = 2500  # texts that are encoded at once


def hashing_encoder(dims: int = 256) -> Encoder:
    """Counts of lower-case words, each word in the slot given by its MD5; needs no service.

    Texts are split and counted together as Arrow columns; only their distinct words are hashed,
    and none is remembered.
    """

    def encode(texts: pd.Series) -> np.ndarray:
        lists = pc.split_pattern_regex(pc.utf8_lower(pa.array(texts, pa.large_string())), r"[ \t\r\n]+")
        words = lists.flatten().dictionary_encode()
        names = words.dictionary.cast(pa.large_binary()).to_pylist()
        hashes = b"".join([md5(w).digest()[:2] for w in names])
        slots = np.frombuffer(hashes, ">u2").astype(np.int64) % dims
        slots[[i for i, w in enumerate(names) if not w]] = -1
        slots = slots[words.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        at = pc.list_parent_indices(lists).to_numpy() * dims + slots
        counts = np.bincount(at[slots >= 0], minlength=len(texts) * dims)
        return counts.reshape(len(texts), dims).astype(np.float32)

    return encode


def embed(df: DataFrame, make_encoder: Callable[[], Encoder] = hashing_encoder,
          text: str = "text", out: str = "vector") -> DataFrame:
    """`df` with the vector of `text`. `make_encoder` runs once per task, so an encoder may
    hold a model or a connection; it receives at most PART_ROWS texts at a time, so that what a task
    holds does not grow with its batches. Vectors stay one Arrow column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                vectors = np.asarray(encode(part.column(text).to_pandas()), dtype=np.float32)
                ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
                yield part.append_column(out, pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel())))

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, StructType(list(df.schema)).add(out, ArrayType(FloatType())))
