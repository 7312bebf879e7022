"""Secret scans with corpus-wide ownership.

Fixed patterns find spans in whole texts. Long mixed strings that no pattern explains and that
change between small letters, capitals, digits and signs as often as random ones do are candidates
too. Hashes of all found values are counted by distinct texts, repositories and owners over the
whole corpus. One rule holds for all: a value is an example only if many owners have it in many
different texts, and looks live otherwise; copies of one text are no spread. Candidates that look
live become spans of kind `owned`; spans of the fixed patterns stay whatever their count, with
their verdict beside them.

Values leave the scan as hashes only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, stored

# Fixed patterns. Letters of the assigned names are in either case, ASCII only.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones never hide longer ones
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_MIXED = 6, 20, 20
KINDS = ("assign", "access", "hex", "owned")

#: A value is an example from so many owners, repositories and texts.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, EXAMPLE_TEXTS = 10, 20, 10
#: Least share of neighbouring characters that differ in kind. Random letters and digits have 0.62,
#: names written as joined words about 0.35; of 20 random characters 2 % fall below.
LEAST_CHANGES = 0.4

FOUND = ("doc_id long, _th long, owner string, repository string, _n long, n_assign long, n_access long, n_hex long, "
         "base_sha256 string, base array<struct<kind:int,start:int,end:int,hash:long>>, "
         "more array<struct<kind:int,start:int,end:int,hash:long>>")
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())])


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns, by start and then kind."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        found += [(0, *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if max(map(len, text.split()), default=0) >= 24:
        found += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def changes(value: str) -> float:
    """The share of neighbouring characters of which one is a small letter, capital, digit or
    sign and the other is not."""
    kinds = [_kind(c) for c in value]
    return sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, len(kinds) - 1)


def mixed_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Long random-looking strings with digits and letters of both cases that overlap no fixed span."""
    if max(map(len, text.split()), default=0) < LEAST_MIXED:
        return []
    found = []
    for m in MIXED.finditer(text):
        v, (s, e) = m[0], m.span()
        if (any(c.isdigit() for c in v) and v.lower() != v and v.upper() != v and changes(v) >= LEAST_CHANGES
                and not any(a < e and s < b for _, a, b, _ in taken)):
            found.append((3, s, e, v))
    return found


def written(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, *_ in spans)


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per document with its spans, as columns of FOUND; `_n` numbers the rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "base", "more")}
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                kinds = [k for k, *_ in base]
                for i, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(kinds.count(i))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                for name, spans in (("base", base), ("more", mixed_spans(text, base))):
                    out[name].append([{"kind": k, "start": s, "end": e, "hash": _hash(v)} for k, s, e, v in spans])
            given = {c: batch.column(c) for c in ("doc_id", "_th", "owner", "repository", "_n")}
            made = {c: pa.array(v, pa.list_(_SPAN) if c in ("base", "more") else pa.string() if c == "base_sha256" else pa.int64())
                    for c, v in out.items()}
            yield pa.RecordBatch.from_pydict(given | made)

    bounded_batches(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), owner.cast("string").alias("owner"),
                         repository.cast("string").alias("repository"),
                         F.coalesce(F.col("text"), F.lit("")).alias("text"),
                         F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_th"),
                         F.monotonically_increasing_id().alias("_n"))
    return chosen.mapInArrow(work, FOUND)


def ownership(found: DataFrame) -> DataFrame:
    """`hash, n_owners, n_repositories, n_texts`, counted over the corpus. A value's rows are
    first reduced to one per repository where they are, then per owner, then counted, and to one
    per text likewise: a value that a third of the corpus holds never meets in one task. Null
    owners and repositories count as one each."""
    values = (found.select("owner", "repository", "_th", F.explode(F.concat("base", "more")).alias("s"))
              .select(F.col("s.hash").alias("hash"), F.coalesce("owner", F.lit("")).alias("owner"),
                      F.coalesce("repository", F.lit("")).alias("repository"), "_th"))
    texts = (values.groupBy("hash", "_th").agg(F.lit(1).alias("one"))
             .groupBy("hash").agg(F.count(F.lit(1)).alias("n_texts")))
    return (values.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
            .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))
            .join(texts, "hash"))


def find_secrets(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: counts and spans of the fixed patterns, `spans`
    with the `owned` ones added, and how many spans look live or are widely copied.

    `owner` defaults to the column source; `repository`, a unit within an owner, to each
    text by itself, so that documents of one text count once. A null text counts as empty; a null
    doc_id stays null; equal rows give equal rows. An empty table gives no rows; long texts are read whole. Other
    columns are not read. `found` is an array of
    (start, kind, end, live), positions in code points, end exclusive; `_th` is a hash of the text.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) if repository is None else repository
    found = stored(scan(docs, owner, repository))
    counts = ownership(found)
    spans = found.select("_n", F.explode(F.concat("base", "more")).alias("s")).select("_n", "s.*")
    example = ((F.col("n_owners") >= EXAMPLE_OWNERS) & (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
               & (F.col("n_texts") >= EXAMPLE_TEXTS))
    judged = spans.join(counts, "hash").withColumn("live", ~example)
    # Spans of one document are at most one for each 7 characters of its text.
    per_doc = (judged.where((F.col("kind") < 3) | F.col("live")).groupBy("_n").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("found")))
    named = F.transform("found", lambda x: F.concat_ws(
        ":", F.get(F.array(*[F.lit(k) for k in KINDS]), x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
    return (
        found.join(per_doc, "_n", "left")
        .select("doc_id", "_th", "n_assign", "n_access", "n_hex", "base_sha256",
                F.coalesce(F.array_join(named, ","), F.lit("")).alias("spans"),
                F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == 3)), F.lit(0)).cast("long").alias("n_owned"),
                F.coalesce(F.size(F.filter("found", lambda x: x["live"])), F.lit(0)).cast("long").alias("n_live"),
                F.coalesce(F.size(F.filter("found", lambda x: ~x["live"])), F.lit(0)).cast("long").alias("n_copied"),
                F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")).alias("found")))


def masked(text: Column, found: Column, mask: str) -> Column:
    """`text` with the live spans of `found` replaced; overlapping ones together by one mask."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        F.filter(found, lambda s: s["live"]), begin,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.concat(a["out"], F.when(s["start"] >= a["at"], F.concat(
                F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask))).otherwise("")).alias("out")),
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    return F.when(F.exists(found, lambda s: s["live"]), done).otherwise(text)
