"""The registered corpus queries and the pipeline over given tables, against brute force."""

import base64
import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from test_outliers import brute as base_counts
from test_suffix import brute as repeats
from wardflow.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")

ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    rows = read("documents")
    found = {r["doc_id"]: r["text"] or "" for r in rows}
    assert len(found) == len(rows) > 0
    return found


def by_id(df):
    rows = df.collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        of = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=of, special_tokens={})


def test_secrets(spark, texts):
    got = by_id(queries.op1_secret_scan(spark, SF_DIR))
    assert set(got) == set(texts)
    for i, t in texts.items():
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        names = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("owned")] == names


def test_fingerprints(spark, texts):
    prints = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(LOWER))
        shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], dtype=np.uint64)
        prints[i] = sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            best = min(least[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3)
            changed |= best < least[a]
            least[a] = min(best, least[a])
    got = by_id(queries.op2_simhash_components(spark, SF_DIR))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", least[i]) for i, p in prints.items()}


def test_shards(spark, texts):
    got = by_id(queries.op4_hypergeometric_shards(spark, SF_DIR))
    assert {i: (r["size"], r.text_crc32) for i, r in got.items()} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    slots = {}
    for r in got.values():
        slots.setdefault(r.shard, []).append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_scores(spark, texts):
    got = by_id(queries.op5_rule_ensemble(spark, SF_DIR))
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_repeats(spark, texts):
    got = by_id(queries.op7_exact_substrings(spark, SF_DIR))
    want = dict(zip(texts, repeats(list(texts.values()))))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want


def test_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = {}, 0
    for i in sorted(texts):
        ids = [*library.encode(texts[i], add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    got = by_id(queries.op8_huffman_files(spark, SF_DIR))
    assert {i: (r.start, r.n_tokens, r.ids_crc32) for i, r in got.items()} == want


def test_ids(spark, texts):
    encoding = ranks()
    got = by_id(queries.op9_bpe_roundtrip(spark, SF_DIR))
    for i, t in texts.items():
        ids = encoding.encode_ordinary(t)
        assert tuple(got[i][c] for c in ("n_tokens", "ids_sha256", "decoded_sha256")) == (
            len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_licenses(spark, texts):
    got = by_id(queries.op12_license_rules(spark, SF_DIR))
    assert set(got) == set(texts)
    for i, t in texts.items():
        w = LICENSE_WORD.findall(t.translate(LOWER))
        places = [(k, k + len(p.split()) - 1, label) for p, label in LICENSES.items()
                  for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        labels = sorted({label for _, _, label in places})
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(labels))
        assert r.first_word == min((k for k, _, _ in places), default=None)
        assert r.last_word == max((k for k, _, _ in places), default=None)
        assert set(labels) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_pipeline(spark, texts):
    judged = by_id(queries.op6_quality_outliers(spark, SF_DIR))
    for i, t in texts.items():
        r = judged[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(t)
        assert not (r.kept and r.base_failed)
    passed = {i for i, r in judged.items() if r.kept}
    got = by_id(corpus_pipeline.run(spark, SF_DIR))
    assert got and set(got) <= passed
    # No two rows with one text, and none that holds a whole passage of the benchmark.
    passages = [" ".join(WORD.findall(r["text"].translate(LOWER))) for r in read("benchmark")]
    flat = {i: " ".join(WORD.findall(t.translate(LOWER))) for i, t in texts.items()}
    assert not [i for i in got if any(p and f" {p} " in f" {flat[i]} " for p in passages)]
    assert len({texts[i] for i in got}) == len(got)
    encoding = ranks()
    masked = 0
    for i, r in got.items():
        same = r.ids_sha256 == hashlib.sha256(packed(encoding.encode_ordinary(texts[i]))).hexdigest()
        masked += not same
        assert same or ASSIGN.search(texts[i]) or re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", texts[i])
    assert masked < len(got)
