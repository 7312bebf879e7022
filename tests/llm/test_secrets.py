"""Secret spans against plain searches, ownership against counting."""

import hashlib
import random
import re
import string

import pytest

from wardflow.llm import secrets, stages

ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


TEXTS = [
    None, "", "no secret here", "Password = \"hunter2x\" and token:abc", "password: token = abcdef1", "é😀 api_key='" + "f0" * 20 + "'",
    "toKen=abcdef, ſecret=abcdefg, toKen=abcdefg", "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 9, "x" + "0123456789abcdef" * 2,
    "cafe" * 7 + "api_key=zzzzzzz", "Ab3" * 9 + " is mixed", "password=" + "q" * 5 + " passwd = 'longenough'" * 3,
]


def test_base_spans_equal_plain_searches():
    for text in TEXTS:
        assert secrets.written(secrets.base_spans(text or "")).split(",") == (brute(text) or [""]), text


@pytest.fixture
def docs(spark):
    rows = [(i, t, f"s{i % 3}", "x") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, "copied " + "Zz9y" * 6 + " everywhere", f"s{i % 3}", "x") for i in range(6)]
    rows += [(200, "key Qq7w" * 1 + "Qq7w" * 6, "s0", "x"), (None, "token = abcdefgh", None, None), (3, TEXTS[3], "s0", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, hash string")


def test_rows(docs):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert by_id[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [s for s in by_id[i].spans.split(",") if s and not s.startswith("owned")] == want
        assert by_id[i].n_assign == sum(s.startswith("assign") for s in want)
    assert all(by_id[100 + i].spans.startswith("owned:") for i in range(6)), "copies of one text are no spread"
    assert by_id[200].spans.startswith("owned:") and by_id[10].n_owned == 1
    assert secrets.find_secrets(docs.where("false")).collect() == []


def test_masks(spark, docs):
    whole = docs.drop("hash").selectExpr("*", "length(text) AS n_chars")
    out = stages.secret_scan(spark, whole, "")
    assert out.columns == whole.columns and out.count() == whole.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[9].text == stages.MASK and by_id[9].n_chars == len(stages.MASK), "overlapping spans are one"
    assert by_id[0].text is None and by_id[2].text == TEXTS[2] and "Zz9y" not in by_id[100].text
    assert by_id[8].text == "x" + stages.MASK


def test_copies_of_a_text_are_no_example(spark):
    key, known, mixed = "AKIA" + "Q7" * 9, "AKIA" + "Z3" * 9, "Vv8w" * 6
    rows = [(i, f"id {key} here", f"s{i % 12}") for i in range(40)]  # one text, mirrored widely
    rows += [(100 + i, f"other text {i} password = topsecret1", f"s{i % 3}") for i in range(8)]
    rows += [(200 + i, f"manual {i} says {known}", f"s{i % 12}") for i in range(40)]
    rows += [(300 + i, f"mine {i % 5} {mixed}", f"s{i % 2}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by_id = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert all(by_id[i].n_live == 1 and by_id[i].n_copied == 0 for i in (*range(40), *range(100, 108)))
    assert all(by_id[i].n_live == 0 and by_id[i].n_copied == 1 for i in range(200, 240))
    assert all(by_id[i].n_owned == 1 for i in range(300, 310))
    texts = {r.doc_id: r.text for r in stages.secret_scan(spark, docs, "").collect()}
    assert texts[0] == "id [secret] here" and texts[100] == "other text 0 [secret]" and known in texts[200]
    assert mixed not in texts[300]


def test_owners_and_truth(spark):
    """A made corpus: keys of one owner, keys passed round in copies, keys of manuals, and names."""
    rng = random.Random(11)
    made = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = "customer invoice shipping delivery handler factory builder response request session context manager".split()
    named = lambda: "".join(w.capitalize() for w in rng.sample(words, 4)) + str(rng.randint(1, 99))
    rows, live, known, names = [], [], [], []
    for i in range(300):  # each in one owner's repositories
        live.append(made(rng.randint(24, 44)))
        rows += [(f"repo note {i} {k} {live[-1]} end", f"own{i % 40}", f"r{i}-{k}") for k in range(rng.randint(1, 4))]
    for i in range(20):  # one text, mirrored by many owners
        live.append(made(32))
        rows += [(f"mirror {i} {live[-1]}", f"own{k}", f"m{i}-{k}") for k in range(30)]
    for i in range(20):  # different texts of many owners
        known.append(made(32))
        rows += [(f"manual {i} page {k} {known[-1]}", f"own{k}", f"d{i}-{k}") for k in range(30)]
    for i in range(300):
        names.append(named())
        rows.append((f"class {names[-1]} of {i}", f"own{i % 40}", f"n{i}"))
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, owner string, repo string")
    got = secrets.find_secrets(docs, owner=docs["owner"], repository=docs["repo"]).select("doc_id", "n_owned").collect()
    owned = [rows[r.doc_id][0] for r in got if r.n_owned]
    caught = sum(any(v in t for t in owned) for v in live)
    assert caught >= 0.97 * len(live)
    assert not any(v in t for v in known for t in owned)
    assert sum(any(v in t for t in owned) for v in names) <= 0.03 * len(names)
