"""Every registered query against its SQL counterpart in another engine."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")
CORPUS = re.compile(r"op\d+_|pipeline$")  # tested with their own operators
QUERIES = {k: v for k, v in entry_points.queries().items() if not CORPUS.match(k)}
ORACLES = {k: v for k, v in entry_points.oracle_sql().items() if not CORPUS.match(k)}
WITHOUT_SQL = {"gbt_h1", "model_registry", "score_latest", "stream_score", "text_classify"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(found):
    def text(v):
        return "~" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in found)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = plain([tuple(r[i] for i in order) for r in cursor.fetchall()])
    got = plain([tuple(r) for r in df.select(*columns).collect()])
    assert got == want and want


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_model_query_has_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0


def test_stream_scores_all_horizons(spark):
    df = QUERIES["stream_score"](spark, SF_DIR)
    wanted = [f"predicted_arrivals_h{h}" for h in (1, 4, 24)]
    assert [c for c in df.columns if c.startswith("predicted_")] == wanted
    assert df.count() > 0 and df.dropna(subset=wanted).count() == df.count()


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "window_start", "hour", "arrivals_count", "wait_avg_60m", "queue_size", "occupied_beds",
        "occupancy_rate", "risk_score", "dt", "sector_id"]
