"""Every registered query against its SQL twin at the scale of the correctness check."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_points  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, TWINS = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else str(value)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(TWINS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == expected


MODELS = sorted(n for n in set(QUERIES) - set(TWINS) if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", MODELS)
def test_models_without_twin(spark, name):
    """Every key once, predictions among the values of the training labels, scores in [0, 1]."""
    rows = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(rows)
    if "accuracy" in rows.columns:
        assert rows.n.min() > 0 and rows.accuracy.between(0, 1).all()
    if "f1" in rows.columns:
        assert rows.f1.dropna().between(0, 1).all()
    if "film_key" in rows.columns:
        assert rows.film_key.is_unique and rows.predicted.notna().any()
    if "probability" in rows.columns:
        assert rows.probability.between(0, 1).all() and not rows.duplicated(["film", "genre"]).any()
    if name == "selected_bayes":
        assert not rows.duplicated(["film", "genre"]).any() and set(rows.predicted) <= set(rows.genre)


def test_broadcast_is_checked_by_rows_and_bytes(spark):
    from filmlake.session import broadcast_checked

    df = spark.createDataFrame([("x" * 1000, [1.0] * 100)] * 10, "t string, a array<double>")
    plan = lambda d: d._jdf.queryExecution().toString()
    assert "broadcast" in plan(broadcast_checked(df))
    assert "broadcast" not in plan(broadcast_checked(df, max_rows=9))
    assert "broadcast" not in plan(broadcast_checked(df, max_bytes=10_000))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)
