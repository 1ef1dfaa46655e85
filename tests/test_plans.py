"""The physical plans the operators are meant to get."""

import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from filmlake.operators import genres as g
from filmlake.operators import tfidf
from filmlake.operators.films import select_films
from filmlake.operators.sentiment import document_sentiment, genre_sentiment
from filmlake.operators.tfidf import fit_vocabulary, weighted_terms
from filmlake.plans import views
from filmlake.plans.registry import REGISTRY
from filmlake.plans.table_queries import film_chain
from filmlake.sources.tables import write_parquet_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_film_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "slim")
    write_parquet_table(views.entities(spark, SF_DIR), path)
    films = select_films(spark.read.parquet(path)).select("wikidata_id", "imdb_id", "nbox")
    text = plan(films)
    for column in ("imdb_id", "genre", "enwiki_title", "rotten_tomatoes_id"):
        assert f"IsNotNull({column})" in text
    read = re.search(r"ReadSchema: struct<(.*)", text).group(1)
    assert "box_office" in read and "director" not in read and "cast_member" not in read
    assert "Exchange" not in text


def test_sentiment_shuffles_genres_only(spark):
    docs = views.table(spark, SF_DIR, "documents").select("doc_id", "text", F.array("lang", "source").alias("genres"))
    scored = document_sentiment(docs, views.lexicon(spark), "doc_id", "text", ("genres",))
    assert "Exchange" not in plan(scored)
    text = plan(genre_sentiment(scored))
    assert text.count("Exchange hashpartitioning(genre") == 1 and "SortAggregate" not in text


def test_term_weights_shuffle_texts_once(spark):
    docs = views.table(spark, SF_DIR, "documents").select(
        "doc_id", "text", F.lit(1).cast("long").alias("mult")
    )
    terms = fit_vocabulary(docs, "text")
    text = plan(weighted_terms(docs, terms, "doc_id", "text"))
    assert text.count("Exchange hashpartitioning") == 1
    assert re.search(r"Exchange hashpartitioning.*\n.*FileScan parquet \[doc_id", text)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_term_counts_spread_with_the_length_of_the_texts(spark, monkeypatch):
    """The partitions were as many for any length, so a task's counts grew with the input."""
    monkeypatch.setattr(tfidf, "TASK_CHARS", 1_000)
    docs = spark.range(3_000).select("id", F.lit("some words of a text").alias("text"))
    for rows in (docs, docs.withColumn("text", F.split("text", " "))):
        counts = tfidf.term_counts(rows, "id", "text")
        assert counts.rdd.getNumPartitions() == 60
        assert counts.groupBy("term", "tf").count().filter("tf = 1 AND count = 3000").count() == (4 if rows is docs else 5)


def testfirst_places_are_hash_aggregated(spark):
    rows = spark.range(10).select(F.col("id").alias("film"), F.lit(0).alias("pos"), F.lit("x").alias("term"))
    text = plan(rows.groupBy("term").agg(g.first_place(rows, "film", "pos")))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_leading_credits_are_cut_before_the_shuffle(spark):
    text = plan(views.leading_credits(spark, SF_DIR, 3))
    below = text[text.index("Exchange hashpartitioning(l_orderkey"):]
    assert "WindowGroupLimit" in below
    # one shuffle serves the ranking and the lists
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1


def test_leading_credits_are_the_first_of_all(spark):
    whole = {r.film_key: r for r in views.credits(spark, SF_DIR).collect()}
    for n in (1, 4):
        got = views.leading_credits(spark, SF_DIR, n).collect()
        assert len(got) == len(whole)
        for r in got:
            w = whole[r.film_key]
            assert (r.cast_member, r.director, r.genre) == (w.cast_member[:n], w.director[:n], w.genre[:n])


def test_a_chain_of_leading_credits_reads_the_line_items_of_its_films(spark, tmp_path):
    """All line items were sorted and grouped, though few films have a plot; rows repeat and keys are null here."""
    made = {
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
            [(k, (k or 0) % 3, 10.0 * k if k else None, datetime(1995, 1, 2)) for k in (1, 2, 2, 3, 4, 13, 23, 30, None)]),
        "customer": ("c_custkey long, c_mktsegment string", [(0, "A"), (1, "B"), (2, None)]),
        "part": ("p_partkey long, p_type string", [(k, f"t{k % 3}") for k in range(40)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double",
            [(k, n, (k or 0) + n, n % 4, 20.0 + n, 7.5, 0.05, None if n == 5 else 0.02)
             for k in (1, 2, 3, 3, 4, 13, 23, 99, None) for n in (1, 2, 3, 5)]),
        "documents": ("doc_id long, text string, lang string, source string, n_chars int",
            [(k, "x", "en", "web", k or 0) for k in (1, 2, 3, 3, 23, 77, None)]),
        "labels": ("doc_id long, quality int", [(1, 1), (3, 0)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    cut = film_chain(spark, str(tmp_path), 3)
    assert "lineitem.parquet" not in plan(cut)
    lists = [F.slice(c, 1, 3).alias(c) for c in ("cast_member", "director", "genre")]
    whole = film_chain(spark, str(tmp_path))
    whole = whole.select(*[c for c in whole.columns if c not in ("cast_member", "director", "genre")], *lists)
    want, got = (Counter(map(str, df.select(*sorted(cut.columns)).collect())) for df in (whole, cut))
    assert got == want and sum(got.values()) > 4
    kept = views.enriched_lines(spark, str(tmp_path)).groupBy("l_orderkey").count().collect()
    assert {tuple(r) for r in kept} == {(1, 4), (2, 4), (3, 8), (23, 4)}


def test_a_chain_of_leading_credits_joins_the_orders_of_its_films(spark, monkeypatch):
    """All orders were read again for the money and the company of films, and shuffled for them."""
    whole = film_chain(spark, SF_DIR, 3)
    monkeypatch.setattr(views, "MOST_WHOLE", 0)
    cut = film_chain(spark, SF_DIR, 3)
    assert "orders.parquet" in plan(whole) and "orders.parquet" not in plan(cut)
    want, got = (Counter(map(str, df.collect())) for df in (whole, cut))
    assert got == want and sum(got.values()) > 10


LAZY = [
    "claims_extract", "films_select", "ratings_join", "film_chain_join", "enrich_lookup",
    "enrich_todo", "linfit_table", "corr_complete", "genre_share", "word_freq_top32", "year_trend",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_all_pairs_join(spark, name):
    text = plan(REGISTRY[name][0](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
