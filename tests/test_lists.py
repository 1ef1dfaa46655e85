import random

import pytest
from pyspark.sql import functions as F

from filmlake.functions.text import fingerprint
from filmlake.operators import genres as g
from filmlake.operators.joins import complete, join_chain, join_ratings, well_rated
from filmlake.operators.metrics import (
    exact_accuracy,
    micro_f1,
    neighbour_accuracy,
    sibling_accuracy,
    tolerance_accuracy,
)
from filmlake.operators.numbering import number_rows, with_neighbours
from filmlake.operators.rare import drop_empty_lists, remove_rare, remove_rare_by_rows
from filmlake.operators.sentiment import document_sentiment, genre_sentiment
from filmlake.operators.vocabulary import concat_features, multi_hot


def lists(spark, data, *names):
    schema = "k long, " + ", ".join(f"{n} array<string>" for n in names)
    return spark.createDataFrame(data, schema)


def test_rare_removal(spark, rows):
    df = lists(spark, [(1, ["a", "b"]), (2, ["a", "c"]), (3, ["d"])], "c")
    assert rows(remove_rare(df, ["c"])) == [(1, ["a"]), (2, ["a"])]


def test_rare_removal_order_matters(spark, rows):
    df = lists(
        spark, [(1, ["a"], ["x"]), (2, ["a"], ["x"]), (3, ["b"], ["x"]), (4, ["b"], ["y"])], "c", "d"
    )
    assert [r[0] for r in rows(remove_rare(df, ["c", "d"]))] == [1, 2, 3]
    assert [r[0] for r in rows(remove_rare(df, ["d", "c"]))] == [1, 2]


def test_rare_removal_counts_occurrences_or_rows(spark, rows):
    df = lists(spark, [(1, ["a", "a", "b"]), (2, ["b"]), (3, ["c"])], "c")
    assert rows(remove_rare(df, ["c"])) == [(1, ["a", "a", "b"]), (2, ["b"])]
    by_rows = remove_rare_by_rows(df, "c")
    assert rows(by_rows) == [(1, ["b"]), (2, ["b"]), (3, [])]
    assert rows(drop_empty_lists(by_rows, "c")) == [(1, ["b"]), (2, ["b"])]


@pytest.mark.parametrize("way", ["in place", "broadcast", "shuffle"])
def test_rare_removal_ways_agree(spark, rows, monkeypatch, way):
    import filmlake.operators.elements as elements

    if way != "in place":
        monkeypatch.setattr("filmlake.session.CONSTANT_MAX_ROWS", 1)
    if way == "shuffle":
        monkeypatch.setattr(elements, "broadcast_checked", lambda df: df)
    rng = random.Random(5)
    data = [(i, ["hot" if rng.random() < 0.4 else f"e{rng.randrange(300)}" for _ in range(4)]) for i in range(400)]
    counts = {}
    for _, items in data:
        for x in items:
            counts[x] = counts.get(x, 0) + 1
    expected = sorted(
        ((k, [x for x in items if counts[x] > 2]) for k, items in data if any(counts[x] > 2 for x in items)),
        key=lambda t: tuple(str(x) for x in t),
    )
    df = lists(spark, data, "c")
    assert rows(remove_rare(df, ["c"], 2)) == expected
    assert remove_rare_by_rows(df, "c", 2).count() == len(data)


def test_corrected_genre_mean(spark):
    scored = spark.createDataFrame(
        [(2, ["g1", "g2"]), (0, ["g1", "g3"]), (-1, ["g1"]), (1, ["g2", "g2"])], "score long, genres array<string>"
    )
    got = {r.genre: (r.total_score, r.n_records, r.mean_score) for r in genre_sentiment(scored).collect()}
    assert got == {"g1": (1, 2, 0.5), "g2": (3, 2, 1.5), "g3": (0, 0, None)}
    plain = {r.genre: r.mean_score for r in genre_sentiment(scored, plain_mean=True).collect()}
    assert plain == {"g1": 0.33, "g2": 1.5, "g3": 0.0}


def test_mean_is_half_even(spark):
    scored = spark.createDataFrame([(1, ["g"])] + [(1, ["g"]), (-1, ["g"])] * 3 + [(-1, ["g"]), (1, ["g"])][:1], "score long, genres array<string>")
    row = genre_sentiment(scored).first()
    assert row.n_records == 8 and row.total_score == 0
    eighth = spark.createDataFrame([(-6, ["g"])] + [(1, ["g"])] * 7, "score long, genres array<string>")
    assert genre_sentiment(eighth).first().mean_score == 0.12


@pytest.mark.parametrize("in_row", [True, False])
def test_document_sentiment(spark, rows, monkeypatch, in_row):
    monkeypatch.setattr("filmlake.session.CONSTANT_MAX_ROWS", 100 if in_row else 1)
    docs = spark.createDataFrame([(1, "Good, good; BAD day"), (2, "nothing"), (3, ""), (4, None)], "k long, t string")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1), ("well-made", 1)], "word string, polarity int")
    assert rows(document_sentiment(docs, lexicon, "k", "t")) == [(1, 1), (2, 0), (3, 0), (4, 0)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_number_rows(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(partitions)
    got = number_rows(df, ["v"]).collect()
    assert sorted((r.v, r.row_idx) for r in got) == [(i, i) for i in range(1000)]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "film long, genres array<string>")
    assert number_rows(empty, ["film"]).count() == 0
    vocabulary = g.genre_vocabulary(empty, 1)
    assert vocabulary.count() == 0 and g.predict_rows(empty, vocabulary).count() == 0
    assert multi_hot(empty, "film", "genres").count() == 0
    assert remove_rare(empty, ["genres"]).count() == 0
    scored = empty.withColumn("score", F.lit(1).cast("long"))
    assert genre_sentiment(scored).count() == 0


def test_null_lists_count_nothing(spark, rows):
    df = lists(spark, [(1, None, ["x"]), (2, ["a", "a"], None), (3, ["a"], ["x"])], "c", "d")
    assert rows(concat_features(df, "k", ["c", "d"])) == [
        (1, "d", "x", 1), (2, "c", "a", 0), (3, "c", "a", 0), (3, "d", "x", 1),
    ]
    assert [r[0] for r in rows(remove_rare(df, ["c"]))] == [2, 3]


def test_neighbours_cross_block_borders(spark):
    df = spark.range(50).select(F.col("id").alias("i"), (F.col("id") * 10).alias("v"))
    got = with_neighbours(df, "i", "v", (-2, 1), block=5).collect()
    assert len(got) == 50
    for r in got:
        assert r.v_m2 == ((r.i - 2) * 10 if r.i >= 2 else None)
        assert r.v_p1 == ((r.i + 1) * 10 if r.i < 49 else None)


def film_lists(spark):
    return spark.createDataFrame(
        [(1, ["b", "a"]), (2, ["a", "c"]), (3, ["a"]), (4, ["c", "b", "c"])], "film long, genres array<string>"
    )


def test_genre_vocabulary_and_shares(spark, rows):
    df = film_lists(spark)
    assert rows(g.genre_counts(df)) == [("a", 3), ("b", 2), ("c", 3)]
    assert rows(g.genre_vocabulary(df, 3)) == [("a", 3, 0), ("c", 3, 1)]
    assert rows(g.genre_vocabulary(df, 1)) == [("a", 3, 1), ("b", 2, 0), ("c", 3, 2)]
    shares = g.genre_shares(g.frequent_genres(df, 3))
    assert [r.share for r in shares.collect()] == [0.5, 0.5]


@pytest.mark.parametrize("small", [True, False])
def test_keep_genres(spark, rows, monkeypatch, small):
    if not small:
        monkeypatch.setattr("filmlake.session.CONSTANT_MAX_ROWS", 1)
    df = film_lists(spark)
    kept = g.keep_genres(df, g.frequent_genres(df, 3)).select("film", "genres")
    assert rows(kept) == [(1, ["a"]), (2, ["a", "c"]), (3, ["a"]), (4, ["c", "c"])]


def test_first_seen_with_text_keys(spark, rows):
    df = film_lists(spark).withColumn("film", F.concat(F.lit("f"), F.col("film").cast("string")))
    assert rows(g.genre_vocabulary(df, 1)) == [("a", 3, 1), ("b", 2, 0), ("c", 3, 2)]


def test_keep_no_genre(spark):
    df = film_lists(spark)
    assert g.keep_genres(df, g.frequent_genres(df, 100)).count() == 0


def test_predict_rows(spark, rows):
    df = film_lists(spark)
    got = rows(g.predict_rows(df, g.genre_vocabulary(df, 1)))
    assert got == [(0, 1, 0), (1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 3, 1), (5, 4, 2), (6, 4, 0), (7, 4, 2)]


def test_multi_hot_and_blocks(spark, rows):
    df = lists(spark, [(1, ["b", "a"], ["x"]), (2, ["a", "a"], ["y"])], "c", "d")
    assert rows(multi_hot(df, "k", "c")) == [(1, "a", 1), (1, "b", 0), (2, "a", 1)]
    assert rows(concat_features(df, "k", ["c", "d"])) == [
        (1, "c", "a", 1), (1, "c", "b", 0), (1, "d", "x", 2), (2, "c", "a", 1), (2, "d", "y", 3),
    ]
    only_one = lists(spark, [(1, ["z"], ["x"])], "c", "d")
    assert rows(concat_features(only_one, "k", ["c", "d"])) == [(1, "c", "z", 0), (1, "d", "x", 1)]


SIBLINGS = [(0, 10, 0, "p1", 2), (1, 10, 1, "p1", 0), (2, 11, 2, "p2", 1), (3, 11, 0, "p2", 2), (4, 11, 1, "p2", 0)]


def test_sibling_accuracy(spark):
    rows_ = spark.createDataFrame(SIBLINGS, "row_idx long, film long, genres_number int, plot string, prediction int")
    assert sibling_accuracy(rows_, rows_.drop("prediction"), "film").first().accuracy == 0.8
    narrow = rows_.withColumn("plot", fingerprint(F.col("plot")))
    assert neighbour_accuracy(narrow, "row_idx", "plot", block=5).first().accuracy == 0.8


def test_micro_f1(spark):
    truth, guess = [1, 0, 1, 0, 1, 0], [1, 1, 0, 0, 1, 0]
    df = spark.createDataFrame(list(zip(truth, guess)), "y int, p int")
    row = micro_f1(df).first()
    assert (row.tp, row.fp, row.fn) == (2, 1, 1) and abs(row.f1 - 4 / 6) < 1e-12


def test_accuracies(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 9.0)], "y double, p double")
    assert abs(tolerance_accuracy(df, "y", "p", 0.5).first().accuracy - 2 / 3) < 1e-12
    assert abs(exact_accuracy(df, "y", "p").first().accuracy - 1 / 3) < 1e-12


def test_joins(spark):
    films = spark.createDataFrame([("m/1", "tt1"), (None, "tt2"), ("m/3", "tt3")], "rotten_tomatoes_id string, imdb_id string")
    ratings = spark.createDataFrame(
        [("m/1", "tt1", 50.0), (None, "tt2", 90.0), ("m/3", "x", 10.0)],
        "rotten_tomatoes_id string, imdb_id string, audience_ratings double",
    )
    joined = join_ratings(films, ratings)
    assert {r.imdb_id_x for r in joined.collect()} == {"tt1", "tt3"}
    assert [r.imdb_id_x for r in well_rated(joined).collect()] == ["tt1"]
    plots = spark.createDataFrame([("tt3", "plot")], "imdb_id string, plot string")
    chain = join_chain(films, ratings, plots).collect()
    assert [(r.imdb_id_x, r.imdb_id_y, r.plot) for r in chain] == [("tt3", "x", "plot")]


def test_complete_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "v double, s string")
    assert complete(df, ["v"]).count() == 2 and complete(df).count() == 1


@pytest.mark.parametrize("limit", [0, 10_000])
def test_both_ways_agree_on_null_lists_and_repeated_keys(spark, monkeypatch, limit):
    monkeypatch.setattr("filmlake.session.CONSTANT_MAX_ROWS", limit)
    data = [(1, ["a", "b", "a"], "x"), (1, ["a"], "y"), (2, None, "z"), (3, ["b"], "v"), (4, [], "w"), (5, ["a", None], "u")]
    df = spark.createDataFrame(data, "k int, c array<string>, t string")
    by_rows = remove_rare_by_rows(df, "c")
    assert by_rows.columns == df.columns
    assert sorted(map(tuple, by_rows.collect()), key=str) == sorted(
        [(1, ["a", "b", "a"], "x"), (1, ["a"], "y"), (2, None, "z"), (3, ["b"], "v"), (4, [], "w"), (5, ["a"], "u")],
        key=str,
    )
    kept = g.keep_genres(df, spark.createDataFrame([("a",)], "genre string"), "c")
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [(1, ["a"], "y"), (1, ["a", "a"], "x"), (5, ["a"], "u")]


@pytest.mark.parametrize("limit", [0, 10_000])
def test_both_ways_of_scoring_agree(spark, monkeypatch, limit):
    monkeypatch.setattr("filmlake.session.CONSTANT_MAX_ROWS", limit)
    docs = spark.createDataFrame([(1, "Good good"), (1, "bad"), (2, None), (3, "odd")], "k int, t string")
    words = [("good", 1), ("good", 1), ("bad", -1), ("odd", 1), ("odd", -1), ("none", 0)]
    scored = document_sentiment(docs, spark.createDataFrame(words, "word string, polarity int"), "k", "t")
    assert sorted(map(tuple, scored.collect())) == [(1, -1), (1, 2), (2, 0), (3, 0)]


def test_a_missing_prediction_is_wrong(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None)], "y double, p double")
    assert tuple(tolerance_accuracy(df, "y", "p", 0.5).first()) == (2, 0.5)
    assert tuple(exact_accuracy(df, "y", "p").first()) == (2, 0.5)
