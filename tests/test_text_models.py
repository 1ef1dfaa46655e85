import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmlake.functions.text import clean_text, clean_tokens, without_words
from filmlake.operators import knn, models, tfidf
from filmlake.operators.bayes import fit_multinomial, predict_multinomial
from filmlake.operators.tfidf import (
    anova_f,
    class_sums,
    fit_vocabulary,
    select_percentile,
    weighted_terms,
)
from filmlake.operators.wordfreq import drop_stop_words, top_words, word_counts
from filmlake.plans import list_queries, model_queries, views

DOCS = [
    (1, "war war soldier the battle", [0], True),
    (2, "love kiss the wedding love", [1], True),
    (3, "war love the story", [0, 1], True),
    (4, "soldier battle war plane", [0], True),
    (5, "kiss story wedding dance", [1], True),
    (6, "war plane soldier unseen", [0], False),
    (7, "love dance", [1], False),
    (8, "nothing known", [1], False),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "film long, plot string, classes array<int>, train boolean").withColumn(
        "mult", F.size("classes").cast("long")
    ).repartition(3)


def prepared_terms(docs, key, text, stop_words=(), max_df=1.0, max_features=None):
    vocabulary = fit_vocabulary(docs.filter("train"), text, stop_words, max_df, max_features)
    return vocabulary, weighted_terms(docs, vocabulary, key, text, stop_words)


def brute_weights(max_df):
    train = [(d, Counter(t.split()), c) for d, t, c, tr in DOCS if tr]
    n = sum(len(c) for _, _, c in train)
    df = Counter()
    for _, tf, c in train:
        for w in tf:
            df[w] += len(c)
    idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items() if k <= max_df * n}
    out = {}
    for d, t, _, _ in DOCS:
        raw = {w: k * idf[w] for w, k in Counter(t.split()).items() if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.update({(d, w): x / norm for w, x in raw.items()})
    return idf, out


def test_tfidf_against_brute_force(docs):
    vocabulary, weights = prepared_terms(docs, "film", "plot", (), 0.6)
    idf, expected = brute_weights(0.6)
    assert "the" not in idf and "battle" in idf
    got = {(r.film, r.term): r.weight for r in weights.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-12) for k in got)
    assert {r.term for r in vocabulary.collect()} == set(idf)


def test_max_features_and_stop_words(docs):
    vocabulary, _ = prepared_terms(docs, "film", "plot", ("the", "war"), 1.0, 2)
    assert sorted((r.term, r.total) for r in vocabulary.collect()) == [("love", 4), ("story", 3)]


def test_selection_and_bayes_against_brute_force(docs):
    _, weights = prepared_terms(docs, "film", "plot")
    samples = docs.filter("train").select("film", F.explode("classes").alias("class"))
    sums = class_sums(weights, samples, "film")
    scores = anova_f(sums, samples)
    got = {r.term: r.f for r in scores.collect()}
    _, w = brute_weights(1.0)
    rows = [(d, c) for d, _, cs, tr in DOCS if tr for c in cs]
    for term in got:
        groups = [np.array([w.get((d, term), 0.0) for d, c in rows if c == k]) for k in (0, 1)]
        everything = np.concatenate(groups)
        ssw = sum(((x - x.mean()) ** 2).sum() for x in groups)
        ssb = sum(len(x) * (x.mean() - everything.mean()) ** 2 for x in groups)
        if ssw > 1e-12:
            assert math.isclose(got[term], ssb / (ssw / (len(rows) - 2)), rel_tol=1e-6, abs_tol=1e-8)
    chosen = select_percentile(scores, 50)
    v = len(got)
    expected = sorted(got, key=lambda t: (-(got[t] if got[t] is not None else -math.inf), t))[: math.ceil((v - 1) * 0.5)]
    assert {r.term for r in chosen.collect()} == set(expected)

    model = fit_multinomial(sums, chosen, [0, 1])
    test = docs.filter("not train")
    predicted = {r.film: r.prediction for r in predict_multinomial(test, weights, model, [0, 1], "film").collect()}
    s = {(t, c): sum(w.get((d, t), 0.0) for d, k in rows if k == c) for t in expected for c in (0, 1)}
    total = {c: sum(s[t, c] for t in expected) + len(expected) for c in (0, 1)}
    for d, _, _, tr in DOCS:
        if not tr:
            score = [
                sum(w.get((d, t), 0.0) * math.log((s[t, c] + 1) / total[c]) for t in expected) for c in (0, 1)
            ]
            assert predicted[d] == int(np.argmax(score)), d
    assert predicted[8] == 0


def test_word_counts(spark, rows):
    df = spark.createDataFrame([("b a b",), ("a c",), ("",)], "t string")
    counts = word_counts(df, "t")
    assert rows(counts) == [("a", 2), ("b", 2), ("c", 1)]
    assert [r.word for r in top_words(counts, 2).collect()] == ["a", "b"]
    stop = spark.createDataFrame([("b",)], "word string")
    assert rows(drop_stop_words(counts, stop)) == [("a", 2), ("c", 1)]
    assert rows(word_counts(df, "t", ["a"])) == [("b", 2), ("c", 1)]


@pytest.mark.parametrize("duplicates", [False, True])
def test_knn_against_brute_force(spark, monkeypatch, duplicates):
    monkeypatch.setattr(knn, "BOX_POINTS", 8)
    monkeypatch.setattr(knn, "BOX_QUERIES", 5)
    rng = np.random.default_rng(11)
    train = rng.integers(0, 12 if duplicates else 1000, size=(300, 3)).astype(float)
    train[:100] = [3, 3, 3]
    test = rng.integers(0, 12, size=(60, 3)).astype(float)
    test[:20] = [3, 3, 4]
    labels = rng.integers(0, 4, size=300)
    columns = "id long, a double, b double, c double, label int"
    tr = spark.createDataFrame([(i, *map(float, p), int(y)) for i, (p, y) in enumerate(zip(train, labels))], columns)
    te = spark.createDataFrame([(1000 + i, *map(float, p), 0) for i, p in enumerate(test)], columns)
    got = {}
    for r in knn.nearest_neighbours(te, tr, "id", "label", ["a", "b", "c"], 10).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour))
    votes = {r.id: (r.prediction, r.votes) for r in knn.knn_predict(te, tr, "id", "label", ["a", "b", "c"], 10).collect()}
    for i, p in enumerate(test):
        d2 = ((train - p) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(300), d2))[:10]
        assert [n for _, n in sorted(got[1000 + i])] == order.tolist()
        counts = np.bincount(labels[order], minlength=4)
        assert votes[1000 + i] == (int(counts.argmax()), int(counts.max()))


def test_knn_with_fewer_points_than_k(spark):
    columns = "id long, a double, label int"
    tr = spark.createDataFrame([(1, 0.0, 1), (2, 5.0, 2)], columns)
    te = spark.createDataFrame([(9, 4.0, 0)], columns)
    got = knn.nearest_neighbours(te, tr, "id", "label", ["a"], 10).orderBy("rank").collect()
    assert [r.neighbour for r in got] == [2, 1]


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    assert sorted(tuple(r) for r in knn.standardise(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_split_is_stable(spark):
    df = spark.range(4000).withColumn("t", models.in_train(F.col("id")))
    share = df.filter("t").count() / 4000
    assert 0.72 < share < 0.78
    assert df.repartition(7).filter("t").count() == share * 4000
    first, second = models.random_split(df, 0.75)
    assert first.count() + second.count() == 4000


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    data = [(i, [f"c{i % 3}", f"r{rng.integers(5)}"], float(i % 3) * 2.5) for i in range(240)]
    df = spark.createDataFrame(data, "k long, items array<string>, y double")
    return models.multi_hot_vectors(df, ["items"]).transform(df)


@pytest.mark.parametrize(
    "make",
    [
        lambda: models.perceptron((6,), 30),
        lambda: models.forest(20, 5, 1),
        lambda: models.tree(30),
        models.multinomial_bayes,
    ],
    ids=["mlp", "forest", "tree", "bayes"],
)
def test_classifiers_predict_label_values(vectors, make):
    estimator = make()
    out = models.fit_predict(vectors, vectors, estimator, "y")
    again = models.fit_predict(vectors, vectors, estimator, "y")
    assert out.count() == 240
    assert {r.predicted for r in out.select("predicted").distinct().collect()} <= {0.0, 2.5, 5.0}
    assert out.filter("predicted = y").count() > 230
    key = lambda df: sorted((r.k, r.predicted) for r in df.select("k", "predicted").collect())
    assert key(out) == key(again)


def test_multi_hot_vector_has_every_element(vectors):
    sizes = {r.features.size for r in vectors.select("features").collect()}
    assert sizes == {8}


def test_bucket_label(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("y"))
    out = models.bucket_label(df, "y", 4)
    counts = {r.label_class: r["count"] for r in out.groupBy("label_class").count().collect()}
    assert len(counts) == 4 and all(240 <= n <= 260 for n in counts.values())
    assert out.filter("abs(label_class - y) > 130").count() == 0


def test_feature_selection(vectors):
    labelled = vectors.withColumn("label", F.col("k") % 3)
    choose = models.select_features(labelled.withColumn("label", F.col("label").cast("double")), "label", 0.5)
    assert choose(vectors).first().selected.size == 4
    single = models.select_features(vectors.withColumn("label", F.lit(1.0)), "label", 0.5)
    assert single(vectors).first().selected.size == 8


def test_label_matrix(spark):
    rows = spark.createDataFrame([(i, ["a"] if i % 2 else ["a", "b"]) for i in range(60)], "k long, genres array<string>")
    matrix = models.label_matrix(rows, "k", "genres", ["b", "a"])
    assert matrix.count() == 120 and matrix.filter("genre = 'a' and y = 1").count() == 60


def test_ml_tfidf_equals_long_form(spark, docs):
    tokens = docs.withColumn("tokens", F.split("plot", " ")).withColumn("mult", F.lit(1).cast("long"))
    encode = models.tfidf_vectors(tokens.filter("train"), "tokens")
    norms = [float(np.linalg.norm(r.features.toArray())) for r in encode(tokens.filter("train")).collect()]
    assert np.allclose(norms, 1.0)
    _, weights = prepared_terms(tokens, "film", "plot")
    trained = weights.join(docs.filter("train").select("film"), "film", "left_semi")
    long_form = sorted(round(r.weight, 9) for r in trained.collect())
    vector = sorted(round(float(x), 9) for r in encode(tokens.filter("train")).collect() for x in r.features.toArray() if x)
    assert long_form == vector


def test_selected_bayes_is_that_of_spark_without_vectors(spark, tmp_path, monkeypatch):
    """Every text was laid out as a vector for each of its genres, and the F of a term came from all cells."""
    draw = random.Random(8)
    texts = []
    for i in range(500):
        lang = draw.choice(["de", "en", "fr"])
        words = [f"{lang}{'abcd'[j]}" for j in range(4) for _ in range(draw.randrange(2 * j + 2))]
        words += [f"x{'abcdefghijklmnopqrstuvwxyz'[draw.randrange(26)]}" for _ in range(draw.randrange(3, 9))]
        source = draw.choice(["web", "book"])
        texts.append((i if i != 7 else 6, "" if i == 9 else " ".join(words), lang if draw.random() < 0.9 else "en", source, len(words)))
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(10, 300)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    encoder = models.tfidf_vectors
    monkeypatch.setattr(models, "tfidf_vectors", None)
    got = model_queries.selected_bayes(spark, str(tmp_path))
    kept, _ = list_queries.kept_films(spark, str(tmp_path), clean_text(F.col("plot")).alias("plot"))
    words = without_words(clean_tokens(F.col("plot")), views.STOP_WORDS).alias("tokens")
    rows = kept.select("film", words, F.explode("genres").alias("genre"), models.in_train(F.col("film"), 0.8).alias("train"))
    train = rows.filter("train")
    encode = encoder(train, "tokens", 0.4)
    codes = models.class_values(train, "genre")
    label = (F.array_position(F.array(*map(F.lit, codes)), F.col("genre")) - 1).cast("double")
    choose = models.select_features(encode(train).withColumn("label", label), "label")
    vectors = choose(encode(rows)).select("film", "genre", "train", F.col("selected").alias("features"))
    want = models.fit_predict(vectors.filter("train"), vectors.filter("not train"), models.multinomial_bayes(), "genre")
    answer = lambda df: sorted(tuple(r) for r in df.select("film", "genre", "predicted").collect())
    assert vectors.first().features.size in (7, 8) and len({r.predicted for r in want.collect()}) > 2
    assert answer(got) == answer(want)


def test_shares_are_taken_as_sparks_selector_takes_them(spark):
    """Beyond the ceiling the p values are 0, and the more frequent terms go first."""
    assert tfidf._tail(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-5)
    assert tfidf._tail(2.7109, 5, 20) == pytest.approx(0.05, abs=1e-5)
    ceiling = tfidf.f_ceiling(4, 300)
    assert tfidf._tail(ceiling * 1.001, 4, 300) < 2**-54 < tfidf._tail(ceiling * 0.999, 4, 300)
    rows = [("a", ceiling + 9, 2), ("b", ceiling + 1, 5), ("c", ceiling + 2, 5), ("d", ceiling - 1, 99), ("e", None, 100)]
    scores = spark.createDataFrame(rows, "term string, f double, total long")
    taken = lambda share: {r.term for r in tfidf.select_share(scores, share, ceiling).collect()}
    assert [taken(x) for x in (0.2, 0.4, 0.6, 0.8, 0.99)] == [{"b"}, {"b", "c"}, {"a", "b", "c"}, {"a", "b", "c", "d"}, {"a", "b", "c", "d"}]


def test_sums_of_lists_are_sums_of_classes(spark):
    weights = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.25), (2, "a", 1.0), (3, "b", 2.0)], "k long, term string, weight double")
    lists = spark.createDataFrame([(1, ["x", "y"]), (2, ["x", "y"]), (3, ["y", "y"])], "k long, genres array<string>")
    flat = lists.select("k", F.explode("genres").alias("class"))
    listed = lambda df: sorted(tuple(r) for r in df.select("term", "class", "s", "q").collect())
    assert listed(tfidf.list_sums(weights, lists, "k", "genres")) == listed(tfidf.class_sums(weights, flat, "k"))


def test_polynomial(spark):
    df = spark.createDataFrame([(float(x), 1.0 + 2 * x + 3 * x * x) for x in range(20)], "x double, y double")
    out = models.polynomial_fit(df, "x", "y", 2).transform(df)
    assert out.filter("abs(fitted - y) > 1e-6").count() == 0


def test_knn_boxes_with_a_dominant_value_and_outliers(spark, monkeypatch):
    monkeypatch.setattr(knn, "BOX_POINTS", 100)
    draw = np.random.default_rng(6)
    points = np.column_stack([np.where(draw.random(3000) < 0.9, 5.0, draw.random(3000) * 100), draw.random(3000)])
    points[:3] = [[1e6, 0.5], [-1e6, 0.2], [0.0, 1e6]]
    rows = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(points)], "id long, point array<double>")
    tree = knn.BoxTree(rows, 2, len(points))
    nodes = {r.path: r for r in tree.nodes.collect()}
    homes = {r.id: r.box for r in tree.homes.collect()}
    assert len(homes) == len(points) and tree.depth >= 1
    assert nodes["0"].points == len(points) and nodes["0"].parent is None
    for path, node in nodes.items():
        inside = [i for i, box in homes.items() if (box + ".").startswith(path + ".")]
        assert node.points == len(inside) and node.leaf == (path in homes.values())
        assert node.low == points[inside].min(0).tolist() and node.high == points[inside].max(0).tolist()
        assert node.parent is None or not nodes[node.parent].leaf
    k = 10
    asked = np.vstack([points[:40], [[-1e7, 3.0], [50.0, -1e7]]])
    queries = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(asked)], "qid long, point array<double>")
    located = tree.located(queries, k)
    d2 = ((asked[:, None] - points[None]) ** 2).sum(-1)
    true = np.sort(d2, axis=1)[:, k - 1]
    bounds = {r.qid: r.bound for r in located.collect()}
    assert all(true[i] <= bounds[i] < np.inf for i in range(len(asked)))
    reach = F.element_at(F.lit(true.tolist()), F.col("qid").cast("int") + 1)
    near = {}
    for r in tree.within(located.select("qid", "point", "own", reach.alias("reach"))).collect():
        near.setdefault(r.qid, []).append(r.box)
    for i in range(len(asked)):
        assert {homes[j] for j in np.flatnonzero(d2[i] <= true[i])} <= set(near[i])
        assert len(near[i]) == len(set(near[i])) <= len(set(homes.values()))
    assert np.mean([len(near[i]) for i in range(3, 40)]) < len(set(homes.values())) / 2


def test_knn_leaves_the_tree_in_tables(spark, monkeypatch):
    """Nothing but the quantiles, the depth, and checks of size reaches the driver."""
    monkeypatch.setattr(knn, "BOX_POINTS", 5)
    monkeypatch.setattr(knn, "broadcast_checked", lambda df: df)
    frame = type(spark.range(1))
    collect, sizes = frame.collect, []

    def counted(self):
        rows = collect(self)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", counted)
    train = spark.range(500).select("id", (F.col("id") % 7).cast("int").alias("label"), (F.col("id") * 1.5).alias("a"))
    test = spark.range(20).select((F.col("id") + 1000).alias("id"), (F.col("id") * 31.0 + 0.3).alias("a"))
    out = knn.nearest_neighbours(test, train, "id", "label", ["a"], 3)
    assert max(sizes) == 1 and "NestedLoop" not in out._jdf.queryExecution().toString()
    monkeypatch.undo()
    got = sorted((r.id, r["rank"], r.neighbour) for r in out.collect())
    want = []
    for q in range(20):
        best = sorted((round((1.5 * i - 31.0 * q - 0.3) ** 2, 9), i) for i in range(500))[:3]
        want += [(1000 + q, n + 1, i) for n, (_, i) in enumerate(best)]
    assert got == want


def test_knn_rows_without_a_feature(spark):
    train = spark.createDataFrame([(1, 1, 0.0), (2, 2, None), (3, 3, float("nan"))], "id long, label int, a double")
    test = spark.createDataFrame([(8, 4.0), (9, None)], "id long, a double")
    got = knn.nearest_neighbours(test, train, "id", "label", ["a"], 3).collect()
    assert [(r.id, r.neighbour) for r in got] == [(8, 1)]
    assert knn.nearest_neighbours(test.limit(0), train, "id", "label", ["a"], 3).count() == 0


def test_knn_splits_boxes_with_many_points(spark, monkeypatch):
    monkeypatch.setattr(knn, "SLICE_POINTS", 50)
    draw = random.Random(4)
    rows = [(i, i % 3, 1.0 if i % 10 else draw.random() * 9, draw.random()) for i in range(900)]
    rows += [(900, 1, 1e6, 0.0), (901, 2, -1e6, 0.0)]

    train = spark.createDataFrame(rows, "id long, label int, a double, b double")
    test = spark.createDataFrame([(5000, 1.0, 0.5), (5001, 1e6, 0.0), (5002, 3.0, 0.1)], "id long, a double, b double")
    got = knn.nearest_neighbours(test, train, "id", "label", ["a", "b"], 5).collect()
    for key, a, b in ((5000, 1.0, 0.5), (5001, 1e6, 0.0), (5002, 3.0, 0.1)):
        best = sorted((round((r[2] - a) ** 2 + (r[3] - b) ** 2, 9), r[0]) for r in rows)[:5]
        assert [r.neighbour for r in sorted(got, key=lambda r: r.rank) if r.id == key] == [i for _, i in best]


def test_a_tree_that_is_too_deep_is_refused():
    with pytest.raises(ValueError):
        models.tree(50)
