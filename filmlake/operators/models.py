"""Feature vectors and Spark ML classifiers with the settings the analyses use."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    Normalizer,
    PolynomialExpansion,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_checked, fresh_path, materialize
from . import sharded_perceptron, wide_perceptron, wide_rows, wide_trees
from .numbering import number_rows

MAX_MODEL_FEATURES = 5_000_000
# Elements whose names Spark ML may keep on the driver, and in the schema of every row; more are a table.
MOST_NAMED = 20_000
# Elements of a vocabulary that a task may hold whole.
MOST_SENT = 50_000
MAX_CLASSES = 1_000
SPARK_MAX_TREE_DEPTH = 30
# Rows x features that Spark ML may lay out; tables of ones beyond that stay sparse.
MOST_DENSE_CELLS = 20_000_000


def in_train(key: Column, share: float = 0.75) -> Column:
    """Deterministic split: the md5 prefix of a key below a share of its range.

    The same key is on the same side in every run and on every engine.
    """
    bar = format(min(int(share * 2**32), 2**32 - 1), "08x")
    return F.substring(F.md5(key.cast("string")), 1, 8) < bar


def random_split(df: DataFrame, share: float = 0.75, seed: int = 9) -> list[DataFrame]:
    """Seeded row split (M08); reproducible only while the input partitions stay the same."""
    return df.randomSplit([share, 1 - share], seed)


def _list_cells(df: DataFrame, columns: Sequence[str], *kept: str) -> DataFrame:
    """(kept columns, i, t): the elements t of the i-th list column."""
    lists = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("items")) for i, c in enumerate(columns)])
    return df.select(*kept, F.explode(lists).alias("l")).select(*kept, "l.i", F.explode("l.items").alias("t"))


def _distinct_terms(df: DataFrame, *columns: str) -> list[int]:
    """How many elements each of the list columns has, at least 1; one job counts them all."""
    cells = _list_cells(df, columns)
    found = dict(cells.distinct().groupBy("i").agg(F.count("t")).collect())
    for i, column in enumerate(columns):
        if found.get(i, 0) > MAX_MODEL_FEATURES:
            raise ValueError(f"{column}: {found[i]} features do not fit a driver-side model; use the long form")
    return [max(found.get(i, 0), 1) for i in range(len(columns))]


def multi_hot_vectors(df: DataFrame, columns: Sequence[str], output: str = "features"):
    """Sparse 0/1 vectors over all elements of the list columns, side by side.

    Returns the fitted encoder; its ``transform`` works on any rows with those columns. Every
    element seen gets a feature, none is cut. Up to ``MOST_NAMED`` elements are a pipeline of
    Spark ML, which names each feature on the driver and in the schema; more are :class:`_LongHot`.
    """
    sizes = _distinct_terms(df, *columns)
    if sum(sizes) > MOST_NAMED:
        return _LongHot(df, columns, output)
    stages = [
        CountVectorizer(inputCol=c, outputCol=f"{c}_hot", binary=True, vocabSize=n) for c, n in zip(columns, sizes)
    ]
    stages.append(VectorAssembler(inputCols=[f"{c}_hot" for c in columns], outputCol=output))
    return Pipeline(stages=stages).fit(df)


class _LongHot:
    """Multi-hot vectors whose vocabulary is a written table that meets the elements in a join.

    The features of a column are in the order of Spark ML's, the most frequent first; equal ones go
    by the element. A NULL element has no feature. The driver learns only how many features there are.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], output: str):
        self.columns, self.output = list(columns), output
        counts = _list_cells(df, columns).filter(F.col("t").isNotNull()).groupBy("i", "t").agg(F.count(F.lit(1)).alias("n"))
        numbered = number_rows(counts, ["i", F.col("n").desc(), "t"], "feature")
        self.vocabulary = materialize(numbered.select("i", "t", F.col("feature").cast("int")), "vocabulary")
        self.size = self.vocabulary.count()

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with their vectors, written; elements outside the vocabulary are left out."""
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "listed")
        known = broadcast_checked(self.vocabulary, MOST_SENT)
        ones = _list_cells(rows, self.columns, "_row").join(known, ["i", "t"]).groupBy("_row").agg(
            F.sort_array(F.collect_set("feature")).alias("_ones")
        )
        found = F.coalesce("_ones", F.array().cast("array<int>"))
        # written as the numbers that a vector is stored as, and read as vectors
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"), found.alias("indices"),
            F.array_repeat(F.lit(1.0), F.size(found)).alias("values"),
        )
        path = fresh_path(df.sparkSession, "hot")
        rows.join(ones, "_row", "left").select(*df.columns, vector.alias(self.output)).write.parquet(path)
        schema = T.StructType([*df.schema.fields, T.StructField(self.output, VectorUDT())])
        return df.sparkSession.read.schema(schema).parquet(path)


def tfidf_vectors(
    train: DataFrame, tokens: str, max_df: float = 1.0, max_features: int | None = None,
    output: str = "features",
):
    """Unit-length smooth TF-IDF vectors learnt from ``train``.

    Spark's idf is ln((1 + N) / (1 + df)); the missing + 1 is added by scaling the counts.
    Returns a function that maps any rows with ``tokens`` to rows with ``output``.
    """
    size = max_features or _distinct_terms(train, tokens)[0]
    counter = CountVectorizer(inputCol=tokens, outputCol="_tf", vocabSize=size)
    if max_df < 1.0:
        counter.setMaxDF(max_df)  # Spark reads 1.0 and above as a number of documents
    counts = counter.fit(train)
    idf = IDF(inputCol="_tf", outputCol="_w").fit(counts.transform(train))
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(idf.idf.toArray() + 1.0), inputCol="_tf", outputCol="_w"
    )
    unit = Normalizer(p=2.0, inputCol="_w", outputCol=output)
    return lambda df: unit.transform(scale.transform(counts.transform(df))).drop("_tf", "_w")


def count_vectors(train: DataFrame, tokens: str, output: str = "features"):
    """Word-count vectors learnt from ``train``."""
    size = _distinct_terms(train, tokens)[0]
    return CountVectorizer(inputCol=tokens, outputCol=output, vocabSize=size).fit(train).transform


def select_features(train: DataFrame, label: str, share: float = 0.2, features: str = "features"):
    """ANOVA F selection of the best share of vector features.

    Returns a function that adds ``selected``. F needs two classes; with one, all are kept.
    """
    if train.select(label).distinct().limit(2).count() < 2:
        return lambda df: df.withColumn("selected", F.col(features))
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol="selected", selectionMode="percentile"
    )
    selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(share)
    return selector.fit(train).transform


def class_values(df: DataFrame, label: str) -> list:
    """Distinct label values in order; a label that is not categorical is refused."""
    rows = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values; bucket it first")
    return sorted(r[0] for r in rows)


def bucket_label(df: DataFrame, label: str, buckets: int, fit_on: DataFrame | None = None) -> DataFrame:
    """Replace a continuous label by the mid-point value of its quantile bucket.

    Keeps a label numeric where cutting its text would lose magnitude. Edges come from one
    mergeable quantile sketch, so no sort of the data is needed. A NULL label stays NULL.
    """
    source = df if fit_on is None else fit_on
    shares = [i / (2 * buckets) for i in range(1, 2 * buckets)]
    marks = source.agg(F.percentile_approx(label, shares, 10_000)).first()[0]
    edges, middles = marks[1::2], marks[0::2]
    value = F.lit(float(middles[-1]))
    for edge, middle in reversed(list(zip(edges, middles))):
        value = F.when(F.col(label) < edge, F.lit(float(middle))).otherwise(value)
    return df.withColumn("label_class", F.when(F.col(label).isNotNull(), value))


def fit_predict(
    train: DataFrame, test: DataFrame, estimator: Estimator, label: str, prediction: str = "predicted"
) -> DataFrame:
    """Fit a classifier on the values of ``label`` and predict such values for ``test``.

    Class indices and values are translated both ways, so a prediction is in the unit of the
    label and can be scored with a tolerance.
    """
    values = class_values(train, label)
    table = F.array(*[F.lit(v) for v in values])
    indexed = train.withColumn("_class", (F.array_position(table, F.col(label)) - 1).cast("double"))
    estimator = estimator.copy()
    setter = estimator.setLabelCol if hasattr(estimator, "setLabelCol") else None
    if setter is None:
        raise TypeError("the estimator takes no label column")
    setter("_class")
    if isinstance(estimator, MultilayerPerceptronClassifier):
        hidden = estimator.getLayers()[1:-1]
        inputs = indexed.select(F.col("features")).first()[0].size
        estimator.setLayers([inputs, *hidden, max(len(values), 2)])
    model = estimator.fit(indexed)
    return model.transform(test).withColumn(
        prediction, F.get(table, F.col("prediction").cast("int"))
    )


def fit_predict_ones(
    train: DataFrame, test: DataFrame, estimator: Estimator, label: str, prediction: str = "predicted",
    most_cells: int = MOST_DENSE_CELLS,
) -> DataFrame:
    """:func:`fit_predict` for vectors of zeros and ones of any width.

    Spark ML lays out every cell of the training rows. Beyond ``most_cells`` of them trees, forests
    and perceptrons are fitted to the ones alone, by :mod:`.wide_trees` and :mod:`.wide_perceptron`.
    """
    first = train.select("features").first()
    width = 0 if first is None else first[0].size
    wide = (DecisionTreeClassifier, RandomForestClassifier, MultilayerPerceptronClassifier)
    if not isinstance(estimator, wide) or train.count() * width <= most_cells:
        return fit_predict(train, test, estimator, label, prediction)
    values = class_values(train, label)
    table = F.array(*[F.lit(v) for v in values])
    place = F.array_position(table, F.col(label)) - 1
    rows = wide_rows.pack(train.select(place.alias("_class"), "features"), label="_class")
    if rows.filter(F.col("class").isNull()).limit(1).count():
        raise ValueError(f"{label} must not be null")
    seed, tested = estimator.getSeed(), wide_rows.pack(test)
    if isinstance(estimator, MultilayerPerceptronClassifier):
        layers = [width, *estimator.getLayers()[1:-1], max(len(values), 2)]
        how = layers, estimator.getMaxIter(), estimator.getTol(), seed
        if wide_perceptron.size(layers) > sharded_perceptron.MOST_LOCAL:
            out = sharded_perceptron.predict(tested, sharded_perceptron.fit(rows, *how))
        else:
            out = wide_perceptron.predict(tested, wide_perceptron.fit(rows, *how), layers)
    else:
        several = isinstance(estimator, RandomForestClassifier) and estimator.getNumTrees() > 1
        trees = wide_trees.fit(
            rows, width, len(values), estimator.getNumTrees() if several else 1, estimator.getMaxDepth(),
            estimator.getMinInstancesPerNode(), seed, math.ceil(math.sqrt(width)) if several else None,
        )
        out = wide_trees.predict(tested, trees)
    return out.withColumn(prediction, F.get(table, F.col("prediction")))


def gaussian_bayes() -> NaiveBayes:
    """Gaussian naive Bayes."""
    return NaiveBayes(modelType="gaussian", featuresCol="features")


def multinomial_bayes(alpha: float = 1.0) -> NaiveBayes:
    """Multinomial naive Bayes of Spark ML (M09); it always learns a class prior.

    :mod:`.bayes` has the uniform-prior form.
    """
    return NaiveBayes(modelType="multinomial", smoothing=alpha, featuresCol="features")


def perceptron(hidden: Sequence[int], max_iter: int = 200, seed: int = 9) -> MultilayerPerceptronClassifier:
    """Perceptron with the given hidden layers, trained by L-BFGS.

    The input and output sizes are set when it is fitted.
    """
    return MultilayerPerceptronClassifier(
        layers=[1, *hidden, 2], solver="l-bfgs", maxIter=max_iter, seed=seed, featuresCol="features"
    )


def forest(trees: int = 200, depth: int = 10, leaf: int = 10, seed: int = 9) -> RandomForestClassifier:
    """Random forest."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, featuresCol="features"
    )


def tree(depth: int = SPARK_MAX_TREE_DEPTH, seed: int = 9) -> DecisionTreeClassifier:
    """Decision tree (M15). Spark grows at most 30 levels, and a deeper request is refused."""
    if depth > SPARK_MAX_TREE_DEPTH:
        raise ValueError(f"a tree has at most {SPARK_MAX_TREE_DEPTH} levels")
    return DecisionTreeClassifier(maxDepth=depth, seed=seed, featuresCol="features")


def polynomial_fit(train: DataFrame, x: str, y: str, degree: int = 1):
    """Least-squares polynomial of y on x with an intercept (M07); returns the fitted pipeline."""
    inputs = VectorAssembler(inputCols=[x], outputCol="_x")
    powers = PolynomialExpansion(degree=degree, inputCol="_x", outputCol="_powers")
    fit = LinearRegression(
        featuresCol="_powers", labelCol=y, predictionCol="fitted", solver="normal", regParam=0.0
    )
    return Pipeline(stages=[inputs, powers, fit]).fit(train)


def label_matrix(df: DataFrame, key: str, genres: str, names: Sequence[str]) -> DataFrame:
    """(key, genre, y) for every film and genre name, y = 1 where the film has it."""
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("genre"), F.array_contains(genres, n).cast("int").alias("y"))
            for n in sorted(names)
        ]
    )
    return df.select(key, F.inline(cells))
