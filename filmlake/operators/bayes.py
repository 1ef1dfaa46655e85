"""Multinomial naive Bayes over long term weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize


def fit_multinomial(sums: DataFrame, terms: DataFrame, classes: list[int], alpha: float = 1.0) -> DataFrame:
    """One row per kept term with an array of ln(S_ct + alpha), one slot per class.

    ``sums`` are the per-class weight sums; a pair that never occurs holds ln(alpha).
    """
    kept = sums.join(broadcast_checked(terms.select("term")), "term")
    per_class = [F.coalesce(F.sum(F.when(F.col("class") == c, F.col("s"))), F.lit(0.0)) for c in classes]
    return kept.groupBy("term").agg(F.array(*per_class).alias("s")).select(
        "term", "s", F.transform("s", lambda v: F.log(v + F.lit(alpha))).alias("log_s")
    )


def predict_multinomial(
    docs: DataFrame,
    weights: DataFrame,
    model: DataFrame,
    classes: list[int],
    key: str,
    alpha: float = 1.0,
    prior: Sequence[float] | None = None,
) -> DataFrame:
    """(key, prediction) with a uniform prior; ties go to the smaller class.

    ``prior`` has the logarithm of a prior for each class.

    score(d, c) = sum_t x_dt * ln(S_ct + alpha) - (sum_t x_dt) * ln(S_c + alpha * V). Each
    (document, term) joins one model row holding all classes, so rows are not multiplied by
    the number of classes, and partial sums leave one row per document.
    """
    model = materialize(model, "bayes")
    span = range(len(classes))
    totals = model.agg(
        F.array(
            *[
                F.log(F.sum(F.get("s", F.lit(i))) + F.lit(alpha) * F.count(F.lit(1)))
                for i in span
            ]
        )
    ).scalar()
    x = F.col("weight")
    sums = (
        weights.select(key, "term", "weight")
        .join(broadcast_checked(model.select("term", "log_s")), "term")
        .groupBy(key)
        .agg(
            F.sum(x).alias("x"),
            *[F.sum(x * F.get("log_s", F.lit(i))).alias(f"g{i}") for i in span],
        )
    )
    scored = docs.select(key).join(sums, key, "left").withColumn("_total", totals)
    ranked = [
        F.struct(
            (
                F.coalesce(F.col(f"g{i}") - F.col("x") * F.get("_total", F.lit(i)), F.lit(0.0))
                + F.lit(0.0 if prior is None else float(prior[i]))
            ).alias("score"),
            F.lit(-c).alias("rank"),
        )
        for i, c in enumerate(classes)
    ]
    best = F.array_max(F.array(*ranked))
    return scored.select(key, (-best["rank"]).cast("int").alias("prediction"))
