"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_QUERIES a comma-separated
choice of registered queries. Every query runs whole; its result goes to a sink that drops it.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from filmlake.plans.registry import REGISTRY  # noqa: E402
from filmlake.session import build_session  # noqa: E402

HEADLINES = (
    "genre_sentiment,claims_extract,films_select,genre_map,ratings_join,film_chain_join,"
    "profit_rate,awards_score,enrich_lookup,linfit_table,corr_complete,residual_histogram,"
    "residual_normality,rare_removal_cast,rare_removal_chain,feature_concat,genre_explode,"
    "word_freq_top32,tfidf_long,anova_select,nb_accuracy,neighbour_accuracy,"
    "knn_vote,gaussian_bayes,multilabel_f1,dump_reshard"
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", HEADLINES).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("orders", "lineitem", "documents"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").groupBy().count().collect()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        query, _ = REGISTRY[name]
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
