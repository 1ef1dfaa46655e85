import gzip
import math

import pytest

from pyspark.sql import functions as F

from filmlake import session
from filmlake.operators.enrich import enrich_films, films_to_fetch
from filmlake.sources import dump, lexicon, tables


def test_json_round_trip_with_nan(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("m/1", float("nan")), ("m/2", 2.0)], "rotten_tomatoes_id string, critic_average double")
    tables.write_json_table(df, path, files=3)
    back = tables.read_json_table(spark, path, tables.RATINGS_SCHEMA)
    got = {r.rotten_tomatoes_id: r for r in back.collect()}
    assert got["m/1"].critic_average is None and got["m/2"].critic_average == 2.0
    assert back.schema == spark.createDataFrame([], tables.RATINGS_SCHEMA).schema
    assert all(f.name.endswith(".json.gz") for f in (tmp_path / "r").glob("part*"))


def test_parquet_round_trip(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("Q1", ["a"], [("+5", "Q9")])], "id string, genre array<string>, cost array<struct<amount:string,unit:string>>")
    tables.write_parquet_table(df, path)
    assert tables.read_parquet_table(spark, path).collect() == df.collect()


def test_gzip_dump_and_reshard(spark, tmp_path):
    source = tmp_path / "dump.json.gz"
    with gzip.open(source, "wt") as out:
        out.write("[\n" + ",\n".join('{"id":"Q%d"}' % i for i in range(100)) + "\n]\n")
    lines = dump.read_dump(spark, str(source))
    assert lines.rdd.getNumPartitions() == 1
    target = str(tmp_path / "shards")
    dump.reshard_dump(lines, target, partitions=4, max_records=10)
    shards = list((tmp_path / "shards").glob("part*.txt.gz"))
    assert len(shards) >= 10
    cleaned = dump.entity_lines(dump.read_dump(spark, target))
    assert {r.value for r in cleaned.collect()} == {'{"id":"Q%d"}' % i for i in range(100)}


def test_word_lists(spark, tmp_path):
    good, bad = tmp_path / "good.txt", tmp_path / "bad.txt"
    good.write_bytes("naïve\nwell-made\n\"quoted\nodd\n\n".encode("latin-1"))
    bad.write_bytes("grim\nodd\ngrim\n".encode("latin-1"))
    assert {r.word for r in lexicon.read_word_list(spark, str(good)).collect()} == {"naïve", "well-made", '"quoted', "odd"}
    signed = {r.word: r.polarity for r in lexicon.read_lexicon(spark, str(good), str(bad)).collect()}
    assert signed == {"naïve": 1, "well-made": 1, '"quoted': 1, "odd": 0, "grim": -1}


def test_enrichment(spark):
    films = spark.createDataFrame([("tt1", "long title"), ("tt2", "b"), ("tt3", "cc"), ("tt4", "dd")], "imdb_id string, label string")
    answers = spark.createDataFrame(
        [("tt1", "ok", '{"Genre":"Drama, War","Plot":"p","Awards":"N/A"}'), ("tt2", "notfound", None)],
        "imdb_id string, status string, payload string",
    )
    got = enrich_films(films, answers).collect()
    assert [(r.imdb_id, r.omdb_genres, r.omdb_plot, r.omdb_awards) for r in got] == [("tt1", ["Drama", "War"], "p", "N/A")]
    todo = films_to_fetch(films, answers, 1).collect()
    assert [r.imdb_id for r in todo] == ["tt3"]
    assert len(films_to_fetch(films, answers, 10).collect()) == 2


class FakeSession:
    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder():
    cluster = FakeSession("hdfs://shared/", "spark://host:7077")
    assert session.fresh_path(cluster, "x").startswith("hdfs://shared/filmlake/x-")
    assert session.fresh_path(cluster, "x") != session.fresh_path(cluster, "x")
    assert session.shared_dir(FakeSession(None, "local[2]")) == session.shared_dir(FakeSession(None, "local[2]"))
    with pytest.raises(ValueError):
        session.shared_dir(FakeSession(None, "spark://host:7077"))


def test_broadcast_only_when_small(spark):
    small, large = spark.range(10), spark.range(11)
    assert session.broadcast_checked(large, 10) is large
    assert session.broadcast_checked(small, 10) is not small


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, ["a"], math.pi), (2, None, None)], "a long, b array<string>, c double")
    kept = session.materialize(df, "t")
    assert kept.schema == df.schema
    assert sorted(kept.collect()) == sorted(df.collect())


@pytest.mark.parametrize("schema", [tables.FILMS_SCHEMA, tables.ENRICHMENT_SCHEMA])
def test_declared_schemas_parse(spark, schema):
    assert spark.createDataFrame([], schema).columns


def test_shards_follow_the_bytes(spark, tmp_path):
    lines = spark.range(2000).select(F.concat(F.lit("x" * 90), F.col("id").cast("string")).alias("value"))
    counts = []
    for n, part in enumerate((lines, lines.union(lines))):
        target = str(tmp_path / f"shards{n}")
        dump.reshard_dump(part, target, target_bytes=20_000)
        counts.append(len(list((tmp_path / f"shards{n}").glob("*.gz"))))
        assert spark.read.text(target).count() == part.count()
    assert counts == [10, 19]


def test_dump_lines_are_made_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """A task had as many orders as its split of narrow rows held, whatever the length of their lines."""
    from filmlake.plans import views

    cores = spark.sparkContext.defaultParallelism
    n = 40 * cores
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"), F.to_date(F.lit("2001-02-03")).alias("o_orderdate"), F.lit(1.5).alias("o_totalprice")
    )
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(views, "DUMP_ROWS", 10)
    lines = views.dump_lines(spark, str(tmp_path))
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 * cores and max(sizes) <= 25 and sum(sizes) == n + 1
