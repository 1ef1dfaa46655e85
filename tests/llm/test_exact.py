import re

from pyspark.sql import functions as F

from filmlake.llm import exact

ROWS = [
    (5, "a  b"),
    (3, "a b"),
    (3, "a b"),
    (9, "a\tb\n"),
    (4, "a\n\nb "),
    (None, None),
    (7, ""),
    (None, "x"),
    (8, " "),
    (1, "a b"),
    (2, "x" * 50_000),
    (6, "x" * 50_000),
]


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    return groups


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, digest string")


def test_against_brute_force(spark):
    got = exact.deduplicate(frame(spark, ROWS)).collect()
    groups = brute(ROWS)
    assert len(got) == len(ROWS) and sum(r.kept for r in got) == len(groups)
    want = sorted(
        ((i, min((x for x in ids if x is not None), default=None), len(ids)) for ids in groups.values() for i in ids),
        key=str,
    )
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == want


def test_colliding_digests_are_told_apart(spark):
    weak = lambda text: F.length(text).cast("string")
    got = exact.deduplicate(frame(spark, ROWS), digest=weak)
    plain = exact.deduplicate(frame(spark, ROWS))
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


def test_kept_rows_keep_their_columns(spark):
    docs = frame(spark, ROWS).withColumn("locator", F.lit(1)).withColumn("place", F.lit(2))
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(brute(ROWS))


def test_an_empty_table(spark):
    assert exact.deduplicate(frame(spark, [])).count() == 0


def test_state_goes_on_with_what_lands_later(spark):
    seen = exact.SeenTexts(spark)
    for part in (ROWS[:4], ROWS[4:]):
        seen.land(exact.located(exact.as_scan(frame(spark, part)), "doc_id", "text"))
        seen.ingest()
    state = seen.state().collect()
    groups = brute(ROWS)
    assert sorted(r.rows for r in state) == sorted(len(ids) for ids in groups.values())
    assert {r.keep_id for r in state if r.rows == 3} == {3}


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = exact.deduplicate(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
