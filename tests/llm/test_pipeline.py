"""Each stage of the pipeline against brute force on what it was given."""

import corpus_pipeline
import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "SimHash near-dedup",
        "suffix-array dedup",
        "benchmark decontamination",
        "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_quality_drops_what_is_judged_poor(spark, docs):
    from orderstrata.llm import quality

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    keep = {r.doc_id for r in quality.judge(docs, labels).where("keep").collect()}
    kept = corpus_pipeline.classify_quality(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == keep and 0 < len(keep) < docs.count()


def test_one_of_each_group_stays(spark):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in [
        (4, "the same words here"), (2, "The same  words here"), (9, "something else entirely now"),
        (9, "something else entirely now"), (None, "the same words here"), (None, "alone, without id"),
    ]]
    given = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, given, SF_DIR)
    assert kept.columns == given.columns
    texts = sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect())
    assert texts == [(2, "The same  words here"), (9, "something else entirely now")]
    assert "alone, without id" in {r.text for r in kept.where("doc_id IS NULL").collect()}


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    texts = [
        (4, "the same words here"), (None, "the same words here"), (None, "The same  words here"),
        (None, "alone, without id"), (None, "alone,  without id"), (4, "another text of this id"),
        (3, "another text of  this id"), (3, "one more text altogether"),
    ]
    given = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, given, SF_DIR).collect()
    found = sorted(((r.doc_id, " ".join(r.text.lower().split())) for r in kept), key=repr)
    assert found == [
        (3, "another text of this id"), (3, "one more text altogether"),
        (4, "the same words here"), (None, "alone, without id"),
    ]


def test_rows_are_judged_one_by_one(spark, docs, monkeypatch):
    """Rows of good and poor texts, without ids or of one id, by the row's own verdict."""
    from pyspark.sql import functions as F

    from orderstrata.llm import quality

    real = quality.judge

    def judge(given, labels, **options):
        judged = real(given, labels, **options)
        texts = given.select(F.col("row").alias("r"), "text")
        poor = judged.join(texts, judged["row"] == texts["r"]).withColumn(
            "keep", ~F.col("text").startswith("poor")
        )
        return poor.select(*judged.columns)

    monkeypatch.setattr(quality, "judge", judge)
    given = spark.createDataFrame(
        [(k, t, "en", "s", len(t)) for k in (None, 7) for t in ("poor text", "good text")], SCHEMA
    )
    kept = corpus_pipeline.classify_quality(spark, given, SF_DIR)
    assert kept.columns == given.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(None, "good text"), (7, "good text")}


def test_leaking_rows_go_one_by_one(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").head().text
    given = spark.createDataFrame(
        [(k, t, "en", "s", len(t)) for k in (None, 7) for t in (f"Before. {item} After.", "clean")],
        SCHEMA,
    )
    kept = corpus_pipeline.drop_leaks(spark, given, SF_DIR).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(None, "clean"), (7, "clean")}


def test_repeats_are_cut(spark):
    passage = "a passage of considerably more than fifty bytes, é, in several texts"
    given = spark.createDataFrame(
        [(1, passage, "en", "s", 9), (2, f"x{passage}y", "en", "s", 9), (3, None, "en", "s", None)],
        SCHEMA,
    )
    kept = corpus_pipeline.cut_repeats(spark, given, SF_DIR)
    assert kept.columns == given.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {
        1: (passage, len(passage)), 2: ("xy", 2), 3: (None, None),
    }


def test_leaks_go(spark, docs):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").head()
    given = spark.createDataFrame(
        [(1, f"Before. {item.text.upper()} After.", "en", "s", 1), (2, "clean", "en", "s", 1),
         (None, None, None, None, None)],
        SCHEMA,
    )
    kept = corpus_pipeline.drop_leaks(spark, given, SF_DIR)
    assert kept.columns == given.columns
    assert {r.doc_id for r in kept.collect()} == {2, None}


def test_whole_run_packs_what_is_left(spark):
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert pieces and len({r.doc_id for r in pieces}) < 200
    assert sum(r.length for r in pieces) == sum(
        {r.doc_id: r.doc_tokens for r in pieces}.values()
    )


def test_no_documents(spark, docs):
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none_left = stage(spark, none, SF_DIR)
        assert none_left.collect() == []


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_of_files_get_the_same_numbers_in_every_scan(spark, docs, tmp_path):
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    files = spark.read.parquet(str(tmp_path / "docs"))
    numbered, row = corpus_pipeline._numbered(files.where("doc_id > 20").select("doc_id", "text"))
    numbers = {r.doc_id: r[row] for r in numbered.collect()}
    assert len(set(numbers.values())) == len(numbers) == files.where("doc_id > 20").count()
    assert numbers == {r.doc_id: r[row] for r in numbered.select("doc_id", row).coalesce(1).collect()}
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan


def test_rows_that_come_from_one_place_get_numbers_too(spark, docs):
    from pyspark.sql import functions as F

    twice = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = f"{SF_DIR}/documents.parquet"
    listed_twice = spark.read.parquet(path, path).where("doc_id < 30")
    for given in (twice, docs.unionAll(docs), docs.limit(10), docs.sample(0.5, 1), listed_twice):
        numbered, row = corpus_pipeline._numbered(given)
        assert numbered.select(row).distinct().count() == numbered.count() > 0


def test_stages_with_clashing_names(spark, tmp_path):
    """Columns named like those that operators make up keep their values."""
    names = ["row", "_row", "file", "place", "listed", "member", "component_id", "rank", "kept",
             "repeats", "ranges", "number", "at", "doc", "named", "keep", "good", "host"]
    text = "a text of some words, told apart by its number and long enough to be kept whole "
    rows = [(k, f"{text * 3} {k} {k}", "en", "s", 9, *[f"{n}{k}" for n in names]) for k in range(6)]
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "docs"))
    given = spark.read.parquet(str(tmp_path / "docs"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, given, SF_DIR)
        assert left.columns == given.columns
        for r in left.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names)


def test_what_a_run_left_can_be_removed(spark, tmp_path):
    from pathlib import Path

    from orderstrata.llm import common

    common._made.clear()
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("llm-*"))
    corpus_pipeline.run(spark, SF_DIR).count()
    left = set(shared.glob("llm-*")) - before
    assert len(left) > 5
    assert common.drop_intermediates(spark) >= len(left)
    assert not set(shared.glob("llm-*")) - before
    assert common.drop_intermediates(spark) == 0
