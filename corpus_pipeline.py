"""A corpus for training, from raw documents to packed sequences.

Each stage works on all that the one before kept: documents of poor quality or toxic
ones go, then near duplicates, then passages that an earlier document holds, then
documents with benchmark items, and what remains is packed.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderstrata.llm import decontaminate, packing, quality, repeats, simhash
from orderstrata.llm.common import new_folder, stored, unused_name
from orderstrata.plans.sizing import small_enough

# Bits of a row's number that are its place in its file.
PLACE_BITS = 40


# What a plan may hold for a row's place in its file to be a number of its own.
ROW_BY_ROW = {"Project", "Filter", "Relation", "SubqueryAlias"}


def _only_scans(docs: DataFrame) -> bool:
    """Whether ``docs`` are rows of files as they are, each once."""
    plan = docs._jdf.queryExecution().analyzed().toString()
    return {re.search(r"[A-Za-z]+", line)[0] for line in plan.splitlines()} <= ROW_BY_ROW


def _read_once(placed: DataFrame, file: str, place: str) -> bool:
    """Whether no file is listed twice, and the names of all files may be sent to every task.

    Rows of a file listed twice have each place twice, far beyond the error of an approximate
    count of the places.
    """
    counts = placed.groupBy(file).agg(
        F.count("*").alias("n_rows"), F.approx_count_distinct(place).alias("n_places")
    )
    return counts.where("n_rows > 1.5 * n_places").isEmpty() and small_enough(counts.select(file))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row, the same in every scan, and its name.

    Rows of Parquet files are numbered by their place in their file and the file's place
    among all files by name, so that nothing is written; any other frame is written once, with a
    number each. Files are far fewer than rows, but their names are only sent to all tasks
    if they are within the size that is allowed for that.
    """
    names = ("row", "file", "place", "named", "at")
    row, file, place, named, at = (unused_name(docs, name) for name in names)
    if _only_scans(docs):
        try:
            placed = docs.withColumns(
                {file: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")}
            )
        except AnalysisException:  # files without such places
            placed = None
        if placed and _read_once(placed, file, place):
            files = placed.select(file).distinct()
            nth = F.row_number().over(Window.orderBy(named)).cast("long")
            numbers = files.toDF(named).withColumn(at, nth)
            met = placed.join(F.broadcast(numbers), F.col(file) == F.col(named))
            number = F.shiftleft(at, PLACE_BITS).bitwiseOR(F.col(place))
            return met.select(*docs.columns, number.alias(row)), row
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def _without(docs: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """``docs`` but for the listed rows, and without the numbers."""
    listed = rows.toDF("listed").distinct()
    return docs.join(listed, docs[row] == listed["listed"], "left_anti").drop(row)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier keeps, each judged for itself.

    NULL texts are judged as empty ones; rows that repeat an id or a text each get a verdict,
    equal ones the same. Long texts are judged whole. All columns stay, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, row = _numbered(docs)
    judged = quality.judge(docs, labels, row_column=row)
    return _without(docs, row, judged.where("NOT keep").select(row))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one row: the smallest id, none last; of one id the least by its text's hash.

    Of equal rows one stays. NULL and empty texts are one group; long texts are compared by all
    their words. All columns stay, whatever their names.
    """
    docs, row = _numbered(docs)
    groups = simhash.near_duplicates(docs, id_column=row, shingle=3, distance=2)
    groups = groups.select(F.col("doc_id").alias("member"), "component_id")
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col(row)]
    ranks = docs.select(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(order)]).alias("rank"))
    met = ranks.join(groups, ranks["rank.c3"] == groups["member"])
    first = met.groupBy("component_id").agg(F.min("rank").alias("rank"))
    first = first.select(F.col("rank.c3").alias("first"))
    return docs.join(first, docs[row] == first["first"], "left_semi").drop(row)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds.

    ``n_chars`` is counted anew, or added. NULL texts stay NULL; rows without an id come after
    all others; rows of one id don't count against each other. Texts may be of any length.
    All other columns stay as they are, whatever their names.
    """
    return repeats.without_repeats(docs, window=50).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item.

    Each goes by its own text, whatever its id; NULL and empty texts hold none and stay, and
    long ones are searched whole. All columns stay, whatever their names.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, row = _numbered(docs)
    leaking = decontaminate.leaks(docs, benchmark, id_column=row)
    return _without(docs, row, leaking.select("doc_id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, token ids included.

    Every row is a document of its own, with an end at least: NULL and empty texts, and rows that
    repeat an id, too; long ones are cut. Other columns than id and text go.
    """
    return packing.pack(docs, length=2048)


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# Training, fingerprints and token ids are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
