"""The operators over whole sample tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstrata.llm import (
    archive,
    chat,
    decontaminate,
    language_model,
    licenses,
    neighbours,
    packing,
    quality,
    repeats,
    search,
    simhash,
    spans,
    trie,
)
from orderstrata.llm.common import stored

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -1, whose texts are control strings, read back."""
    given = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = [F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"))
             for k, r in enumerate(("user", "assistant"))]
    tricky = spark.range(1).select(F.explode(F.array(*turns)).alias("t"))
    tricky = tricky.select(
        F.lit(-1).cast("long").alias("conv_id"), "t.turn", "t.role", F.lit(CONTROL_TEXT).alias("text")
    )
    return chat.conversation_digests(given.unionByName(tricky))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 50 bytes of earlier ones."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    marked = repeats.mark_repeats(docs, window=50)
    removed = F.aggregate(
        "repeats", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"]
    )
    left = F.coalesce("kept", F.lit(b""))
    return marked.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("repeats").cast("long").alias("n_spans"),
        F.sha2(left, 256).alias("kept_sha256"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's posterior; sources stand for hosts, languages for their paths."""
    return quality.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(load(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth one."""
    return neighbours.nearest(
        load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return packing.pack(docs, length=2048, with_ids=False).drop("ids")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=3, distance=2)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived_pages(load(spark, sf_dir, "pages"))


def _sharing_heads(marks: DataFrame) -> DataFrame:
    """Conversations that begin with up to three turns of the one that heads their twenty."""
    conv = F.col("conv_id")
    taken = F.crc32(conv.cast("string").cast("binary")) % 4
    convs = marks.where("place = 1").select(
        "conv_id", (conv - conv % 20).alias("head"), taken.alias("taken")
    )
    heads = marks.where("place <= 3").withColumnRenamed("conv_id", "head")
    shared = convs.join(heads, "head").where("place <= taken").drop("head", "taken")
    own = marks.where(F.col("place") > taken)
    # one without any turn is still there
    empty = convs.selectExpr("conv_id", "NULL AS place", "NULL AS mark", "NULL AS words")
    return shared.unionByName(own).unionByName(empty)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of all conversations, each rebuilt on turns of another."""
    marks = stored(trie.turn_marks(load(spark, sf_dir, "conversations")), "marks")
    return trie.prefix_tree(_sharing_heads(marks))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without runs of 35 words that also start elsewhere."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    marked = spans.mark_repeated_spans(docs, window=35)
    return marked.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search.ranked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    query.__name__: query
    for query in (
        op1_chat_format,
        op2_suffix_array_dedup,
        op3_quality_classifier,
        op4_benchmark_decontamination,
        op5_lm_scoring,
        op6_nearest_neighbours,
        op7_packing,
        op8_license_scan,
        op9_simhash,
        op10_warc,
        op11_prefix_trie,
        op12_substring_dedup,
        op13_ranked_search,
    )
}
