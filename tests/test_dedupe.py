"""One row per key, and the rows left over."""

import random
from collections import Counter

from pyspark.sql import functions as F

from orderstrata.operators import dedupe

SCHEMA = "k int, a string, b int"
ROWS = [
    (1, "x", 3),
    (1, "x", 3),
    (1, "x", 4),
    (1, None, 9),
    (2, "y", None),
    (2, "y", 1),
    (3, "z", 1),
    (None, "n", 2),
    (None, "n", 1),
]
KEPT = [(1, None, 9), (2, "y", None), (3, "z", 1), (None, "n", 1)]


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keeps_the_least_row_of_each_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = dedupe.keep_one(df, "k")
    assert kept.columns == df.columns
    assert bag(kept) == Counter(KEPT)


def test_choice_does_not_depend_on_order_or_partitions(spark):
    df = spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(5)
    assert bag(dedupe.keep_one(df, "k")) == Counter(KEPT)


def test_key_need_not_come_first(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).select("a", "k", "b")
    assert bag(dedupe.keep_one(df, "k")) == Counter((a, k, b) for k, a, b in KEPT)


def test_key_alone(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).select("k")
    assert bag(dedupe.keep_one(df, "k")) == Counter([(1,), (2,), (3,), (None,)])
    assert bag(dedupe.surplus_rows(df, "k")) == Counter({(1,): 3, (2,): 1, (None,): 1})


def test_each_task_sends_one_row_per_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    before_shuffle = plan_of(dedupe.keep_one(df, "k")).split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_surplus_is_what_was_not_kept(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert bag(dedupe.surplus_rows(df, "k")) == Counter(ROWS) - Counter(KEPT)


def test_no_surplus(spark):
    df = spark.createDataFrame(KEPT, SCHEMA)
    assert dedupe.surplus_rows(df, "k").isEmpty()


def test_surplus_of_one_key_is_numbered_by_several_tasks(spark):
    copies = spark.range(0, 8000, 1, 8).select(
        (F.col("id") * 0 + 1).alias("k"), F.lit("same").alias("a"), F.lit(2).alias("b")
    )
    surplus = dedupe.surplus_rows(copies, "k")
    # neither window gathers rows by the key alone
    shuffles = [line for line in plan_of(surplus).splitlines() if "Exchange" in line]
    assert len(shuffles) == 2
    assert all("_task" in line or "_group" in line for line in shuffles)
    assert bag(surplus) == Counter({(1, "same", 2): 7999})


def test_half_the_rows_under_one_key(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").cast("string").alias("a"),
        (F.col("id") % 5).cast("int").alias("b"),
    )
    kept = dedupe.keep_one(rows, "k")
    assert kept.count() == 20_000
    assert kept.where("k = 7").first().a == "0"
    assert dedupe.surplus_rows(rows, "k").count() == 20_000


def test_random_rows_against_a_plain_model(spark):
    pick = random.Random(11)
    rows = [
        (
            pick.choice([None, 1, 2, 3, 4, 5]),
            pick.choice([None, "", "a", "b", "ä"]),
            pick.choice([None, -1, 0, 1]),
        )
        for _ in range(400)
    ]
    rows += [(k, "only", 0) for k in range(100, 200)]

    def place(row):
        return tuple((value is not None, value) for value in row[1:])

    kept = {}
    for row in rows:
        if row[0] not in kept or place(row) < place(kept[row[0]]):
            kept[row[0]] = row
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert bag(dedupe.keep_one(df, "k")) == Counter(kept.values())
    assert bag(dedupe.surplus_rows(df, "k")) == Counter(rows) - Counter(kept.values())
