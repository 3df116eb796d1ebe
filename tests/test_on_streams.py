"""Operators that look at one row at a time serve streaming frames as they are."""

from orderstrata.contracts import STORE_PRODUCTS
from orderstrata.operators.clean import clean
from orderstrata.operators.enrich import product_master


def test_clean_and_enrich_a_stream(spark, tmp_path):
    header = ",".join(STORE_PRODUCTS.columns)
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(f"{header}\n 1 ,d,n,1,,1,1,1,1,,,,,, Socks \n")
    schema = ", ".join(f"{name} string" for name in STORE_PRODUCTS.columns)
    raw = spark.readStream.schema(schema).csv(str(source), header=True)
    query = (
        product_master(clean(raw, STORE_PRODUCTS.schema))
        .writeStream.format("memory")
        .queryName("published")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    (row,) = spark.table("published").collect()
    assert (row.ProductID, row.Color, row.ProductCategoryName) == (1, "N/A", "Clothing")
