"""Headers of many files, read by tasks."""

import pytest
from py4j.java_gateway import JavaMember

from orderstrata.plans import ingest
from orderstrata.sources import ParquetTables, data_files, read_csv
from orderstrata.sources.delimited import header_lines


def test_the_driver_opens_no_file_of_a_thousand(spark, tmp_path, monkeypatch):
    folder = tmp_path / "lines.csv"
    folder.mkdir()
    for k in range(1000):
        names = "a,b" if k % 3 else "b,a"
        (folder / f"part-{k:04d}.csv").write_text(f"{names}\n{k},{k}\n")
    asked = []
    call = JavaMember.__call__
    monkeypatch.setattr(JavaMember, "__call__", lambda m, *a: asked.append(m.name) or call(m, *a))
    df = read_csv(spark, str(folder))
    assert not {"open", "create", "createInputStream", "readLine", "newBufferedReader"} & set(asked)
    assert df.where("a = b").count() == df.count() == 1000


def test_first_lines_of_all_kinds_of_files(spark, tmp_path):
    folder = tmp_path / "odd names, 100% of them"
    folder.mkdir()
    texts = {
        "plain.csv": "a,b\n1,2\n",
        "marked.csv": "﻿a,b\n1,2\n",
        "late.csv": "\n  \nb,a\n3,4\n",
        "one line.csv": "a,b",
        "blank.csv": "\n \n",
        "é%20.csv": "A,b\r\n5,6\r\n",
    }
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    found = header_lines(spark, sorted(data_files(spark, str(folder))))
    assert {file.rsplit("/", 1)[1]: line for file, line in found.items()} == {
        "plain.csv": "a,b",
        "marked.csv": "a,b",
        "late.csv": "b,a",
        "one line.csv": "a,b",
        "é%20.csv": "A,b",
    }
    assert set(found) <= set(data_files(spark, str(folder)))
    rows = read_csv(spark, str(folder).replace(",", "\\,")).select("a", "b").collect()
    assert sorted(tuple(r) for r in rows) == [("1", "2"), ("1", "2"), ("4", "3"), ("5", "6")]


def test_only_first_blocks_are_looked_at(spark, tmp_path):
    """A file of several blocks has its header in the first; later ones don't give another."""
    folder = tmp_path / "long.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n" + "x,y\n" * 50_000)
    (folder / "b.csv").write_text("b,a\n1,2\n")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        found = header_lines(spark, sorted(data_files(spark, str(folder))))
        assert sorted(found.values()) == ["a,b", "b,a"]
        rows = read_csv(spark, str(folder))
        assert rows.count() == 50_001 and rows.where("a = '2'").count() == 1
    finally:
        spark.conf.set(name, before)


def test_loading_looks_at_headers_only_when_they_differ(spark, tmp_path, monkeypatch):
    looked = []
    monkeypatch.setattr(ingest, "read_csv", lambda s, p: looked.append(p) or read_csv(s, p))
    tables = ParquetTables(spark, str(tmp_path / "tables"))
    for kind, second in (("alike", "a,b\n3,4\n"), ("differing", "b,a\n4,3\n")):
        folder = tmp_path / kind / ingest.PRODUCTS_FILE
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text("a,b\n1,2\n")
        (folder / "y.csv").write_text(second)
        ingest.load_products(tables, str(tmp_path / kind))
        rows = tables.read_raw(ingest.RAW_PRODUCTS).select("a", "b").collect()
        assert sorted(tuple(r) for r in rows) == [("1", "2"), ("3", "4")]
        assert bool(looked) == (kind == "differing")
    (folder / "z.csv").write_text("a,b,c\n1,2,3\n")
    with pytest.raises(ValueError, match="z.csv .*differ in the columns c"):
        ingest.load_products(tables, str(tmp_path / "differing"))
    assert tables.read_raw(ingest.RAW_PRODUCTS).count() == 2
