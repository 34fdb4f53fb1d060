from __future__ import annotations

import io
import zipfile
from datetime import date, datetime
from pathlib import Path
from xml.etree import ElementTree

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acervo.sinks.workbook import _column_name, workbook_bytes, write_workbooks
from acervo.sources.workbook import _column_index, as_variant, read_workbooks, sheet_rows, workbook_columns

TEXTS = st.text(st.characters(exclude_categories=["Cs", "Cc"], exclude_characters="￾￿") | st.sampled_from("\t\n\r<&>\"' "), max_size=12)


@given(st.lists(st.lists(st.none() | st.booleans() | st.integers(-(10**12), 10**12) | TEXTS, min_size=1, max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_cells_come_back(table):
    content = workbook_bytes({"first": ([], []), "it's <2>": (["h"], table)}, 1)
    got = list(sheet_rows(content, "it's <2>", False, True))
    assert got == list(sheet_rows(content, None, True, True)) and got[0] == ['"h"']
    import json

    for cells, row in zip(got[1:], table, strict=True):
        back = [None if v is None else json.loads(v) for v in cells]
        assert back + [None] * (len(row) - len(back)) == row


@given(st.integers(0, 20_000))
def test_column_names_are_those_the_reader_counts(at):
    assert _column_index(_column_name(at)) == at


def test_large_and_odd_tables(spark, tmp_path):
    folder = f"file:{tmp_path}/books"
    table = spark.range(0, 2500, numPartitions=3).select(
        "id", (F.col("id") / 7).alias("x"), F.expr("cast(id as decimal(12,2))").alias("d"), F.expr("if(id % 3 = 0, null, concat('n', id))").alias("a.b"),
        F.expr("timestamp_ntz'2024-02-29 12:30:00' + make_dt_interval(cast(id as int))").alias("at"), F.lit(date(1999, 12, 31)).alias("day"),
    )
    written = write_workbooks(table, folder, most=400)
    assert sorted(r.n_rows for r in written.collect()) == [33, 33, 34] + [400] * 6
    assert len(list(Path(f"{tmp_path}/books").glob("*.xlsx"))) == 9
    found, rejects = read_workbooks(spark, folder)
    assert rejects.isEmpty()
    back = workbook_columns(found, ["id", "x", "d", "a.b", "at", "day"])
    want = table.select("id", "x", F.col("d").cast("double"), F.col("`a.b`").alias("text"), F.date_trunc("minute", F.col("at").cast("timestamp")).alias("at"), "day")
    got = back.select(
        F.col("id").cast("long"), F.col("x").cast("double"), F.col("d").cast("double"), F.col("`a.b`").alias("text"),
        F.date_trunc("minute", F.col("at").cast("timestamp") + F.expr("interval 1 second")).alias("at"), F.to_date(F.substring("day", 1, 10)).alias("day"),
    )
    assert rows(got) == rows(want)
    # a run again writes the same files; no rows, no file
    write_workbooks(table, folder, most=400)
    assert read_workbooks(spark, folder)[0].count() == 2500
    assert write_workbooks(table.limit(0), f"{tmp_path}/none").isEmpty()


def test_typed_cells_and_a_cover(spark, tmp_path):
    table = spark.createDataFrame([(1, True, "x", 0.5, datetime(2024, 1, 2)), (2, None, None, None, None)], "n int, ok boolean, t string, f double, d timestamp_ntz")
    write_workbooks(table.coalesce(1), f"{tmp_path}/b", sheet="facts", cover="cover")
    typed = as_variant(read_workbooks(spark, f"{tmp_path}/b", typed=True)[0])
    assert rows(typed, F.to_json("raw")) == [('{"d":"2024-01-02T00:00:00","f":0.5,"n":1,"ok":true,"t":"x"}',), ('{"d":null,"f":null,"n":2,"ok":null,"t":null}',)]
    assert read_workbooks(spark, f"{tmp_path}/b")[0].isEmpty()  # the cover has no rows
    assert rows(read_workbooks(spark, f"{tmp_path}/b", sheet="other")[1], F.col("reason").contains("no sheet")) == [(True,)]


def test_a_written_workbook_is_well_formed():
    book = zipfile.ZipFile(io.BytesIO(workbook_bytes({"s": (["a"], [["x\ry"]])})))
    for name in book.namelist():
        ElementTree.fromstring(book.read(name))
    assert set(book.namelist()) >= {"xl/workbook.xml", "xl/worksheets/sheet1.xml", "xl/styles.xml"}
    with pytest.raises(zipfile.BadZipFile):
        list(sheet_rows(b"no book", None, False, False))


def test_orders_of_one_row_group_become_books_of_many_tasks(spark, tmp_path):
    from acervo.catalogue import roundtrips

    orders = spark.range(400).selectExpr("id AS o_orderkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice", "DATE'1996-01-02' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    written = roundtrips._order_books(spark, str(tmp_path), f"{tmp_path}/books").collect()
    assert len(written) == roundtrips.tasks(spark) > 1 and sum(r.n_rows for r in written) == 400
