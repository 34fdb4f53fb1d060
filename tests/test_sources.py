from __future__ import annotations

import gzip
import json
import zipfile
from datetime import date

import pytest
from conftest import rows
from files import write_part, write_workbook
from pyspark.sql import functions as F

from acervo.sources import batches, paths, ranking, responses, snapshot, tables, workbook, wrapped
from acervo.sources.base import Source

c = F.col


def test_snapshot_good_and_rejects(spark, tmp_path):
    write_part(tmp_path, "works", "2024-01-02", "part_000.gz", [
        {"id": "W1", "is_xpac": False}, "not valid json", "", "   ", {"id": ""}, {"title": "no id"}, {"id": 0}, "[1]",
        {"id": "W2", "is_xpac": True}, {"id": "W3", "is_xpac": None}, {"id": "W4", "is_xpac": "true"},
    ])
    write_part(tmp_path, "works", "2024-01-03", "part_000.gz", [{"id": "W5", "ñ": "é"}])
    (tmp_path / "data" / "works" / "manifest").write_text("{}")
    good, rejects = snapshot.read_ndjson(spark, str(tmp_path), "works")
    assert rows(good, "id", "updated_date") == [
        ("W1", date(2024, 1, 2)), ("W3", date(2024, 1, 2)), ("W4", date(2024, 1, 2)), ("W5", date(2024, 1, 3)),
    ]
    assert rows(rejects, "line", "reason") == sorted(
        [("not valid json", "bad_json"), ('{"id": ""}', "no_id"), ('{"title": "no id"}', "no_id"), ('{"id": 0}', "no_id"), ("[1]", "not_an_object")],
        key=repr,
    )
    other = write_part(tmp_path, "sources", "2024-01-02", "part_000.gz", [{"id": "S1", "is_xpac": True}])
    good, _ = snapshot.read_ndjson(spark, str(tmp_path), "sources")
    assert rows(good, "id") == [("S1",)]
    assert good.first()["file_path"].endswith(other.name)


def test_snapshot_edges(spark, tmp_path):
    with pytest.raises(ValueError, match="works"):
        snapshot.read_ndjson(spark, str(tmp_path), "invalid_entity")
    good, rejects = snapshot.read_ndjson(spark, str(tmp_path), "works")
    assert good.count() == 0 and rejects.count() == 0
    assert len(snapshot.ENTITIES) == 21


BATCH_CASES = {
    "ndjson": ('{"id": 1}\n\n{"id": 2}\n{"id": 3}\n', [1, 2, 3], 0),
    "ndjson_bad_line_ends_it": ('{"id": 1}\n{"id": 2}\noops\n{"id": 4}\n', [1, 2], 2),
    "ndjson_skips_non_objects": ('{"id": 1}\n{"id": 2}\n[5]\n{"id": 4}\n', [1, 2, 4], 0),
    "bad_second_line": ('{"id": 1}\noops\n{"id": 3}\n', [1], 2),
    "list_second_line": ('{"id": 1}\n[2]\n', [1], 1),
    "array": ('[{"id": 1}, 5, {"id": 2}]', [1, 2], 0),
    "pretty_array": ('[\n {"id": 1},\n {"id": 2}\n]', [1, 2], 0),
    "envelope": ('{"results": [{"id": 1}, "x", {"id": 2}]}\n{"id": 9}\n', [1, 2], 1),
    "second_envelope_key": ('{"results": 3, "data": [{"id": 7}]}', [7], 0),
    "no_list_in_envelope": ('{"id": 8, "items": null}', [8], 0),
    "single_pretty_object": ('{\n "id": 5\n}', [5], 0),
    "pretty_envelope": ('{\n "records": [{"id": 6}]\n}', [6], 0),
    "bad": ("{oops", [], 1),
}


def test_json_batches(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for n, (text, _, _) in enumerate(BATCH_CASES.values()):
        (tmp_path / "deep" / f"article_batch_{n:02}.json").write_text(text, encoding="utf-8")
    (tmp_path / "journal_batch_1.json").write_text('{"id": 100}')
    (tmp_path / "article_batch_x.txt").write_text('{"id": 101}')
    good, rejects = batches.read_json_batches(spark, str(tmp_path), "article")
    found: dict = {}
    for path, position, value in good.select("file_path", "position", F.try_variant_get("raw", "$.id", "int")).collect():
        found.setdefault(int(path[-7:-5]), []).append((position, value))
    lost = {int(r["file_path"][-7:-5]): r["lines"] for r in rejects.collect()}
    for n, (name, (_, wanted, lines)) in enumerate(BATCH_CASES.items()):
        assert [v for _, v in sorted(found.get(n, []))] == wanted, name
        assert lost.get(n, 0) == lines, name
    journals, _ = batches.read_json_batches(spark, str(tmp_path), "journal")
    assert journals.count() == 1


RANKING = (
    "Rank;Sourceid;Title;Type;Issn;SJR;SJR Best Quartile;H index;Total Docs. (2023);Total Docs. (3years);Total Refs.;"
    "Total Cites (3years);Citable Docs. (3years);Cites / Doc. (2years);Ref. / Doc.;Country;Region;Publisher;Coverage;Categories\n"
)


def ranking_row(rank, source, title, sjr="1.5"):
    return f"{rank};{source};{title};journal;12345678;{sjr};Q1;10;100;300;4000;900;290;3.1;40.0;Colombia;Latin America;Pub;2000-2023;Cat\n"


def test_ranking(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(RANKING + ranking_row(1, 12345, '"A; B"') + ranking_row(2, 12345, "later") + ranking_row(3, "bad", "x") + ranking_row(4, "", "y"))
    good, bad = ranking.read_ranking(spark, str(path), 2023)
    assert rows(good, "Sourceid", "year", "Rank", "Title") == [(12345, 2023, 1, "A; B")]
    assert "Cites / Doc_ (2years)" in good.columns and not any("." in name for name in good.columns)
    assert bad.count() == 2


def test_ranking_keeps_decimal_commas_as_text(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(RANKING + ranking_row(1, 5, "t", sjr='"1,5"'))
    good, _ = ranking.read_ranking(spark, str(path), 2023)
    assert good.first()["SJR"] == "1,5"


def test_workbook_rows_as_text(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"S": [["col_a", "col_b", "n"], ["x", None, 7], ["inline:y & z", "date:45000", 1.5], [None, None, None], ["s", "t", True, "cut"]]})
    (tmp_path / "broken.xlsx").write_bytes(b"no zip")
    (tmp_path / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0")
    got, rejects = workbook.read_workbooks(spark, str(tmp_path))
    columns = workbook.workbook_columns(got, ["col_a", "col_b", "n", "absent"])
    assert rows(columns.drop("file_path")) == [
        (0, "x", None, "7", None), (1, "y & z", "2023-03-15 00:00:00", "1.5", None), (2, None, None, None, None), (3, "s", "t", "True", None),
    ]
    assert sorted(p.rsplit("/", 1)[1] for (p,) in rows(rejects.select("file_path"))) == ["broken.xlsx", "old.xls"]


def test_workbook_typed_sheet(spark, tmp_path):
    sheets = {"first": [["no"]], "main": [["name", "name", None, "n"], ["x", "y"], [None, None, None, None], ["z", None, "date:1.5", 2, "cut"], ["w", None, None, 2.5]]}
    write_workbook(tmp_path / "a.xlsx", {**sheets, "empty": []}, active=1)
    got, rejects = workbook.read_workbooks(spark, str(tmp_path), typed=True)
    documents = [json.loads(r[0]) for r in workbook.as_variant(got).orderBy("row_number").select(F.to_json("raw")).collect()]
    assert documents == [
        {"name": "x", "name_2": "y", "column_3": None, "n": None},
        {"name": "z", "name_2": None, "column_3": "1899-12-31T12:00:00", "n": 2},
        {"name": "w", "name_2": None, "column_3": None, "n": 2.5},
    ]
    assert rejects.count() == 0
    named, _ = workbook.read_workbooks(spark, str(tmp_path), sheet="first", typed=True)
    assert named.count() == 0
    assert workbook.read_workbooks(spark, str(tmp_path), sheet="empty", typed=True)[0].count() == 0
    _, rejects = workbook.read_workbooks(spark, str(tmp_path), sheet="absent", typed=True)
    assert rejects.count() == 1


def test_workbook_dois(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"S": [["doi", "t"], ["10.1/a", "x"], [None, "y"]]})
    assert rows(workbook.workbook_dois(spark, str(tmp_path / "a.xlsx"))) == [("10.1/a",)]
    assert workbook.workbook_dois(spark, str(tmp_path / "none.xlsx")).count() == 0


def test_wrapped_list_longer_than_a_variant(spark, tmp_path):
    body = "x" * 1000
    with gzip.open(tmp_path / "big.json.gz", "wt", compresslevel=1) as out:
        out.write('{"meta": {"items": 3}, "items": [')
        out.write(", ".join(json.dumps({"id": i, "body": body}) for i in range(140_000)))
        out.write("], \"more\": NULL}".replace("NULL", "null"))
    good, rejects = wrapped.read_wrapped(spark, str(tmp_path / "big.json.gz"))
    assert good.count() == 140_000 and rejects.count() == 0
    assert good.select(F.countDistinct(F.try_variant_get("raw", "$.id", "int"))).first()[0] == 140_000


def test_damaged_wrapped_files(spark, tmp_path):
    texts = ["[1, 2", "[1] 2", '{"items": [1,]}', '{"a": 1', "3", "[NaN]", '{1: 2}']
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.json").write_text(text)
    good, rejects = wrapped.read_wrapped(spark, str(tmp_path))
    assert good.count() == 0 and rows(rejects, "reason") == [("bad_json",)] * len(texts)
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "a.json").write_text(' [ {"id": 1} , "two", [3], null, -4.5e3 ] ')
    good, rejects = wrapped.read_wrapped(spark, str(tmp_path / "odd"))
    assert [r[0] for r in good.orderBy("position").select(F.to_json("raw")).collect()] == ['{"id":1}', '"two"', "[3]", "null", "-4500.0"] and rejects.count() == 0


def test_one_odd_value_does_not_stop_a_batch_load(spark, tmp_path):
    (tmp_path / "journal_batch_1.json").write_text('{"id": 1}\n{"id": 2}\n{"id": NaN}\n')
    (tmp_path / "journal_batch_2.json").write_text('[{"id": "\\ud800"}, {"id": 4}]')
    good, rejects = batches.read_json_batches(spark, str(tmp_path), "journal")
    ids = {r[0] for r in good.select(F.try_variant_get("raw", "$.id", "int")).collect()}
    assert {1, 2, 4} <= ids and rejects.count() >= 1


def test_wrapped_files(spark, tmp_path):
    documents = [{"id": "https://ror.org/1"}, {"id": "https://ror.org/2"}]

    def ids(path):
        good, rejects = wrapped.read_wrapped(spark, str(path))
        return [r[0] for r in good.orderBy("position").select(F.try_variant_get("raw", "$.id", "string")).collect()], rejects.count()

    plain = tmp_path / "a.json"
    plain.write_text(json.dumps(documents))
    assert ids(plain) == (["https://ror.org/1", "https://ror.org/2"], 0)
    items = tmp_path / "b.json.gz"
    with gzip.open(items, "wt") as out:
        out.write(json.dumps({"items": documents[:1]}, indent=1))
    assert ids(items) == (["https://ror.org/1"], 0)
    single = tmp_path / "c.json"
    single.write_text(json.dumps({"id": "x", "items": 3}))
    assert ids(single) == (["x"], 0)
    archive = tmp_path / "d.zip"
    with zipfile.ZipFile(archive, "w") as book:
        book.writestr("v1-ror-data.json", "[]")
        book.writestr("v2-ROR-data.json", json.dumps(documents))
        book.writestr("z.json", "[]")
    assert ids(archive) == (["https://ror.org/1", "https://ror.org/2"], 0)
    other = tmp_path / "e.zip"
    with zipfile.ZipFile(other, "w") as book:
        book.writestr("a.JSON", json.dumps(documents))
    assert len(ids(other)[0]) == 2
    bad = tmp_path / "f.json"
    bad.write_text("3")
    assert ids(bad) == ([], 1)


def test_responses(spark):
    data = [
        (1, 200, '{"id": 7, "issn": "1;2"}'), (2, 200, '[{"codigo": "c"}, {"id": "dropped"}]'), (3, 200, "[]"), (4, 200, "oops"),
        (5, 404, '{"id": 9}'), (6, 200, "5"), (7, 200, '{"x": 1}'), (8, None, None), (9, 200, '{"id": 0}'),
    ]
    items = responses.response_items(spark.createDataFrame(data, "idx int, status int, body string"))
    assert rows(items.where("hit").select("idx")) == [(1,), (2,), (7,), (9,)]
    records = responses.journal_records(items)
    assert rows(records, "_id", "issns") == [("0", []), ("7", ["1", "2"]), ("7", []), ("c", [])]


def test_tables_and_registry(spark, namespace, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").write.saveAsTable(f"{namespace}.dspace_a_records")
    spark.createDataFrame([(2,)], "id int").write.saveAsTable(f"{namespace}.dspace_b_records")
    spark.range(3).write.saveAsTable(f"{namespace}.other")
    family = tables.family_scan(spark, namespace)
    assert rows(family, "id", "x", "table_name") == [(1, "a", "dspace_a_records"), (2, None, "dspace_b_records")]
    assert tables.family_scan(spark, namespace, "^nothing$") is None
    assert rows(tables.scan(spark, f"{namespace}.dspace_a_records", c("id") == 1, ["x"])) == [("a",)]
    registry = [{"endpoint": "e1", "enabled": True, "ror": "", "rate_limit": {"calls": 1, "secs": 2}}, {"endpoint": "e2", "enabled": False}]
    path = tmp_path / "registry.json"
    path.write_text("\n".join(map(json.dumps, registry)))
    enabled = tables.endpoint_registry(spark, str(path))
    assert rows(enabled, "endpoint", "rate_limit.secs") == [("e1", 2)]
    assert tables.endpoint_registry(spark, str(path), enabled_only=False).count() == 2


def test_file_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("12345")
    (tmp_path / "y.txt").write_text("1")
    assert rows(paths.file_listing(spark, str(tmp_path), "*.csv"), "name", "size") == [("x.csv", 5)]
    assert paths.exists(spark, str(tmp_path / "y.txt")) and not paths.exists(spark, str(tmp_path / "z"))


def test_source_modes():
    with pytest.raises(ValueError, match="mode"):
        Source("s", ("id",), "merge", lambda spark: None)


def test_scan_prunes_and_pushes_down(spark, testdata):
    from acervo.plans.search_projection import range_slice

    orders = spark.read.parquet(f"{testdata}/orders.parquet").select("o_orderkey", "o_totalprice")
    plan = range_slice(orders, "o_orderkey", 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,10)" in plan and "LessThan(o_orderkey,20)" in plan
    assert "o_custkey" not in plan


def test_wrapped_files_are_cut_once(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(json.dumps([{"id": n}, {"id": n + 10}]))
    (tmp_path / "bad.json").write_text("[{")
    good, rejects = wrapped.read_wrapped(spark, f"{tmp_path}/*.json")
    for file in tmp_path.glob("*.json"):
        file.write_text("[]")
    assert sorted(r.raw.toPython()["id"] for r in good.collect()) == [0, 1, 2, 10, 11, 12]
    assert [r.reason for r in rejects.collect()] == ["bad_json"]


def test_texts_become_files_of_their_own(spark, tmp_path):
    from acervo.catalogue.roundtrips import write_texts

    texts = ['{"id": 1}', '\n{"id":\n 2}', "[é]"]
    write_texts(spark.createDataFrame([(t,) for t in texts], "value string").repartition(2), f"{tmp_path}/shapes", "article_batch_9_", ".json")
    files = list((tmp_path / "shapes").glob("*"))
    assert sorted(f.read_text() for f in files) == sorted(f"{t}\n" for t in texts)
    assert all(f.name.startswith("article_batch_9_") and f.suffix == ".json" for f in files)
