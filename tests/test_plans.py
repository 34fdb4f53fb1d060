from __future__ import annotations

import importlib.util
import json
from datetime import datetime

import pytest
from conftest import rows
from files import write_workbook
from pyspark.sql import functions as F

from acervo.operators import merge
from acervo.operators.joins import id_bitmaps, loaded, possible, spread_join
from acervo.operators.stats import outcome_counts
from acervo.plans import country_cut, institutional, journal_ranking, journals, search_projection
from acervo.session import materialise
from acervo.sinks.catalog import upsert_table
from acervo.sources.batches import read_json_batches
from acervo.sources.workbook import read_workbooks, workbook_columns
from test_sources import RANKING, ranking_row

c = F.col
RUN = datetime(2026, 1, 27, 14, 41, 5)

WORK_SCHEMA = """
    _id string, id string, doi string, title string, publication_year int,
    authorships array<struct<author:struct<id:string,display_name:string>,countries:array<string>,institutions:array<struct<country_code:string>>>>,
    locations array<struct<source:struct<id:string>>>,
    primary_location struct<source:struct<display_name:string>>,
    biblio struct<volume:string,issue:string,first_page:string,last_page:string>
"""


def work(n, doi=None, title="t", author=None, country=None, sources=()):
    authorships = [((author, author and f"Name {author}"), [country] if country else [], [])] if author or country else None
    return (f"oid{n}", f"W{n}", doi, title, 2020, authorships, [((s,),) for s in sources], None, None)


@pytest.fixture
def works(spark):
    d = "https://doi.org/"
    long_title = "Efectos de la educación rural en los municipios del Caribe colombiano"
    return spark.createDataFrame(
        [
            work(1, d + "10.1000/a", author="A1", country="CO"),
            work(2, None, author="A2", country="US", sources=["S1"]),
            work(3, d + "10.1000/c", author="A3"),
            work(4, d + "10.1000/d", author="A4"),
            work(5, None, title=long_title, author="A5"),
            work(6, d + "10.1000/a", author="A6"),
            work(7, None, author="A7", sources=["S2"]),
            work(1, d + "10.1000/a", author="A1", country="CO"),
            work(8, None, title="Otro tema completamente distinto sobre química", author="A8"),
        ],
        WORK_SCHEMA,
    )


def products(spark):
    return spark.createDataFrame(
        [
            ("p1", "Efectos de la educacion rural en los municipios del caribe colombiano.", "x", "Artículos"),
            ("p2", "Corto", None, "Libros"),
        ],
        "product_key string, title string, person_id string, product_type string",
    )


def test_country_cut_end_to_end(spark, works, namespace):
    out = f"{namespace}_co"
    works.write.saveAsTable(f"{namespace}.works")
    spark.createDataFrame([("S1", "CO"), ("S2", "US"), ("", "CO"), (None, "CO")], "id string, country_code string").write.saveAsTable(f"{namespace}.sources")
    spark.createDataFrame([(f"A{i}",) for i in range(1, 9)] + [("A99",)], "id string").write.saveAsTable(f"{namespace}.authors")
    spark.range(2).write.saveAsTable(f"{namespace}.topics")
    inputs = country_cut.DoiInputs(
        scholar=spark.createDataFrame([("10.1000/C",), ("",), (None,), ("bad",)], "doi string"),
        wos=spark.createDataFrame([("DOI:10.1000/a",), (None,)], "DI string"),
        profiles=spark.createDataFrame([("<a href='https://doi.org/10.1000/D'>x</a>",)], "html string"),
    )
    search = search_projection.search_documents(works)
    profiles = spark.createDataFrame([("x", "Name A5")], "person_id string, name string")

    def run():
        country_cut.run_cut(spark, namespace, out, "CO", inputs, products(spark), profiles, search)
        return rows(spark.table(f"{out}.works"), "id", "routes"), rows(spark.table(f"{out}.authors"))

    first = run()
    assert first[0] == [
        ("W1", ["authorship"]), ("W2", ["source"]), ("W3", ["doi"]), ("W4", ["doi"]), ("W5", ["similarity"]),
    ]
    assert first[1] == [("A1",), ("A2",), ("A3",), ("A4",), ("A5",)]
    assert "_id" not in spark.table(f"{out}.works").columns
    assert spark.table(f"{out}.topics").count() == 2
    assert run() == first
    spark.sql(f"DROP DATABASE {out} CASCADE")


def test_unique_works_of_any_schema(spark):
    df = spark.createDataFrame([("a", '{"x": 1}'), ("a", '{"x": 2}'), ("b", None)], "id string, t string")
    works = df.select("id", F.parse_json("t").alias("raw"), F.create_map("id", "t").alias("m"))
    first = rows(country_cut.unique_works(works).select("id", F.to_json("raw")))
    assert [r[0] for r in first] == ["a", "b"]
    assert rows(country_cut.unique_works(works.repartition(3)).select("id", F.to_json("raw"))) == first


def test_all_doi_sources(spark):
    field = "array<struct<element:string,qualifier:string,text:string>>"
    inputs = country_cut.DoiInputs(
        scholar=spark.createDataFrame([("10.1000/s1",), ("",), (None,)], "doi string"),
        products=spark.createDataFrame([("10.1000/p1",), ("",), (None,)], "TXT_DOI string"),
        scopus=spark.createDataFrame([("10.1000/sc1",), ("",), (None,)], "DOI string"),
        wos=spark.createDataFrame([("10.1000/w1",), ("",), (None,)], "DI string"),
        repositories=spark.createDataFrame([([("identifier", "doi", "10.1000/r1"), ("identifier", "uri", "10.1000/no"), ("identifier", "doi", None)],), (None,)], f"fields {field}"),
        matrices=spark.createDataFrame([("10.1000/m1",), (None,)], "doi string"),
        profiles=spark.createDataFrame([("10.1000/h1 10.1000/h2",), ("none",)], "html string"),
    )
    raw = country_cut.raw_dois(inputs)
    counts = {r["source"]: r["n"] for r in raw.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"scholar": 2, "products": 1, "scopus": 2, "wos": 1, "repositories": 1, "matrices": 1, "profiles": 2}
    assert country_cut.wanted_dois(raw).count() == 8
    with pytest.raises(ValueError):
        country_cut.raw_dois(country_cut.DoiInputs())


def test_similarity_takes_the_first_accepted(spark):
    search = spark.createDataFrame(
        [
            ("w1", "Educación rural en el Caribe colombiano: una mirada", ["Ana Gómez"]),
            ("w2", "Educacion rural en el Caribe colombiano", ["Juan Pérez", None]),
            ("w3", "EDUCACIÓN RURAL EN EL CARIBE COLOMBIANO.", []),
            ("w4", "Física de partículas", None),
        ],
        "id string, title string, authors array<string>",
    )
    asked = spark.createDataFrame(
        [(1, "Educación rural en el Caribe colombiano", "p"), (2, "Física de partículas", "p"), (3, "Física de partículas", None), (4, None, "p"), (5, "La", "p")],
        "product_key int, title string, person_id string",
    )
    people = spark.createDataFrame([("p", "Gómez")], "person_id string, name string")
    pairs = country_cut.similar_pairs(asked, people, search)
    best = country_cut.first_accepted(pairs)
    # 3 is short and has no author; 4 has no title; 5 has no token of three letters
    assert rows(best, "product_key", "id") == [(1, "w2"), (2, "w4")]
    assert rows(country_cut.similar_route(asked, people, search)) == [("w2", "similarity"), ("w4", "similarity")]


def test_products_with_sentinel(spark):
    data = [("1", "a", "Libros"), ("1", "b", "Libros"), ("0000000000", "c", "Libros"), ("0000000000", "c", "Libros"), ("2", None, "Libros"), ("3", "d", "Otros"), (None, "e", "Libros")]
    df = spark.createDataFrame(data, "product_id string, title string, product_type string")
    got = rows(country_cut.bibliographic_products(df), "product_id", "title")
    assert got == sorted([("1", "a"), ("0000000000", "c"), ("0000000000", "c"), (None, "e")], key=repr)


def test_search_projection_and_ranges(spark, works, tmp_path):
    extra = spark.createDataFrame(
        [("o", "W9", None, "A <i>b</i>", None, [(("A", "N"), None, None), ((None, None), None, None), (None, None, None)], None, (("J",),), ("1", None, "3", None)), ("o2", "W10", None, None, 2000, None, None, None, None)],
        WORK_SCHEMA,
    )
    got = search_projection.search_documents(extra)
    assert [r.asDict() for r in got.collect()] == [
        {"id": "W9", "title": "A b", "source": "J", "year": "", "volume": "1", "issue": "", "first_page": "3", "last_page": "", "authors": ["N"]}
    ]
    assert search_projection.untitled(extra).first()[0] == 1
    path = str(tmp_path / "search")
    for _ in range(2):
        search_projection.write_search_table(works, path, 3)
    assert spark.read.parquet(path).count() == works.count()


def test_journal_ranking_year(spark, namespace, tmp_path):
    table, checks = f"{namespace}.ranking", f"{namespace}.etl_checkpoints"
    path = tmp_path / "r.csv"

    def load(year, *lines):
        path.write_text(RANKING + "".join(lines))
        return journal_ranking.load_year(spark, str(path), table, checks, year, RUN)

    assert load(2022, ranking_row(1, 12345, "Other Year")) == {"insert": 1, "check": "match", "rejects": 0}
    assert load(2023, ranking_row(2, 12345, "Old Title"))["insert"] == 1
    new = [ranking_row(1, 12345, "New Title"), ranking_row(2, 67890, "Brand New Journal"), ranking_row(9, "bad", "x")]
    assert load(2023, *new) == {"update": 1, "insert": 1, "check": "match", "rejects": 1}
    state = rows(spark.table(table), "Sourceid", "year", "Title")
    assert state == [(12345, 2022, "Other Year"), (12345, 2023, "New Title"), (67890, 2023, "Brand New Journal")]
    assert load(2023, *new) == {"unchanged": 2, "rejects": 1}
    assert rows(spark.table(table), "Sourceid", "year", "Title") == state
    assert load(2024) is None


LISTING = "folder_id string, id string, name string, mime_type string, trashed boolean, modified_time string, size string, position int"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"


def test_institutional_run(spark, tmp_path):
    # landed under the file id and a safe name; the listing keeps the real one
    write_workbook(tmp_path / "d1__ciarp_006jxzx88_27_01_2026_14_41.xlsx", {"S": [["col_a", "col_b"], ["a0", "b0"], ["a1", None], ["a2", "b2"]]})
    folders = spark.createDataFrame(
        [("f1", "006jxzx88_Universidad Uno"), ("f2", "BadFormatName"), ("f3", "03x_Dos"), ("f4", "04x_Tres"), ("f5", "05x_Cuatro"), ("f6", "06x_Vacía")],
        "id string, name string",
    )
    name = "ciarp_006jxzx88_27_01_2026_14:41.xlsx"
    listing = spark.createDataFrame(
        [
            ("f1", "d0", "ciarp_006jxzx88_2026-01-01_10:00.xlsx", XLSX, False, "2026-01-01", "1", 0),
            ("f1", "d1", name, XLSX, False, "2026-01-27", "10", 1),
            ("f1", "d2", "Original.xlsx", XLSX, False, "2026-02-01", "1", 2),
            ("f1", "d3", "x.pdf", "application/pdf", False, "2026-02-01", "1", 3),
            ("f1", "d4", "x.xlsx", XLSX, True, "2026-02-01", "1", 4),
            ("f2", "d5", "x.xlsx", XLSX, False, "2026-02-01", "1", 0),
            ("f4", "d6", "x.xlsx", XLSX, False, "2026-02-01", "1", 0),
            ("f5", "d7", "x.xlsx", XLSX, False, "2026-02-01", "1", 0),
            ("f6", "d8", "x.xlsx", XLSX, False, None, "1", 0),
        ],
        LISTING,
    )
    stored = spark.createDataFrame(
        [("006jxzx88:d0:0", "006jxzx88", "d0", "2026-01-01"), ("006jxzx88:d0:1", "006jxzx88", "d0", "2026-01-01"), ("04x:d6:0", "04x", "d6", "2026-02-01"), ("06x:old:0", "06x", "old", "1")],
        "_id string, institution_id string, drive_file_id string, drive_modified_time string",
    )
    readable = spark.createDataFrame([("d1",), ("d8",)], "drive_file_id string")
    planned = institutional.plan_run(institutional.latest_files(folders, listing), stored, readable).cache()
    assert {r["drive_folder_id"]: r["outcome"] for r in planned.collect()} == {
        "f1": "processed", "f2": "skipped", "f3": "empty", "f4": "skipped", "f5": "errors", "f6": "processed",
    }
    assert rows(outcome_counts(planned, "outcome")) == [(6, 2, 2, 1, 1)]
    cells, _ = read_workbooks(spark, str(tmp_path))
    sheet = workbook_columns(cells, ["col_a", "col_b"]).drop("file_path").withColumn("drive_file_id", F.lit("d1"))
    fresh = institutional.matrix_rows(planned, sheet, RUN, dated=True)
    assert rows(fresh, "_id", "institution_name", "row_number", "col_b", "ciarp_file_date", "ciarp_file_date_raw") == [
        (f"006jxzx88:d1:{i}", "Universidad Uno", i, b, "2026-01-27T14:41:00", "27_01_2026_14:41") for i, b in enumerate(["b0", None, "b2"])
    ]
    state = institutional.next_state(stored, planned, fresh)
    assert rows(state, "_id") == [("006jxzx88:d1:0",), ("006jxzx88:d1:1",), ("006jxzx88:d1:2",), ("04x:d6:0",)]
    assert rows(institutional.next_state(state, planned, fresh)) == rows(state)
    kept = institutional.next_state(stored, planned, fresh, keep_only_latest=False)
    assert kept.count() == 7
    again = institutional.plan_run(institutional.latest_files(folders, listing), state, readable)
    assert again.where("drive_folder_id = 'f1'").first()["outcome"] == "skipped"
    forced = institutional.plan_run(institutional.latest_files(folders, listing), state, readable, force=True)
    assert forced.where("drive_folder_id = 'f1'").first()["outcome"] == "processed"
    probe = spark.createDataFrame([("006jxzx88", "d1", "2026-01-27"), ("006jxzx88", "d1", "2026-01-28")], ", ".join(f"{k} string" for k in institutional.PROBE))
    assert loaded(probe, state, institutional.PROBE).count() == 1


def derive(spark, record_type, *records):
    df = spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(records)], "t string, position int")
    derived = journals.derive_fields(df.select(F.parse_json("t").alias("raw"), "position"), record_type)
    return derived.orderBy("position").drop("raw", "subjects").collect()


def test_journal_derived_fields(spark):
    article = {"id": "abc123", "bibjson": {"identifier": [{"type": "doi", "id": "10.1234/ABC"}], "publisher": "P", "year": 2024}}
    rows_ = derive(
        spark, "article", article,
        {"id": "x", "bibjson": {"identifier": {"type": "DOI", "value": " 10.1/Z "}}, "publisher": "outer", "year": "1999"},
        {"_id": "y", "bibjson": {"identifier": ["text", {"type": "doi", "id": ""}, {"type": "eissn", "id": "1"}], "publisher": ""}},
        {"title": "nothing"},
    )
    assert (rows_[0]["source_id"], rows_[0]["doi"], rows_[0]["doaj_id"], rows_[0]["year"]) == ("doi:10.1234/abc", "10.1234/ABC", "abc123", "2024")
    assert (rows_[1]["source_id"], rows_[1]["doi"], rows_[1]["publisher"], rows_[1]["year"]) == ("doi:10.1/z", "10.1/Z", "outer", "1999")
    assert (rows_[2]["source_id"], rows_[2]["doi"], rows_[2]["publisher"]) == ("doaj:y", None, None)
    assert rows_[3]["source_id"].startswith("hash:") and len(rows_[3]["source_id"]) == 45
    journal = derive(
        spark, "journal", {"id": "journal-001", "bibjson": {"pissn": "1234-5678"}},
        {"bibjson": {"pissn": "1", "eissn": "", "issn": ["2", "", None]}}, {"bibjson": {"issn": "3"}}, {"bibjson": {"issn": []}},
    )
    assert [r["source_id"] for r in journal[:3]] == ["doaj:journal-001", "issn:1|2", "issn:3"]
    assert journal[3]["source_id"].startswith("hash:") and journal[3]["issn"] is None


def test_journal_upsert(spark, tmp_path, namespace):
    def identifier(doi):
        return {"bibjson": {"identifier": [{"type": "doi", "id": doi}], "subject": [{"term": "x"}]}}

    path = tmp_path / "article_batch_1.json"
    path.write_text("\n".join(map(json.dumps, [identifier("10.1/a"), identifier("10.1/B")])))

    def load(at):
        records, _ = read_json_batches(spark, str(tmp_path), "article")
        incoming = journals.upsert_rows(journals.derive_fields(records, "article"), F.lit(at))
        upsert_table(incoming.drop("raw", "subjects"), f"{namespace}.articles", ["source_id"], insert_only=["created_at"])
        return rows(spark.table(f"{namespace}.articles"), "source_id", "created_at", "updated_at")

    assert load("t0") == [("doi:10.1/a", "t0", "t0"), ("doi:10.1/b", "t0", "t0")]
    assert load("t1") == [("doi:10.1/a", "t0", "t1"), ("doi:10.1/b", "t0", "t1")]
    assert merge.diff_summary(merge.diff(spark.table(f"{namespace}.articles"), spark.table(f"{namespace}.articles"), ["source_id"])).collect()[0]["action"] == "unchanged"


def test_registered_queries_have_unique_contracts():
    from __spark_entry__ import oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())
    own = {name for name in queries() if name != "pipeline" and not name.startswith("op")}
    assert own - set(oracle_sql()) == set()


def test_entry(spark, testdata):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


@pytest.mark.parametrize("missing", [{"acervo.llm"}, {"corpus_pipeline"}, {"acervo.llm", "corpus_pipeline"}])
def test_queries_without_the_optional_parts(monkeypatch, missing):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *rest: None if name in missing else find(name, *rest))
    from __spark_entry__ import queries

    names = set(queries())
    assert {"cut_union_routes", "fuzzy_title_match"} <= names and "pipeline" not in names
    assert any(n.startswith("op1_") for n in names) == ("acervo.llm" not in missing and find("acervo.llm") is not None)


def test_only_works_that_may_be_wanted_reach_the_exchange(spark):
    works = spark.range(50_000).select(F.concat(F.lit("W"), "id").alias("id"), F.lit("x").alias("title"))
    wanted = works.where("crc32(id) % 500 = 0").select("id")
    bitmaps = materialise(id_bitmaps(wanted, "id"), "bitmaps")
    some = possible(works, "id", bitmaps)
    found = {r.id for r in some.collect()}
    assert {r.id for r in wanted.collect()} <= found and len(found) < 130
    # the bits are sent to the tasks that scan the works, whatever the size of these; no work moves before it is tested
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "shiftright" in plan
    kept = {r.id for r in spread_join(some, wanted, "id").collect()}
    assert kept == {r.id for r in wanted.collect()}
    assert possible(works, "id", materialise(id_bitmaps(wanted.limit(0), "id"), "bitmaps")).count() == 0


def test_only_products_without_an_accepted_best_candidate_are_looked_for_again(spark, monkeypatch):
    same = [(f"w{n}", "Historia rural del Caribe colombiano", ["Ana Gómez"]) for n in range(3)]
    # more shared tokens, but another title; the accepted one ranks second
    longer = [("v1", "Atlas general de física: partículas, ondas, campos, materia y otros asuntos vecinos de partículas", ["Luis Ruiz"]), ("v2", "Atlas general física partículas ondas campos", [])]
    search = spark.createDataFrame([*same, *longer, ("u", "Otra cosa", None)], "id string, title string, authors array<string>")
    products = spark.createDataFrame(
        [(1, "Historia rural del Caribe colombiano", "p"), (2, "Atlas general física partículas ondas campos", "q"), (3, "Nada parecido aquí", "p")], "product_key int, title string, person_id string"
    )
    people = spark.createDataFrame([("p", "Gómez"), ("q", "Ruiz")], "person_id string, name string")
    asked, real = [], country_cut.similar_pairs

    def counted(products, profiles, search, k=20):
        asked.append((k, rows(products, "product_key")))
        return real(products, profiles, search, k)

    want = rows(country_cut.first_accepted(real(products, people, search)))
    monkeypatch.setattr(country_cut, "similar_pairs", counted)
    got = rows(country_cut.best_matches(products, people, search))
    assert got == want and {r[0]: r[2] for r in got} == {1: 1, 2: 2}
    assert asked == [(1, [(1,), (2,), (3,)]), (20, [(2,), (3,)])]


def test_search_table_has_as_many_ranges_as_its_size_needs(spark, tmp_path, monkeypatch):
    titles = [("o", f"W{n:02d}", None, "x" * 1000, None, None, None, None, None) for n in range(40)]
    frame = spark.createDataFrame(titles, WORK_SCHEMA)
    monkeypatch.setattr(search_projection, "RANGE_BYTES", 4000, raising=False)
    search_projection.write_search_table(frame, f"{tmp_path}/t", 2)
    written = spark.read.parquet(f"{tmp_path}/t").select("id", F.input_file_name().alias("file"))
    spans = sorted(tuple(r) for r in written.groupBy("file").agg(F.min("id"), F.max("id")).drop("file").collect())
    assert len(spans) >= 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)) and written.count() == 40
