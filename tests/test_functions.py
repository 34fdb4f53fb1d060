from __future__ import annotations

import json
from datetime import datetime
from hashlib import sha1

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acervo.functions import doi, entities, ids, names, nested, predicates, similarity, text

c = F.col


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("10.1234/ABC", "10.1234/abc"),
        ("doi:10.1234/abc", "10.1234/abc"),
        ("HTTP://dx.doi.org/10.1234/abc.", "10.1234/abc"),
        (" https://doi.org/10.1234/abc ", "10.1234/abc"),
        ("(see 10.1234/abc)", "10.1234/abc"),
        ("10.1016/S0140(05)x);", "10.1016/s0140(05)x)"),
        ("10.12/x", None),
        ("abc", None),
        ("", None),
        ("10.1234/...", None),
        (None, None),
    ],
)
def test_normalise_doi(spark, raw, wanted):
    assert one(spark, raw, doi.normalise_doi(c("v"))) == (wanted and f"https://doi.org/{wanted}")


def test_page_dois(spark):
    html = """<a href="https://doi.org/10.1234/AbC">10.1234/abc.</a> 10.99/no <i>10.5555/z</i>'"""
    assert one(spark, html, doi.doi_candidates(c("v"))) == ["10.1234/AbC", "10.1234/abc.", "10.5555/z"]
    assert one(spark, html, doi.page_dois(c("v"))) == ["https://doi.org/10.1234/abc", "https://doi.org/10.5555/z"]
    assert one(spark, "nothing", doi.page_dois(c("v"))) == []


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("  Ábaco. de Ñandú  ", "abaco de nandu"),
        ("Straße Œuvre Æther Łódź", "strasse oeuvre aether lodz"),
        ("é . ", "e "),
        ("PLAIN A.B.", "plain ab"),
        ("", ""),
    ],
)
def test_fold_text(spark, raw, wanted):
    assert one(spark, raw, text.fold_text(c("v"))) == wanted


def test_tokens(spark):
    assert one(spark, "La salud, de la SALUD-pública en 2024", text.tokens(c("v"))) == ["la", "salud", "de", "publica", "en", "2024"]
    assert one(spark, "AI in 5G", text.tokens(c("v"))) == ["ai", "in", "5g"]
    assert one(spark, "物理", text.tokens(c("v"))) == ["物理"]


def test_greek_and_cyrillic_are_spelled_in_latin(spark):
    assert one(spark, "Щука и Ёж", text.fold_text(c("v"))) == "shchuka i ezh"
    assert one(spark, "Ψυχή ΘΕΟΣ", text.fold_text(c("v"))) == "psukhe theos"
    assert one(spark, "Año 物理", text.fold_text(c("v"))) == "ano 物理"


def test_entities_equal_the_standard_decoder(spark):
    import html
    import random
    from html.entities import html5

    rng = random.Random(3)
    names = list(html5)
    numbers = [0, 1, 9, 10, 11, 13, 31, 38, 65, 127, 128, 129, 150, 159, 160, 233, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**12]
    atoms = ["&", "&&", "&#", "&#;", "&#x;", "& ", "&;", "x", "é ", "&bogus;", "&ampfoo", "&notit;", "&amp;lt;", "&#38;lt;", "&#000065;", "&" + "z" * 40 + ";", "&lt", "\n"]
    atoms += [f"&#{n};" for n in numbers] + [f"&#x{n:X}" for n in numbers] + [f"&#X{n:x};" for n in numbers]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    texts += [f"a&{n}b" for n in names] + atoms + ["", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    wrong = [(r[0], r[1], html.unescape(r[0])) for r in df.select("v", entities.decode_entities(c("v"))).collect() if r[1] != html.unescape(r[0])]
    assert not wrong, wrong[:10]


def test_strip_markup(spark):
    title = "The <b>mass</b> <math><mi>m</mi><annotation>m</annotation></math> &lt; 3 &amp;amp; <!-- x --><script>1<2</script>&eacute;"
    assert one(spark, title, text.strip_markup(c("v"))) == "The mass m < 3 &amp; é"
    assert one(spark, "a < b > c", text.strip_markup(c("v"))) == "a < b > c"


@pytest.mark.parametrize(
    "name, wanted",
    [("año 2024 (final).xlsx", "año_2024_final_.xlsx"), ("ok-name.csv", "ok-name.csv"), ("a/b\\c", "a_b_c")],
)
def test_safe_file_name(spark, name, wanted):
    assert one(spark, name, text.safe_file_name(c("v"))) == wanted


@pytest.mark.parametrize(
    "path, base, stem, ext",
    [
        ("/a/b/file.tar.GZ", "file.tar.GZ", "file.tar", "gz"),
        ("plain", "plain", "plain", ""),
        ("/x/.hidden", ".hidden", ".hidden", ""),
    ],
)
def test_path_parts(spark, path, base, stem, ext):
    v = c("v")
    got = one(spark, path, F.array(text.base_name(v), text.file_stem(v), text.file_extension(v)))
    assert got == [base, stem, ext]


def test_split_list(spark):
    assert one(spark, " 1234-5678,;  9 |/\\ x ", text.split_list(c("v"))) == ["1234-5678", "9", "x"]


@pytest.mark.parametrize(
    "word, default, wanted",
    [
        (" Yes ", False, True), ("1", False, True), ("t", False, True), ("N", True, False), ("0", True, False),
        ("maybe", False, True), ("", True, False), ("  ", False, True), (None, True, True), (None, False, False),
    ],
)
def test_parse_bool(spark, word, default, wanted):
    assert one(spark, word, text.parse_bool(c("v"), default)) is wanted


@pytest.mark.parametrize(
    "folder, wanted",
    [
        ("03bp5hc83_Universidad_de_Antioquia", ["03bp5hc83", "Universidad_de_Antioquia"]),
        ("BadFormatName", [None, "BadFormatName"]),
        (" id _ name ", ["id", "name"]),
    ],
)
def test_folder_names(spark, folder, wanted):
    v = c("v")
    assert one(spark, folder, F.array(names.folder_institution(v), names.folder_label(v))) == wanted


@pytest.mark.parametrize(
    "file, ror, raw, date",
    [
        ("ciarp_006jxzx88_27_01_2026_14:41.xlsx", "006jxzx88", "27_01_2026_14:41", datetime(2026, 1, 27, 14, 41)),
        ("CIARP_006jxzx88_2026-01-28_10:06_v2.xlsx", "006jxzx88", "2026-01-28_10:06", datetime(2026, 1, 28, 10, 6)),
        ("ciarp_x_45_13_2026_10:06.xlsx", "x", "45_13_2026_10:06", None),
        ("bad_name.xlsx", None, None, None),
    ],
)
def test_matrix_names(spark, file, ror, raw, date):
    v = c("v")
    got = one(spark, file, F.struct(names.matrix_institution(v), names.matrix_date_text(v), names.matrix_date(v)))
    assert tuple(got) == (ror, raw, date)


def test_periods_and_stamps(spark):
    v = c("v").cast("timestamp_ntz")
    day = "2026-06-30 01:02:03"
    assert one(spark, day, names.period_name("doaj", v)) == "doaj_2026_1"
    assert one(spark, "2026-07-01 00:00:00", names.semester(v).cast("string")) == "2"
    assert one(spark, day, F.array(names.stamp(v), names.month_stamp(v), names.iso_stamp(v))) == [
        "20260630_010203", "202606", "2026-06-30T01:02:03",
    ]


@pytest.mark.parametrize(
    "doc, wanted",
    [
        ({"issn": "1234-5678, 1234-5678;8765-4321"}, ["1234-5678", "8765-4321"]),
        ({"issns": [], "issn": ["a", " a ", "", 5, None]}, ["a"]),
        ({"issnPrint": [{"value": " ", "issn": "x"}, {"codigo": 7, "id": "y"}, {}]}, ["x", "y"]),
        ({"issn_print": 12345678}, ["12345678"]),
        ({"issns": None, "issn": ""}, []),
        ({}, []),
    ],
)
def test_issn_list(spark, doc, wanted):
    assert one(spark, json.dumps(doc), nested.issn_list(F.parse_json("v"))) == wanted


@pytest.mark.parametrize(
    "value, wanted",
    [(None, False), ("", False), ("0", True), (0, False), (0.0, False), (1, True), (False, False), (True, True),
     ([], False), ({}, False), ([0], True), ({"a": 1}, True), ("false", True)],
)
def test_truthy_follows_the_json_type(spark, value, wanted):
    got = one(spark, json.dumps({"a": value}), nested.truthy(nested.at(F.parse_json("v"), "$.a", "variant")))
    assert got is wanted


def test_merge_objects_keeps_absent_and_takes_null(spark):
    df = spark.createDataFrame([('{"id":"a","x":1,"y":2}', '{"id":"a","x":null,"z":[1]}')], "a string, b string")
    merged = df.select(F.to_json(nested.merge_objects(F.parse_json("a"), F.parse_json("b"))).alias("m")).first()["m"]
    assert json.loads(merged) == {"id": "a", "x": None, "y": 2, "z": [1]}


def test_canonical_sha1_equals_sorted_ascii_json(spark):
    record = {"b": "ñ", "a": [1, {"z": None, "y": 1.5}]}
    expected = sha1(json.dumps(record, sort_keys=True).encode()).hexdigest()
    assert one(spark, json.dumps(record, ensure_ascii=False), ids.canonical_sha1(c("v"))) == expected


@pytest.mark.parametrize(
    "checksum, size, wanted",
    [("sha256:GOOD", None, True), ("GOOD", 99, True), ("md5:0", 3, False), (None, 3, True), ("", 3, True), (None, 4, False), (None, None, False)],
)
def test_content_matches(spark, checksum, size, wanted):
    good = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    checksum = checksum and checksum.replace("GOOD", good)
    df = spark.createDataFrame([(b"abc", checksum, size)], "c binary, k string, s long")
    assert df.select(ids.content_matches(c("c"), c("k"), c("s")).alias("x")).first()["x"] is wanted


def test_country_predicate_is_null_safe(spark):
    schema = "id int, a array<struct<countries:array<string>,institutions:array<struct<country_code:string>>>>"
    data = [
        (1, [(["US", "CO"], None)]), (2, [(None, [("CO",)])]), (3, [(["US"], [(None,)]), (None, None)]), (4, None), (5, []),
        (6, [(["US", None], [("US",)])]), (7, [(None, None), (["CO"], [])]),
    ]
    df = spark.createDataFrame(data, schema)
    assert rows(df.where(predicates.in_country(c("a"), "CO")).select("id")) == [(1,), (2,), (7,)]
    assert rows(df.where(~predicates.in_country(c("a"), "CO")).select("id")) == [(3,), (4,), (5,), (6,)]


def test_small_predicates(spark):
    df = spark.createDataFrame([("10", 1), ("4.9", 2), ("x", 3), (None, 4), ("NaN", 5), ("1e3", 6)], "v string, i int")
    assert rows(df.select("i", predicates.long_or_zero(c("v")))) == [(1, 10), (2, 4), (3, 0), (4, 0), (5, 0), (6, 1000)]
    ranged = df.where(predicates.key_between(c("i"), 2, 4)).select("i")
    assert rows(ranged) == [(2,), (3,)]
    assert df.where(predicates.key_between(c("i"), "", None)).count() == 6


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


short = st.text(alphabet="abcñ ", max_size=24)


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(short, short)
def test_scores_equal_brute_force(a, b):
    assert similarity.lcs_length(a, b) == brute_lcs(a, b)
    small, large = sorted((a, b), key=len)
    n = len(small)
    windows = [100.0 * brute_lcs(small, large[i : i + n]) / n for i in range(len(large) - n + 1)] if n else [0.0]
    assert similarity._partial(a, b) == pytest.approx(max(windows))
    full, floored = similarity.title_score(a, b), similarity.title_score(a, b, 80)
    assert floored == full if full >= 80 else floored < 80


def test_title_scores():
    assert similarity.title_score("el estudio de la salud", "el estudio de la salud") == 100
    assert similarity.title_score("salud de la estudio el", "el estudio de la salud") == 95
    assert similarity.title_score("estudio salud", "estudio salud publica en colombia hoy") == 95
    assert similarity.title_score("", "x") == 0
    assert similarity.author_score("perez juan", "juan perez") < 65 <= similarity.author_score("perez", "juan perez")


def test_accept_rule(spark):
    df = spark.createDataFrame([(90, 65), (90, 64), (94, 0), (93, 64), (89, 100), (None, 100)], "t int, a int")
    got = [r[0] for r in df.select(similarity.accepted(c("t"), c("a"))).collect()]
    assert got == [True, False, True, False, False, False]
