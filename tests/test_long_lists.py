from __future__ import annotations

import json
import os
import random

import pytest

from acervo.sources.long_lists import read_long_lists
from acervo.sources.wrapped import read_wrapped

BITS = ["}", "{", '"', "\\", "a", "]", "[", ",", "é", " ", "\n", "items"]


def value(rng, deep=0):
    kind = rng.randrange(6 if deep < 3 else 3)
    if kind == 0:
        return rng.randrange(100)
    if kind < 3:
        return "".join(rng.choices(BITS, k=rng.randrange(8)))
    if kind == 3:
        return [value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return {"".join(rng.choices(BITS, k=3)): value(rng, deep + 1) for _ in range(rng.randrange(3))}


@pytest.fixture
def narrow(spark):
    """Splits so short that strings, escapes and records run over many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_long_lists_equal_the_sequential_reader(spark, narrow, tmp_path):
    rng = random.Random(1)
    wanted = {}
    for i in range(10):
        items = [value(rng) if rng.random() < 0.3 else {"id": j, "v": value(rng)} for j in range(rng.randrange(12))]
        body = json.dumps(items, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        more = rng.choice(["}\n", "}", ', "more": {"a": [1, {"b": 2}], "c": {"d": {"e": {}}}}}'])
        text = body if i % 2 else '{"n": 3, "s": "it[ems", "items": ' + body + more
        (tmp_path / f"f{i}.json").write_text(("﻿" if i == 5 else "") + text, encoding="utf-8")
        wanted[f"f{i}.json"] = items
    good, rejects = read_long_lists(spark, str(tmp_path))
    found: dict[str, list] = {}
    for r in good.selectExpr("file_path", "record", "within", "to_json(raw) AS j").orderBy("file_path", "record", "within").collect():
        found.setdefault(os.path.basename(r.file_path), []).append(json.loads(r.j))
    assert found == {k: v for k, v in wanted.items() if v} and rejects.count() == 0
    plain, _ = read_wrapped(spark, str(tmp_path / "*.json"))
    assert sorted(r.j for r in plain.selectExpr("to_json(raw) AS j").collect()) == sorted(r.j for r in good.selectExpr("to_json(raw) AS j").collect())


def test_long_lists_name_what_is_damaged(spark, narrow, tmp_path):
    files = {"cut.json": '[{"a":1}, {"b": "x]', "open.json": '[{"a":1}, {"b": 2}', "value.json": '[{"a":1}, {"b": nope}, 3]', "one.json": '{"a": {"b": 1}}', "empty.json": "[]"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, rejects = read_long_lists(spark, str(tmp_path))
    assert sorted((os.path.basename(r.file_path), r.reason) for r in rejects.collect()) == [
        ("cut.json", "bad_json"), ("one.json", "other_shape"), ("open.json", "bad_json"), ("value.json", "bad_record"),
    ]
    assert sorted(r.j for r in good.selectExpr("to_json(raw) AS j").collect()) == ["3", '{"a":1}']


def test_a_file_is_read_by_many_tasks(spark, narrow, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps([{"id": i, "text": "}" * (i % 7)} for i in range(400)]))
    from acervo.sources.long_lists import pieces_of

    cuts = pieces_of(spark, str(tmp_path))
    assert cuts.select("split").distinct().count() > 50
    assert read_long_lists(spark, str(tmp_path))[0].count() == 400
