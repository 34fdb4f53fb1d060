from __future__ import annotations

import functools
import itertools
import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from files import write_part
from pyspark.sql import functions as F

from acervo.plans.organisations import load_organisations
from acervo.plans.runner import run_sources
from acervo.session import materialise, on_one_machine, scratch_run, shared_folder
from acervo.sinks import catalog, checkpoints
from acervo.sinks import documents as documents_sink
from acervo.sinks.documents import compact_documents, settled_versions, stored_documents, upsert_documents
from acervo.sources.base import Source
from acervo.sources.tables import table_names
from acervo.streaming.incremental import load_snapshot, load_totals, reset_snapshot

c = F.col
RUN = datetime(2026, 1, 27, 14, 41, 5)


def twice(action, state):
    """Run an action twice; the table is the same after both."""
    action()
    first = state()
    action()
    assert state() == first
    return first


def test_materialise_uses_the_shared_folder(spark):
    df = materialise(spark.range(5).withColumn("p", F.spark_partition_id()), "test")
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert df.count() == 5


def test_scratch_goes_when_a_run_ends_well(spark):
    with scratch_run(spark):
        kept = materialise(spark.range(5), "inner").inputFiles()
        assert all(Path(f.removeprefix("file://")).exists() for f in kept)
    assert not any(Path(f.removeprefix("file://")).exists() for f in kept)
    with pytest.raises(ValueError), scratch_run(spark):
        left = materialise(spark.range(5), "failed").inputFiles()
        raise ValueError
    assert all(Path(f.removeprefix("file://")).exists() for f in left)


def test_no_machine_local_folder_on_a_cluster():
    assert on_one_machine("local") and on_one_machine("local[4]") and on_one_machine("local[*]")
    assert not on_one_machine("local-cluster[3,2,1024]") and not on_one_machine("yarn") and not on_one_machine("spark://h:7077")

    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(Fake)


def test_truncate_append_swap(spark, namespace):
    table = f"{namespace}.t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    state = lambda: rows(spark.table(table))
    assert twice(lambda: catalog.truncate_and_load(df, table), state) == [(1, "a"), (2, "b")]
    catalog.append_load(df.where("id = 1"), table)
    assert len(state()) == 3
    swapped = twice(lambda: catalog.build_then_swap(spark.table(table).distinct(), table), state)
    assert swapped == [(1, "a"), (2, "b")]
    # what an interrupted swap leaves behind does no harm
    spark.range(1).write.saveAsTable(f"{table}__building")
    catalog.build_then_swap(spark.table(table), table)
    assert state() == swapped and table_names(spark, namespace) == ["t"]


def test_keyed_tables(spark, namespace):
    table = f"{namespace}.t"
    state = lambda: rows(spark.table(table), "id", "v")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    catalog.upsert_table(one, table, ["id"])
    assert twice(lambda: catalog.upsert_table(two, table, ["id"]), state) == [(1, "a"), (2, "B"), (3, "C")]
    assert twice(lambda: catalog.keep_existing_table(one.unionByName(spark.createDataFrame([(9, "z")], "id int, v string")), table, ["id"]), state) == [
        (1, "a"), (2, "B"), (3, "C"), (9, "z"),
    ]
    assert twice(lambda: catalog.replace_rows_table(one, table, ["id"]), state) == [(1, "a"), (2, "b"), (3, "C"), (9, "z")]


def test_replace_partitions(spark, namespace):
    table = f"{namespace}.t"
    schema = "g string, id int"
    catalog.replace_partitions(spark.createDataFrame([("a", 1), ("a", 2), ("b'x", 3), ("c", 4)], schema), table, "g", spark.createDataFrame([("a",), ("b'x",), ("c",)], "g string"))
    assert len(rows(spark.table(table))) == 4
    incoming = spark.createDataFrame([("a", 9), ("c", 99)], schema)
    groups = spark.createDataFrame([("a",), ("b'x",)], "g string")
    got = twice(lambda: catalog.replace_partitions(incoming, table, "g", groups), lambda: rows(spark.table(table), "g", "id"))
    assert got == [("a", 9), ("c", 4)]


def test_load_by_content(spark, namespace):
    table = f"{namespace}.t"

    def documents(*texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "position int, t string")
        return df.select("position", F.parse_json("t").alias("raw"))

    state = lambda: rows(spark.table(table).select(F.to_json("raw")))
    keyed = documents('{"id":"a","n":1}', '{"id":"b"}', '{"id":"a","n":2}')
    assert catalog.load_by_content(keyed, table) == "replace"
    assert twice(lambda: catalog.load_by_content(keyed, table), state) == [('{"id":"a","n":2}',), ('{"id":"b"}',)]
    assert catalog.load_by_content(documents('{"id":"c"}', '{"id":""}'), table) == "truncate"
    assert len(state()) == 2
    assert catalog.load_by_content(documents(), table) == "empty"
    assert len(state()) == 2


def test_copy_backup_archive_export_reset(spark, namespace, tmp_path):
    out = f"{namespace}_out"
    spark.range(3).write.saveAsTable(f"{namespace}.topics")
    spark.range(2).withColumn("_id", F.lit("x")).write.saveAsTable(f"{namespace}.fields")
    spark.range(1).write.saveAsTable(f"{namespace}.private")
    assert sorted(catalog.copy_auxiliary(spark, namespace, out)) == ["fields", "topics"]
    assert table_names(spark, out) == ["fields", "topics"]
    assert catalog.backup(spark, f"{namespace}.topics", RUN) == f"{namespace}.topics_backup_20260127_144105"
    assert catalog.backup(spark, f"{namespace}.absent", RUN) is None
    path = catalog.export(spark.table(f"{namespace}.topics"), str(tmp_path), "topics", RUN)
    assert path.endswith("topics_20260127_144105") and spark.read.parquet(path).count() == 3
    assert catalog.export(spark.range(0), str(tmp_path), "none", RUN) is None
    archived = catalog.archive(spark, out, RUN)
    assert archived == f"{out}_202601" and not spark.catalog.databaseExists(out)
    assert spark.table(f"{archived}.fields").columns == ["id"]
    catalog.copy_auxiliary(spark, namespace, out)
    catalog.archive(spark, out, RUN)
    assert spark.table(f"{archived}.topics").count() == 3  # overwritten, not doubled
    assert catalog.archive(spark, "no_such_namespace", RUN) is None
    catalog.reset(spark, namespace)
    assert table_names(spark, namespace) == []
    spark.sql(f"DROP DATABASE {archived} CASCADE")


def test_row_count(spark, namespace):
    table = f"{namespace}.t"
    spark.range(5).write.saveAsTable(table)
    assert catalog.row_count(spark, table) == catalog.row_count(spark, table, estimate=True) == 5
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    assert catalog.row_count(spark, table, estimate=True) == 5


def test_clean_surplus(spark, namespace):
    table = f"{namespace}.r"
    data = [(1, "a", 2023), (1, "b", 2023), (2, "c", 2023), (1, "d", 2022), (1, "e", 2022)]
    spark.createDataFrame(data, "Sourceid int, Title string, year int").write.partitionBy("year").saveAsTable(table)
    check = lambda n: catalog.clean_surplus(spark, table, 2023, "Sourceid", ["Title"], n)
    assert check(4) == "fewer"
    assert check(2) == "clean"
    assert rows(spark.table(table), "Sourceid", "Title", "year") == [(1, "a", 2023), (1, "d", 2022), (1, "e", 2022), (2, "c", 2023)]
    assert check(2) == "match"


def test_checkpoints(spark, namespace):
    table = f"{namespace}.etl_checkpoints"
    assert checkpoints.last_value(spark, table, "s") is None
    checkpoints.save_value(spark, table, "s", "completed", RUN)
    checkpoints.save_value(spark, table, "s", {"b": 1, "a": None}, datetime(2026, 2, 1))
    checkpoints.save_value(spark, table, "other", [1], RUN)
    assert checkpoints.last_value(spark, table, "s") == {"a": None, "b": 1}
    files = spark.createDataFrame([("f1",), ("f2",)], "file_path string")
    done = f"{namespace}.loaded"
    assert checkpoints.pending_files(files, done, "works").count() == 2
    checkpoints.save_files(files.where("file_path = 'f1'"), done, "works")
    checkpoints.save_files(files.where("file_path = 'f1'"), done, "works")
    assert rows(checkpoints.loaded_files(spark, done, "works")) == [("f1",)]
    assert rows(checkpoints.pending_files(files, done, "works")) == [("f2",)]
    assert checkpoints.pending_files(files, done, "authors").count() == 2


def documents_of(spark, path):
    got = stored_documents(spark, str(path)).select("id", F.to_json("raw").alias("raw")).collect()
    return {r["id"]: json.loads(r["raw"]) for r in got}


def test_upsert_documents(spark, tmp_path):
    path = tmp_path / "docs"

    def load(day, *documents):
        df = spark.createDataFrame([(json.dumps(d), i) for i, d in enumerate(documents)], "t string, line_no long")
        raw = df.select(F.parse_json("t").alias("raw"), "line_no").withColumn("id", F.try_variant_get("raw", "$.id", "string"))
        raw = raw.withColumns({"updated_date": F.lit(day).cast("date"), "file_path": F.lit(f"{day}.gz")})
        counters = upsert_documents(spark, str(path), raw)
        return rows(counters, "file_path", "upserted", "matched", "modified")

    assert load("2024-01-02", {"id": "a", "x": 1, "y": 1}, {"id": "b"}, {"id": "a", "x": 2}) == [("2024-01-02.gz", 2, 0, 0)]
    assert documents_of(spark, path) == {"a": {"id": "a", "x": 2, "y": 1}, "b": {"id": "b"}}
    assert load("2024-01-03", {"id": "a", "x": None, "z": [1]}, {"id": "c"}) == [("2024-01-03.gz", 1, 1, 1)]
    assert documents_of(spark, path)["a"] == {"id": "a", "x": None, "y": 1, "z": [1]}
    before = documents_of(spark, path)
    assert load("2024-01-03", {"id": "a", "x": None, "z": [1]}, {"id": "c"}) == [("2024-01-03.gz", 0, 2, 0)]
    load("2024-01-01", {"id": "a", "x": 99, "old": 1})  # late delivery of an older file
    assert documents_of(spark, path) == {**before, "a": {**before["a"], "old": 1}}


def versions(spark, day, document):
    df = spark.createDataFrame([(json.dumps({"id": "a", **document}), 0)], "t string, line_no long")
    raw = df.select(F.parse_json("t").alias("raw"), "line_no").withColumn("id", F.lit("a"))
    return raw.withColumns({"updated_date": F.lit(day).cast("date"), "file_path": F.lit(f"{day}.gz")})


def test_every_load_order_gives_the_same_record(spark, tmp_path):
    all_ = [versions(spark, "2024-01-01", {"a": 1, "b": 1}), versions(spark, "2024-01-02", {"b": 2}), versions(spark, "2024-01-03", {"a": 3})]
    for n, order in enumerate(itertools.permutations(range(3))):
        for cut in ((3,), (1, 2), (2, 1), (1, 1, 1)):
            path, at = f"{tmp_path}/{n}-{len(cut)}-{cut[0]}", 0
            for size in cut:
                some = [all_[i] for i in order[at : at + size]]
                upsert_documents(spark, path, functools.reduce(lambda x, y: x.unionByName(y), some))
                at += size
            assert documents_of(spark, path) == {"a": {"id": "a", "a": 3, "b": 2}}
    compact_documents(spark, path, f"{path}-compact")
    upsert_documents(spark, f"{path}-compact", versions(spark, "2024-01-02", {"a": 9, "c": 5}))
    assert documents_of(spark, f"{path}-compact") == {"a": {"id": "a", "a": 3, "b": 2, "c": 5}}


def test_a_small_delta_writes_little_and_a_repeated_batch_counts_the_same(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.parse_json(F.concat(F.lit('{"v":"'), F.md5(F.col("id").cast("string")), F.lit('"}'))).alias("raw"))
    base = base.withColumns({"updated_date": F.lit("2024-01-01").cast("date"), "file_path": F.lit("base"), "line_no": F.lit(0).cast("long")})
    upsert_documents(spark, path, base, batch_id=0)
    files = lambda: {f: f.stat().st_size for f in Path(path).rglob("*.parquet")}
    before = files()
    delta = base.where("id < '11'").withColumns({"updated_date": F.lit("2024-01-02").cast("date"), "file_path": F.lit("delta")})
    count = lambda: rows(upsert_documents(spark, path, delta, batch_id=1), "file_path", "upserted", "matched", "modified")
    first = count()
    assert count() == first and first[0][1] == 0 and first[0][2] == delta.count()
    assert all(files()[f] == size for f, size in before.items())
    assert sum(size for f, size in files().items() if f not in before) < 0.25 * sum(before.values())


def test_a_compacted_table_exchanges_only_what_batches_touch(spark, tmp_path):
    path, day = f"{tmp_path}/t", lambda d, f: {"updated_date": F.lit(d).cast("date"), "file_path": F.lit(f), "line_no": F.lit(0).cast("long")}
    made = lambda n, name: spark.range(n).select(F.col("id").cast("string"), F.parse_json(F.concat(F.lit('{"id":"'), "id", F.lit('","' + name + '":1}'))).alias("raw"))
    upsert_documents(spark, path, made(20_000, "a").withColumns(day("2024-01-01", "f1")))
    upsert_documents(spark, path, made(50, "b").withColumns(day("2024-01-02", "f2")))
    want = documents_of(spark, path)
    compact_documents(spark, path, f"{path}-1")
    assert documents_of(spark, f"{path}-1") == want
    # fifty records have fields of two versions; the others are settled
    settled, open_ = settled_versions(spark, f"{path}-1")
    assert settled.count() > 19_900 and 100 <= open_.count() < 200
    # a batch that runs again with its first number leaves the base alone
    for _ in range(2):
        counters = upsert_documents(spark, f"{path}-1", made(80, "c").withColumns(day("2024-01-03", "f3")), batch_id=0)
        assert rows(counters, "upserted", "matched", "modified") == [(0, 80, 80)]
    want = {k: v | ({"c": 1} if int(k) < 80 else {}) for k, v in want.items()}
    assert documents_of(spark, f"{path}-1") == want
    settled, open_ = settled_versions(spark, f"{path}-1")
    assert settled.count() > 19_800 and open_.count() < 300
    plan = settled._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    compact_documents(spark, f"{path}-1", f"{path}-2")
    assert documents_of(spark, f"{path}-2") == want
    # late: hidden fields change nothing, others are added
    late = made(20, "a").union(made(60, "d").where("id >= '3'")).withColumns(day("2023-01-01", "f0"))
    upsert_documents(spark, f"{path}-2", late)
    assert documents_of(spark, f"{path}-2") == {k: v | ({"d": 1} if int(k) < 60 and k >= "3" else {}) for k, v in want.items()}


def test_versions_are_exchanged_once_and_records_of_many_give_the_same(spark, tmp_path, monkeypatch):
    made = [(i, d, n) for n, d in enumerate(("2024-01-02", "2024-01-03", None, "2024-01-01")) for i in ("a", "b", None, "c") if (i, n) != ("c", 3)]
    texts = lambda i, n: {"a": f'{{"x":{n},"f{n}":{n},"nul":null}}', "b": "{}" if n == 1 else '[1]' if n == 2 else f'{{"y":[{n}]}}', "c": None}.get(i, f'{{"z":{n}}}')
    df = spark.createDataFrame([(i, texts(i, n), d, n) for i, d, n in made], "id string, t string, day string, line_no long")
    df = df.select("id", F.parse_json("t").alias("raw"), F.col("day").cast("date").alias("updated_date"), F.lit("f").alias("file_path"), "line_no")
    path = f"{tmp_path}/t"
    for n in range(4):
        upsert_documents(spark, path, df.where(F.col("line_no") == n))
    state = lambda p: sorted(((str(r.id), json.loads(r.t), str(r.updated_date), r.line_no) for r in stored_documents(spark, p).withColumn("t", F.to_json("raw")).collect() if r.t), key=lambda r: (r[0], r[2]))
    # of a the newest is line 1; the one without a day is the oldest; b has an empty object and an array beside its fields
    a = {"x": 1, "nul": None, **{f"f{n}": n for n in range(4)}}
    want = [("a", a, "2024-01-03", 1), ("b", {"y": [0]}, "2024-01-02", 0)]
    # rows without an id stay apart until a compaction
    apart = [("None", {"z": n}, d, n) for d, n in (("2024-01-01", 3), ("2024-01-02", 0), ("2024-01-03", 1), ("None", 2))]
    want, apart = [("None", {"z": 1}, "2024-01-03", 1), *want], [*apart, *want]
    assert state(path) == apart
    plan = stored_documents(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    compact_documents(spark, path, f"{path}-1")
    assert state(f"{path}-1") == want
    # the same where every id has too many versions for one place
    monkeypatch.setattr(documents_sink, "FEW", 1)
    assert state(path) == apart
    compact_documents(spark, path, f"{path}-2")
    base = lambda p: sorted((str(r.id), r.t, r.alone, str(r.updated_date), r.line_no) for r in documents_sink.stored_versions(spark, p).withColumn("t", F.to_json("raw")).collect())
    assert base(f"{path}-2") == base(f"{path}-1")


def test_writers_keep_the_layout_and_one_row_per_key(spark, namespace):
    table = f"{namespace}.t"
    one = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, g string")
    one.write.partitionBy("g").saveAsTable(table)
    again = spark.createDataFrame([(2, "old", "y"), (2, "new", "y"), (9, "n", "z")], "id int, v string, g string")
    for write in (catalog.upsert_table, catalog.replace_rows_table, catalog.keep_existing_table):
        with pytest.raises(ValueError, match="not unique"):
            write(again, table, ["id"])
    state = lambda: rows(spark.table(table), "id", "v", "g")
    want = [(1, "a", "x"), (2, "new", "y"), (9, "n", "z")]
    assert twice(lambda: catalog.upsert_table(again, table, ["id"], [c("v")]), state) == want
    assert twice(lambda: catalog.replace_rows_table(again, table, ["id"], [c("v")]), state) == want
    assert twice(lambda: catalog.keep_existing_table(again, table, ["id"], [c("v")]), state) == want
    assert catalog.partition_columns(spark, table) == ["g"]


def test_only_touched_partitions_are_rewritten(spark, namespace):
    table = f"{namespace}.t"
    made = spark.range(40).select("id", F.lit("old").alias("v"), (F.col("id") % 10).cast("int").alias("a"), F.when(F.col("id") % 20 < 10, "x'y").alias("b"))
    made.write.partitionBy("a", "b").saveAsTable(table)
    files = lambda: {tuple(r) for r in spark.table(table).select("a", "b", "_metadata.file_path").distinct().collect()}
    state = lambda: {r.id: (r.v, r.a, r.b) for r in spark.table(table).collect()}
    before, want = files(), state()
    # one row changes, one moves to a new partition, one partition loses all its rows, one key is new, one has a null group
    new = [(3, "n3", 3, "x'y"), (5, "n5", 77, "x'y"), (7, "n7", 8, "x'y"), (27, "n27", 8, None), (99, "n99", 3, "x'y"), (14, "n14", 4, None)]
    source = spark.createDataFrame(new, "id long, v string, a int, b string")
    want |= {i: (v, a, b) for i, v, a, b in new}
    for write in (catalog.replace_rows_table, catalog.upsert_table):
        write(source, table, ["id"])
        assert state() == want and spark.table(table).count() == len(want)
    after = files()
    touched = {(3, "x'y"), (5, "x'y"), (77, "x'y"), (7, "x'y"), (8, "x'y"), (8, None), (4, None)}
    assert {f for f in before if f[:2] not in touched} == {f for f in after if f[:2] not in touched}
    assert not any(f in after for f in before if f[:2] in touched)
    assert (7, "x'y") not in {f[:2] for f in after} and catalog.partition_columns(spark, table) == ["a", "b"]
    # fields that the source has for new keys only stay in their partition
    catalog.upsert_table(spark.createDataFrame([(3, "z", 1, None)], source.schema), table, ["id"], insert_only=["a", "b"])
    assert state() == want | {3: ("z", 3, "x'y")}
    catalog.upsert_table(source.limit(0), table, ["id"])
    assert state() == want | {3: ("z", 3, "x'y")}


def test_an_interrupted_swap_is_mended(spark, namespace):
    table = f"{namespace}.t"
    spark.range(3).write.saveAsTable(f"{table}__old")
    catalog.upsert_table(spark.range(2, 5), table, ["id"])
    assert rows(spark.table(table)) == [(0,), (1,), (2,), (3,), (4,)] and table_names(spark, namespace) == ["t"]


def test_replace_partitions_with_odd_groups(spark, namespace):
    table = f"{namespace}.t"
    names = ["plain", "o'clock", "back\\slash", None, "stays"]
    spark.createDataFrame([(n, 1) for n in names], "g string, v int").select("v", "g").write.partitionBy("g").saveAsTable(table)
    groups = spark.createDataFrame([(n,) for n in names if n != "stays"], "g string")
    replace = lambda new: catalog.replace_partitions(spark.createDataFrame(new, "v int, g string"), table, "g", groups)
    replace([(2, "plain"), (3, None), (7, "stays")])
    assert rows(spark.table(table), "g", "v") == sorted([("plain", 2), (None, 3), ("stays", 1)], key=repr)
    replace([(2, "plain")])
    assert rows(spark.table(table), "g", "v") == [("plain", 2), ("stays", 1)]


def test_snapshot_stream(spark, tmp_path):
    base, out = tmp_path / "base", tmp_path / "out"

    def run():
        load_snapshot(spark, str(base), "works", f"{out}/t", f"{out}/c", f"{out}/r", f"{out}/m", files_per_batch=1)

    run()  # no directory yet: nothing to do
    assert not out.exists()
    write_part(base, "works", "2024-01-02", "part_000.gz", [{"id": "W1", "v": 1}, "not valid json", "", {"id": "W2"}])
    write_part(base, "works", "2024-01-03", "part_000.gz", [{"id": "W1", "v": 2}, {"title": "no id"}, {"id": "X", "is_xpac": True}])
    run()
    assert documents_of(spark, f"{out}/t") == {"W1": {"id": "W1", "v": 2}, "W2": {"id": "W2"}}
    assert rows(spark.read.parquet(f"{out}/r"), "reason", "line") == [("bad_json", "not valid json"), ("no_id", '{"title": "no id"}')]
    totals = lambda: {r["entity"]: r.asDict() for r in load_totals(spark.read.parquet(f"{out}/m")).collect()}
    assert totals()[None] == {
        "entity": None, "files_processed": 2, "records": 3, "skipped": 1, "errors": 2, "upserted": 2, "matched": 1, "modified": 1,
    }
    run()  # nothing new
    assert totals()[None]["files_processed"] == 2
    write_part(base, "works", "2024-01-03", "part_001.gz", [{"id": "W3"}] + [{"id": f"S{i}"} for i in range(20)])
    run()
    assert totals()[None]["files_processed"] == 3 and totals()["works"]["records"] == 24
    assert len(documents_of(spark, f"{out}/t")) == 23
    # a reset forgets everything, and the files load again
    reset_snapshot(spark, f"{out}/t", f"{out}/c", f"{out}/r", f"{out}/m")
    assert documents_of(spark, f"{out}/t") == {}
    run()
    assert totals()[None]["files_processed"] == 3 and len(documents_of(spark, f"{out}/t")) == 23


def test_runner_isolates_a_failing_source(spark, namespace):
    def good(spark):
        return spark.range(3), spark.range(1)

    def bad(spark):
        raise OSError("unreachable")

    sources = [Source("a", ("id",), "upsert", good), Source("b", ("id",), "truncate", bad), Source("c", ("id",), "append", good), Source("d", ("id",), "replace", good)]
    outcome = run_sources(spark, sources, namespace, RUN)
    assert rows(outcome, "name", "outcome") == [("a", "processed"), ("b", "errors"), ("c", "processed"), ("d", "processed")]
    assert spark.table(f"{namespace}.a").count() == 3 and spark.table(f"{namespace}.a_rejects").count() == 1
    assert checkpoints.last_value(spark, f"{namespace}.etl_checkpoints", "b") is None
    run_sources(spark, sources, namespace, RUN)
    assert spark.table(f"{namespace}.a").count() == 3 and spark.table(f"{namespace}.c").count() == 6


def test_organisations(spark, tmp_path, namespace):
    ns = f"{namespace}_ror"
    path = tmp_path / "v1-ror-data.json"
    path.write_text(json.dumps([{"id": "r1"}, {"id": "r2"}]))
    assert load_organisations(spark, str(path), ns, "stage", RUN, is_new=False) == "unchanged"
    assert load_organisations(spark, str(path), ns, "stage", RUN) == "replace"
    assert load_organisations(spark, str(path), ns, "stage", RUN) == "replace"
    assert rows(spark.table(f"{ns}.stage"), "id") == [("r1",), ("r2",)]
    assert spark.table(f"{ns}_202601.stage").count() == 2
    path.write_text("7")
    with pytest.raises(ValueError):
        load_organisations(spark, str(path), ns, "stage", RUN)
    assert spark.table(f"{ns}.stage").count() == 2
    for name in (ns, f"{ns}_202601"):
        spark.sql(f"DROP DATABASE {name} CASCADE")
