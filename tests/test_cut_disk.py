"""What a country cut moves and leaves on disk."""

from __future__ import annotations

import os

from conftest import rows
from pyspark.sql import functions as F

from acervo.catalogue.cuts import authored_works, located_works
from acervo.catalogue.pipelines import described_works
from acervo.operators import joins
from acervo.operators.joins import hot_buckets, id_bitmaps, possible, spread_join
from acervo.plans import country_cut
from acervo.session import materialise, shared_folder

c = F.col
LOW = "spark.sql.autoBroadcastJoinThreshold"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, folder: str, **tables) -> str:
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def shuffle_files(spark) -> set[str]:
    """Shuffle files in the folders of this session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for top in folders for _, _, names in os.walk(str(top)) for name in names if name.startswith("shuffle_")}


def test_a_works_row_is_made_of_its_line_as_by_joining_the_places(spark, tmp_path):
    lines = [(1, 1, 5, 7), (1, 1, 5, 7), (1, 1, 6, 8), (1, None, 5, 7), (None, 1, 5, 7), (2, 1, None, 7), (2, 2, 5, None), (2, 3, 5, 9), (2, 4, 5, 8), (3, 1, 5, 8), (4, 1, 5, 7), (9, 1, 5, 7)]
    folder = stored(
        spark, str(tmp_path),
        lineitem=(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"),
        supplier=([(7, 1), (7, 2), (8, None), (None, 3)], "s_suppkey long, s_nationkey int"),
        orders=([(1, 1, "O"), (2, 2, "P"), (2, 3, "F"), (3, None, "O"), (3, 2, None), (4, 9, "O"), (None, 1, "O")], "o_orderkey long, o_custkey long, o_orderstatus string"),
        customer=([(1, "one", 7), (2, "two", 7), (2, "two", 7), (3, None, None), (None, "none", 7)], "c_custkey long, c_name string, c_nationkey int"),
    )
    doi = F.concat(F.lit("https://doi.org/10.7777/cust("), c("o_custkey"), F.lit(")")).alias("doi")
    dois = spark.read.parquet(f"{folder}/orders.parquet").select(c("o_orderkey").alias("order_no"), doi)
    authored = authored_works(spark, folder, "l_orderkey", "l_suppkey", "l_partkey")
    located = located_works(spark, folder, "l_suppkey", "l_partkey").dropDuplicates(["id", "l_suppkey", "l_partkey"])
    joined = authored.join(located, ["id", "l_suppkey", "l_partkey"]).join(dois, c("l_orderkey") == c("order_no"))
    made = described_works(spark, folder)
    want = rows(joined.select("id", "doi", "authorships", "locations", F.md5("id").alias("_id")))
    assert rows(made) == want and len(want) == 17 and {r[0] for r in want} == {"1-1", "1", "2-4", "3-1"}
    # the lines are read once; they and the orders move once by order, all else is narrower
    before = spark.conf.get(LOW)
    spark.conf.set(LOW, "-1")
    try:
        plan = plan_of(described_works(spark, folder))
    finally:
        spark.conf.set(LOW, before)
    assert plan.count("ReadSchema: struct<l_") == 1 and plan.count("hashpartitioning(l_") == 2 and plan.count("Exchange hashpartitioning") == 7


def test_rows_are_tested_where_they_are_read_even_if_broadcasts_are_off(spark):
    works = spark.range(20_000).select(F.concat(F.lit("W"), "id").alias("id"))
    wanted = materialise(works.where("crc32(id) % 500 = 0"), "wanted")
    places = spark.range(2000).select("id", F.array("id", c("id") + 1).alias("places"))
    before = spark.conf.get(LOW)
    spark.conf.set(LOW, "-1")
    try:
        some = possible(works, "id", materialise(id_bitmaps(wanted, "id"), "bitmaps"))
        plan = plan_of(some)
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert {r.id for r in wanted.collect()} <= {r.id for r in some.collect()}
        near = joins.ids_by_nested_key(places, "id", c("places"), spark.range(100, 102).select(c("id").alias("place")), "place")
        exchanged = plan_of(near)
        assert "shiftright" in exchanged[exchanged.index("hashpartitioning(place") :]
        assert rows(near) == [(100,), (101,), (99,)]
    finally:
        spark.conf.set(LOW, before)
    # keys of another type are compared by value
    other = spark.createDataFrame([(100,)], "place int")
    assert rows(joins.ids_by_nested_key(places, "id", c("places"), other, "place")) == [(100,), (99,)]


def test_only_ids_of_very_many_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    few = spark.range(3000).select(F.concat(F.lit("W"), "id").alias("id"))
    many = few.unionByName(spark.range(900).select(F.lit("W7").alias("id"))).repartition(3)
    assert hot_buckets(few, "id") == []
    hot = hot_buckets(many, "id")
    assert hot == [few.where("id = 'W7'").select(F.pmod(F.xxhash64("id"), F.lit(joins.BUCKETS))).first()[0]]
    unique = few.where("substring(id, -1) = '7'").withColumn("n", F.length("id"))
    for buckets in ([], hot, None):
        assert rows(spread_join(many, unique, "id", hot=buckets)) == rows(many.join(unique, "id"))
    # the narrow side is sent once, but for the hot key
    sent = []
    frame = type(many)
    real = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, *rest: (sent.append(other.count()), real(self, other, *rest))[1])
    for buckets in ([], hot, None):
        spread_join(many, unique, "id", hot=buckets)
    assert sent == [300, 300 + 15, 300 * 16]


def test_a_cut_leaves_its_tables_only(spark, namespace):
    out = f"{namespace}_co"
    author = "array<struct<author:struct<id:string>,countries:array<string>,institutions:array<struct<country_code:string>>>>"
    place = "array<struct<source:struct<id:string>>>"
    values = [(f"W{n}", f"https://doi.org/10.1000/{n % 40}", [((f"A{n % 9}",), ["CO" if n % 7 == 0 else "US"], [])], [((f"S{n % 11}",),)]) for n in range(200)]
    spark.createDataFrame(values, f"id string, doi string, authorships {author}, locations {place}").withColumn("_id", c("id")).repartition(3).write.saveAsTable(f"{namespace}.works")
    spark.createDataFrame([("S3", "CO"), ("S4", "US")], "id string, country_code string").write.saveAsTable(f"{namespace}.sources")
    spark.createDataFrame([(f"A{n}",) for n in range(12)], "id string").write.saveAsTable(f"{namespace}.authors")
    dois = country_cut.DoiInputs(wos=spark.createDataFrame([(f"10.1000/{n}",) for n in range(60)], "DI string"))
    scratch = f"{shared_folder(spark).removeprefix('file://')}/acervo"
    files, folders = shuffle_files(spark), set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    country_cut.run_cut(spark, namespace, out, "CO", dois)
    assert set(os.listdir(scratch)) == folders
    assert not shuffle_files(spark) - files
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    found = {r.id: r.routes for r in spark.table(f"{out}.works").collect()}
    want: dict[str, list[str]] = {}
    for n in range(200):
        if n % 7 == 0:
            want.setdefault(f"W{n}", []).append("authorship")
        if n % 11 == 3:
            want.setdefault(f"W{n}", []).append("source")
    present = {int(i[1:]) % 40 for i in want}
    for k in set(range(40)) - present:
        want.setdefault(min(f"W{n}" for n in range(200) if n % 40 == k), []).append("doi")
    assert found == {i: sorted(r) for i, r in want.items()}
    spark.sql(f"DROP DATABASE {out} CASCADE")
