from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acervo.functions.text import tokens
from acervo.operators import dedup, digests, headers, joins, merge, positions, quality, retrieval, stats, streaks

c = F.col


def test_first_per_key_needs_an_order(spark):
    df = spark.range(3).withColumn("k", F.lit(1))
    with pytest.raises(ValueError):
        dedup.first_per_key(df, ["k"], [])
    assert rows(dedup.first_per_key(df, ["k"], [c("id").desc()])) == [(2, 1)]


def test_first_per_key_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", c("id") % 3)
    plan = dedup.first_per_key(df, ["k"], [c("id")])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], plan


def test_latest_per_group(spark):
    files = [("i", "a", "2025-01-01", 0), ("i", "b", "2025-02-01", 1), ("i", "c", "2025-02-01", 2), ("i", "d", None, 3), ("j", "e", None, 4)]
    df = spark.createDataFrame(files, "inst string, file string, modified string, pos int")
    got = dedup.latest_per_group(df, ["inst"], "modified", [c("pos")])
    assert rows(got, "inst", "file") == [("i", "b"), ("j", "e")]


def test_latest_matching(spark):
    files = [
        ("g", "v1-ror-data.json", "2025", "2020", 0), ("g", "V2-ROR-DATA.JSON", None, "2026", 1), ("g", "z.csv", "2030", None, 2),
        ("h", "a.csv", "2030", None, 0), ("h", "b.csv", "2020", None, 1),
        ("k", "a-ror-data.json", "2025", None, 0), ("k", "b-ror-data.json", "2025", None, 1),
    ]
    df = spark.createDataFrame(files, "g string, name string, updated string, created string, pos int")
    got = dedup.latest_matching(df, ["g"], "name", r"(?i)ror-data\.json$", "updated", "created", "pos")
    assert rows(got, "g", "name") == [("g", "V2-ROR-DATA.JSON"), ("h", "b.csv"), ("k", "b-ror-data.json")]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e"), (None, "f")], "k int, row string")
    assert rows(dedup.duplicate_keys(df, ["k"])) == [(1, 3), (None, 2)]
    assert rows(dedup.surplus_rows(df, ["k"], "row").select("row")) == [("b",), ("c",), ("f",)]
    with pytest.raises(ValueError, match="not unique"):
        quality.assert_unique(df, ["k"])
    quality.assert_unique(df, ["row"])


def test_upsert_fields(spark):
    stored = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, x string, y int")
    incoming = spark.createDataFrame([(2, None, 5, True), (3, "c", 7, False)], "id int, x string, z int, has_z boolean")
    got = merge.upsert(stored, incoming.drop("has_z"), ["id"])
    assert rows(got, "id", "x", "y", "z") == [(1, "a", 10, None), (2, None, 20, 5), (3, "c", None, 7)]
    partial = merge.upsert(stored, incoming, ["id"], present={"z": c("has_z"), "x": c("x").isNotNull()})
    assert rows(partial, "id", "x", "y", "z") == [(1, "a", 10, None), (2, "b", 20, 5), (3, "c", None, None)]


def test_upsert_insert_only(spark):
    stored = spark.createDataFrame([(1, "t0", "t0")], "id int, created string, updated string")
    incoming = spark.createDataFrame([(1, "t1", "t1"), (2, "t1", "t1")], "id int, created string, updated string")
    got = merge.upsert(stored, incoming, ["id"], insert_only=["created"])
    assert rows(got) == [(1, "t0", "t1"), (2, "t1", "t1")]
    again = merge.upsert(got, incoming, ["id"], insert_only=["created"])
    assert rows(again) == rows(got)


def test_replace_keep_and_groups(spark):
    stored = spark.createDataFrame([(1, "a", "old"), (2, "a", "old"), (3, "b", "old"), (4, "c", "old")], "id int, g string, v string")
    incoming = spark.createDataFrame([(2, "a", "new"), (9, "a", "new"), (8, "z", "new")], "id int, g string, v string")
    assert rows(merge.replace_rows(stored, incoming, ["id"]), "id", "v") == [
        (1, "old"), (2, "new"), (3, "old"), (4, "old"), (8, "new"), (9, "new"),
    ]
    assert rows(merge.keep_existing(stored, incoming, ["id"]), "id", "v") == [
        (1, "old"), (2, "old"), (3, "old"), (4, "old"), (8, "new"), (9, "new"),
    ]
    groups = spark.createDataFrame([("a",), ("b",)], "g string")
    got = merge.replace_groups(stored, incoming, ["g"], groups)
    assert rows(got, "id", "v") == [(2, "new"), (4, "old"), (9, "new")]
    assert rows(merge.replace_groups(got, incoming, ["g"], groups), "id", "v") == rows(got, "id", "v")


def test_diff(spark):
    nan = float("nan")
    stored = spark.createDataFrame(
        [(12345, "Old Title", 2.0, None), (1, "same", nan, None), (2, "gone", 1.0, None), (3, "extra", 1.0, "x")],
        "Sourceid int, Title string, Rank double, extra string",
    )
    incoming = spark.createDataFrame(
        [(12345, "New Title", 1), (67890, "Brand New", 2), (3, "extra", 1)], "Sourceid int, Title string, Rank int"
    )
    same = spark.createDataFrame([(1, "same", nan)], "Sourceid int, Title string, Rank double")
    got = merge.diff(stored, incoming.unionByName(same), ["Sourceid"])
    assert rows(got) == [(1, "unchanged"), (12345, "update"), (2, "absent"), (3, "update"), (67890, "insert")]
    assert rows(merge.diff_summary(got)) == [("absent", 1), ("insert", 1), ("unchanged", 1), ("update", 2)]
    state = merge.apply_diff(stored, incoming, ["Sourceid"])
    assert rows(merge.diff(state, incoming, ["Sourceid"]).where("action != 'absent'").select("action").distinct()) == [("unchanged",)]


@pytest.mark.parametrize("seed", range(2))
def test_diff_by_digests_equals_the_full_diff(spark, seed):
    rng = random.Random(seed)
    pick = lambda *some: rng.choice([None, *some])
    row = lambda i: (i, f"k{i % 3}", pick("a", "b", ""), pick(0.0, -0.0, float("nan"), 1.5), pick([], [None], ["x", None], [None, "x"]), pick((None, "v"), ("v", None)))
    schema = "id int, part string, t string, x double, l array<string>, s struct<p: string, q: string>"
    old = [row(i) for i in range(300)] + [(None, "k0", "a", 1.0, [], None)]
    new = [r if rng.random() < 0.7 else row(r[0]) for r in old[:-1] if rng.random() < 0.9] + [row(i) for i in range(300, 330)] + [(None, "k0", "a", 1.0, [], None)]
    stored, incoming = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).repartition(3)
    for a, b, ignore in ((stored, incoming, []), (stored, incoming, ["x", "l"]), (stored.drop("t"), incoming, []), (stored, incoming.withColumn("id", c("id").cast("long")), []), (stored.limit(0), incoming, []), (stored, incoming.limit(0), [])):
        for width in (4, 1024):
            assert rows(digests.diff(a, b, ["id", "part"], ignore, width)) == rows(merge.diff(a, b, ["id", "part"], ignore))


def test_digests_open_only_what_differs(spark):
    table = spark.range(20_000).select("id", F.md5(c("id").cast("string")).alias("v"), F.lit(None).cast("string").alias("n"))
    old, new, same = digests.open_rows(table, table.repartition(5), ["id"])
    assert old.isEmpty() and new.isEmpty() and same.count() == 20_000
    changed = table.withColumn("v", F.when(c("id") % 4000 == 1, "x").otherwise(c("v"))).where("id <> 77")
    old, new, same = digests.open_rows(table, changed, ["id"])
    assert 6 <= old.count() < 20 and 5 <= new.count() < 20 and same.count() > 19_970
    # rows are tested in the scan; none moves before
    plan = same._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    # a value that moves to another column, and pairs of equal rows, are seen
    moved = table.select("id", c("n").alias("v"), c("v").alias("n"))
    assert digests.open_rows(table, moved, ["id"])[2].isEmpty()
    twice = lambda v: spark.createDataFrame([(1, v), (1, v)], "id long, v string")
    assert digests.open_rows(twice("a"), twice("b"), ["id"])[2].isEmpty()


def test_nested_semi_join_and_lookup(spark):
    works = spark.createDataFrame([("w1", ["s1", "s2"]), ("w2", ["s3", None]), ("w3", None), ("w4", ["s2", "s2"])], "id string, s array<string>")
    keys = spark.createDataFrame([("s2",), ("s9",)], "source string")
    assert rows(joins.ids_by_nested_key(works, "id", c("s"), keys, "source")) == [("w1",), ("w4",)]
    people = spark.createDataFrame([("p", "B"), ("p", "A"), ("q", "C")], "pid string, name string")
    products = spark.createDataFrame([(1, "p"), (2, "z"), (3, None)], "n int, pid string")
    got = joins.first_match_lookup(products, people, "pid", ["name"], [c("name")])
    assert rows(got, "n", "name") == [(1, "A"), (2, None), (3, None)]


@pytest.mark.parametrize("n_rows, n", [(0, 4), (1, 4), (10, 4), (12, 4), (103, 7), (5, 1)])
def test_key_ranges(spark, n_rows, n):
    keys = sorted(f"{i:024x}" for i in random.Random(n_rows).sample(range(10**9), n_rows))
    df = spark.createDataFrame([(k,) for k in keys], "_id string").repartition(3)
    chunk = max(-(-n_rows // n), 1)
    cuts = [keys[i * chunk] for i in range(1, n) if i * chunk < n_rows]
    wanted = list(zip(["", *cuts], [*cuts, ""], strict=True))
    assert rows(positions.key_ranges(df, "_id", n)) == sorted(wanted, key=repr)


@pytest.mark.parametrize("hot, n", [(0, 4), (2000, 3), (2900, 7), (2000, 1)])
def test_key_ranges_are_exact_and_order_few_rows(spark, monkeypatch, hot, n):
    rng = random.Random(hot + n)
    keys = [5_000] * hot + [None] * 150 + [rng.randint(-10_000, 10_000) for _ in range(2850)]
    ordered = sorted(keys, key=lambda k: (k is not None, k or 0))
    step = -(-len(keys) // n)
    cuts = [None if k is None else str(k) for k in ordered[step::step]]
    sizes, plain = [], positions.row_positions
    monkeypatch.setattr(positions, "row_positions", lambda df, *a, **k: (sizes.append(df.count()), plain(df, *a, **k))[1])
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    got = positions.key_ranges(frame, "k", n, pivots=64)
    assert [tuple(r) for r in got.collect()] == list(zip(["", *cuts], [*cuts, ""], strict=True))
    assert sum(sizes) <= 4 * n * len(keys) / 64
    few = spark.createDataFrame([(k / 8 if k else None,) for k in keys], "k double")
    assert positions.key_ranges(few, "k", n, pivots=1).count() == len(cuts) + 1


def test_row_positions_over_a_hot_group(spark):
    df = spark.range(500).select(F.when(c("id") % 3 == 0, c("id")).otherwise(-1).alias("g"), (c("id") * 7 % 500).alias("v"))
    got = positions.row_positions(df, ["v"], within=["g"]).collect()
    groups: dict = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["v"], r["position"]))
    assert len(got) == 500
    for members in groups.values():
        assert [p for _, p in sorted(members)] == list(range(len(members)))


def brute_stop(hits, n, start, max_index, last):
    misses, idx = 0, start
    while True:
        if max_index and idx > max_index:
            return idx - 1, "max_index"
        misses = 0 if idx in hits else misses + 1
        if misses >= n:
            return idx, "missing_streak"
        idx += 1


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("max_index", [0, None, 25])
def test_streak_stop_equals_the_walk(spark, seed, max_index):
    rng = random.Random(seed)
    n, start = rng.randint(1, 6), rng.randint(0, 3)
    hits = {i for i in range(200) if rng.random() < 0.45}
    end, reason = brute_stop(hits, n, start, max_index, 200)
    log = spark.createDataFrame([(i, i in hits) for i in range(260)], "idx int, hit boolean")
    got = streaks.streak_stop(log, "idx", "hit", n, start, max_index)
    summary = got.agg(F.min("idx"), F.max("idx"), F.count("*"), F.min("stop_reason")).first()
    assert tuple(summary) == (start, end, end - start + 1, reason)


def test_validation_and_counts(spark):
    df = spark.createDataFrame([(1, "es", 3), (2, None, 0), (3, "xx", 5)], "id int, lang string, n int")
    good, bad = quality.validate(df, {"lang": c("lang").isin("es", "en"), "n": c("n") > 0})
    assert rows(good) == [(1, "es", 3)]
    assert rows(bad, "id", "reasons") == [(2, ["lang", "n"]), (3, ["lang"])]
    verdicts = spark.createDataFrame([(3, 2), (2, 2), (1, 2)], "a int, e int").select(quality.count_verdict(c("a"), c("e")))
    assert rows(verdicts) == [("clean",), ("fewer",), ("match",)]


def test_stats(spark):
    df = spark.createDataFrame([("works", "f1", True), ("works", "f1", False), ("works", "f2", True), ("authors", "f3", True)], "e string, f string, ok boolean")
    got = stats.rolled_up(df, "e", "f", {"records": c("ok"), "errors": ~c("ok")})
    assert (None, None, 3, 1, 3) in rows(got)
    assert ("works", None, 2, 1, 1) in rows(got)
    rated = stats.with_rates(spark.createDataFrame([(50,)], "n int"), "n", F.lit(200), F.lit(4.0))
    assert rows(rated) == [(50, 12.5, 25.0)]
    outcomes = spark.createDataFrame([("processed",), ("skipped",), ("skipped",)], "o string")
    assert rows(stats.outcome_counts(outcomes, "o")) == [(3, 1, 2, 0, 0)]


@pytest.mark.parametrize(
    "cells, wanted",
    [
        (["a", None, "a", " ", "a"], ["a", "column_2", "a_2", "column_4", "a_3"]),
        (["a", "a", "a_2"], ["a", "a_2", "a_2_2"]),
        (["a", "a_2", "a"], ["a", "a_2", "a_3"]),
        ([], []),
    ],
)
def test_unique_headers(spark, cells, wanted):
    df = spark.createDataFrame([(cells,)], "cells array<string>")
    assert df.select(headers.unique_headers(c("cells"))).first()[0] == wanted


def test_registry_lookup(spark):
    registry = spark.createDataFrame([("a", True), ("b", False)], "name string, enabled boolean")
    asked = spark.createDataFrame([("a",), ("b",), ("x",)], "name string")
    known, unknown = joins.registry_lookup(asked, registry, "name")
    assert rows(known, "name") == [("a",)]
    assert rows(unknown) == [("x",)]


def brute_top(queries, titles, tokens_of, k):
    from decimal import Decimal
    from math import log

    df: dict = {}
    for words in titles.values():
        for w in words:
            df[w] = df.get(w, 0) + 1
    weight = {w: Decimal(str(round(log(1 + len(titles) / n), 6))) for w, n in df.items()}
    out = []
    for q, words in queries.items():
        scores = []
        for t, have in titles.items():
            shared = set(words) & set(have)
            if shared:
                scores.append((-sum(weight[w] for w in shared), t))
        out += [(q, t, -s, r + 1) for r, (s, t) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_top_candidates_equal_all_pairs(spark, seed):
    """Zipf-like words, so that every query has hot tokens and some have only hot ones."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(40)]
    pick = lambda n: " ".join(words[min(int(rng.paretovariate(0.7)) - 1, 39)] for _ in range(n))
    titles = {i: pick(rng.randint(1, 8)) for i in range(150)}
    titles |= {i: "word1 word3 word9" for i in range(150, 230, 2)} | {i: "Word9, word3 - WORD1!" for i in range(151, 230, 2)}
    asked = {i: pick(rng.randint(1, 6)) for i in range(25)}
    asked[25] = "word0 word0"
    asked[26] = "unknown token"
    asked |= {27: "word9 word1 word2", 28: "word2 word9 word1", 29: "word9 word1 word2"}
    t_df = spark.createDataFrame(list(titles.items()), "id int, title string")
    q_df = spark.createDataFrame(list(asked.items()), "qid int, text string")
    got = retrieval.top_candidates(q_df, "qid", "text", t_df, "id", "title", 5)

    def cut(df, key, value):
        return {r[0]: r[1] for r in df.select(key, tokens(c(value))).collect()}

    assert rows(got, "q_id", "t_id", "score", "rank") == brute_top(cut(q_df, "qid", "text"), cut(t_df, "id", "title"), None, 5)


def test_candidates_share_titles_and_authors(spark):
    """A word in a title and the same word in a name are different; null names and null lists count as none."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(25)]
    pick = lambda n: " ".join(rng.choices(words, k=n))
    titles = [(i, pick(rng.randint(0, 5)), rng.choice([None, [], [None], [pick(1), pick(2)], [pick(2)]])) for i in range(120)]
    asked = [(i, pick(rng.randint(1, 4)), rng.choice([None, [None], [pick(2)]])) for i in range(20)]
    schema = "id int, title string, names array<string>"
    found = retrieval.top_candidates(
        spark.createDataFrame(asked, schema), "id", "title", spark.createDataFrame(titles, schema), "id", "title", 4, "names", "names"
    )

    def both(rows_):
        return {i: set(t.split()) | {"@" + w for n in names or [] if n for w in n.split()} for i, t, names in rows_}

    assert rows(found, "q_id", "t_id", "score", "rank") == brute_top(both(asked), both(titles), None, 4)


def test_few_pairs_are_kept(spark, monkeypatch):
    """What is ranked grows with the queries, not with queries and titles: ten times the titles, the same number of pairs."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(60)]
    kept = []
    ranked = retrieval._ranked

    def counted(scores, k):
        kept.append(scores.count())
        return ranked(scores, k)

    monkeypatch.setattr(retrieval, "_ranked", counted)
    sizes = []
    for n in (300, 3000):
        titles = [(i, " ".join(rng.choices(common, k=9) + [f"r{i // 12}"])) for i in range(n)]
        asked = [(i, " ".join(rng.choices(common, k=6) + [f"r{i}", f"r{i + 1}"])) for i in range(20)]
        kept.clear()
        got = retrieval.top_candidates(spark.createDataFrame(asked, "id int, t string"), "id", "t", spark.createDataFrame(titles, "id int, t string"), "id", "t", 5)
        assert got.count() == 100
        sizes.append(kept[1])
    # of the three rankings the second one is that of the pairs scored in full
    assert sizes[1] < 3 * sizes[0] and sizes[1] < 20 * 20
