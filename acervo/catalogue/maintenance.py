"""Table maintenance on the given tables: merges, diffs, duplicates, pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.functions.predicates import long_or_zero
from acervo.operators import digests, merge
from acervo.operators.dedup import (
    duplicate_keys,
    first_per_key,
    latest_matching,
    latest_per_group,
    surplus_rows,
)
from acervo.operators.joins import first_match_lookup, loaded, pending
from acervo.operators.quality import count_verdict

c = F.col


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice * 2 FROM orders s
    WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_orderkey = s.o_orderkey)
""")
def keep_existing_merge(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    stored = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    incoming = orders.select("o_orderkey", (c("o_totalprice") * 2).alias("o_totalprice"))
    return merge.keep_existing(stored, incoming, ["o_orderkey"])


@query("""
    WITH t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0),
    s AS (SELECT c_custkey, c_acctbal * 2 AS c_acctbal, c_mktsegment <> 'BUILDING' AS has_balance,
                 CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END AS c_mktsegment,
                 'nation ' || c_nationkey AS c_address
          FROM customer WHERE c_nationkey < 15)
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, c_name,
           CASE WHEN has_balance THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment, c_address
    FROM t FULL JOIN s ON t.c_custkey = s.c_custkey
""")
def field_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Balance is absent for one segment, segment is present and null for another."""
    customer = table(spark, d, "customer")
    stored = customer.where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    segment = c("c_mktsegment")
    incoming = customer.where("c_nationkey < 15").select(
        "c_custkey",
        (c("c_acctbal") * 2).alias("c_acctbal"),
        F.when(segment != "MACHINERY", F.lower(segment)).alias("c_mktsegment"),
        F.concat(F.lit("nation "), c("c_nationkey")).alias("c_address"),
    )
    has_balance = c("c_mktsegment").isNull() | (c("c_mktsegment") != "building")
    return merge.upsert(stored, incoming, ["c_custkey"], present={"c_acctbal": has_balance})


@query("""
    WITH t AS (SELECT * FROM supplier WHERE s_acctbal > 0), s AS (SELECT * FROM supplier WHERE s_nationkey < 12)
    SELECT coalesce(t.s_suppkey, s.s_suppkey) AS s_suppkey, coalesce(s.s_name, t.s_name) AS s_name,
           CASE WHEN s.s_suppkey IS NULL THEN '2026-01-01T00:00:00' ELSE '2026-02-01T00:00:00' END AS updated_at,
           CASE WHEN t.s_suppkey IS NULL THEN '2026-02-01T00:00:00' ELSE '2026-01-01T00:00:00' END AS created_at
    FROM t FULL JOIN s ON t.s_suppkey = s.s_suppkey
""")
def upsert_created_updated(spark: SparkSession, d: str) -> DataFrame:
    def stamped(df: DataFrame, at: str) -> DataFrame:
        return df.select("s_suppkey", "s_name", F.lit(at).alias("updated_at"), F.lit(at).alias("created_at"))

    supplier = table(spark, d, "supplier")
    return merge.upsert(
        stamped(supplier.where("s_acctbal > 0"), "2026-01-01T00:00:00"),
        stamped(supplier.where("s_nationkey < 12"), "2026-02-01T00:00:00"),
        ["s_suppkey"],
        insert_only=["created_at"],
    )


@query("""
    SELECT s_suppkey, s_name, s_acctbal FROM supplier t
    WHERE s_acctbal < 5000 AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey < 10 AND s.s_suppkey = t.s_suppkey)
    UNION ALL SELECT s_suppkey, upper(s_name), CASE WHEN s_acctbal > 0 THEN s_acctbal END FROM supplier WHERE s_nationkey < 10
""")
def row_replace(spark: SparkSession, d: str) -> DataFrame:
    supplier = table(spark, d, "supplier")
    stored = supplier.where("s_acctbal < 5000").select("s_suppkey", "s_name", "s_acctbal")
    incoming = supplier.where("s_nationkey < 10").select(
        "s_suppkey", F.upper("s_name").alias("s_name"), F.when(c("s_acctbal") > 0, c("s_acctbal")).alias("s_acctbal")
    )
    return merge.replace_rows(stored, incoming, ["s_suppkey"])


@query("""
    WITH g AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
    first AS (SELECT min(n_nationkey) AS k FROM g)
    SELECT c_custkey, c_nationkey, c_name FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM g)
    UNION ALL
    SELECT c_custkey, c_nationkey, 'new ' || c_name FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM g) AND c_nationkey <> (SELECT k FROM first) AND c_acctbal > 0
""")
def group_replace(spark: SparkSession, d: str) -> DataFrame:
    """The nations of a region are replaced; the first of them by no rows."""
    region = table(spark, d, "region").where("r_name = 'ASIA'")
    groups = table(spark, d, "nation").join(region, c("n_regionkey") == c("r_regionkey")).select(
        c("n_nationkey").alias("c_nationkey")
    )
    customer = table(spark, d, "customer")
    emptied = groups.agg(F.min("c_nationkey")).scalar()
    incoming = customer.where((c("c_acctbal") > 0) & (c("c_nationkey") != emptied)).select(
        "c_custkey", "c_nationkey", F.concat(F.lit("new "), c("c_name")).alias("c_name")
    )
    stored = customer.select("c_custkey", "c_nationkey", "c_name")
    return merge.replace_groups(stored, incoming, ["c_nationkey"], groups)


def _part_versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two captures of part: rows come and go, some prices change, some fields are null or NaN."""
    part = table(spark, d, "part")
    kind = F.when(c("p_type") != "SMALL", c("p_type")).alias("p_type")
    price = F.when(c("p_brand") == "Brand#9", F.lit(float("nan"))).otherwise(c("p_retailprice"))
    stored = part.where("p_size <= 40").select("p_partkey", "p_name", kind, price.alias("p_retailprice"))
    raised = F.when(c("p_brand").startswith("Brand#1"), price + 1).otherwise(price)
    incoming = part.where("p_size >= 5").select("p_partkey", "p_name", kind, raised.alias("p_retailprice"))
    return stored, incoming


_ACTIONS = """
    WITH v AS (SELECT *, CASE WHEN p_brand = 'Brand#9' THEN 'NaN'::DOUBLE ELSE p_retailprice END AS price FROM part),
    a AS (SELECT p_partkey, price FROM v WHERE p_size <= 40),
    b AS (SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN price + 1 ELSE price END AS price FROM v WHERE p_size >= 5)
    SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey,
           CASE WHEN a.p_partkey IS NULL THEN 'insert' WHEN b.p_partkey IS NULL THEN 'absent'
                WHEN a.price IS DISTINCT FROM b.price THEN 'update' ELSE 'unchanged' END AS action
    FROM a FULL JOIN b ON a.p_partkey = b.p_partkey
"""


@query(_ACTIONS)
def diff_actions(spark: SparkSession, d: str) -> DataFrame:
    return digests.diff(*_part_versions(spark, d), ["p_partkey"])


@query(f"SELECT action, count(*) AS n FROM ({_ACTIONS}) GROUP BY action")
def diff_summary(spark: SparkSession, d: str) -> DataFrame:
    return merge.diff_summary(digests.diff(*_part_versions(spark, d), ["p_partkey"]))


@query("""
    SELECT key, event_id, user_id FROM (
        SELECT key, event_id, user_id, row_number() OVER (PARTITION BY key ORDER BY event_id) AS rn FROM (
            SELECT event_id, user_id, coalesce(try_cast(CASE WHEN event_type = 'error' THEN 'n/a'
                   ELSE json_extract_string(props, '$.k') || '.0' END AS DOUBLE), 0)::BIGINT AS key FROM events)
        WHERE key <> 0) WHERE rn = 1
""")
def dedup_in_file_order(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(c("event_type") == "error", "n/a").otherwise(F.concat(F.get_json_object("props", "$.k"), F.lit(".0")))
    rows = table(spark, d, "events").select(long_or_zero(text).alias("key"), "event_id", "user_id")
    return first_per_key(rows.where("key != 0"), ["key"], [c("event_id")])


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1
""")
def surplus_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every copy of a text but the first; the digest moves instead of the text."""
    digests = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return surplus_rows(digests, ["digest"], "doc_id").select("doc_id")


@query("""
    WITH a AS (SELECT l_returnflag, l_linestatus, count(*) AS actual FROM lineitem GROUP BY ALL),
    e AS (SELECT l_returnflag, l_linestatus, count(*) AS expected FROM
          (SELECT DISTINCT l_returnflag, l_linestatus, l_orderkey, l_linenumber FROM lineitem) GROUP BY ALL)
    SELECT l_returnflag, l_linestatus, actual, expected,
           CASE WHEN actual > expected THEN 'clean' WHEN actual = expected THEN 'match' ELSE 'fewer' END AS verdict
    FROM a JOIN e USING (l_returnflag, l_linestatus)
""")
def expected_vs_actual(spark: SparkSession, d: str) -> DataFrame:
    by = ["l_returnflag", "l_linestatus"]
    keys = table(spark, d, "lineitem").groupBy(*by, "l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    counts = keys.groupBy(*by).agg(F.sum("copies").alias("actual"), F.count("*").alias("expected"))
    return counts.withColumn("verdict", count_verdict(c("actual"), c("expected")))


@query("""
    SELECT c_custkey, c_nationkey, s_name FROM customer
    LEFT JOIN (SELECT s_nationkey, arg_min(s_name, s_suppkey) AS s_name FROM supplier WHERE s_acctbal > 3000 GROUP BY s_nationkey)
    ON c_nationkey = s_nationkey
""")
def first_match_lookup_query(spark: SparkSession, d: str) -> DataFrame:
    profiles = table(spark, d, "supplier").where("s_acctbal > 3000").withColumnRenamed("s_nationkey", "c_nationkey")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return first_match_lookup(customer, profiles, "c_nationkey", ["s_name"], [c("s_suppkey")])


@query("""
    SELECT user_id, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY CASE WHEN event_type <> 'error' THEN ts END DESC NULLS LAST, event_id) AS rn FROM events)
    WHERE rn = 1
""")
def latest_per_group_query(spark: SparkSession, d: str) -> DataFrame:
    """Latest event of each user; the time of error events is missing."""
    time = F.when(c("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    events = table(spark, d, "events").withColumn("modified_time", time)
    return latest_per_group(events, ["user_id"], "modified_time", [c("event_id")]).select("user_id", "event_id", "value")


@query("""
    WITH f AS (SELECT p_brand, p_partkey, p_name, p_name LIKE '%bolt' AS hit,
                      CASE WHEN p_size > 25 THEN lpad(p_size::VARCHAR, 2, '0') END AS updated, lpad(p_size::VARCHAR, 2, '0') AS created FROM part)
    SELECT p_brand, p_partkey, p_name FROM (
        SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY hit DESC,
            CASE WHEN hit THEN coalesce(updated, created, '') END DESC NULLS LAST, p_partkey DESC) AS rn FROM f)
    WHERE rn = 1
""")
def latest_matching_query(spark: SparkSession, d: str) -> DataFrame:
    created = F.lpad(c("p_size").cast("string"), 2, "0")
    files = table(spark, d, "part").withColumns({"created": created, "updated": F.when(c("p_size") > 25, created)})
    latest = latest_matching(files, ["p_brand"], "p_name", "bolt$", "updated", "created", "p_partkey")
    return latest.select("p_brand", "p_partkey", "p_name")


@query("""
    SELECT DISTINCT 'part_' || o_custkey AS file_path FROM orders
    EXCEPT (SELECT 'part_' || o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1997-01-01'
            UNION SELECT 'part_' || o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def checkpoint_pending(spark: SparkSession, d: str) -> DataFrame:
    """Customers as files: all of them less the set union of two earlier runs."""
    orders = table(spark, d, "orders").withColumn("file_path", F.concat(F.lit("part_"), c("o_custkey")))
    first = orders.where("o_orderstatus = 'F' and o_orderdate < timestamp_ntz '1997-01-01'").select("file_path")
    second = orders.where("o_totalprice > 450000").select("file_path")
    files = orders.select("file_path").distinct()
    return pending(files, first.unionByName(second).distinct(), ["file_path"])


@query("""
    WITH probe AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, EXISTS (
        SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'R' AND s.l_orderkey = p.l_orderkey
        AND s.l_partkey = p.l_partkey AND s.l_suppkey = p.l_suppkey) AS loaded
    FROM probe p
""")
def three_key_probe(spark: SparkSession, d: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    lines = table(spark, d, "lineitem")
    stored = lines.where("l_returnflag = 'R'")
    probes = lines.select(*keys).distinct()
    hit = loaded(probes, stored, keys).withColumn("loaded", F.lit(True))
    return hit.unionByName(pending(probes, stored, keys).withColumn("loaded", F.lit(False)))
