"""Filters, ranges, counters, outcomes and checks on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.functions.predicates import (
    any_value,
    bibliographic,
    has_text,
    identifier_values,
    nonzero,
    not_blank_or_null_passes,
    not_flagged,
    present_number,
    searchable,
)
from acervo.operators.joins import registry_lookup
from acervo.operators.positions import key_ranges
from acervo.operators.quality import failed_rules
from acervo.operators.stats import load_counters, outcome_counts, rolled_up, with_rates
from acervo.operators.streaks import streak_stop
from acervo.plans.country_cut import bibliographic_products
from acervo.plans.institutional import latest_files, plan_run
from acervo.plans.search_projection import range_slice, search_documents
from acervo.sources.responses import response_items
from acervo.sources.snapshot import parse_lines

c = F.col


@query("""
    SELECT event_id, user_id,
           CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL WHEN 'click' THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
           CASE event_type WHEN 'error' THEN 'bad_json' WHEN 'signup' THEN 'no_k' WHEN 'click' THEN 'not_an_object'
                ELSE CASE WHEN json_extract_string(props, '$.k') = '0' THEN 'no_k' END END AS reason
    FROM events WHERE event_type <> 'view'
    UNION ALL SELECT event_id, user_id, '' AS k, 'no_k' AS reason FROM events WHERE event_type = 'view' AND value > 50
""")
def ndjson_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Property lines, damaged by event type: cut off, a list, no key, blank, empty key."""
    kind = c("event_type")
    line = (
        F.when(kind == "error", F.expr("substring(props, 1, length(props) - 1)"))
        .when(kind == "signup", F.lit('{"other": 1}'))
        .when(kind == "click", F.concat(F.lit("["), c("props"), F.lit("]")))
        .when(kind == "view", F.when(c("value") > 50, ' {"k": ""} ').otherwise("  \t"))
        .otherwise(c("props"))
    )
    lines = table(spark, d, "events").select("event_id", "user_id", line.alias("value"))
    return parse_lines(lines, "k").select("event_id", "user_id", "k", "reason")


@query("""
    SELECT CAST(count(*) FILTER (a IS NULL OR a <> '') AS BIGINT) AS blank_excluded, count(*) FILTER (a <> '') AS text_only,
           count(*) FILTER (n IS NOT NULL AND NOT isnan(n)) AS numbers, count(*) FILTER (n <> 0) AS nonzero,
           count(*) FILTER (a IS NULL) AS untitled, count(*) AS total
    FROM (SELECT CASE lang WHEN 'en' THEN text WHEN 'fr' THEN '' END AS a,
                 CASE lang WHEN 'en' THEN n_chars WHEN 'de' THEN 'NaN'::DOUBLE WHEN 'es' THEN 0 END AS n FROM documents)
""")
def source_null_rules(spark: SparkSession, d: str) -> DataFrame:
    lang = c("lang")
    text = F.when(lang == "en", c("text")).when(lang == "fr", "")
    number = (
        F.when(lang == "en", c("n_chars").cast("double")).when(lang == "de", float("nan")).when(lang == "es", 0.0)
    )
    rows = table(spark, d, "documents").select(text.alias("a"), number.alias("n"))
    tests = {
        "blank_excluded": not_blank_or_null_passes(c("a")),
        "text_only": has_text(c("a")),
        "numbers": present_number(c("n")),
        "nonzero": nonzero(c("n")),
        "untitled": c("a").isNull(),
        "total": F.lit(True),
    }
    return load_counters(rows, [], tests)


@query("""
    SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id)
    WHERE (toxic IS NULL OR toxic = 0) AND lang IN ('en', 'de')
      AND (source = 'src1' OR length(string_split(text, chr(10))[1]) >= 30) AND (source = 'src1' OR quality IS NOT NULL)
""")
def row_filters(spark: SparkSession, d: str) -> DataFrame:
    """Flag, product type, searchable title (a document's first line) and all-null rules together."""
    kind = F.when(c("lang") == "en", "Libros").when(c("lang") == "de", "Notas científica").otherwise("Otros")
    labels = table(spark, d, "labels").select("doc_id", "quality", (c("toxic") == 1).alias("is_xpac"))
    author = F.when(c("source") == "src1", c("source"))
    title = F.get(F.split("text", "\n"), F.lit(0))
    return (
        table(spark, d, "documents")
        .join(labels, "doc_id", "left")
        .where(not_flagged(c("is_xpac")) & bibliographic(kind) & searchable(title, author))
        .where(any_value(author, c("quality"), F.lit(None)))
        .select("doc_id")
    )


@query("""
    SELECT product_id, c_custkey, title FROM (
        SELECT lpad(c_nationkey::VARCHAR, 10, '0') AS product_id, c_custkey, c_name AS title,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
        FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_mktsegment <> 'MACHINERY')
    WHERE rn = 1 OR product_id = '0000000000'
""")
def sentinel_branch(spark: SparkSession, d: str) -> DataFrame:
    """Customers of nation 0 have the all-zero product id and all stay."""
    segment = c("c_mktsegment")
    products = table(spark, d, "customer").select(
        F.lpad(c("c_nationkey").cast("string"), 10, "0").alias("product_id"),
        "c_custkey",
        F.when(segment != "MACHINERY", c("c_name")).alias("title"),
        F.when(segment == "BUILDING", "Otros").otherwise("Libros").alias("product_type"),
    )
    return bibliographic_products(products).select("product_id", "c_custkey", "title")


@query("""
    SELECT p_partkey, p_brand AS doi FROM part WHERE p_type IN ('PROMO', 'LARGE')
    UNION ALL SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO'
""")
def identifier_fields(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the fields identifier/doi in a metadata array, flattened."""

    def field(element: str, qualifier: str, text):
        return F.struct(F.lit(element).alias("element"), F.lit(qualifier).alias("qualifier"), text.alias("text"))

    kind = c("p_type")
    fields = F.when(
        kind.isin("PROMO", "LARGE"),
        F.array(
            field("identifier", "doi", c("p_brand")),
            field("identifier", "uri", c("p_name")),
            field("title", "doi", c("p_name")),
            field("identifier", "doi", F.when(kind == "PROMO", c("p_name"))),
        ),
    )
    return table(spark, d, "part").select("p_partkey", F.explode(identifier_values(fields)).alias("doi"))


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey >= (SELECT max(o_orderkey) FROM orders) // 4 AND o_orderkey < (SELECT max(o_orderkey) FROM orders) // 2
""")
def key_slice(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    # one number, from the file footers
    top = orders.agg(F.max("o_orderkey")).first()[0]
    return range_slice(orders, "o_orderkey", top // 4, top // 2)


@query("""
    WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
    n AS (SELECT CAST(ceil(count(*) / 4.0) AS BIGINT) AS chunk FROM orders),
    cuts AS (SELECT o_orderkey::VARCHAR AS cut, pos FROM r, n WHERE pos > 0 AND pos % chunk = 0 UNION ALL SELECT '', NULL)
    SELECT coalesce(lag(cut) OVER (ORDER BY pos NULLS LAST), '') AS min_id, cut AS max_id FROM cuts
""")
def id_ranges(spark: SparkSession, d: str) -> DataFrame:
    return key_ranges(table(spark, d, "orders"), "o_orderkey", 4)


@query("""
    SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN p_type = 'PROMO' THEN p_name || ' & co' ELSE p_name END AS title,
           CASE WHEN l_linestatus = 'O' THEN s_name ELSE '' END AS source, year(o_orderdate)::VARCHAR AS year,
           l_linenumber::VARCHAR AS volume, '' AS issue, CASE WHEN l_returnflag = 'R' THEN l_partkey::VARCHAR ELSE '' END AS first_page,
           '' AS last_page, 'author ' || o_custkey || '|' || s_name AS authors
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
    WHERE p_type <> 'SMALL'
""")
def search_projection(spark: SparkSession, d: str) -> DataFrame:
    """Lines as works: marked-up titles, missing sources and pages, an author without name."""
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_name")
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = (
        table(spark, d, "lineitem")
        .join(part, c("l_partkey") == c("p_partkey"))
        .join(supplier, c("l_suppkey") == c("s_suppkey"))
        .join(orders, c("l_orderkey") == c("o_orderkey"))
    )
    kind = c("p_type")
    title = F.when(kind == "PROMO", F.concat(F.lit("<i>"), c("p_name"), F.lit("</i> &amp; co"))).when(
        kind != "SMALL", F.concat(F.lit("<math><mi>"), c("p_name"), F.lit("</mi></math>"))
    )
    nothing = F.lit(None).cast("string")

    def author(name):
        return F.struct(F.struct(name.alias("display_name")).alias("author"))

    works = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        title.alias("title"),
        F.when(
            c("l_linestatus") == "O", F.struct(F.struct(c("s_name").alias("display_name")).alias("source"))
        ).alias("primary_location"),
        F.year("o_orderdate").alias("publication_year"),
        F.struct(
            c("l_linenumber").cast("string").alias("volume"),
            nothing.alias("issue"),
            F.when(c("l_returnflag") == "R", c("l_partkey").cast("string")).alias("first_page"),
            nothing.alias("last_page"),
        ).alias("biblio"),
        F.array(
            author(F.concat(F.lit("author "), c("o_custkey"))), author(nothing), author(c("s_name"))
        ).alias("authorships"),
    )
    return search_documents(works).withColumn("authors", F.array_join("authors", "|"))


@query("""
    WITH h AS (SELECT event_id, event_type, max(CASE WHEN event_type = 'purchase' THEN event_id END)
                      OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_hit FROM events),
    s AS (SELECT min(event_id) AS stop FROM h WHERE event_id - coalesce(last_hit, -1) = 20)
    SELECT event_id, event_type, 'missing_streak' AS stop_reason FROM events, s WHERE event_id <= stop
""")
def missing_streak_stop(spark: SparkSession, d: str) -> DataFrame:
    """Event ids as probes, a purchase as hit."""
    status = F.when(c("event_type") == "purchase", 200).otherwise(404)
    log = table(spark, d, "events").select(c("event_id").alias("idx"), status.alias("status"), c("props").alias("body"), "event_type")
    items = response_items(log.select("idx", "status", "body")).select("idx", "hit")
    # row-local: the items keep the row order and number of the log
    visited = streak_stop(items, "idx", "hit", 20, start=0)
    return visited.join(log.select("idx", "event_type"), "idx").select(
        c("idx").alias("event_id"), "event_type", "stop_reason"
    )


@query("""
    SELECT event_type, day, count(*) FILTER (value > 50) AS upserted, count(*) FILTER (value <= 50) AS matched,
           count(*) FILTER (value < 5) AS errors, count(*) AS records, CAST(grouping(event_type, day) AS INTEGER) AS level
    FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events) GROUP BY ROLLUP (event_type, day)
""")
def load_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    tests = {
        "upserted": c("value") > 50,
        "matched": c("value") <= 50,
        "errors": c("value") < 5,
        "records": F.lit(True),
    }
    return rolled_up(rows, "event_type", "day", tests)


@query("""
    WITH n AS (SELECT event_type, count(*) AS n, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS seconds
               FROM events GROUP BY event_type)
    SELECT event_type, n, round(n / seconds, 6) AS per_second, round(n * 100.0::DOUBLE / (SELECT count(*) FROM events), 6) AS percent_done FROM n
""")
def counts_and_rate(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("at", F.unix_timestamp(F.date_trunc("second", "ts").cast("timestamp")))
    counters = events.groupBy("event_type").agg(F.count("*").alias("n"), (F.max("at") - F.min("at")).alias("seconds"))
    total = events.agg(F.count("*")).scalar()
    rated = with_rates(counters, "n", total, c("seconds"))
    return rated.select(
        "event_type",
        "n",
        F.round("per_second", 6).alias("per_second"),
        F.round(c("percent_done").cast("double"), 6).alias("percent_done"),
    )


@query("""
    SELECT count(*) AS folders, count(*) FILTER (outcome = 'processed') AS processed, count(*) FILTER (outcome = 'skipped') AS skipped,
           count(*) FILTER (outcome = 'empty') AS empty, count(*) FILTER (outcome = 'errors') AS errors
    FROM (
        SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'skipped' WHEN latest IS NULL THEN 'empty' WHEN latest = 'F' THEN 'skipped'
                               WHEN latest = 'P' THEN 'errors' ELSE 'processed' END AS outcome
        FROM customer LEFT JOIN (
            SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, -o_orderkey)) AS latest FROM orders
            WHERE o_orderpriority <> '5-LOW' AND o_orderpriority <> '1-URGENT' AND o_totalprice > 100000 GROUP BY o_custkey)
        ON o_custkey = c_custkey)
""")
def group_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Customers as folders and orders as their files. Low-priority files are untouched
    originals, urgent ones no workbooks, cheap ones in the bin; a latest file of status F is
    loaded already, one of status P unreadable; folders of nation 3 are badly named."""
    folders = table(spark, d, "customer").select(
        c("c_custkey").cast("string").alias("id"),
        F.concat("c_custkey", F.when(c("c_nationkey") == 3, "-").otherwise("_"), "c_mktsegment").alias("name"),
    )
    priority = c("o_orderpriority")
    listing = table(spark, d, "orders").select(
        c("o_custkey").cast("string").alias("folder_id"),
        c("o_orderkey").cast("string").alias("id"),
        F.when(priority == "5-LOW", "ORIGINAL.xlsx").otherwise("staff.xlsx").alias("name"),
        F.when(priority == "1-URGENT", "text/plain").otherwise("application/vnd.ms-excel").alias("mime_type"),
        (c("o_totalprice") <= 100000).alias("trashed"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("modified_time"),
        c("o_totalprice").cast("string").alias("size"),
        c("o_orderkey").alias("position"),
        "o_orderstatus",
    )
    stored = listing.where("o_orderstatus = 'F'").select(
        c("folder_id").alias("institution_id"), c("id").alias("drive_file_id"), c("modified_time").alias("drive_modified_time")
    )
    readable = listing.where("o_orderstatus != 'P'").select(c("id").alias("drive_file_id"))
    planned = plan_run(latest_files(folders, listing), stored, readable)
    return outcome_counts(planned, "outcome")


@query("""
    SELECT doc_id, array_to_string(list_filter([CASE WHEN NOT (lang IN ('en', 'fr', 'de')) THEN 'lang' END, CASE WHEN NOT (n_chars >= 200) THEN 'short' END,
           CASE WHEN n_chars <> length(text) THEN 'n_chars' END, CASE WHEN contains(text, '@') THEN 'mail' END,
           CASE WHEN quality IS NULL THEN 'label' END], lambda r: r IS NOT NULL), '|') AS reasons
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def row_validation(spark: SparkSession, d: str) -> DataFrame:
    rules = {
        "lang": c("lang").isin("en", "fr", "de"),
        "short": c("n_chars") >= 200,
        "n_chars": c("n_chars") == F.char_length("text"),
        "mail": ~c("text").contains("@"),
        "label": c("quality") >= 0,
    }
    labelled = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return labelled.select("doc_id", F.array_join(failed_rules(rules), "|").alias("reasons"))


@query("""
    SELECT c_custkey, n_nationkey AS calls, 'known' AS lookup FROM customer JOIN nation ON n_name = 'NATION_' || c_nationkey
    WHERE n_regionkey <> 2 AND c_acctbal > 0
    UNION ALL SELECT c_custkey, NULL, 'unknown' FROM customer WHERE c_acctbal <= 0
""")
def registry_lookup_query(spark: SparkSession, d: str) -> DataFrame:
    """Nations as endpoints, those of region 2 disabled; customers in debt name an unknown one."""
    registry = table(spark, d, "nation").select(
        c("n_name").alias("name"),
        (c("n_regionkey") != 2).alias("enabled"),
        F.struct(c("n_nationkey").alias("calls")).alias("rate_limit"),
    )
    name = F.concat(F.when(c("c_acctbal") > 0, "NATION_").otherwise("NONE_"), "c_nationkey")
    rows = table(spark, d, "customer").select("c_custkey", name.alias("name"))
    known, unknown = registry_lookup(rows, registry, "name")
    return known.select("c_custkey", c("rate_limit.calls").alias("calls"), F.lit("known").alias("lookup")).unionByName(
        unknown.select("c_custkey", F.lit(None).cast("int").alias("calls"), F.lit("unknown").alias("lookup"))
    )
