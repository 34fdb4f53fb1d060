"""Key and field derivation on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.functions.ids import article_id, canonical_sha1, content_matches, journal_id, record_key, row_id
from acervo.functions.names import (
    folder_institution,
    folder_label,
    iso_stamp,
    matrix_date,
    matrix_date_text,
    matrix_institution,
    month_stamp,
    period_name,
    semester,
    stamp,
)
from acervo.functions.nested import at, issn_list
from acervo.functions.text import (
    base_name,
    file_extension,
    file_stem,
    fold_text,
    parse_bool,
    safe_file_name,
    split_list,
    strip_markup,
)
from acervo.operators.headers import unique_headers
from acervo.operators.lineage import with_lineage
from acervo.operators.positions import row_positions
from acervo.plans.journals import derive_fields
from acervo.sources.ranking import underscored

c = F.col


@query(r"""
    SELECT doc_id, replace(trim(replace(strip_accents(lower(text)), 'ß', 'ss'), E' \n\t\r'), '.', '') AS folded FROM documents
""")
def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", fold_text(c("text")).alias("folded"))


@query(r"""
    WITH s AS (SELECT page_id, regexp_replace(html, '<!--.*?-->', ' ', 'gs') AS x FROM pages),
    t AS (SELECT page_id, regexp_replace(regexp_replace(x, '<script\b[^>]*>.*?</script\s*>', ' ', 'gsi'),
                 '<style\b[^>]*>.*?</style\s*>', ' ', 'gsi') AS x FROM s),
    u AS (SELECT page_id, regexp_replace(x, '</?[A-Za-z!][^>]*>', ' ', 'gs') AS x FROM t),
    v AS (SELECT page_id, regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS x FROM u)
    SELECT page_id, trim(regexp_replace(x, '\s+', ' ', 'g')) AS text FROM v
""")
def markup_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", strip_markup(c("html")).alias("text"))


@query(r"""
    SELECT page_id, regexp_replace(url, '[^\w\-.]+', '_', 'g') AS safe, regexp_extract(url, '([^/]*)$', 1) AS base,
           regexp_replace(regexp_extract(url, '([^/]*)$', 1), '([^.])\.[^.]+$', '\1') AS stem,
           lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '[^.]\.([^.]+)$', 1)) AS "extension_",
           CASE WHEN contains(url, '#top') THEN true WHEN contains(url, 'utm_source') THEN false
                WHEN contains(url, 'page=') THEN true WHEN contains(url, '.html') THEN false ELSE true END AS flag
    FROM pages
""")
def name_cleanup(spark: SparkSession, d: str) -> DataFrame:
    url = c("url")
    word = (
        F.when(url.contains("#top"), " Yes ")
        .when(url.contains("utm_source"), "N")
        .when(url.contains("page="), "maybe")
        .when(url.contains(".html"), "")
    )
    named = table(spark, d, "pages").select(
        "page_id",
        safe_file_name(url).alias("safe"),
        base_name(url).alias("base"),
        file_stem(url).alias("stem"),
        file_extension(url).alias("extension."),
        parse_bool(word, default=True).alias("flag"),
    )
    return underscored(named)


@query("""
    SELECT o_orderkey, 'ror' || o_custkey AS institution, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ror' || o_custkey END AS folder_id,
           CASE WHEN o_orderstatus = 'P' THEN 'ror' || o_custkey ELSE 'Univ_' || o_orderkey END AS folder_label,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d_%m_%Y_14:41')
                WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d_10:06') ELSE '45_13_2026_10:06' END AS date_text,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT14:41:00')
                WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%dT10:06:00') END AS file_date
    FROM orders
""")
def name_parse(spark: SparkSession, d: str) -> DataFrame:
    status = c("o_orderstatus")
    ror = F.concat(F.lit("ror"), c("o_custkey"))
    date = (
        F.when(status == "F", F.date_format("o_orderdate", "dd_MM_yyyy_'14:41'"))
        .when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd_'10:06'"))
        .otherwise("45_13_2026_10:06")
    )
    ending = F.when(status == "F", "_v2.xlsx").otherwise(".xlsx")
    file = F.concat(F.lit("CIARP_"), ror, F.lit("_"), date, ending)
    folder = F.when(status == "P", ror).otherwise(F.concat(ror, F.lit(" _ Univ_"), c("o_orderkey")))
    return table(spark, d, "orders").select(
        "o_orderkey",
        matrix_institution(file).alias("institution"),
        folder_institution(folder).alias("folder_id"),
        folder_label(folder).alias("folder_label"),
        matrix_date_text(file).alias("date_text"),
        iso_stamp(matrix_date(file)).alias("file_date"),
    )


@query("""
    SELECT 'journals_' || year(o_orderdate) || '_' || CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS period,
           CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester, count(*) AS n
    FROM orders GROUP BY ALL
""")
def half_year_period(spark: SparkSession, d: str) -> DataFrame:
    day = c("o_orderdate")
    return (
        table(spark, d, "orders")
        .groupBy(period_name("journals", day).alias("period"), F.year(day).alias("year"), semester(day).alias("semester"))
        .agg(F.count("*").alias("n"))
    )


@query("""
    SELECT p_partkey,
           CASE WHEN p_type = 'ECONOMY' THEN 'doi:10.1/abc' || p_partkey WHEN p_size < 25 THEN 'doaj:' || p_partkey
                ELSE 'hash:' || sha1(p_name) END AS article,
           CASE WHEN p_type = 'PROMO' THEN 'doaj:' || p_partkey
                WHEN p_type = 'LARGE' THEN 'issn:' || p_brand || '|' || p_size || '|' || p_name
                WHEN p_size < 25 THEN 'issn:' || p_size || '|' || p_name
                WHEN p_type = 'SMALL' THEN 'issn:' || p_name
                ELSE 'hash:' || sha1(p_name) END AS journal,
           p_brand || ':' || p_size || ':' || p_partkey AS row_id
    FROM part
""")
def composite_source_id(spark: SparkSession, d: str) -> DataFrame:
    kind, small, digest = c("p_type"), c("p_size") < 25, F.sha1("p_name")
    doi = F.when(kind == "ECONOMY", F.concat(F.lit("10.1/ABC"), c("p_partkey"))).when(kind == "SMALL", "")
    record = F.when(small, c("p_partkey").cast("string"))
    owner = F.when(kind == "PROMO", c("p_partkey").cast("string")).when(kind == "LARGE", "")
    print_issn = F.when(kind == "LARGE", c("p_brand")).when(kind == "SMALL", "")
    e_issn = F.when((kind == "LARGE") | small, c("p_size").cast("string"))
    issns = F.when((kind == "LARGE") | small | (kind == "SMALL"), F.array(F.lit(""), c("p_name")))
    return table(spark, d, "part").select(
        "p_partkey",
        article_id(doi, record, digest).alias("article"),
        journal_id(owner, print_issn, e_issn, issns, digest).alias("journal"),
        row_id(c("p_brand"), c("p_size"), c("p_partkey")).alias("row_id"),
    )


@query("""
    SELECT p_partkey, coalesce(CASE WHEN p_type <> 'SMALL' THEN p_brand END, CASE WHEN p_size > 10 THEN p_size::VARCHAR END, p_partkey::VARCHAR) AS record_key
    FROM part
""")
def record_key_fallback(spark: SparkSession, d: str) -> DataFrame:
    doc = F.to_variant_object(
        F.struct(
            F.when(c("p_type") != "SMALL", c("p_brand")).alias("id"), F.when(c("p_size") > 10, c("p_size")).alias("codigo")
        )
    )
    key = record_key(at(doc, "$.id"), at(doc, "$.codigo"), c("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", key.alias("record_key"))


@query("""
    SELECT p_partkey,
        CASE p_type WHEN 'PROMO' THEN array_to_string(CASE WHEN split_part(p_name, ' ', 1) = split_part(p_name, ' ', 2)
                          THEN [split_part(p_name, ' ', 1)] ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] END, '|')
            WHEN 'LARGE' THEN p_name || '|' || p_brand
            WHEN 'MEDIUM' THEN p_brand || '|' || p_name
            WHEN 'ECONOMY' THEN p_size::VARCHAR
            WHEN 'STANDARD' THEN p_brand ELSE '' END AS issns,
        CASE WHEN p_type = 'PROMO' THEN 3 ELSE 0 END AS parts
    FROM part
""")
def array_normalise(spark: SparkSession, d: str) -> DataFrame:
    """ISSN fields as text with separators, list of texts, list of objects, number, or missing."""
    kind = c("p_type")
    first, second = F.split_part(c("p_name"), F.lit(" "), F.lit(1)), F.split_part(c("p_name"), F.lit(" "), F.lit(2))
    text = F.concat(first, F.lit(" ;, "), second, F.lit("|"), first)

    def variant(**fields):
        return F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()]))

    doc = (
        F.when(kind == "PROMO", variant(issns=F.array().cast("array<string>"), issnPrint=text))
        .when(kind == "LARGE", variant(issns=F.array(F.lit(" "), c("p_name"), c("p_brand"), c("p_name"))))
        .when(
            kind == "MEDIUM",
            variant(
                issn=F.array(
                    F.struct(F.lit("").alias("value"), c("p_brand").alias("issn")),
                    F.struct(F.concat(F.lit(" "), c("p_name")).alias("value"), F.lit("x").alias("issn")),
                )
            ),
        )
        .when(kind == "ECONOMY", variant(issnElectronico=c("p_size")))
        .when(kind == "STANDARD", variant(issn=F.lit(""), issn_print=c("p_brand")))
    )
    return table(spark, d, "part").select(
        "p_partkey",
        F.array_join(issn_list(doc), "|").alias("issns"),
        F.when(kind == "PROMO", F.size(split_list(text))).otherwise(0).alias("parts"),
    )


@query("""
    SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'doi:10.1/' || lower(p_brand) || p_partkey
                           WHEN p_type = 'PROMO' THEN 'doi:10.1/' || p_size ELSE 'doaj:' || p_partkey END AS source_id,
           CASE WHEN p_type IN ('SMALL', 'LARGE') THEN '10.1/' || p_brand || p_partkey WHEN p_type = 'PROMO' THEN '10.1/' || p_size END AS doi,
           CASE WHEN p_size > 25 THEN p_brand ELSE p_name END AS publisher
    FROM part
""")
def nested_first_match(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers as one object or a list; the first of type doi with a value gives the DOI."""
    kind, small = c("p_type"), c("p_size") > 25

    def identifier(kind_name: str, value, key: str = "id"):
        return F.to_variant_object(F.struct(F.lit(kind_name).alias("type"), value.alias(key)))

    named = F.concat(F.lit(" 10.1/"), c("p_brand"), c("p_partkey"))
    listed = F.array(identifier("eissn", F.lit("1")), identifier("doi", F.lit("")), identifier("DOI", named, "value"))
    identifiers = (
        F.when(kind == "SMALL", F.to_variant_object(listed))
        .when(kind == "LARGE", identifier("doi", named))
        .when(kind == "PROMO", F.to_variant_object(F.array(identifier("DOI", F.concat(F.lit("10.1/"), c("p_size"))))))
    )
    bibjson = F.struct(identifiers.alias("identifier"), F.when(small, c("p_brand")).otherwise("").alias("publisher"))
    raw = F.to_variant_object(
        F.struct(c("p_partkey").cast("string").alias("id"), c("p_name").alias("publisher"), bibjson.alias("bibjson"))
    )
    derived = derive_fields(table(spark, d, "part").select("p_partkey", raw.alias("raw")), "article")
    return derived.select("p_partkey", "source_id", "doi", "publisher")


@query("""
    SELECT c_nationkey || ':F' || c_nationkey || ':' || (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) AS _id,
           c_custkey, n_name AS institution_name, 'N' || n_nationkey AS folder_id, '20260102_030405' AS extracted_at, '202601' AS month,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS row_number
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def lineage_columns(spark: SparkSession, d: str) -> DataFrame:
    """The customers of a nation as the rows of its file."""
    rows = row_positions(
        table(spark, d, "customer").select("c_custkey", c("c_nationkey").alias("nation")),
        ["c_custkey"],
        within=["nation"],
        alias="row_number",
    )
    files = table(spark, d, "nation").select(
        c("n_nationkey").alias("nation"),
        c("n_nationkey").cast("string").alias("institution_id"),
        c("n_name").alias("institution_name"),
        F.concat(F.lit("N"), c("n_nationkey")).alias("folder_id"),
        F.concat(F.lit("F"), c("n_nationkey")).alias("file_id"),
    )
    run_ts = F.lit("2026-01-02 03:04:05").cast("timestamp_ntz")
    return with_lineage(rows, files, "nation", stamp(run_ts)).select(
        "_id", "c_custkey", "institution_name", "folder_id", "extracted_at", month_stamp(run_ts).alias("month"), "row_number"
    )


@query("""
    WITH cells AS (SELECT p_partkey // 16 AS book, p_partkey % 16 AS place,
                          CASE WHEN p_type = 'SMALL' THEN 'column_' || (p_partkey % 16 + 1) ELSE p_type END AS base FROM part),
    n AS (SELECT *, row_number() OVER (PARTITION BY book, base ORDER BY place) AS k FROM cells)
    SELECT book, CAST(place AS INTEGER) AS place, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS header FROM n
""")
def header_repair(spark: SparkSession, d: str) -> DataFrame:
    """Sixteen parts make one header row."""
    cell = F.struct(
        (c("p_partkey") % 16).alias("place"), F.when(c("p_type") == "SMALL", " ").otherwise(c("p_type")).alias("name")
    )
    books = (
        table(spark, d, "part")
        .groupBy(F.floor(c("p_partkey") / 16).alias("book"))
        .agg(F.array_sort(F.collect_set(cell)).alias("cells"))
    )
    headers = unique_headers(F.transform("cells", lambda x: x["name"]))
    return books.select("book", F.posexplode(headers).alias("place", "header"))


@query("""
    SELECT doc_id, sha1('{"lang": "' || lang || '", "n": ' || n_chars || ', "source": "' || source || '"}') AS record_sha1,
           sha256(text) AS text_sha256, lang <> 'fr' AS matches
    FROM documents
""")
def hash_ids(spark: SparkSession, d: str) -> DataFrame:
    record = F.to_json(F.struct(c("source"), c("n_chars").alias("n"), c("lang")))
    content = F.encode("text", "utf-8")
    digest = F.sha2(content, 256)
    announced = F.when(c("lang") == "en", F.concat(F.lit("sha256:"), digest)).when(c("lang") == "fr", "sha256:0")
    return table(spark, d, "documents").select(
        "doc_id",
        canonical_sha1(record).alias("record_sha1"),
        digest.alias("text_sha256"),
        content_matches(content, announced, F.octet_length("text")).alias("matches"),
    )
