"""Whole runs on the given tables: the country cut by four routes, and the load of institutional matrices."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.catalogue.cuts import COUNTRY, _BY_AUTHOR, _BY_SOURCE, _RAW_DOIS, _sql_doi, authored_works, doi_inputs, journal_sources, page_names, work_locations
from acervo.catalogue.registry import SQL, query, table
from acervo.functions.predicates import SPREADSHEET_TYPES
from acervo.plans.country_cut import run_cut
from acervo.plans.institutional import run_matrices
from acervo.session import scratch_path, shuffles_released

c = F.col
RUNS = datetime(2026, 1, 27, 14, 41, 5), datetime(2026, 2, 27, 14, 41, 5)

_CUT_ROUTES = f"""
    works AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS id, o_custkey, 'https://doi.org/10.7777/cust(' || o_custkey || ')' AS doi
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    first AS (SELECT DISTINCT id, 'authorship' AS route FROM ({_BY_AUTHOR}) UNION ALL SELECT id, 'source' FROM ({_BY_SOURCE})),
    wanted AS (SELECT DISTINCT {_sql_doi('raw')} AS doi FROM ({_RAW_DOIS})),
    by_doi AS (SELECT min(id) AS id, 'doi' AS route FROM works
               WHERE doi IN (SELECT doi FROM wanted) AND doi NOT IN (SELECT doi FROM works WHERE id IN (SELECT id FROM first)) GROUP BY doi),
    alike AS (SELECT DISTINCT id || '-1' AS id, 'similarity' AS route FROM ({SQL['fuzzy_title_match']})),
    routes AS (SELECT id, string_agg(route, '|' ORDER BY route) AS routes
               FROM (FROM first UNION ALL FROM by_doi UNION ALL FROM alike) WHERE id IN (SELECT id FROM works) GROUP BY id)
"""


def described_works(spark: SparkSession, d: str) -> DataFrame:
    """``id, doi, authorships, locations, _id`` of the lines; those that repeat an id are the same work.

    The lines move by supplier, if the suppliers are many, and once by order; the text of a DOI is made where the row is written.
    """
    doi = F.concat(F.lit("https://doi.org/10.7777/cust("), c("doi_custkey"), F.lit(")")).alias("doi")
    dois = table(spark, d, "orders").select(c("o_orderkey").alias("order_no"), c("o_custkey").alias("doi_custkey"))
    # a line without a part is no work, as it has no such place
    authored = authored_works(spark, d, "l_orderkey", "l_partkey", work_locations()).where("l_partkey is not null")
    return authored.join(dois, c("l_orderkey") == c("order_no")).select("id", doi, "authorships", "locations", F.md5("id").alias("_id"))


@query(f"""
    WITH {_CUT_ROUTES}
    SELECT 'work' AS kind, id, routes, doi FROM routes JOIN works USING (id)
    UNION ALL SELECT 'author', 'C' || c_custkey, c_name, NULL FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM works JOIN routes USING (id))
    UNION ALL SELECT 'topic', r_regionkey::VARCHAR, r_name, NULL FROM region
""")
def run_country_cut(spark: SparkSession, d: str) -> DataFrame:
    """The whole cut: works by authorship, source, DOI and similarity, their authors, and the auxiliary tables."""
    name = f"cut_{uuid.uuid4().hex}"
    source, target = f"{name}_all", f"{name}_country"
    for schema in (source, target):
        spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, schema)}'")
    with shuffles_released(spark):
        # not much more than half of what the default packing takes
        described_works(spark, d).write.option("compression", "zstd").saveAsTable(f"{source}.works")
        journal_sources(spark, d).write.saveAsTable(f"{source}.sources")
        table(spark, d, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"), "c_name").write.saveAsTable(f"{source}.authors")
        table(spark, d, "region").select(c("r_regionkey").cast("string").alias("id"), "r_name").write.saveAsTable(f"{source}.topics")
    pages = page_names(spark, d)
    run_cut(
        spark, source, target, COUNTRY, doi_inputs(spark, d),
        products=pages.select(c("page_id").alias("product_key"), c("heading").alias("title"), c("page_id").alias("person_id")),
        profiles=pages.select(c("page_id").alias("person_id"), c("site").alias("name")),
        search=pages.select(F.concat("page_id", F.lit("-1")).alias("id"), "title", F.array(F.upper("site")).alias("authors")),
    )
    kept = spark.table(f"{target}.works")
    if "_id" in kept.columns:
        raise ValueError("the row number of the source is no column of the cut")
    none = F.lit(None).cast("string").alias("doi")
    works = kept.select(F.lit("work").alias("kind"), "id", F.array_join("routes", "|").alias("routes"), "doi")
    authors = spark.table(f"{target}.authors").select(F.lit("author").alias("kind"), "id", c("c_name").alias("routes"), none)
    topics = spark.table(f"{target}.topics").select(F.lit("topic").alias("kind"), "id", c("r_name").alias("routes"), none)
    return works.unionByName(authors).unionByName(topics)


# Customers of a nation are the rows of its matrix; a later file brings some nations other rows.
_FILE_ROWS = """
    SELECT 1 AS version, c_nationkey AS n, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS r FROM customer WHERE c_acctbal < 5000
    UNION ALL
    SELECT 2, c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 FROM customer WHERE c_acctbal > 0 AND c_nationkey < 12
"""


def _matrix_runs(spark: SparkSession, d: str, keep_only_latest: bool) -> tuple[DataFrame, DataFrame]:
    """The table after two runs, and the outcomes of both."""
    schema = f"matrix_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, schema)}'")
    name = f"{schema}.staff"
    nations = table(spark, d, "nation").select(c("n_nationkey").alias("n"))
    label = F.when(c("n") == 24, F.lit("NoInstitution")).otherwise(F.concat(F.lit("ror"), "n", F.lit("_Nation_"), "n"))
    folders = nations.select(F.concat(F.lit("d"), "n").alias("id"), label.alias("name"))
    customers = table(spark, d, "customer")

    def file_id(version: int):
        return F.concat(F.lit(f"f{version}-"), "n")

    def listing(version: int) -> DataFrame:
        # the folder of nation 23 holds a picture only
        rows = nations if version == 1 else nations.where("n < 12")
        kind = F.when(c("n") == 23, "image/png").otherwise(SPREADSHEET_TYPES[0])
        return rows.select(
            F.concat(F.lit("d"), "n").alias("folder_id"), file_id(version).alias("id"), F.concat(F.lit("staff_"), "n", F.lit(".xlsx")).alias("name"), kind.alias("mime_type"),
            F.lit(False).alias("trashed"), F.lit(f"2025-0{version}-01").alias("modified_time"), F.lit("1").alias("size"), F.lit(version).alias("position"),
        )

    def rows(version: int) -> DataFrame:
        some = customers.where("c_acctbal < 5000" if version == 1 else "c_acctbal > 0 and c_nationkey < 12")
        # a nation's customers are one small file
        place = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
        return some.select(c("c_nationkey").alias("n"), "c_custkey", place.alias("row_number")).select(file_id(version).alias("drive_file_id"), "row_number", "c_custkey")

    first = run_matrices(spark, folders, listing(1), rows(1), name, RUNS[0], keep_only_latest)
    both = rows(1).unionByName(rows(2))
    second = run_matrices(spark, folders, listing(1).unionByName(listing(2)), both, name, RUNS[1], keep_only_latest)
    outcomes = first.withColumn("run", F.lit("1")).unionByName(second.withColumn("run", F.lit("2")))
    return spark.table(name), outcomes


def _loaded(runs: tuple[DataFrame, DataFrame]) -> DataFrame:
    stored, outcomes = runs
    rows = stored.select("_id", "institution_id", "c_custkey", c("drive_modified_time").alias("note"))
    told = F.concat_ws(",", "folders", "processed", "skipped", "empty", "errors")
    return rows.unionByName(outcomes.select(c("run").alias("_id"), F.lit("outcomes").alias("institution_id"), F.lit(0).cast("long").alias("c_custkey"), told.alias("note")))


_ROW = "'ror' || n || ':f' || version || '-' || n || ':' || r AS _id, 'ror' || n AS institution_id, c_custkey, '2025-0' || version || '-01' AS note"
_OUTCOMES = """
    SELECT '1' AS _id, 'outcomes' AS institution_id, 0 AS c_custkey, '25,23,1,1,0' AS note UNION ALL SELECT '2', 'outcomes', 0, '25,12,12,1,0'
"""


@query(f"""
    SELECT {_ROW} FROM ({_FILE_ROWS}) WHERE n < 23 AND version = CASE WHEN n < 12 THEN 2 ELSE 1 END
    UNION ALL {_OUTCOMES}
""")
def matrix_load(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of institutional matrices: an institution whose folder has a newer file is replaced, the others stay."""
    return _loaded(_matrix_runs(spark, d, True))


@query(f"SELECT {_ROW} FROM ({_FILE_ROWS}) WHERE n < 23 UNION ALL {_OUTCOMES}")
def matrix_append(spark: SparkSession, d: str) -> DataFrame:
    """The same loads without replacing: rows of newer files come beside those of older ones."""
    return _loaded(_matrix_runs(spark, d, False))
