"""Readers and writers on the given tables: each query writes rows out, maintains or loads them, and returns what is there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.plans.organisations import load_organisations
from acervo.plans.runner import run_sources
from acervo.plans.search_projection import write_search_table
from acervo.session import materialise, scratch_path
from acervo.sinks import catalog, checkpoints
from acervo.sinks.documents import compact_documents, stored_documents, upsert_documents
from acervo.sinks.workbook import write_workbooks
from acervo.sources.base import Source
from acervo.sources.batches import read_json_batches
from acervo.sources.long_lists import read_long_lists
from acervo.sources.paths import file_listing
from acervo.sources.ranking import read_ranking
from acervo.sources.tables import endpoint_registry, family_scan
from acervo.sources.workbook import as_variant, read_workbooks, workbook_columns, workbook_dois
from acervo.sources.wrapped import read_wrapped

c = F.col
RUN = datetime(2026, 1, 27, 14, 41, 5)


def namespace(spark: SparkSession, label: str) -> str:
    """A new catalog schema whose tables lie in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


def rename_parts(spark: SparkSession, folder: str, prefix: str, suffix: str) -> None:
    """Give the part files of a folder names that a reader looks for."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().toString() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-"))
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda n: fs.rename(path(parts[n]), path(f"{folder}/{prefix}{n}{suffix}")), range(len(parts))))


def tasks(spark: SparkSession) -> int:
    """Partitions for work that costs far more than its bytes suggest."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_texts(texts: DataFrame, folder: str, prefix: str, suffix: str) -> None:
    """Every text of the only column as a file, under a name that a reader looks for; tasks write what they hold."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for text in batch.column(0):
                with store.open_output_stream(f"{root.rstrip('/')}/{prefix}{task}_{n}{suffix}") as out:
                    out.write(f"{text.as_py()}\n".encode())
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["written"])

    materialise(texts.mapInArrow(write, "written long"), "written-texts")


@query("SELECT s_suppkey, s_name, s_suppkey // 40 AS batch FROM supplier")
def wrapped_json(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in packed files of one list each, forty to a file."""
    path = scratch_path(spark, "wrapped")
    batch = F.floor(c("s_suppkey") / 40).alias("batch")
    lists = table(spark, d, "supplier").groupBy(batch).agg(F.collect_list(F.struct("s_suppkey", "s_name")).alias("items"))
    lists.select(F.to_json(F.struct("batch", "items"))).write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    good, _ = read_wrapped(spark, f"{path}/*.gz")
    key = F.try_variant_get("raw", "$.s_suppkey", "bigint")
    return good.select(key.alias("s_suppkey"), F.try_variant_get("raw", "$.s_name", "string").alias("s_name"), F.floor(key / 40).alias("batch"))


@query("""
    SELECT 'ok' AS kind, c_custkey AS id, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT 'lost', count(*), NULL FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def json_batches(spark: SparkSession, d: str) -> DataFrame:
    """Customers as batch files of one record each; those of one segment are cut off and come back as rejects."""
    path = scratch_path(spark, "batches")
    whole = F.to_json(F.struct(c("c_custkey").alias("id"), "c_name"))
    line = F.when(c("c_mktsegment") == "BUILDING", F.substring(whole, 1, 9)).otherwise(whole)
    rows = table(spark, d, "customer").select(line, F.pmod("c_custkey", F.lit(3)).alias("folder"), c("c_mktsegment"))
    # a line that ends early ends its file, so damaged ones lie in files of their own
    rows.where("c_mktsegment <> 'BUILDING'").drop("c_mktsegment").write.partitionBy("folder").text(f"{path}/whole")
    rows.where("c_mktsegment = 'BUILDING'").drop("c_mktsegment", "folder").write.option("maxRecordsPerFile", 50).text(f"{path}/damaged")
    for n in range(3):
        rename_parts(spark, f"{path}/whole/folder={n}", f"article_batch_{n}_", ".json")
    rename_parts(spark, f"{path}/damaged", "article_batch_d_", ".json")
    good, rejects = read_json_batches(spark, path, "article")
    files = spark.read.option("recursiveFileLookup", "true").text(f"{path}/damaged").select(F.col("_metadata.file_path").alias("file_path"))
    lost = files.join(rejects.select("file_path").distinct(), "file_path", "left_semi").agg(F.count(F.lit(1)).alias("id"))
    return good.select(
        F.lit("ok").alias("kind"), F.try_variant_get("raw", "$.id", "bigint").alias("id"), F.try_variant_get("raw", "$.c_name", "string").alias("c_name")
    ).unionByName(lost.select(F.lit("lost").alias("kind"), "id", F.lit(None).cast("string").alias("c_name")))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def long_list(spark: SparkSession, d: str) -> DataFrame:
    """Customers in plain list files, cut at the braces and read by as many tasks as the files have ranges."""
    path = scratch_path(spark, "long")
    row = F.struct("c_custkey", F.struct("c_name", F.concat(F.lit("}{]["), "c_mktsegment").alias("segment")).alias("of"))
    lists = table(spark, d, "customer").groupBy(F.floor(c("c_custkey") / 200).alias("batch")).agg(F.collect_list(row).alias("items"))
    plain = F.when(c("batch") % 2 == 0, F.to_json(F.struct("batch", "items", c("items").alias("more")))).otherwise(F.to_json("items"))
    lists.select(plain).write.option("maxRecordsPerFile", 1).text(path)
    good, _ = read_long_lists(spark, path)
    get = lambda name, kind: F.try_variant_get("raw", f"$.{name}", kind)
    return good.select(get("c_custkey", "bigint").alias("c_custkey"), get("of.c_name", "string").alias("c_name"), F.substring(get("of.segment", "string"), 5, 99).alias("c_mktsegment"))


@query("""
    SELECT ['lines', 'array', 'envelope', 'single'][1 + s_nationkey % 4] AS shape, s_suppkey AS id, s_name FROM supplier
""")
def json_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers in batch files of all four shapes, one nation to a file: lines, an array, an object that wraps a list, single objects."""
    path = scratch_path(spark, "shapes")
    rows = table(spark, d, "supplier").select(c("s_suppkey").alias("id"), "s_name", "s_nationkey", F.element_at(F.array(*map(F.lit, ("lines", "array", "envelope", "single"))), (c("s_nationkey") % 4 + 1).cast("int")).alias("shape"))
    whole = F.struct("id", "s_name", "shape")
    lists = rows.groupBy("s_nationkey", "shape").agg(F.collect_list(whole).alias("data"))
    # what is no object in a list is passed by
    array = F.concat(F.lit("[1, null,\n"), F.substring(F.to_json("data"), 2, 1 << 30))
    texts = {
        "lines": lists.select(F.array_join(F.transform("data", lambda r: F.to_json(r)), "\n\n"), "shape"),
        "array": lists.select(array, "shape"),
        "envelope": lists.select(F.to_json(F.struct("s_nationkey", "data")), "shape"),
        "single": rows.repartition(tasks(spark)).select(F.concat(F.lit("\n"), F.replace(F.to_json(whole), F.lit(","), F.lit(",\n"))), "shape"),
    }
    for n, (shape, frame) in enumerate(texts.items()):
        write_texts(frame.where(c("shape") == shape).drop("shape"), f"{path}/{shape}", f"article_batch_{n}_", ".json")
    good, _ = read_json_batches(spark, path, "article")
    get = lambda name, kind: F.try_variant_get("raw", f"$.{name}", kind).alias(name)
    return good.select(get("shape", "string"), get("id", "bigint"), get("s_name", "string"))


@query("""
    SELECT p_partkey AS "Sourceid", p_name AS "Title", p_size AS "H index", 2023 AS year FROM part WHERE p_size > 3 AND p_partkey <> 0
""")
def ranking_csv(spark: SparkSession, d: str) -> DataFrame:
    """Parts as a ranking file: doubled rows and rows without a usable key do not come back."""
    path = scratch_path(spark, "ranking")
    parts = table(spark, d, "part")
    key = F.when(c("p_size") > 3, c("p_partkey").cast("string")).otherwise("-")
    rows = parts.select(key.alias("Sourceid"), c("p_name").alias("Title"), c("p_size").alias("H index"), F.lit(0).alias("copy"))
    doubled = rows.where("`H index` > 20").withColumns({"Title": F.lit("second"), "copy": F.lit(1)})
    rows.unionByName(doubled).coalesce(1).sortWithinPartitions("copy").drop("copy").write.option("header", True).option("sep", ";").csv(path)
    good, _ = read_ranking(spark, path, 2023)
    return good.select(c("Sourceid").cast("bigint").alias("Sourceid"), "Title", c("H index").cast("int").alias("H index"), "year")


@query("""
    SELECT 'dspace_a_records' AS table_name, c_custkey AS id, c_name AS name, NULL AS extra FROM customer
    UNION ALL SELECT 'dspace_b_records', s_suppkey, s_name, s_acctbal FROM supplier
""")
def table_family(spark: SparkSession, d: str) -> DataFrame:
    ns = namespace(spark, "family")
    table(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name")).write.saveAsTable(f"{ns}.dspace_a_records")
    table(spark, d, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_acctbal").alias("extra")).write.saveAsTable(f"{ns}.dspace_b_records")
    spark.range(3).write.saveAsTable(f"{ns}.other")
    return family_scan(spark, ns).select("table_name", "id", "name", "extra")


@query("SELECT o_orderpriority AS folder, count(*) AS files FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders) GROUP BY 1")
def path_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder by the folder they lie in; none is opened."""
    path = scratch_path(spark, "listing")
    orders = table(spark, d, "orders").select("o_orderkey", c("o_orderpriority").alias("priority"), c("o_orderstatus").alias("status"))
    orders.repartition(4, "priority", "status").write.partitionBy("priority", "status").parquet(path)
    folder = F.url_decode(F.regexp_extract("id", "priority=([^/]+)/", 1)).alias("folder")
    return file_listing(spark, path, "*.parquet").groupBy(folder).agg(F.countDistinct(F.regexp_extract("id", "status=([^/]+)/", 1)).alias("files"))


@query("SELECT r_name AS endpoint, true AS enabled FROM region WHERE r_regionkey <> 2")
def registry_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "registry")
    table(spark, d, "region").select(c("r_name").alias("endpoint"), (c("r_regionkey") != 2).alias("enabled")).write.json(path)
    return endpoint_registry(spark, path).select("endpoint", "enabled")


@query("""
    SELECT event_id::VARCHAR AS id, CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value,
           CASE WHEN event_type = 'click' THEN user_id ELSE user_id + 1 END AS user_id, CASE WHEN event_type = 'click' THEN 'late' END AS note
    FROM events
""")
def late_delivery(spark: SparkSession, d: str) -> DataFrame:
    """Three versions of the events, the oldest delivered last, then compacted: fields of later versions stay.

    One that is older still comes after the compaction, for the clicks only; its values are hidden.
    """
    path = scratch_path(spark, "late")
    events = table(spark, d, "events")

    def version(rows: DataFrame, day: str, *fields) -> DataFrame:
        raw = F.parse_json(F.to_json(F.struct(c("event_id").cast("string").alias("id"), *fields)))
        return rows.select(
            c("event_id").cast("string").alias("id"), raw.alias("raw"), F.lit(day).cast("date").alias("updated_date"), F.lit(day).alias("file_path"), F.lit(0).cast("long").alias("line_no")
        )

    newest = version(events.where("event_type = 'purchase'"), "2024-03-01", (c("value") * 2).alias("value"))
    middle = version(events.where("event_type <> 'click'"), "2024-02-01", (c("user_id") + 1).alias("user_id"))
    oldest = version(events, "2024-01-01", "value", "user_id", F.when(c("event_type") == "click", "late").alias("note"))
    for batch in (newest, middle, oldest):
        upsert_documents(spark, path, batch)
    compact_documents(spark, path, f"{path}-compact")
    upsert_documents(spark, f"{path}-compact", version(events.where("event_type = 'click'"), "2023-12-01", (c("value") * 3).alias("value")))
    get = lambda name, kind: F.try_variant_get("raw", f"$.{name}", kind).alias(name)
    return stored_documents(spark, f"{path}-compact").select("id", get("value", "double"), get("user_id", "bigint"), get("note", "string"))


@query("""
    SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 10
    UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey >= 20
""")
def table_truncate_append(spark: SparkSession, d: str) -> DataFrame:
    """A table is loaded, truncated and loaded anew, and appended to."""
    name = f"{namespace(spark, 'load')}.t"
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    catalog.truncate_and_load(rows, name)
    catalog.truncate_and_load(rows.where("s_nationkey < 10"), name)
    catalog.append_load(rows.where("s_nationkey >= 20"), name)
    return spark.table(name).select("s_suppkey", "s_name")


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN upper(c_name) || '!' ELSE c_name END AS c_name, c_nationkey FROM customer WHERE c_nationkey <> 4
    UNION ALL SELECT c_custkey, 'new', 25 FROM customer WHERE c_nationkey = 4 AND c_acctbal > 0
""")
def table_swap(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table through an upsert, a swap and a replacement of partitions; it stays partitioned throughout."""
    name = f"{namespace(spark, 'swap')}.t"
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows.write.partitionBy("c_nationkey").saveAsTable(name)
    changed = rows.where("c_nationkey = 3").withColumn("c_name", F.concat(F.upper("c_name"), F.lit("!")))
    catalog.upsert_table(changed.unionByName(changed.withColumn("c_name", F.lit("~"))), name, ["c_custkey"], [c("c_name")])
    moved = table(spark, d, "customer").where("c_nationkey = 4 and c_acctbal > 0").select("c_custkey", F.lit("new").alias("c_name"), F.lit(25).alias("c_nationkey"))
    catalog.replace_partitions(moved, name, "c_nationkey", spark.createDataFrame([(4,), (25,)], "c_nationkey int"))
    catalog.build_then_swap(spark.table(name), name)
    assert catalog.partition_columns(spark, name) == ["c_nationkey"]
    return spark.table(name).select("c_custkey", "c_name", "c_nationkey")


@query("""
    SELECT way, key, name FROM (
        SELECT 'copy' AS way, r_regionkey AS key, r_name AS name FROM region
        UNION ALL SELECT unnest(['backup', 'archive', 'export']), n_nationkey, n_name FROM nation
        UNION ALL SELECT 'reset', n_nationkey, n_name FROM nation WHERE n_regionkey = 1)
""")
def table_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """The rows found after copying, backing up, archiving and exporting the tables of a schema, and after a reset and a new load."""
    ns = namespace(spark, "life")
    table(spark, d, "region").withColumn("_id", F.lit(1)).write.saveAsTable(f"{ns}.topics")
    nations = table(spark, d, "nation").withColumn("_id", F.lit(1))
    nations.write.saveAsTable(f"{ns}.nation")
    catalog.copy_auxiliary(spark, ns, f"{ns}_copy")
    saved = catalog.backup(spark, f"{ns}.nation", RUN)
    exported = catalog.export(spark.table(f"{ns}.nation"), scratch_path(spark, "export"), "nation", RUN)
    kept = catalog.archive(spark, ns, RUN)
    # a second archive of the month takes the first one's place
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")
    nations.write.saveAsTable(f"{ns}.nation")
    catalog.archive(spark, ns, RUN)
    fresh = namespace(spark, "fresh")
    nations.write.saveAsTable(f"{fresh}.nation")
    catalog.reset(spark, fresh)
    catalog.append_load(nations.where("n_regionkey = 1"), f"{fresh}.nation")
    if "_id" in spark.table(f"{kept}.nation").columns:
        raise ValueError("an archive keeps no row numbers")
    found = {"backup": spark.table(f"{kept}.{saved.split('.')[1]}"), "archive": spark.table(f"{kept}.nation"), "export": spark.read.parquet(exported), "reset": spark.table(f"{fresh}.nation")}
    rows = spark.table(f"{ns}_copy.topics").select(F.lit("copy").alias("way"), c("r_regionkey").alias("key"), c("r_name").alias("name"))
    for way, frame in found.items():
        rows = rows.unionByName(frame.select(F.lit(way).alias("way"), c("n_nationkey").alias("key"), c("n_name").alias("name")))
    return rows


@query("""
    SELECT o_custkey AS key, year(o_orderdate)::INTEGER AS year, min(o_orderkey) AS o_orderkey FROM orders WHERE year(o_orderdate) = 1996 GROUP BY ALL
    UNION ALL SELECT o_custkey, year(o_orderdate)::INTEGER, o_orderkey FROM orders WHERE year(o_orderdate) = 1997
""")
def clean_surplus_year(spark: SparkSession, d: str) -> DataFrame:
    """One year of orders has more rows than keys and is reduced to the first of each; the next year is left alone."""
    name = f"{namespace(spark, 'surplus')}.t"
    rows = table(spark, d, "orders").select(c("o_custkey").alias("key"), "o_orderkey", F.year("o_orderdate").alias("year")).where("year in (1996, 1997)")
    rows.write.partitionBy("year").saveAsTable(name)
    catalog.clean_surplus(spark, name, 1996, "key", ["o_orderkey"], 1)
    return spark.table(name).select("key", "year", "o_orderkey")


@query("""
    SELECT 'replace' AS way, c_custkey::VARCHAR AS id, c_name AS name FROM customer
    UNION ALL SELECT 'truncate', CASE WHEN s_nationkey <> 3 THEN s_suppkey::VARCHAR END, s_name FROM supplier
""")
def organisations_file(spark: SparkSession, d: str) -> DataFrame:
    """Organisation dumps of many list files: one whose records all have a key is loaded by key, twice; one without is loaded whole."""
    path = scratch_path(spark, "organisations")

    def write(rows: DataFrame, folder: str) -> str:
        # five hundred records to a list, a file for each list, written by many tasks
        lists = rows.groupBy("batch").agg(F.collect_list(F.struct("id", "name")).alias("items"))
        texts = lists.select(F.to_json("items").alias("value")).repartition(tasks(spark))
        texts.write.option("maxRecordsPerFile", 1).text(f"{path}/{folder}")
        return f"{path}/{folder}/*.txt"

    customers = table(spark, d, "customer").select(c("c_custkey").cast("string").alias("id"), c("c_name").alias("name"), F.floor(c("c_custkey") / 500).alias("batch"))
    missing = F.when(c("s_nationkey") != 3, c("s_suppkey").cast("string"))
    suppliers = table(spark, d, "supplier").select(missing.alias("id"), c("s_name").alias("name"), F.floor(c("s_suppkey") / 500).alias("batch"))
    by_key, whole = f"org_{uuid.uuid4().hex}", f"org_{uuid.uuid4().hex}"
    files = write(customers, "keyed")
    for _ in range(2):
        load_organisations(spark, files, by_key, "stage", RUN)
    load_organisations(spark, write(suppliers, "whole"), whole, "stage", RUN)
    get = lambda name: F.try_variant_get("raw", f"$.{name}", "string").alias(name)
    replaced = spark.table(f"{by_key}.stage").select(F.lit("replace").alias("way"), "id", get("name"))
    return replaced.unionByName(spark.table(f"{whole}.stage").select(F.lit("truncate").alias("way"), get("id"), get("name")))


@query("SELECT c_nationkey::VARCHAR AS source_id, max(c_custkey)::VARCHAR AS last_value FROM customer GROUP BY 1")
def checkpoint_values(spark: SparkSession, d: str) -> DataFrame:
    """The last value of each source, from a table that keeps them all."""
    name = f"{namespace(spark, 'checkpoint')}.t"
    seen = table(spark, d, "customer").select(
        c("c_nationkey").cast("string").alias("source_id"), c("c_custkey").cast("string").alias("last_value"), F.timestamp_seconds("c_custkey").cast("timestamp_ntz").alias("saved_at")
    )
    seen.write.saveAsTable(name)
    return checkpoints.last_values(spark, name)


@query("""
    SELECT 'regions' AS source, r_regionkey AS id, r_name AS name FROM region
    UNION ALL SELECT 'nations', n_regionkey, max(n_name) FROM nation GROUP BY n_regionkey
""")
def source_runner(spark: SparkSession, d: str) -> DataFrame:
    """Three sources run twice: one that fails and one whose keys repeat do not stop or double the others."""
    ns = namespace(spark, "runner")
    nothing = spark.createDataFrame([], "line string")

    def fails(_: SparkSession):
        raise OSError("unreachable")

    regions = table(spark, d, "region").select(c("r_regionkey").alias("id"), c("r_name").alias("name"))
    nations = table(spark, d, "nation").select(c("n_regionkey").alias("id"), c("n_name").alias("name"))
    sources = [
        Source("regions", ("id",), "upsert", lambda _: (regions, nothing)),
        Source("broken", ("id",), "truncate", fails),
        Source("nations", ("id",), "replace", lambda _: (nations, nothing), order=("name desc",)),
    ]
    for _ in range(2):
        run_sources(spark, sources, ns, RUN)
    parts = [spark.table(f"{ns}.{n}").select(F.lit(n).alias("source"), "id", "name") for n in ("regions", "nations")]
    return parts[0].unionByName(parts[1])


@query(r"""
    SELECT doc_id::VARCHAR AS id, lang AS source, n_chars::VARCHAR AS year, source AS authors,
           md5(trim(regexp_replace(regexp_replace(text, '</?[A-Za-z!][^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS title_md5
    FROM documents WHERE source <> 'src3'
""")
def search_table_file(spark: SparkSession, d: str) -> DataFrame:
    """The search table written in key ranges and read back; a whole text is the title."""
    path = scratch_path(spark, "search")
    void = F.lit(None).cast("string")
    works = table(spark, d, "documents").select(
        c("doc_id").cast("string").alias("id"),
        F.when(c("source") != "src3", c("text")).alias("title"),
        F.struct(F.struct(c("lang").alias("display_name")).alias("source")).alias("primary_location"),
        c("n_chars").alias("publication_year"),
        F.struct(*[void.alias(n) for n in ("volume", "issue", "first_page", "last_page")]).alias("biblio"),
        F.array(F.struct(F.struct(c("source").alias("display_name")).alias("author"))).alias("authorships"),
    )
    write_search_table(works, path, 4)
    return spark.read.parquet(path).select("id", "source", "year", F.array_join("authors", "|").alias("authors"), F.md5("title").alias("title_md5"))


def _order_books(spark: SparkSession, d: str, folder: str) -> DataFrame:
    """Orders as workbooks, with a header that repeats a name and a cover sheet before the rows."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", c("o_orderdate").cast("date"), F.when(c("o_orderstatus") != "P", c("o_orderstatus") == "F").alias("done"),
        F.concat(F.lit('<a & "b">  '), "o_orderpriority", F.lit("\n ")).alias("note"),
    )
    return write_workbooks(orders.repartition(tasks(spark)), folder, ["key", "status", "price", "day", "done", "status"], cover="cover")


_ORDERS_READ = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS o_orderdate,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS done, '<a & "b">  ' || o_orderpriority || chr(10) || ' ' AS note FROM orders
"""


@query(f"SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS day, done, note FROM ({_ORDERS_READ})")
def workbook_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders through workbooks, read as texts from a named sheet; the repeated header got a name of its own."""
    folder = scratch_path(spark, "workbooks")
    _order_books(spark, d, folder)
    rows, rejects = read_workbooks(spark, folder, sheet="rows")
    if not rejects.isEmpty():
        raise ValueError("a workbook that was just written cannot be read")
    texts = workbook_columns(rows, ["key", "status", "price", "day", "done", "status_2"])
    return texts.select(
        c("key").cast("bigint"), "status", c("price").cast("double"), F.to_date(F.substring("day", 1, 10)).alias("day"), c("done").cast("boolean"), c("status_2").alias("note")
    )


@query(f"SELECT o_orderkey AS key, o_totalprice AS price, o_orderdate AS day, done FROM ({_ORDERS_READ})")
def workbook_typed(spark: SparkSession, d: str) -> DataFrame:
    """The same workbooks as documents of typed values, from the active sheet."""
    folder = scratch_path(spark, "workbooks")
    _order_books(spark, d, folder)
    raw = as_variant(read_workbooks(spark, folder, typed=True)[0])
    get = lambda name, kind: F.try_variant_get("raw", f"$.{name}", kind).alias(name)
    return raw.select(get("key", "bigint"), get("price", "double"), F.to_date(F.substring(get("day", "string"), 1, 10)).alias("day"), get("done", "boolean"))


@query("""
    SELECT '10.5555/' || event_type || '.' || event_id AS doi FROM events WHERE event_type <> 'view'
""")
def workbook_doi_list(spark: SparkSession, d: str) -> DataFrame:
    """DOIs from the column of that name in a folder of workbooks; rows without one are left out."""
    folder = scratch_path(spark, "doi-workbooks")
    doi = F.when(c("event_type") != "view", F.concat(F.lit("10.5555/"), "event_type", F.lit("."), "event_id")).alias("doi")
    write_workbooks(table(spark, d, "events").select("event_id", doi), folder)
    return workbook_dois(spark, folder)
