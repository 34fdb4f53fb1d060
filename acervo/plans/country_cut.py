"""Country cut: works of a country by four routes, and the authors they refer to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.functions.doi import normalise_doi, page_dois
from acervo.functions.predicates import (
    SENTINEL_PRODUCT,
    bibliographic,
    has_text,
    identifier_values,
    in_country,
    not_blank_or_null_passes,
    present_number,
    searchable,
)
from acervo.functions.similarity import TITLE_WITH_AUTHOR, accepted, author_similarity, title_similarity
from acervo.functions.text import fold_text
from acervo.operators.dedup import distinct_nested, first_per_key
from acervo.operators.joins import first_match_lookup, hot_buckets, id_bitmaps, ids_by_nested_key, possible, referenced, spread_join
from acervo.operators.retrieval import top_candidates
from acervo.session import materialise, scratch_run, shuffles_released
from acervo.sinks.catalog import build_then_swap, copy_auxiliary, truncate_and_load


def _route(ids: DataFrame, name: str) -> DataFrame:
    return ids.select("id", F.lit(name).alias("route"))


def country_route(works: DataFrame, country: str) -> DataFrame:
    """Works with an authorship of the country."""
    return _route(works.where(in_country(F.col("authorships"), country)), "authorship")


def source_route(works: DataFrame, sources: DataFrame, country: str) -> DataFrame:
    """Works with any location in a source of the country."""
    of_country = sources.where((F.col("country_code") == country) & has_text(F.col("id")))
    keys = of_country.select(F.col("id").alias("source_id"))
    location_ids = F.col("locations.source.id")
    return _route(ids_by_nested_key(works, "id", location_ids, keys, "source_id"), "source")


@dataclass(frozen=True)
class DoiInputs:
    """The DOI sources of a run; any of them may be missing."""

    scholar: DataFrame | None = None  # doi
    products: DataFrame | None = None  # TXT_DOI, the tables of all institutions
    scopus: DataFrame | None = None  # DOI
    wos: DataFrame | None = None  # DI
    repositories: DataFrame | None = None  # fields: array of (element, qualifier, text)
    matrices: DataFrame | None = None  # doi
    profiles: DataFrame | None = None  # html


def raw_dois(inputs: DoiInputs) -> DataFrame:
    """``(source, raw_doi)`` of all sources, each with its own rule for missing values."""

    def column(df: DataFrame, name: str, keep: Column, source: str) -> DataFrame:
        return df.where(keep).select(F.lit(source).alias("source"), F.col(name).alias("raw_doi"))

    def spread(df: DataFrame, values: Column, source: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.explode(values).alias("raw_doi"))

    c = F.col
    frames = []
    if inputs.scholar is not None:
        frames.append(column(inputs.scholar, "doi", not_blank_or_null_passes(c("doi")), "scholar"))
    if inputs.products is not None:
        frames.append(column(inputs.products, "TXT_DOI", has_text(c("TXT_DOI")), "products"))
    if inputs.scopus is not None:
        frames.append(column(inputs.scopus, "DOI", c("DOI").isNotNull(), "scopus"))
    if inputs.wos is not None:
        frames.append(column(inputs.wos, "DI", has_text(c("DI")), "wos"))
    if inputs.repositories is not None:
        frames.append(spread(inputs.repositories, identifier_values(c("fields")), "repositories"))
    if inputs.matrices is not None:
        frames.append(column(inputs.matrices, "doi", c("doi").isNotNull(), "matrices"))
    if inputs.profiles is not None:
        frames.append(spread(inputs.profiles, page_dois(c("html")), "profiles"))
    if not frames:
        raise ValueError("no DOI source given")
    return reduce(DataFrame.unionByName, frames)


def wanted_dois(raw: DataFrame) -> DataFrame:
    """Distinct normalised DOIs."""
    return raw.select(normalise_doi(F.col("raw_doi")).alias("doi")).where("doi is not null").distinct()


def doi_route(works: DataFrame, dois: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """One work per wanted DOI, the smallest id, skipping DOIs of works already ``present``."""
    if present is not None:
        dois = dois.join(present.select("doi").where("doi is not null").distinct(), "doi", "left_anti")
    dois = materialise(dois, "missing-dois")
    # only works that may have a wanted DOI move, and only those that have one reach the aggregate
    near = possible(works.select("id", "doi"), "doi", materialise(id_bitmaps(dois, "doi"), "missing-bitmaps"))
    wanted = near.join(dois, "doi", "left_semi")
    return _route(wanted.groupBy("doi").agg(F.min("id").alias("id")), "doi")


def bibliographic_products(products: DataFrame) -> DataFrame:
    """One row per product id; rows of the all-zero id are different products and all stay."""
    usable = products.where(F.col("title").isNotNull() & bibliographic(F.col("product_type")))
    sentinel = F.coalesce(F.col("product_id") == SENTINEL_PRODUCT, F.lit(False))
    single = first_per_key(usable.where(~sentinel), ["product_id"], [F.col(c) for c in sorted(usable.columns)])
    return single.unionByName(usable.where(sentinel))


def similar_pairs(
    products: DataFrame, profiles: DataFrame, search: DataFrame, k: int = 20
) -> DataFrame:
    """``(product_key, id, rank, title_score, author_score)`` of the accepted candidates.

    products: product_key (unique), title, person_id; profiles: person_id, name;
    search: id, title, authors.
    """
    with_author = first_match_lookup(products, profiles.select("person_id", F.col("name").alias("author")), "person_id", ["author"], [F.col("author")])
    asked = with_author.where(searchable(F.col("title"), F.col("author")))
    # the index is asked by title and author
    named = asked.withColumn("asked_names", F.array("author"))
    candidates = materialise(
        top_candidates(named, "product_key", "title", search, "id", "title", k, "asked_names", "authors"), "candidates"
    )
    # each title is folded once, not once per pair, and only if it is a candidate
    queries = asked.select(
        F.col("product_key").alias("q_id"),
        fold_text(F.col("title")).alias("q_title"),
        fold_text(F.col("author")).alias("author"),
    )
    found = referenced(search.withColumnRenamed("id", "t_id"), "t_id", candidates).select(
        "t_id", fold_text(F.col("title")).alias("t_title"), F.transform("authors", fold_text).alias("authors")
    )
    pairs = candidates.join(queries, "q_id").join(found, "t_id")
    # scoring costs far more than its bytes suggest: a fixed number of partitions
    # keeps adaptive execution from gathering the pairs in a few tasks
    tasks = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    titled = pairs.repartition(tasks, "q_id", "t_id").select(
        F.col("q_id").alias("product_key"),
        F.col("t_id").alias("id"),
        "rank",
        "author",
        "authors",
        title_similarity(F.col("q_title"), F.col("t_title"), TITLE_WITH_AUTHOR).alias("title_score"),
    )
    # below this no author can help, so names are compared for the few pairs that are left
    near = titled.where(F.col("title_score") >= TITLE_WITH_AUTHOR)
    scored = near.select("product_key", "id", "rank", "title_score", author_similarity(F.col("author"), F.col("authors")).alias("author_score"))
    return scored.where(accepted(F.col("title_score"), F.col("author_score")))


def first_accepted(pairs: DataFrame) -> DataFrame:
    """The best-ranked accepted candidate of each product."""
    return first_per_key(pairs, ["product_key"], [F.col("rank")])


def best_matches(products: DataFrame, profiles: DataFrame, search: DataFrame, k: int = 20) -> DataFrame:
    """The best-ranked accepted one of the ``k`` candidates of each product, as ``first_accepted(similar_pairs(...))`` gives it.

    Most products need their best candidate only: the higher score to reach leaves far fewer pairs to judge than the k-th best one does.
    Those whose best candidate is not accepted are looked for again, among all ``k``.
    """
    best = materialise(first_accepted(similar_pairs(products, profiles, search, 1)), "best-matches")
    rest = materialise(products.join(best.select("product_key"), "product_key", "left_anti").select(*products.columns), "unmatched-products")
    if k == 1 or rest.isEmpty():
        return best
    return best.unionByName(first_accepted(similar_pairs(rest, profiles, search, k)))


def dois_present(works: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, doi)`` of the works whose id is ``found``; works that cannot be are left behind in the scan."""
    bitmaps = materialise(id_bitmaps(found, "id"), "found-bitmaps")
    return referenced(possible(works.select("id", "doi"), "id", bitmaps), "id", found)


def similar_route(products: DataFrame, profiles: DataFrame, search: DataFrame) -> DataFrame:
    matches = best_matches(products, profiles, search)
    return _route(matches.select("id").distinct(), "similarity")


def routes_by_work(routes: list[DataFrame]) -> DataFrame:
    """``(id, routes)``: the sorted routes that found a work, at most one entry per route."""
    found = reduce(DataFrame.unionByName, routes)
    return found.groupBy("id").agg(F.array_sort(F.collect_set("route")).alias("routes"))


def cut(works: DataFrame, routes: list[DataFrame], order: Sequence[Column] = ()) -> DataFrame:
    """Distinct works of any route, with the routes. Works that no route can have found are left behind in the scan.

    The routes are sent once for each work; only for ids that very many works share are they sent to several tasks.
    """
    wanted = materialise(routes_by_work(routes), "wanted-works")
    bitmaps = materialise(id_bitmaps(wanted, "id"), "wanted-bitmaps")
    return unique_works(spread_join(possible(works, "id", bitmaps), wanted, "id", hot=hot_buckets(works.select("id"), "id")), order)


def _content_hash(df: DataFrame) -> Column:
    """Hash over all columns; maps and VARIANT values count by their JSON text."""
    parts = [F.to_json(name) if "map<" in kind or "variant" in kind else F.col(name) for name, kind in df.dtypes]
    return F.xxhash64(*parts)


def unique_works(works: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """First work per id; by default in the order of a hash over the whole document."""
    return first_per_key(works, ["id"], list(order) or [_content_hash(works)])


def closure(authors: DataFrame, works: DataFrame) -> DataFrame:
    """Authors that occur in the works."""
    return referenced(authors, "id", distinct_nested(works, "authorships", "author.id", "id"))


def run_cut(
    spark: SparkSession,
    source: str,
    target: str,
    country: str,
    dois: DoiInputs | None = None,
    products: DataFrame | None = None,
    profiles: DataFrame | None = None,
    search: DataFrame | None = None,
) -> None:
    """All steps: routes, one join back to the works, authors, auxiliary tables. What a step leaves on disk goes with it."""
    with scratch_run(spark), shuffles_released(spark):
        works = spark.table(f"{source}.works").drop("_id")
        routes = [
            materialise(country_route(works, country), "authorship-route"),
            materialise(source_route(works, spark.table(f"{source}.sources"), country), "source-route"),
        ]
        if dois is not None:
            present = dois_present(works, reduce(DataFrame.unionByName, routes))
            routes.append(materialise(doi_route(works, wanted_dois(raw_dois(dois)), present), "doi-route"))
        if products is not None and profiles is not None and search is not None:
            routes.append(materialise(similar_route(products, profiles, search), "similarity-route"))
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
        build_then_swap(cut(works, routes), f"{target}.works")
        truncate_and_load(closure(spark.table(f"{source}.authors"), spark.table(f"{target}.works")), f"{target}.authors")
        copy_auxiliary(spark, source, target)
