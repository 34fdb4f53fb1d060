"""Country cut, DOI matching and similarity on the given tables.

A work is a row of lineitem: its id is order and line, its authorships come from
the order's customer and the line's supplier, its locations are the line's
supplier and part. Lines that repeat an id are duplicate works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.catalogue.registry import query, table
from acervo.functions.doi import page_dois
from acervo.functions.predicates import in_country
from acervo.functions.similarity import accepted, author_similarity, title_similarity
from acervo.functions.text import fold_text, strip_markup
from acervo.operators.dedup import distinct_nested
from acervo.operators.joins import referenced
from acervo.operators.retrieval import top_candidates
from acervo.plans.country_cut import (
    DoiInputs,
    best_matches,
    country_route,
    cut,
    doi_route,
    raw_dois,
    source_route,
    unique_works,
    wanted_dois,
)

COUNTRY = "N7"
LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def _country(key: str):
    return F.concat(F.lit("N"), F.col(key))


def _work_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id")


def authored_works(spark: SparkSession, d: str, *extra: str | Column) -> DataFrame:
    customer = table(spark, d, "customer")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, d, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # orders meet their customers first, so that the far more numerous lines move by their order only
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    whole = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    author = F.struct(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"), F.col("c_name").alias("display_name"))
    countries = F.when(F.col("o_orderstatus") != "P", F.array(_country("c_nationkey")))
    authorship = F.struct(
        author.alias("author"),
        countries.alias("countries"),
        F.array(F.struct(_country("s_nationkey").alias("country_code"))).alias("institutions"),
    )
    return whole.select(_work_id(), *extra, F.array(authorship).alias("authorships"))


def work_locations() -> Column:
    """The places of a line: its supplier and its part."""

    def location(prefix: str, key: str):
        return F.struct(F.struct(F.concat(F.lit(prefix), F.col(key)).alias("id")).alias("source"))

    return F.array(location("S", "l_suppkey"), location("P", "l_partkey")).alias("locations")


def located_works(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    return table(spark, d, "lineitem").select(_work_id(), *extra, work_locations())


def journal_sources(spark: SparkSession, d: str) -> DataFrame:
    suppliers = table(spark, d, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"), _country("s_nationkey").alias("country_code")
    )
    parts = table(spark, d, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("id"), _country("p_size").alias("country_code")
    )
    return suppliers.unionByName(parts)


_BY_AUTHOR = """
    SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey, c_custkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE s_nationkey = 7 OR (o_orderstatus <> 'P' AND c_nationkey = 7)
"""
_BY_SOURCE = """
    SELECT DISTINCT l_orderkey || '-' || l_linenumber AS id FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 7)
       OR l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)
"""


@query(f"SELECT id, l_partkey FROM ({_BY_AUTHOR})")
def cut_nested_predicate(spark: SparkSession, d: str) -> DataFrame:
    works = authored_works(spark, d, "l_partkey")
    return works.where(in_country(F.col("authorships"), COUNTRY)).select("id", "l_partkey")


@query(f"SELECT id, 'source' AS route FROM ({_BY_SOURCE})")
def cut_by_source_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return source_route(located_works(spark, d), journal_sources(spark, d), COUNTRY)


@query(f"""
    WITH a AS (SELECT DISTINCT id FROM ({_BY_AUTHOR})), s AS ({_BY_SOURCE}),
    routes AS (
        SELECT id, string_agg(route, '|' ORDER BY route) AS routes
        FROM (SELECT id, 'authorship' AS route FROM a UNION ALL SELECT id, 'source' FROM s) GROUP BY id),
    works AS (
        SELECT l_orderkey || '-' || l_linenumber AS id, {', '.join(LINE_ORDER)},
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn
        FROM lineitem)
    SELECT id, {', '.join(LINE_ORDER)}, routes FROM works JOIN routes USING (id) WHERE rn = 1
""")
def cut_union_routes(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "lineitem").select(_work_id(), *LINE_ORDER)
    routes = [
        country_route(authored_works(spark, d), COUNTRY),
        source_route(located_works(spark, d), journal_sources(spark, d), COUNTRY),
    ]
    kept = cut(works, routes, [F.col(c) for c in LINE_ORDER])
    return kept.select("id", *LINE_ORDER, F.array_join("routes", "|").alias("routes"))


@query(f"SELECT 'C' || c_custkey AS id, c_name FROM customer WHERE c_custkey IN (SELECT c_custkey FROM ({_BY_AUTHOR}))")
def referenced_closure(spark: SparkSession, d: str) -> DataFrame:
    works = authored_works(spark, d).where(in_country(F.col("authorships"), COUNTRY))
    authors = table(spark, d, "customer").select(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"), "c_name")
    return referenced(authors, "id", distinct_nested(works, "authorships", "author.id", "id"))


@query(f"""
    SELECT id, {', '.join(LINE_ORDER)} FROM (
        SELECT l_orderkey || '-' || l_linenumber AS id, {', '.join(LINE_ORDER)},
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn
        FROM lineitem) WHERE rn = 1
""")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "lineitem").select(_work_id(), *LINE_ORDER)
    return unique_works(works, [F.col(c) for c in LINE_ORDER])


# -- DOI matching ------------------------------------------------------------


def _sql_doi(text: str) -> str:
    found = rf"regexp_extract(lower({text}), '10\.\d{{3,}}/\S+')"
    cut_all = rf"""regexp_replace({found}, '[.,;:"''>\]}})]+$', '')"""
    cut_open = rf"""regexp_replace({found}, '[.,;:"''>\]}}]+$', '')"""
    clean = f"CASE WHEN contains({found}, '(') THEN {cut_open} ELSE {cut_all} END"
    return rf"CASE WHEN regexp_matches({clean}, '^10\.\d{{3,}}/\S') THEN 'https://doi.org/' || ({clean}) END"


def doi_inputs(spark: SparkSession, d: str) -> DoiInputs:
    """Seven DOI sources with the mixed spellings of real ones."""
    text = F.col("text")
    c = F.col
    documents = table(spark, d, "documents").select(
        F.when(c("lang") == "en", F.concat(F.lit(" doi:10.5555/DOC."), c("doc_id"), F.lit(" ")))
        .when(c("lang") == "fr", "")
        .when(c("lang") == "es", "no identifier")
        .alias("doi")
    )
    part = table(spark, d, "part")
    orders = table(spark, d, "orders")
    customer = table(spark, d, "customer")
    supplier = table(spark, d, "supplier")

    def field(element: str, qualifier: str, text=text):
        return F.struct(F.lit(element).alias("element"), F.lit(qualifier).alias("qualifier"), text.alias("text"))

    return DoiInputs(
        scholar=documents,
        products=part.select(
            F.concat(F.lit("HTTP://dx.doi.org/10."), c("p_size") + 1000, F.lit("/P"), c("p_partkey"), F.lit(".")).alias("TXT_DOI")
        ),
        scopus=orders.select(F.concat(F.lit("https://doi.org/10.7777/Cust("), c("o_custkey"), F.lit(")")).alias("DOI")),
        wos=customer.select(
            F.when(c("c_acctbal") < 0, "").otherwise(F.concat(F.lit("10.7777/CUST("), c("c_custkey"), F.lit(");"))).alias("DI")
        ),
        repositories=part.select(
            F.array(
                field("identifier", "uri", F.lit("10.9999/uri")),
                field("identifier", "doi", F.concat(F.lit("10.5555/Type."), c("p_type"))),
                field("identifier", "doi", F.lit(None).cast("string")),
            ).alias("fields")
        ),
        matrices=supplier.select(
            F.when(c("s_acctbal") > 0, F.concat(F.lit("10.12/x"), c("s_suppkey")))
            .otherwise(F.concat(F.lit("DOI: 10.4444/s"), c("s_suppkey"), F.lit("),")))
            .alias("doi")
        ),
        profiles=table(spark, d, "pages").select(
            F.concat(
                "html",
                F.lit('<a href="https://doi.org/10.8888/Page.'), c("page_id"),
                F.lit("\">(10.8888/PAGE."), c("page_id"), F.lit(")</a>"),
            ).alias("html")
        ),
    )


_PAGE_TEXT = """html || '<a href="https://doi.org/10.8888/Page.' || page_id || '">(10.8888/PAGE.' || page_id || ')</a>'"""
_PAGE_DOIS = rf"""
    SELECT DISTINCT page_id, {_sql_doi('raw')} AS doi
    FROM (SELECT page_id, unnest(regexp_extract_all({_PAGE_TEXT}, '(?i)10\.\d{{3,}}/[^\s"''<]+')) AS raw FROM pages)
"""
_RAW_DOIS = f"""
    SELECT ' doi:10.5555/DOC.' || doc_id || ' ' AS raw FROM documents WHERE lang = 'en'
    UNION ALL SELECT 'no identifier' FROM documents WHERE lang = 'es'
    UNION ALL SELECT 'HTTP://dx.doi.org/10.' || (p_size + 1000) || '/P' || p_partkey || '.' FROM part
    UNION ALL SELECT 'https://doi.org/10.7777/Cust(' || o_custkey || ')' FROM orders
    UNION ALL SELECT '10.7777/CUST(' || c_custkey || ');' FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT '10.5555/Type.' || p_type FROM part
    UNION ALL SELECT CASE WHEN s_acctbal > 0 THEN '10.12/x' || s_suppkey ELSE 'DOI: 10.4444/s' || s_suppkey || '),' END FROM supplier
    UNION ALL SELECT doi FROM ({_PAGE_DOIS})
"""


@query(f"""
    SELECT DISTINCT doi FROM (SELECT {_sql_doi('raw')} AS doi FROM ({_RAW_DOIS})) WHERE doi IS NOT NULL
    EXCEPT SELECT 'https://doi.org/10.7777/cust(' || o_custkey || ')' FROM orders WHERE o_orderstatus = 'F'
""")
def multi_source_key_union(spark: SparkSession, d: str) -> DataFrame:
    present = table(spark, d, "orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("https://doi.org/10.7777/cust("), F.col("o_custkey"), F.lit(")")).alias("doi")
    )
    return wanted_dois(raw_dois(doi_inputs(spark, d))).join(present, "doi", "left_anti")


@query(f"""
    WITH wanted AS (SELECT DISTINCT {_sql_doi('raw')} AS doi FROM ({_RAW_DOIS})),
    works AS (SELECT o_orderkey AS id, 'https://doi.org/10.7777/cust(' || o_custkey || ')' AS doi FROM orders),
    present AS (SELECT 'https://doi.org/10.7777/cust(' || o_custkey || ')' AS doi FROM orders WHERE o_totalprice > 450000)
    SELECT min(id) AS id, 'doi' AS route FROM works
    WHERE doi IN (SELECT doi FROM wanted) AND doi NOT IN (SELECT doi FROM present) GROUP BY doi
""")
def doi_key_join(spark: SparkSession, d: str) -> DataFrame:
    doi = F.concat(F.lit("https://doi.org/10.7777/cust("), F.col("o_custkey"), F.lit(")")).alias("doi")
    orders = table(spark, d, "orders")
    works = orders.select(F.col("o_orderkey").alias("id"), doi)
    present = orders.where("o_totalprice > 450000").select(doi)
    return doi_route(works, wanted_dois(raw_dois(doi_inputs(spark, d))), present)


@query(f"SELECT page_id, doi FROM ({_PAGE_DOIS}) WHERE doi IS NOT NULL")
def html_regex_extract(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(
        F.col("html"),
        F.lit('<a href="https://doi.org/10.8888/Page.'), F.col("page_id"),
        F.lit("\">(10.8888/PAGE."), F.col("page_id"), F.lit(")</a>"),
    )
    return table(spark, d, "pages").select("page_id", F.explode(page_dois(page)).alias("doi"))


# -- similarity ----------------------------------------------------------------

_SQL_TOKENS = r"""list_distinct(list_filter(regexp_split_to_array(
    replace(replace(strip_accents(lower(text)), 'ß', 'ss'), '.', ''), '[^\p{L}\p{N}]+'), lambda w: w <> ''))"""


@query(f"""
    WITH q AS (SELECT item_id AS q_id, unnest({_SQL_TOKENS}) AS token FROM benchmark),
    t AS (SELECT doc_id AS t_id, unnest({_SQL_TOKENS}) AS token FROM documents),
    w AS (SELECT token, CAST(round(ln(1 + (SELECT count(*) FROM documents) / count(*)), 6) AS DECIMAL(18, 6)) AS weight
          FROM t GROUP BY token),
    s AS (SELECT q_id, t_id, CAST(sum(weight) AS DOUBLE) AS score FROM q JOIN t USING (token) JOIN w USING (token) GROUP BY q_id, t_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, t_id) AS rank FROM s)
    SELECT q_id, t_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20
""")
def candidate_topk(spark: SparkSession, d: str) -> DataFrame:
    found = top_candidates(
        table(spark, d, "benchmark"), "item_id", "text", table(spark, d, "documents"), "doc_id", "text", 20
    )
    return found.select("q_id", "t_id", F.col("score").cast("double").alias("score"), "rank")


def _sql_fold(text: str) -> str:
    return f"replace(trim(replace(strip_accents(lower({text})), 'ß', 'ss')), '.', '')"


def _sql_masks(a: str, b: str) -> str:
    """For each letter of ``b`` the places in ``a`` where it stands, as bits; up to 120 letters."""
    here = f"CASE WHEN substr({a}, i::INTEGER + 1, 1) = substr({b}, j::INTEGER + 1, 1) THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END"
    return f"list_transform(range(length({b})), lambda j: list_sum(list_transform(range(length({a})), lambda i: {here}))::HUGEINT)"


def _sql_lcs(length: str, masks: str) -> str:
    """Longest common subsequence: bits of a row, one step for each letter of the other text."""
    full = f"((1::HUGEINT << ({length})::INTEGER) - 1)"
    step = f"lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}"
    return f"(({length}) - bit_count(list_reduce(list_prepend({full}, {masks}), {step})))"


def _sql_ratio(a: str, b: str) -> str:
    lcs = _sql_lcs(f"length({a})", _sql_masks(a, b))
    return f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE 200.0::DOUBLE * {lcs} / (length({a}) + length({b})) END)"


def _sql_partial(a: str, b: str) -> str:
    """Best window of ``b``, not the shorter one; ``masks`` are those of its letters in ``a``."""
    windows = f"list_transform(range(length({b}) - length({a}) + 1), lambda w: {_sql_lcs(f'length({a})', f'masks[w + 1:w + length({a})]')})"
    return f"(CASE WHEN length({a}) = 0 THEN 0 ELSE 100.0::DOUBLE * list_max({windows}) / length({a}) END)"


_SHORT_LONG = "CASE WHEN length(a) > length(b) THEN b ELSE a END AS short, CASE WHEN length(a) > length(b) THEN a ELSE b END AS long"


def _sql_title_scores(pairs: str) -> str:
    """``key, title_score`` for rows (key, a, b) of folded titles."""
    rest = "array_to_string(list_sort(list_filter(list_distinct({}), lambda w: NOT list_contains({}, w))), ' ')"
    both = lambda x, y: f"concat_ws(' ', nullif(common, ''), nullif({rest.format(x, y)}, ''))"
    words = lambda x: f"list_filter(string_split({x}, ' '), lambda w: w <> '')"
    alone = lambda u: f"190.0::DOUBLE * length(common) / (length(common) + length({u}))"
    return f"""
        SELECT key, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0 ELSE round_even(greatest(
            {_sql_ratio('a', 'b')}, 0.95::DOUBLE * {_sql_ratio('sa', 'sb')}, 0.95::DOUBLE * {_sql_ratio('ua', 'ub')},
            CASE WHEN common <> '' THEN greatest({alone('ua')}, {alone('ub')}) ELSE 0 END,
            CASE WHEN length(long) >= 1.5 * length(short) THEN 0.9::DOUBLE * {_sql_partial('short', 'long')} ELSE 0 END), 0) END::INTEGER AS title_score
        FROM (SELECT *, {_sql_masks('short', 'long')} AS masks, {both('wa', 'wb')} AS ua, {both('wb', 'wa')} AS ub
              FROM (SELECT *, array_to_string(list_sort(wa), ' ') AS sa, array_to_string(list_sort(wb), ' ') AS sb, {_SHORT_LONG},
                           array_to_string(list_sort(list_filter(list_distinct(wa), lambda w: list_contains(wb, w))), ' ') AS common
                    FROM (SELECT *, {words('a')} AS wa, {words('b')} AS wb FROM ({pairs}))))"""


def _sql_author_scores(pairs: str) -> str:
    """``key, author_score`` for rows (key, a, b) of folded names; the best of a key."""
    return f"""
        SELECT key, max(CASE WHEN short = '' THEN 0 ELSE round_even({_sql_partial('short', 'long')}, 0) END)::INTEGER AS author_score
        FROM (SELECT *, {_sql_masks('short', 'long')} AS masks FROM (SELECT key, {_SHORT_LONG} FROM ({pairs}))) GROUP BY key"""


def _sql_plain(html: str) -> str:
    """Text of a heading without tags."""
    for name, letter in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
        html = f"replace({html}, '{name}', {letter})"
    return rf"trim(regexp_replace({html}, '\s+', ' ', 'g'))"


_HEADING = "regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
_PAGE_NAMES = rf"""
    SELECT page_id, {_sql_plain(_HEADING)} AS heading, {_sql_plain(_TITLE)} AS title, regexp_extract(url, '^https?://(?:www\.|m\.)?([^/]+)', 1) AS site FROM pages
"""


def page_names(spark: SparkSession, d: str) -> DataFrame:
    """``page_id, heading, title, site`` of each page."""
    site = F.regexp_extract("url", r"^https?://(?:www\.|m\.)?([^/]+)", 1)
    heading = strip_markup(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1))
    title = strip_markup(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))
    return table(spark, d, "pages").select("page_id", heading.alias("heading"), title.alias("title"), site.alias("site"))


@query(_sql_title_scores(f"""
    SELECT p.page_id || ':next' AS key, {_sql_fold('p.title')} AS a, {_sql_fold('n.title')} AS b FROM ({_PAGE_NAMES}) p JOIN ({_PAGE_NAMES}) n ON n.page_id = p.page_id + 1
    UNION ALL SELECT page_id || ':site', {_sql_fold('title')}, {_sql_fold("replace(site, '.', ' ')")} FROM ({_PAGE_NAMES})
"""))
def title_scores(spark: SparkSession, d: str) -> DataFrame:
    """Each page's title against that of the next page, and against the words of its site."""
    site = fold_text(F.replace("site", F.lit("."), F.lit(" ")))
    pages = page_names(spark, d).select("page_id", fold_text(F.col("title")).alias("title"), site.alias("site"))
    following = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("title").alias("other"))
    pairs = pages.join(following, "page_id").select(F.concat("page_id", F.lit(":next")).alias("key"), "title", "other")
    pairs = pairs.unionByName(pages.select(F.concat("page_id", F.lit(":site")).alias("key"), "title", F.col("site").alias("other")))
    return pairs.select("key", title_similarity(F.col("title"), F.col("other")).alias("title_score"))


@query(_sql_author_scores(f"""
    SELECT p.page_id AS key, {_sql_fold('p.site')} AS a, {_sql_fold('n.site')} AS b FROM ({_PAGE_NAMES}) p JOIN ({_PAGE_NAMES}) n ON n.page_id IN (p.page_id + 1, p.page_id + 2)
    UNION ALL SELECT page_id, {_sql_fold('site')}, {_sql_fold('title')} FROM ({_PAGE_NAMES})
"""))
def author_scores(spark: SparkSession, d: str) -> DataFrame:
    """Each page's site against the sites of the next two pages and its own title, as names."""
    pages = page_names(spark, d).select("page_id", fold_text(F.col("title")).alias("title"), fold_text(F.col("site")).alias("site"))
    others = [pages.select((F.col("page_id") - n).alias("page_id"), F.col("site").alias("name")) for n in (1, 2)]
    named = others[0].unionByName(others[1]).unionByName(pages.select("page_id", F.col("title").alias("name")))
    names = named.groupBy("page_id").agg(F.collect_list("name").alias("names"))
    return pages.join(names, "page_id").select(F.col("page_id").alias("key"), author_similarity(F.col("site"), F.col("names")).alias("author_score"))


def _sql_fields(text: str) -> str:
    """Tokens of a text, and of the site as those of an author."""
    of = lambda column: _SQL_TOKENS.replace("lower(text)", f"lower({column})")
    return f"list_concat({of(text)}, list_transform({of('site')}, lambda w: '@' || w))"


@query(f"""
    WITH named_pages AS ({_PAGE_NAMES}),
    q AS (SELECT page_id AS q_id, unnest({_sql_fields('heading')}) AS token FROM named_pages),
    t AS (SELECT page_id AS t_id, unnest({_sql_fields('title')}) AS token FROM named_pages),
    w AS (SELECT token, CAST(round(ln(1 + (SELECT count(*) FROM pages) / count(*)), 6) AS DECIMAL(18, 6)) AS weight FROM t GROUP BY token),
    s AS (SELECT q_id, t_id, sum(weight) AS score FROM q JOIN t USING (token) JOIN w USING (token) GROUP BY q_id, t_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, t_id) AS rank FROM s QUALIFY rank <= 20),
    pairs AS (
        SELECT q_id || ':' || t_id AS key, q_id, t_id, rank, {_sql_fold('a.heading')} AS a, {_sql_fold('b.title')} AS b, {_sql_fold('a.site')} AS author, {_sql_fold('b.site')} AS name
        FROM r JOIN named_pages a ON a.page_id = q_id JOIN named_pages b ON b.page_id = t_id),
    titled AS ({_sql_title_scores('SELECT key, a, b FROM pairs')}),
    authored AS ({_sql_author_scores('SELECT key, author AS a, name AS b FROM pairs')})
    SELECT q_id AS product_key, t_id AS id, CAST(rank AS INTEGER) AS rank, title_score, author_score
    FROM pairs JOIN titled USING (key) JOIN authored USING (key)
    WHERE title_score >= CASE WHEN author_score >= 65 THEN 90 ELSE 94 END
    QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY rank) = 1
""")
def fuzzy_title_match(spark: SparkSession, d: str) -> DataFrame:
    """Page headings against page titles; the site of a page is its author."""
    pages = page_names(spark, d)
    products = pages.select(F.col("page_id").alias("product_key"), F.col("heading").alias("title"), F.col("page_id").alias("person_id"))
    profiles = pages.select(F.col("page_id").alias("person_id"), F.col("site").alias("name"))
    search = pages.select(F.col("page_id").alias("id"), "title", F.array(F.upper("site")).alias("authors"))
    return best_matches(products, profiles, search)


@query("""
    SELECT CAST(floor(l_quantity * 2) AS INTEGER) AS title_score, CAST(round(l_discount * 1000) AS INTEGER) AS author_score,
           CASE WHEN round(l_discount * 1000) >= 65 THEN floor(l_quantity * 2) >= 90 ELSE floor(l_quantity * 2) >= 94 END AS accepted,
           count(*) AS n
    FROM lineitem GROUP BY ALL
""")
def accept_rule(spark: SparkSession, d: str) -> DataFrame:
    scores = table(spark, d, "lineitem").select(
        F.floor(F.col("l_quantity") * 2).cast("int").alias("title_score"),
        F.round(F.col("l_discount") * 1000).cast("int").alias("author_score"),
    )
    verdict = accepted(F.col("title_score"), F.col("author_score")).alias("accepted")
    return scores.groupBy("title_score", "author_score", verdict).agg(F.count("*").alias("n"))
