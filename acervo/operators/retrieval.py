"""Exact top-k retrieval of titles, and their authors, by shared tokens.

Score of a pair is the sum of ``ln(1 + N/df)`` over the tokens both share; tokens of a title and of an author are
different fields. Matching on every token would pair each query with every title that has a common word. Instead:

1. Each title carries a bitmap of the commonest tokens, in bands of like weight, so what common tokens add to a
   pair is bounded by counting bits, without a join.
2. Each query is matched on its rarest tokens; the k most promising titles so found are scored in full. The
   least of these k scores is a floor: k titles reach it.
3. A query's commonest tokens whose weights together stay below the floor can never lift a title into the top k by themselves, so
   only the others are matched. A pair is judged under its rarest shared token: it has none of the query's rarer ones,
   so the tokens from there on, common ones by their bits, bound its score. What stays below the floor goes.
4. The pairs that are left are scored in full; those that reach the floor are ranked: k for each query, and ties.

Texts with the same tokens score alike, so equal titles, and equal queries, are
matched as one set and told apart at the end: thousands of titles "Editorial"
cost as much as one.

The result equals scoring all pairs; no document-frequency limit is set.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.functions.text import tokens
from acervo.operators.dedup import top_per_key
from acervo.session import materialise

WEIGHT = "decimal(18,6)"
#: Scores are summed as whole millionths.
UNIT = 1_000_000
#: Postings a query's leaders are found in, in multiples of k.
LEAD = 16
#: The commonest tokens, which titles carry as a bitmap: bands of so many bits.
BANDS, BITS = 32, 32
#: Marks an author's token; no token of a text has it.
AUTHOR = "@"
PAIR = ["q_id", "t_id"]


def _tokenised(df: DataFrame, key: str, words: Column, alias: str) -> DataFrame:
    """Sorted distinct tokens of each row, and a digest that names the set."""
    found = df.select(F.col(key).alias(alias), F.sort_array(words).alias("words"))
    return found.withColumn("digest", F.sha2(F.array_join("words", " "), 256))


def field_tokens(text: Column, authors: Column | None = None) -> Column:
    """Distinct tokens of a text, and of a list of names as a field of their own."""
    words = F.coalesce(tokens(text), F.array().cast("array<string>"))
    if authors is None:
        return words
    named = F.array_distinct(F.flatten(F.transform(F.filter(authors, lambda n: n.isNotNull()), lambda n: tokens(n))))
    marked = F.transform(named, lambda w: F.concat(F.lit(AUTHOR), w))
    return F.concat(words, F.coalesce(marked, F.array().cast("array<string>")))


def common_bound(bits: str, masks: str, tops: str) -> Column:
    """The most that common tokens can add: the bits that title and query share in a band, times the query's largest weight there."""
    return reduce(add, [F.bit_count(F.get(bits, F.lit(b)).bitwiseAND(F.get(masks, F.lit(b)))) * F.get(tops, F.lit(b)) for b in range(BANDS)])


def _scored(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """``q_id, t_id, score`` over all tokens, of pairs with the query's ``names`` and the title's ``words``."""
    shared = pairs.select(*PAIR, F.explode(F.array_intersect("names", "words")).alias("token"))
    return shared.join(weights.select("token", "weight"), "token").groupBy(*PAIR).agg(F.sum("weight").alias("score"))


def leading(terms: DataFrame, postings: DataFrame, asked: DataFrame, titles: DataFrame, k: int) -> DataFrame:
    """The k most promising titles of each query under the given terms: their own weights, and what the common tokens may add."""
    pairs = terms.select("q_id", "token", "rare_weight").join(postings, "token").groupBy(*PAIR).agg(F.sum("rare_weight").alias("rare"))
    both = pairs.join(titles.select("t_id", "bits"), "t_id").join(asked.select("q_id", "masks", "tops"), "q_id")
    return _ranked(both.select(*PAIR, (F.col("rare") + common_bound("bits", "masks", "tops")).alias("score")), k)


def reaching(judged: DataFrame, postings: DataFrame, asked: DataFrame, titles: DataFrame) -> DataFrame:
    """Pairs, with ``names`` and ``words``, that may reach the floor of their query; each is judged under its rarest shared token.

    ``judged``: the needed terms; ``asked``: q_id, names, masks, tops, floor (null: every pair is wanted).
    """
    pairs = judged.select("q_id", "token", "rare_reach").join(postings, "token").groupBy(*PAIR).agg(F.max("rare_reach").alias("rare_reach"))
    can = F.col("floor").isNull() | (F.col("rare_reach") + common_bound("bits", "masks", "tops") >= F.col("floor"))
    return pairs.join(titles, "t_id").join(asked, "q_id").where(can).select(*PAIR, "names", "words")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    return top_per_key(scores, ["q_id"], [F.desc("score"), F.asc("t_id")], k, "rank")


def common_tokens(weights: DataFrame) -> DataFrame:
    """``token, band, bit`` of the commonest tokens, the commonest first; at most BANDS x BITS rows."""
    first = weights.select("token", "df").orderBy(F.desc("df"), "token").limit(BANDS * BITS).collect()
    slots = [(row["token"], n // BITS, n % BITS) for n, row in enumerate(first)]
    return weights.sparkSession.createDataFrame(slots, "token long, band int, bit int")


def _bitmap() -> list[Column]:
    """Aggregates of (band, bit) rows: one number of BITS bits for each band."""
    return [F.coalesce(F.bit_or(F.when(F.col("band") == b, F.call_function("shiftleft", F.lit(1), F.col("bit")))), F.lit(0)) for b in range(BANDS)]


def query_terms(asked: DataFrame, weights: DataFrame, common: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per query its tokens, and the common ones as masks with the largest weight of each band; and a row per token.

    ``rarer_sets`` counts the postings of the query's rarer tokens, ``reach`` is what this and all commoner tokens can add,
    ``rare_reach`` that of those without a bit.
    """
    terms = asked.join(weights, "token").join(common, "token", "left")
    rare = F.when(F.col("band").isNull(), F.col("weight")).otherwise(F.lit(0).cast("long"))
    rare_first = W.partitionBy("q_id").orderBy("df", "token")  # one title's tokens
    onwards = rare_first.rowsBetween(0, W.unboundedFollowing)
    terms = terms.select(
        "q_id", "token", "weight", "band", "bit", "sets", rare.alias("rare_weight"),
        F.coalesce(F.sum("sets").over(rare_first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("rarer_sets"),
        F.sum("weight").over(onwards).alias("reach"),
        F.sum(rare).over(onwards).alias("rare_reach"),
    )
    tops = [F.coalesce(F.max(F.when(F.col("band") == b, F.col("weight"))), F.lit(0).cast("long")) for b in range(BANDS)]
    per_query = terms.groupBy("q_id").agg(F.collect_list("token").alias("names"), F.array(*_bitmap()).alias("masks"), F.array(*tops).alias("tops"))
    return per_query, terms


def _members(best: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """The titles of the best sets: per set the k smallest ids, the only ones that can rank.

    A set is named by its smallest title id, so k sets cover the k best titles.
    """
    named = words.select(F.col("title_id").alias("t_id"), "digest")
    chosen = named.join(best.select("t_id").distinct(), "t_id")
    copies = words.select("title_id", "digest").join(chosen, "digest")
    first = top_per_key(copies, ["t_id"], [F.asc("title_id")], k).select("t_id", "title_id")
    return best.join(first, "t_id").select("q_id", F.col("title_id").alias("t_id"), "score")


def top_candidates(
    queries: DataFrame,
    query_id: str,
    query_text: str,
    titles: DataFrame,
    title_id: str,
    title: str,
    k: int = 20,
    query_authors: str | None = None,
    authors: str | None = None,
) -> DataFrame:
    """``(q_id, t_id, score, rank)``: the k best titles per query, ties by title id.

    With ``query_authors`` and ``authors`` (lists of names on either side), shared author tokens count as well.
    """
    column = lambda name: None if name is None else F.col(name)
    named = _tokenised(queries, query_id, field_tokens(F.col(query_text), column(query_authors)), "query_id")
    sets_asked = named.groupBy(F.col("digest").alias("q_id")).agg(F.any_value("words").alias("words"))
    asked = sets_asked.select("q_id", F.explode("words").alias("token"))
    # titles are tokenised once
    words = materialise(_tokenised(titles, title_id, field_tokens(F.col(title), column(authors)), "title_id"), "title-tokens")
    sets = words.groupBy("digest").agg(
        F.min("title_id").alias("t_id"), F.count("*").alias("copies"), F.any_value("words").alias("words")
    )
    # only tokens that some query has are kept
    met = materialise(
        sets.select("t_id", "copies", F.explode("words").alias("token")).join(
            asked.select("token").distinct(), "token", "left_semi"
        ),
        "postings",
    )
    total = titles.agg(F.count("*")).scalar()
    counted = met.groupBy("token").agg(F.sum("copies").alias("df"), F.count("*").alias("sets"))
    weight = F.round(F.ln(1 + total / F.col("df")), 6).cast(WEIGHT)
    # from here on tokens are numbers
    numbered = counted.select(F.monotonically_increasing_id().alias("token_no"), "token", "df", "sets", (weight * UNIT).cast("long").alias("weight"))
    numbered = materialise(numbered, "token-weights")
    weights = numbered.drop("token").withColumnRenamed("token_no", "token")
    common = common_tokens(weights)
    numbers = numbered.select("token", "token_no")
    whole = met.join(numbers, "token").select("t_id", F.col("token_no").alias("token")).join(common, "token", "left")
    whole = materialise(whole.groupBy("t_id").agg(F.collect_list("token").alias("words"), F.array(*_bitmap()).alias("bits")), "title-bitmaps")
    postings = whole.select("t_id", F.explode("words").alias("token"))
    asked = asked.join(numbers, "token").select("q_id", F.col("token_no").alias("token"))
    asked_sets, per_token = query_terms(asked, weights, common)
    asked_sets = materialise(asked_sets, "queries")
    terms = materialise(per_token, "query-terms")

    # the rarest tokens: as many as k titles need, and more while they stay few
    opening = (F.col("rarer_sets") < k) | (F.col("rarer_sets") + F.col("sets") <= LEAD * k)
    leaders = leading(terms.where(opening), postings, asked_sets, whole, k).drop("score")
    kth = _scored(leaders.join(whole, "t_id").join(asked_sets, "q_id"), weights).groupBy("q_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    floors = materialise(kth.where(F.col("n") == k).drop("n"), "floors")
    # a `floor` of null means that every term is needed
    needed = F.col("floor").isNull() | (F.col("reach") >= F.col("floor"))
    judged = terms.join(floors, "q_id", "left").where(needed)
    hopeful = reaching(judged, postings, asked_sets.join(floors, "q_id", "left"), whole)
    scores = _scored(hopeful, weights).join(floors, "q_id", "left").where(F.col("floor").isNull() | (F.col("score") >= F.col("floor")))
    best = materialise(_ranked(scores.select(*PAIR, "score"), k).drop("rank"), "best-sets")
    ranked = _ranked(_members(best, words, k), k).withColumnRenamed("q_id", "digest")
    score = (F.col("score").cast("decimal(18,0)") / UNIT).cast(WEIGHT).alias("score")
    return ranked.join(named.select("digest", F.col("query_id").alias("q_id")), "digest").select(*PAIR, score, "rank")
