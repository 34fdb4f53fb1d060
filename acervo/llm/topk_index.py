"""Exact top-k inner products over a pivot-distance index with triangle-inequality stops."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.session import materialise

SCALE = 1024
#: Rows that pivots are chosen from, and pivots of one vector length: the bound of what reaches the driver.
SAMPLE, PIVOTS = 2048, 16
#: Vectors of one annulus, before it is sliced, and annuli of one pivot at most (more vectors make more slices).
ANNULUS, ANNULI = 8192, 64
#: Vectors of a slice and queries of a block: what one task multiplies at once, tile by tile.
SLICE, BLOCK, TILE = 16_384, 4096, 512
#: Products of whole numbers below this are exact in doubles.
EXACT = float(1 << 53)

NOTHING = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("qkey", "query_id", "vec_id", "score")})
POINTS = "dim int, pivot int, r double, norm double, vec_id long, v binary"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: components as floor(scale * x), for rows that take part.

    A row takes no part if its id or vector is null, or a component is null, not finite, or too large for a long after scaling.
    """
    x = F.transform(F.col("embedding"), lambda c: c.cast("double") * scale)
    fine = F.forall(x, lambda c: F.coalesce(F.abs(c) < float(1 << 62), F.lit(False)))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long"), x.alias("x"))
    return rows.where(fine & ~F.exists("x", F.isnan)).select("vec_id", F.transform("x", lambda c: F.floor(c).cast("long")).alias("v"))


def choose_pivots(whole: DataFrame, sample: int = SAMPLE, most: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per vector length the origin and, from a sample by hash of the id (about so many), points far from all chosen before."""
    share = min(1.0, sample / max(1, whole.count()))
    # a share by hash: no task sends the driver more than its part of the sample
    some = whole.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # an id that many rows carry gives one vector
    rows = some.groupBy("vec_id").agg(F.max("v").alias("v")).toPandas().sort_values("vec_id", kind="stable")
    by_length: dict[int, list] = {}
    for v in rows["v"]:
        by_length.setdefault(len(v), []).append(v)
    chosen = {}
    for n, vs in by_length.items():
        x = np.array(vs, np.int64).reshape(len(vs), n).astype(float)
        picked = [np.zeros(n)]
        gap = np.sqrt((x**2).sum(1))
        while len(picked) < most and len(gap) and gap.max() > 0:
            picked.append(x[int(gap.argmax())])
            gap = np.minimum(gap, np.sqrt(((x - picked[-1]) ** 2).sum(1)))
        chosen[n] = np.array(picked)
    return chosen


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(2), 0))


def slack(*values: np.ndarray) -> np.ndarray:
    """What rounding may have cost a bound."""
    return 1e-9 * sum(np.abs(v) for v in values) + 1e-3


def reach(norm: np.ndarray, d: np.ndarray, low: np.ndarray, high: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Upper bound of the inner product of queries (of ``norm``, ``d`` from the pivot) with vectors of at most ``norms``
    at ``low`` to ``high`` from it: their distance is at least the gap between d and the annulus."""
    gap = np.maximum(np.maximum(low - d, d - high), 0)
    gap = np.maximum(gap - slack(d, high), 0)
    top = (norm**2 + norms**2 - gap**2) / 2
    # Cauchy-Schwarz holds as well
    top = np.minimum(top, norm * norms)
    return top + slack(norm**2, norms**2)


def index_points(whole: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``POINTS``: every vector with its nearest pivot and the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                at = pivots.get(n, np.zeros((1, n)))
                for lo in range(0, len(rows), TILE):
                    some = rows[lo : lo + TILE]
                    v = flat[starts[some][:, None] + np.arange(n)[None, :]].astype(np.int64)
                    far = distances(v.astype(float), at)
                    near = far.argmin(1)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dim": pa.array(np.full(len(some), n, np.int32)), "pivot": pa.array(near.astype(np.int32)),
                            "r": far[np.arange(len(some)), near], "norm": np.sqrt((v.astype(float) ** 2).sum(1)),
                            "vec_id": ids[some], "v": pa.array([row.tobytes() for row in v], pa.binary()),
                        }
                    )

    return whole.mapInArrow(run, POINTS)


def annuli(points: DataFrame) -> dict[tuple[int, int], list[float]]:
    """Per pivot the inner edges of its annuli: quantiles of the distance, as many as its vectors need."""
    steps = [i / ANNULI for i in range(1, ANNULI)]
    rows = points.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("r", F.array(*map(F.lit, steps)), 1000).alias("q")).collect()
    edges = {}
    for row in rows:
        n = max(1, min(ANNULI, -(-row["n"] // ANNULUS)))
        edges[row["dim"], row["pivot"]] = sorted({row["q"][round(i * ANNULI / n) - 1] for i in range(1, n)})
    return edges


def multiply(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a long they stop at its ends."""
    high = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * max(1, x.shape[1])
    if high < EXACT:
        return (x.astype(float) @ q.astype(float).T).astype(np.int64)
    if high < float(1 << 62):
        return x @ q.T
    wide = x.astype(object) @ q.astype(object).T
    return np.array([[max(-(1 << 63), min((1 << 63) - 1, s)) for s in row] for row in wide], np.int64).reshape(len(x), len(q))


def best_in_unit(points: pd.DataFrame, probes: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of ``points`` (one slice of an annulus) for each probing query, tile by tile in order of distance."""
    points = points.sort_values("r", kind="stable")
    n, m = len(points), len(probes)
    x = np.frombuffer(b"".join(points["v"]), np.int64).reshape(n, -1)
    q = np.frombuffer(b"".join(probes["qv"]), np.int64).reshape(m, -1)
    r, norm, ids = points["r"].to_numpy(), points["norm"].to_numpy(), points["vec_id"].to_numpy()
    qid, qnorm, d = probes["query_id"].to_numpy(), probes["qnorm"].to_numpy(), probes["d"].to_numpy()
    floor = probes["floor"].to_numpy(float).copy()
    best = np.full((m, k), -np.inf)
    tiles = [(lo, min(lo + TILE, n)) for lo in range(0, n, TILE)]
    bounds = np.array([reach(qnorm, d, np.full(m, r[a]), np.full(m, r[b - 1]), np.full(m, norm[a:b].max())) for a, b in tiles])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for t in np.argsort(-bounds.max(1), kind="stable"):
        a, b = tiles[t]
        live = np.flatnonzero(bounds[t] >= floor)
        if not len(live):
            continue
        s = multiply(x[a:b], q[live])
        other = ids[a:b, None] != qid[None, live]
        ranked = np.where(other, s.astype(float), -np.inf)
        best[live] = -np.partition(-np.concatenate([best[live], ranked.T], axis=1), k - 1, axis=1)[:, :k]
        # doubles of longs may round; a floor is lowered by what that can cost
        kth = best[live].min(1)
        floor[live] = np.maximum(floor[live], kth - np.where(np.isfinite(kth), np.abs(kth) * 1e-15, 0))
        row, col = np.nonzero(other & (ranked >= floor[live][None, :]))
        found.append((live[col], s[row, col], ids[a + row]))
    if not found:
        return NOTHING
    which, score, vec = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((vec, -score.astype(object) if (score == -(1 << 63)).any() else -score, which))
    which, score, vec = which[order], score[order], vec[order]
    first = np.concatenate([[True], which[1:] != which[:-1]])
    nth = np.arange(len(which)) - np.maximum.accumulate(np.where(first, np.arange(len(which)), 0))
    top = nth < k
    return pd.DataFrame({"qkey": probes["qkey"].to_numpy()[which[top]], "query_id": qid[which[top]], "vec_id": vec[top], "score": score[top]})


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every`` the k others of highest inner product.

    Exact on whole numbers. Every vector is keyed by its nearest pivot and the distance from it; sorted, these form
    annuli. A query first looks into the annuli of its highest bounds until they hold k vectors, which gives it a floor. Then it
    expands to all others whose bound reaches the floor, and to no more. Annuli are cut into slices and queries into
    blocks of bounded size, so that copies or a dense cluster make more tasks and not larger ones.

    Rows that take no part: see ``whole_vectors``. Only vectors of the same length meet. Ties go to the smaller id. All rows
    with the query's id count as its own. Equal rows are one query; different vectors under one id are queries of their own under
    that id. Fewer candidates than k give all of them; other columns are ignored.
    """
    whole = whole_vectors(vectors, scale)
    pivots = choose_pivots(whole)
    points = materialise(index_points(whole, pivots), "topk-points")
    edges = annuli(points)
    if not edges:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, pivot, r = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "pivot", "r"))
            which = np.zeros(len(r), np.int32)
            for key in set(zip(dim.tolist(), pivot.tolist(), strict=True)):
                rows = (dim == key[0]) & (pivot == key[1])
                which[rows] = np.searchsorted(edges[key], r[rows])
            yield batch.append_column("ring", pa.array(which))

    ringed = materialise(points.mapInArrow(ring, f"{POINTS}, ring int"), "topk-rings")
    #: At most PIVOTS * ANNULI rows for a length.
    cells = ringed.groupBy("dim", "pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("r").alias("low"), F.max("r").alias("high"), F.max("norm").alias("norms")
    ).toPandas()
    by_dim = {n: part.reset_index(drop=True) for n, part in cells.groupby("dim")}
    n_slices = F.lit(0)
    for n, part in by_dim.items():
        for row in part[part["n"] > SLICE].itertuples():
            here = (F.col("dim") == n) & (F.col("pivot") == row.pivot) & (F.col("ring") == row.ring)
            n_slices = F.when(here, F.pmod(F.xxhash64("vec_id"), F.lit(-(-row.n // SLICE)))).otherwise(n_slices)
    sliced = ringed.withColumn("slice", n_slices.cast("int"))
    queries = ringed.where(F.col("vec_id") % every == 0).select("dim", F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.col("norm").alias("qnorm")).distinct()
    queries = queries.withColumn("qkey", F.xxhash64("query_id", "qv"))
    n_queries = queries.count()
    queries = queries.withColumn("block", F.pmod(F.xxhash64("qkey"), F.lit(max(1, -(-n_queries // BLOCK)))).cast("int"))
    probe_schema = "dim int, pivot int, ring int, slice int, block int, qkey long, query_id long, qv binary, qnorm double, d double, floor double"

    def probes(floors: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for n, part in batch.groupby("dim"):
                    cell = by_dim[n]
                    at = pivots.get(n, np.zeros((1, n)))
                    q = np.frombuffer(b"".join(part["qv"]), np.int64).reshape(len(part), n).astype(float)
                    d = distances(q, at)[:, cell["pivot"].to_numpy()]
                    top = reach(part["qnorm"].to_numpy()[:, None], d, cell["low"].to_numpy()[None], cell["high"].to_numpy()[None], cell["norms"].to_numpy()[None])
                    order = np.argsort(-top, axis=1, kind="stable")
                    size = cell["n"].to_numpy()[order]
                    # a query's own row is in one of them
                    lead = np.zeros(top.shape, bool)
                    np.put_along_axis(lead, order, np.cumsum(size, axis=1) - size < k + 1, axis=1)
                    floor = part["floor"].to_numpy() if floors else np.full(len(part), -np.inf)
                    wanted = ~lead & (top >= floor[:, None]) if floors else lead
                    row, col = np.nonzero(wanted)
                    many = np.maximum(1, -(-cell["n"].to_numpy()[col] // SLICE))
                    row, col = np.repeat(row, many), np.repeat(col, many)
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    out = part.iloc[row][["block", "qkey", "query_id", "qv", "qnorm"]].reset_index(drop=True)
                    out["dim"], out["pivot"], out["ring"], out["slice"] = n, cell["pivot"].to_numpy()[col], cell["ring"].to_numpy()[col], nth
                    out["d"], out["floor"] = d[row, col], floor[row]
                    yield out[[c.split()[0] for c in probe_schema.split(", ")]]

        return run

    unit = ["dim", "pivot", "ring", "slice", "block"]

    def visit(asked: DataFrame) -> DataFrame:
        asked = materialise(asked, "topk-probes")
        needed = asked.select(*[F.col(c).alias(f"_{c}") for c in unit]).distinct()
        sent = sliced.join(needed, [F.col(c) == F.col(f"_{c}") for c in unit[:-1]]).select(*sliced.columns, F.col("_block").alias("block"))
        return materialise(
            sent.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInPandas(
                lambda a, b: best_in_unit(a, b, k) if len(a) and len(b) else NOTHING,
                "qkey long, query_id long, vec_id long, score long",
            ),
            "topk-found",
        )

    first = visit(queries.mapInPandas(probes(False), probe_schema))
    in_order = W.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("nth", F.row_number().over(in_order)).where(f"nth <= {k}").groupBy("qkey").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    with_floor = queries.join(kth, "qkey", "left").withColumn(
        "floor", F.when(F.col("n") >= k, F.col("least").cast("double") - F.abs(F.col("least").cast("double")) * 1e-15).otherwise(F.lit(float("-inf")))
    ).select(*queries.columns, "floor")
    rest = visit(with_floor.mapInPandas(probes(True), probe_schema))
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(in_order)).where(f"rank <= {k}")
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
