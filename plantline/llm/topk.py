"""Exact top-k search by pivot-table elimination.

The distances of every vector to a fixed number of pivots are computed once. For
a query, the largest difference between its own and a candidate's distances is a
lower bound of their distance, and with both norms an upper bound of their inner
product. Candidates are evaluated in the order of that bound, and as soon as the
bound falls below the k-th best score found, no other candidate can enter.

Queries and candidates are cut into blocks, and each pair of blocks is one task;
of each pair only k rows a query go on. The queries are a stated set that is held
against all rows; the work is theirs times the rows, less what is eliminated.

Defined results: components are floor(1024 * x) as whole numbers of any size, scores
exact inner products; a score that is to be returned and does not fit a long is an
error, as there is no value for it; vectors that are null, empty, or hold a null or non-finite
component take no part; vectors of another length than the query's are not its
candidates; ties go to the smaller vec_id; rows that share a vec_id are separate
candidates, and none of them is a candidate for a query of that id; a query row
that is repeated is answered once for each distinct vector; rows of null vec_id
are no queries and, as candidates, cannot be named, so they take no part; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantline.llm.common import blocks_of, stored

SCALE = 1024
#: Pivots of a length of vectors, lengths that have pivots, queries and candidates in one block.
PIVOTS, LENGTHS, QUERY_BLOCK, ROW_BLOCK = 32, 32, 4096, 16384
#: Candidates that are evaluated between two looks at the k-th score.
STEP = 256


def usable(vector: Column) -> Column:
    """floor(1024 * x) / 1024 of each component, exact as a double, or null if the vector takes no part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    # From 2^52 on every double is whole.
    cut = lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(x * SCALE).cast("double") / SCALE).otherwise(x)
    return F.when(F.coalesce(F.size(vector) > 0, F.lit(False)) & F.forall(vector, finite), F.transform(vector.cast("array<double>"), cut))


def whole_numbers(vectors: np.ndarray, limit: float = 2.0**62) -> np.ndarray:
    """floor(1024 * x) of each component: int64 below ``limit``, Python's whole numbers from there on."""
    if not vectors.size or float(np.abs(vectors).max()) < limit / SCALE:
        return np.floor(vectors * SCALE).astype(np.int64)
    # From 2^52 on every double is whole; below it, the product with 1024 is exact.
    exact = [int(x) * SCALE if abs(x) >= 2.0**52 else int(np.floor(x * SCALE)) for x in vectors.ravel().tolist()]
    out = np.empty(len(exact), dtype=object)
    out[:] = exact
    return out.reshape(vectors.shape)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as doubles, infinite where too large: for bounds only."""
    with np.errstate(over="ignore"):
        return np.floor(vectors * SCALE)


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, lengths: int = LENGTHS) -> dict[int, np.ndarray]:
    """For each of the ``lengths`` commonest lengths, the ``pivots`` vectors of the least hashes: a bounded sample.

    Vectors of other lengths have no pivots; the norms alone bound their scores.
    """
    counted = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(lengths).collect()
    common = vectors.where(F.col("dim").isin(*[row.dim for row in counted])) if counted else vectors.limit(0)
    by_hash = Window.partitionBy("dim").orderBy("draw", "vec_id")
    drawn = common.select("dim", "vec_id", "vector", F.xxhash64("vec_id", F.lit(5)).alias("draw"))
    # Least hashes of blocks first, then of all: no task orders all vectors.
    near = drawn.withColumn("part", F.pmod(F.col("vec_id"), F.lit(1024)))
    few = near.withColumn("r", F.row_number().over(Window.partitionBy("dim", "part").orderBy("draw", "vec_id"))).where(F.col("r") <= pivots)
    rows = few.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= pivots).select("dim", "vector").collect()
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row.dim, []).append(row.vector)
    return {dim: scaled(np.array(v, dtype=np.float64)) for dim, v in found.items()}


def distances(vector: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, from differences, so that no large norms cancel; infinite or NaN where they overflow."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(((pivots - vector[None, :]) ** 2).sum(1))


def top_scores(
    query: np.ndarray, query_id: int, ids: np.ndarray, rows: np.ndarray, upper: np.ndarray, k: int
) -> list[tuple[int, int]]:
    """The k best (score, vec_id) of ``rows``, taken in falling order of ``upper``; see ``bounds`` for its margin."""
    order = np.argsort(-upper, kind="stable")
    best: list[tuple[int, int]] = []
    for at in range(0, order.size, STEP):
        if len(best) == k and upper[order[at]] < best[-1][0]:
            break
        some = order[at : at + STEP]
        some = some[ids[some] != query_id]
        best += zip((rows[some] @ query).tolist(), ids[some].tolist(), strict=True)
        best = sorted(best, key=lambda b: (-b[0], b[1]))[:k]
    return best


def bounds(query: np.ndarray, rows: np.ndarray, query_far: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products, with a margin for rounding; infinite where a norm overflows."""
    with np.errstate(over="ignore", invalid="ignore"):
        least = np.zeros(len(rows))
        if far.shape[1]:
            apart = np.abs(far - query_far[None, :]) - 1e-10 * (far + query_far[None, :])
            # A distance that overflowed says nothing.
            least = np.where(np.isfinite(apart), apart, 0.0).max(axis=1)
        own, theirs = float((query**2).sum()), (rows**2).sum(1)
        slack = 1e-9 * (own + theirs) + 1
        upper = (own + theirs - np.maximum(least - 1e-6 * (1 + least), 0) ** 2) / 2 + slack
    return np.where(np.isnan(upper), np.inf, upper)


def _searcher(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            held = np.array(rows["vector"].tolist(), dtype=np.float64)
            ids, far = rows["vec_id"].to_numpy(dtype=np.int64), np.array(rows["far"].tolist(), dtype=np.float64)
            asked = np.array(queries["vector"].tolist(), dtype=np.float64)
            # Whole numbers of 64 bits serve while no sum of products can leave them.
            most = [float(np.abs(v).max()) * SCALE + 1 for v in (held, asked)]
            with np.errstate(over="ignore"):
                limit = 2.0**62 if held.shape[1] * np.float64(most[0]) * np.float64(most[1]) < 2.0**62 else 0.0
            exact, loose, ask = whole_numbers(held, limit), scaled(held), whole_numbers(asked, limit)
            for own, plain, q in zip(ask, scaled(asked), queries.itertuples(index=False), strict=True):
                upper = bounds(plain, loose, np.array(q.far, dtype=np.float64), far)
                best = top_scores(own, q.vec_id, ids, exact, upper, k)
                found += [(q.vec_id, q.copy, str(s), i) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "copy", "score", "vec_id"])

    return search


def _far_maker(pivots: dict[int, np.ndarray]):
    def far(parts):
        for part in parts:
            out = []
            for dim, vector in zip(part["dim"], part["vector"], strict=True):
                known = pivots.get(dim)
                own = scaled(np.array(vector, dtype=np.float64))
                out.append(distances(own, known) if known is not None else np.empty(0))
            part["far"] = out
            yield part

    return far


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of each query among all other rows."""
    spark = vectors.sparkSession
    blocks = blocks_of(spark)
    held = vectors.where("vec_id is not null").select(
        "vec_id", usable(F.col("embedding")).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    held = stored(held.where("vector is not null").withColumn("dim", F.size("vector")), "topk-vectors")
    table = stored(
        held.mapInPandas(
            _far_maker(choose_pivots(held, pivots)),
            "vec_id bigint, vector array<double>, asks boolean, dim int, far array<double>",
        ),
        "topk-pivots",
    )
    blocks = max(blocks, -(-table.count() // ROW_BLOCK))
    asked = stored(table.where("asks").dropDuplicates(["vec_id", "vector"]).withColumn("copy", F.xxhash64("vector")), "topk-queries")
    groups = max(1, -(-asked.count() // QUERY_BLOCK))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("c", all_of(blocks))
    right = table.withColumn("c", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("q", all_of(groups))
    keys = ["dim", "q", "c"]
    best = (
        left.select(*keys, "vec_id", "copy", "vector", "far")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "vec_id", "vector", "far").groupBy(*keys))
        .applyInPandas(_searcher(k), "query_id bigint, copy bigint, score string, vec_id bigint")
    )
    # Scores are decimal text up to here, as one that no query returns may be of any size. Order: sign, digits, value.
    # At most k rows of each block stand in a query's window.
    under, digits = F.startswith("score", F.lit("-")), F.regexp_replace("score", "^-", "")
    place = Window.partitionBy("query_id", "copy").orderBy(
        under, F.when(under, F.length(digits)).otherwise(-F.length(digits)), F.when(under, digits), F.desc(digits), "vec_id"
    )
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.col("score").cast("bigint").alias("score")
    )
