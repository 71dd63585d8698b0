"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors serves as pivots. Each vector is known by the order of its nearest
pivots. Vectors are kept in blocks; a block has an inverted file for each pivot that gives every
vector's place for that pivot. A query reads the files of its own nearest pivots, ranks the block by
footrule distance and length, and computes exact inner products for the best share of it only.

All vectors are indexed, all queries meet all blocks, and the best of each block are merged. Blocks
of queries and of vectors have fixed sizes, so no task grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railstream.llm.store import stored

PIVOTS = 256
NEAREST_PIVOTS = 128
# Vectors drawn for one pivot, and the distance, as a share of the longer of two vectors, below
# which one of them is enough.
DRAWN_FOR_PIVOT = 8
NEAR = 0.3
# Share of a block that is reranked, and the least number; ties in distance come on top.
RERANKED = 0.08
RERANKED_LEAST = 256
BLOCK = 8192
QUERY_BLOCK = 1024
LANES = 64


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part, one for each id.

    Left out are rows without an id and vectors that are missing, zero, of another length than
    most, or that hold missing or non-finite components. Rows of one id count once.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull()).filter(
        finite & F.exists(v, lambda x: x != 0)).withColumn("width", F.size("vector"))
    usual = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    width = usual["width"] if usual else 0
    return rows.filter(F.col("width") == width).select("id", "vector").dropDuplicates(["id"])


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pivots(vectors: DataFrame, number: int = PIVOTS) -> np.ndarray:
    """At most ``number`` of the vectors, from a bounded sample drawn by a hash of the id."""
    drawn = (vectors.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(number * DRAWN_FOR_PIVOT)
             .toArrow())
    return spread_out(_matrix(drawn["vector"]), number) if len(drawn) else np.zeros((0, 1))


def spread_out(vectors: np.ndarray, number: int) -> np.ndarray:
    """The first ``number`` distinct vectors that do not lie near one before them.

    If there are fewer, the others that lie farthest from all of these come on top.
    """
    vectors = vectors[np.sort(np.unique(vectors, axis=0, return_index=True)[1])]
    norms = np.linalg.norm(vectors, axis=1)
    apart = np.full(len(vectors), np.inf)
    chosen: list[int] = []
    for at in range(len(vectors)):
        if len(chosen) < number and apart[at] >= NEAR:
            chosen.append(at)
            gap = np.linalg.norm(vectors - vectors[at], axis=1) / np.maximum(norms, norms[at])
            apart = np.minimum(apart, gap)
    others = np.setdiff1d(np.arange(len(vectors)), chosen)
    more = others[np.argsort(-apart[others], kind="stable")[:number - len(chosen)]]
    return vectors[np.sort(np.concatenate([chosen, more]).astype(int))]


def permutation(vectors: np.ndarray, centres: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each vector by inner product, nearest first; ties to the first pivot."""
    return np.argsort(-(vectors @ centres.T), axis=1, kind="stable")[:, :nearest]


def inverted_files(order: np.ndarray, number: int) -> np.ndarray:
    """For each pivot, the place it has in each vector's order; ``nearest`` where it has none."""
    n, nearest = order.shape
    files = np.full((number, n), nearest, np.uint16)
    files[order, np.arange(n)[:, None]] = np.arange(nearest, dtype=np.uint16)
    return files


def footrule(files: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Footrule distance of one query's order to all vectors of a block, up to a constant.

    With places beyond the nearest counted as ``nearest``, the distance is a constant plus twice
    the sum, over the query's pivots, of the larger of the two places.
    """
    places = np.arange(len(order), dtype=np.uint16)[:, None]
    return np.maximum(files[order], places).sum(axis=0, dtype=np.uint32)


def unrelated(number: int, nearest: int) -> float:
    """Mean footrule distance of orders that have nothing to do with each other."""
    places = np.minimum(np.arange(number), nearest)
    return float(np.maximum(places[:, None], np.arange(nearest)).mean(axis=0).sum())


def preference(distance: np.ndarray, norms: np.ndarray, mean: float) -> np.ndarray:
    """What vectors are ranked by before their exact scores, largest first.

    An order does not change with a vector's length. The part by which a distance falls short of
    the mean stands for the cosine, so times the length for the inner product.
    """
    return (mean - distance) * norms


def _blocks(rows: DataFrame, size: int, total: int, centres: np.ndarray, nearest: int,
            label: str) -> DataFrame:
    """(block, ids, vectors, order) with at most about ``size`` rows in a block."""
    number = max(1, -(-total // size))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        vectors = np.ascontiguousarray(_matrix(table["vector"]))
        order = permutation(vectors, centres, nearest).astype("<u2")
        ids = table["id"].to_numpy().astype("<i8")
        return pa.table({"block": table["block"][:1], **{
            name: pa.array([part.tobytes()], pa.binary())
            for name, part in (("ids", ids), ("vectors", vectors), ("orders", order))}})

    return stored(rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(number)).cast("int"))
                  .groupBy("block").applyInArrow(
                      build, "block int, ids binary, vectors binary, orders binary"), label)


def search(vectors: DataFrame, is_query, k: int = 20, number: int = PIVOTS,
           nearest: int = NEAREST_PIVOTS, reranked: float = RERANKED, block: int = BLOCK,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, itself left out.

    ``is_query`` is a condition on the column ``id``. Ties in score go to the smaller id. A query
    with fewer than ``k`` candidates gets them all. See ``usable`` for rows that take no part. An
    empty table gives no rows.
    """
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    queries = rows.filter(is_query)
    centres = pivots(rows, number)
    nearest = min(nearest, len(centres))
    total = rows.count()
    index = _blocks(rows, block, total, centres, nearest, "index")
    asked = _blocks(queries, QUERY_BLOCK, queries.count(), centres, nearest, "queries")
    n_pivots, width = len(centres), centres.shape[1]
    mean = unrelated(n_pivots, nearest) if n_pivots else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return (np.frombuffer(row[f"{side}ids"], "<i8"),
                    np.frombuffer(row[f"{side}vectors"], "<f8").reshape(-1, width),
                    np.frombuffer(row[f"{side}orders"], "<u2").reshape(-1, nearest))

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids, vecs, orders = arrays(row, "")
                query_ids, query_vecs, query_orders = arrays(row, "query_")
                files = inverted_files(orders, n_pivots)
                norms = np.sqrt((vecs * vecs).sum(axis=1))
                least = min(len(ids), max(RERANKED_LEAST, k + 1, int(np.ceil(reranked * len(ids)))))
                out = [], [], []
                for one, vec, order in zip(query_ids, query_vecs, query_orders):
                    liked = preference(footrule(files, order), norms, mean)
                    limit = np.partition(liked, len(ids) - least)[len(ids) - least]
                    near = np.flatnonzero((liked >= limit) & (ids != one))
                    # Summed in one order for all rows, so equal vectors have equal scores.
                    score = (vecs[near] * vec).sum(axis=1)
                    # Rows of a block are in the order of their ids: a stable sort settles ties.
                    best = np.argsort(-score, kind="stable")[:k]
                    out[0].append(np.full(len(best), one))
                    out[1].append(ids[near[best]])
                    out[2].append(score[best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    # Every block of vectors meets every block of queries; queries are copied to each lane once.
    lanes = max(1, min(LANES, -(-total // block)))
    index = index.withColumn("lane", F.col("block") % lanes)
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
                         *(F.col(c).alias(f"query_{c}") for c in ("ids", "vectors", "orders")))
    found = index.join(asked, "lane").mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
