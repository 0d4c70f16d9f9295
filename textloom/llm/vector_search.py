"""Exact top-k search with segment statistics of several resolutions.

A vector is cut into segments; of each segment the mean and the deviation are
kept, for one segment, then four, then sixteen. For two vectors, the sum over
the segments of ``length * ((difference of means)^2 + (difference of
deviations)^2)`` is at most their squared distance, and grows towards it with
finer segments. With the lengths of the vectors known, each lower bound of the
distance is an upper bound of the inner product. Candidates are dropped as
soon as a bound, coarse to fine, puts them below the k-th best known; the
survivors' products are computed exactly in whole numbers.

Vectors are dealt into portions of bounded size and queries into blocks;
each task meets one block with one portion and returns k rows per query.

Defined results: vectors that are null or hold null or non-finite components
take no part; only vectors of equal length are compared, empty ones with
score 0; equal scores go to the smaller id; a query's own row is no candidate
but other rows of the same id are; products beyond 64 bits are held at their
limits; null ids can't ask, and as candidates come last among equals; an empty
table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import written


@dataclass(frozen=True)
class SearchConfig:
    k: int = 5
    scale: int = 256
    segments: tuple[int, ...] = (1, 4, 16)
    portion: int = 2048
    block: int = 512


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, fine)


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of equal segments, scaled so that a dot product of two is a bound."""
    parts = np.array_split(np.arange(vectors.shape[1]), min(segments, max(1, vectors.shape[1])))
    columns = []
    for part in parts:
        piece = vectors[:, part]
        root = np.sqrt(len(part))
        columns += [root * piece.mean(axis=1), root * piece.std(axis=1)] if len(part) else []
    return np.stack(columns, axis=1) if columns else np.zeros((len(vectors), 1))


def exact_products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole-number inner products, in floating point only where that is exact."""
    most = max(1, int(np.abs(query).max(initial=0))), max(1, int(np.abs(vectors).max(initial=0)))
    bound = most[0] * most[1] * max(1, len(query))
    if bound < 1 << 53:
        return np.rint(vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return vectors @ query
    totals = (sum(int(a) * int(b) for a, b in zip(query, v)) for v in vectors)
    limit = (1 << 63) - 1
    return np.array([max(-limit - 1, min(limit, t)) for t in totals], dtype=np.int64)


def search(
    queries: np.ndarray,
    query_rows: np.ndarray,
    vectors: np.ndarray,
    rows: np.ndarray,
    ids: np.ndarray,
    config: SearchConfig,
):
    """For each query its best ``k`` places in ``vectors`` and their scores."""
    levels = [
        (segment_features(queries.astype(float), s), segment_features(vectors.astype(float), s))
        for s in config.segments
    ]
    coarse = levels[0][0] @ levels[0][1].T
    finest = levels[-1]
    for q in range(len(queries)):
        slack = 1e-9 * float(np.sqrt((queries[q].astype(float) ** 2).sum())) * float(
            np.abs(coarse[q]).max(initial=1)
        ) ** 0.5 + 1e-6 * (1 + np.abs(coarse[q]))
        other = rows != query_rows[q]
        # A first guess of the k-th best: the most promising by the finest bound.
        left = np.flatnonzero(other)
        if len(left) > 4 * config.k:
            promise = finest[1][left] @ finest[0][q]
            first = left[np.argpartition(-promise, config.k - 1)[: config.k]]
            least = exact_products(queries[q], vectors[first]).min()
            left = left[coarse[q][left] + slack[left] >= least]
            for of_query, of_vectors in levels[1:]:
                bound = of_vectors[left] @ of_query[q]
                left = left[bound + slack[left] >= least]
        score = exact_products(queries[q], vectors[left])
        best = np.lexsort((rows[left], ids[left], -score.astype(object) if _wide(score) else -score))
        best = best[: config.k]
        yield q, left[best], score[best]


def _wide(score: np.ndarray) -> bool:
    return bool((score == np.iinfo(np.int64).min).any())


def top_k(
    vectors: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    config: SearchConfig = SearchConfig(),
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best rows of ``vectors`` for the rows where ``asks``."""
    scaled = F.transform(vector_col, lambda x: F.floor(F.lit(config.scale) * x.cast("double")))
    rows = written(
        vectors.filter(usable(F.col(vector_col))).select(
            F.col(id_col).cast("long").alias("id"),
            scaled.alias("vector"),
            F.coalesce(asks, F.lit(False)).alias("asks"),
            F.size(vector_col).alias("dims"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    sizes = rows.groupBy("dims").agg(
        F.ceil(F.count("*") / config.portion).alias("portions"),
        F.ceil(F.count_if("asks") / config.block).alias("blocks"),
    )

    def pack(key, pdf):
        data = np.array(pdf["vector"].tolist(), dtype=np.int64)
        ids = pdf["id"].fillna(np.iinfo(np.int64).max).astype(np.int64).to_numpy()
        names = pdf["row"].to_numpy(np.int64)
        return pd.DataFrame(
            {
                "dims": [key[0]],
                "part": [key[1]],
                "rows": [names.tobytes()],
                "ids": [ids.tobytes()],
                "data": [data.tobytes()],
            }
        )

    def packed(some: DataFrame, parts: str) -> DataFrame:
        part = F.pmod(F.xxhash64("row"), F.col(parts))
        return (
            some.join(sizes, "dims")
            .select("dims", part.alias("part"), "row", "id", "vector")
            .groupBy("dims", "part")
            .applyInPandas(pack, "dims int, part long, rows binary, ids binary, data binary")
        )

    portions = packed(rows, "portions")
    blocks = (
        packed(rows.filter("asks and id is not null"), "blocks")
        .join(sizes, "dims")
        .select(
            "dims",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("part"),
            F.col("part").alias("block"),
            F.col("rows").alias("query_rows"),
            F.col("ids").alias("query_ids"),
            F.col("data").alias("query_data"),
        )
    )

    def meet(pdf):
        found = []
        for r in pdf.itertuples(index=False):
            read = lambda b: np.frombuffer(b, dtype=np.int64)
            query_rows, query_ids = read(r.query_rows), read(r.query_ids)
            names, ids = read(r.rows), read(r.ids)
            for q, places, score in search(
                read(r.query_data).reshape(len(query_rows), r.dims),
                query_rows,
                read(r.data).reshape(len(names), r.dims),
                names,
                ids,
                config,
            ):
                found.append(
                    pd.DataFrame(
                        {
                            "query_row": query_rows[q],
                            "query_id": query_ids[q],
                            "row": names[places],
                            "vec_id": ids[places],
                            "score": score,
                        }
                    )
                )
        names = ["query_row", "query_id", "row", "vec_id", "score"]
        return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, np.int64) for c in names})

    per_query = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    missing = np.iinfo(np.int64).max
    return (
        portions.join(blocks, ["dims", "part"])
        .groupBy("dims", "part", "block")
        .applyInPandas(meet, "query_row long, query_id long, row long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(per_query))
        .filter(F.col("rank") <= config.k)
        .select("query_id", "rank", F.nullif("vec_id", F.lit(missing)).alias("vec_id"), "score")
    )
