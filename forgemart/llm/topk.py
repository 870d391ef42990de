"""Exact top-k inner products by aggregation of sorted lists without random access.

Rows are dealt into blocks. In a block each dimension is one list of rows sorted by value, read from the top for a
positive query component and from the bottom for a negative one. After reading all lists to some depth, a row's
score lies between what was read of it plus the rest of each list's range: the lower bound takes the list's end, the
upper bound the last value read. Rows whose upper bound is below the k-th lower bound are out. Depth grows until
few rows are left, whose final scores are then resolved in whole numbers. Queries are blocks as well, every query
block meets every row block, and a block's best k of each query go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEST = 5
QUERY_STEP = 50
ROWS, QUERIES = 2048, 512  # of a block, about
SCHEMA = "query_id long, vec_id long, score long"

ORACLE_SQL = """
    WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
               FROM embeddings
               WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
         s AS (SELECT q.vec_id AS query_id, v.vec_id,
                      CAST(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(v.vec AS DOUBLE[])) AS BIGINT) AS score
               FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
         r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                      AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 5"""


class Lists:
    """A block of rows as sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.whole, self.rows = ids, rows, rows.astype(np.float64)
        order = np.argsort(-self.rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.rows, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(rows))[:, None], axis=0)

    def bounds(self, depth: int, queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of ``rows`` (by query) after reading ``depth`` of each list."""
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        high, low = self.sorted[0][:, None], self.sorted[-1][:, None]
        top = self.rank[rows] < depth
        bottom = self.rank[rows] >= len(self.rows) - depth
        value = self.rows[rows]
        read = (value * top) @ up + (value * bottom) @ down
        last, first = self.sorted[depth - 1][:, None], self.sorted[-depth][:, None]
        lower = read + ~top @ (up * low) + ~bottom @ (down * high)
        upper = read + ~top @ (up * last) + ~bottom @ (down * first)
        return lower, upper

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query the ids and scores of its best ``k`` rows other than those with its own id."""
        n = len(self.rows)
        real = queries.astype(np.float64)
        rows, alive = np.arange(n), np.ones((n, len(queries)), bool)
        alive &= self.ids[:, None] != query_ids[None, :]
        slack = 1e-9 * (np.abs(self.rows).max(initial=0) * np.abs(real).sum(axis=1) + 1)
        depth = max(1, n // 4)
        while depth < n and n > 8 * k:
            lower, upper = self.bounds(depth, real, rows)
            lower[~alive[rows]] = -np.inf
            kth = np.partition(lower, len(rows) - k, axis=0)[len(rows) - k] if len(rows) >= k else np.full(len(queries), -np.inf)
            alive[rows] &= upper >= kth - slack
            rows = np.flatnonzero(alive.any(axis=1))
            if alive.sum() <= 64 * k * len(queries):
                break
            depth *= 2
        for at in range(len(queries)):
            mine = np.flatnonzero(alive[:, at])
            scores = self.whole[mine] @ queries[at]
            order = np.lexsort((self.ids[mine], -scores))[:k]
            yield at, self.ids[mine][order], scores[order]


def _matrix(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, "<i8").reshape(-1, width)


def _blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """One row per block and width: ids and vectors in binary."""
    count = max(1, -(-rows.count() // size))

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["vec_id"].to_numpy("<i8")
        vectors = np.stack([np.asarray(v, "<i8") for v in frame["vec"]])
        row = (*key, ids.tobytes(), vectors.tobytes())
        return pd.DataFrame([row], columns=[name, "width", f"{name}_ids", f"{name}_vectors"])

    dealt = rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "vec"), F.lit(count)).cast("int"))
    schema = f"{name} int, width int, {name}_ids binary, {name}_vectors binary"
    return dealt.groupBy(name, "width").applyInPandas(join, schema)


def search(vectors: DataFrame, k: int = BEST, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``step``, candidates all rows with another vec_id. Components
    count as ``floor(256 * x)``. Rows without an id, and vectors that are null, empty or hold a null or non-finite
    component take no part; vectors of different widths don't meet. A repeated candidate is listed as often; of
    several vectors of one query id the smallest is the query. Other columns are not read.
    """
    spark = vectors.sparkSession
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    rows = rows.filter(F.size("embedding") > 0).select(
        "vec_id",
        F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")).cast("long")).alias("vec"),
        F.size("embedding").alias("width"),
    )
    queries = rows.filter(F.col("vec_id") % step == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    queries = queries.withColumn("width", F.size("vec"))
    lists = _blocks(rows, "list", ROWS)
    asked = _blocks(queries, "query", QUERIES)
    count = max(1, -(-rows.count() // ROWS))
    # Every query block meets every row block: the blocks of rows are named, then joined by name.
    asked = asked.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    pairs = asked.repartition("list", "query").join(lists.hint("shuffle_merge"), ["list", "width"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: tuple = ()
        for frame in frames:
            for row in frame.itertuples(index=False):
                if not kept or kept[0] != (row.list, row.width):
                    ids = np.frombuffer(row.list_ids, "<i8")
                    kept = (row.list, row.width), Lists(ids, _matrix(row.list_vectors, row.width))
                query_ids = np.frombuffer(row.query_ids, "<i8")
                found = list(kept[1].best(query_ids, _matrix(row.query_vectors, row.width), k))
                yield pd.DataFrame(
                    {
                        "query_id": np.repeat(query_ids, [len(i) for _, i, _ in found]),
                        "vec_id": np.concatenate([i for _, i, _ in found]),
                        "score": np.concatenate([s for _, _, s in found]),
                    }
                )

    found = pairs.select("list", "width", "list_ids", "list_vectors", "query_ids", "query_vectors").mapInPandas(run, SCHEMA)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
