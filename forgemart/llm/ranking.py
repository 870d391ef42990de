"""Ranked lexical search over FP-trees of documents.

1. Each document is cut to the terms that the items ask for, with their frequencies; the corpus statistics come from
   these rows. Terms are numbered by falling document frequency.
2. The rows of a task are laid into trees, some thousands at a time: sorted by their numbered terms, documents that
   begin with the same frequent terms share a path. Every node keeps, for each term, the largest frequency in any
   document below it, and the smallest length norm ``m``. Paths without a branch are one edge, and neighbouring
   branches with few documents share a leaf.
3. For an item, a node's largest frequencies at its smallest ``m`` give a score that no document below exceeds. The
   search goes depth first, the best child first, and leaves a branch whose bound is under the last of the best ``k``
   found so far in the task, in this tree or an earlier one. Documents in the leaves reached are scored exactly.
4. Each task hands on at most ``k`` documents of every item, of which the best ``k`` are taken.

Items are sent to the tasks in blocks of about ``BLOCK_TERMS`` terms, whatever the size of the benchmark.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgemart.llm.common import discard, staged
from forgemart.llm.contamination import _WORD_JAVA, LOWER, UPPER, words

BEST = 50
BLOCK_TERMS = 1 << 16  # terms of a block of items, about
LEAF = 64  # documents of a leaf
CELLS = 1 << 24  # frequencies in one tree, about
LAST = 2**63 - 1  # stands for a null id

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"

ORACLE_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
               FROM documents),
         n AS (SELECT row, doc_id, count(*) AS n FROM d GROUP BY ALL),
         c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
         m AS (SELECT row, doc_id, 50 + CAST((50 * n * docs) // total AS BIGINT) AS m FROM n, c),
         f AS (SELECT row, term, count(*) AS tf FROM d GROUP BY ALL),
         w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
               FROM f, c GROUP BY term, docs),
         q AS (SELECT DISTINCT item_id,
                      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
               FROM benchmark),
         s AS (SELECT item_id, row, doc_id,
                      CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
               FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL),
         r AS (SELECT item_id, doc_id, score,
                      CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
               FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""


def norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """``100 - 50 + (50 * n * docs) div total``, exact whatever the size of the corpus."""
    if int(n.max(initial=0)) * 50 * docs < 2**62:
        return 50 + (50 * n * docs) // total
    return np.array([50 + 50 * int(x) * docs // total for x in n], np.int64)


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's share of the score before its weight: grows with ``tf``, falls with ``m``."""
    tf = tf.astype(np.int64)
    return (10**9 * tf) // (1000 * tf + 20 * m[:, None])


class Tree:
    """Documents as sorted paths of terms, and the nodes above them."""

    def __init__(self, paths: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray, ids: np.ndarray, width: int):
        keys = [p.astype(">u4").tobytes() for p in paths]
        order = sorted(range(len(paths)), key=keys.__getitem__)
        self.m, self.ids = m[order], ids[order]
        lengths = np.array([len(paths[k]) for k in order])
        flat = np.concatenate([tfs[k] for k in order])
        kind = np.uint16 if flat.max() < 1 << 16 else np.int32
        self.tf = np.zeros((len(order), width), kind)
        self.tf[np.repeat(np.arange(len(order)), lengths), np.concatenate([paths[k] for k in order])] = flat
        self._grow([paths[k] for k in order], lengths)

    def _grow(self, paths: list[np.ndarray], lengths: np.ndarray) -> None:
        low, high, self.children = [0], [len(paths)], [[]]
        waiting = [(0, 0)]  # node, terms that its documents share
        while waiting:
            node, depth = waiting.pop()
            lo, hi = low[node], high[node]
            if hi - lo <= LEAF:
                continue
            first, last = paths[lo], paths[hi - 1]
            shared = min(len(first), len(last))
            apart = np.flatnonzero(first[depth:shared] != last[depth:shared])
            depth = depth + int(apart[0]) if len(apart) else shared
            steps = np.array([p[depth] if len(p) > depth else -1 for p in paths[lo:hi]])
            borders = [lo, *(lo + 1 + np.flatnonzero(np.diff(steps))).tolist(), hi]
            branches: list[tuple[int, int]] = []
            for a, b in zip(borders, borders[1:]):
                if steps[a - lo] < 0:  # equal sets of terms
                    branches += [(x, min(x + LEAF, b)) for x in range(a, b, LEAF)]
                elif branches and b - branches[-1][0] <= LEAF:
                    branches[-1] = (branches[-1][0], b)
                else:
                    branches.append((a, b))
            for a, b in branches:
                self.children[node].append(len(low))
                if b - a > LEAF:
                    waiting.append((len(low), depth + 1))
                low.append(a)
                high.append(b)
                self.children.append([])
        self.low, self.high = low, high
        self.peak = np.zeros((len(low), self.tf.shape[1]), self.tf.dtype)
        self.least = np.zeros(len(low), np.int64)
        for node in range(len(low) - 1, -1, -1):
            below = self.children[node]
            own = slice(low[node], high[node])
            self.peak[node] = (self.peak[below] if below else self.tf[own]).max(axis=0)
            self.least[node] = (self.least[below] if below else self.m[own]).min()

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, found: tuple[np.ndarray, np.ndarray]):
        """``found`` (scores and ids, best first) joined with this tree's documents, cut to the best ``k``."""
        scores, ids = found
        waiting = [(np.iinfo(np.int64).max, 0)]
        while waiting:
            bound, node = waiting.pop()
            least = scores[k - 1] if len(scores) >= k else 1
            if bound < least:
                continue
            below = self.children[node]
            if below:
                bounds = parts(self.peak[below][:, terms], self.least[below]) @ weights
                order = np.argsort(bounds, kind="stable")
                waiting += [(int(bounds[x]), below[x]) for x in order if bounds[x] >= least]
                continue
            own = slice(self.low[node], self.high[node])
            exact = parts(self.tf[own][:, terms], self.m[own]) @ weights
            good = np.flatnonzero(exact >= least)
            if len(good):
                scores, ids = np.concatenate([scores, exact[good]]), np.concatenate([ids, self.ids[own][good]])
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
        return scores, ids


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            found = words(text.as_buffer().to_pybytes() if text.is_valid else None)
            if found:
                known = [(vocabulary[t], c) for t, c in Counter(found).items() if t in vocabulary]
                rows.append((key, len(found), [t for t, _ in known], [c for _, c in known]))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        columns = [pa.array([r[x] for r in rows], kind) for x, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])


def _search(batches: Iterator[pa.RecordBatch], rank: np.ndarray, asked: list, docs: int, total: int, k: int):
    """The best ``k`` documents of a task for each item: its terms by number, and their weights."""
    width = len(rank)
    chunk = max(8, min(4096, CELLS // max(1, width)))
    empty = np.zeros(0, np.int64)
    found = [(empty, empty)] * len(asked)
    held: tuple[list, ...] = ([], [], [], [])

    def search_tree() -> None:
        paths, tfs, n, ids = held
        tree = Tree(paths, tfs, norms(np.array(n, np.int64), docs, total), np.array(ids, np.int64), width)
        for at, (terms, weights) in enumerate(asked):
            found[at] = tree.best(terms, weights, k, found[at])

    for batch in batches:
        columns = [batch.column(c) for c in ("terms", "tfs", "n", "doc_id")]
        for terms, tfs, n, key in zip(*columns):
            path = rank[terms.values.to_numpy()]
            order = np.argsort(path)
            held[0].append(path[order])
            held[1].append(tfs.values.to_numpy()[order])
            held[2].append(n.as_py())
            held[3].append(LAST if key.as_py() is None else key.as_py())
            if len(held[0]) == chunk:
                search_tree()
                held = ([], [], [], [])
    if held[0]:
        search_tree()
    for at, (scores, ids) in enumerate(found):
        columns = [pa.array(np.full(len(ids), at, np.int32)), pa.array(ids, mask=ids == LAST), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


def _block(docs: DataFrame, items: list, id_field: T.StructField, k: int) -> DataFrame:
    """The best documents of a block of items (item_id, terms)."""
    spark = docs.sparkSession
    vocabulary = {t: at for at, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    cut = functools.partial(_vectors, vocabulary={t.encode(): at for t, at in vocabulary.items()})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, VECTORS)
    rows = staged(rows, "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms
        df[r["term"]] = r["count"]
    number, total = size["docs"], size["total"] or 1
    rank = np.empty(len(df), np.int32)
    rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df), dtype=np.int32)
    asked = []
    for _, terms in items:
        known = [vocabulary[t] for t in terms if df[vocabulary[t]]]
        weights = [math.floor(1000 * math.log((2 * number + 2) / (2 * int(df[t]) + 1))) for t in known]
        asked.append((rank[known] if known else np.zeros(0, np.int32), np.array(weights, np.int64)))
    run = functools.partial(_search, rank=rank, asked=asked, docs=number, total=total, k=k)
    some = rows.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = some.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    best = staged(best, "ranks")
    discard(rows)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_field.dataType)])
    names = spark.createDataFrame([(at, key) for at, (key, _) in enumerate(items)], schema)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item.

    Null and empty texts have no terms: such documents don't count, such items give no rows. Items that share an id
    are one item with the terms of all its rows; so are those without an id. Documents that share a doc_id are ranked
    each by itself; equal scores go by ascending doc_id, a null one last. Empty tables give no rows. Other columns are
    not read.
    """
    cut = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(_WORD_JAVA), F.lit(0))
    asked = items.select("item_id", F.explode(cut).alias("term")).groupBy("item_id").agg(
        F.array_sort(F.collect_set("term")).alias("terms")
    )
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    id_field, found = items.schema["item_id"], []
    for at in range(blocks):
        rows = [(r["item_id"], r["terms"]) for r in dealt.filter(F.col("block") == at).collect()]  # of bounded size
        if rows:
            found.append(_block(docs, rows, id_field, k))
    if not found:
        schema = T.StructType(
            [
                T.StructField("item_id", id_field.dataType),
                T.StructField("rank", T.IntegerType()),
                T.StructField("doc_id", T.LongType()),
                T.StructField("score", T.LongType()),
            ]
        )
        return docs.sparkSession.createDataFrame([], schema)
    return functools.reduce(DataFrame.unionByName, found)
