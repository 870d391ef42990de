"""Benchmark passages in documents, found in a positional inverted index.

1. Documents are laid end to end in shards of about ``SHARD_CHARS`` characters. Of every shard each word is one row:
   its places, as steps from one to the next. A document lies in one shard, so no phrase crosses shards, and a word
   with a third of all places is one short list per shard. The table is stored and can be searched again.
2. A test phrase is looked up per shard. The places of its rarest word, moved back by that word's offset, are the
   candidate starts; the other words, rarest first, keep a candidate if they stand at their own offset from it. With
   ``slack`` each word may stand up to so many words off its place, a proximity match, and starts near those of the
   rarest word are candidates too. All phrases of a shard take each step at once.
3. Places that phrases cover are marked in the shard, so that overlapping matches count once.

Test phrases are sent to the tasks in blocks of about ``BLOCK_WORDS`` words, whatever the size of the benchmark.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import discard, staged

WINDOW = 10
SHARD_CHARS = 4 << 20
BLOCK_WORDS = 1 << 20  # words of a block of test phrases, about
PIECE = 4096  # windows of one item that stay together
CANDIDATES = 1 << 20  # looked at together

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WORD_JAVA = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

INDEX = "shard long, term binary, steps array<int>, place int, doc_id long, start int, n_words int"
FOUND = "shard long, place int, doc_id long, n_words int, starts array<int>, ends array<int>, items array<string>"

ORACLE_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
               FROM documents),
         b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
               FROM benchmark),
         p AS (SELECT item, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS phrase
               FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM b WHERE len(w) > 0)),
         s AS (SELECT row, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase
               FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS k
                     FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
         m AS (SELECT row, item, k, n FROM s JOIN p USING (n, phrase)),
         h AS (SELECT row, count(DISTINCT pos) AS n_hit
               FROM (SELECT row, unnest(generate_series(k, k + n - 1)) AS pos FROM m) GROUP BY row),
         i AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
               FROM m GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (row) LEFT JOIN i USING (row)"""


def words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    return _WORD.findall(text.lower()) if text else []


def _shard(number: int, ids: list, lengths: list[int], tokens: list[bytes]) -> pa.RecordBatch:
    """The rows of a shard: first its documents, then its words. One place between two documents stays free."""
    count, sizes = len(ids), np.array(lengths, np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int32)
    codes, distinct = pd.factorize(np.array(tokens, dtype=object))
    places = np.arange(len(tokens), dtype=np.int32) + np.repeat(np.arange(count, dtype=np.int32), sizes)
    places = places[np.argsort(codes, kind="stable")]
    borders = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(distinct)))]).astype(np.int32)
    steps = np.diff(places, prepend=np.int32(0))
    steps[borders[:-1]] = places[borders[:-1]]
    total = count + len(distinct)
    lists = pa.ListArray.from_arrays(np.concatenate([np.zeros(count, np.int32), borders]), steps)
    pad = lambda values, kind: pa.concat_arrays([pa.array(values, kind), pa.nulls(len(distinct), kind)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(total, number)),
            pa.concat_arrays([pa.nulls(count, pa.binary()), pa.array(distinct.tolist(), pa.binary())]),
            lists,
            pad(np.arange(count, dtype=np.int32), pa.int32()),
            pad(ids, pa.int64()),
            pad(starts, pa.int32()),
            pad(sizes, pa.int32()),
        ],
        names=["shard", "term", "steps", "place", "doc_id", "start", "n_words"],
    )


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids, lengths, tokens, chars = [], [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            found = words(text.as_buffer().to_pybytes() if text.is_valid else None)
            ids.append(key)
            lengths.append(len(found))
            tokens += found
            chars += len(text.as_buffer()) if text.is_valid else 0
            if chars >= SHARD_CHARS or len(ids) >= 1 << 16:
                yield _shard(number, ids, lengths, tokens)
                ids, lengths, tokens, chars, number = [], [], [], 0, number + 1
    if ids:
        yield _shard(number, ids, lengths, tokens)


def build_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text): per shard one row for each document (place, doc_id, start,
    n_words) and one for each word (term, steps). Goes to ``path``, or to the scratch folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_index, INDEX)
    return staged(rows, "postings", path, compression="zstd")


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """(item, words): every window of every item lies in one row; a row has ``PIECE`` windows at most."""
    cut = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(_WORD_JAVA), F.lit(0))
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), cut.alias("words"))
    rows = rows.filter(F.size("words") > 0)
    at = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(PIECE))
    rows = rows.withColumn("at", F.explode(at))
    return rows.select("item", F.slice("words", F.col("at") + 1, PIECE + window - 1).alias("words"))


class Phrases:
    """The windows of a block of pieces as rows of word numbers, -1 behind the end of a short one."""

    def __init__(self, pieces: list[tuple[str, list[str]]], window: int):
        self.items = sorted({item for item, _ in pieces})
        numbers = {item: k for k, item in enumerate(self.items)}
        self.terms: dict[bytes, int] = {}
        rows, owners = [], []
        for item, found in pieces:
            codes = [self.terms.setdefault(w.encode(), len(self.terms)) for w in found]
            codes = np.array(codes + [-1] * (window - len(codes)), np.int32)
            views = np.lib.stride_tricks.sliding_window_view(codes, window)
            rows.append(views)
            owners.append(np.full(len(views), numbers[item], np.int32))
        both = np.unique(np.column_stack([np.concatenate(owners), np.concatenate(rows)]), axis=0)
        self.owners, self.rows = both[:, 0], both[:, 1:]
        self.lengths = (self.rows >= 0).sum(axis=1)


def matches(phrases: Phrases, terms: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray, slack: int):
    """Blocks of (phrase, document, first place, place after the last) in a shard.

    ``terms`` and ``places`` are the postings, sorted by both; ``starts`` and ``ends`` the documents' places.
    """
    span = np.int64(ends[-1] + 1) if len(ends) else np.int64(1)
    keys = terms.astype(np.int64) * span + places
    counts = np.bincount(terms, minlength=len(phrases.terms))
    heads = np.concatenate([[0], np.cumsum(counts)])
    used = phrases.rows >= 0
    frequency = np.where(used, counts[phrases.rows], np.iinfo(np.int64).max)
    alive = np.flatnonzero((frequency > 0).all(axis=1))
    order = np.argsort(frequency[alive], axis=1, kind="stable")  # the rarest word first
    rarest = phrases.rows[alive, order[:, 0]]
    group = np.cumsum(counts[rarest]) // CANDIDATES
    for part in np.split(np.arange(len(alive)), np.flatnonzero(np.diff(group)) + 1):
        number = counts[rarest[part]]
        at = np.repeat(part, number)
        within = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
        place = places[heads[rarest[at]] + within].astype(np.int64)
        doc = np.searchsorted(starts, place, side="right") - 1
        start = place - order[at, 0]
        if slack:
            shifts = np.arange(-slack, slack + 1)
            moved = (start[:, None] + shifts).ravel()
            both = np.column_stack([np.repeat(at, len(shifts)), moved, np.repeat(doc, len(shifts))])
            at, start, doc = np.unique(both, axis=0).T
            first, last = np.full(len(at), span), np.full(len(at), -1)
        else:
            fits = (start >= starts[doc]) & (start + phrases.lengths[alive[at]] <= ends[doc])
            at, doc, start = at[fits], doc[fits], start[fits]
            first, last = start, start + phrases.lengths[alive[at]] - 1
        for step in range(0 if slack else 1, phrases.rows.shape[1]):
            term = phrases.rows[alive[at], order[at, step]]
            here = start + order[at, step]
            low = np.maximum(here - slack, starts[doc])
            high = np.minimum(here + slack, ends[doc] - 1)
            found = np.searchsorted(keys, term * span + low)
            hit = keys[np.minimum(found, len(keys) - 1)]
            good = (found < len(keys)) & (hit <= term * span + high) & (low <= high)
            keep = good | (term < 0)
            if slack:
                near = hit - term * span
                first = np.where(term < 0, first, np.minimum(first, near))
                last = np.where(term < 0, last, np.maximum(last, near))
            at, doc, start, first, last = at[keep], doc[keep], start[keep], first[keep], last[keep]
        yield alive[at], doc, first, last + 1


def _runs(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and word after the last of each run of marked places."""
    edges = np.diff(hit.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    left, right = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    doc = np.searchsorted(starts, left, side="right") - 1
    return doc, left - starts[doc], right - starts[doc]


def _lists(owner: np.ndarray, values: pa.Array, count: int) -> pa.ListArray:
    """One list for each of ``count`` owners; ``owner`` ascends."""
    borders = np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(borders, values)


def _search_shard(table: pa.Table, phrases: Phrases, slack: int) -> pa.Table:
    table = table.combine_chunks()
    is_doc = table.column("term").is_null()
    docs, posted = table.filter(is_doc).sort_by("place"), table.filter(pc.invert(is_doc))
    count = docs.num_rows
    starts = docs.column("start").to_numpy().astype(np.int64)
    ends = starts + docs.column("n_words").to_numpy()
    numbers = np.array([phrases.terms.get(t, -1) for t in posted.column("term").to_pylist()], np.int64)
    order = np.argsort(numbers, kind="stable")
    order = order[numbers[order] >= 0]
    hit = np.zeros(int(ends[-1]) + 1 if count else 1, np.int32)
    pairs = np.zeros(0, np.int64)
    if len(order):
        lists = posted.column("steps").combine_chunks().take(pa.array(order))
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        sums = np.cumsum(lists.flatten().to_numpy(), dtype=np.int64)
        before = np.concatenate([[0], sums[np.cumsum(sizes) - 1]])[:-1]  # what earlier lists added
        places = sums - np.repeat(before, sizes)
        terms = np.repeat(numbers[order], sizes)
        for phrase, doc, first, last in matches(phrases, terms, places, starts, ends, slack):
            np.add.at(hit, first, 1)
            np.subtract.at(hit, last, 1)
            pairs = np.union1d(pairs, doc * len(phrases.items) + phrases.owners[phrase])
    doc, left, right = _runs(np.cumsum(hit) > 0, starts, ends)
    names = pa.array(phrases.items, pa.string()).take(pa.array(pairs % len(phrases.items)))
    return pa.table(
        {
            "shard": docs.column("shard"),
            "place": docs.column("place"),
            "doc_id": docs.column("doc_id"),
            "n_words": docs.column("n_words"),
            "starts": _lists(doc, pa.array(left, pa.int32()), count),
            "ends": _lists(doc, pa.array(right, pa.int32()), count),
            "items": _lists(pairs // len(phrases.items), names, count),
        }
    )


def _searcher(phrases: Phrases, slack: int):
    def run(table: pa.Table) -> pa.Table:
        return _search_shard(table, phrases, slack)

    return run


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """One row per indexed document: shard, place (of the document in its shard), doc_id, n_words, spans (arrays of
    first word and word after the last, merged) and items (those with a window in the document, as sorted strings).

    ``slack`` 0 finds phrases. Above it a window matches at a start if each of its words occurs within so many words
    of its place from there; the span reaches from the first to the last of these words. A document without a match
    has empty arrays.
    """
    if window < 1 or slack < 0:
        raise ValueError("window must be positive and slack not negative")
    pieces = _pieces(items, window)
    number = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-number // BLOCK_WORDS)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))))
    documents = index.filter(F.col("term").isNull())
    empty = F.array().cast("array<int>")
    found = []
    for k in range(blocks):
        block = dealt.filter(F.col("block") == k).select("item", "words")
        rows = [(r["item"], r["words"]) for r in block.collect()]  # a block of bounded size
        if not rows:
            continue
        phrases = Phrases(rows, window)
        wanted = block.select(F.explode(F.col("words").cast("array<binary>")).alias("term")).distinct()
        posted = index.join(wanted, "term", "left_semi").select(*index.columns).unionByName(documents)
        found.append(posted.groupBy("shard").applyInArrow(_searcher(phrases, slack), FOUND))
    if not found:
        none = F.array().cast("array<string>").alias("items")
        found = [documents.select("shard", "place", "doc_id", "n_words", empty.alias("starts"), empty.alias("ends"), none)]
    rows = functools.reduce(DataFrame.unionByName, found)
    rows = rows.select("shard", "place", "doc_id", "n_words", F.arrays_zip("starts", "ends").alias("spans"), "items")
    rows = rows.groupBy("shard", "place", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<starts:int,ends:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["ends"] >= s["starts"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["starts"].alias("starts"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["ends"], s["ends"]).alias("ends"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return rows.withColumn("spans", merged) if blocks > 1 else rows


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of a shorter item whole.
    Null and empty texts have no words, an item without words no windows. Items that share an id count as one; a null
    item id is an id of its own, written as an empty text. Rows that share a doc_id, or have none, are judged each by
    itself. An empty table of items leaves all documents clean. Other columns are not read.
    """
    index = build_index(docs)
    found = staged(search(index, items, window), "contamination")
    discard(index)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["ends"] - s["starts"]))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
