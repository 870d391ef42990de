"""Repeated passages: seeds from winnowing, extension to whole windows, removal of what a smaller document has.

1. Every run of ``SEED`` words is hashed and of ``WINDOW - SEED + 1`` neighbouring hashes the least is an anchor.
   Two equal windows hold the same runs, so they share an anchor: no passage of ``WINDOW`` words is missed.
2. Anchors that occur in two documents are seeds. Each is extended both ways to every window around it, and windows
   are grouped by their hash instead of comparing documents in pairs, so a passage that a third of all documents
   share costs one row per document and window.
3. Windows whose smallest document is another one are repeats; overlapping repeats join to maximal ones.

Copies of a whole document are settled by their digest before any of this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import batches, gram_hashes, staged, word_hashes, words

WINDOW = 50  # words of the shortest repeat that is removed
SEED = 20  # words of an anchor
LAST = 2**63 - 1  # stands for a null id


def anchors(hashes: np.ndarray, window: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """The least hash of each ``window - seed + 1`` neighbouring seed hashes, each once."""
    least, reach, width = gram_hashes(hashes, seed), 1, window - seed + 1
    if len(least) < width:
        return np.zeros(0, np.uint64)
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return np.unique(least)


def windows_around(hashes: np.ndarray, seeds: np.ndarray, window: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """The hashes of the windows that hold a seed, each once."""
    whole = gram_hashes(hashes, window)
    if not len(whole):
        return whole
    found = np.isin(gram_hashes(hashes, seed), seeds)
    sums = np.concatenate([[0], np.cumsum(found)])
    starts = np.arange(len(whole))
    return np.unique(whole[sums[starts + window - seed + 1] > sums[starts]])


def covered(hashes: np.ndarray, repeats: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words are covered by repeated windows."""
    out = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(np.isin(gram_hashes(hashes, window), repeats))
    out[: len(hashes)][at] += 1
    np.subtract.at(out, at + window, 1)
    return np.cumsum(out[:-1]) > 0


def _sha(tokens: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(tokens)).hexdigest()


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches(frames):
        rows = []
        for key, text in zip(frame["key"], frame["text"]):
            tokens = words(text)
            found = anchors(word_hashes(tokens)) if len(tokens) >= WINDOW else np.zeros(0, np.uint64)
            rows.append((key, len(tokens), _sha(tokens), found.astype(np.int64)))
        yield pd.DataFrame(rows, columns=["key", "n_words", "sha", "anchors"])


def _extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches(frames):
        rows = []
        for key, text, seeds in zip(frame["key"], frame["text"], frame["seeds"]):
            hashes = word_hashes(words(text))
            rows.append((key, text, windows_around(hashes, np.asarray(seeds).astype(np.uint64)).astype(np.int64)))
        yield pd.DataFrame(rows, columns=["key", "text", "windows"])


def _remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches(frames):
        rows = []
        for key, text, repeats in zip(frame["key"], frame["text"], frame["repeats"]):
            tokens = words(text)
            gone = covered(word_hashes(tokens), np.asarray(repeats).astype(np.uint64))
            left = [t for t, g in zip(tokens, gone.tolist()) if not g]
            rows.append((key, _sha(tokens), int(gone.sum()), _sha(left), b" ".join(left).decode()))
        yield pd.DataFrame(rows, columns=["key", "sha", "n_removed", "kept_sha256", "kept"])


def _shared(rows: DataFrame, item: str) -> DataFrame:
    """(item, key) without the items that one document alone has, and the smallest key of each item."""
    least = rows.groupBy(item).agg(F.min("key").alias("least"), F.max("key").alias("most"))
    least = least.filter(F.col("least") < F.col("most")).select(item, "least")
    return rows.join(least, item)


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per document (key, n_words, sha, first): ``first`` is the smallest key with the same words; and per document
    with repeats, copies of smaller documents apart, (key, sha, n_removed, kept_sha256, kept)."""
    base = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("key"), "text")
    scanned = base.mapInPandas(_scan, "key long, n_words long, sha string, anchors array<long>")
    scanned = staged(scanned, "anchors")
    first = scanned.groupBy("sha").agg(F.min("key").alias("first"))
    known = scanned.select("key", "n_words", "sha").join(first, "sha")
    unique = scanned.join(first.select(F.col("first").alias("key"), "sha"), ["key", "sha"], "left_semi")
    seeds = _shared(unique.select("key", F.explode("anchors").alias("anchor")).distinct(), "anchor")
    seeds = seeds.groupBy("key").agg(F.collect_set("anchor").alias("seeds"))
    texts = base.filter(F.length("text") >= 2 * WINDOW - 1).join(seeds, "key")
    extended = staged(texts.mapInPandas(_extend, "key long, text string, windows array<long>"), "windows")
    found = _shared(extended.select("key", F.explode("windows").alias("window")), "window")
    found = found.filter(F.col("key") > F.col("least"))
    found = found.groupBy("key").agg(F.collect_set("window").alias("repeats"))
    removed = extended.select("key", "text").join(found, "key")
    schema = "key long, sha string, n_removed long, kept_sha256 string, kept string"
    return known, removed.mapInPandas(_remove, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of ``WINDOW`` words around it also starts in a document with a smaller doc_id. Null and
    empty texts have no words and keep the digest of the empty text. A null doc_id is larger than all others;
    rows that share a doc_id don't remove from each other. Other columns are not read.
    """
    known, removed = repeats(docs)
    removed = removed.select("key", "sha", "n_removed", "kept_sha256").dropDuplicates(["key", "sha"])
    joined = known.join(removed, ["key", "sha"], "left")
    copy = (F.col("first") < F.col("key")) & (F.col("n_words") >= WINDOW)
    return joined.select(
        F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def cleaned_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that lose words: what is left, joined by single spaces; copies of a smaller
    document lose all of at least ``WINDOW`` words."""
    known, removed = repeats(docs)
    copies = known.filter((F.col("first") < F.col("key")) & (F.col("n_words") >= WINDOW))
    both = removed.select("key", F.col("kept").alias("text")).unionByName(copies.select("key", F.lit("").alias("text")))
    return both.distinct().select(F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"), "text")
