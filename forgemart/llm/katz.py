"""A Katz backoff model of word pairs, trained and evaluated without moving any text.

    P(w | h) = d(c) c(h, w) / c(h)   if the pair was seen c times, with Good-Turing discounts d for small c
             = alpha(h) P(w)         otherwise

``alpha(h)`` is the mass that the discounts leave, over the mass of the words not seen after h, so each distribution
sums to one exactly. The recursion ends in the additive unigram distribution, which gives unknown words a chance.

Documents are stored once as word numbers in chunks, a table bucketed by chunk. Counts, pair counts and backoff weights live in
tables partitioned by hash. A chunk asks for each of its different words or pairs once, with its own training
counts, so a word that makes up a third of the corpus is one request per chunk; the partition adds up all chunks
and answers in the order of the request. Answers are joined to the bucketed chunks, which are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import batches, bucketed, mix, part_of, release, staged, word_hashes

CHUNK_CHARS = 4 << 20
DISCOUNTED = 5  # counts up to this are discounted
DROPPED_BITS = np.uint64(16)
END, START = np.uint64(1 << 16), np.uint64(2 << 16)  # stand for the end of a text, as a token, and its start, as a context
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_ANSWERS = "chunk long, part int, answer binary"
_STORED = ["chunk", "ids", "named", "held", "lengths", "vocabulary", "tokens"]


def _read(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text, the different words as ascending numbers, and the place there of every token."""
    tokens, counts = [], []
    for text in texts:
        own = (text or "").encode("utf-8").lower().split()
        counts.append(len(own) + 1)
        tokens += own
    lengths = np.array(counts, np.int64)
    stream = np.full(int(lengths.sum()) + 1, END, np.uint64)
    inside = np.ones(len(stream), bool)
    inside[np.cumsum(lengths) - 1] = False
    inside[-1] = False
    stream[inside] = word_hashes(tokens)
    stream[-1] = START
    words, place = np.unique(stream, return_inverse=True)
    return lengths, words, place[:-1]


class Chunk:
    """The words of a chunk's texts as numbers and its different words."""

    def __init__(self, row):
        held = np.frombuffer(row.held, bool)
        self.lengths = np.frombuffer(row.lengths, "<i8")
        self.train = np.repeat(~held, self.lengths)
        self.words = np.cumsum(_expanded(row.vocabulary, "<u8")[0], dtype=np.uint64)
        self.word_of = _expanded(row.tokens, "<u4")[0].astype(np.int64)
        self.doc_of = np.repeat(np.arange(len(held)), self.lengths)

    def find_pairs(self) -> Chunk:
        """Number the pairs as well: their keys, the place of each token's pair, the words of each."""
        before = np.roll(self.word_of, 1)
        before[np.cumsum(self.lengths) - self.lengths] = np.searchsorted(self.words, START)
        pair = mix(self.words[before] * np.uint64(0x9E3779B97F4A7C15) + mix(self.words)[self.word_of])
        self.pairs, first, self.pair_of = np.unique(pair, return_index=True, return_inverse=True)
        self.left, self.right = before[first], self.word_of[first]
        return self

    def counts(self, of: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(of[self.train], minlength=size).astype("<u4")


def _packed(keys: np.ndarray) -> np.ndarray:
    """The steps between ascending keys cut to 48 bits: with the partition, which comes from all 64, those tell keys
    apart."""
    return np.diff(keys >> DROPPED_BITS, prepend=np.uint64(0))


def _unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(_expanded(blob, "<u8")[0], dtype=np.uint64)


def _squeezed(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed; whole numbers by byte planes, as their high bytes are alike."""
    flat = [c.view(np.uint8).reshape(-1, c.itemsize).T if c.dtype.kind in "iu" else c for c in map(np.ascontiguousarray, columns)]
    return zstandard.compress(b"".join(c.tobytes() for c in flat), 1)


def _expanded(blob: bytes, *kinds: str) -> list[np.ndarray]:
    """The columns of a compressed blob."""
    joined, out, at = zstandard.decompress(blob), [], 0
    types = [np.dtype(k) for k in kinds]
    size = len(joined) // sum(t.itemsize for t in types)
    for kind in types:
        column = np.frombuffer(joined, np.uint8, size * kind.itemsize, at)
        if kind.kind in "iu":
            column = np.ascontiguousarray(column.reshape(kind.itemsize, size).T)
        out.append(column.view(kind).ravel())
        at += size * kind.itemsize
    return out


def _order(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys sorted by partition, and where each partition starts."""
    part = (mix(keys) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _ask(chunk: int, keys: np.ndarray, columns: list[np.ndarray], parts: int) -> pd.DataFrame:
    order, starts = _order(keys, parts)
    rows = []
    for part in np.flatnonzero(np.diff(starts)):
        at = order[starts[part] : starts[part + 1]]
        rows.append((chunk, int(part), _squeezed(_packed(keys[at])), _squeezed(*(c[at] for c in columns))))
    return pd.DataFrame(rows, columns=["chunk", "part", "keys", "own"])


def _answered(blobs: list, parts_of: list, keys: np.ndarray, parts: int, *kinds: str) -> list[np.ndarray]:
    """One number of each kind per key from the answers of all partitions."""
    order, _ = _order(keys, parts)
    found = [_expanded(b, *kinds) for _, b in sorted(zip(parts_of, blobs))]
    out = []
    for k, kind in enumerate(kinds):
        column = np.zeros(len(keys), kind)
        column[order] = np.concatenate([f[k] for f in found])
        out.append(column)
    return out


def _merged(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The requests of a partition in chunk order, their lengths, their different keys and the place of each."""
    frame = frame.sort_values("chunk")
    keys = [_unpacked(k) for k in frame["keys"]]
    different, place = np.unique(np.concatenate(keys), return_inverse=True)
    return frame, np.array([len(k) for k in keys]), different, place


def _answer(frame: pd.DataFrame, lengths: np.ndarray, *values: np.ndarray) -> pd.DataFrame:
    ends = np.cumsum(lengths)[:-1]
    blobs = [_squeezed(*columns) for columns in zip(*(np.split(v, ends) for v in values))]
    return pd.DataFrame({"chunk": frame["chunk"].to_numpy(), "part": frame["part"].to_numpy(), "answer": blobs})


def _sum_counts(frame: pd.DataFrame) -> pd.DataFrame:
    """Training counts of all chunks; a last row, for no chunk, has the number of tokens and of known words."""
    frame, lengths, different, place = _merged(frame)
    own = np.concatenate([_expanded(c, "<u4")[0] for c in frame["own"]])
    total = np.bincount(place, weights=own, minlength=len(different)).astype("<i8")
    out = _answer(frame, lengths, total[place].astype("<i8"))
    totals = np.array([total.sum(), (total > 0).sum()], "<i8")
    return pd.concat([out, pd.DataFrame([(-1, out["part"].iloc[0], totals.tobytes())], columns=out.columns)])


def _sum_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Twice the training count of each pair, one more for the first chunk that asks; a last row, for no chunk, has
    how many pairs occur once, twice and so on."""
    frame, lengths, different, place = _merged(frame)
    own = np.concatenate([_expanded(c, "<u4")[0] for c in frame["own"]])
    total = np.bincount(place, weights=own, minlength=len(different)).astype("<i8")
    values = total[place] * 2
    values[np.unique(place, return_index=True)[1]] += 1
    out = _answer(frame, lengths, values)
    of = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3).astype("<i8")
    return pd.concat([out, pd.DataFrame([(-1, out["part"].iloc[0], of.tobytes())], columns=out.columns)])


def _sum_backoff(frame: pd.DataFrame) -> pd.DataFrame:
    """Discounted pair counts after each context and counts of the words seen there, one added to each, of all
    chunks."""
    frame, lengths, different, place = _merged(frame)
    own = [_expanded(c, "<f8", "<i8") for c in frame["own"]]
    seen, after = np.zeros(len(different)), np.zeros(len(different), np.int64)
    np.add.at(seen, place, np.concatenate([o[0] for o in own]))
    np.add.at(after, place, np.concatenate([o[1] for o in own]))
    return _answer(frame, lengths, seen[place], after[place])


def backoff(seen: np.ndarray, base: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The divisor and the backoff weight of contexts, 0 and 1 for one never seen."""
    # A context whose pairs are all frequent is not discounted: one more in the divisor leaves mass to back off.
    divisor = np.where(total > 0, np.where(seen > total - 0.5, total + 1, total), 0.0)
    alpha = np.where(total > 0, (1 - seen / np.maximum(divisor, 1)) / np.maximum(1 - base, 1e-300), 1.0)
    return divisor, alpha


def discounts(occur: np.ndarray) -> np.ndarray:
    """Katz's discounts for counts 0 to ``DISCOUNTED`` from how many pairs occur once, twice and so on; where
    Good-Turing gives none between 0 and 1, half a count is taken off."""
    out = np.ones(DISCOUNTED + 1)
    many = (DISCOUNTED + 1) * occur[DISCOUNTED + 1] / occur[1] if occur[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        turing = (r + 1) * occur[r + 1] / (r * occur[r]) if occur[r] else 1.0
        d = (turing - many) / (1 - many) if many < 1 else 1.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, factors[np.minimum(counts, DISCOUNTED)], 1.0)


def _store(docs: DataFrame, held_out) -> DataFrame:
    """The documents as word numbers in chunks, a table bucketed by chunk: texts are cut into words once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for frame in batches(frames, CHUNK_CHARS):
            held = frame["held"].to_numpy(bool).tobytes()
            named = frame["doc_id"].notna().to_numpy().tobytes()
            ids = frame["doc_id"].fillna(0).to_numpy("<i8").tobytes()
            lengths, words, place = _read(list(frame["text"]))
            steps = np.diff(words, prepend=np.uint64(0))
            row = (number, ids, named, held, lengths.tobytes(), _squeezed(steps), _squeezed(place.astype("<u4")))
            yield pd.DataFrame([row], columns=_STORED)
            number += 1

    schema = ", ".join(f"{c} {'long' if c == 'chunk' else 'binary'}" for c in _STORED)
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held")).mapInPandas(run, schema)
    return bucketed(rows, "chunks", "chunk")


def score(docs: DataFrame, held_out=None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``held_out`` (by default crc32 of the id modulo 7 being 2) does not hold. Null and
    empty texts are the end token alone. Repeated rows are learnt from and scored as often as they occur; a null
    doc_id is not held out. Without training rows all scores are those of unknown words. Other columns are not read.
    """
    chunks = _store(docs, part_of("doc_id", 7) == 2 if held_out is None else held_out)
    parts = max(1, chunks.select("chunk").count())

    def each(frames: Iterator[pd.DataFrame], use: Callable) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield use(row, Chunk(row))

    def table(request: Callable, source: DataFrame, reduce: Callable) -> DataFrame:
        asked = source.mapInPandas(lambda frames: each(frames, request), "chunk long, part int, keys binary, own binary")
        answers = staged(asked.groupBy("part").applyInPandas(reduce, _ANSWERS), "answers")
        del asked
        release(docs.sparkSession)
        return answers

    def with_answers(source: DataFrame, answers: DataFrame, name: str) -> DataFrame:
        lists = answers.filter("chunk >= 0").groupBy("chunk").agg(
            F.collect_list("part").alias(f"{name}_parts"), F.collect_list("answer").alias(name)
        )
        return source.join(lists.hint("merge"), "chunk")

    def totals(answers: DataFrame, size: int) -> np.ndarray:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(size, np.int64)
            for frame in frames:
                for blob in frame["answer"]:
                    total += np.frombuffer(blob, "<i8")
            yield pd.DataFrame({"k": np.arange(size), "n": total})

        rows = answers.filter("chunk < 0").select("answer").mapInPandas(run, "k int, n long")
        found = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.sum("n").alias("n")).collect()}
        return np.array([found.get(k, 0) for k in range(size)], np.int64)

    def pair_counts(row, c: Chunk) -> pd.DataFrame:
        c.find_pairs()
        return _ask(row.chunk, c.pairs, [c.counts(c.pair_of, len(c.pairs))], parts)

    words = table(lambda row, c: _ask(row.chunk, c.words, [c.counts(c.word_of, len(c.words))], parts), chunks, _sum_counts)
    pairs = table(pair_counts, chunks, _sum_pairs)
    tokens, known = (int(x) for x in totals(words, 2))
    factors = discounts(totals(pairs, DISCOUNTED + 3))
    mass = float(tokens + known + 1)

    def seen(row, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of words and pairs, and of words as contexts: a start is followed as often as there are ends."""
        c.find_pairs()
        (count,) = _answered(row.words, row.words_parts, c.words, parts, "<i8")
        (of_pair,) = _answered(row.pairs, row.pairs_parts, c.pairs, parts, "<i8")
        context = count.astype(np.float64)
        context[np.searchsorted(c.words, START)] = context[np.searchsorted(c.words, END)]
        context[np.searchsorted(c.words, END)] = 0
        return count, of_pair, context

    def sums(row, c: Chunk) -> pd.DataFrame:
        count, of_pair, _ = seen(row, c)
        times = np.where(of_pair & 1, of_pair >> 1, 0)
        mine = times > 0
        discounted = np.bincount(c.left[mine], weights=_discounted(times[mine], factors), minlength=len(c.words))
        after = np.zeros(len(c.words), np.int64)
        np.add.at(after, c.left[mine], count[c.right[mine]] + 1)
        return _ask(row.chunk, c.words, [discounted, after], parts)

    joined = with_answers(with_answers(chunks, words, "words"), pairs, "pairs")
    after = table(sums, joined, _sum_backoff)

    def final(row, c: Chunk) -> pd.DataFrame:
        count, of_pair, context = seen(row, c)
        discounted, followers = _answered(row.after, row.after_parts, c.words, parts, "<f8", "<i8")
        divisor, alpha = backoff(discounted, followers / mass, context)
        times = of_pair >> 1
        base = (count + 1) / mass
        high = _discounted(times, factors) / np.maximum(divisor[c.left], 1)
        value = np.log10(np.where(times > 0, high, alpha[c.left] * base[c.right]))
        n = len(c.lengths)
        add = lambda x: np.bincount(c.doc_of, weights=x, minlength=n)
        ids = pd.array(np.frombuffer(row.ids, "<i8"), dtype="Int64")
        ids[~np.frombuffer(row.named, bool)] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": np.frombuffer(row.held, bool),
                "n_tokens": c.lengths,
                "n_known": add(count[c.word_of] > 0).astype(np.int64),
                "train_tokens": np.full(n, tokens),
                "base_score": add(np.log10(base)[c.word_of]),
                "score": add(value[c.pair_of]),
            }
        )

    return with_answers(joined, after, "after").mapInPandas(lambda frames: each(frames, final), SCHEMA)
