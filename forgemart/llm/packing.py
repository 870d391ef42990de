"""Packing token streams into sequences of one size by dynamic programming over cut positions.

A task walks its documents in the order in which it reads them, so a stored table is packed in file order and
nothing is shuffled. Their ids form one stream. Possible cuts are document ends, sentence ends, and a grid that
bounds the distance between cuts inside long sentences. With ``best[j]`` the least cost of the stream up to cut j,

    best[i] = penalty[i] + min over j with position[i] - position[j] <= size of best[j] + padding(i - j).

Padding is ``size - length``, so the minimum of ``best[j] + position[j]`` over a sliding window is enough, which a
monotone queue gives in constant time; sequences whose length is a power of two need no padding and are looked up
one by one. The stream is settled in stretches; the unsettled rest joins the next stretch, so memory is bounded by
a stretch and the largest document.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forgemart.llm.common import batches, words

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
STRETCH = 1 << 19  # ids settled at a time
SENTENCE_PENALTY = 6  # ids of padding that a cut at a sentence end is worth
FREE_PENALTY = 24  # ids of padding that a cut inside a sentence is worth
GRID = 256  # largest distance between possible cuts
SHORT_PENALTY = 12  # ids of padding that one more short sequence is worth
APART = 24  # least distance between possible cuts inside a document
CACHED_WORDS, KEPT_WORDS = 600_000, 350_000  # words whose ids a worker keeps, and the first of these when it has more
_PUNCTUATION = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"  # ASCII but for the apostrophe and angle brackets
# Bytes that are printable in Latin-1 stand for themselves, the others for characters from U+0100 on, in turn.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(_HIDDEN)}
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)


def _latin(word: bytes) -> str:
    """The word in lower case if it is Latin letters alone, which the vocabulary takes as one piece; else empty."""
    if word.isalpha():
        return word.decode("ascii")
    text = unicodedata.normalize("NFC", word.decode("utf-8"))
    return text.lower() if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text else ""


def _as_bytes(text: str) -> str:
    """The characters that stand for the UTF-8 bytes of ``text`` in a byte-level vocabulary."""
    return "".join(map(_BYTE_CHARS.__getitem__, text.encode("utf-8")))


class Encoder:
    """Ids of whole texts. The vocabulary cuts at white space before anything else, so the ids of a text are those
    of its words in turn and each distinct word is encoded once; ASCII letters are lower-cased first, as the
    vocabulary does with all letters."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.codes: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keep the words learnt first, which are most of the frequent ones."""
        self.codes = dict(islice(self.codes.items(), KEPT_WORDS))
        self.starts = self.starts[: len(self.codes) + 1].copy()
        self.flat = self.flat[: self.starts[-1]].copy()

    def _learn(self, missing: list[bytes]) -> None:
        """Encode new words. Letters followed by punctuation are two pieces, each learnt once."""
        whole, pairs = dict.fromkeys(missing), {}
        for word in missing:
            core = word.rstrip(_PUNCTUATION)
            if core and core != word and _latin(core):
                pairs[word] = core, word[len(core) :]
                del whole[word]
                whole.update((x, None) for x in pairs[word] if x not in self.codes)
        plain = {x: text for x in whole if (text := _latin(x))}
        other = [x for x in whole if x not in plain]
        one = self.tokenizer.model.tokenize
        ids = [[t.id for t in one(text if text.isascii() else _as_bytes(text))] for text in plain.values()]
        texts = [x.decode("utf-8") for x in other]
        ids += [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self._store([*plain, *other], ids)
        self._store(list(pairs), [self._ids(core) + self._ids(rest) for core, rest in pairs.values()])

    def _ids(self, word: bytes) -> list[int]:
        k = self.codes[word]
        return self.flat[self.starts[k] : self.starts[k + 1]].tolist()

    def _store(self, new: list[bytes], ids: list[list[int]]) -> None:
        first = len(self.codes)
        self.codes.update(zip(new, range(first, first + len(new))))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(list(map(len, ids)), dtype=np.int64)])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers."""
        tokens, counts = [], []
        for text in texts:
            # Special tokens are looked for before letters are lower-cased: words that may hold one stay as they are.
            if text and "<|" in text:
                found = [w if b"<|" in w else w.lower() for w in words(text)]
            else:
                found = (text or "").encode().lower().split()
            tokens += found
            counts.append(len(found))
        if len(self.codes) > CACHED_WORDS:
            self.forget()
        at = np.fromiter(map(self.codes.get, tokens, repeat(-1)), np.int64, len(tokens))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(tokens[k] for k in unknown)))
            at[unknown] = [self.codes[tokens[k]] for k in unknown]
        starts = self.starts[at]
        lengths = self.starts[at + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(starts - ends + lengths, lengths)].astype("<u4")
        bounds = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(ids, bounds[:-1]) if len(texts) else []

    def sentence_ends(self) -> np.ndarray:
        """Ids of pieces that hold a full stop, question or exclamation mark."""
        return np.array([i for t, i in self.tokenizer.get_vocab().items() if t[0] in ".!?" and t.endswith("</w>")])


_encoders: dict[str, tuple[Encoder, np.ndarray]] = {}


def encoder(name: str) -> tuple[Encoder, np.ndarray]:
    """A worker's encoder and the ids that end a sentence."""
    if name not in _encoders:
        made = Encoder(public_tokenizers.path(name))
        _encoders[name] = made, made.sentence_ends()
    return _encoders[name]


def cheapest_cuts(positions: list[int], penalties: list[int], size: int = SEQUENCE) -> list[int]:
    """The cut positions of least cost, first and last included. Positions grow by at most ``size`` a step."""
    powers = [1 << k for k in range(size.bit_length() - 1)]
    index = {p: i for i, p in enumerate(positions)}
    best, before, value = [0] * len(positions), [0] * len(positions), [positions[0]] * len(positions)
    queue = deque([0])
    for i in range(1, len(positions)):
        p = positions[i]
        while positions[queue[0]] < p - size:
            queue.popleft()
        came = queue[0]
        cost = value[came] + size - p
        for length in powers:
            j = index.get(p - length)
            if j is not None and best[j] + SHORT_PENALTY < cost:
                came, cost = j, best[j] + SHORT_PENALTY
        best[i], before[i] = cost + penalties[i], came
        value[i] = reach = best[i] + p
        while queue and value[queue[-1]] >= reach:
            queue.pop()
        queue.append(i)
    cuts, i = [positions[-1]], len(positions) - 1
    while i:
        i = before[i]
        cuts.append(positions[i])
    return cuts[::-1]


def possible_cuts(ids: np.ndarray, ends: np.ndarray, marks: np.ndarray, last: bool) -> tuple[list[int], list[int]]:
    """Positions and penalties: document ends, sentence ends thinned to ``APART``, the grid, and near the end of the
    last stretch every position, so that the rest can be cut into powers of two."""
    total = len(ids)
    inside = np.flatnonzero(np.isin(ids, marks)) + 1
    inside = inside[np.diff(inside // APART, prepend=-1) != 0]
    fixed = np.unique(np.concatenate([[0], ends, [total]]))
    known = np.unique(np.concatenate([fixed, inside]))
    gaps = np.diff(known)
    wide = np.flatnonzero(gaps > GRID)
    grid = [np.arange(known[k] + GRID, known[k + 1], GRID) for k in wide]
    if last:
        grid.append(np.arange(max(0, total - SEQUENCE), total))
    grid = np.unique(np.concatenate([np.zeros(0, np.int64), *grid]))
    positions = np.union1d(known, grid)
    penalties = np.full(len(positions), FREE_PENALTY)
    penalties[np.isin(positions, inside)] = SENTENCE_PENALTY
    penalties[np.isin(positions, ends)] = 0
    penalties[[0, -1]] = 0
    return positions.tolist(), penalties.tolist()


class _Stream:
    """The unsettled part of a task's stream."""

    def __init__(self, partition: int, marks: np.ndarray):
        self.sequence, self.marks = partition << 33, marks
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, position of its first id (negative if settled), its number of ids
        self.length = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.length, len(ids) + 1))
        self.ids += [ids, np.array([END_ID], "<u4")]
        self.length += len(ids) + 1

    def settle(self, last: bool) -> pd.DataFrame:
        ids = np.concatenate(self.ids)
        ends = np.array([start + n for _, start, n in self.docs])
        cuts = cheapest_cuts(*possible_cuts(ids, ends, self.marks, last))
        if not last:
            cuts = cuts[:-1]  # the last sequence may still grow
        rows, doc = [], 0
        for a, b in zip(cuts, cuts[1:]):
            at = a
            while at < b:
                doc_id, start, n = self.docs[doc]
                end = min(b, start + n)
                crc = zlib.crc32(ids[at:end].tobytes())
                rows.append((doc_id, at - start, end - at, crc, n, self.sequence, at - a, b - a))
                at = end
                doc += at == start + n
            self.sequence += 1
        done = cuts[-1]
        self.docs = [(d, start - done, n) for d, start, n in self.docs[doc:]]
        self.ids, self.length = [ids[done:]], len(ids) - done
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        return frame.astype({"doc_id": "Int64"})


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece of a document in a sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and sequence_length, the ids in the sequence before padding.

    Null and empty texts are the end id alone. Each task packs the rows it reads, in order, with one unfilled
    sequence at most per task. Repeated and null doc_ids are packed row by row like any other. Other columns are not
    read. The order of rows must not change between attempts of a task: pack a stored table. With ``order``, tasks are
    ranges of these columns and doc_id, so sequence numbers follow them however the table is filed.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, marks = encoder(tokenizer)
        stream = _Stream(TaskContext.get().partitionId(), marks)
        for frame in batches(frames, 1 << 20):
            for doc_id, ids in zip(frame["doc_id"], coder.encode(frame["text"].tolist())):
                stream.add(None if pd.isna(doc_id) else int(doc_id), ids)
                if stream.length >= STRETCH:
                    yield stream.settle(False)
        if stream.length:
            yield stream.settle(True)

    if order:
        by = [*order, "doc_id", F.xxhash64("text")]
        docs = docs.repartitionByRange(*by).sortWithinPartitions(*by)
    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
