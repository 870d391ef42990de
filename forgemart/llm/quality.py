"""Quality by nearest neighbours among labelled rows in a latent space.

Terms are shapes: letters, capitals, digits and line ends stand for their kind, punctuation for itself, runs of a
kind count once, and one to three kinds in a row make a term. Some measures of repetition and length are further
terms. The bounded labelled sample gives term weights and a singular value decomposition; its vectors are broadcast,
and each task computes the cosines of its documents to all of them in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import batches, labelled_sample, mix, part_of, words

SAMPLE_ROWS = 6000  # labelled rows that the space is fitted on and neighbours are taken from, at most
TERMS = 1024
RANK = 48
NEIGHBOURS = 15
BLOCK = 1024
MEASURES = 24
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def _kinds() -> np.ndarray:
    """A number for each character below U+0250."""
    out = np.zeros(0x251, np.uint64)
    for code in range(0x250):
        c = chr(code)
        kind = 1 if c.isalpha() and not c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in " \t" else 5 if c in "\r\n" else 6 + code
        out[code] = kind
    out[0x250] = 1
    return out


_KIND = _kinds()


def _measures(tokens: list[bytes], text: str) -> list[tuple[int, float]]:
    """Repetition and length as graded terms: the two grades next to a value share its weight."""
    lines = text.split("\n")
    values = (len(set(tokens)) / max(1, len(tokens)), len(set(lines)) / len(lines), min(1.0, np.log2(len(tokens) + 1) / 14))
    out = []
    for k, value in enumerate(values):
        place = value * 7
        low = int(place)
        out += [(k * 8 + low, 1 - (place - low)), (k * 8 + min(7, low + 1), place - low)]
    return out


def terms(text: str | None) -> np.ndarray:
    """The weights of the terms of one text before term weighting: logarithms of counts."""
    out = np.zeros(TERMS, np.float32)
    text = text or ""
    kinds = _KIND[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), "<u4"), 0x250)]
    if len(kinds):
        kinds = kinds[np.flatnonzero(np.diff(kinds, prepend=np.uint64(0)))]
        for n in (1, 2, 3):
            key = np.full(max(0, len(kinds) - n + 1), n, np.uint64)
            for k in range(n):
                key = key * np.uint64(1024) + kinds[k : k + len(key)]
            slot = (mix(key) % np.uint64(TERMS - MEASURES)).astype(np.int64)
            out[: TERMS - MEASURES] += np.bincount(slot, minlength=TERMS - MEASURES)
        # Shares of the length in shapes, so that long and short texts of one kind are alike.
        out *= 1000.0 / len(kinds)
    out = np.log1p(out)
    for slot, weight in _measures(words(text), text):
        out[TERMS - MEASURES + slot] += 4 * weight
    return out


def _matrix(texts) -> np.ndarray:
    return np.stack([terms(t) for t in texts]) if len(texts) else np.zeros((0, TERMS), np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, labels: DataFrame, keep) -> dict[str, np.ndarray]:
    """The space and the labelled vectors, from at most ``SAMPLE_ROWS`` labelled rows where ``keep`` holds."""
    sample = labelled_sample(labels, "quality", keep, SAMPLE_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = [terms(t).astype("<f2").tobytes() for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "label": frame["label"], "vector": vectors})

    # The sample is bounded, whatever the size of the corpus: 2 kB a row.
    found = rows.mapInPandas(run, "doc_id long, label int, vector binary").limit(SAMPLE_ROWS).toPandas()
    found = found.sort_values(["doc_id", "vector"])
    x = np.stack([np.frombuffer(v, "<f2") for v in found["vector"]]).astype(np.float32) if len(found) else np.zeros((0, TERMS), np.float32)
    weight = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x = _unit(x * weight)
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    basis = np.ascontiguousarray(vectors[:, ::-1][:, :RANK], dtype=np.float32)
    return {"weight": weight, "basis": basis, "vectors": _unit(x @ basis), "labels": found["label"].to_numpy(np.float32)}


def vote(x: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """The share of label 1 among the nearest labelled vectors, each weighing as its similarity; 0.5 without any."""
    known = model["vectors"]
    k = min(NEIGHBOURS, len(known))
    out = np.full(len(x), 0.5)
    if not k:
        return out
    space = _unit(_unit(x * model["weight"]) @ model["basis"])
    for at in range(0, len(x), BLOCK):
        cosines = space[at : at + BLOCK] @ known.T
        near = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(np.float64) ** 8
        out[at : at + BLOCK] = (weight * model["labels"][near]).sum(axis=1) / weight.sum(axis=1)
    return out


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have only the terms of length and are scored by their neighbours. Without labelled rows
    all scores are 0.5. Repeated rows are scored alike; a null doc_id is never learnt from and not held out. Other
    columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, part_of("doc_id", 3) != 1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames):
            scores = np.clip(vote(_matrix(frame["text"].tolist()), model.value), 0, 1)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "held_out": frame["held_out"],
                    "score": scores,
                    "predicted": (scores >= 0.5).astype("int32"),
                }
            )

    held_out = F.coalesce(part_of("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held_out).mapInPandas(run, SCHEMA)
