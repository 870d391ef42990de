"""Near duplicates by ProbMinHash signatures, banding and exact verification.

Each different run of five words is an element of weight one, however often it occurs, as in the verification. An
element is a Poisson process of that rate; every arrival falls into a random register, which keeps the earliest
arrival. Elements that can arrive in no register before its present value stop. Registers of two texts agree with the
probability Jaccard similarity of their elements, which for equal weights is the Jaccard similarity. Texts that agree in all registers of a band are candidates, and the
Jaccard similarity of their element sets is computed from their whole texts.

No group is expanded into pairs:

1. Texts with the same elements are one class from the start; only the smallest id goes on.
2. The smallest id of a band bucket is a partner of the other texts in it. Each text is compared with one partner,
   verified links are joined to classes, and then with those partners that are still in another class.
3. In a bucket that still holds several classes, the texts outside its commonest class are compared with all texts of
   the bucket, block by block. A task holds the signatures and elements of two blocks, verifies each pair that is
   likely by its signatures, between texts still in different classes and first met in this band, and gives out only
   links that join two classes: fewer than the two blocks have texts. Every likely pair is either verified
   or lies within a class already, so one pass is enough.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import batches, discard, gram_hashes, mix, staged, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4  # a pair at the threshold is missed with probability (1 - 0.8 ** 4) ** 24, below 1e-5
REGISTERS = BANDS * ROWS
LIKELY = 0.55  # share of agreeing registers: six standard deviations below the threshold
BLOCK = 1024  # texts of a block, about
BLOCK_ELEMENTS = 1 << 20  # elements of a block, about; a longer text is a block alone, or nearly
FEW = 1 << 10  # pairs whose registers are compared at once
SLICE = 1 << 16  # pairs whose bands are compared at a time
ARRIVALS = 1000  # drawn at a time: about as many as fill all registers
LAST = 2**63 - 1  # stands for a null id
VOCABULARY = 1 << 17  # words whose hashes a process keeps at hand
TEXTS = 1 << 20  # characters of the texts whose words a process holds at once, or one text

_known: dict[bytes, int] = {}
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Marks are the lower halves of the bands.
_SIGNATURES = "key long, elements long, low long, high long, bands array<long>, marks binary, registers binary"


def elements(text: str | None) -> np.ndarray:
    """Hashes of the different runs of five lower-case words; a shorter text is one run."""
    return next(all_elements([text]))


def all_elements(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The elements of each text; equal words of all texts are hashed once."""
    tokens = [words(text.lower()) if text else [] for text in texts]
    new = list(set().union(*tokens).difference(_known))
    if len(_known) + len(new) > VOCABULARY:
        _known.clear()
        new = list(set().union(*tokens))
    _known.update(zip(new, word_hashes(new).tolist()))
    every = itertools.chain.from_iterable(tokens)
    hashes = np.fromiter(map(_known.__getitem__, every), np.uint64, sum(map(len, tokens)))
    at = 0
    for found in tokens:
        own = hashes[at : at + len(found)]
        at += len(found)
        yield np.unique(gram_hashes(own, min(SHINGLE, len(own)))) if len(own) else own


def signature(items: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The element that arrives first in each register."""
    times = np.full(REGISTERS, np.inf)
    first = np.zeros(REGISTERS, np.uint64)
    now, arrival = np.zeros(len(items)), 0
    while len(items):
        rounds = max(1, -(-ARRIVALS // len(items)))
        steps = np.arange(arrival + 1, arrival + rounds + 1, dtype=np.uint64)[:, None] * _STEP
        draws = mix(items[None, :] + steps)
        gaps = -np.log(((draws >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weights
        at = now + np.cumsum(gaps, axis=0)
        register = (mix(draws + _STEP) % np.uint64(REGISTERS)).astype(np.int64).ravel()
        before, moments = times.copy(), at.ravel()
        np.minimum.at(times, register, moments)
        better = np.flatnonzero((moments == times[register]) & (moments < before[register]))
        first[register[better]] = np.broadcast_to(items, at.shape).ravel()[better]
        on = at[-1] < times.max()
        items, weights, now, arrival = items[on], weights[on], at[-1][on], arrival + rounds
    return first


def _content(items: np.ndarray) -> tuple[int, int]:
    """Two numbers that name a set of elements."""
    return tuple(int(np.sum(mix(items + k * _STEP)).astype(np.int64)) for k in (np.uint64(1), np.uint64(2)))


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shift = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for frame in batches(frames, TEXTS):
        rows = []
        for key, items in zip(frame["key"], all_elements(frame["text"].tolist())):
            if not len(items):
                rows.append((key, 0, 0, 0, [], b"", b""))
                continue
            first = signature(items, np.ones(len(items)))
            bands = gram_hashes(first, ROWS)[::ROWS]
            bands = mix(bands + shift).astype(np.int64)
            low, high = _content(items)
            registers = (first & np.uint64(0xFFFF)).astype("<u2").tobytes()
            marks = bands.astype("<u4").tobytes()
            rows.append((key, len(items), low, high, bands, marks, registers))
        yield pd.DataFrame(rows, columns=["key", "elements", "low", "high", "bands", "marks", "registers"])


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The elements of each text that has the wanted content: a repeated id may have others."""
    for frame in batches(frames, TEXTS):
        rows = []
        wanted = zip(frame["key"], frame["low"], frame["high"])
        for (key, low, high), items in zip(wanted, all_elements(frame["text"].tolist())):
            if len(items) and _content(items) == (low, high):
                rows.append((key, items.astype("<u8").tobytes()))
        yield pd.DataFrame(rows, columns=["key", "hashes"])


def _likely(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose signatures agree enough, with the number of registers that agree."""
    for frame in frames:
        if len(frame):
            a, b = (np.frombuffer(b"".join(frame[c]), "<u2").reshape(len(frame), REGISTERS) for c in ("ra", "rb"))
            same = (a == b).sum(axis=1)
            out = frame[["a", "b"]].assign(same=same.astype("int32"))
            yield out[same >= LIKELY * REGISTERS]


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose element sets reach the threshold."""
    for frame in frames:
        kept = []
        for left, right in zip(frame["sa"], frame["sb"]):
            x, y = np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            kept.append(both >= SIMILARITY * (len(x) + len(y) - both))
        yield frame.loc[np.array(kept, bool), ["a", "b"]]


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many registers agree, for each row of ``x`` and each of ``y``."""
    if len(x) * len(y) <= FEW:
        return (x[:, None] == y[None]).sum(axis=2)
    same = np.zeros((len(x), len(y)), np.uint8)
    for left, right in zip(x.T.copy(), y.T.copy()):
        same += left[:, None] == right
    return same


def _met_here(marks: np.ndarray, at: np.ndarray, to: np.ndarray, band: int) -> np.ndarray:
    """Whether ``band`` is the first in which the texts ``at`` and ``to`` agree."""
    here = np.zeros(len(at), bool)
    for k in range(0, len(at), SLICE):
        some = slice(k, k + SLICE)
        here[some] = (marks[at[some]] == marks[to[some]]).argmax(axis=1) == band
    return here


def joining_links(
    band: int, labels: np.ndarray, marks: np.ndarray, registers: np.ndarray, sets: list[np.ndarray], left: np.ndarray
) -> list[tuple[int, int]]:
    """Verified links (positions) between texts of different ``labels``, each joining two classes.

    Texts marked ``left`` are compared with the others; if all are marked, with each other. A pair is compared if
    ``band`` is the first in which it agrees, its signatures make it likely, and its ends are still in different classes.
    """
    rows = np.flatnonzero(left)
    columns = rows if len(rows) == len(left) else np.flatnonzero(~left)
    sizes = np.array([len(x) for x in sets])
    same = _agreeing(registers[rows], registers[columns])
    small, large = (f(sizes[rows, None], sizes[None, columns]) for f in (np.minimum, np.maximum))
    may = (same >= LIKELY * REGISTERS) & (labels[rows, None] != labels[None, columns]) & (small >= SIMILARITY * large)
    if columns is rows:
        may = np.triu(may, 1)
    at, to = np.nonzero(may)
    at, to = rows[at], columns[to]
    here = _met_here(marks, at, to, band)
    at, to = at[here], to[here]
    if not len(at):
        return []
    # The elements of the texts concerned are numbered, so that a text is a set of positions in one array.
    concerned = np.union1d(at, to)
    ends = np.cumsum(sizes[concerned])
    _, numbers = np.unique(np.concatenate([sets[k] for k in concerned]), return_inverse=True)
    numbered = dict(zip(concerned.tolist(), np.split(numbers, ends[:-1])))
    held = np.zeros(numbers.max() + 1, bool)
    links, labels = [], labels.copy()
    for row, partners in zip(*_runs(at, to)):
        partners = partners[labels[partners] != labels[row]]
        if not len(partners):
            continue
        held[numbered[row]] = True
        starts = np.cumsum(sizes[partners]) - sizes[partners]
        both = np.add.reduceat(held[np.concatenate([numbered[k] for k in partners.tolist()])], starts, dtype=np.int64)
        held[numbered[row]] = False
        alike = partners[both >= SIMILARITY * (sizes[row] + sizes[partners] - both)]
        for label in np.unique(labels[alike]):
            links.append((row, int(alike[labels[alike] == label][0])))
        labels[np.isin(labels, labels[alike])] = labels[row]
    return links


def _runs(at: np.ndarray, to: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The different values of the sorted ``at`` and for each the values of ``to`` beside it."""
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[starts].tolist(), np.split(to, starts[1:])


def _whole_jobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by job, cut so that no job is in two tables, and where its jobs start and end."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        rows = rest if batch is None else pa.Table.from_batches([batch])
        if rest is not None and batch is not None:
            rows = pa.concat_tables([rest, rows])
        if rows is None or not rows.num_rows:
            continue
        jobs = np.stack([rows.column(c).to_numpy() for c in ("bucket", "i", "j")])
        starts = np.flatnonzero(np.r_[True, (jobs[:, 1:] != jobs[:, :-1]).any(axis=0)])
        end = rows.num_rows if batch is None else int(starts[-1])
        if end:
            yield rows.slice(0, end), np.append(starts[starts < end], end)
        rest = rows.slice(end)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join classes, found in each job (bucket, i, j) of two blocks of texts."""
    for rows, edges in _whole_jobs(batches):
        keys, classes, numbers, left = (rows.column(c).to_numpy() for c in ("key", "class", "band", "left"))
        hashes = rows.column("hashes").to_pylist()
        marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), "<u4").reshape(-1, BANDS)
        registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        found = []
        for start, end in itertools.pairwise(edges.tolist()):
            own = start + np.argsort(keys[start:end], kind="stable")
            sets = [np.frombuffer(hashes[k], "<u8") for k in own.tolist()]
            links = joining_links(int(numbers[start]), classes[own], marks[own], registers[own], sets, left[own])
            found += [(keys[own[x]], keys[own[y]]) for x, y in links]
        ends = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(key, class) of all ends of ``links`` (a, b): the smallest key that can be reached.

    Alternates two steps until nothing changes: larger neighbours are linked to the smallest neighbour, then smaller
    ones. A step is an aggregation and a join on links, so no component is gathered anywhere.
    """
    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("v"), "least")
        large = large.filter(F.col("v") != F.col("least")).distinct()
        small = large.groupBy("v").agg(F.min("least").alias("root"))
        new = large.join(small, "v").select(
            F.when(F.col("least") == F.col("root"), F.col("v")).otherwise(F.col("least")).alias("b"), F.col("root").alias("a")
        )
        new = staged(new.filter("a != b").select("a", "b").distinct(), "links")
        changed = new.exceptAll(edges).limit(1).count() + edges.exceptAll(new).limit(1).count()
        discard(edges)
        edges = new
        if not changed:
            break
    roots = edges.select(F.col("b").alias("key"), F.col("a").alias("class"))
    return roots.unionByName(roots.select(F.col("class").alias("key"), "class").distinct())


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (its smallest doc_id), links (the texts it was compared with and
    found alike to; texts already joined by others are not compared again).

    Null and empty texts are alone in a class of their own id. Texts of fewer than five words are alike when they
    have the same words in order. Null doc_ids count as one id, larger than all others and given as null. Repeated
    rows give repeated rows. Other columns are not read.
    """
    base = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("key"), "text")
    signed = staged(base.mapInPandas(_sign, _SIGNATURES), "signatures")
    by_content = signed.filter("elements > 0").groupBy("elements", "low", "high").agg(F.min("key").alias("first"))
    own = signed.select("key", "elements", "low", "high").join(by_content, ["elements", "low", "high"], "left")
    own = staged(own.select("key", F.coalesce("first", "key").alias("first")), "own")
    texts_of = by_content.select(F.col("first").alias("key")).distinct()
    unique = signed.filter("elements > 0").join(texts_of, "key", "left_semi")
    unique = unique.select("key", "elements", "low", "high", "bands", "marks", "registers")
    unique = staged(unique.dropDuplicates(["key"]), "unique")

    rows = unique.select("key", F.posexplode("bands").alias("band", "bucket"))
    full = rows.groupBy("bucket").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = staged(rows.join(full, "bucket"), "members")
    registers = unique.select("key", "elements", "registers")
    wanted = unique.join(members.select("key").distinct(), "key", "left_semi").select("key", "low", "high")
    texts = base.join(wanted, "key").dropDuplicates(["key", "text"])
    sets = staged(texts.mapInPandas(_sets, "key long, hashes binary"), "sets")
    discard(signed)

    def verified(pairs: DataFrame) -> DataFrame:
        left, right = (sets.select(F.col("key").alias(c), F.col("hashes").alias(f"s{c}")) for c in "ab")
        return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInPandas(_verify, "a long, b long")

    # A set of fewer than 0.8 times the elements of another can't be similar enough.
    star = members.filter("key > least").select(F.col("least").alias("a"), F.col("key").alias("b")).distinct()
    left, right = (registers.select(F.col("key").alias(c), F.col("elements").alias(f"e{c}"), F.col("registers").alias(f"r{c}")) for c in "ab")
    fitting = F.least("ea", "eb") >= SIMILARITY * F.greatest("ea", "eb")
    pairs = star.join(right, "b").join(left, "a").filter(fitting).select("a", "b", "ra", "rb")
    checked = staged(pairs.mapInPandas(_likely, "a long, b long, same int"), "checked")
    # First one partner for each text, the smallest of those that seem similar enough; then the others that are
    # still in another class. A group of copies is one class after the first step.
    promising = F.struct(F.col("same") >= SIMILARITY * REGISTERS, -F.col("a"))
    first = staged(checked.groupBy("b").agg(F.max_by("a", promising).alias("a")).select("a", "b"), "first")
    links = staged(verified(first), "found")
    found = staged(components(links), "classes")
    apart = _apart(checked.select("a", "b"), found).join(first, ["a", "b"], "left_anti")
    new = staged(verified(apart), "found")
    discard(checked, first)
    links = links.unionByName(new)
    found = staged(_merged(found, new), "classes")
    new = staged(_between_classes(members, unique, sets, found), "found")
    discard(members, unique, sets)
    links = links.unionByName(new)
    found = staged(_merged(found, new), "classes")

    ends = links.select("a", "b").distinct()
    degree = ends.select(F.explode(F.array("a", "b")).alias("first")).groupBy("first").agg(F.count(F.lit(1)).alias("links"))
    out = own.join(found.withColumnRenamed("key", "first"), "first", "left").join(degree, "first", "left")
    class_id = F.coalesce("class", "first")
    return out.select(
        F.when(F.col("key") != LAST, F.col("key")).alias("doc_id"),
        F.when(class_id != LAST, class_id).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different classes."""
    of = lambda c: found.select(F.col("key").alias(c), F.col("class").alias(f"class_{c}"))
    both = pairs.join(of("b"), "b", "left").join(of("a"), "a", "left")
    return both.filter(F.coalesce("class_a", "a") != F.coalesce("class_b", "b")).select("a", "b")


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (key, class) after ``links`` (a, b) have joined some."""
    of = lambda c: found.select(F.col("key").alias(c), F.col("class").alias(f"class_{c}"))
    both = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = both.select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
    joined = components(ends.filter("a != b")).select(F.col("key").alias("class"), F.col("class").alias("root"))
    moved = found.join(joined, "class", "left").select("key", F.coalesce("root", "class").alias("class"))
    return moved.unionByName(joined.select(F.col("class").alias("key"), F.col("root").alias("class"))).distinct()


def _blocks(texts: str, elements: str) -> Column:
    """How many blocks so many texts with so many elements in all make."""
    return F.greatest(F.ceil(F.col(texts) / BLOCK), F.ceil(F.col(elements) / BLOCK_ELEMENTS)).cast("int")


def _between_classes(members: DataFrame, unique: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Verified links (a, b) between the classes of one bucket, enough to join all classes that have one.

    The texts of a bucket outside its commonest class make blocks 0 to m - 1, those of that class blocks from m on.
    Job (bucket, i, j) compares block i, one of the first m, with block j, not less than i.
    """
    rows = members.select("bucket", "band", "key").join(found, "key", "left").withColumn("class", F.coalesce("class", "key"))
    rows = rows.join(unique.select("key", "elements"), "key")
    of_class = rows.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("texts"), F.sum("elements").alias("elements"))
    most = F.max(F.struct("texts", (-F.col("class")).alias("minus"), "elements")).alias("most")
    mixed = of_class.groupBy("bucket").agg(F.sum("texts").alias("texts"), F.sum("elements").alias("elements"), most)
    mixed = mixed.filter("texts > most.texts").select(
        "bucket",
        (-F.col("most.minus")).alias("common"),
        F.col("most.texts").alias("inner_texts"),
        F.col("most.elements").alias("inner_elements"),
        (F.col("texts") - F.col("most.texts")).alias("outer_texts"),
        (F.col("elements") - F.col("most.elements")).alias("outer_elements"),
    )
    mixed = mixed.select(
        "bucket",
        "common",
        _blocks("outer_texts", "outer_elements").alias("outer"),
        _blocks("inner_texts", "inner_elements").alias("inner"),
    )
    rows = rows.join(mixed, "bucket").withColumn("outside", F.col("class") != F.col("common"))
    at = F.pmod(F.xxhash64("key"), F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).cast("int")
    rows = rows.withColumn("at", F.when(F.col("outside"), at).otherwise(F.col("outer") + at))
    job = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), left.alias("left"))
    as_left = F.transform(F.sequence("at", F.col("outer") + F.col("inner") - 1), lambda j: job(F.col("at"), j, F.lit(True)))
    before = F.least("at", "outer")
    as_right = F.when(
        before > 0, F.transform(F.sequence(F.lit(0), before - 1), lambda i: job(i, F.col("at"), F.lit(False)))
    )
    none = F.array().cast("array<struct<i:int,j:int,left:boolean>>")
    jobs = F.concat(F.when(F.col("outside"), as_left).otherwise(none), F.coalesce(as_right, none))
    rows = rows.select("bucket", "band", "key", "class", F.inline(jobs))
    payload = unique.select("key", "marks", "registers").join(sets, "key")
    # The blocks are small in bytes and heavy in work: as many tasks as a shuffle has, whatever their size.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.join(payload, "key").repartition(tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return spread.mapInArrow(_compared, "a long, b long")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of their class, all columns; texts without words all stay."""
    kept = classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__keep"]), "left_semi")
