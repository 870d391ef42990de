"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of one size. Time has one slot per block. With share ``w`` of the slots, block ``i``
(from 0) of a source is released at ``floor(i / w)`` and due at ``ceil((i + 1) / w)``; earliest deadline first then
keeps every source within one block of its target at every slot. Shares are the weights themselves, as whole numbers
of one unit, and the driver places every block: it holds a number per block and a row per source. When a source runs
out, the shares are scaled over the others and a new phase starts. No row is dropped or repeated.

Blocks come from running sums of sizes. Rows of a source are ordered by a hash, dealt into buckets of that hash, and
summed in two steps, so a source with a third of the corpus is spread over many tasks.
"""

from __future__ import annotations

import heapq
import itertools
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 65536
PERIOD = 1024  # blocks of a source in one row of the plan
MISSING = "\u0000missing"
ORDER = ("mixed_slot", "mixed_place")  # columns of the mixed order

_PLAN = pa.schema([("__source", pa.string()), ("part", pa.int64()), ("slots", pa.list_(pa.int64()))])


def exact_shares(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the ratio of the weights."""
    ratios = {s: float(w).as_integer_ratio() for s, w in weights.items()}
    unit = max(d for _, d in ratios.values())  # powers of two
    return {s: n * (unit // d) for s, (n, d) in ratios.items()}


def whole_shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Shares out of ``period`` by largest remainders, one at least."""
    total = sum(weights.values())
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    shares = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: period - sum(shares.values())]:
        shares[s] += 1
    return shares


def one_period(
    shares: dict[str, int], period: int | None = PERIOD, blocks: dict[str, int] | None = None
) -> dict[str, list[int]]:
    """The slots of each source's blocks by earliest deadline among the released: those of ``period`` slots, or with
    ``blocks`` all until the first source has run out."""
    total = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {s: [] for s in shares}
    for slot in itertools.count() if blocks else range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // shares[s]), s, i))
        _, s, i = heapq.heappop(ready)
        slots[s].append(slot)
        if blocks and i + 1 == blocks[s]:
            break
        heapq.heappush(waiting, ((i + 1) * total // shares[s], s, i + 1))
    return slots


def phases(blocks: dict[str, int], weights: dict[str, float]) -> dict[str, list[tuple[int, int, int, list[int]]]]:
    """For each source its (first block, block after the last, first slot, slots from there) by phase."""
    left = {s: n for s, n in blocks.items() if n > 0}
    used, begin = dict.fromkeys(left, 0), 0
    out: dict[str, list[tuple[int, int, int, list[int]]]] = {s: [] for s in left}
    while left:
        slots = one_period(exact_shares({s: weights[s] for s in left}), None, left)
        for s in list(left):
            took = len(slots[s])
            if took:
                out[s].append((used[s], used[s] + took, begin, slots[s]))
            used[s] += took
            left[s] -= took
            if not left[s]:
                del left[s]
        begin += sum(map(len, slots.values()))
    return out


def _as_table(spark: SparkSession, plan: dict[str, list[tuple[int, int, int, list[int]]]]) -> DataFrame:
    """The slots of each source's blocks, ``PERIOD`` to a row. Sent as Arrow: rows of Python would be unpickled on the
    executors, by a second set of Python workers that stays beside those of the other operators."""
    rows = []
    for s, p in plan.items():
        at = [begin + x for _, _, begin, slots in p for x in slots]
        rows += [(s, k // PERIOD, at[k : k + PERIOD]) for k in range(0, len(at), PERIOD)]
    columns = zip(*rows) if rows else [()] * len(_PLAN)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _PLAN.types)], schema=_PLAN))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, source, source_block, slot, place.

    ``slot`` is when the document's block is served and ``place`` its characters from the start of the block, so
    (slot, place, doc_id) is the mixed order. A document belongs to the block in which it starts; one longer than a
    block leaves slots empty behind it. Without ``weights`` a source weighs as the square root of its characters;
    a source that ``weights`` leaves out gets the least given weight. Null and empty texts count one character. A
    null source is a source of its own.
    Repeated rows follow each other. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce("source", F.lit(MISSING)).alias("__source"),
        F.greatest(F.char_length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("long").alias("size"),
    )
    # One row per source.
    totals = rows.groupBy("__source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {r["__source"]: r["size"] for r in totals}
    number = sum(r["rows"] for r in totals)
    blocks = {s: -(-n // block_chars) for s, n in sizes.items()}
    if weights is None:
        target = {s: math.sqrt(n) for s, n in sizes.items()}
    else:
        if any(w <= 0 for w in weights.values()):
            raise ValueError("weights must be positive")
        target = {s: float(weights.get(s, min(weights.values()))) for s in sizes}
    table = _as_table(docs.sparkSession, phases(blocks, target))

    # About as many buckets as rows in a bucket: both grow with the root of the corpus.
    bits = max(1, math.ceil(math.log2(math.sqrt(number + 1)) + 1))
    mark = F.xxhash64("doc_id")
    rows = rows.withColumn("mark", mark).withColumn("bucket", F.shiftright("mark", 64 - bits))
    sums = rows.groupBy("__source", "bucket").agg(F.sum("size").alias("in_bucket"))
    earlier = Window.partitionBy("__source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__source", "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("__source", "bucket").orderBy("mark", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, ["__source", "bucket"])
    start = F.col("earlier") + F.col("before")
    block = F.floor(start / block_chars).cast("long")
    rows = rows.withColumn("source_block", block).withColumn("place", start - block * block_chars)
    rows = rows.withColumn("part", F.floor(block / PERIOD).cast("long")).join(F.broadcast(table), ["__source", "part"])
    slot = F.get("slots", (F.col("source_block") % PERIOD).cast("int"))
    return rows.select("doc_id", "source", "source_block", slot.alias("slot"), "place")


def placed(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, and the columns of ``ORDER``: sorted by these and doc_id they are mixed. Columns of
    ``docs`` that have these names already are replaced."""
    docs = docs.drop(*ORDER)
    at = "at" + "_" * max(map(len, docs.columns))  # longer than any other name
    order = schedule(docs, weights, block_chars).select(F.col("doc_id").alias(f"{at}id"), "slot", "place").distinct()
    first = order.groupBy(f"{at}id").agg(F.min(F.struct("slot", "place")).alias(at))
    joined = docs.join(first, docs["doc_id"].eqNullSafe(first[f"{at}id"]))
    return joined.select(*[docs[c] for c in docs.columns], *[first[at][c[6:]].alias(c) for c in ORDER])


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, sorted into the mixed order. Files read again may come in another order: a later
    step that needs the order takes ``placed``."""
    return placed(docs, weights, block_chars).orderBy(*ORDER, "doc_id").drop(*ORDER)
