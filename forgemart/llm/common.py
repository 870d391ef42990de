"""What the operators share: staged tables, word arrays, hashes and bounded samples of labelled rows.

Words are the maximal runs of characters other than the six ASCII white-space characters, taken from the UTF-8
bytes, so that Python and Spark cut every text alike.
"""

from __future__ import annotations

import gc
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemart.session import scratch_path

WHITE_SPACE = " \t\n\x0b\x0c\r"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_staged: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}
_read: dict[int, tuple] = {}


def staged(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts lineage, survives lost executors. With
    ``path`` the table is written there and kept."""
    spark = df.sparkSession
    target = path or scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(target)
    out = spark.read.schema(df.schema).parquet(target)
    if path is None:
        _staged.setdefault(spark.sparkContext.applicationId, []).append(target)
        _read[id(out)] = weakref.ref(out, lambda _, key=id(out): _read.pop(key, None)), target
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables whose readers are done; tables kept under a path of the caller's stay."""
    for df in tables:
        _, path = _read.pop(id(df), (None, None))
        if path:
            _staged[df.sparkSession.sparkContext.applicationId].remove(path)
            _delete(df.sparkSession, path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` stored as a table bucketed by ``column``, in as many buckets as a shuffle has partitions: joins on the
    column move only the other side."""
    spark = df.sparkSession
    full = f"llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(buckets, column).saveAsTable(full)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(full)
    return spark.table(full)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def clear_staged(spark: SparkSession) -> int:
    """Delete the staged tables of this application once the results that read them are stored; their number."""
    app = spark.sparkContext.applicationId
    tables = _tables.pop(app, [])
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _staged.pop(app, [])
    for path in paths:
        _delete(spark, path)
    return len(paths) + len(tables)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_of(column: str, modulus: int):
    """``crc32(column as text) mod modulus``; null for a null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(labels: DataFrame, target: str, keep, bound: int) -> DataFrame:
    """At most ``bound`` rows (doc_id, label) of 0/1 labels, chosen by a hash of the id; an id counts once, with
    its smallest label. Small enough to broadcast: ``bound`` times two numbers."""
    rows = labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & keep)
    rows = rows.groupBy("doc_id").agg(F.min(target).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """One 64-bit number per word, the same in every process."""
    if not tokens:
        return np.zeros(0, np.uint64)
    codes, distinct = pd.factorize(np.array(tokens, dtype=object))
    named = np.array([t.decode("utf-8", "surrogatepass") for t in distinct], dtype=object)
    return pd.util.hash_array(named, categorize=False)[codes]


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each run of ``n`` consecutive items: empty when there are fewer."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:size].copy()
    for k in range(1, n):
        total *= _MULTIPLIER
        total += hashes[k : k + size]
    return mix(total)


def batches(frames: Iterator[pd.DataFrame], size: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Cut batches so that one holds about ``size`` characters of text, one row at least."""
    for frame in frames:
        if not len(frame):
            continue
        lengths = frame["text"].map(len, na_action="ignore").fillna(0).to_numpy(dtype="int64")
        group = np.cumsum(lengths) // size
        if group[-1] == 0:
            yield frame
        else:
            for _, part in frame.groupby(group, sort=True):
                yield part
