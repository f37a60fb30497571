"""What the operators share: settings, scratch tables, words and their hashes.

Words are runs of bytes other than space and \\t..\\r. UTF-8 never uses those bytes
inside a character, so bytes and code points agree on where words begin and end.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import configure, scratch_dir
from tripmart.sources.files import Store

ROOT = str(Path(__file__).resolve().parent.parent)
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024**2),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
# Shuffle files go when the query that made them ends; else they stay until the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SEGMENT_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = []
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches, as one text may be long."""
    configure(spark)
    # Workers on this machine find the package; on a cluster it is installed or shipped.
    paths = spark.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths.get("PYTHONPATH")]))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: lineage ends here, and its shuffle files go."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    written = _written.get()
    if written is not None:
        written.append(path)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def settle(spark: SparkSession, make: Callable[[], DataFrame | tuple[DataFrame, ...]], *labels: str, **options: str):
    """`stash` of the table, or one after the other of the tables, that `make` gives; scratch tables that it wrote on the way, which nothing else
    may read, are removed."""
    outer, mine, kept = _written.get(), [], []
    token = _written.set(mine)
    try:
        made = make()
        tables = made if isinstance(made, tuple) else (made,)
        on_the_way = len(mine)
        stored = [stash(df, label, **options) for df, label in zip(tables, labels, strict=True)]
        mine, kept = mine[:on_the_way], mine[on_the_way:]
    finally:
        _written.reset(token)
        store = Store(spark)
        for path in mine:
            store.delete(path)
    if outer is not None:
        outer.extend(kept)
    return tuple(stored) if isinstance(made, tuple) else stored[0]


def slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_few_files(df: DataFrame) -> DataFrame:
    """A small table of ids in an eighth of the shuffle's partitions: a file each costs more than its rows, also where adaptive merging is off."""
    return df.coalesce(max(8, slots(df.sparkSession) // 8))


def text_key(text: str = "text") -> F.Column:
    """Distinguishes rows with one doc_id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = []
        for base in (_BASE, inverse):
            table = np.full(max(n, SEGMENT_BYTES * 2), base, dtype=np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class Prefix:
    """Hashes of any substring of a byte array, from one pass."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * _MIX2)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in runs of about SEGMENT_BYTES: (bytes, row of each piece, where it begins).

    A longer text is cut where white space stands, so that no word is cut.
    """
    parts: list[bytes] = []
    rows: list[int] = []
    size = 0

    def run():
        begins = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
        return np.frombuffer(b"\n".join(parts), dtype=np.uint8), np.array(rows, dtype=np.int64), begins

    for row, text in enumerate(texts):
        at = 0
        while at == 0 or at < len(text):
            end = len(text)
            if end - at > SEGMENT_BYTES:
                gaps = np.flatnonzero(_SPACE[np.frombuffer(text, np.uint8, SEGMENT_BYTES // 2, at + SEGMENT_BYTES // 2)])
                end = at + SEGMENT_BYTES // 2 + int(gaps[-1]) if len(gaps) else end
            parts.append(text[at:end])
            rows.append(row)
            size += end - at + 1
            at = max(end, at + 1)
            if size >= SEGMENT_BYTES:
                yield run()
                parts, rows, size = [], [], 0
    if parts:
        yield run()


def words_of(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word of the texts, in order."""
    all_rows, hashes = [], []
    for data, rows, begins in segments(texts):
        if lower:
            data = LOWER[data]
        start, end = word_spans(data)
        all_rows.append(rows[np.searchsorted(begins, start, side="right") - 1])
        hashes.append(Prefix(data).of(start, end))
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(all_rows), np.concatenate(hashes)


def raw(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]
