"""Packing documents into sequences of bounded length.

The lengths of all pieces make a histogram of at most `capacity` entries. Patterns of
one to three lengths that fill a sequence exactly get repeat counts by non-negative
least squares; the counts are rounded, or cut to whole numbers, and what is left is packed best fit,
longest first, with repeat counts too. Of these plans, and of one without patterns, the one with the fewest sequences
is taken, so that packing never needs more than best fit alone. The work on the driver depends on
`capacity`, not on the number of documents. Pieces are then numbered within their length and the
number tells sequence and offset.

Defined results: a null text is the end id alone; repeated rows are packed each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import slots, stash
from llm.tokens import encoder

ITERATIONS = 200
Groups = list[tuple[tuple[int, ...], int]]  # lengths in a sequence, number of such sequences


def exact_patterns(counts: np.ndarray) -> np.ndarray:
    """Rows of two or three present lengths (0: none) that sum to the capacity, no larger first."""
    capacity = len(counts) - 1
    have = np.flatnonzero(counts)
    have = have[(have > 0) & (have < capacity)]
    present = counts > 0
    rows = []
    pairs = have[(have <= capacity - have) & present[capacity - have]]
    rows.append(np.stack([np.zeros_like(pairs), pairs, capacity - pairs], axis=1))
    for a in have[have <= capacity // 3]:
        b = have[(have >= a) & (have <= (capacity - a) // 2)]
        b = b[present[capacity - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, capacity - a - b], axis=1))
    return np.concatenate(rows).astype(np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 with least squares of A x - counts, by multiplicative steps."""
    n = len(counts)
    used = patterns > 0

    def spread(x):  # A x
        total = np.zeros(n)
        for k in range(3):
            total += np.bincount(patterns[:, k], x * used[:, k], n)
        return total

    def gather(y):  # A' y
        return sum(y[patterns[:, k]] * used[:, k] for k in range(3))

    target = gather(counts.astype(float))
    x = target / (1e-9 + gather(spread(np.ones(len(patterns)))))
    for _ in range(ITERATIONS):
        x *= target / (1e-9 + gather(spread(x)))
    return x


def best_fit(left: np.ndarray) -> Groups:
    """Best fit decreasing over a histogram; equal sequences are kept as one entry."""
    capacity = len(left) - 1
    by_space: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    open_spaces = np.zeros(capacity + 1, dtype=bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(open_spaces[length:])
            if not len(fitting):
                each = capacity // length
                full, rest = divmod(n, each)
                for times, many in ((each, full), (rest, 1)):
                    if times and many:
                        by_space[capacity - times * length].append(((length,) * times, many))
                        open_spaces[capacity - times * length] = True
                break
            space = int(fitting[0]) + length
            content, many = by_space[space].pop()
            take = min(n, many)
            if take < many:
                by_space[space].append((content, many - take))
            open_spaces[space] = bool(by_space[space])
            by_space[space - length].append(((*content, length), take))
            open_spaces[space - length] = True
            n -= take
    return [group for groups in by_space.values() for group in groups]


def take_patterns(patterns: np.ndarray, repeats: np.ndarray, left: np.ndarray) -> Groups:
    """The patterns as often as asked for and as pieces last; `left` loses what they take."""
    groups: Groups = []
    chosen = np.flatnonzero(repeats > 0)
    for lengths, wanted in zip(patterns[chosen].tolist(), repeats[chosen].tolist(), strict=True):
        lengths = [v for v in lengths if v]
        wanted = min(wanted, *(int(left[v]) // lengths.count(v) for v in set(lengths)))
        if wanted:
            groups.append((tuple(lengths), wanted))
            for v in lengths:
                left[v] -= wanted
    return groups


def plan(counts: np.ndarray) -> Groups:
    """Sequences that hold exactly the pieces of the histogram; counts[k] pieces have length k."""
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    full: Groups = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    plans = [best_fit(left)]
    patterns = exact_patterns(left)
    if len(patterns):
        x = fit_repeats(patterns, left)
        order = np.argsort(-x, kind="stable")
        # Rounding carries the fraction on to the next pattern.
        rounded = np.diff(np.floor(np.append(0, np.cumsum(x[order])) + 0.5)).astype(np.int64)
        for repeats in (rounded, np.floor(x[order]).astype(np.int64)):
            rest = left.copy()
            taken = take_patterns(patterns[order], repeats, rest)
            plans.append(taken + best_fit(rest))
    # Among equals the plan by rounded patterns.
    return full + min([*plans[1:], plans[0]], key=lambda groups: sum(n for _, n in groups))


def runs(groups: Groups) -> np.ndarray:
    """Rows (length, first number, sequence of that number, offset), sorted: where pieces go."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, many in groups:
        offset = 0
        for v in lengths:
            rows.append((v, taken[v], sequence, offset))
            taken[v] += many
            offset += v
        sequence += many
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def cut_documents(
    df: DataFrame, vocabulary: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as token pieces of at most `capacity`.

    A document that is too long is cut so that only its first piece is shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(vocabulary)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for name, ids in zip(batch.column("doc_id").to_pylist(), library.encode_many(texts), strict=True):
                ids = np.append(ids, end)
                begins = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
                for k, (s, e) in enumerate(zip(begins, [*begins[1:], len(ids)], strict=True)):
                    for column, value in zip(out, (name, k, s, e - s, zlib.crc32(ids[s:e].tobytes())), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces.

    Pieces of one length may be a third of all, so they are numbered in buckets; where a
    bucket's numbers begin follows from bucket counts.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    where = spark.sparkContext.broadcast(runs(plan(counts)))

    bucket = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(slots(spark))).alias("bucket")
    dealt = pieces.select("*", bucket)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    firsts = firsts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(firsts, ["length", "bucket"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = where.value
        keys = (table[:, 0] << 48) | table[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(keys, (batch.column("length").to_numpy() << 48) | rank, side="right") - 1
            found = [pa.array(table[k, 2] + rank - table[k, 1]), pa.array(table[k, 3])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *found], [*columns, "sequence_id", "offset"]
            )

    numbered = numbered.select(*columns, (F.col("first") + F.col("rank")).cast("long").alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(locate, schema)


def pack_documents(
    df: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    capacity: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    return place(stash(cut_documents(df, vocabulary, end_id, capacity, doc_id, text), "pieces"), capacity)
