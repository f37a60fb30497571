"""Toxicity score of texts: a linear model of character n-grams scaled by naive Bayes ratios.

Features are the n-grams of 3 to 5 code points of each lower-cased word with a space on
either side, hashed to 2^18 buckets, present or not. A bucket's scale is the log ratio of
its smoothed shares in toxic and other training texts, brought nearer to 0 by its own standard error, so that
n-grams seen too rarely to tell have none. All buckets enter a regularised logistic regression, fitted by
limited-memory quasi-Newton steps whose gradients are summed in tasks.

Training uses at most TRAIN_ROWS labelled rows, those with the smallest hash of their
id; so the join with the texts is a broadcast of bounded size. Every row is scored.

Defined results: a null or empty text has no feature and gets the model's base score;
rows with a null id are scored but never held out nor trained on; a document labelled
twice counts as toxic if most of its labels say so; without labels, or with one class
only, every score is the share of toxic labels (0 without labels). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Prefix, segments, stash

ORDERS = (3, 4, 5)
BITS = 18
TRAIN_ROWS = 20_000
TRAIN_TASKS = 16
PENALTY, STEPS, MEMORY = 0.5, 40, 8

_TEXT = np.arange(256, dtype=np.uint8)
_TEXT[[b for b in range(128) if not chr(b).isalpha()]] = 32


def lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode() for t in texts]


def buckets(texts: list[bytes], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs; `keep` marks the buckets of interest."""
    found = [np.zeros(0, dtype=np.int64)]
    for data, rows, begins in segments(texts):
        # Which piece a byte belongs to; an n-gram has letters of one piece only, and its second character tells which.
        piece = np.repeat(np.arange(len(begins), dtype=np.int32), np.diff(np.append(begins, len(data) + 1)))
        data = np.concatenate([[np.uint8(32)], _TEXT[data], [np.uint8(32)]])
        prefix = Prefix(data)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        spaces = np.concatenate([[0], np.cumsum(data[at] == 32, dtype=np.int32)])
        at = np.append(at, len(data))
        parts = []
        for n in ORDERS:
            last = len(at) - n
            first = np.flatnonzero(spaces[n - 1 : last + n - 1] == spaces[1 : last + 1])  # no space inside
            start = at[first + 1] - 1  # of the second character, in the texts
            bucket = (prefix.of(at[first], at[first + n]) >> np.uint64(64 - BITS)).astype(np.int32)
            if keep is not None:
                hit = keep[bucket]
                start, bucket = start[hit], bucket[hit]
            parts.append((piece[start].astype(np.int32 if len(begins) < 1 << 13 else np.int64) << BITS) | bucket)
        pairs = np.sort(np.concatenate(parts))
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]].astype(np.int64)
        found.append((rows[pairs >> BITS] << BITS) | (pairs & ((1 << BITS) - 1)))
    pairs = np.concatenate(found)
    if np.any(pairs[1:] <= pairs[:-1]):  # a text in several pieces
        pairs = np.unique(pairs)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def held_out(doc_id: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, limit: int) -> DataFrame:
    """(text, toxic) of a bounded number of labelled rows that aren't held out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    one = usable.groupBy("doc_id").agg((F.avg("toxic") > 0.5).cast("int").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def ratios(train: DataFrame) -> tuple[np.ndarray, int, int]:
    """Log-count ratio of every bucket less its standard error, 0 for those never seen, and the number of toxic and other rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            rows += np.bincount(toxic, minlength=2)
            row, bucket = buckets(lowered(batch.column("text").to_pylist()))
            for label in (0, 1):
                sums[label] += np.bincount(bucket[toxic[row] == label], minlength=1 << BITS)
        seen = np.flatnonzero(sums.any(axis=0))
        ids = np.append(seen, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(np.append(sums[0, seen], rows[0])), pa.array(np.append(sums[1, seen], rows[1]))],
            ["bucket", "other", "toxic"],
        )

    table = train.mapInArrow(count, "bucket long, other long, toxic long")
    table = table.groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    bucket = table["bucket"].to_numpy()
    total = bucket == -1
    other, toxic = table["other"].to_numpy(), table["toxic"].to_numpy()
    n_toxic, n_other = int(toxic[total].sum()), int(other[total].sum())
    scale = np.zeros(1 << BITS)
    p = (toxic[~total] + 1) / (n_toxic + 2)
    q = (other[~total] + 1) / (n_other + 2)
    ratio = np.log(p / q)
    error = np.sqrt((1 - p) / (p * (n_toxic + 2)) + (1 - q) / (q * (n_other + 2)))
    scale[bucket[~total]] = np.sign(ratio) * np.maximum(np.abs(ratio) - error, 0)
    return scale, n_toxic, n_other


def losses(rows: DataFrame, weights: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
    """Logistic loss over all rows, and its slope by weight and bias."""
    model = rows.sparkSession.sparkContext.broadcast((weights, bias))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        loss, slope, total = 0.0, np.zeros(len(weights)), 0.0
        for batch in batches:
            toxic = batch.column("toxic").to_numpy().astype(float)
            places = [np.frombuffer(x, "<u4") for x in batch.column("at").to_pylist()]
            column = np.concatenate([np.zeros(0, "<u4"), *places])
            owner = np.repeat(np.arange(len(places)), [len(x) for x in places])
            z = np.bincount(owner, weights[column], len(places)) + bias
            error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic
            loss += float((np.logaddexp(0, z) - toxic * z).sum())
            slope += np.bincount(column, error[owner], len(weights))
            total += float(error.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([loss]), pa.array([slope.tobytes()], pa.binary()), pa.array([total])], ["loss", "slope", "error"]
        )

    parts = rows.mapInArrow(add, "loss double, slope binary, error double").toArrow()  # a row a task
    model.unpersist()
    slope = sum((np.frombuffer(x) for x in parts["slope"].to_pylist()), np.zeros(len(weights)))
    return float(parts["loss"].to_numpy().sum()), slope, float(parts["error"].to_numpy().sum())


def minimise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int) -> np.ndarray:
    """Where a convex function is least, by limited-memory quasi-Newton steps; `evaluate` gives value and slope."""
    value, slope = evaluate(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, shares = -slope, []
        for step, change in reversed(past):
            shares.append(step @ direction / (step @ change))
            direction = direction - shares[-1] * change
        if past:
            step, change = past[-1]
            direction = direction * (step @ change / (change @ change))
        else:
            direction = direction / max(float(np.linalg.norm(slope)), 1e-300)
        for (step, change), share in zip(past, reversed(shares), strict=True):
            direction = direction + (share - change @ direction / (step @ change)) * step
        rate, fall = 1.0, float(slope @ direction)
        while True:
            new_value, new_slope = evaluate(x + rate * direction)
            if new_value <= value + 1e-4 * rate * fall or rate < 1e-6:
                break
            rate /= 2
        if new_value >= value:
            break
        step, change = rate * direction, new_slope - slope
        if step @ change > 0:
            past = [*past, (step, change)][-MEMORY:]
        small = value - new_value <= 1e-6 * value
        x, value, slope = x + step, new_value, new_slope
        if small:
            break
    return x


def train_model(train: DataFrame) -> tuple[np.ndarray, float]:
    """Weight of every bucket when present, and the intercept."""
    scale, n_toxic, n_other = ratios(train)
    if not n_toxic or not n_other:
        return np.zeros(1 << BITS), 30.0 if n_toxic else -30.0

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = buckets(lowered(batch.column("text").to_pylist()))
            ends = np.searchsorted(row, np.arange(1, batch.num_rows + 1))
            packed = [x.astype("<u4").tobytes() for x in np.split(bucket, ends[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(packed, pa.binary())], ["toxic", "at"])

    # At most TRAIN_ROWS rows, in few tasks, as each gives a slope of 2^18 numbers to the driver.
    rows = stash(train.repartition(TRAIN_TASKS).mapInArrow(present, "toxic int, at binary"), "features").coalesce(TRAIN_TASKS)

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope, error = losses(rows, x[:-1] * scale, float(x[-1]))
        return loss + PENALTY / 2 * float(x[:-1] @ x[:-1]), np.append(slope * scale + PENALTY * x[:-1], error)

    x = minimise(evaluate, np.append(np.zeros(1 << BITS), np.log(n_toxic / n_other)), STEPS)
    return x[:-1] * scale, float(x[-1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`."""
    train = stash(training_rows(docs, labels, doc_id, text, train_rows), "labelled")
    weights, bias = train_model(train)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = model.value != 0
        for batch in batches:
            row, bucket = buckets(lowered(batch.column("text").to_pylist()), used)
            z = np.bincount(row, model.value[bucket], batch.num_rows) + bias
            share = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(share), pa.array((share >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("held_out", held_out("doc_id"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
