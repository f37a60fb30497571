"""Scores of texts under a hierarchical Pitman-Yor model of words in their context and of their spelling.

Each word is a restaurant for the word after it: its customers are the training tokens that follow it, the first word of a text
following an end. Their parent is the word restaurant, whose customers are their tables; its parent spells words byte by byte.
There, each context of up to three bytes is a restaurant whose parent is the context one byte shorter,
down to a uniform distribution. Seating is sampled. Tables of word pairs begin with a word's share of the training tokens for
its parent's chance (that of words beyond the FREQUENT most frequent ones with their mean). Each Gibbs sweep after the first
draws the tables of every pair anew, with the chance that the word restaurant of the last sweep gives its second word; these tables are the word
restaurant's new customers. Then, given the spelling model, tables of every word are drawn in Spark; each table is a customer of the spelling
restaurants, whose tables are then drawn level by level. Customers of one dish are reseated in
blocks of an eighth of those already seated. After BURN_IN sweeps, predictive probabilities of pairs, each with the seating of pairs and
words of its own sweep, are averaged over SAMPLES sweeps. The discount of pairs is fixed.

Scores are over the training words and one unknown type, as the base score's are: an unknown
word has all the probability that the model spells outside of the training words.

Texts are read once and kept as blocks of word numbers with a word list each. Words and pairs of a block are sent, sorted, to
buckets by hash, where counts, tables and probabilities of all blocks meet; these go back to the blocks in the order in which they
came. A bucket keeps its distinct pairs and where each block has them; in a sweep it gets the chances of its second words from their buckets and
sends back the tables. Draws depend on the bucket, not on partitions. Pairs of very frequent first words are dealt by both words. All words and pairs of all
texts are counted. The spelling model is bounded: at most MAX_PAIRS (context, byte) pairs of three
bytes; customers of rarer ones sit in the two-byte context, of which there are at most 2^24.
The second word of a pair is a hash of 40 bits.

Defined results: a null text is empty, that is the end token alone; repeated rows are learnt from and scored
each; a row with a null doc_id is learnt from; an empty table gives an empty result;
without training tokens every base score is null and every score 0. Other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import LOWER, Prefix, mix, raw, segments, settle, slots, stash, word_spans

BLOCK_TOKENS = 1_500_000
BURN_IN, SAMPLES = 1, 2
ORDER, MAX_PAIRS = 3, 2_000_000
SPELLING_DISCOUNT, STRENGTH = 0.5, 1.0
PAIR_DISCOUNT = 0.75
BUCKET_BITS, PAIR_BITS = 9, 40
OWN_BITS = (1 << PAIR_BITS - BUCKET_BITS) - 1  # of the second word's hash, without its bucket
FREQUENT = 1_000_000  # words whose share of tokens is broadcast
HOT_SHARE = 1 / 256  # first words of at least this share of tokens are dealt by both words
STOP = 32  # ends a word's spelling and stands before its first byte
END = b"\n"  # the end token; no word has white space


def pack(numbers: np.ndarray) -> bytes:
    """Numbers of 1, 2, 4 or 8 bytes, as far as they need, all first bytes before all second ones."""
    top = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    parts = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zlib.compress(parts.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    parts = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((parts.shape[1], 8), np.uint8)
    out[:, : data[0]] = parts.T
    return out.view("<i8").reshape(-1)


def word_keys(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each of the words, which spaces separate; the end token's hash is 0."""
    data = np.frombuffer(words, np.uint8)
    gaps = np.flatnonzero(data == STOP)
    start, end = np.append(0, gaps + 1), np.append(gaps, len(data))
    keys = np.maximum(Prefix(data).of(start, end), np.uint64(1))
    keys[(end - start == 1) & (data[start] == END[0])] = 0
    return keys, start, end


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of runs of equal values."""
    begins = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return begins, np.append(begins[1:], len(values))


def _blobs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Adjoining slices of an array as binary values."""
    width = data.itemsize * (data.shape[1] if data.ndim > 1 else 1)
    offsets = (np.append(begins, ends[-1:]) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words from `start` to `end`, with a space between each two."""
    size = end - start
    out = np.full(int(size.sum()) + max(len(size) - 1, 0), STOP, np.uint8)
    at = np.arange(int(size.sum()))
    before = np.cumsum(size) - size
    out[at + np.repeat(np.arange(len(size)), size)] = data[at + np.repeat(start - before, size)]
    return out.tobytes()


def _groups(batches: Iterator[pa.RecordBatch], name: str = "bucket") -> Iterator[tuple[int, list[dict]]]:
    """Rows of batches sorted by `name`, group by group."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[name] != held[0][name]:
                yield held[0][name], held
                held = []
            held.append(row)
    if held:
        yield held[0][name], held


def _dealt(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition(slots(df.sparkSession), "bucket").sortWithinPartitions("bucket", *order)


def to_blocks(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(block, payload, words, counts): documents as word numbers, and the words, sorted by hash, with training counts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        names: list = []
        held: list[bool] = []
        lengths: list[np.ndarray] = []
        hashes: list[np.ndarray] = []
        train: list[np.ndarray] = []
        data_, spans = [np.frombuffer(END, np.uint8)], []  # bytes of the block, and where its tokens are
        size, width = 0, len(END)

        def block():
            known, first, local = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            counts = np.bincount(local[np.concatenate(train)], minlength=len(known))
            payload = pack(local)
            start, end = np.concatenate(spans, axis=1)[:, first]
            columns = [
                pa.array([task << 32 | made], pa.int64()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([np.concatenate(lengths).tolist()], pa.list_(pa.int64())),
                pa.array([payload], pa.binary()),
                pa.array([_joined(np.concatenate(data_), start, end)], pa.binary()),
                pa.array([pack(counts)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(
                columns, ["block", "doc_ids", "held_out", "lengths", "payload", "words", "counts"]
            )

        for batch in batches:
            rows_, found, spans_ = [], [], []
            for data, rows, begins in segments(raw(batch.column("text").to_pylist())):
                data = LOWER[data]
                start, end = word_spans(data)
                rows_.append(rows[np.searchsorted(begins, start, side="right") - 1])
                found.append(np.maximum(Prefix(data).of(start, end), np.uint64(1)))
                spans_.append(np.stack([start, end]) + width)
                data_.append(data)
                width += len(data)
            n = batch.num_rows
            row = np.concatenate([np.zeros(0, np.int64), *rows_])
            h = np.concatenate([np.zeros(0, np.uint64), *found])
            counts = np.bincount(row, minlength=n)
            ends = np.cumsum(counts)
            h = np.insert(h, ends, np.uint64(0))
            at = np.concatenate([np.zeros((2, 0), np.int64), *spans_], axis=1)
            spans.append(np.stack([np.insert(at[0], ends, 0), np.insert(at[1], ends, len(END))]))
            out = np.array(batch.column("held_out").to_pylist(), dtype=bool)
            names += batch.column("doc_id").to_pylist()
            held += out.tolist()
            lengths.append(counts + 1)
            hashes.append(h)
            train.append(np.repeat(~out, counts + 1))
            size += len(h)
            if size >= BLOCK_TOKENS:
                yield block()
                made, size = made + 1, 0
                names, held, lengths, hashes, train = [], [], [], [], []
                data_, spans, width = data_[:1], [], len(END)
        if names:
            yield block()

    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    schema = (
        "block long, doc_ids array<long>, held_out array<boolean>, lengths array<long>, payload binary, "
        "words binary, counts binary"
    )
    return stash(rows.mapInArrow(encode, schema), "blocks", compression="zstd")


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context of the last three bytes, byte) of every letter and stop; contexts begin with STOP."""
    text = np.frombuffer(bytes([STOP]).join([b"", *words, b""]), np.uint8).astype(np.int64)
    at = np.arange(1, len(text))
    is_stop = text == STOP
    word = np.cumsum(is_stop)[:-1] - 1
    back1 = text[at - 1]
    back2 = np.where((back1 == STOP) | (at < 2), 0, text[np.maximum(at - 2, 0)])
    back3 = np.where((back2 == 0) | (back2 == STOP) | (at < 3), 0, text[np.maximum(at - 3, 0)])
    return word, (back3 << 16) | (back2 << 8) | back1, text[at]


def draw_tables(rng: np.random.Generator, customers: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """Tables of each dish; `pull` is the weight of a new table, (strength + discount * tables) * parent's chance."""
    tables = np.minimum(customers, 1).astype(np.float64)
    seated = tables.copy()
    active = np.flatnonzero(customers > 1)
    while len(active):
        n, t, a = seated[active], tables[active], pull[active]
        step = np.minimum(np.maximum(n // 8, 1), customers[active] - n)
        new = rng.binomial(step.astype(np.int64), np.clip(a / (n - discount * t + a), 0, 1))
        tables[active] += new
        seated[active] += step
        active = active[seated[active] < customers[active]]
    return tables


@dataclass
class Level:
    """Restaurants of one context length: sorted contexts and (context, byte) pairs."""

    contexts: np.ndarray
    back: np.ndarray
    pairs: np.ndarray
    share: np.ndarray

    def apply(self, context: np.ndarray, byte: np.ndarray, parent: np.ndarray) -> np.ndarray:
        if not len(self.contexts):
            return parent
        at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = self.contexts[at] == context
        pair = (context << 8) | byte
        k = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        own = np.where(self.pairs[k] == pair, self.share[k], 0.0)
        return np.where(known, own + self.back[at] * parent, parent)


def shorten(context: np.ndarray, order: int) -> np.ndarray:
    return context & ((1 << 8 * order) - 1)


class Spelling:
    """Hierarchical Pitman-Yor restaurants over bytes, seated anew from customers of the longest contexts."""

    def __init__(self, rng: np.random.Generator, contexts: np.ndarray, bytes_: np.ndarray, customers: np.ndarray, before: Spelling | None):
        self.levels: list[Level] = []
        pairs = (contexts << 8) | bytes_
        top = np.argsort(-customers, kind="stable")
        extra_pairs, extra = pairs[top[MAX_PAIRS:]], customers[top[MAX_PAIRS:]].astype(float)
        pairs, count = pairs[top[:MAX_PAIRS]], customers[top[:MAX_PAIRS]].astype(float)
        levels = []
        for order in range(ORDER, -1, -1):
            merged, place = np.unique(pairs, return_inverse=True)
            count = np.bincount(place, count, len(merged))
            context, byte = merged >> 8, merged & 255
            parent = before.chance(shorten(context, order - 1), byte, order - 1) if before and order else np.full(len(merged), 1 / 256)
            names, owner = np.unique(context, return_inverse=True)
            guess = np.bincount(owner, minlength=len(names)).astype(float)  # a table for each dish
            pull = (STRENGTH + SPELLING_DISCOUNT * guess[owner]) * parent
            tables = draw_tables(rng, count, pull, SPELLING_DISCOUNT)
            total = np.bincount(owner, count, len(names)) + STRENGTH
            all_tables = np.bincount(owner, tables, len(names))
            share = (count - SPELLING_DISCOUNT * tables) / total[owner]
            levels.append(Level(names, (STRENGTH + SPELLING_DISCOUNT * all_tables) / total, merged, share))
            pairs, count = (shorten(context, order - 1) << 8 | byte) if order else pairs, tables
            if order == ORDER:
                pairs = np.append(pairs, shorten(extra_pairs >> 8, order - 1) << 8 | (extra_pairs & 255))
                count = np.append(count, extra)
        self.levels = levels[::-1]

    def chance(self, context: np.ndarray, byte: np.ndarray, order: int = ORDER) -> np.ndarray:
        p = np.full(len(byte), 1 / 256)
        for k in range(order + 1):
            p = self.levels[k].apply(shorten(context, k), byte, p)
        return p

    def words(self, words: list[bytes]) -> np.ndarray:
        word, context, byte = spell(words)
        # Few spellings are new within a batch: look each (context, byte) up once.
        pair, place = np.unique(context << 8 | byte, return_inverse=True)
        logs = np.log(self.chance(pair >> 8, pair & 255))
        return np.exp(np.bincount(word, logs[place], len(words)))


@dataclass
class Sample:
    """The word restaurant of one sweep and its parent."""

    spelling: Spelling
    tables: float
    known: float  # spelling mass of known words
    customers: int
    discount: float
    before: float | None  # tables in the sweep before; None for the first one, which gives each word one
    seed: int

    def chances(self, bucket: int, words: list[bytes], n: np.ndarray, c: np.ndarray) -> np.ndarray:
        # Every word that training lacks is the one unknown type, with the mass spelled outside of it.
        spelled = np.where(n > 0, self.spelling.words(words), max(1 - self.known, 1e-12))
        t, some = np.minimum(c, 1), c > 0
        if self.before is not None:  # the same draw as in the sweep, so that all chances add up to one
            t[some] = seat_words(bucket, c[some], spelled[some], self.before, self.discount, self.seed)
        return ((c - self.discount * t) + (STRENGTH + self.discount * self.tables) * spelled) / (STRENGTH + self.customers)


def seat_words(bucket: int, customers: np.ndarray, spelled: np.ndarray, tables: float, discount: float, seed: int) -> np.ndarray:
    return draw_tables(np.random.default_rng([seed, bucket]), customers, (STRENGTH + discount * tables) * spelled, discount)


@dataclass
class Model:
    samples: list[Sample]
    tokens: int
    types: int
    customers: int  # of the word restaurant
    discount: float


WORDS = "kind int, bucket int, block long, words binary, n binary"


def block_words(blocks: DataFrame) -> DataFrame:
    """A row for each block and bucket: its words there and their training counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, start, end = word_keys(row["words"])
                bucket, counts = bucket_of(keys), unpack(row["counts"])
                b, e = _runs_of(bucket)
                words = [row["words"][x:y] for x, y in zip(start[b].tolist(), end[e - 1].tolist(), strict=True)]
                n = [pack(counts[x:y]) for x, y in zip(b.tolist(), e.tolist(), strict=True)]
                columns = [pa.array(np.full(len(b), 1, np.int32)), pa.array(bucket[b].astype(np.int32)), pa.array(np.full(len(b), row["block"]))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.binary()), pa.array(n, pa.binary())], ["kind", "bucket", "block", "words", "n"])

    return blocks.select("block", "words", "counts").mapInArrow(split, WORDS)


def count_words(blocks: DataFrame) -> DataFrame:
    """(bucket, words, n, classes), stored: all words, sorted by hash, their training counts, and how many words have counts of each bit length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            data = b" ".join(r["words"] for r in rows)
            keys, start, end = word_keys(data)
            _, first, place = np.unique(keys, return_index=True, return_inverse=True)
            n = np.bincount(place, np.concatenate([unpack(r["n"]) for r in rows])).astype(np.int64)
            words = _joined(np.frombuffer(data, np.uint8), start[first], end[first])
            classes = np.bincount(np.frexp(n.astype(float))[1], minlength=64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([words], pa.binary()), pa.array([n.astype("<i8").tobytes()], pa.binary()), pa.array([classes.tolist()], pa.list_(pa.int64()))],
                ["bucket", "words", "n", "classes"],
            )

    counted = _dealt(block_words(blocks)).mapInArrow(count, "bucket int, words binary, n binary, classes array<long>")
    return stash(counted, "words", compression="zstd")


def frequent_words(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(40-bit hashes in order, training counts) of at most FREQUENT words."""
    sums = words.select(F.posexplode("classes").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).orderBy(F.desc("k")).collect()  # 64 rows
    kept = int(np.searchsorted(np.cumsum([r["n"] for r in sums if r["k"]]), FREQUENT, side="right"))
    least = 1 << (sums[kept - 1]["k"] - 1) if kept else 1 << 62

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = word_keys(row["words"])[0], np.frombuffer(row["n"], "<i8")
                some = n >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array((keys[some] >> np.uint64(64 - PAIR_BITS)).astype(np.int64)), pa.array(n[some])], ["key", "n"]
                )

    table = words.select("words", "n").mapInArrow(pick, "key long, n long").toArrow()
    key, n = table["key"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(key, kind="stable")
    return key[order], n[order]


def hot_words(blocks: DataFrame, tokens: int) -> np.ndarray:
    """Hashes of words that have at least HOT_SHARE of all training tokens, sorted."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = word_keys(row["words"])[0], unpack(row["counts"])
                some = n >= HOT_SHARE / 2 * n.sum()
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(n[some])], ["key", "n"])

    found = blocks.select("words", "counts").mapInArrow(pick, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    keys = [r["key"] for r in found.where(F.col("n") >= HOT_SHARE / 2 * tokens).collect()]  # at most 2 / HOT_SHARE rows
    return np.sort(np.array(keys, np.int64).view(np.uint64))


def pairs_of(row: dict, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first word, second word, training count, bucket, pair of each token) of a block's distinct pairs, by bucket."""
    keys = word_keys(row["words"])[0]
    ids = unpack(row["payload"])
    train = np.repeat(~np.array(row["held_out"], dtype=bool), row["lengths"])
    # Every text ends with the end token, which has number 0.
    pair, place = np.unique(np.append(0, ids[:-1]) << 32 | ids, return_inverse=True)
    count = np.bincount(place, train).astype(np.int64)
    u, w = pair >> 32, pair & 0xFFFFFFFF
    bucket = bucket_of(keys)[u]
    wide = np.isin(keys, hot)[u]
    bucket[wide] = bucket_of(mix(keys[u[wide]] ^ mix(keys[w[wide]])))
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return u[order], w[order], count[order], bucket[order], rank[place], keys


PAIRS = "bucket int, block long, first binary, sizes binary, second binary, n binary"
SEATED = "kind int, bucket int, block long, n binary, t binary, total binary"
STATE = f"{SEATED}, first binary, sizes binary, dish binary, blocks array<long>, places array<binary>, owners array<binary>"


def _rows(kind: int, buckets: list, blocks: list, *blobs) -> pa.RecordBatch:
    blobs = [x if isinstance(x, pa.Array) else pa.array(x, pa.binary()) for x in blobs]
    columns = [pa.array([kind] * len(buckets), pa.int32()), pa.array(buckets, pa.int32()), pa.array(blocks, pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, *blobs], ["kind", "bucket", "block", "n", "t", "total"])


def _with_state(rows: pa.RecordBatch, **state) -> pa.RecordBatch:
    """The rows with the columns of STATE, null if not given."""
    lists = {"blocks": pa.list_(pa.int64()), "places": pa.list_(pa.binary()), "owners": pa.list_(pa.binary())}
    for name in ("first", "sizes", "dish", "blocks", "places", "owners"):
        rows = rows.append_column(name, pa.array([state.get(name)] * rows.num_rows, lists.get(name, pa.binary())))
    return rows


def _pack_rising(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=0))


def _unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def seat_pairs(blocks: DataFrame, frequent: tuple[np.ndarray, np.ndarray], tokens: int, types: int, hot: np.ndarray, seed: int = 7) -> DataFrame:
    """First tables of all pairs, stored: a row of kind 0 for each bucket: counts and tables of its distinct pairs, and tables of their first words;
    the first words, how many pairs each has, the second word of each pair that training has, as a place among the bucket's, and for each block
    where its pairs and first words are; of kind 1 for buckets of second words and those of pairs (`block`): hashes and tables;
    of kind 2: first words dealt by both words, and tables."""
    sent = blocks.sparkSession.sparkContext.broadcast((*frequent, hot))
    shift = np.uint64(64 - PAIR_BITS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                u, w, count, bucket, _, keys = pairs_of(row, sent.value[2])
                b, e = _runs_of(bucket)
                second = (keys[w] >> shift).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : PAIR_BITS // 8]
                firsts, sizes, counts = [], [], []
                for x, y in zip(b.tolist(), e.tolist(), strict=True):
                    begins, ends = _runs_of(u[x:y])
                    firsts.append(keys[u[x + begins]].tobytes())
                    sizes.append(pack(ends - begins))
                    counts.append(pack(count[x:y]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[b].astype(np.int32)), pa.array(np.full(len(b), row["block"])), pa.array(firsts, pa.binary()), pa.array(sizes, pa.binary())]
                    + [_blobs(second, b, e), pa.array(counts, pa.binary())],
                    ["bucket", "block", "first", "sizes", "second", "n"],
                )

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times, hot = sent.value
        rare = max(tokens - int(times.sum()), 1) / max(types - len(known), 1)
        for bucket, met in _groups(batches):
            met.sort(key=lambda r: r["block"])
            first = np.concatenate([np.frombuffer(r["first"], np.uint64) for r in met])
            sizes = np.concatenate([unpack(r["sizes"]) for r in met])
            contexts, owner = np.unique(first, return_inverse=True)
            packed = np.frombuffer(b"".join(r["second"] for r in met), np.uint8).reshape(-1, PAIR_BITS // 8)
            second = np.zeros((len(packed), 8), np.uint8)
            second[:, : PAIR_BITS // 8] = packed
            pair = np.repeat(owner, sizes).astype(np.uint64) << np.uint64(PAIR_BITS) | second.view("<u8").reshape(-1)
            pair, place = np.unique(pair, return_inverse=True)
            n = np.bincount(place, np.concatenate([unpack(r["n"]) for r in met]))
            u, w = (pair >> np.uint64(PAIR_BITS)).astype(np.int64), (pair & np.uint64((1 << PAIR_BITS) - 1)).astype(np.int64)
            guess = np.bincount(u, n > 0, len(contexts)) * np.where(np.isin(contexts, hot), 1 << BUCKET_BITS, 1)  # a table for each dish
            share = np.full(len(w), float(rare))
            if len(known):
                at = np.minimum(np.searchsorted(known, w), len(known) - 1)
                share = np.where(known[at] == w, times[at], rare)
            pull = (STRENGTH + PAIR_DISCOUNT * guess[u]) * share / max(tokens, 1)
            t = draw_tables(np.random.default_rng([seed, 2, bucket]), n, pull, PAIR_DISCOUNT)
            total = np.bincount(u, t, len(contexts))
            ends, first_ends = np.cumsum([len(r["second"]) * 8 // PAIR_BITS for r in met]), np.cumsum([len(r["first"]) // 8 for r in met])
            dish, back = np.unique(w[n > 0], return_inverse=True)
            yield _with_state(
                _rows(0, [bucket], [None], [pack(n)], [pack(t)], [pack(total)]),
                first=contexts.tobytes(), sizes=pack(np.bincount(u, minlength=len(contexts))), dish=pack(back),
                blocks=[r["block"] for r in met],
                places=[_pack_rising(x) for x in np.split(place, ends[:-1])],
                owners=[_pack_rising(x) for x in np.split(owner, first_ends[:-1])],
            )
            if len(dish):
                b, e = _runs_of(dish >> (PAIR_BITS - BUCKET_BITS))
                tables = np.bincount(back, t[n > 0]).astype("<u4")
                to = (dish[b] >> (PAIR_BITS - BUCKET_BITS)).tolist()
                yield _with_state(_rows(1, to, [bucket] * len(to), _blobs((dish & OWN_BITS).astype("<u4"), b, e), _blobs(tables, b, e), [None] * len(to)))
            own = np.isin(contexts, hot)
            if own.any():
                yield _with_state(_rows(2, [bucket], [None], [contexts[own].tobytes()], [total[own].astype("<u4").tobytes()], [None]))

    dealt = _dealt(blocks.select("block", "held_out", "lengths", "payload", "words").mapInArrow(send, PAIRS))
    return stash(dealt.mapInArrow(seat, STATE), "pairs", compression="zstd")


def seat_again(pairs: DataFrame, before: DataFrame, vocabulary: DataFrame, sample: Sample, sweep: int, seed: int = 7) -> DataFrame:
    """Tables of all pairs, drawn anew and stored, given the word restaurant and the first words' tables in `before`, the seating before.

    Rows of kind 0 for each bucket: tables of its pairs and of their first words; of kinds 1 and 2 as those of `pairs`, without hashes in kind 1.
    """
    shared = vocabulary.sparkSession.sparkContext.broadcast((sample, *hot_tables(before)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            word, *asked = rows
            if not asked:
                continue
            n, c = np.frombuffer(word["t"], "<i8"), np.frombuffer(word["total"], "<i8").astype(float)
            p = shared.value[0].chances(bucket, word["n"].split(b" "), n, c).astype("<f4")
            short = (word_keys(word["n"])[0] >> np.uint64(64 - PAIR_BITS)).astype(np.int64) & OWN_BITS
            parts = [p[np.searchsorted(short, np.frombuffer(r["n"], "<u4"))].tobytes() for r in asked]
            none = [None] * len(asked)
            yield _with_state(_rows(5, [r["block"] for r in asked], [bucket] * len(asked), none, parts, none)).select(columns)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, dealt, tables = shared.value
        for bucket, (state, last, *answers) in _groups(batches):
            contexts, n = np.frombuffer(state["first"], np.uint64), unpack(state["n"])
            u = np.repeat(np.arange(len(contexts)), unpack(state["sizes"]))
            seats = unpack(last["total"])
            if len(dealt):
                at = np.minimum(np.searchsorted(dealt, contexts), len(dealt) - 1)
                seats = np.where(dealt[at] == contexts, tables[at], seats)
            some = n > 0
            dish = unpack(state["dish"])
            sizes = [len(r["t"]) // 4 for r in answers]
            p = np.frombuffer(b"".join(r["t"] for r in answers), "<f4").astype(float)
            t = np.zeros(len(n))
            pull = (STRENGTH + PAIR_DISCOUNT * seats[u[some]]) * p[dish]
            t[some] = draw_tables(np.random.default_rng([seed, 2, bucket, sweep]), n[some], pull, PAIR_DISCOUNT)
            total = np.bincount(u, t, len(contexts))
            yield _rows(0, [bucket], [None], [None], [pack(t)], [pack(total)])
            if answers:
                sums = np.bincount(dish, t[some], len(p)).astype("<u4")
                ends = np.cumsum(sizes)
                none = [None] * len(answers)
                yield _rows(1, [r["block"] for r in answers], [bucket] * len(answers), none, _blobs(sums, ends - sizes, ends), none)
            if len(dealt) and (own := dealt[at] == contexts).any():
                yield _rows(2, [bucket], [None], [contexts[own].tobytes()], [total[own].astype("<u4").tobytes()], [None])

    none = F.lit(None).cast("binary")
    columns = ["kind", "bucket", "block", "n", "t", "total", "first", "sizes", "dish"]
    # Words go as kind 0 with spellings, counts and customers for n, t and total.
    words = vocabulary.select(F.lit(0).alias("kind"), "bucket", F.lit(None).cast("long").alias("block"), F.col("words").alias("n"), F.col("n").alias("t"), F.col("c").alias("total"))
    asked = pairs.where("kind = 1").select("kind", "bucket", "block", "n", none.alias("t"), none.alias("total"))
    types = "kind int, bucket int, block long, n binary, t binary, total binary, first binary, sizes binary, dish binary"
    answers = _dealt(words.union(asked), "kind", "block").mapInArrow(answer, types)
    state = pairs.where("kind = 0").select("kind", "bucket", "block", "n", none.alias("t"), none.alias("total"), "first", "sizes", "dish")
    last = before.where("kind = 0").select(F.lit(4).alias("kind"), "bucket", "block", none.alias("n"), none.alias("t"), "total", *(none.alias(c) for c in columns[6:]))
    return stash(_dealt(state.union(last).union(answers), "kind", "block").mapInArrow(seat, SEATED), "seats", compression="zstd")


def to_each_block(pairs: DataFrame, seated: list[DataFrame]) -> DataFrame:
    """Rows of kind 0 for each block and bucket: counts of its pairs, their tables in all samples together, and tables of their first words in each."""

    samples = range(len(seated))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, t = unpack(row["n"]), sum(unpack(row[f"t{k}"]) for k in samples)
                total = np.stack([unpack(row[f"total{k}"]) for k in samples])
                places, owners = ([_unpack_rising(x) for x in row[k]] for k in ("places", "owners"))
                blobs = [pack(n[x]) for x in places], [pack(t[x]) for x in places], [pack(total[:, x].reshape(-1)) for x in owners]
                yield _rows(0, [row["bucket"]] * len(places), row["blocks"], *blobs)

    rows = pairs.where("kind = 0").select("bucket", "n", "blocks", "places", "owners")
    for k, one in enumerate(seated):
        rows = rows.join(one.where("kind = 0").select("bucket", F.col("t").alias(f"t{k}"), F.col("total").alias(f"total{k}")).hint("merge"), "bucket")
    return rows.mapInArrow(deal, SEATED)


def hot_tables(seated: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(first words dealt by both words, their tables in all buckets)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, tables = np.frombuffer(row["n"], np.int64), np.frombuffer(row["t"], "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(tables)], ["key", "tables"])

    rows = seated.where("kind = 2").select("n", "t").mapInArrow(read, "key long, tables long")
    table = rows.groupBy("key").agg(F.sum("tables").alias("tables")).toArrow()  # at most 2 / HOT_SHARE rows
    keys, tables = table["key"].to_numpy().view(np.uint64), table["tables"].to_numpy()
    order = np.argsort(keys)
    return keys[order], tables[order]


VOCABULARY = "bucket int, words binary, n binary, c binary, tokens long, types long, customers long, once long, twice long"


def with_customers(words: DataFrame, pairs: DataFrame, seated: DataFrame | None = None) -> DataFrame:
    """The words with their customers in the word restaurant: the tables of all pairs that end with them, those of `pairs` or of a later seating."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            word = rows[0]
            keys, n = word_keys(word["words"])[0], np.frombuffer(word["n"], "<i8")
            short = (keys >> np.uint64(64 - PAIR_BITS)).astype(np.int64) & OWN_BITS
            c = np.zeros(len(n), np.int64)
            asked = [r for r in rows if r["kind"] == 1]
            for r, x in zip(asked, [r for r in rows if r["kind"] == 2] or asked, strict=True):
                np.add.at(c, np.searchsorted(short, np.frombuffer(r["n"], "<u4")), np.frombuffer(x["t"], "<u4"))
            facts = [int(n.sum()), int((n > 0).sum()), int(c.sum()), int((c == 1).sum()), int((c == 2).sum())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([word["words"]], pa.binary()), pa.array([word["n"]], pa.binary()), pa.array([c.astype("<i8").tobytes()], pa.binary())]
                + [pa.array([x], pa.int64()) for x in facts],
                ["bucket", "words", "n", "c", "tokens", "types", "customers", "once", "twice"],
            )

    none = F.lit(None).cast("binary")
    rows = words.select(F.lit(0).alias("kind"), "bucket", F.lit(None).cast("long").alias("block"), "words", "n", none.alias("t"))
    rows = rows.union(pairs.where("kind = 1").select("kind", "bucket", "block", none, "n", "t" if seated is None else none))
    if seated is not None:
        rows = rows.union(seated.where("kind = 1").select(F.lit(2), "bucket", "block", none, none, "t"))
    return stash(_dealt(rows, "kind", "block").mapInArrow(add, VOCABULARY), "vocabulary", compression="zstd")


def _word_pass(vocabulary: DataFrame, spelling: Spelling | None, tables: float, discount: float, seed: int):
    """Seat every word: pairs of context and byte, their customers, tables, and the spelling mass of the words."""

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, sums, total, mass = np.zeros(0, np.int64), np.zeros(0), 0.0, 0.0
        for batch in batches:
            for row in batch.to_pylist():
                c = np.frombuffer(row["c"], "<i8").astype(float)
                words = [x for x, n in zip(row["words"].split(b" "), c.tolist(), strict=True) if n]
                c = c[c > 0]
                if not words:
                    continue
                if spelling is None:
                    t = np.minimum(c, 1)
                else:
                    spelled = spelling.words(words)
                    mass += spelled.sum()
                    t = seat_words(row["bucket"], c, spelled, tables, discount, seed)
                word, context, byte = spell(words)
                pairs, place = np.unique(np.concatenate([pairs, context << 8 | byte]), return_inverse=True)
                sums = np.bincount(place, np.concatenate([sums, t[word]]), len(pairs))
                total += t.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(pairs, [-1, -2])), pa.array(np.append(sums, [total, mass]))], ["pair", "customers"]
        )

    seats = vocabulary.select("bucket", "words", "c").mapInArrow(seat, "pair long, customers double")
    table = seats.groupBy("pair").agg(F.sum("customers").alias("customers")).toArrow()
    pair, customers = table["pair"].to_numpy(), table["customers"].to_numpy()
    real = pair >= 0
    order = np.argsort(pair[real])
    return pair[real][order], customers[real][order], float(customers[pair == -1].sum()), float(customers[pair == -2].sum())


def learn(vocabulary: DataFrame, seed: int = 7, reseat: Callable[[Sample, int], DataFrame] | None = None) -> Model:
    """Gibbs sweeps over the stored words and their customers.

    Before each sweep but the first, `reseat` seats the customers of pairs anew, given the word restaurant and the sweep's number,
    and gives the words with their new customers; without it these stay.
    """
    rng = np.random.default_rng(seed)
    spelling, tables, model, last = None, 0.0, None, None
    for sweep in range(BURN_IN + SAMPLES):
        if sweep and reseat is not None:
            vocabulary = reseat(last, sweep)
        if not sweep or reseat is not None:
            facts = vocabulary.agg(*(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("tokens", "types", "customers", "once", "twice"))).first()
            once, twice = facts["once"] + 1, facts["twice"] + 1
            model = Model(model.samples if model else [], facts["tokens"], facts["types"], facts["customers"], once / (once + 2 * twice))
        before = tables
        pairs, customers, tables, known = _word_pass(vocabulary, spelling, before, model.discount, seed + sweep)
        now = Spelling(rng, pairs >> 8, pairs & 255, customers, spelling)
        state = (tables, min(known, 1.0), model.customers, model.discount)
        last = Sample(spelling, *state, before, seed + sweep) if spelling is not None else Sample(now, *state, None, seed)
        if spelling is not None and sweep >= BURN_IN:
            model.samples.append(last)
        spelling = now
    return model


def word_chances(vocabulary: DataFrame, model: Model) -> DataFrame:
    """(bucket, words, n, p), stored: each word's predictive probability in the word restaurant, averaged over the samples."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words, n, c = row["words"].split(b" "), np.frombuffer(row["n"], "<i8"), np.frombuffer(row["c"], "<i8").astype(float)
                p = sum(sample.chances(row["bucket"], words, n, c) for sample in model.samples)
                out.append((p / len(model.samples)).tobytes())
            columns = [batch.column(c) for c in ("bucket", "words", "n")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], ["bucket", "words", "n", "p"])

    chances = vocabulary.select("bucket", "words", "n", "c").mapInArrow(predict, "bucket int, words binary, n binary, p binary")
    return stash(chances, "chances", compression="zstd")


def values_of(blocks: DataFrame, chances: DataFrame) -> DataFrame:
    """(kind, bucket, block, n, t, total): training counts and probabilities, one after the other for each sample, of each block's words, bucket by bucket."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            known, *asked = rows
            keys, n, p = word_keys(known["words"])[0], np.frombuffer(known["n"], "<i8"), np.frombuffer(known["t"], np.float64)
            p = p.reshape(-1, len(n))
            place = np.searchsorted(keys, word_keys(b" ".join(r["words"] for r in asked))[0])
            parts = np.split(place, np.cumsum([r["words"].count(b" ") + 1 for r in asked])[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([3] * len(asked), pa.int32()), pa.array([bucket] * len(asked), pa.int32()), pa.array([r["block"] for r in asked], pa.int64())]
                + [pa.array([pack(n[x]) for x in parts], pa.binary()), pa.array([p[:, x].tobytes() for x in parts], pa.binary()), pa.nulls(len(asked), pa.binary())],
                ["kind", "bucket", "block", "n", "t", "total"],
            )

    none = F.lit(None).cast("binary")
    asked = block_words(blocks).select("kind", "bucket", "block", "words", none.alias("n"), none.alias("t"))
    known = chances.select(F.lit(0).alias("kind"), "bucket", F.lit(None).cast("long").alias("block"), "words", "n", F.col("p").alias("t"))
    return _dealt(known.union(asked), "kind").mapInArrow(answer, SEATED)


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, perplexity double"
)


def learnt(blocks: DataFrame) -> tuple[DataFrame, DataFrame, Model, list, np.ndarray]:
    """(counts and tables of pairs for each block and bucket, counts and chances of words for them, the model, tables of first words dealt by both words
    in each sample, these words)."""
    words = count_words(blocks)
    frequent = frequent_words(words)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.frombuffer(x, "<i8") for x in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n]), pa.array([int((x > 0).sum()) for x in n])], ["tokens", "types"])

    facts = words.select("n").mapInArrow(add, "tokens long, types long").agg(F.sum("tokens"), F.sum("types")).first()
    hot = hot_words(blocks, facts[0] or 0)
    pairs = seat_pairs(blocks, frequent, facts[0] or 0, facts[1] or 0, hot)
    states = [(pairs, with_customers(words, pairs))]

    def reseat(sample: Sample, sweep: int) -> DataFrame:
        before, vocabulary = states[-1]
        seated = seat_again(pairs, before, vocabulary, sample, sweep)
        states.append((seated, with_customers(words, pairs, seated)))
        return states[-1][1]

    model = learn(states[0][1], reseat=reseat)
    drawn = states[-len(model.samples):]
    chances = words.select("bucket", "words", "n")
    for k, (sample, (_, vocabulary)) in enumerate(zip(model.samples, drawn, strict=True)):
        mine = word_chances(vocabulary, replace(model, samples=[sample]))
        chances = chances.join(mine.select("bucket", F.col("p").alias(f"p{k}")).hint("merge"), "bucket")
    chances = chances.select("bucket", "words", "n", F.concat(*(f"p{k}" for k in range(len(drawn)))).alias("p"))
    tables = to_each_block(pairs, [seated for seated, _ in drawn])
    return tables, values_of(blocks, chances), model, [hot_tables(seated) for seated, _ in drawn], hot


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`; `perplexity` is 10^(-score / n_tokens)."""
    blocks = to_blocks(df, doc_id, text)
    facts: list = []

    def values_for_blocks() -> tuple[DataFrame, DataFrame]:
        tables, chances, *more = learnt(blocks)
        facts.extend(more)
        return tables, chances

    # Seatings, words and shuffle files go before the blocks get their values.
    tables, chances = settle(df.sparkSession, values_for_blocks, "tables", "values", compression="zstd")
    values = tables.union(chances)
    model, dealt, hot = facts
    tokens, types, samples = model.tokens, model.types, len(model.samples)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        n = np.concatenate([unpack(r["n"]) for r in found if r["kind"] == 3])
        p = np.concatenate([np.frombuffer(r["t"], np.float64).reshape(samples, -1) for r in found if r["kind"] == 3], axis=1)
        c, t = (np.concatenate([unpack(r[k]) for r in found if r["kind"] == 0]) for k in ("n", "t"))
        total = np.concatenate([unpack(r["total"]).reshape(samples, -1) for r in found if r["kind"] == 0], axis=1)
        base = np.log10((n + 1) / (tokens + types + 1)) if tokens else np.full(len(n), np.nan)
        parts = []
        for row in left.to_pylist():
            ids = unpack(row["payload"])
            lengths = np.array(row["lengths"])
            begins = np.cumsum(lengths) - lengths
            u, w, _, bucket, place, keys = pairs_of(row, hot)
            start, end = _runs_of(bucket << 32 | u)  # a first word in a bucket
            back = np.zeros(len(u))
            for k, (words, tables) in enumerate(dealt):
                seats = np.repeat(total[k], end - start)
                if len(words):
                    at = np.minimum(np.searchsorted(words, keys[u]), len(words) - 1)
                    seats = np.where(words[at] == keys[u], tables[at], seats)
                back += (STRENGTH + PAIR_DISCOUNT * seats) * p[k][w]
            chance = (c - PAIR_DISCOUNT * t / samples + back / samples) / (STRENGTH + n[u])
            sums = np.add.reduceat(np.log10(chance)[place], begins)
            scores = np.add.reduceat(base[ids], begins)
            parts.append(pa.table({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array(row["held_out"], pa.bool_()),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(np.add.reduceat((n > 0)[ids].astype(np.int64), begins)),
                "train_tokens": pa.array(np.full(len(lengths), tokens)),
                "base_score": pa.array(scores, from_pandas=True),
                "score": pa.array(sums),
                "perplexity": pa.array(10 ** np.minimum(-sums / lengths, 300)),
            }))
        return pa.concat_tables(parts)

    stored = blocks.select(F.col("block").alias("home"), "doc_ids", "held_out", "lengths", "payload", "words")
    return stored.groupBy("home").cogroup(values.groupBy("block")).applyInArrow(score, SCHEMA)
