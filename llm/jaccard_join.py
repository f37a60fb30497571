"""Documents whose sets of word shingles are similar, as components, exactly.

Sets are 64-bit hashes of SHINGLE words; equal sets are one node. Two sets that
link miss at most e = n - ceil(threshold * n) of each other's tokens, n being the size.

Tokens are in one order for all sets: those of up to RARE sets by hash, then the more frequent ones by count. The counts are of
40-bit fingerprints of all tokens of all texts, which pass the shuffle as differences of sorted numbers, 3 bytes each. At most
HOT_TOKENS of them, the most frequent, are broadcast; any order would be right, this one keeps frequent tokens out of prefixes.

Rare tokens: the first e + 1 tokens of two linked sets share one, so each
prefix token is indexed alone. A token that more than RARE nodes hold is of the frequent class:
its nodes extend their prefix to the whole set and are indexed by combinations of tokens.
For that the tokens are dealt over more buckets than two linked sets can differ in, by size class, so that
one bucket holds the same combination in both. Every linked pair shares a rare token or a combination.

A group of nodes with one index entry isn't expanded into pairs. Each node is compared with one leader,
the least node of most of its groups. Links found make components, and only nodes of different components that
share a group are compared further; equal groups count once. In groups of at most SMALL nodes those pairs of fitting size are
listed, less than SMALL for each member. Larger groups are gathered if most of their nodes are the same, as those of the
entries of near copies, and compared in blocks of BLOCK_NODES: first each node with the nearest,
then each component with each other by the BRIDGES pairs that are nearest, as one link unites two components and
more of them grow with the square of a group's size; at last, with the components so found, all that differ in component.
Nodes of the component that has most of a group aren't compared with each other, so only the rest go to several blocks. Parity sketches, which never differ in more bits than the
sets in tokens, drop pairs that can't link; the texts of the other pairs are compared exactly.

Texts are stored once, beside the facts of their set, and never shuffled as a whole: what is compared or combined is chosen
by the ids of its nodes, which are broadcast up to BROADCAST_NODES and joined by a shuffle beyond. Tables of groups and components
are joined by shuffle also while they are small, as each of many broadcasts would take memory on the driver.

Defined results: a null or empty text has an empty set, links with nothing and is its own component;
less than SHINGLE words make one shingle; repeated rows share a component; with null ids
the component is the least id that isn't null, if any; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import in_few_files, mix, raw, settle, slots, stash, text_key, words_of
from llm.components import components

SHINGLE, THRESHOLD = 4, 85
RARE = 8
SPARE = 4  # empty buckets that a set may have without indexing them
CLASS_RATIO = 1.5
SMALL = 32
BRIEF = 16
BLOCK_NODES = 2048
BRIDGES = 4
MEMBER, ASKING = 0, 1
NEAREST, BETWEEN, ALL = "nearest", "between", "all"
BROADCAST_NODES = 1_000_000
HOT_TOKENS = 1_000_000
FINGERPRINT, RUN_TOKENS = 40, 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) of all texts, sorted by row and shingle."""
    row, h = words_of(texts)
    n = len(h) - k + 1
    whole = np.zeros(0, np.int64)
    counts = np.bincount(row, minlength=len(texts))
    rows, tokens = [whole], [np.zeros(0, np.uint64)]
    if n > 0:
        value = h[:n]
        for j in range(1, k):
            value = mix(value * _A + h[j : j + n])
        inside = row[:n] == row[k - 1 :]
        rows.append(row[:n][inside])
        tokens.append(value[inside])
    begin = np.cumsum(counts) - counts
    for r in np.flatnonzero((counts > 0) & (counts < k)).tolist():
        value = counts[r : r + 1].astype(np.uint64)
        for x in h[begin[r] : begin[r] + counts[r]]:
            value = mix(value * _B + x)
        rows.append(np.array([r]))
        tokens.append(value)
    row, token = np.concatenate(rows), np.concatenate(tokens)
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.append(True, (row[1:] != row[:-1]) | (token[1:] != token[:-1]))[: len(row)]
    return row[new], token[new]


def nodes_of(row: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the set, size) of each of n rows; 0 for empty sets."""
    sizes = np.bincount(row, minlength=n)
    sums = np.zeros(n, np.uint64)
    begins = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
    if len(begins):
        sums[row[begins]] = np.add.reduceat(mix(token ^ _B), begins)
    return np.where(sizes > 0, mix(sums + sizes.astype(np.uint64) * _A).view(np.int64), 0), sizes


def missing_allowed(size: np.ndarray, threshold: int) -> np.ndarray:
    return size - -(-size * threshold // 100)


def _class_bounds(threshold: int) -> np.ndarray:
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * CLASS_RATIO)))
    return np.array(bounds)


def combinations(row: np.ndarray, token: np.ndarray, sizes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index entry) of the token combinations of each set.

    A set is dealt into the buckets of its size class, and of the class below if a set there can be similar.
    """
    bounds = _class_bounds(threshold)
    own = np.searchsorted(bounds, sizes, side="right") - 1
    out_row, out_key = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lower in (0, 1):
        label = own - lower
        # The smallest partner of this set, against the beginning of its own class.
        takes = (sizes > 0) & (label >= 0) & ((lower == 0) | (-(-sizes * threshold // 100) < bounds[np.maximum(own, 0)]))
        top = bounds[np.maximum(label, 0) + 1] - 1  # largest set of the class: its largest partner is top / threshold
        differ = (100 - threshold) * (top + top * 100 // threshold) // (100 + threshold)
        buckets = differ + 1 + SPARE
        used = takes[row]
        r, t = row[used], token[used]
        if not len(r):
            continue
        seed = label[r].astype(np.uint64) * _A
        bucket = (mix(t ^ seed) % buckets[r].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((bucket, r))
        r, t, bucket = r[order], t[order], bucket[order]
        begins = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (bucket[1:] != bucket[:-1])))
        content = np.add.reduceat(mix(t * _B), begins)
        r, bucket = r[begins], bucket[begins]
        out_row.append(r)
        out_key.append(mix(content ^ mix(bucket.astype(np.uint64) + label[r].astype(np.uint64) * _B)))
        filled = np.bincount(r, minlength=len(sizes))
        for k in np.flatnonzero(takes & (buckets - filled > SPARE)).tolist():
            empty = np.setdiff1d(np.arange(buckets[k]), bucket[r == k])
            out_row.append(np.full(len(empty), k))
            out_key.append(mix(empty.astype(np.uint64) + label[k : k + 1].astype(np.uint64) * _B))
    return np.concatenate(out_row), np.concatenate(out_key)


def pack_differences(values: np.ndarray, start: int = 0) -> bytes:
    """Sorted distinct numbers below 2^40 as 3-byte differences, the first from `start`; larger ones are spelled as steps of 2^24 - 1."""
    step = np.diff(values, prepend=np.int64(start))
    whole = step // 0xFFFFFF
    out = np.repeat(np.int64(0xFFFFFF), len(values) + int(whole.sum()))
    out[np.cumsum(whole + 1) - 1] = step % 0xFFFFFF
    return out.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpack_differences(data: bytes, start: int = 0) -> np.ndarray:
    step = np.zeros((len(data) // 3, 4), np.uint8)
    step[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    step = step.view("<u4").reshape(-1).astype(np.int64)
    return np.cumsum(step)[step != 0xFFFFFF] + start


def fingerprints(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - FINGERPRINT)).astype(np.int64)


def hot_tokens(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints in order, place in the order of counts) of tokens that more than RARE texts hold."""
    spark = docs.sparkSession
    buckets = 4 * slots(spark)

    def least_of(bucket: int) -> int:
        return -(-(bucket << FINGERPRINT) // buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            bucket = (values * buckets) >> FINGERPRINT
            begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            once, twice, more = [], [], []
            for b, e in zip(begins.tolist(), np.append(begins[1:], len(values)).tolist(), strict=True):
                again = b + np.flatnonzero(times[b:e] > 1)
                # Differences from 0 would take up to 65,536 steps for each bucket.
                start = least_of(int(bucket[b]))
                once.append(pack_differences(values[b:e], start))
                twice.append(pack_differences(values[again], start))
                more.append((times[again] - 1).astype("<u4").tobytes())
            blobs = [pa.array(x, pa.binary()) for x in (once, twice, more)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[begins].astype(np.int32)), *blobs], ["bucket", "once", "twice", "more"])

        for batch in batches:
            _, token = shingle_sets(raw(batch.column("text").to_pylist()), shingle)
            if len(token):
                waiting.append(fingerprints(token))
                size += len(token)
            if size > RUN_TOKENS:
                yield flush()
                size = 0
        if waiting:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, values, times = None, [], []

        def total() -> pa.RecordBatch:
            value, back = np.unique(np.concatenate(values), return_inverse=True)
            n = np.bincount(back, np.concatenate(times)).astype(np.int64)
            hot = n > RARE
            values.clear()
            times.clear()
            return pa.RecordBatch.from_arrays([pa.array(value[hot]), pa.array(n[hot])], ["token", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != present and values:
                    yield total()
                present = row["bucket"]
                start = least_of(present)
                once, twice = unpack_differences(row["once"], start), unpack_differences(row["twice"], start)
                values += [once, twice]
                times += [np.ones(len(once), np.int64), np.frombuffer(row["more"], "<u4").astype(np.int64)]
        if values:
            yield total()

    runs = docs.select("text").mapInArrow(count, "bucket int, once binary, twice binary, more binary")
    dealt = runs.repartition(slots(spark), "bucket").sortWithinPartitions("bucket")
    counts = stash(dealt.mapInArrow(add, "token long, n long"), "frequent-tokens")
    classes = counts.groupBy((F.length(F.bin("n")) - 1).alias("k")).count().orderBy(F.desc("k")).collect()  # 63 rows at most
    kept = int(np.searchsorted(np.cumsum([r["count"] for r in classes]), HOT_TOKENS, side="right"))
    least = 1 << classes[kept - 1]["k"] if kept else 1 << 62
    table = counts.where(F.col("n") >= least).toArrow()
    token, n = table["token"].to_numpy(), table["n"].to_numpy()
    place = np.empty(len(token), np.int64)
    place[np.lexsort((token, n))] = np.arange(1, len(token) + 1)
    order = np.argsort(token)
    return token[order], place[order]


def sets_table(docs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """(doc_id, text_key, node, n_shingles, prefix, crowded, sketch, text), stored; texts are cut into shingles once for all of these.

    A task gives prefix tokens, sketch (see `sketch_of`) and text where it first meets a node. Once it has met a token
    again and again, it reports no more of its nodes, as it is frequent; other nodes that hold the token are crowded.
    """

    hot = docs.sparkSession.sparkContext.broadcast(hot_tokens(docs, shingle))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = hot.value
        counts: dict[int, int] = {}
        known = np.zeros(0, np.int64)
        seen: set[int] = set()
        for batch in batches:
            n = batch.num_rows
            row, token = shingle_sets(raw(batch.column("text").to_pylist()), shingle)
            node, size = nodes_of(row, token, n)
            fresh = np.zeros(n, dtype=bool)
            for k, value in enumerate(node.tolist()):
                fresh[k] = value not in seen
                seen.add(value)
            if len(seen) > 2_000_000:
                seen.clear()
            fresh &= size > 0
            end = np.cumsum(size)
            ordered = token
            if len(frequent) and len(token):
                mark = fingerprints(token)
                at = np.minimum(np.searchsorted(frequent, mark), len(frequent) - 1)
                ordered = token[np.lexsort((token, np.where(frequent[at] == mark, rank[at], 0), row))]
            place = np.arange(len(row)) - (end - size)[row]
            kept = (place <= missing_allowed(size, threshold)[row]) & fresh[row]
            tokens, owners = ordered[kept].view(np.int64), row[kept]
            # Tokens met before in this task, or twice in this batch, are counted.
            _, back, times = np.unique(tokens, return_inverse=True, return_counts=True)
            again = np.flatnonzero((times[back] > 1) | np.isin(tokens, known))
            over = np.zeros(len(tokens), dtype=bool)
            for k in again.tolist():
                value = int(tokens[k])
                counts[value] = counts.get(value, 0) + 1
                over[k] = counts[value] > RARE + 1
            if len(again):
                known = np.fromiter(counts, np.int64, len(counts))
            crowded = np.bincount(owners[over], minlength=n) > 0
            ends = np.cumsum(np.append(0, np.bincount(owners[~over], minlength=n)))
            prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens[~over]))
            sketches = [
                sketch_of(token[e - m : e]) if first else None
                for e, m, first in zip(end.tolist(), size.tolist(), fresh.tolist(), strict=True)
            ]
            texts = pc.if_else(pa.array(fresh), batch.column("text"), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(node), pa.array(size), prefix]
                + [pa.array(crowded), pa.array(sketches, pa.binary()), texts],
                ["doc_id", "text_key", "node", "n_shingles", "prefix", "crowded", "sketch", "text"],
            )

    columns = "doc_id long, text_key long, node long, n_shingles long, prefix array<long>, crowded boolean, sketch binary, text string"
    return stash(docs.mapInArrow(measure, columns), "sets", compression="zstd")


def among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose node is among `nodes` (one column `node`), each node once. Rows that aren't wanted don't move while the nodes are few."""
    nodes = stash(in_few_files(nodes.distinct()), "nodes")
    few = nodes.count() <= BROADCAST_NODES
    return rows.join(F.broadcast(nodes) if few else nodes, "node", "left_semi").dropDuplicates(["node"])


def shared_tokens(entries: DataFrame) -> DataFrame:
    """(token, node, frequent) of tokens that several nodes hold, each node once; all in one shuffle by token."""
    by_token = Window.partitionBy("token")
    bounds = entries.withColumns({"least": F.min("node").over(by_token), "last": F.max("node").over(by_token)})
    # Tasks may have reported the same node.
    once = bounds.where("least < last").select("token", "node").distinct()
    return once.withColumn("frequent", F.count("*").over(by_token) > RARE)


def sketch_of(token: np.ndarray) -> bytes:
    """A bit for each of 4 size tokens or more: how many of the set's tokens fall there, odd or even.

    Two sketches differ in no more bits than the sets in tokens. The number of bits is a power of two, so a
    longer sketch is folded to the length of a shorter one.
    """
    bits = 1 << min(max((4 * len(token)).bit_length(), 6), 24)
    odd = np.bincount((token & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def verify(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, stored; the texts of their nodes alone are moved to both sides."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            both = []
            for side in ("text_a", "text_b"):
                row, token = shingle_sets(raw(batch.column(side).to_pylist()), shingle)
                both.append((row, token, np.bincount(row, minlength=n)))
            (ra, ta, na), (rb, tb, nb) = both
            row, token = np.concatenate([ra, rb]), np.concatenate([ta, tb])
            order = np.lexsort((token, row))
            row, token = row[order], token[order]
            twice = (row[1:] == row[:-1]) & (token[1:] == token[:-1])
            shared = np.bincount(row[1:][twice], minlength=n)
            good = pa.array(100 * shared >= threshold * (na + nb - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(good)

    concerned = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    texts = among(texts, concerned)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "text_a", "text_b")
    return stash(joined.mapInArrow(check, "a long, b long"), "links")


def sketches_of(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, size, sketch, brief) of these nodes, stored; `brief` is the sketch folded to BRIEF words of 64 bits at most."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            briefs = []
            for sketch in batch.column("sketch").to_pylist():
                x = np.frombuffer(sketch, np.uint8)
                while len(x) > 8 * BRIEF:
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                briefs.append(x.view("<i8"))
            columns = [batch.column(c) for c in ("node", "size", "sketch")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(briefs, pa.list_(pa.int64()))], ["node", "size", "sketch", "brief"]
            )

    met = among(sets.where(F.col("sketch").isNotNull()).select("node", "n_shingles", "sketch"), nodes)
    rows = met.select("node", F.col("n_shingles").alias("size"), "sketch")
    return stash(rows.mapInArrow(fold, "node long, size long, sketch binary, brief array<long>"), "sketches")


def _differing(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        longer = x if len(x) > len(y) else y
        half = longer[: len(longer) // 2] ^ longer[len(longer) // 2 :]
        x, y = (half, y) if longer is x else (x, half)
    return int(np.bitwise_count(x ^ y).sum())


def _folded(sketch: np.ndarray, length: int) -> np.ndarray:
    while len(sketch) > length:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _bridges(first: np.ndarray, second: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Places of the BRIDGES rows that differ least for each (first, second)."""
    order = np.lexsort((differ, second, first))
    f, s = first[order], second[order]
    begins = np.flatnonzero(np.append(True, (f[1:] != f[:-1]) | (s[1:] != s[:-1]))[: len(f)])
    rank = np.arange(len(f)) - np.repeat(begins, np.diff(np.append(begins, len(f))))
    return order[rank < BRIDGES]


def _across(threshold: int, which: str):
    """Pairs of asking nodes and others of one block, of different components, that sizes and sketches don't exclude.

    NEAREST: only the pair of each asking node whose sketches differ least. BETWEEN: only the BRIDGES pairs of
    each two components whose sketches differ least. ALL: all of them.
    """
    nearest = which == NEAREST

    def compare(table: pa.Table) -> pa.Table:
        table = table.take(np.argsort(table["size"].to_numpy(), kind="stable"))
        size, node, component = (table[c].to_numpy() for c in ("size", "node", "component"))
        role, asks = table["role"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False)
        sketches = [np.frombuffer(x, np.uint8) for x in table["sketch"].to_pylist()]
        length = np.array([len(x) for x in sketches])
        left, right, apart = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        best, least = np.full(len(node), -1), np.full(len(node), 1 << 60)
        for mine in np.unique(length[role == ASKING]).tolist():
            asking = np.flatnonzero((length == mine) & (role == ASKING))
            for other in np.unique(length[role == MEMBER]).tolist():
                met = np.flatnonzero((length == other) & (role == MEMBER))
                low = np.searchsorted(size[met], -(-size[asking] * threshold // 100))
                high = np.searchsorted(size[met], size[asking] * 100 // threshold, side="right")
                if not (low < high).any():
                    continue
                width = min(mine, other)
                matrix = np.stack([_folded(sketches[k], width) for k in met.tolist()])
                wide = matrix.view(np.uint64) if width % 8 == 0 else matrix
                for x, b, e in zip(asking.tolist(), low.tolist(), high.tolist(), strict=True):
                    y = met[b:e]
                    # Of two asking nodes one asks the other; the nearest may be any.
                    fits = (component[y] != component[x]) & (nearest | ~asks[y] | (node[y] > node[x]))
                    y, at = y[fits], np.arange(b, e)[fits]
                    differ = np.bitwise_count(wide[at] ^ _folded(sketches[x], width).view(wide.dtype)).sum(axis=1, dtype=np.int64)
                    close = (100 + threshold) * differ <= (100 - threshold) * (size[x] + size[y])
                    y, differ = y[close], differ[close]
                    if nearest and len(y) and differ.min() < least[x]:
                        least[x], best[x] = differ.min(), y[differ.argmin()]
                    elif not nearest:
                        if which == BETWEEN:
                            kept = _bridges(np.zeros(len(y)), component[y], differ)
                            y, differ = y[kept], differ[kept]
                            apart.append(differ)
                        left.append(np.full(len(y), x))
                        right.append(y)
        if nearest:
            found = np.flatnonzero(best >= 0)
            left, right = [found], [best[found]]
        a, b = np.concatenate(left), np.concatenate(right)
        if which == BETWEEN:
            p, q = component[a], component[b]
            kept = _bridges(np.minimum(p, q), np.maximum(p, q), np.concatenate(apart))
            a, b = a[kept], b[kept]
        return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})

    return compare


def possible(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches don't exclude a link, stored."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "size_a", "size_b"))
            good = [
                (100 + threshold) * _differing(x, y) <= (100 - threshold) * (n + m) for x, y, n, m in zip(a, b, na, nb, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    for side in ("a", "b"):
        mine = sketches.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(mine, side)
    close = 100 * F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b")
    return stash(pairs.where(close).mapInArrow(keep, "a long, b long"), "possible")


def groups_of(entries: DataFrame) -> DataFrame:
    """(group, members, leader, node, entries) of index entries with several nodes; entries with equal nodes are one group."""
    by_entry = Window.partitionBy("entry")
    groups = entries.withColumns(
        {
            "leader": F.min("node").over(by_entry),
            "last": F.max("node").over(by_entry),
            "members": F.count("*").over(by_entry),
            "content": F.bit_xor(F.xxhash64("node")).over(by_entry),
        }
    ).where("leader < last")
    groups = groups.withColumn("group", F.xxhash64("content", "leader", "last", "members"))
    return groups.groupBy("group", "members", "leader", "node").agg(F.count("*").alias("entries"))


def labelled(members: DataFrame, known: DataFrame) -> DataFrame:
    """The members of groups, with the component known of each node."""
    return members.join(known.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _as_links(known: DataFrame) -> DataFrame:
    """Links that make the same components."""
    return known.select(F.col("node").alias("a"), F.col("component").alias("b"))


def listed(members: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of nodes of one small group that differ in component and that sizes and brief sketches don't exclude."""
    mixed = members.groupBy("group").agg((F.min("component") < F.max("component")).alias("mixed"))
    nodes = members.join(mixed.where("mixed").hint("merge"), "group").join(sketches.select("node", "brief"), "node")
    groups = nodes.groupBy("group").agg(F.collect_list(F.struct("size", "node", "component", "brief")).alias("nodes"))
    one = groups.select("nodes", F.explode("nodes").alias("x"))

    def fits(y: F.Column) -> F.Column:
        after = F.struct(y["size"], y["node"]) > F.struct("x.size", "x.node")
        near = F.col("x.size") * 100 >= y["size"] * threshold
        # Briefs of two lengths aren't compared here.
        bits = F.zip_with(y["brief"], "x.brief", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        differ = F.coalesce(F.aggregate(bits, F.lit(0), lambda n, b: n + b), F.lit(0))
        close = (100 + threshold) * differ <= (100 - threshold) * (y["size"] + F.col("x.size"))
        return after & (y["component"] != F.col("x.component")) & near & close

    pairs = one.select(F.col("x.node").alias("p"), F.explode(F.filter("nodes", fits)).alias("y")).select("p", "y.node")
    return pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()


def gathered(members: DataFrame) -> DataFrame:
    """(group, node, component, size), stored: groups of several components, those of about the same nodes as one.

    Each node is at home in its largest group. A group goes to the home of at least half of its nodes,
    and all that go to one home become one group, unless that makes more pairs than they have on their own.
    """
    counts = members.groupBy("group").agg(F.count("*").alias("n"), (F.min("component") < F.max("component")).alias("mixed"))
    counts = counts.where("mixed").select("group", "n")
    rows = stash(members.select("group", "node", "component", "size").join(counts.hint("merge"), "group"), "mixed")
    homes = rows.groupBy("node").agg(F.max_by("group", F.struct("n", "group")).alias("home"))
    shared = rows.join(homes.hint("merge"), "node").groupBy("group", "n", "home").agg(F.count("*").alias("k"))
    best = shared.groupBy("group", "n").agg(F.max_by("home", F.struct("k", "home")).alias("home"), F.max("k").alias("k"))
    target = F.when(2 * F.col("k") >= F.col("n"), F.col("home")).otherwise(F.col("group"))
    targets = stash(best.select("group", "n", target.alias("target")), "targets")
    pairs = targets.groupBy("target").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    united = rows.join(targets.select("group", "target").hint("merge"), "group").select("target", "node").distinct()
    united = united.groupBy("target").agg(F.count("*").alias("all")).join(pairs.hint("merge"), "target")
    united = targets.join(united.hint("merge"), "target").select("group", F.when(F.col("all") * F.col("all") <= F.col("pairs"), F.col("target")).alias("into"))
    moved = rows.join(united.hint("merge"), "group").withColumn("group", F.coalesce("into", "group"))
    return stash(moved.select("group", "node", "component", "size").distinct(), "gathered")


def dealt(members: DataFrame, ready: bool = False) -> DataFrame:
    """(group, i, j, role, asks, node, component, size): the members of large groups of several components, dealt into blocks.

    Of two nodes that differ in component, one at least is outside of the component that has most of the group. Only these ask:
    block i of asking nodes meets block j of all members. Groups that are gathered already (`ready`) stay as they are.
    """
    members = members if ready else gathered(members)
    counts = members.groupBy("group", "component").agg(F.count("*").alias("n"))
    main = F.max_by("component", F.struct("n", "component")).alias("main")
    groups = counts.groupBy("group").agg(main, F.sum("n").alias("members"), (F.sum("n") - F.max("n")).alias("asking"))
    nodes = members.join(groups.where("asking > 0").hint("merge"), "group").withColumn("asks", F.col("component") != F.col("main"))

    def places(role: int, mine: str, other: str) -> F.Column:
        block = F.pmod(F.xxhash64("node"), F.ceil(F.col(mine) / BLOCK_NODES)).cast("int")
        others = F.sequence(F.lit(0), F.ceil(F.col(other) / BLOCK_NODES).cast("int") - 1)
        pair = (lambda k: (block, k)) if role == ASKING else (lambda k: (k, block))
        return F.transform(others, lambda k: F.struct(F.lit(role).alias("role"), *(x.alias(n) for x, n in zip(pair(k), "ij", strict=True))))

    asked = places(MEMBER, "members", "asking")
    every = F.when(F.col("asks"), F.concat(asked, places(ASKING, "asking", "members"))).otherwise(asked)
    nodes = nodes.withColumn("place", F.explode(every))
    return nodes.select("group", "place.i", "place.j", "place.role", "asks", "node", "component", "size")


def blocks(members: DataFrame, sketches: DataFrame, threshold: int, which: str) -> DataFrame:
    """Pairs (a, b) of nodes of one gathered group that differ in component and may link (see `_across`), compared block by block."""
    nodes = dealt(members, ready=True).join(sketches.select("node", "sketch"), "node")
    pairs = nodes.groupBy("group", "i", "j").applyInArrow(_across(threshold, which), "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def join_similar(
    df: DataFrame,
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, node) of every row; linked are rows that share a component."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("text_key", text_key())
    sets = sets_table(docs, shingle, threshold)
    prefixes = stash(shared_tokens(sets.select(F.explode("prefix").alias("token"), "node")), "prefixes")
    members = prefixes.select("node", "frequent").union(sets.where("crowded").select("node", F.lit(True)))
    texts = sets.where(F.col("text").isNotNull()).select("node", "text")
    sketches = sketches_of(sets, members.select("node"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, token = shingle_sets(raw(batch.column("text").to_pylist()), shingle)
            node, size = nodes_of(row, token, batch.num_rows)
            row, key = combinations(row, token, size, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node[row])], ["entry", "node"])

    frequent = among(texts, members.where("frequent").select("node"))
    combined = frequent.select("text").mapInArrow(combine, "entry long, node long")
    rare = prefixes.where("not frequent").select(F.col("token").alias("entry"), "node")
    members = stash(groups_of(rare.union(combined)), "groups")

    met = members.where("node != leader").groupBy("node", "leader").agg(F.sum("entries").alias("n"))
    stars = met.groupBy("node").agg(F.max_by("leader", F.struct("n", "leader")).alias("leader"))
    stars = possible(stars.select(F.col("leader").alias("a"), F.col("node").alias("b")), sketches, threshold)
    known = components(verify(stars, texts, shingle, threshold))
    members = members.join(sketches.select("node", "size"), "node").select("group", "members", "node", "size")
    large = gathered(labelled(members.where(F.col("members") > SMALL), known)).drop("component")
    for which in (NEAREST, BETWEEN):
        pairs = stash(blocks(labelled(large, known), sketches, threshold, which), which)
        known = components(_as_links(known).union(verify(pairs, texts, shingle, threshold)))
    small = stash(labelled(members.where(F.col("members") <= SMALL), known), "labelled")
    few = possible(listed(small, sketches, threshold), sketches, threshold)
    rest = blocks(labelled(large, known), sketches, threshold, ALL)
    pairs = stash(few.union(rest).distinct(), "across")
    final = components(_as_links(known).union(verify(pairs, texts, shingle, threshold)))

    labelled_docs = sets.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled_docs.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    joined = labelled_docs.join(least, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), "node", "component")


def keep_first(df: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of `df` but one of each component, that of the least id that isn't null.

    Rows without words all stay, repeated or not, also those with null ids. Of rows with equal id and text one stays, whichever their
    other columns are. The columns are those of `df`, whatever their names; an empty table gives an empty result.
    """
    # The stored texts and sets go before the rows are filtered.
    every = settle(df.sparkSession, lambda: join_similar(df, shingle, threshold), "joined")
    rows = every.where("n_shingles > 0")
    # The first row of each component, without bringing a component's rows together.
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"))
    dropped = rows.join(first, "component").where(
        ~(F.col("doc_id").eqNullSafe(F.col("row.doc_id")) & (F.col("text_key") == F.col("row.text_key")))
    )
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = df["doc_id"].eqNullSafe(dropped["_id"]) & (text_key("text") == dropped["_key"])
    kept = df.join(dropped, same, "left_anti")
    repeated = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    repeated = repeated.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    if repeated.isEmpty():
        return kept
    again = kept["doc_id"].eqNullSafe(repeated["_id"]) & (text_key("text") == repeated["_key"])
    once = kept.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, again, "left_anti").union(once)
