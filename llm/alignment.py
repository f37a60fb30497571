"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

A has a row for each token of the first tokenizer and a column for each byte of a text, B the same for the second. The
product of A with B transposed, built row by row (Gustavson), holds the number of bytes that each token pair shares: its
entries are the overlap links. Places where tokens of both end cut a text into groups; the product of the two
token-group incidence matrices holds the links of tokens that share a group. Groups bound both products, so matrices
are built for runs of groups of about SLICE_BYTES, however long a text is.

How many documents hold a pair of ids linked is counted over the whole table. Counts of frequent pairs, at
most TABLE_PAIRS, are broadcast as sorted arrays; the highest count of each first id is bounded by the vocabulary. Links of
rarer pairs are few, and no pair among them is hot: they are joined to their counts and summed up for each row.

The first vocabulary is byte-level and encodes a space and the text, the second is a sentencepiece model that
adds the space itself. Special strings in texts are ordinary text. The second is encoded word by word
through a cache, which is exact when no piece has a space behind another character; other models are refused.

Defined results: null and empty texts, and those whose tokens don't spell the space and the text, have no tokens and
zeros in every number; repeated rows count as documents each; null doc_ids stay; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bpe import CACHE_IDS, CACHE_WORDS, WordCache, list_array, merge_encoder, ragged
from llm.common import Prefix, stash
from llm.tokens import tokenizer_path

SLICE_BYTES = 1 << 18
TABLE_PAIRS = 1_000_000
UNSPELLED = -1
SPACE = "▁"

_word_gap = regex.compile(b"[^ ](?= )")


@dataclass
class Csr:
    """A sparse matrix of whole numbers; entries of a row lie together."""

    begin: np.ndarray  # of each row, and the end of the last
    column: np.ndarray
    value: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.begin) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.begin))


def spans(size: np.ndarray) -> Csr:
    """Incidence of consecutive spans with the places they cover, one span a row."""
    begin = np.append(0, np.cumsum(size))
    n = int(begin[-1])
    return Csr(begin, np.arange(n), np.ones(n, np.int32), n)


def covers(size: np.ndarray) -> Csr:
    """The transpose of spans(size): each place lies in one span."""
    n = int(size.sum())
    return Csr(np.arange(n + 1), np.repeat(np.arange(len(size)), size), np.ones(n, np.int32), len(size))


def product_size(left: Csr, right: Csr) -> np.ndarray:
    """Entries that each row of the product gathers, before equal columns are added up."""
    gathered = np.append(0, np.cumsum(np.diff(right.begin)[left.column]))
    return gathered[left.begin[1:]] - gathered[left.begin[:-1]]


def product(left: Csr, right: Csr) -> Csr:
    """left x right: row by row, the rows of `right` that a row of `left` names, scaled and added up."""
    size = np.diff(right.begin)[left.column]
    taken = ragged(right.begin[left.column], size)
    row = np.repeat(left.row_of_entries(), size)
    key = row * max(right.columns, 1) + right.column[taken]
    value = np.repeat(left.value, size) * right.value[taken]
    if len(key) and np.any(key[1:] < key[:-1]):
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    value = np.add.reduceat(value, first) if len(first) else value
    row, column = np.divmod(key[first], max(right.columns, 1))
    return Csr(np.append(0, np.cumsum(np.bincount(row, minlength=left.rows))), column, value, right.columns)


class WordPieces:
    """A sentencepiece model, word by word through a cache."""

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        pieces = [self.model.id_to_piece(k) for k in range(self.model.vocab_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError(f"{name} has pieces across words")
        self.size = len(pieces)
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)
        ]
        self.space = [self.model.piece_to_id(SPACE)]
        self.cache = WordCache()

    def learn(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words, which begin with a space; UNSPELLED for words that their pieces don't spell."""
        found = self.model.encode([w[1:].decode() for w in words], num_threads=1)
        found = [self.space if w == b" " else ids for w, ids in zip(words, found, strict=True)]
        spelled = (b"".join(map(self.token_bytes.__getitem__, ids)) == w for w, ids in zip(words, found, strict=True))
        return [ids if same else [UNSPELLED] for ids, same in zip(found, spelled, strict=True)]

    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts in turn, number of ids of each part); parts begin with a space."""
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        fresh = data == 32
        fresh[1:] &= data[:-1] != 32
        fresh[ends[:-1]] = True
        start = np.flatnonzero(fresh)
        end = np.append(start[1:], len(data))
        keys, first, back = np.unique(Prefix(data).of(start, end), return_index=True, return_inverse=True)
        at, there = self.cache.find(keys)
        if not there.all():
            buffer, new = data.tobytes(), np.flatnonzero(~there)
            found = self.learn([buffer[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            self.cache.add(keys[new], found)
            at, _ = self.cache.find(keys)
        size = self.cache.size[at][back]
        ids = self.cache.pool[ragged(self.cache.start[at][back], size)]
        if len(self.cache.keys) > CACHE_WORDS or len(self.cache.pool) > CACHE_IDS:
            self.cache = WordCache()
        part = np.searchsorted(ends, start, side="right")
        return ids, np.bincount(part, size, len(parts)).astype(np.int64)

    def encode_many(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text; a text is empty or begins with a space, which stands for the one that the model adds."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        rows: list[int] = []
        parts: list[bytes] = []
        size = 0
        for row, text in enumerate(texts):
            at = 0
            while at < len(text):
                found = _word_gap.search(text, at + SLICE_BYTES)
                stop = found.start() + 1 if found else len(text)
                rows.append(row)
                parts.append(text[at:stop])
                size, at = size + stop - at, stop
                if size > SLICE_BYTES:
                    self._collect(rows, parts, out)
                    size = 0
        if parts:
            self._collect(rows, parts, out)
        none = np.zeros(0, dtype=np.int32)
        return [x[0] if len(x) == 1 else np.concatenate([none, *x]) for x in out]

    def _collect(self, rows: list[int], parts: list[bytes], out: list[list[np.ndarray]]) -> None:
        ids, sizes = self.encode_parts(parts)
        for row, some in zip(rows, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            out[row].append(some)
        rows.clear()
        parts.clear()


class Aligner:
    def __init__(self, first: str, second: str):
        self.a, self.b = merge_encoder(first, special=False), WordPieces(second)
        self.n_a, self.n_b = self.a.table.size, self.b.size
        self.len_a = np.array([len(x) for x in self.a.table.token_bytes], dtype=np.int64)
        self.len_b = np.array([len(x) for x in self.b.token_bytes], dtype=np.int64)
        names = [*map(str, range(self.n_a)), *map(str, range(self.n_b))]
        self.shown = [name + mark for mark in (",", "|", ";", "") for name in names]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by both; none for texts that either doesn't spell."""
        full = [" " + t if t else "" for t in texts]
        a, b = self.a.encode_many(full), self.b.encode_many([t.encode() for t in full])
        none = np.zeros(0, dtype=np.int32)
        for k, ids in enumerate(b):
            # The first vocabulary holds all bytes and merges what stands together, so it spells every text.
            if len(ids) and ids.min() == UNSPELLED:
                a[k], b[k] = none, none
        return a, b

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end of each group in bytes, group of each token of a, of b)."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends_here = np.zeros(int(end_b[-1]) + 1 if len(b) else 1, dtype=np.int8)
        ends_here[end_a] += 1
        ends_here[end_b] += 1
        last_a, last_b = ends_here[end_a] == 2, ends_here[end_b] == 2
        return end_a[last_a], np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b

    def runs(self, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """Groups in runs of about SLICE_BYTES: (first, one past the last)."""
        at, before = 0, 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield at, stop
            at, before = stop, int(ends[stop - 1])

    def matrices(self, a: np.ndarray, b: np.ndarray, groups: tuple) -> Iterator[tuple[int, int, Csr, Csr, np.ndarray, np.ndarray]]:
        """For each run of groups: first token of either, the byte incidences, and the group of each token."""
        ends, group_a, group_b = groups
        for first, stop in self.runs(ends):
            (a0, a1), (b0, b1) = np.searchsorted(group_a, [first, stop]), np.searchsorted(group_b, [first, stop])
            yield a0, b0, spans(self.len_a[a[a0:a1]]), covers(self.len_b[b[b0:b1]]), group_a[a0:a1] - first, group_b[b0:b1] - first

    def links(self, a: np.ndarray, b: np.ndarray, groups: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token of a, token of b, bytes shared) of every pair of overlapping tokens."""
        found = [(np.zeros(0, np.int64),) * 3]
        for a0, b0, left, right, _, _ in self.matrices(a, b, groups or self.groups(a, b)):
            shared = product(left, right)
            found.append((a0 + shared.row_of_entries(), b0 + shared.column, shared.value))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def group_matrices(self, group_a: np.ndarray, group_b: np.ndarray) -> tuple[Csr, Csr]:
        """Token-group incidence of a, and group-token incidence of b."""
        n = int(group_a[-1]) + 1 if len(group_a) else 0
        ones = np.ones(max(len(group_a), len(group_b)), np.int32)
        begin = np.searchsorted(group_b, np.arange(n + 1))
        return Csr(np.arange(len(group_a) + 1), group_a, ones[: len(group_a)], n), Csr(begin, np.arange(len(group_b)), ones[: len(group_b)], len(group_b))

    def group_links(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(token of a, token of b) of pairs that share a group, for each run of groups."""
        for a0, b0, _, _, group_a, group_b in self.matrices(a, b, self.groups(a, b)):
            shared = product(*self.group_matrices(group_a, group_b))
            yield a0 + shared.row_of_entries(), b0 + shared.column

    def align(self, texts: list[str | None]) -> list[list]:
        """Columns n_a, n_b, n_groups, n_links, n_group_links, groups, pairs, times, for each text a value.

        All texts are one row of tokens: a text ends a group, so no link leaves it.
        """
        a_parts, b_parts = self.encode(texts)
        a, b = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (a_parts, b_parts))
        rows = np.arange(len(texts))
        row_a, row_b = (np.repeat(rows, [len(p) for p in x]) for x in (a_parts, b_parts))
        ends, group_a, group_b = groups = self.groups(a, b)
        row_of_group = row_a[np.searchsorted(group_a, np.arange(len(ends)))]
        at_a, at_b, _ = self.links(a, b, groups)
        owner, key = row_a[at_a], a[at_a].astype(np.int64) * self.n_b + b[at_b]
        n_links = np.bincount(owner, minlength=len(texts))
        in_groups = product_size(*self.group_matrices(group_a, group_b))
        order = np.lexsort((key, owner))
        owner, key = owner[order], key[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))) if len(key) else order
        times = np.diff(np.append(first, len(key)))
        cuts = np.searchsorted(owner[first], rows[1:])
        return [
            np.bincount(row_a, minlength=len(texts)),
            np.bincount(row_b, minlength=len(texts)),
            np.bincount(row_of_group, minlength=len(texts)),
            n_links,
            np.bincount(row_a, in_groups, len(texts)).astype(np.int64),
            self.show(a, b, row_of_group, group_a, group_b, len(texts)),
            np.split(key[first], cuts),
            np.split(times.astype(np.int32), cuts),
        ]

    def show(self, a, b, row_of_group, group_a, group_b, n: int) -> list[str]:
        """Each text's groups as a1,a2|b1;a3|b2,b3."""
        if not len(a):
            return [""] * n
        side = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        row = row_of_group[side >> 1]
        mark = np.full(len(side), 3)
        step = np.diff(side)
        mark[:-1] = np.where(row[1:] != row[:-1], 3, np.where(step == 0, 0, np.where(side[:-1] & 1, 2, 1)))
        token = np.concatenate([a, b + self.n_a])[order] + mark * (self.n_a + self.n_b)
        cuts = np.append(0, np.searchsorted(row, np.arange(1, n + 1)))
        return ["".join(map(self.shown.__getitem__, token[s:e].tolist())) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


def align_texts(df: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_group_links, groups, pairs, times) of each row.

    `pairs` are the distinct linked pairs of ids, as first id x size of the second vocabulary + second id, in order;
    `times` says how often each is linked.
    """
    schema = "doc_id long, " + "".join(f"{c} long, " for c in NUMBERS) + "groups string, pairs array<long>, times array<int>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(first, second)
        for batch in batches:
            *numbers, groups, pairs, times = both.align(batch.column("text").to_pylist())
            columns = [pa.array(x, pa.int64()) for x in numbers]
            lists = [list_array(pairs, pa.int64()), list_array(times, pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(groups, pa.string()), *lists],
                ["doc_id", *NUMBERS, "groups", "pairs", "times"],
            )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many rows hold each pair linked."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(pairs in order, their counts, whether these are all) of at most `most` pairs with the highest counts."""
    classes = counts.groupBy((F.length(F.bin("n")) - 1).alias("k")).count().orderBy(F.desc("k")).collect()  # 63 rows at most
    taken = np.cumsum([r["count"] for r in classes])
    kept = int(np.searchsorted(taken, most, side="right"))
    least = 2 ** classes[kept - 1]["k"] if kept else None
    table = counts.where(F.col("n") >= least if kept else F.lit(False)).toArrow()
    pair = table["pair"].to_numpy()
    order = np.argsort(pair)
    return pair[order], table["n"].to_numpy()[order], kept == len(classes)


def score_links(aligned: DataFrame, second_size: int, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Add n_best and count_sum to stored rows of align_texts, which have a unique column `row`.

    n_best counts links whose pair has the highest count of its first id, count_sum adds up the counts of all links.
    """
    spark = aligned.sparkSession
    counts = stash(pair_counts(aligned), "pair-counts")
    best = counts.groupBy(F.floor(F.col("pair") / F.lit(second_size)).cast("int").alias("a")).agg(F.max("n").alias("best"))
    best = stash(best, "best-counts")  # at most a row for each id of the first vocabulary
    found = best.toArrow()
    highest = np.zeros(max(found["a"].to_pylist(), default=0) + 1, dtype=np.int64)
    highest[found["a"].to_numpy()] = found["best"].to_numpy()
    pair, n, complete = frequent_pairs(counts, table_pairs)
    shared = spark.sparkContext.broadcast((pair, n, highest))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    types = dict(aligned.dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, highest = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            key, many = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(pairs.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
            hit = pair[at] == key if len(pair) else np.zeros(len(key), bool)
            count = np.where(hit, n[at], 0) if len(pair) else np.zeros(len(key), np.int64)
            top = np.where(hit & (count == highest[key // second_size]), many, 0)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            tops, sums = (np.diff(np.append(0, np.cumsum(x))[ends]) for x in (top, count * many))
            cuts = np.searchsorted(row[~hit], np.arange(1, batch.num_rows))
            rest = [list_array(np.split(x[~hit], cuts), kind) for x, kind in ((key, pa.int64()), (many.astype(np.int32), pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(tops), pa.array(sums), *rest], [*kept, "n_best", "count_sum", "pairs", "times"]
            )

    schema = "".join(f"`{c}` {types[c]}, " for c in kept) + "n_best long, count_sum long, pairs array<long>, times array<int>"
    scored = aligned.mapInArrow(score, schema)
    if complete:
        return scored.drop("pairs", "times")
    scored = stash(scored, "scored-links")
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rare = rare.withColumnRenamed("pairs", "pair").join(counts, "pair")
    rare = rare.withColumn("a", F.floor(F.col("pair") / F.lit(second_size)).cast("int")).join(F.broadcast(best), "a")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    added = [(F.col(c) + F.coalesce(m, F.lit(0))).cast("long").alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return scored.drop("pairs", "times").join(more, "row", "left").select(*kept, *added)


def align_and_score(df: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256) of each row."""
    aligned = align_texts(df, first, second, doc_id, text)
    shown = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    stored = aligned.select(F.monotonically_increasing_id().alias("row"), "doc_id", *NUMBERS, shown, "pairs", "times")
    stored = stash(stored, "aligned")
    return score_links(stored, WordPieces(second).size, table_pairs).drop("row")
