"""Byte-pair encoding and decoding of whole texts by batched numpy merge rounds.

Texts are cut at special strings and then into words as the vocabulary's pattern does, by the class of each code point.
The symbols of all words that a worker meets for the first time lie in one flat array. In a round every word merges its
lowest-ranked pair, at all its places from the left; ranks are found by binary search over sorted pair keys, and
only pairs next to a merge are searched again. Words leave the array when no pair is left, so the rounds
number as many as the merges of the longest word. Words beyond LONG_WORD bytes are merged
rank by rank instead, with linked symbols: that touches a symbol only when it changes.
Ids of words are kept by a 64-bit hash of their bytes in a cache of bounded size for each worker.

Ids equal the library's encode(text, add_special_tokens=False) without truncation and padding, and texts its
decode(ids, skip_special_tokens=False). Works for byte-level vocabularies without normalizer.

Defined results: a null text counts as empty and has no ids; null ids give an empty text, ids outside the
vocabulary give nothing; rows are independent, so repeated rows and null or repeated doc_ids change nothing;
an empty table gives an empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import Prefix
from llm.tokens import PRINTABLE, tokenizer_path

LONG_WORD = 256
CACHE_WORDS = 500_000
CACHE_IDS = 4_000_000
SLICE_CHARS = 1 << 18
NO_RANK = np.int64(1) << 62
LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)

_gap = regex.compile(r"(?<=\S)(?=\s)")


def slices(text: str) -> Iterator[str]:
    """A text in parts of about SLICE_CHARS, cut where white space begins: no word crosses such a place."""
    at = 0
    while len(text) - at > SLICE_CHARS:
        found = _gap.search(text, at + SLICE_CHARS)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def character_classes(library) -> np.ndarray:
    """Class of every code point. Those younger than Python's own tables are classed as the library's pre-tokenizer does."""
    classes = np.full(0x110000, OTHER, dtype=np.int8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            a, b = (x + 0x800 * (x >= 0xD800) for x in found.span())
            classes[a:b] = kind
    for k in np.flatnonzero(classes != OTHER).tolist():
        if unicodedata.category(chr(k)) == "Cn":
            alike = [c for c, before in ((LETTER, "a"), (NUMBER, "1"), (SPACE, "\t\t")) if len(library.pre_tokenize_str(before + chr(k))) == 1]
            classes[k] = alike[0] if alike else OTHER
    return classes


def alternate(linked: np.ndarray) -> np.ndarray:
    """Which of a row of places to take, when linked[k] says that place k + 1 overlaps place k: every other one of each run."""
    if not linked.any():
        return np.ones(len(linked) + 1, dtype=bool)
    place = np.arange(len(linked) + 1)
    begins = np.append(True, ~linked)
    return (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[k] .. start[k] + size[k] - 1 of every k in turn."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class MergeTable:
    """Pairs of a vocabulary as sorted keys, with rank and merged symbol of each."""

    def __init__(self, name: str):
        with open(tokenizer_path(name), encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if content["normalizer"] is not None or content["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{name} is no byte-level vocabulary")
        if content["pre_tokenizer"]["add_prefix_space"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError(f"{name} has options that merge rounds don't follow")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in content["added_tokens"]):
            raise ValueError(f"{name} has special tokens that take neighbours with them")
        vocabulary = model["vocab"]
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.size = max([*vocabulary.values(), *self.added.values()]) + 1
        self.first = np.array([vocabulary[PRINTABLE[b]] for b in range(256)], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        keys = left * self.size + right
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        byte_of = {c: b for b, c in PRINTABLE.items()}
        self.token_bytes = [b""] * self.size
        for token, k in [*vocabulary.items(), *self.added.items()]:
            known = all(c in byte_of for c in token)
            self.token_bytes[k] = bytes(byte_of[c] for c in token) if known else token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK for pairs that never merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)


def merge_rounds(table: MergeTable, words: list[bytes]) -> list[list[int]]:
    """Ids of each word; no word is empty."""
    out: list[list[int]] = [[] for _ in words]
    symbol = table.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    rank = np.full(len(symbol), NO_RANK)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    rank[inner] = table.ranks(symbol[inner], symbol[inner + 1])
    while len(symbol):
        begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(begins, len(symbol)))
        lowest = np.minimum.reduceat(rank, begins)
        done = lowest == NO_RANK
        if done.any():
            for word, b, n in zip(owner[begins[done]].tolist(), begins[done].tolist(), sizes[done].tolist(), strict=True):
                out[word] = symbol[b : b + n].tolist()
            stay = np.repeat(~done, sizes)
            symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(symbol):
                break
        place = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # Places one apart overlap; within a word they hold one pair of equal symbols.
        place = place[alternate((np.diff(place) == 1) & (owner[place[1:]] == owner[place[:-1]]))]
        symbol[place] = table.merged[rank[place]]
        stay = np.ones(len(symbol), dtype=bool)
        stay[place + 1] = False
        moved = np.cumsum(stay) - 1
        symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
        changed = moved[place]
        changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
        rank[changed] = NO_RANK
        pair = changed[changed < len(symbol) - 1]
        pair = pair[owner[pair] == owner[pair + 1]]
        rank[pair] = table.ranks(symbol[pair], symbol[pair + 1])
    return out


def merge_by_rank(table: MergeTable, word: bytes) -> list[int]:
    """Ids of one long word: ranks in turn, each at all its places at once."""
    symbol = table.first[np.frombuffer(word, dtype=np.uint8)]
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, NO_RANK)
    rank[:-1] = table.ranks(symbol[:-1], symbol[1:])
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def wait(place: np.ndarray) -> None:
        place = place[rank[place] != NO_RANK]
        place = place[np.argsort(rank[place], kind="stable")]
        for part in np.split(place, np.flatnonzero(np.diff(rank[place])) + 1):
            if len(part):
                r = int(rank[part[0]])
                if r not in waiting:
                    heapq.heappush(queue, r)
                waiting.setdefault(r, []).append(part)

    wait(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        place = np.unique(np.concatenate(waiting.pop(r)))
        place = place[rank[place] == r]
        if not len(place):
            continue
        left = place[alternate(after[place[:-1]] == place[1:])]
        right = after[left]
        symbol[left] = table.merged[r]
        rank[right] = NO_RANK
        after[left] = after[right]
        inside = left[after[left] < n]
        before[after[inside]] = inside
        changed = np.unique(np.concatenate([left, before[left][before[left] >= 0]]))
        rank[changed] = NO_RANK
        changed = changed[after[changed] < n]
        rank[changed] = table.ranks(symbol[changed], symbol[after[changed]])
        wait(changed)
    place, kept = 0, []
    while place < n:
        kept.append(place)
        place = int(after[place])
    return symbol[kept].tolist()


class WordCache:
    """Ids of words by hash: sorted keys, and places in a pool of ids."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, whether it is there)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def add(self, keys: np.ndarray, found: list[list[int]]) -> None:
        size = np.array([len(f) for f in found], dtype=np.int64)
        start = len(self.pool) + np.cumsum(size) - size
        self.pool = np.append(self.pool, np.fromiter(chain.from_iterable(found), dtype=np.int32))
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.keys = np.concatenate([self.keys, keys])[order]
        self.start, self.size = np.concatenate([self.start, start])[order], np.concatenate([self.size, size])[order]


class MergeEncoder:
    """`special`: whether special strings in a text become their ids, as is the library's default."""

    def __init__(self, name: str, special: bool = True):
        self.table = MergeTable(name)
        added = sorted(self.table.added, key=len, reverse=True) if special else []
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")").split if added else None
        self.special = {x.encode(): [k] for x, k in self.table.added.items()} if special else {}
        self.classes = character_classes(Tokenizer.from_file(tokenizer_path(name)).pre_tokenizer)
        self.cache = WordCache()

    def cut(self, parts: list[str], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, part, start and end of each word). Parts marked whole are one word each."""
        text = "\n".join(parts)
        code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        begins = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
        kind = self.classes[code]
        kind[begins[1:] - 1] = EDGE
        fresh = np.append(True, kind[1:] != kind[:-1])
        fresh[begins[1:] - 1] = True
        fresh[begins[begins < len(code)]] = True
        # The last of several spaces before a word stands alone, or is part of the word if it is U+0020.
        last = np.flatnonzero(fresh[1:] & (kind[:-1] == SPACE) & (kind[1:] != EDGE))
        fresh[last] = True
        fresh[last[code[last] == 32] + 1] = False
        # 's, 't, 'm, 'd, 're, 've, 'll where an apostrophe begins a word and a letter follows.
        mark = np.flatnonzero((code == 39) & fresh)
        mark = mark[mark + 1 < len(code)]
        mark = mark[kind[mark + 1] == LETTER]
        one, two = code[mark + 1], code[np.minimum(mark + 2, len(code) - 1)]
        short = (one == 115) | (one == 116) | (one == 109) | (one == 100)
        double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        mark, length = mark[short | double], np.where(short, 2, 3)[short | double]
        fresh[mark + 1] = False
        rest = mark + length
        fresh[rest[rest < len(code)]] = True
        for k in np.flatnonzero(whole).tolist():
            fresh[begins[k] + 1 : begins[k] + len(parts[k])] = False
        start = np.flatnonzero(fresh)
        end = np.append(start[1:], len(code))
        wanted = kind[start] != EDGE
        start, end = start[wanted], end[wanted]
        part = np.searchsorted(begins, start, side="right") - 1
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        if len(data) != len(code):
            offset = np.cumsum(np.append(0, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)))
            start, end = offset[start], offset[end]
        return data, part, start, end

    def learn(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words that aren't in the cache."""
        out: list[list[int] | None] = [self.special.get(w) or (merge_by_rank(self.table, w) if len(w) > LONG_WORD else None) for w in words]
        rest = [k for k, ids in enumerate(out) if ids is None]
        if rest:
            for k, ids in zip(rest, merge_rounds(self.table, [words[k] for k in rest]), strict=True):
                out[k] = ids
        return out

    def encode_parts(self, parts: list[str], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts in turn, number of ids of each part)."""
        data, part, start, end = self.cut(parts, whole)
        if not len(part):
            return np.zeros(0, np.int32), np.zeros(len(parts), np.int64)
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
        return ids, np.bincount(part, size, len(parts)).astype(np.int64)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        rows: list[int] = []
        parts: list[str] = []
        whole: list[bool] = []

        def flush() -> None:
            ids, sizes = self.encode_parts(parts, np.array(whole))
            for row, some in zip(rows, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                out[row].append(some)
            for x in (rows, parts, whole):
                x.clear()

        size = 0
        for row, text in enumerate(texts):
            for k, piece in enumerate(self.split(text) if self.split else [text]):
                for part in [piece] if k % 2 else slices(piece):
                    rows.append(row)
                    parts.append(part)
                    whole.append(k % 2 == 1)
                    size += len(part) + 1
                    if size > SLICE_CHARS:
                        flush()
                        size = 0
        if parts:
            flush()
        none = np.zeros(0, dtype=np.int32)
        return [x[0] if len(x) == 1 else np.concatenate([none, *x]) for x in out]

    def join(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.table.size):
            ids = ids[(ids >= 0) & (ids < self.table.size)]
        return b"".join(map(self.table.token_bytes.__getitem__, ids.tolist()))


_encoders: dict[tuple[str, bool], MergeEncoder] = {}


def merge_encoder(name: str, special: bool = True) -> MergeEncoder:
    """The worker's own encoder: kept between batches and tasks."""
    if (name, special) not in _encoders:
        _encoders[name, special] = MergeEncoder(name, special)
    return _encoders[name, special]


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def encode_texts(df: DataFrame, vocabulary: str, special: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merge_encoder(vocabulary, special)
        for batch in batches:
            ids = encoder.encode_many([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_array(ids, pa.int32())], ["doc_id", "ids"])

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of each row; bytes that are no UTF-8 come out as U+FFFD."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merge_encoder(vocabulary)
        for batch in batches:
            lists = batch.column("ids")
            texts = []
            for k in range(batch.num_rows):
                values = lists[k].values
                found = np.zeros(0, np.int64) if values is None else values.drop_null().to_numpy()
                texts.append(encoder.join(found).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(decode, "doc_id long, ids array<int>, text string")


def digest(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows (doc_id, ids, text)."""
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
