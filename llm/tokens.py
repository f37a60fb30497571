"""Token ids of whole texts, pre-token by pre-token through a cache kept by each worker.

A byte-pair encoder works inside pre-tokens, so the ids of a text are those of its
pre-tokens in turn. All texts are cut into pre-tokens with numpy: those of ASCII and letters of two bytes
by the classes of their bytes, others by the classes of their code points, after they were split at
special strings and, where the vocabulary has a normalizer, normalized by the library. A pre-token is looked up
by a 64-bit hash in a table of fixed size with two places for each, where a newer entry replaces an older one; those
of more than INLINE_IDS ids in a dictionary of bounded size. Only pre-tokens that aren't there go to the library, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from llm.common import LOWER, Prefix, segments

CACHE_BITS = 21
INLINE_IDS = 6
LONG_PIECES, LONG_IDS = 50_000, 64

WIDE_CHARS = 1 << 18
# Letters of two UTF-8 bytes, and ASCII but for control characters: what is cut by bytes.
NOT_SIMPLE = regex.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ɏ]")
SIMPLE_ASCII = bytes([9, 10, 13, *range(32, 127)])
LETTER, DIGIT, OTHER, SPACE, EDGE = range(5)


def _byte_classes() -> np.ndarray:
    classes = np.full(256, OTHER, dtype=np.int8)
    classes[128:] = LETTER
    classes[65:91] = classes[97:123] = LETTER
    classes[48:58] = DIGIT
    classes[[9, 10, 13, 32]] = SPACE
    return classes


def _printable_bytes() -> dict[int, str]:
    """The printable character that stands for each byte inside byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


CLASSES, PRINTABLE = _byte_classes(), _printable_bytes()


@cache
def wide_classes() -> np.ndarray:
    """Class of every code point."""
    from llm.bpe import character_classes  # imports this module

    return character_classes(ByteLevel(add_prefix_space=False))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is; names with a slash are paths already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Pieces:
    """Pre-tokens of several texts: which row, where in `data`, and a hash of the bytes."""

    data: np.ndarray
    rows: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


class CachedEncoder:
    def __init__(self, name: str):
        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.by_words = self.library.normalizer is not None
        added = {t.content: k for k, t in self.library.get_added_tokens_decoder().items()}
        self.special = {t.encode(): [k] for t, k in added.items()}
        self.names = sorted(added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.names)) + ")").split if added else lambda text: [text]
        self.long: dict[int, list[int]] = {}
        self.keys = np.zeros(1 << CACHE_BITS, dtype=np.uint64)
        self.lengths = np.zeros(1 << CACHE_BITS, dtype=np.uint8)
        self.ids = np.zeros((1 << CACHE_BITS, INLINE_IDS), dtype=np.uint16 if self.vocabulary_size() <= 1 << 16 else np.uint32)

    def vocabulary_size(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def one(self, piece: bytes) -> list[int]:
        """ids of one pre-token or special string."""
        if piece in self.special:
            return self.special[piece]
        return [t.id for t in self.library.model.tokenize(piece.decode("latin-1").translate(PRINTABLE))]

    def remembered(self, key: int, piece: bytes) -> list[int]:
        """ids of a pre-token that the table lacks."""
        ids = self.long.get(key)
        if ids is None:
            ids = self.one(piece)
            if INLINE_IDS < len(ids) <= LONG_IDS:
                if len(self.long) >= LONG_PIECES:
                    self.long.clear()
                self.long[key] = ids
        return ids

    def cut(self, code: np.ndarray, classes: np.ndarray, begins: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each pre-token of parts that begin at `begins`, one character apart; those in `whole` are one each."""
        edge = begins[1:] - 1
        classes[edge] = EDGE
        change = np.empty(len(code), dtype=bool)
        change[:1] = True
        np.not_equal(classes[1:], classes[:-1], out=change[1:])
        change[edge] = True
        if self.by_words:
            change |= classes == DIGIT
        else:
            ends = np.flatnonzero(change[1:] & (classes[:-1] == SPACE) & (classes[1:] != EDGE))
            change[ends] = True
            change[ends[code[ends] == 32] + 1] = False
        # 's, 't, 'm, 'd, 're, 've, 'll where an apostrophe begins a pre-token.
        mark = np.flatnonzero((code[:-1] == 39) & change[:-1])
        if len(mark):
            one, two = code[mark + 1], code[np.minimum(mark + 2, len(code) - 1)]
            short = (one == 115) | (one == 116) | (one == 109) | (one == 100)
            long = (((one == 114) | (one == 118)) & (two == 101)) | ((one == 108) & (two == 108))
            long &= mark + 2 < len(code)
            mark, rest = mark[short | long], (mark + np.where(short, 2, 3))[short | long]
            change[mark + 1] = False
            change[rest[rest < len(code)]] = True
        for k in np.flatnonzero(whole).tolist():
            change[begins[k] + 1 : begins[k + 1] - 1 if k + 1 < len(begins) else len(code)] = False
        start = np.flatnonzero(change)
        end = np.append(start[1:], len(code))
        kept = classes[start] != EDGE
        if self.by_words:
            kept &= classes[start] != SPACE
        return start[kept], end[kept]

    def narrow_pieces(self, texts: list[bytes]) -> Iterator[Pieces]:
        for data, rows, begins in segments(texts):
            if self.by_words:
                data = LOWER[data]
            start, end = self.cut(data, CLASSES[data], begins, np.zeros(len(begins), dtype=bool))
            owner = rows[np.searchsorted(begins, start, side="right") - 1]
            yield Pieces(data, owner, start, end, Prefix(data).of(start, end))

    def wide_parts(self, rows: list[int], texts: list[str]) -> Iterator[tuple[int, str, bool]]:
        """(row, part, whether it is a special string), each part ready to be cut."""
        from llm.bpe import slices  # imports this module

        for row, text in zip(rows, texts, strict=True):
            for k, between in enumerate(self.split(text)):
                if k % 2:
                    yield row, between, True
                    continue
                for part in slices(between):
                    part = self.library.normalizer.normalize_str(part) if self.by_words else part
                    if part:
                        yield row, part, False

    def wide_pieces(self, rows: list[int], texts: list[str]) -> Iterator[Pieces]:
        held: list[tuple[int, str, bool]] = []
        size = 0

        def run() -> Pieces:
            text = "\n".join(part for _, part, _ in held)
            code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            begins = np.cumsum([0, *[len(part) + 1 for _, part, _ in held[:-1]]])
            start, end = self.cut(code, wide_classes()[code], begins, np.array([whole for _, _, whole in held]))
            owner = np.array([row for row, _, _ in held], dtype=np.int64)[np.searchsorted(begins, start, side="right") - 1]
            offset = np.cumsum(np.append(0, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)))
            data, start, end = np.frombuffer(text.encode(), dtype=np.uint8), offset[start], offset[end]
            return Pieces(data, owner, start, end, Prefix(data).of(start, end))

        for part in self.wide_parts(rows, texts):
            held.append(part)
            size += len(part[1]) + 1
            if size >= WIDE_CHARS:
                yield run()
                held, size = [], 0
        if held:
            yield run()

    def pieces(self, texts: list[str]) -> Iterator[Pieces]:
        """Pre-tokens of all texts; those of one text come in turn."""
        narrow: list[bytes] = []
        wide: list[int] = []
        for row, text in enumerate(texts):
            if text.isascii():
                plain = not text.encode().translate(None, SIMPLE_ASCII)
            else:
                plain = NOT_SIMPLE.search(text) is None
            if plain and not any(name in text for name in self.names):
                narrow.append((text.lower() if self.by_words and not text.isascii() else text).encode())
            else:
                narrow.append(b"")
                wide.append(row)
        yield from self.narrow_pieces(narrow)
        yield from self.wide_pieces(wide, [texts[row] for row in wide])

    def lookup(self, p: Pieces) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Slot of each piece after filling the table; ids of those that have no slot."""
        slot = (p.hash >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        loose: dict[int, list[int]] = {}
        missed = np.flatnonzero(self.keys[slot] != p.hash)
        second = (p.hash[missed] & np.uint64((1 << CACHE_BITS) - 1)).astype(np.int64)
        moved = (self.keys[second] == p.hash[missed]) | (self.keys[slot[missed]] != 0)
        slot[missed[moved]] = second[moved]
        missed = missed[self.keys[slot[missed]] != p.hash[missed]]
        if len(missed):
            _, first, back = np.unique(p.hash[missed], return_index=True, return_inverse=True)
            buffer = p.data.tobytes()
            found = [self.remembered(int(p.hash[k]), buffer[p.start[k] : p.end[k]]) for k in missed[first]]
            lengths = np.array([len(f) for f in found])
            taken = slot[missed[first]]
            fits = np.flatnonzero(lengths <= INLINE_IDS)
            # One entry a slot: the last of this round; what loses its slot within the round stays loose.
            self.keys[taken[fits]] = p.hash[missed[first[fits]]]
            for k in fits[self.keys[taken[fits]] == p.hash[missed[first[fits]]]]:
                self.lengths[taken[k]] = lengths[k]
                self.ids[taken[k], : lengths[k]] = found[k]
            still = np.flatnonzero(self.keys[slot] != p.hash)
            by_hash = dict(zip(p.hash[missed[first]].tolist(), found, strict=True))
            for k in still.tolist():
                key = int(p.hash[k])
                if key not in by_hash:
                    by_hash[key] = self.remembered(key, buffer[p.start[k] : p.end[k]])
                loose[k] = by_hash[key]
        return slot, loose

    def piece_lengths(self, p: Pieces) -> np.ndarray:
        slot, loose = self.lookup(p)
        lengths = self.lengths[slot].astype(np.int64)
        for k, ids in loose.items():
            lengths[k] = len(ids)
        return lengths

    def piece_ids(self, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in turn, number of ids of each piece)."""
        slot, loose = self.lookup(p)
        lengths = self.lengths[slot].astype(np.int64)
        inline = lengths.copy()
        for k, ids in loose.items():
            lengths[k], inline[k] = len(ids), 0
        mask = np.arange(INLINE_IDS) < inline[:, None]
        packed = self.ids[slot][mask].astype(np.uint32)
        if not loose:
            return packed, lengths
        out = np.empty(int(lengths.sum()), dtype=np.uint32)
        begin = np.cumsum(lengths) - lengths
        free = np.ones(len(out), dtype=bool)
        for k, ids in loose.items():
            out[begin[k] : begin[k] + len(ids)] = ids
            free[begin[k] : begin[k] + len(ids)] = False
        out[free] = packed
        return out, lengths

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for p in self.pieces(texts):
            if len(p.rows) == 0:
                continue
            ids, lengths = self.piece_ids(p)
            last = np.flatnonzero(np.append(p.rows[1:] != p.rows[:-1], True))
            begin = 0
            for r, k in zip(p.rows[last].tolist(), np.cumsum(lengths)[last].tolist(), strict=True):
                parts[r].append(ids[begin:k])
                begin = k
        none = np.zeros(0, dtype=np.uint32)
        return [x[0] if len(x) == 1 else np.concatenate([none, *x]) for x in parts]


_encoders: dict[str, CachedEncoder] = {}


def encoder(name: str) -> CachedEncoder:
    """The worker's own encoder: kept between batches and tasks."""
    if name not in _encoders:
        _encoders[name] = CachedEncoder(name)
    return _encoders[name]
