"""Merge rounds and token alignment against the libraries and plain loops."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm import alignment, bpe
from llm.common import prepare

SCHEMA = "doc_id long, text string, ids array<int>, pairs long, row long"
POOL = "abcde fgh ''  \n\t.!1234é日本😀́‍▁<|endoftext|>"


def random_texts(n, seed):
    rng = random.Random(seed)
    any_char = lambda: chr(rng.choice([rng.randrange(0x250), rng.randrange(0x3000, 0xD000), rng.randrange(0x10000, 0x11FFF)]))
    return ["".join(rng.choice(POOL) if rng.random() < 0.9 else any_char() for _ in range(rng.randrange(60))) for _ in range(n)]


def odd_texts():
    rng = random.Random(2)
    texts = [None, "", " ", "   ", "don't <|endoftext|> stop<|endoftext|><|endoftext|>", "a  b <s> </s> <unk> ", "x" * 5000, "ab" * 3000]
    texts += ["'s're'llx 'tis we''ve\n'd", "tab\tand\x00\x1c\x85", "日本語テキスト😀 мир İß", "՘x ࢏1", "she said ▁ this", "same text", "same text"]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC0123456789+/") for _ in range(20_000)), "some words " * 30_000]
    return texts + random_texts(300, 4)


ROWS = [(k, t, [1], 7, 7) for k, t in enumerate(odd_texts())] + [(None, "null id", None, None, None), (3, "again", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_ids_and_texts_equal_the_library(docs, none, byte_library):
    want = collections.Counter()
    for doc_id, text, *_ in ROWS:
        ids = byte_library.encode(text or "", add_special_tokens=False).ids
        back = byte_library.decode(ids, skip_special_tokens=False)
        want[(doc_id, len(ids), sha(",".join(map(str, ids))), sha(back))] += 1
    encoded = bpe.encode_texts(docs, "byte_bpe_50k.json")
    assert collections.Counter(map(tuple, bpe.digest(bpe.decode_ids(encoded, "byte_bpe_50k.json")).collect())) == want
    assert bpe.digest(bpe.decode_ids(bpe.encode_texts(none, "byte_bpe_50k.json"), "byte_bpe_50k.json")).count() == 0


def test_special_strings_as_text(byte_library):
    byte_library.encode_special_tokens = True
    texts = [t or "" for t in odd_texts()]
    got = bpe.merge_encoder("byte_bpe_50k.json", special=False).encode_many(texts)
    assert [g.tolist() for g in got] == [e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)]


def test_decoding_any_ids(spark, byte_library):
    rng = random.Random(5)
    lists = [[rng.randrange(50_257) for _ in range(rng.randrange(9))] for _ in range(200)] + [[50_256, 60_000, -1, 5]]
    rows = [(k, x) for k, x in enumerate(lists)] + [(900, None), (901, [None, 5])]
    got = {r.doc_id: r.text for r in bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), "byte_bpe_50k.json").collect()}
    for k, ids in enumerate(lists):
        assert got[k] == byte_library.decode([i for i in ids if 0 <= i <= 50_256], skip_special_tokens=False)
    assert got[900] == "" and got[901] == byte_library.decode([5])


def test_both_ways_of_merging_agree():
    table = bpe.merge_encoder("byte_bpe_50k.json").table
    rng = random.Random(6)
    words = ["".join(rng.choice("aabetho ") for _ in range(rng.randrange(1, 90))).encode() for _ in range(400)]
    assert bpe.merge_rounds(table, words) == [bpe.merge_by_rank(table, w) for w in words]


def test_small_slices_and_caches_change_nothing(monkeypatch, byte_library):
    texts = [t or "" for t in odd_texts()]
    want = [e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(bpe, "SLICE_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    assert [g.tolist() for g in bpe.MergeEncoder("byte_bpe_50k.json").encode_many(texts)] == want


def test_product_of_sparse_matrices():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n, m, k = rng.integers(1, 9, size=3)
        left, right = rng.integers(0, 3, size=(n, m)), rng.integers(0, 3, size=(m, k))

        def csr(x):
            row, column = np.nonzero(x)
            return alignment.Csr(np.searchsorted(row, np.arange(len(x) + 1)), column, x[row, column], x.shape[1])

        got = alignment.product(csr(left), csr(right))
        dense = np.zeros((n, k), int)
        dense[got.row_of_entries(), got.column] = got.value
        assert np.array_equal(dense, left @ right)
        assert alignment.product_size(csr(left), csr(right)).sum() >= len(got.value)


def plain_alignment(rows):
    """Digests by the libraries and loops over all token pairs that can meet."""
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    bytes_a = bpe.merge_encoder("byte_bpe_50k.json").table.token_bytes
    show = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()
    each, counts = [], collections.Counter()
    for doc_id, text, *_ in rows:
        a = tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        spell_a, spell_b = [bytes_a[i] for i in a], [show(pieces.id_to_piece(i)) for i in b]
        if text and not (b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode()):
            a, b = [], []
        links, groups, at_b, end_a, end_b, ga, gb = [], [], 0, 0, 0, [], []
        ends_b = np.cumsum([len(x) for x in spell_b]).tolist() if b else []
        k = 0
        for i, x in zip(a, spell_a, strict=False):
            begin, end_a = end_a, end_a + len(x)
            ga.append(i)
            while k < len(b) and ends_b[k] <= begin:
                k += 1
            j = k
            while j < len(b) and (ends_b[j - 1] if j else 0) < end_a:
                links.append((i, b[j]))
                if ends_b[j] <= end_a:
                    gb.append(b[j])
                j += 1
            if end_a in ends_b[max(0, j - 2) : j + 1]:
                groups.append((ga, gb))
                ga, gb = [], []
        each.append((doc_id, a, b, groups, links))
        counts.update(set(links))
    best = collections.defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = collections.Counter()
    for doc_id, a, b, groups, links in each:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        in_groups = sum(len(x) * len(y) for x, y in groups)
        n_best, total = sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)
        out[(doc_id, len(a), len(b), len(groups), len(links), in_groups, sha(shown) if shown else "", n_best, total)] += 1
    return out


@pytest.mark.parametrize("table_pairs", [1_000_000, 40, 0])
def test_alignment(docs, none, table_pairs):
    got = alignment.align_and_score(docs, "byte_bpe_50k.json", "piece_bpe_32k.model", table_pairs=table_pairs)
    columns = ["doc_id", *alignment.NUMBERS, "groups_sha256", "n_best", "count_sum"]
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == plain_alignment(ROWS)
    assert alignment.align_and_score(none, "byte_bpe_50k.json", "piece_bpe_32k.model", table_pairs=table_pairs).count() == 0


def test_links_by_bytes(monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", 16)
    both = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    for text in ["Unbelievably 日本 tokenizations\n\n  of 12345 words", " x", "😀é́ " * 20]:
        (a,), (b,) = both.encode([text])
        end_a, end_b = np.cumsum(both.len_a[a]), np.cumsum(both.len_b[b])
        begin_a, begin_b = end_a - both.len_a[a], end_b - both.len_b[b]
        shared = np.minimum(end_a[:, None], end_b) - np.maximum(begin_a[:, None], begin_b)
        at_a, at_b, n = both.links(a, b)
        assert list(zip(at_a, at_b, n, strict=True)) == [(i, j, shared[i, j]) for i, j in zip(*np.nonzero(shared > 0), strict=True)]
        ends = [e for e in end_a if e in end_b]
        group = lambda end: np.searchsorted(ends, end)
        pairs = [(i, j) for x, y in both.group_links(a, b) for i, j in zip(x, y, strict=True)]
        assert pairs == [(i, j) for i in range(len(a)) for j in range(len(b)) if group(end_a[i]) == group(end_b[j])]
