"""Operators against brute force on a small table with nulls, empty and long texts, ties and extra columns."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm import binary_ids, decontamination, jaccard_join, language_model, licenses, packing
from llm import quality, suffix_dedup, token_counts, toxicity
from llm.common import prepare
from llm.packing import best_fit, plan

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}
SCHEMA = "doc_id long, text string, node long, hash string, n long"


def sample():
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdeén'1."), size=rng.integers(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary, size=n))
    base, shared = say(120), say(60)
    texts = [None, "", " \n\t ", base, base, base.replace(base.split()[40], "changed", 1), say(3), say(3) + "\n" + say(90)]
    texts += [f"{say(20)}\n{shared}\n{say(20)}" for _ in range(4)] + [say(30_000), "x" * 5000, "The Tom <|endoftext|> İ 日本"]
    texts += [f"{say(30)}\nReleased under the MIT License.\n" * 2 + say(10), "apache license" + " z" * 60]
    rows = [(k, t, 1, "h", 5) for k, t in enumerate(texts)]
    return [*rows, rows[7], (None, say(40), None, None, None), (3, base + " same id", 1, "h", 1)]


ROWS = sample()


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def text_words(text, lower=True):
    return WORDS.findall((text or "").translate(LOWER) if lower else text or "")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_quality_measures(docs, none):
    want = []
    for doc_id, text, *_ in ROWS:
        words, seen, twice = text_words(text, lower=False), set(), 0
        for line in (text or "").split("\n"):
            if WORDS.search(line):
                twice += line in seen
                seen.add(line)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = collections.Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
        want.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(covered)))
    judged = quality.judge(docs)
    assert rows_of(judged.select(*quality.DIGEST[:6])) == sorted(want, key=repr)
    assert judged.where("base_failed and kept").count() == 0
    assert quality.judge(none).count() == 0


def test_toxicity_learns_words(spark, none):
    rows = [(k, f"plain words here {k} and {'you scumbag' if k % 3 == 0 else 'you friend'} again") for k in range(600)]
    texts = spark.createDataFrame([*rows, (None, None), (9999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(600)], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r for r in toxicity.score_toxicity(texts, labels).collect()}
    assert len(scored) == 602
    assert all(scored[k].predicted == int(k % 3 == 0) for k in range(600))
    assert all(scored[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(600))
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.score_toxicity(texts, labels.where("false")).count() == 602


def brute_components(rows, shingle, threshold):
    sets = []
    for _, text, *_ in rows:
        w = text_words(text)
        sets.append({tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= threshold * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    ids = collections.defaultdict(list)
    for k, row in enumerate(rows):
        ids[root(k)].append(row[0])
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(row[0], len(sets[k]), least[root(k)]) for k, row in enumerate(rows)]


@pytest.mark.parametrize("rare", [8, 1])
def test_jaccard_join(docs, none, monkeypatch, rare):
    monkeypatch.setattr(jaccard_join, "RARE", rare)  # with 1, most sets are indexed by combinations
    got = jaccard_join.join_similar(docs).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(ROWS, 4, 85), key=repr)
    assert jaccard_join.join_similar(none).count() == 0


def test_combinations_meet():
    rng = np.random.default_rng(5)
    for size in [*range(2, 40), 100, 333, 900]:
        tokens = rng.integers(0, 1 << 63, size=2 * size, dtype=np.uint64)
        a = np.unique(tokens[:size])
        for b_size in {size, max(1, math.ceil(size * 0.85))}:
            drop = (15 * (size + b_size) // 185 + size - b_size) // 2
            b = np.unique(np.concatenate([a[: size - drop], tokens[size : size + max(0, b_size - size + drop)]]))
            if 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
                continue
            row = np.repeat([0, 1], [len(a), len(b)])
            owner, key = jaccard_join.combinations(row, np.concatenate([a, b]), np.array([len(a), len(b)]), 85)
            assert np.intersect1d(key[owner == 0], key[owner == 1]).size


def test_binary_ids(spark, docs, none, tmp_path):
    tool = library("word_bpe_49k.json")
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    path = str(tmp_path / "packs")
    binary_ids.write_packs(docs, path, "word_bpe_49k.json", end_id=2)
    got = sorted((tuple(r) for r in binary_ids.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in order]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
    want = collections.Counter()
    for doc_id, text, *_ in ROWS:
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want[(doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert collections.Counter((r[0], r[2], r[3]) for r in got) == want
    binary_ids.write_packs(none, path + "-none", "word_bpe_49k.json", end_id=2)
    assert binary_ids.read_documents(spark, path + "-none").count() == 0


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 32])
def test_packs_are_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, size=10_001, dtype=np.uint64).astype(np.uint32)
    pack = binary_ids.Pack(binary_ids.make_pack([7, None], [ids[:9000], ids[9000:]], bits))
    assert pack.doc_ids == [7, None]
    for start, end in [(0, 10_001), (4095, 4097), (9000, 9000), (8191, 10_001)]:
        assert np.array_equal(pack.ids(start, end), ids[start:end])


def test_packing(docs, none):
    tool = library("byte_bpe_50k.json")
    got = packing.pack_documents(docs, "byte_bpe_50k.json", end_id=0, capacity=2048).collect()
    want = collections.Counter()
    for doc_id, text, *_ in ROWS:
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        begins = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048)]
        for k, (s, e) in enumerate(zip(begins, [*begins[1:], len(ids)], strict=True)):
            want[(doc_id, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(none, "byte_bpe_50k.json").count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 2049, size=20_000), minlength=2049)
    groups = plan(counts)
    used = np.zeros(2049, dtype=int)
    for lengths, n in groups:
        assert sum(lengths) <= 2048
        np.add.at(used, list(lengths), n)
    assert np.array_equal(used, counts)
    bound = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(n for _, n in groups) <= 1.02 * bound


@pytest.mark.parametrize("kind", ["uniform", "narrow", "geometric", "large", "two", "halves", "empty"])
def test_plan_never_needs_more_than_best_fit(kind):
    rng = np.random.default_rng(7)
    lengths = {
        "uniform": rng.integers(1, 2049, 5_000),
        "narrow": rng.normal(600, 60, 5_000).astype(int).clip(1, 2048),
        "geometric": rng.geometric(1 / 300, 5_000).clip(1, 2048),
        "large": rng.integers(1025, 2049, 500),
        "two": np.array([1024] * 7 + [683] * 5),
        "halves": rng.choice([512, 1024, 1536, 2048], 1_000),
        "empty": np.zeros(0, dtype=int),
    }[kind]
    counts = np.bincount(lengths, minlength=2049)
    groups = plan(counts)
    used = np.zeros(2049, dtype=int)
    for held, n in groups:
        assert sum(held) <= 2048 and n > 0
        np.add.at(used, list(held), n)
    assert np.array_equal(used, counts)
    assert sum(n for _, n in groups) <= sum(n for _, n in best_fit(counts))


def test_reworded_questions(spark, none):
    q = "the train from Paris to Lyon takes about 45 minutes and then Paris is 300 km away from the old town of Lyon said Anna"
    other = q.replace("Paris", "Berlin").replace("45", "90").replace("Lyon", "Bonn")
    rows = [(1, f"see: {q} end"), (2, f"well {other}"), (3, q.replace("Paris", "Berlin", 1)), (4, None), (5, ""), (None, q), (2, f"well {other}")]
    items = spark.createDataFrame([(10, q), (11, None), (12, ""), (None, q)], "item_id long, text string")
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.find_leaks(texts, items)
    assert rows_of(found.select("doc_id", "item_id")) == sorted([(d, i) for d in (1, 2, None) for i in (10, None)], key=repr)
    assert sorted(r.doc_id for r in decontamination.drop_leaking(texts, items).collect()) == [3, 4, 5]
    assert decontamination.find_leaks(texts, items.where("false")).count() == 0
    assert decontamination.find_leaks(none, items).count() == 0


def test_copies_in_other_case_and_spacing(spark):
    q = "in the long summer of 1912 the painter Maria met Jonas near Lisbon and sold him 3 km of rope for old Peter to use"
    forms = [q, q.replace(" M", "\nM").replace(" J", "\r\n\tJ").replace(" P", "\n P"), q.replace(" ", "  "), q.lower(), q.upper(), q.title(),
             q.replace(" ", "\u00a0"), q.replace("Lisbon", "lisbon"), q.replace("Maria", "Anna").replace("1912", "1850")]
    texts = [f"some words before. {form} and words after" for form in forms]
    texts += [q.replace("Lisbon and", "Rome but").replace("painter", "man").replace("sold him", "got").replace("long", "wet"), q[:40]]
    texts += ["who wrote War\n\nand peace", "who wrote war peace?", " WHO  wrote, war; Peace", "so who wrote war peace", "42", "Who", "17"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for item in (q, q.lower()):
        items = spark.createDataFrame([(1, item), (2, "Who wrote war peace"), (3, "42"), (4, "!")], "item_id long, text string")
        found = decontamination.find_leaks(docs, items)
        assert dict(found.dtypes)["n_changed"] == "bigint"
        got = sorted((r.doc_id, r.item_id) for r in found.collect())
        assert got == [(k, 1) for k in range(9)] + [(12, 2), (13, 2), (15, 3)]
    facts = {r.doc_id: (r.coverage, r.n_slots, r.n_changed) for r in decontamination.find_leaks(docs, items.where("item_id = 1")).collect()}
    assert facts[0] == facts[3] == (1.0, 3, 0)
    items = spark.createDataFrame([(1, q)], "item_id long, text string")
    facts = {r.doc_id: (r.coverage, r.n_slots, r.n_changed) for r in decontamination.find_leaks(docs, items).collect()}
    assert facts[0] == facts[1] == facts[2] == (1.0, 7, 0) and facts[8] == (1.0, 7, 2)


def plain_template(text):
    """Lower-case words of letters only, as random items here have no slots."""
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def test_random_items_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [a + b for a in "bdfgklm" for b in ("ala", "eno", "iro", "ut")]
    say = lambda n: rng.choice(words, n).tolist()
    items = {k: say(int(rng.integers(1, 40))) for k in range(60)}
    docs = {}
    for k in range(200):
        item = items[int(rng.integers(60))]
        a, b = sorted(rng.integers(0, len(item) + 1, 2).tolist())
        middle = item if k % 3 else item[a:b]
        parts = say(int(rng.integers(0, 30))) if k % 4 else []
        text = [*parts, *middle, *(say(3) if k % 4 else [])]
        docs[k] = "".join(w.upper() + " \n" if rng.random() < 0.1 else w + rng.choice([" ", "  ", ", "]) for w in text)
    want = {}
    for d, text in docs.items():
        t = plain_template(text)
        for i, item in items.items():
            n = len(item)
            if n < 5:
                if t == item:
                    want[d, i] = 1.0
                continue
            size, at, run = min(n, 8), set(), False
            for shift in range(-n, len(t)):
                hit = [p for p in range(n - size + 1) if 0 <= p + shift and t[p + shift : p + shift + size] == item[p : p + size]]
                at.update(hit)
                run |= any(all(p + j in hit for j in range(6)) for p in hit)
            share = len({p + j for p in at for j in range(size)}) / n
            if share >= 0.5 or run:
                want[d, i] = share
    found = decontamination.find_leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string"),
    )
    assert {(r.doc_id, r.item_id): round(r.coverage, 9) for r in found.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_interrupted_and_quoted_questions(spark):
    say = lambda name, n: [f"{name}{k}q" for k in range(n)]
    long, middle, short = say("a", 59), say("b", 38), say("c", 18)
    texts = {
        1: [*long[:30], "inserted", *long[30:]],
        2: [*middle[:19], "inserted", *middle[19:]],
        3: ["so", *long[20:50], "he", "said"],  # half of the tokens, no insertion
        4: [*short[:9], "changed", *short[10:]],
        5: [*say("d", 9), *long[40:53], *say("e", 9)],  # thirteen in a row
        6: [*say("d", 9), *long[40:52], *say("e", 9)],
        7: [*short[:8], *say("f", 20)],
    }
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    items = [(k, " ".join(t)) for k, t in enumerate((long, middle, short))]
    found = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): round(r.coverage, 6) for r in found.collect()}
    assert got == {(1, 0): 1, (2, 1): 1, (3, 0): round(30 / 59, 6), (4, 2): round(17 / 18, 6), (5, 0): round(13 / 59, 6)}


def test_language_model(docs, none):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter()
    for doc_id, text, *_ in ROWS:
        if not held(doc_id):
            counts.update([*text_words(text), "\n"])
    n, v = sum(counts.values()), len(counts)
    want = []
    for doc_id, text, *_ in ROWS:
        words = [*text_words(text), "\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want.append((doc_id, held(doc_id), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    got = language_model.score_texts(docs).collect()
    assert sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    assert language_model.score_texts(none).count() == 0


@pytest.mark.parametrize("strings", [20_000, 1])
def test_suffix_dedup(docs, none, monkeypatch, strings):
    monkeypatch.setattr(suffix_dedup, "GROUP_STRINGS", strings)  # with 1, windows are counted singly
    texts = [(d, (t or "").encode()) for d, t, *_ in ROWS]
    seen = collections.Counter(b[k : k + 200] for _, b in texts for k in range(len(b) - 199))
    want = []
    for doc_id, b in texts:
        gone = np.zeros(len(b) + 2, dtype=bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k + 1 : k + 201] = True
        kept = np.frombuffer(b, np.uint8)[~gone[1:-1]].tobytes()
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        want.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_passages(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(got) == sorted(want, key=repr)
    assert suffix_dedup.remove_passages(none).count() == 0


def test_token_counts(docs, none):
    tool = library("byte_bpe_50k.json")
    want = []
    for doc_id, text, *_ in ROWS:
        n = len(tool.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert rows_of(token_counts.count_tokens(docs, "byte_bpe_50k.json")) == sorted(want, key=repr)
    assert token_counts.count_tokens(none, "byte_bpe_50k.json").count() == 0


def test_licenses(docs, none):
    want = []
    for doc_id, text, *_ in ROWS:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            for k in range(len(words)):
                if words[k : k + len(p)] == p:
                    places.append(k)
                    labels.add(label)
        want.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    got = licenses.scan_licenses(docs)
    assert rows_of(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want, key=repr)
    assert got.where("labels like '%notice-mit%'").count() == 1
    assert licenses.scan_licenses(none).count() == 0


def test_wrapped_licenses(spark):
    mit = "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software"
    gpl = " * you can redistribute it and/or modify\n * it under the terms of the GNU General Public\n * License"
    far = mit.replace("charge,", "charge, " + "other " * 9)
    texts = [f"a b\n{mit} and\nmore", f"some text\n{gpl}", far, "permission is hereby\n" * 9, mit[:40]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert got == {0: ("notice-mit", 1), 1: ("gpl,notice-gpl", 1), 2: ("", 0), 3: ("", 0), 4: ("", 0)}


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        ids = [r.doc_id for r in out.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        docs, before = spark.createDataFrame(out.collect(), out.schema), set(ids)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").distinct().count() == len(before)
