"""Scores depend on the words before and not on partitions, and chances add up to one."""

import collections
import zlib

import numpy as np
import pytest

from llm import language_model


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("hot", [1 / 256, 2.0])
def test_word_contexts(spark, monkeypatch, hot):
    monkeypatch.setattr(language_model, "HOT_SHARE", hot)  # with 2, no first word is dealt by both words
    lines = ["the cat sat on the mat", "a dog ran to the park", "the cat ran to a mat", "red birds fly over green hills"]
    rows = [(k, lines[k % 4]) for k in range(60) if not held(k)]
    out = [k for k in range(1000, 2000) if held(k)]
    known = sorted({w for line in lines for w in line.split()})
    # What follows "cat" after "the": every known word, the end and an unknown one.
    asked = {f"the cat {w}": k for w, k in zip([*known, "zzzqq"], out, strict=False)}
    more = {"the cat": out[-1], "mat the on sat cat the": out[-2], "the cat sat on the mat": out[-3]}
    docs = spark.createDataFrame(rows + [(k, t) for t, k in (asked | more).items()], "doc_id long, text string")
    score = {r.doc_id: r.score for r in language_model.score_texts(docs.repartition(3)).collect()}
    again = {r.doc_id: r.score for r in language_model.score_texts(docs.coalesce(1)).collect()}
    assert score == pytest.approx(again, abs=1e-9)
    assert score[more["the cat sat on the mat"]] > score[more["mat the on sat cat the"]] + 2


def test_chances_add_up(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HOT_SHARE", 2.0)
    texts = [(k, f"the cat{k % 3} sat on the mat and the dog{k % 5} ran") for k in range(40) if not held(k)]
    unknown = next(k for k in range(1000, 1100) if held(k))
    docs = spark.createDataFrame(texts + [(unknown, "zzzqq")], "doc_id long, text string").coalesce(1)
    blocks = language_model.to_blocks(docs, "doc_id", "text")
    words = language_model.count_words(blocks)
    known, times = language_model.frequent_words(words)
    hot = language_model.hot_words(blocks, int(times.sum()))
    seated = language_model.seat_pairs(blocks, (known, times), int(times.sum()), len(known), hot)
    vocabulary = language_model.with_customers(words, seated)
    model = language_model.learn(vocabulary)
    chances = language_model.word_chances(vocabulary, model).collect()
    # The one unknown word has what the others leave.
    assert sum(np.frombuffer(r.p).sum() for r in chances) == pytest.approx(1)
    counts = collections.Counter(pair for _, t in texts for pair in zip(["\n", *t.split()], [*t.split(), "\n"], strict=True))
    found = seated.where("kind = 0").collect()
    n, tables = (np.concatenate([language_model.unpack(r[k]) for r in found]) for k in ("n", "t"))
    totals = np.concatenate([language_model.unpack(r.total) for r in found])
    assert sorted(n[n > 0].tolist()) == sorted(counts.values())
    assert (tables[n > 0] >= 1).all() and (tables <= n).all()
    assert totals.sum() == tables.sum() == model.customers
    assert model.tokens == sum(counts.values())
