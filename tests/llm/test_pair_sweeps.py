"""Tables of pairs are drawn in every sweep, given the word restaurant, and each sample scores with its own."""

import zlib

import numpy as np
import pytest

from llm import language_model
from llm.language_model import BURN_IN, SAMPLES, unpack


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("hot", [1 / 256, 2.0])
def test_pairs_are_seated_in_every_sweep(spark, monkeypatch, hot):
    monkeypatch.setattr(language_model, "HOT_SHARE", hot)
    lines = ["the fog over san francisco is cold", "a ship from san francisco ran late", "the cat sat in san francisco"]
    rows = [(k, f"{lines[k % 3]} w{k % 17} and x{k % 23} of y{k % 29}") for k in range(400) if not held(k)]
    rows.append((next(k for k in range(1000, 1100) if held(k)), "the zzzqq of san zzzqq"))
    seatings, vocabularies = [], []

    def record(make, made):
        def call(*args, **more):
            made.append(make(*args, **more))
            return made[-1]

        return call

    for name, made in (("seat_pairs", seatings), ("seat_again", seatings), ("with_customers", vocabularies)):
        monkeypatch.setattr(language_model, name, record(getattr(language_model, name), made))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks = language_model.to_blocks(docs, "doc_id", "text")
    tables, values, model, dealt, hot_words = language_model.learnt(blocks)
    assert len(seatings) == len(vocabularies) == BURN_IN + SAMPLES
    assert len(model.samples) == len(dealt) == SAMPLES

    first = seatings[0].where("kind = 0").orderBy("bucket").collect()
    n = np.concatenate([unpack(r.n) for r in first])
    drawn = []
    for seated, vocabulary in zip(seatings, vocabularies, strict=True):
        found = seated.where("kind = 0").orderBy("bucket").collect()
        t = np.concatenate([unpack(r.t) for r in found])
        customers = sum(np.frombuffer(r.c, "<i8").sum() for r in vocabulary.collect())
        assert ((t >= 1) == (n > 0)).all() and (t <= n).all()
        assert sum(unpack(r.total).sum() for r in found) == t.sum() == customers
        drawn.append(t)
    assert all((x != y).any() for x, y in zip(drawn, drawn[1:], strict=False))
    # "francisco" is frequent, but the word restaurant has it from one pair only, so that pair gets fewer tables than by its share of tokens.
    pair = n.argmax()
    assert n[pair] > 300
    assert all(t[pair] < drawn[0][pair] for t in drawn[1:])

    # All chances after a word add up to one, in every sample.
    rows = tables.orderBy("bucket").collect()
    block = blocks.first().asDict()
    u, w, count, bucket, _, keys = language_model.pairs_of(block, hot_words)
    assert (np.concatenate([unpack(r.n) for r in rows]) == count).all()
    t = np.concatenate([unpack(r.t) for r in rows])
    assert (np.bincount(u, t) > 0).sum() == (np.bincount(u, count) > 0).sum()
    start, end = language_model._runs_of(bucket << 32 | u)
    seats = np.zeros(len(keys))
    for k, (words, all_tables) in enumerate(dealt):
        mine = np.concatenate([unpack(r.total).reshape(SAMPLES, -1)[k] for r in rows])
        wide = np.isin(keys[u[start]], words)
        seats += np.bincount(u[start[~wide]], mine[~wide], len(keys))
        at = np.flatnonzero(np.isin(keys, words))
        seats[at] += all_tables[np.searchsorted(words, keys[at])]
    assert np.bincount(u, t, len(keys)) == pytest.approx(seats)
    p = np.concatenate([np.frombuffer(r.t).reshape(SAMPLES, -1) for r in values.orderBy("bucket").collect()], axis=1)
    assert p.sum(axis=1) == pytest.approx([1] * SAMPLES)
    assert (p[0] != p[1]).any()
