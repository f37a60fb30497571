"""Components of one large group are united by a few pairs, not by all links between their nodes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_training_data import brute_components, rows_of

from llm import jaccard_join


def two_centres(n, seed):
    """Two texts a word apart, n copies of each with a word of their own, all of them linked, and others that share much but link with none."""
    draw = random.Random(seed)
    base = [f"w{k}" for k in range(200)]
    other = [*base[:100], "other", *base[101:]]
    places = [k for k in range(5, 195, 5) if k != 100]
    texts = [base, other]

    def changed(text, k):
        out = list(text)
        for place in draw.sample(places, k):
            out[place] = f"x{draw.randrange(10**9)}"
        return out

    texts += [changed(text, 1) for text in (base, other) for _ in range(n)]
    texts += [changed(base, 6) for _ in range(2 * n)]
    return [(k * 7 % 1009, " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("nodes", [2048, 40])
def test_links_between_two_components_do_not_grow_with_both(spark, monkeypatch, nodes):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", nodes)
    stored = []

    def seen(df, label, store=jaccard_join.stash, **options):
        out = store(df, label, **options)
        stored.append((label, out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "stash", seen)
    rows = two_centres(40, 501)
    got = jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == sorted(brute_components(rows, 4, 85), key=repr)
    links = [n for label, n in stored if label == "links"]
    assert sum(links) <= 3 * len(rows), stored


def test_bridges_are_the_nearest_of_each_pair():
    first, second = np.array([1, 2, 1, 1, 1, 1, 1]), np.array([5, 5, 5, 5, 5, 5, 5])
    kept = jaccard_join._bridges(first, second, np.array([9, 4, 3, 7, 8, 1, 2]))
    assert sorted(kept.tolist()) == [1, 2, 3, 5, 6]
    assert len(jaccard_join._bridges(first[:0], second[:0], first[:0])) == 0


def test_a_block_offers_few_pairs_of_two_components():
    rows = [(node, 1 + node % 2, node % 2 == 1) for node in range(60)]
    sketch = np.zeros(32, np.uint8).tobytes()
    table = pa.table(
        {
            "node": [r[0] for r in rows] + [r[0] for r in rows if r[2]],
            "component": [r[1] for r in rows] + [r[1] for r in rows if r[2]],
            "asks": [r[2] for r in rows] + [r[2] for r in rows if r[2]],
            "role": [jaccard_join.MEMBER] * 60 + [jaccard_join.ASKING] * 30,
            "size": [50] * 90,
            "sketch": [sketch] * 90,
        }
    )
    few = jaccard_join._across(85, jaccard_join.BETWEEN)(table).to_pylist()
    assert len(few) == jaccard_join.BRIDGES and all(r["a"] % 2 != r["b"] % 2 for r in few)
    assert jaccard_join._across(85, jaccard_join.ALL)(table).num_rows == 30 * 30
