"""The order of tokens in the similarity join: counts of all tokens, in small pieces."""

import collections

import numpy as np
import pytest

from llm import jaccard_join
from llm.common import prepare, raw


def test_differences_round_trip():
    rng = np.random.default_rng(1)
    cases = [np.zeros(0, np.int64), np.array([0]), np.array([0xFFFFFE, 0xFFFFFF, 0x1FFFFFE, (1 << 40) - 1])]
    cases += [np.unique(rng.integers(0, 1 << 40, size=n)) for n in (1, 10, 100_000)] + [np.arange(50)]
    for values in cases:
        assert np.array_equal(jaccard_join.unpack_differences(jaccard_join.pack_differences(values)), values)


@pytest.mark.parametrize(("run", "most"), [(1 << 22, 1_000_000), (50, 1_000_000), (50, 12)])
def test_frequent_tokens_are_counted(spark, monkeypatch, run, most):
    prepare(spark)
    monkeypatch.setattr(jaccard_join, "RUN_TOKENS", run)
    monkeypatch.setattr(jaccard_join, "HOT_TOKENS", most)
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(list("abcdefgh"), size=rng.integers(0, 30), p=[0.4, 0.3, 0.1, 0.1, 0.04, 0.03, 0.02, 0.01])) for _ in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, ""])], "doc_id long, text string").repartition(5)
    _, token = jaccard_join.shingle_sets(raw(texts), 4)
    counts = collections.Counter(jaccard_join.fingerprints(token).tolist())
    want = {t: n for t, n in counts.items() if n > jaccard_join.RARE}
    found, place = jaccard_join.hot_tokens(docs, 4)
    assert set(found.tolist()) == want.keys() if most > len(want) else len(found) <= most and set(found.tolist()) < want.keys()
    in_order = [want[t] for t in found[np.argsort(place)].tolist()]
    assert in_order == sorted(in_order) and sorted(place.tolist()) == list(range(1, len(place) + 1))
    assert all(n <= in_order[0] for t, n in want.items() if t not in set(found.tolist()))
    empty, _ = jaccard_join.hot_tokens(docs.limit(0), 4)
    assert len(empty) == 0
