"""The classifier against a plain fit, and on odd input."""

import math
import random
import re

import pytest

from llm import toxicity
from llm.common import prepare


def plain_ngrams(text):
    words = filter(None, re.split(r"[^a-z\x80-\U0010ffff]+", (text or "").lower()))
    return {f" {w} "[k : k + n] for w in words for n in (3, 4, 5) for k in range(len(w) + 3 - n)}


def plain_fit(rows, steps=20_000, rate=0.02):
    sets = [(plain_ngrams(t), y) for t, y in rows]
    n1, n0 = sum(y for _, y in sets), sum(1 - y for _, y in sets)
    scale = {}
    for g in set().union(*(s for s, _ in sets)):
        p = (sum(y for s, y in sets if g in s) + 1) / (n1 + 2)
        q = (sum(1 - y for s, y in sets if g in s) + 1) / (n0 + 2)
        error = math.sqrt((1 - p) / (p * (n1 + 2)) + (1 - q) / (q * (n0 + 2)))
        scale[g] = math.copysign(max(abs(math.log(p / q)) - error, 0), p - q)
    weight, bias = dict.fromkeys(scale, 0.0), math.log(n1 / n0)
    for _ in range(steps):
        error = []
        for s, y in sets:
            z = bias + sum(weight[g] * scale[g] for g in s)
            error.append(1 / (1 + math.exp(-z)) - y)
        slope = {g: toxicity.PENALTY * w for g, w in weight.items()}
        for (s, _), e in zip(sets, error, strict=True):
            for g in s:
                slope[g] += e * scale[g]
        weight = {g: w - rate * slope[g] for g, w in weight.items()}
        bias -= rate * sum(error)
        if max(map(abs, slope.values())) < 1e-6 and abs(sum(error)) < 1e-6:
            break
    return lambda t: 1 / (1 + math.exp(-bias - sum(weight[g] * scale[g] for g in plain_ngrams(t) if g in scale)))


def test_scores_equal_a_plain_fit(spark):
    prepare(spark)
    rng = random.Random(4)
    good, bad = ["river", "Öl", "дом", "日本", "tea"], ["vile", "Дрянь", "馬鹿野郎", "Übel"]
    rows = []
    for k in range(60):
        toxic = int(rng.random() < 0.4)
        rows.append((k, " ".join(rng.choices(good, k=3) + (rng.choices(bad, k=1) if toxic or rng.random() < 0.1 else []))))
    toxic = {k: int(any(w in t for w in bad)) if k % 9 else 1 for k, t in rows}
    extra = [(1000, None), (1001, ""), (1002, "дрянь ÜBEL"), (None, "vile tea"), (3, rows[3][1])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows + extra], "doc_id long, text string, toxic int, score int")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    held = {r.doc_id for r in got if r.held_out}
    assert held and None not in held
    # Row 3 stands twice, so it is learnt from twice.
    learnt = [(t, toxic[k]) for k, t in [*rows, extra[-1]] if k not in held]
    plain = plain_fit(learnt)
    want = sorted((k is not None, k or 0, round(plain(t), 3)) for k, t in rows + extra)
    for (_, k, score), row in zip(want, sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.score)), strict=True):
        assert (row.doc_id or 0) == k
        assert row.score == pytest.approx(score, abs=0.01)


def test_one_class_long_texts_and_no_rows(spark):
    prepare(spark)
    texts = [(k, "vile " * 200_000 if k == 1 else "日" * 700_000 if k == 2 else "calm tea") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    clean = spark.createDataFrame([(k, 0) for k in range(40)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_toxicity(docs, clean).collect()} == {0}
    mixed = spark.createDataFrame([(k, int(k in (0, 1, 2, 3))) for k in range(40)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, mixed).count() == 40
    assert toxicity.score_toxicity(docs.where("false"), mixed).count() == 0
