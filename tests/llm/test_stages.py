"""Stages of the pipeline on rows with nulls, empty texts, repeats and columns of any name, against plain Python."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from llm import decontamination, jaccard_join, quality, suffix_dedup
from llm.common import prepare
from test_training_data import brute_components, sample

SCHEMA = "doc_id long, text string, kept boolean, _id string, _key long, n_chars long"
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def rows():
    texts = [(k, t) for k, t, *_ in sample() if t is None or len(t) < 20_000]
    texts += [(None, ""), (None, ""), (None, None), (50, " "), (50, " "), (60, BASE), (61, BASE), (61, BASE), (None, BASE), (None, BASE)]
    texts += [(70, "unlike any other text of this table that is there"), (70, "unlike any other text of this table that is there")]
    return [(k, t, True, f"x{n % 3}", n, 5) for n, (k, t) in enumerate(texts)]


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_one_row_of_each_group_stays(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(jaccard_join, "BROADCAST_NODES", broadcast)
    kept = jaccard_join.keep_first(docs, shingle=5, threshold=80)
    assert kept.columns == docs.columns
    # Components by brute force; rows without words are none of them.
    numbered = [(n, t) for n, (_, t, *_) in enumerate(ROWS)]
    parts = collections.defaultdict(list)
    for (n, size, component), (doc_id, text, *_) in zip(brute_components(numbered, 5, 80), ROWS, strict=True):
        parts[component if size else ("empty", n)].append((doc_id, text))
    want = collections.Counter()
    for members in parts.values():
        least = min((d for d, _ in members if d is not None), default=None)
        at_least = [m for m in members if m[0] == least]
        want[len(at_least) and tuple(sorted({repr(m) for m in at_least}))] += 1
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(parts)
    for choices, n in want.items():
        assert sum(repr(g) in choices for g in got) == n
    assert jaccard_join.keep_first(spark.createDataFrame([], SCHEMA), 5, 80).count() == 0


def test_passages_are_cut_whatever_the_columns(spark, docs):
    got = suffix_dedup.cut_passages(docs)
    assert got.columns == docs.columns and dict(got.dtypes)["n_chars"] == "bigint"
    seen = collections.Counter()
    for _, t, *_ in ROWS:
        b = (t or "").encode()
        seen.update(b[k : k + 200] for k in range(len(b) - 199))
    want = []
    for doc_id, t, *rest in ROWS:
        b, gone = (t or "").encode(), set()
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone.update(range(k, k + 200))
        left = bytes(x for k, x in enumerate(b) if k not in gone).decode("utf-8", "ignore")
        text = t if not gone else left
        want.append((doc_id, text, *rest[:-1], None if text is None else len(text)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert suffix_dedup.cut_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_good_rows_stay(spark, docs):
    got = quality.keep_good(docs)
    assert got.columns == docs.columns
    verdict = collections.Counter((r.doc_id, r.n_words, r.n_dup_lines) for r in quality.judge(docs).where("kept").collect())
    words = re.compile(r"[^\x20\x09-\x0D]+")
    assert collections.Counter((r.doc_id, len(words.findall(r.text or ""))) for r in got.collect()) == collections.Counter(
        {(k, n): sum(v for (a, b, _), v in verdict.items() if (a, b) == (k, n)) for k, n, _ in verdict}
    )
    assert quality.keep_good(spark.createDataFrame([], SCHEMA)).count() == 0


def test_leaks_go_whatever_the_columns(spark, docs):
    items = spark.createDataFrame([(1, BASE), (None, None)], "item_id long, text string")
    got = decontamination.drop_leaking(docs, items)
    assert got.columns == docs.columns
    want = [r for r in ROWS if r[1] != BASE]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert decontamination.drop_leaking(docs, items.where(F.lit(False))).count() == len(ROWS)
    assert decontamination.drop_leaking(spark.createDataFrame([], SCHEMA), items).count() == 0
