"""Scratch tables and shuffle files go as soon as nothing reads them, and strings that can't share a passage aren't fetched."""

import os
import random
import time

import pytest

import corpus_pipeline
from llm import jaccard_join, suffix_dedup
from llm.common import stash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(n))


@pytest.fixture
def docs(spark):
    passage = words(0, 60)
    texts = [f"{words(k, 80)} {passage if k % 3 == 0 else ''} {words(k + 100, 80)}" for k in range(1, 12)]
    return spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in enumerate([*texts, texts[0]])], SCHEMA)


@pytest.fixture
def scratch(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    return lambda: sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_go(spark):
    before = shuffle_files(spark)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    mine = spark.conf.get(setting, None)
    numbers = stash(spark.range(10_000).repartition(8, "id"), "numbers")
    assert spark.conf.get(setting, None) == mine
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert numbers.count() == 10_000


def test_scratch_tables_go(spark, docs, scratch):
    kept = jaccard_join.keep_first(docs, shingle=5, threshold=80)
    assert scratch() == ["joined"]
    assert kept.count() == 11
    cut = suffix_dedup.cut_passages(docs, length=200)
    assert scratch() == ["joined", "marks"]
    left = {r.doc_id: r.text for r in cut.collect()}
    passage = words(0, 60)
    assert all(passage not in text for text in left.values())


def test_pipeline_leaves_the_last_tables(spark, docs, scratch, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, words(500, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = scratch()
    assert not {"sets", "sketches", "groups", "joined", "strings", "runs", "marks", "measures"} & set(left)
    assert packed.count() >= 0


def test_strings_alike_only_by_anchor(spark, monkeypatch):
    # Passages shorter than half of a window make strings with one anchor that share no window.
    short, long = words(7, 12), words(8, 60)
    texts = [f"{words(k, 60)} {short} {words(k + 50, 60)}" for k in range(10, 20)] + [f"{words(k, 60)} {long} {words(k + 50, 60)}" for k in (30, 31)]
    stored = {}

    def keep(df, label, **options):
        stored[label] = stash(df, label, **options)
        return stored[label]

    monkeypatch.setattr(suffix_dedup, "stash", keep)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("text_key", suffix_dedup.text_key())
    found = suffix_dedup.repeated_passages(docs, 200)
    assert {r.doc_id for r in found.collect()} == {10, 11}
    assert {r.doc_id for r in stored["strings"].collect()} == {10, 11}
