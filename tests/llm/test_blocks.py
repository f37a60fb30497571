"""Large groups of the similarity join are compared without a row for each entry and block; passages move each text once."""

import random

import pytest
from test_training_data import brute_components, rows_of

from llm import jaccard_join, suffix_dedup


def near_copies(n, seed=3):
    """Copies of a few texts with words changed here and there, and others."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    bases = [[draw.choice(words) for _ in range(size)] for size in (60, 66, 150, 30)]
    rows = []
    for k in range(n):
        text = list(draw.choice(bases))
        for _ in range(draw.randrange(6)):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((k * 7 % 1009, " ".join(text[: len(text) - draw.randrange(3)])))
    rows += [(2000 + k, " ".join(draw.choices(words, k=50))) for k in range(20)]
    return rows


@pytest.mark.parametrize("nodes", [2048, 7])
def test_large_groups_lose_no_link(spark, monkeypatch, nodes):
    monkeypatch.setattr(jaccard_join, "RARE", 1)
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", nodes)
    rows = near_copies(130)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.join_similar(docs).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == sorted(brute_components(rows, 4, 85), key=repr)


def test_blocks_grow_with_the_nodes_outside_of_the_main_component(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 20)
    # 30 groups of the same 400 nodes, of which 5 aren't in the main component; one of other nodes; one of one component.
    rows = [(g, 400, node, 50, node if node < 5 else 1000) for g in range(30) for node in range(400)]
    rows += [(40, 50, 1000 + node, 50, node % 2) for node in range(50)] + [(50, 50, 2000 + node, 50, 7) for node in range(50)]
    members = spark.createDataFrame(rows, "group long, members long, node long, size long, component long")
    found = jaccard_join.dealt(members).collect()
    # A row for each node, for each asking one also one for each block of 20.
    near = [r for r in found if r.node < 400]
    assert len(near) == 400 + 5 * 20 and {r.node for r in near if r.asks} == set(range(5))
    assert len([r for r in found if 1000 <= r.node < 1050]) == 50 * 2 + 25 * 3
    assert not [r for r in found if r.node >= 2000]
    met = {(a.node, b.node) for a in near for b in near if (a.group, a.i, a.j) == (b.group, b.i, b.j) and a.role and not b.role}
    assert met == {(a, b) for a in range(5) for b in range(400)}


def test_texts_move_once_to_be_cut(spark):
    rows = [(k, " ".join(f"x{k}y{j}" for j in range(60)) + " common passage" * 20, "s") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = suffix_dedup.cut_passages(docs)
    # Runs go to the rows; no cut text is joined, made distinct or hashed on the way.
    assert "kept_sha256" not in cut._jdf.queryExecution().executedPlan().toString()
    assert all(len(r.text) < len(rows[r.doc_id][1]) for r in cut.collect())
