"""Components by stars: rounds only while there is something to link, and no broadcast of small tables in the rounds or when groups are gathered."""

import random

import pytest

from llm import components as stars
from llm import jaccard_join


@pytest.fixture
def plans(monkeypatch):
    """The final plans of what is stored."""
    found = []
    for module in (stars, jaccard_join):

        def seen(df, label, store=module.stash, **options):
            df.collect()
            found.append(df._jdf.queryExecution().executedPlan().toString())
            return store(df, label, **options)

        monkeypatch.setattr(module, "stash", seen)
    return found


def brute(links):
    nodes = {x for pair in links for x in pair if pair[0] != pair[1]}
    least = {x: x for x in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    return sorted(least.items())


def found(spark, links):
    return sorted(tuple(r) for r in stars.components(spark.createDataFrame(links, "a long, b long")).collect())


def test_components_equal_a_plain_search(spark):
    draw = random.Random(5)
    path = [(k, k + 1) for k in range(-20, 20)]
    draw.shuffle(path)
    for links in (path, [(draw.randrange(60), draw.randrange(60)) for _ in range(45)], [(7, 7)], [(3, 9), (9, 3), (5, 9), (5, 9)]):
        assert found(spark, links) == brute(links)


def test_links_that_are_components_take_no_round(spark, plans):
    links = [(k, k % 3) for k in range(40)] + [(50, 41)]
    assert found(spark, links) == brute(links)
    assert len(plans) == 1  # the links themselves


def test_rounds_broadcast_nothing(spark, plans):
    links = [(k, k + 1) for k in range(10)]
    assert found(spark, links) == brute(links)
    assert len(plans) > 1
    assert not any("Broadcast" in plan for plan in plans)


def test_gathering_groups_broadcasts_nothing(spark, plans):
    rows = [(g, 40, node, 50, node if node < 5 else 1000) for g in range(4) for node in range(40)]
    members = spark.createDataFrame(rows, "group long, members long, node long, size long, component long")
    assert jaccard_join.dealt(members).where("role = 0").count() == 40
    assert len(plans) == 3
    assert not any("Broadcast" in plan for plan in plans)
