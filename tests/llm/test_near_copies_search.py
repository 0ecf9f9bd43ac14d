"""The search for similar documents: what it looks up, and how much it writes."""

import random

import numpy as np
import pyarrow as pa
import pytest

from clickstrata.llm import components as components_module
from clickstrata.llm import jaccard
from clickstrata.llm.components import components
from clickstrata.llm.wordtable import texts_of
from clickstrata.session import overridden

NEAR = jaccard.Rule(5, 8, 10)


def sets_of(texts, rule):
    [run] = texts_of(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]))
    return jaccard.Sets(run, rule)


@pytest.mark.parametrize("rule", [jaccard.RULE, NEAR])
def test_linked_sets_share_two_lists(rule):
    rng = random.Random(7)
    for _ in range(150):
        words = [f"w{k}" for k in range(rng.randint(30, 400))]
        other = list(words)
        for _ in range(rng.randint(1, 8)):
            other[rng.randrange(len(other))] = f"x{rng.random()}"
        sets = sets_of([" ".join(words), " ".join(other[: rng.randint(len(other) - 4, len(other))])], rule)
        a, b = (set(sets.hashes[sets.rows == k].tolist()) for k in (0, 1))
        if a != b and rule.base * len(a & b) >= rule.top * len(a | b):
            rows, keys = jaccard.list_keys(sets, np.arange(2), rule)
            assert len(set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())) >= 2


def test_pairs_of_one_list_are_no_candidates(spark):
    # Pairs (1, 2) and (3, 4) meet in one list, (5, 6) in two, (7, 8) by a subset.
    mark = jaccard.MARK
    lists = {4 * mark: [1, 2], 6 * mark: [3, 4], 8 * mark: [5, 6], 10 * mark: [6, 5], 13 * mark: [7, 8]}
    rows = [(key, x) for key, members in lists.items() for x in members]
    found = jaccard.candidates(spark.createDataFrame(rows, "key long, print long"))
    assert {tuple(r) for r in jaccard.sharing(found).collect()} == {(5, 6), (7, 8)}
    assert {r.key for r in found.collect()} == {0, mark}


def test_components_of_few_links_are_few_files(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 900), rng.randint(0, 900)) for _ in range(500)]
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with overridden(spark, settings):
        found = components(spark.createDataFrame(links, "x long, y long").repartition(24))
        assert len(found.inputFiles()) == 1
    least = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert dict(map(tuple, found.collect())) == least


def test_components_by_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(components_module, "BROADCAST_LINKS", 0)
    links = [(i, i + 1) for i in range(60)] + [(80, 70), (75, 80), (80, 90)]
    found = components(spark.createDataFrame(links, "x long, y long"))
    assert dict(map(tuple, found.collect())) == dict.fromkeys(range(61), 0) | dict.fromkeys((70, 75, 80, 90), 70)


def settled_pairs(spark, rows, components_of=()):
    """What is compared of the members (key, x) of long lists, where no summary tells sets apart."""
    known = [(x, 30, bytes(jaccard.BUCKETS)) for x in sorted({x for _, x in rows})]
    known = spark.createDataFrame(known, "print long, n long, summary binary")
    search = jaccard.Found(None, known.select("print", "n"), None, None, known, None, None, len(rows))
    members = spark.createDataFrame(rows, "key long, x long")
    named = spark.createDataFrame(list(components_of), "node long, component long")
    found = [tuple(r) for r in jaccard.settled(members, named, search, NEAR).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_members_of_one_long_list_are_not_compared(spark):
    # A passage's list holds all sets, and those of a pair or of a group meet in one more list.
    mark = jaccard.MARK
    rows = [(2 * mark, x) for x in range(300)]
    rows += [(4 * mark, x) for x in (5, 6)] + [(6 * mark, x) for x in range(100, 140)]
    rows += [(8 * mark, x) for x in range(300, 360)]
    pairs = {(5, 6)} | {(x, y) for y in range(100, 140) for x in range(100, y)}
    assert settled_pairs(spark, rows) == pairs


@pytest.mark.parametrize("narrow, cost", [(16, 4), (3, 4), (16, 0), (3, 1e9), (0, 4)])
def test_members_of_two_long_lists_are_compared(spark, monkeypatch, narrow, cost):
    monkeypatch.setattr(jaccard, "NARROW", narrow)
    monkeypatch.setattr(jaccard, "PAIR_COST", cost)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    monkeypatch.setattr(jaccard, "SHORT_LIST", 4)
    rng = random.Random(11)
    lists = {2 * k * jaccard.MARK: set(rng.sample(range(120), 12)) for k in range(1, 40)}
    lists |= {2 * k * jaccard.MARK: set(range(20)) | {30 + k} for k in range(40, 48)}
    by_subset = {(2 * k + 1) * jaccard.MARK: set(rng.sample(range(120), 6)) for k in range(1, 4)}
    named = {x: x % 7 for x in range(0, 120, 3)}
    shared = {}
    for key, members in (lists | by_subset).items():
        for x in members:
            for y in members:
                if x < y and named.get(x, x + 1000) != named.get(y, y + 1000):
                    shared[x, y] = shared.get((x, y), 0) + (2 if key in by_subset else 1)
    rows = [(key, x) for key, members in (lists | by_subset).items() for x in members]
    # Components are named by the least of them.
    least = {c: min(x for x in named if named[x] == c) for c in set(named.values())}
    found = settled_pairs(spark, rows, [(x, least[c]) for x, c in named.items()])
    assert {pair for pair, n in shared.items() if n >= 2} <= found
    assert not any(x in named and y in named and named[x] == named[y] for x, y in found)


@pytest.mark.parametrize("rule", [jaccard.RULE, NEAR])
def test_linked_sets_share_two_short_or_two_long_lists(rule):
    rng = random.Random(8)
    for _ in range(100):
        words = [f"w{k}" for k in range(rng.randint(30, 400))]
        other = list(words)
        for _ in range(rng.randint(1, 8)):
            other[rng.randrange(len(other))] = f"x{rng.random()}"
        sets = sets_of([" ".join(words), " ".join(other)], rule)
        a, b = (set(sets.hashes[sets.rows == k].tolist()) for k in (0, 1))
        if a != b and rule.base * len(a & b) >= rule.top * len(a | b):
            rows, keys = jaccard.list_keys(sets, np.arange(2), rule)
            both = set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())
            assert len(both) >= 2 * jaccard.OF_A_KIND - 1
