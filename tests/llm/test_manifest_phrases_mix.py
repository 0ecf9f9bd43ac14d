"""Merkle manifest, collocations and mixing against brute force and their SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import collocations, hat_trie, merkle, mixing, queries
from tests.check import compare

SF_DIR = "/root/testdata/sf0.001"
# Columns named like those the operators make.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, tree string, "
    "place long, size long, key string, rank long, phrase string, carried string"
)
EXTRA = ("t", 7, 7, "k", 7, "p", "c")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, a hot language."""
    rng = random.Random(11)
    pool = ["a", "b", "c", "Dd", "é", "f"]
    out = [
        (0, None, None, None, None),
        (None, "null id", "en", "s", 7),
        (None, "null id", "en", "s", 7),
        (1, "", "en", "s", 0),
        (2, " \t\n ", "", "", 3),
        (3, "one", "de", None, None),
        (3, "another with the same id", "de", "s", 4),
        (4, "x " * 20_000, "long", "long", 40_000),
    ]
    for i in range(5, 160):
        text = "".join(rng.choice(pool) + rng.choice("  \t .,\n") for _ in range(rng.randint(0, 60)))
        lang = rng.choice(["en", "en", "en", "de", None, "und"])
        out.append((i, text, lang, rng.choice(["s", "s", "s", "u", None, "é"]), len(text)))
    return [*out, *out[20:24], *out[20:22]]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    i, text, lang, source, n = row
    values = (i, source, lang, n, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return levels


def brute_audit(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    first = lambda v: (v is not None, v if v is not None else "")
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in names:
        trees[lang].sort(key=lambda r: ((r[0] is not None, r[0] or 0), leaf(r)))
        built[lang] = climb([leaf(r) for r in trees[lang]])
    assert first(None) < first("")
    top = climb([built[lang][-1][0] for lang in names])
    out = []
    for at_top, lang in enumerate(names):
        for place, row in enumerate(trees[lang]):
            claimed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                claimed = (*row[:4], row[4] + 1)
            digest, siblings = leaf(claimed), ""
            for levels, at in ((built[lang], place), (top, at_top)):
                for level in levels[:-1]:
                    pair = level[at - at % 2 : at - at % 2 + 2]
                    siblings += "".join(pair[:at % 2] + pair[at % 2 + 1 :])
                    pair[at % 2] = digest
                    digest, at = h(*pair), at // 2
            root = top[-1][0]
            subroot = built[lang][-1][0]
            out.append((row[0], leaf(row), subroot, root, h(siblings), digest, digest == root))
    return Counter(out)


@pytest.mark.parametrize("tier", [10, 2, 1])
def test_manifest(spark, rows, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    found = merkle.audited(frame(spark, rows))
    assert Counter(map(tuple, found.collect())) == brute_audit(rows)


@pytest.mark.parametrize("some", [slice(0, 0), slice(1, 2), slice(3, 5)])
def test_manifest_of_few_rows(spark, rows, some):
    found = merkle.audited(frame(spark, rows[some]))
    assert Counter(map(tuple, found.collect())) == (brute_audit(rows[some]) if rows[some] else {})


def test_proofs_of_some_leaves(spark, rows, monkeypatch):
    monkeypatch.setattr(merkle, "TIER", 3)
    manifest = merkle.build(frame(spark, rows))
    wanted = manifest.leaves.where("doc_id % 5 = 0")
    proofs = merkle.prove(manifest, wanted)
    good = merkle.folded(F.col("leaf"), F.col("siblings")) == F.col("root")
    assert proofs.count() == wanted.count() > 0
    assert proofs.where(~good).isEmpty()
    wrong = merkle.folded(F.sha2(F.lit("x").cast("binary"), 256), F.col("siblings"))
    assert proofs.where(wrong == F.col("root")).isEmpty()


def test_lacking_is_the_least_set():
    rng = random.Random(3)
    for n in [1, 2, 3, 7, 16, 21]:
        for _ in range(20):
            places = rng.sample(range(n), rng.randint(1, n))
            found = merkle.lacking(places, n)
            # Nodes over a wanted leaf are derived; of the rest, those whose parent is derived.
            sizes = [n]
            while sizes[-1] > 1:
                sizes.append((sizes[-1] + 1) // 2)
            over = {(level, p >> level) for p in places for level in range(len(sizes))}
            every = {(level, at) for level, size in enumerate(sizes) for at in range(size)}
            least = {c for c in every - over if (c[0] + 1, c[1] >> 1) in over}
            assert sorted(found) == sorted(least)


def brute_phrases(rows, least, top):
    counts = defaultdict(Counter)
    for _, text, lang, _, _ in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for length in (1, 2, 3):
                for at in range(len(words) - length + 1):
                    counts["und" if lang is None else lang][tuple(words[at : at + length])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            longer = [
                c
                for q, c in candidates.items()
                if len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= 50 * a
            ]
            if longer:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("entries, words, burst", [(10**6, 10**6, 4096), (50, 10**6, 4), (8, 3, 1)])
def test_collocations(spark, rows, monkeypatch, entries, words, burst):
    monkeypatch.setattr(collocations, "MOST_ENTRIES", entries)
    monkeypatch.setattr(collocations, "KEPT_ENTRIES", entries // 2)
    monkeypatch.setattr(collocations, "MOST_WORDS", words)
    monkeypatch.setattr(collocations, "AT_ONCE", 200 if burst < 4096 else 4 << 20)
    monkeypatch.setattr(hat_trie, "BURST", burst)
    found = collocations.mine(frame(spark, rows), top=12, least=3)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, 3, 12)


def test_collocations_of_nothing(spark, rows):
    assert collocations.mine(frame(spark, rows).where("false")).isEmpty()
    assert collocations.mine(frame(spark, [(1, None, None, None, None)])).isEmpty()


def test_a_full_filter_changes_nothing(spark, rows, monkeypatch):
    everything = collocations.Bloom(64, np.full(8, 255, np.uint8))
    monkeypatch.setattr(collocations, "bloom", lambda frequent: everything)
    found = collocations.mine(frame(spark, rows), top=12, least=3)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, 3, 12)


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_001
    make = lambda data: spark.createDataFrame(data, "lang string, phrase string, code long, count long")
    tables = [make([("en", "a", 1, big + 4), ("en", "b", 2, big + 9)]), make([("en", "a b", 3, big)])]
    got = collocations.scored(tables).first()
    assert got.score == 1_000_000 * big * big // ((big + 4) * (big + 9))


def test_trie_counts_and_spills(monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST", 5)
    rng, trie, want, got = random.Random(5), hat_trie.Node(3), Counter(), Counter()

    def spill(keep):
        for phrases, counts in trie.spilled(keep):
            assert len({p >> 2 * hat_trie.WORD_BITS for p in phrases.tolist()}) <= 1 or keep < 5
            got.update(dict(zip(phrases.tolist(), counts.tolist())))
        assert trie.entries <= keep

    for _ in range(60):
        some = Counter()
        for _ in range(40):
            ids = [min(rng.randint(1, 8), rng.randint(1, 8)) for _ in range(3)]
            some[ids[0] << 42 | ids[1] << 21 | ids[2]] += 1
        want += some
        phrases = np.array(sorted(some))
        trie.add(phrases, np.array([some[p] for p in sorted(some)]))
        assert trie.entries == len(set(trie.arrays()[0].tolist()))
        if trie.entries > 100:
            spill(50)
    spill(0)
    assert got == want


def brute_targets(sizes, weights, share, most):
    """Share out; what passes a limit stops there, and the rest is shared anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        own = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if own[s] > most * sizes[s]]
        if not above:
            return fixed | own
        fixed |= {s: Fraction(most * sizes[s]) for s in above}


@pytest.mark.parametrize("long", [True, False])
def test_mix(spark, rows, long):
    rows = [r for r in rows if long or r[0] != 4]
    docs = frame(spark, rows)
    found = mixing.mix(docs).collect()
    size_of = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], size_of(r[1])) for r in rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    goals = brute_targets(sizes, (3, 1, 2), Fraction(3, 2), 2)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == float(goals[r.source])
    assert taken == {s: int(goal) for s, goal in goals.items()}
    cut = Counter(r.source for r in found if r.size * r.passes < r.taken < r.size * (r.passes + 1))
    assert not cut or max(cut.values()) == 1
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    other = mixing.mix(docs, seed="other").collect()
    # One long text alone leaves the other sources whole, whatever their order.
    assert (Counter(map(tuple, other)) == Counter(map(tuple, found))) == long


def test_mixed_documents(spark, rows):
    docs = frame(spark, rows)
    out = mixing.mixed(docs)
    assert out.select("document.*").schema.names == docs.schema.names
    words = Counter()
    originals = Counter((r[0], r[1]) for r in rows)
    for r in out.collect():
        words[r.document.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.document.text))
        assert r.epoch in (1, 2)
        whole = (r.document.doc_id, r.document.text) in originals
        assert whole or r.document.text == " ".join(r.document.text.split())
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
    assert +words == +taken


@pytest.mark.parametrize("seed", range(8))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice(["a", "b", "é", "z", None, "", "q"]) : rng.choice([0, 1, 5, 1000, 10**12])
             for _ in range(rng.randint(1, 7))}
    goals = brute_targets(sizes, (3, 1, 2), Fraction(3, 2), 2)
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for r in mixing.targets(table).collect():
        assert r.target == float(goals[r.source])
        assert r.passes * r.source_size + r.cut == int(goals[r.source])


def test_mix_of_nothing(spark, rows):
    assert mixing.mix(frame(spark, rows).where("false")).isEmpty()
    empty = mixing.mix(frame(spark, [(1, None, None, None, None)])).collect()
    assert [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in empty] == [(1, 0, 0, 0.0, 0)]


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert compare(queries.QUERIES[key](spark, SF_DIR), con, queries.ORACLE_SQL[key]) is None


def test_mixing_is_native(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
