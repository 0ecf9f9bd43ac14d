"""The operators against brute force on small fixtures with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickstrata.llm import (
    common,
    decontamination,
    html_blocks,
    html_text,
    jaccard,
    pattern_packing,
    pii,
    quality,
    queries,
    sharding,
    substrings,
    token_output,
    tokens,
    toxicity,
)
from clickstrata.llm.best_fit import best_fit_decreasing
from clickstrata.llm.components import components
from clickstrata.llm.fm_index import FMIndex

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Columns named like those the operators make.
SCHEMA = "doc_id long, text string, score double, size long, kept boolean, row string"


def frame(spark, texts):
    rows = [(i, t, 0.5, 1, True, "r") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words_of(text):
    return WORDS.findall(text or "")


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and long texts, repeated rows, near copies, passages, personal data."""
    rng = random.Random(4)
    pool = [f"w{i}é" for i in range(400)]
    some = lambda n: [rng.choice(pool) for _ in range(n)]
    passage = some(90)
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two"), (None, "one two three")]
    out += [(5, "same text here now"), (5, "same text here now"), (6, "same text here now")]
    out += [(7, " ".join(some(9000))), (8, "a " * 300), (9, "a.\n" * 40)]
    for i in range(10, 60):
        words = some(rng.randint(0, 150))
        if rng.random() < 0.4:
            words[len(words) // 2 : len(words) // 2] = passage[rng.choice([0, 0, 20, 41]) :]
        out.append((i, " ".join(words)))
        if rng.random() < 0.4 and words:
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            out.append((i + 100, " ".join(near)))
    data = "mail a.b+c@mail.example.com, x@y, a@b.c_d@e.f 4111 1111 1111 1111 and 4111111111111112 "
    data += "1.2.3.4.5.6.7.8 256.1.1.1 +1 (555) 010-9999. +12 ++123456789 00.0.0.0 1 1 1 1 1 1"
    return [*out, (300, data), (301, "é" + data * 3), (302, "Call +49-30-1234567\nx")]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (20, 21), (30, 30), (22, 21), (22, 20)]
    links += [(i, i + 1) for i in range(100, 140)]
    found = dict(components(spark.createDataFrame(links, "x long, y long")).collect())
    assert found == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 22: 20} | dict.fromkeys(
        range(100, 141), 100
    )


def brute_repeats(texts):
    own = [(i, words_of(t)) for i, t in texts]
    first = {}
    for i, words in sorted((x for x in own if x[0] is not None), key=lambda x: x[0]):
        for at in range(len(words) - 49):
            first.setdefault(tuple(words[at : at + 50]), i)
    out = []
    for i, words in own:
        gone = set()
        for at in range(len(words) - 49):
            if i is not None and first[tuple(words[at : at + 50])] < i:
                gone.update(range(at, at + 50))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("very_common", [20_000, 2])
def test_substrings(spark, texts, very_common):
    found = substrings.removed(frame(spark, texts), very_common).drop("intervals")
    assert Counter(map(tuple, found.collect())) == brute_repeats(texts)


@pytest.mark.parametrize("very_common", [20_000, 2])
def test_substrings_of_one_passage_in_many_texts(spark, monkeypatch, very_common):
    search = substrings.repeats

    def once(shard):
        words = shard["words"].to_pylist()
        assert len(words) == len(set(words))
        return search(shard)

    monkeypatch.setattr(substrings, "repeats", once)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"own{i} {passage} end{i} " + f"q{i} " * 3 + passage) for i in range(40)]
    rows += [(7, f"other text {passage}"), (90, passage[:200])]
    found = substrings.removed(frame(spark, rows), very_common).drop("intervals")
    assert Counter(map(tuple, found.collect())) == brute_repeats(rows)


def test_fm_index_finds_every_pattern():
    rng = np.random.default_rng(0)
    text = np.concatenate([[0], rng.integers(1, 4, 300), [0], rng.integers(1, 3, 80), [0]])
    index = FMIndex(text, 6)
    for start in range(len(text) - 6):
        pattern = text[start : start + 6]
        if (pattern == 0).any():
            continue
        low, high = np.array([0]), np.array([index.n])
        for symbol in pattern[::-1]:
            low, high = index.extended(np.array([symbol]), low, high)
        at = sorted(index.suffixes[low[0] : high[0]])
        assert at == [i for i in range(len(text) - 5) if (text[i : i + 6] == pattern).all()]


def brute_links(texts):
    sets = {}
    for i, t in texts:
        words = words_of("".join(c.lower() if c.isascii() else c for c in t or ""))
        grams = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} or {tuple(words)} - {()}
        sets.setdefault(i, grams)
    group = {i: i for i in sets}
    ids = sorted(i for i in sets if i is not None)
    for _ in range(len(ids)):
        before = dict(group)
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
        if group == before:
            break
    return {i: (len(sets[i]), group[i]) for i in ids}


def test_jaccard(spark, texts):
    found = jaccard.linked(frame(spark, texts)).where("doc_id is not null")
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == brute_links(texts)
    kept = jaccard.representatives(frame(spark, texts))
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({g for _, g in brute_links(texts).values()})
    assert kept.columns == frame(spark, []).columns


@pytest.mark.parametrize("short", [16, 1])
def test_all_links_of_a_join(spark, texts, monkeypatch, short):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    rng = random.Random(8)
    words = [f"q{k}" for k in range(120)]
    rows = list(texts)
    for i in range(400, 430):
        own = list(words)
        for _ in range(rng.choice([0, 0, 1, 2])):
            own[rng.randrange(120)] = f"z{rng.random()}"
        rows.append((i, " ".join(own)))
    sets = []
    for _, t in rows:
        own = words_of("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(own[k : k + 3]) for k in range(len(own) - 2)} or {tuple(own)} - {()})
    wanted = Counter()
    for a, (i, _) in enumerate(rows):
        linked = [
            b for b in range(len(rows))
            if b != a and sets[a] and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])
        ]
        wanted[i, len(sets[a]), len(linked)] += 1
    found = jaccard.link_counts(frame(spark, rows)).drop("class").collect()
    assert Counter(map(tuple, found)) == wanted and max(r.n_links for r in found) > 5


def test_jaccard_links_through_a_null_id(spark):
    words = [f"j{k}" for k in range(100)]
    change = lambda *at: " ".join("changed" if k in at else w for k, w in enumerate(words))
    # The first and the third are linked through the second only.
    texts = [change(), change(20), change(20, 70)]
    for ids in ([1, None, 3], [3, None, 1], [None, 1, 3], [None, None, None]):
        rows = [*zip(ids, texts), (9, "something else"), (None, "something else"), (None, None)]
        found = jaccard.linked(frame(spark, rows), jaccard.Rule(3, 9, 10)).collect()
        least = min((i for i in ids if i is not None), default=None)
        wanted = [(i, 98, least) for i in ids] + [(9, 1, 9), (None, 1, 9), (None, 0, None)]
        assert Counter(map(tuple, found)) == Counter(wanted)
    assert jaccard.representatives(frame(spark, [(1, texts[0]), (None, texts[1])])).count() == 2


def test_jaccard_of_a_family_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"b{i}" for i in range(200)]
    family = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.choice([0, 1, 3, 4, 5])):
            words[rng.randrange(200)] = f"x{rng.random()}"
        family.append((i, " ".join(words)))
    found = {r[0]: (r[1], r[2]) for r in jaccard.linked(frame(spark, family)).collect()}
    assert found == brute_links(family)


@pytest.mark.parametrize("size", [(3, 40), (90, 110)])
def test_jaccard_by_five_words(spark, size):
    rng = random.Random(5)
    rows = []
    for i in range(90):
        words = [f"f{i % 4}_{k}" for k in range(rng.randint(*size))]
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"y{rng.random()}"
        rows.append((i, " ".join(words)))
    sets = {}
    for i, text in rows:
        words = words_of(text)
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    found = jaccard.linked(frame(spark, rows), jaccard.Rule(5, 8, 10)).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == {i: (len(sets[i]), group[i]) for i in sets}


def test_near_copies_of_the_pipeline(spark):
    import corpus_pipeline

    words = [f"n{k}" for k in range(100)]
    near = [*words[:30], "changed", *words[31:70], "too", *words[71:]]
    docs = frame(spark, [(1, " ".join(words)), (2, " ".join(near)), (3, "some other text of words")])
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def test_small_results_of_the_search_are_few_files(spark):
    words = [f"n{k}" for k in range(100)]
    rows = [(i, " ".join([*words[:40], f"c{i}", *words[41:]])) for i in range(12)]
    rows += [(20 + i, f"text {i} of its own") for i in range(30)]
    docs = frame(spark, rows).repartition(24)
    search = jaccard.searched(docs, jaccard.Rule(5, 8, 10))
    assert search.own.count() == len(rows) and search.likely.count() == 66
    assert len(search.own.inputFiles()) == len(search.likely.inputFiles()) == 1
    spread = spark.range(1000).repartition(24)
    assert len(common.store(spread, "spread").inputFiles()) == 24
    few = common.store(spread, "few", few=True)
    assert len(few.inputFiles()) == 1
    assert sorted(r.id for r in few.collect()) == list(range(1000))


def test_short_sets_by_subsets(spark):
    rng = random.Random(8)
    short = []
    for i in range(60):
        words = [f"s{k}" for k in range(rng.randint(10, 26))]
        if rng.random() < 0.6:
            words[rng.choice([0, -1])] = f"z{rng.randint(0, 2)}"
        short.append((i, " ".join(words)))
    found = {r[0]: (r[1], r[2]) for r in jaccard.linked(frame(spark, short)).collect()}
    assert found == brute_links(short)


def plain(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return words_of(re.sub(r"[^0-9a-z\x80-\U0010ffff\x20\x09-\x0d]", "", lowered))


def test_decontamination(spark, texts):
    items = [(1, None), (2, ""), (3, "One two!"), (4, " ".join(words_of(texts[20][1])[:14]))]
    long = next(t for _, t in texts if t and len(words_of(t)) > 120 and "w" in t)
    items += [(5, " ".join(words_of(long)[40:90])), (5, " ".join(words_of(long)[40:90]))]
    items += [(6, " ".join(words_of(long)[20:60] + ["other", "words", "here"]))]
    found = decontamination.contaminated(
        frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    )
    wanted = Counter()
    for item, text in items:
        words = plain(text)
        n = min(5, len(words))
        grams = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
        for i, t in texts:
            own = plain(t)
            has = len(grams & {tuple(own[k : k + n]) for k in range(len(own) - n + 1)})
            if grams and 10 * has >= 8 * len(grams):
                wanted[i, item, len(grams), has] += 1
    rows = found.collect()
    assert len(rows) > 4 and Counter(tuple(r)[:4] for r in rows) == wanted
    held = {r.doc_id for r in rows}
    kept = decontamination.clean(
        frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    )
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        i for i, _ in texts if i not in held
    )


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", m)] * all(int(p) <= 255 for p in m.group().split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        out += [("card", m)] * (13 <= len(digits) <= 19 and luhn(digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", m)] * (9 <= len(re.sub("[^0-9]", "", m.group())) <= 15)
    return [(kind, m.start(), m.end()) for kind, m in out]


def test_pii(spark, texts):
    rng = random.Random(1)
    odd = ["".join(rng.choices("a@.1 9+-()5x%", k=60)) for _ in range(150)]
    rows = [*texts, *((1000 + i, t) for i, t in enumerate(odd))]
    found = pii.detect(frame(spark, rows))
    names = found.select("doc_id", pii.as_text("base").alias("b"), pii.as_text("spans").alias("s"))
    wanted = Counter(
        (i, ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t or ""))) for i, t in rows
    )
    got = names.collect()
    assert Counter((r.doc_id, r.b) for r in got) == wanted
    assert all(set(r.b.split(",")) <= set(r.s.split(",")) or not r.b for r in got)
    masked = {r.doc_id: r.text for r in pii.redacted(frame(spark, texts)).collect()}
    assert masked[302] == "Call [phone]\nx" and masked[0] is None
    assert "@mail.example.com" not in masked[301]


def test_pii_adds_what_base_forms_lack(spark):
    planted = [
        ("email", "write to {} for more", f"name{c} (at) host{c} (dot) co (dot) uk") for c in "abcdef"
    ]
    planted += [("phone", "please call {} today", f"030 12{n}4567") for n in range(5)]
    planted += [("phone", "at {} or later", f"(555) 01{n}-9999") for n in range(5)]
    other = [
        "order #1234567{}", "since 2024-01-1{} here", "a ratio of 3.1415926{} or so", "AB12345678{}",
        "look @ this{}. Then go", "run 411111111111111{}",
    ]
    rows, wanted = [], {}
    for at, (kind, around, value) in enumerate(planted):
        start = around.index("{}")
        rows.append((at, around.format(value)))
        wanted[at] = f"{kind}:{start}:{start + len(value)}"
    rows += [(100 + i, text.format(2 + i % 3)) for i, text in enumerate(other * 3)]
    # Few certain spans: one added for 99 of them would be none.
    rows += [(200 + i, f"mail a{i}@b.org or +49 30 123456{i} now") for i in range(5)]
    found = pii.detect(frame(spark, rows)).select("doc_id", pii.as_text("spans").alias("s"))
    got = {r.doc_id: r.s for r in found.collect()}
    assert {i: s for i, s in got.items() if i < 100} == wanted
    assert not any(s for i, s in got.items() if 100 <= i < 200)
    two = frame(spark, [(1, "pay 7536784127813050 4845168114407329 now")])
    assert pii.detect(two).select(pii.as_text("spans")).first()[0] == "card:4:20,card:21:37"


def brute_repeat_words(words):
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    gone = set()
    for k in range(len(words) - 7):
        if grams[tuple(words[k : k + 8])] > 1:
            gone.update(range(k, k + 8))
    return len(gone)


def test_quality(spark, texts):
    wanted = []
    for i, t in texts:
        words, lines = words_of(t), [x for x in (t or "").split("\n") if words_of(x)]
        n = brute_repeat_words(words)
        failed = len(words) < 20 or 100 * n > 30 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        wanted.append((i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), n, failed))
    found = quality.assess(frame(spark, texts)).collect()
    assert Counter(tuple(r)[:7] for r in found) == Counter(wanted)
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_lines(spark):
    prose = "This is a plain sentence with enough words to be kept as it is.\n" \
        "Here another line follows that says something else about the matter at hand.\n"
    menu = "Home | About | Products | Contact | Search | Help | Login | More\n" * 1
    rows = [(1, prose), (2, prose + "All rights reserved.\n"), (3, menu * 3 + "x y z.")]
    found = {r.doc_id: r for r in quality.assess(frame(spark, rows)).collect()}
    assert found[1].kept and found[1].cleaned == prose.strip()
    assert found[2].kept and "reserved" not in found[2].cleaned
    assert not found[3].kept


def test_sharding(spark, texts):
    rows = sharding.shard(frame(spark, texts), 7).collect()
    assert len(rows) == len(texts)
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )


def test_slot_maps():
    sizes = [(i * 7919) % 101 for i in range(800)]
    first = sharding.first_map(sizes, 8)
    load = Counter()
    for size, shard in zip(sizes, first):
        load[shard] += size
    assert max(load.values()) - min(load.values()) <= 101
    grown = sharding.rebalanced(first, sizes, 9)
    moved = [s for s in range(800) if grown[s] != first[s]]
    assert {grown[s] for s in moved} == {8} and len(moved) < 200
    again = Counter()
    for size, shard in zip(sizes, grown):
        again[shard] += max(size, 1)
    assert max(again.values()) <= 1.05 * sum(sizes) / 9


def test_map_versions(spark, tmp_path):
    for version in (1, 2):
        placed = [version] * 4
        sharding.store_map(sharding.map_frame(spark, placed, [1, 0, 2, 1], version), str(tmp_path / "m"))
    latest = sharding.read_map(spark, str(tmp_path / "m")).orderBy("virtual_slot").collect()
    assert [(r.shard, r.first_place) for r in latest] == [(2, 0), (2, 1), (2, 1), (2, 3)]
    assert sharding.read_map(spark, str(tmp_path / "m"), 1).first().shard == 1


def test_sharding_again_edits_the_map(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    folder = str(tmp_path / "map")
    dealt = []
    for shards in (40, 40, 41):
        rows = sharding.shard(docs, shards, folder).collect()
        assert len(rows) == docs.count()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
        places = defaultdict(list)
        for r in rows:
            places[r.shard].append(r.slot)
        assert all(sorted(own) == list(range(len(own))) for own in places.values())
        dealt.append({r.doc_id: r.shard for r in rows})
    assert sharding.read_map(spark, folder).first().version == 3
    moved = {i for i in dealt[0] if dealt[1][i] != dealt[2][i]}
    assert moved and {dealt[2][i] for i in moved} == {40}
    with pytest.raises(Exception, match="exists"):
        sharding.store_map(sharding.map_frame(spark, [0], [0], 3), folder)
    with pytest.raises(ValueError, match="more than 40"):
        sharding.shard(docs, 40, folder)


def test_shards_have_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.where("doc_id < 500").withColumn("text", F.lit("the same text " * 30))
    rows = sharding.shard(docs.unionAll(hot), 40).groupBy("shard").agg(F.sum("size"))
    sizes = [r[1] for r in rows.collect()]
    assert len(sizes) == 40
    # A document is at most 34 KB here.
    assert max(sizes) - min(sizes) <= 34_000


def test_token_ids_are_the_tokenizers(texts):
    coder = tokens.WordIds()
    rng = random.Random(3)
    odd = "aZzéÉßÿ×'’stvre019%&$#<|>.,-~ ́ẞİΣσςﬁ中😀\x1c\x7f\n"
    rows = [t or "" for _, t in texts] + ["".join(rng.choices(odd, k=200)) for _ in range(200)]
    for text, ids in zip(rows, coder.encode(rows)):
        wanted = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted


def test_special_strings_and_other_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "<|ENDOFTEXT|>", "<|endo ftext|>",
            "é<|endoftext|>é it<|endoftext|>'s", "<|endoftext|<|endoftext|>|>"]
    for text, ids in zip(rows, tokens.WordIds(special=True).encode(rows)):
        wanted = untouched.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted
    plain = np.frombuffer(tokens.WordIds().encode(rows[:1])[0], "<u4")
    assert 49407 not in plain and len(plain) > 1
    with pytest.raises(ValueError, match="white space"):
        tokens.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_packing_gives_the_tokenizers_ids(spark):
    rows = [(1, "x <|endoftext|> y"), (2, "<|endoftext|>"), (3, None)]
    found = {r.doc_id: r for r in pattern_packing.pack(frame(spark, rows)).collect()}
    assert [found[i].length for i in (1, 2, 3)] == [4, 2, 1]
    assert found[2].ids_crc32 == zlib.crc32(np.array([49407, 1], "<u4").tobytes())


def all_ids(texts, end):
    coder = tokens.WordIds()
    return [
        (i, np.frombuffer(ids, "<u4").tolist() + [end])
        for (i, _), ids in zip(texts, coder.encode([t or "" for _, t in texts]))
    ]


def test_token_output_round_trip(spark, texts):
    rows = token_output.pack(frame(spark, texts), block_tokens=30_000).collect()
    found = defaultdict(list)
    for r in rows:
        assert r.cu_seqlens[-1] == r.n_tokens <= 4096 and r.position_resets == r.cu_seqlens[:-1]
        for (i, start, ids), piece in zip(token_output.unpacked(r), r.pieces):
            found[i].append((piece, start, tuple(ids.tolist())))
    wanted = defaultdict(list)
    for i, ids in all_ids(texts, token_output.END_ID):
        for piece, start in enumerate(range(0, len(ids), 4096)):
            wanted[i].append((piece, start, tuple(ids[start : start + 4096])))
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(x) for i, x in wanted.items()}
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_token_files_round_trip(spark, texts, tmp_path):
    packed = token_output.pack(frame(spark, texts), block_tokens=30_000)
    folder = f"file://{tmp_path}/files"
    manifest = token_output.write(packed, folder).collect()
    found = Counter()
    for entry in manifest:
        rows = token_output.read_block(folder, entry)
        assert len(rows) == entry.rows and entry.id_bytes == 2
        for ids, lengths, resets in rows:
            assert lengths[:-1].tolist() == resets.tolist()
            found.update(tuple(ids[a:b].tolist()) for a, b in zip(lengths, lengths[1:]))
    wanted = Counter()
    for _, ids in all_ids(texts, token_output.END_ID):
        wanted.update(tuple(ids[at : at + 4096]) for at in range(0, len(ids), 4096))
    assert found == wanted
    assert sum(e.n_tokens for e in manifest) == sum(map(len, wanted.elements()))
    broken = next((tmp_path / "files").glob("*.ids.bin"))
    broken.write_bytes(b"x" + broken.read_bytes()[1:])
    entry = next(e for e in manifest if e.file in broken.name)
    with pytest.raises(ValueError, match="not what was written"):
        token_output.read_block(folder, entry)
    assert token_output.write(packed.where("false"), f"file://{tmp_path}/none").isEmpty()


def test_pattern_packing(spark, texts):
    rows = pattern_packing.pack(frame(spark, texts)).collect()
    wanted, total = [], 0
    for i, ids in all_ids(texts, pattern_packing.END_ID):
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[start : start + 4096], "<u4").tobytes()
            wanted.append((i, piece, start, len(own) // 4, zlib.crc32(own)))
    assert Counter(tuple(r)[:5] for r in rows) == Counter(wanted)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= 1.1 * total / 4096 + 1


@pytest.mark.parametrize("n", [0, 1, 20, 3000])
def test_plans_place_everything(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(4096, rng.lognormal(6.5, 1.2, n).astype(int) + 1)
    plan = pattern_packing.planned(Counter(lengths.tolist()))
    assert not any(plan.left.values())
    load, ranks = Counter(), defaultdict(list)
    for length, low, high, first, each in plan.rows:
        ranks[length] += range(low, high)
        for k in range(high - low):
            load[first + k // each] += length
    assert all(v <= 4096 for v in load.values()) and len(load) == plan.sequences
    assert {x: len(r) for x, r in ranks.items()} == Counter(lengths.tolist())
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    assert plan.sequences <= lengths.sum() / 4096 * 1.03 + 1


def test_best_fit_decreasing_takes_the_tightest_room():
    assert best_fit_decreasing([6, 5, 5, 4, 3, 2], 10) == [[0, 3], [1, 2], [4, 5]]
    assert best_fit_decreasing([], 10) == []


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
<nav><a href="/">Home</a></nav><article><h1>Big &amp; small</h1><p><b>First   part.<br>goes
on<p>Second &lt;one&gt; &#233;.</article><script>var x="</p>";</script>
<footer>&copy; me</footer></body></html>"""


def test_blocks():
    found = [(b.clean, b.path[-1]) for b in html_blocks.blocks(PAGE)]
    assert found == [
        ("Home", "a"), ("Big & small", "h1"), ("First part. goes on", "b"),
        ("Second <one> é.", "p"), ("© me", "footer"),
    ][:0] or [t for t, _ in found] == [
        "Home", "Big & small", "First part. goes on", "Second <one> é.", "© me",
    ]
    for odd in ("", "<", "<<p", "a<p class='x", "</p></p>", "<!-- x", "<p" * 50, "<script>x"):
        html_blocks.blocks(odd)


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ('<p>One.</p><p>See <svg class="i" /> this</p><p>Two three.</p>',
         ["One.", "See this", "Two three."]),
        ('<p>One <svg class="i"><path d="M0 0"/><title>Icon</title></svg>two</p>', ["One two"]),
        ("<p>One <svg class=i>two</p><p>Three <svg><text>no</text></svg>four</p>",
         ["One", "Three four"]),
        ("<p title=it's>One</p><p>Don't</p>", ["One", "Don't"]),
        ("<p title='a>b' class=\"c>d\" 'odd\">One</p><p>Two</p>", ["One", "Two"]),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>", ["Let x=2 be"]),
        ("<p>See <object data=x.pdf>the file</object>.</p>", ["See the file."]),
        ("<figure><img src=x><figcaption>A caption</figcaption></figure><p>One",
         ["A caption", "One"]),
    ],
)
def test_html_blocks_lose_no_text(page, wanted):
    assert [b.clean for b in html_blocks.blocks(page)] == wanted


def test_captions_and_names_of_the_whole_page():
    page = '<body class="no-sidebar has-footer"><article class="post search"><p>One two</p>'
    page += "<figure><figcaption>A caption</figcaption></figure></article><footer>me</footer></body>"
    assert html_text.looked_at(html_blocks.blocks(page)).tolist() == [1, 1, 0]


def test_html_sample_is_of_different_pages(spark, monkeypatch):
    pages = [f"<article><p>{k} text</p></article>" for k in range(5)]
    rows = [(k, "u", pages[0] if k < 50 else pages[k % 5]) for k in range(60)]
    seen = []
    monkeypatch.setattr(html_text, "fit", seen.extend)
    html_text.train(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(seen) == pages


def test_slopes_of_the_network_are_its_gradient():
    from clickstrata.llm.lstm import Batch, BiLstm

    rng = np.random.default_rng(1)
    network = BiLstm(3, 2)
    batch = Batch.of([rng.normal(size=(n, 3)) for n in (4, 1, 2)])
    labels = rng.integers(0, 2, 7).astype(float)

    def loss():
        p = network.probabilities(batch)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, slope in network.slopes(batch, labels).items():
        weights = network.weights[name]
        for at in np.ndindex(weights.shape):
            before = weights[at]
            weights[at] = before + 1e-6
            high = loss()
            weights[at] = before - 1e-6
            assert slope[at] == pytest.approx((high - loss()) / 2e-6, abs=1e-7)
            weights[at] = before


def test_html_text(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    network = html_text.train(pages)
    rows = [(1, "u", None), (2, "u", ""), (2, "u", PAGE), (None, None, PAGE)]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = Counter(tuple(r) for r in html_text.extracted(odd, network).collect())
    text = "Big & small\nFirst part. goes on\nSecond <one> é."
    assert found == Counter([(1, "u", ""), (2, "u", ""), (2, "u", text), (None, None, text)])
    own = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.extracted(pages, network).collect():
        inner = re.search(r"<article>(.*)</article>", own[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        plain_parts = [" ".join(re.sub("<[^>]*>", "", p).split()) for p in parts]
        import html

        assert r.text == "\n".join(html.unescape(p) for p in plain_parts if p)


def test_html_text_of_other_layouts(spark):
    network = html_text.train(spark.read.parquet(f"{SF_DIR}/pages.parquet"))
    long = "This is one long sentence of the article that the page is about. " * 3
    page = (
        "<html><body><header><p>Site of things</p></header><main><h1>Title here</h1>"
        f"<p>{long}</p><p>{long}</p></main><aside class='sidebar'><p>Also see this</p></aside>"
        "<section id='comments'><div class='comment'><p>I liked it</p></div></section>"
        "<form><label>Your name</label></form></body></html>"
    )
    assert html_text.texts(network, [page])[0].split("\n") == ["Title here", long.strip(), long.strip()]


def test_toxicity(spark):
    rng = random.Random(6)
    plain_words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu") for b in ("ra", "so", "vi", "pe")]
    docs, labels = [(9000, None), (9001, ""), (9001, "Badword!"), (None, "kara")], [(9000, 1), (1, None)]
    for i in range(600):
        words = rng.choices(plain_words, k=rng.randint(5, 60))
        if i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Badword,", "badling"]))
        docs.append((i, ". ".join([" ".join(words[:9]), " ".join(words[9:])])))
        labels.append((i, int(i % 5 == 0)))
    table = frame(spark, docs)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    field = toxicity.train(table, marks)
    rows = toxicity.scored(table, field).withColumn("held", toxicity.held_out()).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in docs)
    text_of = dict(d for d in docs if d[0] is not None and d[0] < 9000)
    for r in rows:
        if r.doc_id is not None and r.doc_id < 9000:
            assert (r.score >= 0.5) == (r.doc_id % 5 == 0)
            spans = [text_of[r.doc_id][s.start : s.end].lower() for s in r.spans]
            assert all("bad" in s for s in spans)
            assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = toxicity.clean(table, field)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id and r.doc_id < 9000} == set(
        i for i in range(1, 600) if i % 5
    )
    assert toxicity.train(table, marks.where("toxic = 0")) is None
    assert toxicity.scored(table, None).agg(F.max("score")).first()[0] == 0


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    empty = [
        substrings.removed(none), jaccard.linked(none), jaccard.representatives(none),
        sharding.shard(none, 4), token_output.pack(none), pattern_packing.pack(none),
        pii.detect(none), pii.redacted(none), quality.assess(none), toxicity.scored(none, None),
        decontamination.contaminated(none, items),
        html_text.extracted(pages, html_text.train(pages)),
    ]
    assert [x.count() for x in empty] == [0] * len(empty)
    some = frame(spark, [(1, "a b c d e f")])
    assert decontamination.contaminated(some, items).count() == 0
    assert decontamination.clean(some, items).count() == 1


def test_registered_queries_keep_every_document(spark):
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name in ("op1_toxicity", "op3_substrings", "op4_sharding", "op6_quality", "op8_pii", "op9_jaccard"):
        assert queries.QUERIES[name](spark, SF_DIR).count() == n, name


def test_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.op8_pii(spark, SF_DIR).collect():
        spans = base_spans(docs[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.n_email == sum(k == "email" for k, _, _ in spans)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        left = docs.count()
        assert 0 < left <= n, name
        n = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == n


def test_pipeline_of_awkward_rows(spark, tmp_path):
    """Null ids and columns, repeated rows, rows that share an id, long and empty texts."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rng = random.Random(6)
    words = lambda n: " ".join(f"p{rng.randrange(10**6)}" for _ in range(n))
    same, long = words(40), words(20_000)
    rows = [
        (None, words(30), None, None, None),
        (None, words(30), "en", "s", 1),
        (None, None, None, None, None),
        (10**6, None, "en", "s", 0),
        (10**6 + 1, "", "en", "s", 0),
        (10**6 + 2, same, "en", "s", 1),
        (10**6 + 2, same, "en", "s", 1),
        (10**6 + 3, same, None, None, 2),
        (10**6 + 4, words(30), "en", "s", 1),
        (10**6 + 4, words(31), "en", "s", 1),
        (10**6 + 5, long, "en", "s", len(long)),
        (10**6 + 6, f"{words(5)} {item} {words(5)}", "en", "s", 1),
        (10**6 + 7, f"{words(20)} mail a.b@mail.example.com {words(20)}", "en", "s", 1),
    ]
    odd = spark.createDataFrame(rows, docs.schema)
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = Counter(r.doc_id for r in packed if r.doc_id is None or r.doc_id >= 10**6)
    # Null ids all stay; of equal texts and of rows with one id one does; the test item goes.
    kept = {None: 3, 10**6: 1, 10**6 + 1: 1, 10**6 + 2: 1, 10**6 + 4: 1, 10**6 + 7: 1}
    assert {i: n for i, n in pieces.items() if i != 10**6 + 5} == kept
    assert pieces[10**6 + 5] > 10


def test_words_used_lately_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    coder, encoded = tokens.WordIds(special=True), []
    whole = coder._encoded
    coder._encoded = lambda word: encoded.append(word) or whole(word)
    often = "the common words"
    wanted = coder.encode([often])
    for at in range(20):
        assert coder.encode([" ".join(f"rare{at}x{n}" for n in range(40)), often])[1:] == wanted
        assert len(coder) <= 50 + 43 and len(coder.earlier) <= 50 + 43
    assert encoded.count(b"common") == 1


def test_texts_become_strings_a_few_rows_at_once(monkeypatch):
    monkeypatch.setattr(tokens, "ROWS_AT_ONCE", 3)
    rows = ["a", None, "bb", "", "cccc", "d", "e", None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(rows, pa.string())})
    found = list(tokens.slices(batch, at_once=3))
    assert found == [(0, ["a", "", "bb"]), (3, ["", "cccc"]), (5, ["d", "e", ""])]
    assert list(tokens.slices(batch.slice(0, 0))) == []


def test_rows_go_to_python_in_batches_of_bounded_size(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes])})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    common.small_batches(spark)
    try:
        texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('x', 5000) AS text")
        found = [row.bytes for row in texts.mapInArrow(sizes, "bytes long").collect()]
        assert len(found) > 3 and max(found) < 6 << 20
    finally:
        spark.conf.unset(key)
