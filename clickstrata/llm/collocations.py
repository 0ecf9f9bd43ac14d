"""Phrases whose words occur together more than by chance, by HAT-trie counting.

Phrases of one, two and three words are counted in three passes over the texts. A task
counts in a HAT-trie over its own word ids (``hat_trie``). When the trie holds too many
phrases, whole subtrees leave it, largest first, each as a run sorted by its words; what
is left is spilled at the end. Runs are dealt by prefix (language and first word, a
crowded prefix further by a hash of the whole phrase) and merged there into exact counts.

A phrase with fewer than the least count has no place in the result, and neither has any
longer one that holds it. So the second pass skips phrases with a rare word, the third
those with a rare pair. Tasks know the frequent ones by a Bloom filter of bounded size: a
rare phrase that passes it is counted for nothing, a frequent one is never skipped. Where
the filter is too small for a vocabulary it skips less; counts stay exact.

A cut of a candidate into two parts scores a * a / (l * r), a, l and r being the counts of
the candidate and its parts; its lowest score counts. Numbers are decimals of 38 digits,
quotients whole. Candidates held by a longer one at least half as frequent are dropped.

Defined results: letters A-Z are lower-cased, marks and line ends split a text into
pieces, phrases lie within a piece and may overlap themselves; a null text is empty; a
null language is ``und``; repeated rows count each time; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickstrata.llm.bloom import Bloom, bloom
from clickstrata.llm.common import shared, store
from clickstrata.llm.hat_trie import WORD_BITS, WORD_MASK, Node
from clickstrata.llm.wordtable import LOWERED, hashes, mixed, texts_of

LONGEST = 3
LEAST_COUNT = 10
TOP = 2000
SCALE = 1_000_000
# A candidate is dropped for a longer one with this share of its count, in percent.
COVERED = 50

# Phrases that a task's trie holds before it spills, and is left with then.
MOST_ENTRIES = 1_000_000
KEPT_ENTRIES = 500_000
# Words a task knows before it spills everything and begins anew.
MOST_WORDS = 500_000
# Bytes of text counted at once.
AT_ONCE = 4 << 20
# Prefixes are dealt to this many parts each.
SPREAD = 64
# Rows of a batch given back.
ROWS = 1 << 17

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EXACT = "decimal(38,0)"

_COUNTED = "prefix long, lang string, phrase string, code long, count long"


class Vocabulary:
    """Ids of the words a task has met, by language, with their hashes; 0 is a word left out."""

    def __init__(self):
        self.ids: dict[str, dict[str, int]] = {}
        self.words, self.langs = [""], [""]
        self.codes = np.zeros(1024, dtype=np.uint64)

    def ids_of(self, lang: str, words: list[str], codes: np.ndarray) -> np.ndarray:
        """The ids of different words, new ones for those not met before."""
        known = self.ids.setdefault(lang, {})
        out = np.array([known.get(word, 0) for word in words], dtype=np.int64)
        new = np.flatnonzero(out == 0)
        first = len(self.words)
        out[new] = np.arange(first, first + len(new))
        spelled = [words[at] for at in new]
        known.update(zip(spelled, range(first, first + len(new))))
        self.words += spelled
        self.langs += [lang] * len(new)
        while len(self.codes) < len(self.words):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.codes[first : len(self.words)] = codes[new]
        return out


def hashes_of(words: pa.LargeStringArray) -> np.ndarray:
    """A hash of each string, by its bytes."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    spelled = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
    return hashes(spelled, ends[:-1] - ends[0], ends[1:] - ends[0])


def lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


def phrase_codes(codes: list[np.ndarray]) -> np.ndarray:
    """One hash for the hashes of a phrase's words."""
    total = codes[0]
    for own in codes[1:]:
        total = mixed(total * _STEP + own)
    return total


class Counter:
    """What a task counts: phrases of ``length`` words, in a trie of bounded size."""

    def __init__(self, length: int, words: Bloom | None, pairs: Bloom | None):
        self.length, self.frequent, self.pairs = length, words, pairs
        self.begin()

    def begin(self) -> None:
        self.vocabulary, self.trie = Vocabulary(), Node(self.length)

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array) -> None:
        """Count the phrases of some texts, given as bytes with the places where each begins."""
        n = len(data)
        data = LOWERED[data]
        cut = _BREAK[data]
        solid = ~(cut | _SPACE[data])
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        begins, stops = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:n]
        stops[:-1] &= ~solid[1:] | edge[1:n]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        if not len(starts):
            return
        piece = np.cumsum(cut | edge[:n], dtype=np.int32)[starts]
        row = np.searchsorted(offsets, starts, side="right") - 1
        lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(lengths), pa.py_buffer(np.ascontiguousarray(data[solid]))
        ).dictionary_encode()
        langs = langs.dictionary_encode()
        ids = self.ids(words, langs, row)
        keep = ids > 0
        # The first words of phrases: known words that follow each other in a piece.
        codes = self.vocabulary.codes
        for k in range(1, self.length):
            keep[-k:] = False
            keep[:-k] &= (piece[:-k] == piece[k:]) & (ids[k:] > 0)
        first = np.flatnonzero(keep)
        if self.pairs is not None:
            pair = lambda at: self.pairs.has(
                phrase_codes([codes[ids[at]], codes[ids[at + 1]]])
            )
            first = first[pair(first)]
            first = first[pair(first + 1)]
        phrases = np.zeros(len(first), dtype=np.int64)
        for k in range(self.length):
            phrases = phrases << WORD_BITS | ids[first + k]
        found, counts = np.unique(phrases, return_counts=True)
        self.trie.add(found, counts)

    def ids(self, words: pa.DictionaryArray, langs: pa.DictionaryArray, row: np.ndarray):
        """The id of each word, 0 for those that are not wanted."""
        names, spelled = langs.dictionary.to_pylist(), words.dictionary
        lang = langs.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64)
        both = lang * len(spelled) + words.indices.to_numpy(zero_copy_only=False)
        met = np.zeros(len(names) * len(spelled), dtype=bool)
        met[both] = True
        of = np.zeros(len(met), dtype=np.int64)
        spelled_codes = hashes_of(spelled)
        for k, name in enumerate(names):
            own = np.flatnonzero(met[k * len(spelled) : (k + 1) * len(spelled)])
            codes = mixed(spelled_codes[own] ^ lang_code(name))
            if self.frequent is not None:
                wanted = self.frequent.has(codes)
                own, codes = own[wanted], codes[wanted]
            text = spelled.take(pa.array(own)).to_pylist()
            of[k * len(spelled) + own] = self.vocabulary.ids_of(name, text, codes)
        return of[both]

    def spill(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Runs of rows, each sorted, of subtrees that leave the trie."""
        if not everything and self.trie.entries <= MOST_ENTRIES:
            return
        words = pa.array(self.vocabulary.words, pa.string())
        # Ids in order of the words they stand for.
        place = np.empty(len(words), dtype=np.int64)
        place[pa.compute.sort_indices(words).to_numpy()] = np.arange(len(words))
        langs = pa.array(self.vocabulary.langs, pa.string())
        for phrases, counts in self.trie.spilled(0 if everything else KEPT_ENTRIES, ROWS):
            yield from self.run(phrases, counts, words, place, langs)

    def run(self, phrases, counts, words, place, langs) -> Iterator[pa.RecordBatch]:
        ids = [
            phrases >> (WORD_BITS * (self.length - 1 - k)) & WORD_MASK for k in range(self.length)
        ]
        order = np.lexsort([place[own] for own in reversed(ids)])
        ids, counts = [own[order] for own in ids], counts[order]
        codes = [self.vocabulary.codes[own] for own in ids]
        whole = phrase_codes(codes)
        # Language and first word, and for a crowded one a part of the hash.
        prefixes = mixed(codes[0] * np.uint64(SPREAD) + whole % np.uint64(SPREAD)).view(np.int64)
        whole = whole.view(np.int64)
        for low in range(0, len(counts), ROWS):
            own = [words.take(pa.array(x[low : low + ROWS])) for x in ids]
            phrase = own[0] if len(own) == 1 else pa.compute.binary_join_element_wise(*own, " ")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(prefixes[low : low + ROWS]),
                    langs.take(pa.array(ids[0][low : low + ROWS])),
                    phrase,
                    pa.array(whole[low : low + ROWS]),
                    pa.array(counts[low : low + ROWS]),
                ],
                ["prefix", "lang", "phrase", "code", "count"],
            )


def runs(
    docs: DataFrame, length: int, words: Bloom | None = None, pairs: Bloom | None = None
) -> DataFrame:
    """Rows (prefix, lang, phrase, code, count) of the tasks' sorted runs."""
    spark = docs.sparkSession
    held = shared(spark, (words, pairs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(length, *held())
        for batch in batches:
            langs = batch.column("lang")
            for texts in texts_of(batch, at_once=AT_ONCE):
                own = langs.slice(texts.first, len(texts))
                counter.add(texts.data, texts.offsets, own)
                yield from counter.spill()
                if len(counter.vocabulary.words) > MOST_WORDS:
                    yield from counter.spill(everything=True)
                    counter.begin()
        yield from counter.spill(everything=True)

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(count, _COUNTED)


def merged(rows: DataFrame) -> DataFrame:
    """Exact counts from sorted runs, prefix by prefix."""
    sums = (
        rows.repartition("prefix")
        .groupBy("prefix", "lang", "phrase", "code")
        .agg(F.sum("count").alias("count"))
    )
    return sums.select("lang", "phrase", "code", "count")


def counted(docs: DataFrame, least: int = LEAST_COUNT) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1, 2 and 3 words that occur often enough, and all words of each language.

    Tables of (lang, phrase, code, count), and one of (lang, n).
    """
    often = F.col("count") >= least
    words = store(merged(runs(docs, 1)), "words")
    totals = words.groupBy("lang").agg(F.sum("count").alias("n"))
    tables = [store(words.where(often), "frequent")]
    filters: list[Bloom] = []
    for length in range(2, LONGEST + 1):
        filters.append(bloom(tables[-1]))
        tables.append(store(merged(runs(docs, length, *filters)).where(often), "frequent"))
    return tables, totals


def scored(tables: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates, by their lowest-scoring cut."""
    parts = tables[0].unionAll(tables[1]).select("lang", "phrase", "count")
    cuts = None
    for length, table in enumerate(tables[1:], 2):
        for k in range(1, length):
            cut = table.select(
                "lang",
                "phrase",
                F.col("count").alias("a"),
                F.lit(k).alias("k"),
                F.substring_index("phrase", " ", k).alias("left"),
                F.substring_index("phrase", " ", k - length).alias("right"),
            )
            cuts = cut if cuts is None else cuts.unionAll(cut)
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r"))
    known = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    for name in ("a", "l", "r"):
        known = known.withColumn(f"{name}_", F.col(name).cast(_EXACT))
    known = known.withColumn("top", (F.col("a_") * F.col("a_") * SCALE).cast(_EXACT))
    known = known.withColumn("bottom", (F.col("l_") * F.col("r_")).cast(_EXACT))
    known = known.withColumn("score", F.expr("top div bottom"))
    lowest = known.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(tables: list[DataFrame]) -> DataFrame:
    """(lang, phrase) of the candidates that lie in a longer one frequent enough."""
    out = None
    for length in range(2, LONGEST):
        inside = tables[length].select(
            "lang",
            "count",
            F.explode(
                F.array(
                    F.substring_index("phrase", " ", length),
                    F.substring_index("phrase", " ", -length),
                )
            ).alias("phrase"),
        )
        most = inside.groupBy("lang", "phrase").agg(F.max("count").alias("most"))
        own = (
            tables[length - 1]
            .join(most, ["lang", "phrase"])
            .where(F.col("most") * 100 >= F.col("count") * COVERED)
            .select("lang", "phrase")
        )
        out = own if out is None else out.unionAll(own)
    return out


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first candidates of each language, numbered from 1.

    A language's candidates are first cut down in parts, by the hash of the phrase.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    within = Window.partitionBy("lang", "part").orderBy(*order)
    overall = Window.partitionBy("lang").orderBy(*order)
    best = candidates.withColumn("part", part).withColumn("rank", F.row_number().over(within))
    best = best.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(overall))
    return best.where(F.col("rank") <= top).drop("part")


def mine(docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language."""
    tables, totals = counted(docs, least)
    open_ = scored(tables).join(covered(tables), ["lang", "phrase"], "left_anti")
    return (
        ranked(open_, top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


# DuckDB SQL of ``mine`` over ``documents`` with the settings above.
SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
numbered AS (SELECT lang, piece, row_number() OVER () AS id FROM pieces),
split AS (
    SELECT lang, id, unnest(string_split_regex(piece, '[ \t]+')) AS w,
           generate_subscripts(string_split_regex(piece, '[ \t]+'), 1) AS i
    FROM numbered),
starts AS (
    SELECT lang, w, lead(w) OVER near AS w2, lead(w, 2) OVER near AS w3 FROM split WHERE w <> ''
    WINDOW near AS (PARTITION BY id ORDER BY i)),
spans AS (
    SELECT lang, 1 AS words, w AS phrase FROM starts
    UNION ALL SELECT lang, 2, w || ' ' || w2 FROM starts WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM starts WHERE w3 IS NOT NULL),
counts AS (SELECT lang, words, phrase, CAST(count(*) AS HUGEINT) AS c FROM spans GROUP BY ALL),
totals AS (SELECT lang, sum(c) AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND c >= {LEAST_COUNT}),
cuts AS (
    SELECT lang, phrase, c AS a, unnest(range(1, words)) AS k, w FROM candidates),
scores AS (
    SELECT u.lang, u.phrase, u.a, u.k, x.c AS l, y.c AS r, {SCALE} * u.a * u.a // (x.c * y.c) AS score
    FROM cuts u
    JOIN counts x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.k], ' ')
    JOIN counts y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.k + 1:], ' ')),
lowest AS (
    SELECT * FROM scores
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, c FROM candidates WHERE words = 3
    UNION ALL
    SELECT lang, array_to_string(w[2:3], ' '), c FROM candidates WHERE words = 3),
ranked AS (
    SELECT s.*, row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank"
    FROM lowest s
    WHERE NOT EXISTS (SELECT 1 FROM covers v WHERE v.lang = s.lang AND v.phrase = s.phrase
                      AND 100 * v.c >= {COVERED} * s.a))
SELECT lang, CAST("rank" AS BIGINT) AS "rank", phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE "rank" <= {TOP}
"""
