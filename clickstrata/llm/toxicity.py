"""Toxic spans by a linear-chain conditional random field.

A token is a word in lower case, letters and digits only; a sentence is a chain.
Each token is labelled toxic or not: emission weights for the word, its
beginnings, its end and its length, hashed into one table, and transition weights.
Training labels for tokens come from the labels of documents: in a toxic document,
the toxic tokens are the words which, or beginnings of which, have contexts far more
often in toxic documents than in others. (Contexts are counted, a word with the one
before it, so that copies of one text count once.) Forward-backward marginals give the offending spans; their
largest value and the sum of the larger ones give the document's score, calibrated to the share
of toxic documents.

The field is fitted on a bounded sample of labelled documents outside the
held-out fold; every text is scored whole. Score inputs are texts only.

Defined results: a null or empty text gets the score of a text without toxic
tokens, no spans; repeated rows are scored each for itself; null ids are not
held out; without labels of both kinds every score is 0; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickstrata.llm.common import shared
from clickstrata.llm.wordtable import Texts, Words, mixed, texts_of, words_of

FOLDS = 5
# The bounded sample: documents of each label, and the longest that are drawn.
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 1600
SAMPLE_CHARS = 6000
TABLE_BITS = 18
STEPS = 40
# A toxic word or beginning has this many contexts in toxic documents, and its log odds there
# against others, less some standard errors, are at least this.
LEAST_CONTEXTS = 5
LEAST_LOG_ODDS = 1.5
ERRORS = 1.5
# Bytes of the beginnings that are features; at most 8 fit a hash input.
BEGINNINGS = (3, 4, 5, 6, 7)
# Marginals from here on add to a document's sum: many faint ones are no sign.
LEAST_COUNTED = 0.2
SENTENCE_ENDS = np.zeros(256, dtype=bool)
SENTENCE_ENDS[list(b".!?\n")] = True

# What a fitted field consists of.
PARTS = ("emission", "transition", "calibration")
SCHEMA = "doc_id long, score double, spans array<struct<start:int,end:int>>"


def held_out(doc_id: str = "doc_id") -> Column:
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(False))


@dataclass
class Chains:
    """Tokens in sentence order: features, and where sentences begin, longest first."""

    words: Words
    # Hashes of each token's word and its beginnings.
    units: list[np.ndarray]
    features: list[np.ndarray]
    starts: np.ndarray
    lengths: np.ndarray
    texts: Texts


def chains_of(texts: Texts) -> Chains:
    words = words_of(texts, plain=True)
    n = len(words.starts)
    data = words.data
    shift = np.uint64(64 - TABLE_BITS)

    def slot(value: np.ndarray) -> np.ndarray:
        return (value >> shift).astype(np.int32)

    def byte(at: np.ndarray) -> np.ndarray:
        inside = (at >= words.starts) & (at < words.ends)
        return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint64)

    def salted(value: np.ndarray, salt: int) -> np.ndarray:
        return mixed(value ^ np.uint64(salt << 58))

    units = [words.hashes]
    end = value = np.zeros(n, dtype=np.uint64)
    if n:
        for k in range(max(BEGINNINGS)):
            value = value | byte(words.starts + k) << np.uint64(8 * k)
            if k + 1 in BEGINNINGS:
                units.append(salted(value, 2 + k))
        for k in range(3):
            end = end | byte(words.ends - 1 - k) << np.uint64(8 * k)
    length = np.minimum(words.ends - words.starts, 15).astype(np.uint64)
    features = [slot(salted(length, 1)), slot(salted(end, 0)), *map(slot, units)]
    # A sentence ends where the byte after a word, as written, says so.
    follows = np.zeros(n, dtype=bool)
    if n:
        after = words.places[words.ends - 1] + 1
        inside = after < len(texts.data)
        follows[inside] = SENTENCE_ENDS[texts.data[after[inside]]]
    begins = np.ones(n, dtype=bool)
    begins[1:] = follows[:-1] | (words.rows[1:] != words.rows[:-1])
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    return Chains(words, units, features, starts[order], lengths[order], texts)


@dataclass
class Field:
    """Emission weights by feature slot, transition weights, and the calibration."""

    emission: np.ndarray
    # Into label 1 from 0, into 0 from 1, and staying in 1; staying in 0 is 0.
    transition: np.ndarray
    # Constant, weight of the largest marginal, weight of the capped sum.
    calibration: np.ndarray

    def scores(self, chains: Chains) -> np.ndarray:
        return sum(self.emission[slots] for slots in chains.features)

    def marginals(
        self, chains: Chains, counts: bool = False
    ) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of each token, and the expected counts of the three transitions."""
        u = np.exp(np.clip(self.scores(chains), -30, 30))
        enter, leave, stay = np.exp(self.transition)
        n, expected = len(u), np.zeros(3)
        odds = np.zeros(n)
        longest = int(chains.lengths[0]) if len(chains.lengths) else 0
        active = np.searchsorted(-chains.lengths, -np.arange(longest), side="left")
        carried = np.zeros(0)
        for t in range(longest):
            at = chains.starts[: active[t]] + t
            if t == 0:
                now = u[at]
            else:
                p = carried[: active[t]]
                now = u[at] * ((1 - p) * enter + p * stay) / ((1 - p) + p * leave)
            odds[at] = now
            carried = now / (1 + now)
        ratio = np.ones(n)
        after = np.zeros(0)
        for t in range(longest - 1, 0, -1):
            at = chains.starts[: active[t]] + t
            b = np.ones(len(at))
            b[: len(after)] = after
            ratio[at] = b
            weight = u[at] * b
            after = (leave + stay * weight) / (1 + enter * weight)
            if counts:
                before = odds[at - 1]
                p = before / (1 + before)
                parts = np.stack([(1 - p) * enter * weight, p * leave, p * stay * weight])
                expected += (parts / ((1 - p) + parts.sum(axis=0))).sum(axis=1)
        if longest:
            at = chains.starts
            first = np.ones(len(at))
            first[: len(after)] = after
            ratio[at] = first
        joint = odds * ratio
        return joint / (1 + joint), expected

    def document_scores(self, chains: Chains, p: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-summary(chains, p) @ self.calibration))


def summary(chains: Chains, p: np.ndarray) -> np.ndarray:
    """Of each text: 1, the largest marginal, and the sum of the larger ones, up to 3."""
    n = len(chains.texts)
    most, total = np.zeros(n), np.zeros(n)
    np.maximum.at(most, chains.words.rows, p)
    np.add.at(total, chains.words.rows, np.where(p >= LEAST_COUNTED, p, 0))
    return np.stack([np.ones(n), most, np.minimum(total, 3)], axis=1)


def spans_of(chains: Chains, p: np.ndarray, least: float = 0.5) -> dict[int, list[dict]]:
    """Runs of toxic tokens of each text, in code points of the text."""
    found: dict[int, list[dict]] = {}
    toxic = np.flatnonzero(p >= least)
    if len(toxic):
        words, chars = chains.words, chains.texts.chars_before()
        last = -2
        for token in toxic:
            row = int(words.rows[token])
            base = chars[chains.texts.offsets[row]]
            end = int(chars[words.places[words.ends[token] - 1] + 1] - base)
            own = found.setdefault(row, [])
            if token == last + 1 and own:
                own[-1]["end"] = end
            else:
                start = int(chars[words.places[words.starts[token]]] - base)
                own.append({"start": start, "end": end})
            last = token
    return found


def toxic_units(batches: list[tuple[Chains, np.ndarray]]) -> np.ndarray:
    """Hashes of the words and beginnings that mark toxic documents."""
    chosen, totals = [], []
    for label in (0, 1):
        pairs = []
        for chains, labels in batches:
            words = chains.words
            before = np.concatenate([[np.uint64(0)], words.hashes[:-1]])
            before[words.bounds[:-1][np.diff(words.bounds) > 0]] = 0
            mine = labels[words.rows] == label
            pairs.append(mixed(words.hashes + before * np.uint64(3))[mine])
        # One token of each context.
        first = np.unique(np.concatenate(pairs), return_index=True)[1]
        chosen.append(first)
        totals.append(len(first))
    marked = []
    for kind in range(1 + len(BEGINNINGS)):
        counts = []
        for label, first in enumerate(chosen):
            own = [c.units[kind][labels[c.words.rows] == label] for c, labels in batches]
            counts.append(np.unique(np.concatenate(own)[first], return_counts=True))
        (known, clean), (found, n) = counts
        at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
        others = np.where(known[at] == found, clean[at], 0) if len(known) else 0 * n
        odds = np.log((n + 0.5) / (others + 0.5)) + np.log((totals[0] + 1) / (totals[1] + 1))
        sure = odds - ERRORS * np.sqrt(1 / (n + 0.5) + 1 / (others + 0.5))
        marked.append(found[(n >= LEAST_CONTEXTS) & (sure >= LEAST_LOG_ODDS)])
    return np.concatenate(marked)


def fit(texts: list[str], labels: list[int], share: float) -> Field | None:
    """A field for labelled documents, of which a ``share`` is toxic among all."""
    labels_all = np.array(labels)
    if len(set(labels)) < 2:
        return None
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    batches = []
    for some in texts_of(batch):
        batches.append((chains_of(some), labels_all[some.first : some.first + len(some)]))
    marked = toxic_units(batches)
    goals = [
        np.any([np.isin(unit, marked) for unit in c.units], axis=0) & (y[c.words.rows] == 1)
        for c, y in batches
    ]
    for c, _ in batches:
        c.units.clear()
        c.words.places = None
    size = 1 << TABLE_BITS
    field = Field(np.zeros(size), np.zeros(3), np.zeros(3))
    tokens = max(1, sum(map(len, goals)))
    rate = (sum(int(g.sum()) for g in goals) + 1) / (tokens + 2)
    # Every token has a length, so these slots start as the constant.
    for c, _ in batches:
        field.emission[c.features[0]] = np.log(rate / (1 - rate))
    moments = [np.zeros(size + 3), np.zeros(size + 3)]
    for step in range(1, STEPS + 1):
        slope, turn = np.zeros(size), np.zeros(3)
        for (c, _), y in zip(batches, goals):
            p, expected = field.marginals(c, counts=True)
            error = y - p
            for slots in c.features:
                slope += np.bincount(slots, error, size)
            inner = np.ones(len(y), dtype=bool)
            inner[c.starts] = False
            now, before = y[inner], y[np.flatnonzero(inner) - 1]
            seen = [(now & ~before).sum(), (~now & before).sum(), (now & before).sum()]
            turn += np.array(seen) - expected
        whole = np.concatenate([slope - 0.02 * field.emission, turn - 0.02 * field.transition])
        moments[0] = 0.9 * moments[0] + 0.1 * whole
        moments[1] = 0.99 * moments[1] + 0.01 * whole**2
        move = moments[0] / (1 - 0.9**step)
        move /= np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-3
        field.emission += 0.3 * move[:size]
        field.transition += 0.1 * move[size:]
    rows = np.concatenate([summary(c, field.marginals(c)[0]) for c, _ in batches])
    # The sample holds more toxic documents than there are; weights set that right.
    toxic = labels_all.mean()
    weight = np.where(labels_all == 1, share / toxic, (1 - share) / (1 - toxic))
    field.calibration = logistic(rows, labels_all, weight)
    return field


def logistic(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, lightly held to zero."""
    beta = np.zeros(rows.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-rows @ beta))
        slope = rows.T @ (weight * (labels - p)) - 0.1 * beta
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(len(beta))
        beta = beta + np.linalg.solve(curve, slope)
    return beta


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """Fit on a bounded sample of the labelled documents outside the held-out fold.

    One task fits; only the field comes to the driver, a few megabytes.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.select("doc_id", (F.col("toxic") == 1).cast("int").alias("mark"))
    marks = marks.where(~held_out())
    totals = dict(marks.groupBy("mark").count().collect())
    if len(totals) < 2:
        return None
    share = totals[1] / (totals[0] + totals[1])
    samples = []
    for mark, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        # The ids are drawn first: at most so many, so they can be broadcast.
        drawn = marks.where(F.col("mark") == mark).select("doc_id").distinct()
        drawn = drawn.orderBy(F.xxhash64("doc_id")).limit(most)
        known = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        known = known.where(F.length("text").between(1, SAMPLE_CHARS))
        known = known.join(F.broadcast(drawn), "doc_id", "left_semi")
        known = known.select(F.xxhash64("doc_id").alias("draw"), "text", F.lit(mark).alias("mark"))
        samples.append(known.orderBy("draw", "text").limit(most))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda row: (-row[2], row[0], row[1]))
        field = fit([row[1] for row in rows], [row[2] for row in rows], share)
        if field is not None:
            parts = (field.emission, field.transition, field.calibration)
            columns = [pa.array([part.tobytes()], pa.binary()) for part in parts]
            yield pa.RecordBatch.from_arrays(columns, list(PARTS))

    sample = samples[0].union(samples[1]).coalesce(1)
    schema = ", ".join(f"{name} binary" for name in PARTS)
    row = sample.mapInArrow(learn, schema).first()
    return row and Field(*(np.frombuffer(part) for part in row))


def scored(docs: DataFrame, field: Field | None) -> DataFrame:
    """Score and toxic spans of every document."""
    held = shared(docs.sparkSession, field)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held()
        for batch in batches:
            for some in texts_of(batch):
                scores, spans = judged(field, some)
                columns = [
                    batch.column("doc_id").slice(some.first, len(some)),
                    pa.array(scores, pa.float64()),
                    pa.array([spans.get(row, []) for row in range(len(some))], span),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "spans"])

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(run, SCHEMA)


def judged(field: Field | None, texts: Texts) -> tuple[np.ndarray, dict[int, list[dict]]]:
    if field is None:
        return np.zeros(len(texts)), {}
    chains = chains_of(texts)
    p, _ = field.marginals(chains)
    return field.document_scores(chains, p), spans_of(chains, p)


def clean(docs: DataFrame, field: Field | None, least: float = 0.5) -> DataFrame:
    """The documents that score below ``least``, with all their columns."""
    held = shared(docs.sparkSession, field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = held()
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for some in texts_of(batch):
                scores, _ = judged(field, some)
                keep[some.first : some.first + len(some)] = scores < least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
