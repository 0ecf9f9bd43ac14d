"""Repeated passages: matching statistics over a compressed FM-index per shard.

A window is 50 consecutive words of a document. Words covered by a window that also
starts in a document with a smaller id are removed.

Of the eight-word runs in a window the one with the smallest hash is its anchor, so
equal windows have equal anchors. Neighbouring windows with one anchor form a
segment. Equal segments of all documents are one, under the smallest document id that
holds it; every other holder repeats it whole. Segments whose anchor occurs in two
different texts are dealt to shards by anchor: windows that could be equal meet. A shard
indexes its segments in an FM-index over exact words and streams them through it: backward search, widened to the window
length at each step, finds for each window all places where it occurs, and the
smallest document id among them. Intervals that belong to a smaller id are reported.

Texts with equal words are one class, searched once, under its smallest id; further
copies are repeated whole if they hold a window. An anchor in very many texts has its
segments cut into single windows. These need no shard: they are equal or have nothing
in common. Their holders are dealt by a salt as well, so no task has all of them.

Defined results: a document with fewer than 50 words, null or empty, keeps all;
rows with a null id keep all and take nothing from others; rows with the same id
take nothing from each other; an empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.common import store
from clickstrata.llm.fm_index import FMIndex
from clickstrata.llm.wordtable import shingles, texts_of, words_of

WINDOW = 50
ANCHOR = 8
# Words a shard should hold, and texts from which an anchor's windows are dealt singly.
SHARD_WORDS = 300_000
VERY_COMMON = 20_000


def digest(words: list[bytes]) -> int:
    """64 bits of a digest of the word sequence."""
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "big", signed=True)


def anchors_of(hashes: np.ndarray) -> np.ndarray:
    """Place of the smallest of each ``WINDOW - ANCHOR + 1`` consecutive hashes, the last if equal."""
    span = WINDOW - ANCHOR + 1
    n = len(hashes)
    if n < span:
        return np.zeros(0, dtype=np.int64)
    # Smallest of 1, 2, 4, ... hashes from each place on.
    places, width = np.arange(n), 1
    while 2 * width <= span:
        left, right = places[: len(places) - width], places[width:]
        places = np.where(hashes[right] <= hashes[left], right, left)
        width *= 2
    rest = span - width
    left, right = places[: n - span + 1], places[rest : rest + n - span + 1]
    return np.where(hashes[right] <= hashes[left], right, left)


def windows(texts) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """(row, words, hashes of eight-word runs, anchor place of each window) of the texts."""
    words = words_of(texts)
    runs, first = shingles(words, ANCHOR)
    bounds = np.searchsorted(first, words.bounds)
    for row in range(len(texts)):
        text = texts.data[texts.offsets[row] : texts.offsets[row + 1]].tobytes().split()
        own = runs[bounds[row] : bounds[row + 1]]
        yield row, text, own, anchors_of(own)


def surveyed(docs: DataFrame) -> DataFrame:
    """doc_id, class of equal texts, word count, and the distinct anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                kinds, counts, found = [], [], []
                for _, words, runs, places in windows(texts):
                    kinds.append(digest(words))
                    counts.append(len(words))
                    found.append(np.unique(runs[np.unique(places)]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.first, len(texts)),
                        pa.array(kinds, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "kind", "n_words", "anchors"],
                )

    schema = "doc_id long, kind long, n_words long, anchors array<long>"
    return _source(docs).mapInArrow(run, schema)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def segments(wanted: DataFrame) -> DataFrame:
    """The segments of the anchors asked for: anchor, digest, whether cut, holder, places, words.

    Equal segments of one document are one row. ``wanted`` has doc_id, text, kind, and the shared and very common anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                rows = []
                for row, words, runs, places in windows(texts):
                    at = texts.first + row
                    kind = batch.column("kind")[at].as_py()
                    # Another text under the same id.
                    if digest(words) != kind:
                        continue
                    doc_id = batch.column("doc_id")[at].as_py()
                    shared = np.array(batch.column("shared")[at].as_py(), dtype=np.int64)
                    common = np.array(batch.column("common")[at].as_py(), dtype=np.int64)
                    anchor = runs[places].view(np.int64)
                    single = np.isin(anchor, common)
                    new = np.ones(len(places), dtype=bool)
                    new[1:] = (places[1:] != places[:-1]) | single[1:]
                    begins = np.flatnonzero(new)
                    stops = np.append(begins[1:], len(places))
                    own: dict[tuple[int, bool, bytes], list[int]] = defaultdict(list)
                    for a, b in zip(*(x[np.isin(anchor[begins], shared)] for x in (begins, stops))):
                        text = b" ".join(words[a : b + WINDOW - 1])
                        own[int(anchor[a]), bool(single[a]), text].append(int(a))
                    rows += [
                        (s, digest([text]), cut, doc_id, kind, at, text.count(b" ") + 1, text)
                        for (s, cut, text), at in own.items()
                    ]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["spread", "mark", "cut", "doc_id", "kind", "places", "size", "words"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    types += [pa.int64(), pa.binary()]
    schema = (
        "spread long, mark long, cut boolean, doc_id long, kind long, places array<long>, "
        "size long, words binary"
    )
    return wanted.mapInArrow(run, schema)


REPEATS = "spread long, mark long, least long, start long, end long"


def repeats(shard: pa.Table) -> pa.Table:
    """The intervals of a shard's different segments that occur under a smaller document id."""
    least = shard["least"].to_numpy()
    number: dict[bytes, int] = {}
    symbols, starts = [0], []
    for words in shard["words"].to_pylist():
        starts.append(len(symbols))
        # The symbol 0 stands between segments.
        symbols += [number.setdefault(w, len(number) + 1) for w in words.split(b" ")]
        symbols.append(0)
    text, starts = np.array(symbols), np.array(starts)
    lengths = np.diff(np.append(starts, len(text))) - 1
    index = FMIndex(text, WINDOW)
    # The smallest document id among equal windows.
    segment_of = np.maximum(np.searchsorted(starts, index.suffixes, side="right") - 1, 0)
    smallest = np.full(int(index.run[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, index.run, least[segment_of])
    low, high = matched(index, text, starts, lengths)
    out = []
    spreads, marks = shard["spread"].to_numpy(), shard["mark"].to_numpy()
    for segment, own in enumerate(least):
        n = int(lengths[segment]) - WINDOW + 1
        at = int(starts[segment])
        owner = smallest[index.run[low[at : at + n]]]
        hit = np.concatenate([[False], owner < own, [False]])
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            out.append((spreads[segment], marks[segment], own, a, b + WINDOW - 1))
    columns = zip(*out) if out else ([], [], [], [], [])
    names = ["spread", "mark", "least", "start", "end"]
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns)})


def matched(
    index: FMIndex, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index places of the window that starts at each place of the text, by backward search.

    All segments are streamed at once, longest first, from their ends.
    """
    low, high = np.zeros(len(text), dtype=np.int64), np.zeros(len(text), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    ends, sizes = (starts + lengths)[order], lengths[order]
    a = np.zeros(len(ends), dtype=np.int64)
    b = np.full(len(ends), index.n, dtype=np.int64)
    for step in range(1, int(sizes[0]) + 1):
        active = int(np.searchsorted(-sizes, -step, side="right"))
        a, b = a[:active], b[:active]
        if step > index.depth:
            # The window moves on: its last word no longer counts.
            a, b = index.widened(a)
        at = ends[:active] - step
        a, b = index.extended(text[at], a, b)
        if step >= index.depth:
            low[at], high[at] = a, b
    return low, high


def repeated(docs: DataFrame, very_common: int = VERY_COMMON) -> DataFrame:
    """(doc_id, kind, start, end): the word intervals to remove; they may overlap."""
    survey = store(surveyed(docs.where(F.col("doc_id").isNotNull())), "survey")
    full = survey.where(F.col("n_words") >= WINDOW)
    firsts = full.groupBy("kind").agg(F.min("doc_id").alias("doc_id"))
    copies = full.join(firsts.withColumnRenamed("doc_id", "first"), "kind").where(
        F.col("doc_id") > F.col("first")
    )
    whole = copies.select("doc_id", "kind", F.lit(0).cast("long").alias("start"), "n_words")

    every = full.select("kind", F.explode("anchors").alias("anchor"))
    counted = every.groupBy("anchor").agg(
        F.min("kind").alias("low"), F.max("kind").alias("high"), F.count(F.lit(1)).alias("n")
    )
    counted = counted.where(F.col("low") < F.col("high")).select("anchor", "n")
    counted = store(counted, "anchors")
    total, most = counted.agg(F.sum("n"), F.max("n")).first()
    total, salts = total or 0, max(1, -(-(most or 0) // very_common))
    shards = max(1, -(-total * 2 * WINDOW // SHARD_WORDS))
    per_kind = (
        every.join(counted, "anchor")
        .groupBy("kind")
        .agg(
            F.collect_set("anchor").alias("shared"),
            F.collect_set(F.when(F.col("n") > very_common, F.col("anchor"))).alias("common"),
        )
        .join(firsts, "kind")
    )
    wanted = _source(docs).join(per_kind, "doc_id")
    dealt = segments(wanted.select("doc_id", "text", "kind", "shared", "common"))
    dealt = store(dealt, "segments")
    return within(dealt, shards).unionAll(beyond_first(dealt, salts)).unionAll(whole)


def within(dealt: DataFrame, shards: int) -> DataFrame:
    """Intervals to remove under the least id of each segment."""
    uncut = dealt.where(~F.col("cut"))
    different = uncut.groupBy("spread", "mark", "words").agg(F.min("doc_id").alias("least"))
    shard = F.pmod(F.xxhash64("spread"), F.lit(shards))
    found = different.withColumn("shard", shard).groupBy("shard").applyInArrow(repeats, REPEATS)
    holders = uncut.select("spread", "mark", "doc_id", "kind", "places")
    place = F.explode("places").alias("place")
    return (
        holders.join(found, ["spread", "mark"])
        .where(F.col("doc_id") == F.col("least"))
        .select("doc_id", "kind", place, "start", "end")
        .select("doc_id", "kind", F.col("place") + F.col("start"), F.col("place") + F.col("end"))
        .toDF("doc_id", "kind", "start", "end")
    )


def beyond_first(dealt: DataFrame, salts: int) -> DataFrame:
    """Whole segments under all ids but the least; holders of cut ones are dealt by a salt."""
    groups = dealt.groupBy("spread", "mark", "cut").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("last")
    )
    groups = groups.where(F.col("least") < F.col("last"))
    last_salt = F.when(F.col("cut"), salts - 1).otherwise(0)
    groups = groups.select(
        "spread", "mark", "least", F.explode(F.sequence(F.lit(0), last_salt)).alias("salt")
    )
    salt = F.when(F.col("cut"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(0).cast("int")
    holders = dealt.select("spread", "mark", "doc_id", "kind", "places", "size", salt.alias("salt"))
    return (
        holders.join(groups, ["spread", "mark", "salt"])
        .where(F.col("doc_id") > F.col("least"))
        .select("doc_id", "kind", F.explode("places").alias("start"), "size")
        .select("doc_id", "kind", "start", (F.col("start") + F.col("size")).alias("end"))
    )


def removed(docs: DataFrame, very_common: int = VERY_COMMON) -> DataFrame:
    """Every document: its word counts, the words kept, and the intervals removed."""
    intervals = store(repeated(docs, very_common), "repeats")
    own = intervals.groupBy("doc_id").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("intervals")
    )
    joined = _source(docs).join(own, "doc_id", "left")

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                counts, gone, kept, spans = [], [], [], []
                for row in range(len(texts)):
                    a, b = texts.offsets[row], texts.offsets[row + 1]
                    words = texts.data[a:b].tobytes().split()
                    marks = batch.column("intervals")[texts.first + row].as_py() or []
                    merged: list[list[int]] = []
                    if marks:
                        kind = digest(words)
                        for mark in sorted(marks, key=lambda m: m["start"]):
                            if mark["kind"] != kind:
                                continue
                            if merged and mark["start"] <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], mark["end"])
                            else:
                                merged.append([mark["start"], mark["end"]])
                    left, at = [], 0
                    for start, end in merged:
                        left += words[at:start]
                        at = end
                    left += words[at:]
                    counts.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                    spans.append([{"start": s, "end": e} for s, e in merged])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.first, len(texts)),
                        pa.array(counts, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array(kept, pa.string()),
                        pa.array(spans, span),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept", "intervals"],
                )

    schema = (
        "doc_id long, n_words long, n_removed long, kept string, "
        "intervals array<struct<start:long,end:long>>"
    )
    return joined.mapInArrow(run, schema)
