"""Test items inside documents: size-partitioned MinHash containment search.

Words are compared in lower case, letters and digits only; an item's shingles are
its distinct runs of five words (a shorter item is one run). Items are parted by
size. Within a part, an item's sketch is its shingles with the smallest hashes,
so many that a document which holds the wanted share of the item must hold one
of them: no containment is missed. Documents that hold one are candidates, if
they are long enough for the part; the shingles of a candidate are then looked up
in its words, exactly.

The items are the stated query set. They are handled in blocks of bounded size,
each broadcast and held against all documents, so benchmarks of any size work.

Defined results: an item or document without words, null or empty, matches
nothing; repeated rows match each for itself; null ids stay null; empty tables
give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.common import shared
from clickstrata.llm.wordtable import Texts, Words, shingles, texts_of, words_of

SHINGLE = 5
SHARE = 0.8
# Text of the items in a block; a longer item is a block of its own.
BLOCK_BYTES = 8 << 20
FILTER_BITS = 20

SCHEMA = "doc_id long, item_id long, n_shingles int, n_found int, containment double"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_shingles", pa.int32()),
        ("n_found", pa.int32()),
        ("containment", pa.float64()),
    ]
)


@dataclass
class Part:
    """Items with shingles of one length and about as many of them."""

    length: int
    # Fewest words of a document that can hold an item of this part.
    least_words: int
    # Sketch hashes in order, and the item of each.
    hashes: np.ndarray
    items: np.ndarray
    filter: np.ndarray


@dataclass
class Index:
    parts: list[Part]
    ids: list
    # The distinct shingles of each item, as words between single spaces.
    shingles: list[list[bytes]]
    needed: list[int]


def _needed(n: int, share: float) -> int:
    return int(np.ceil(share * n - 1e-9))


def index_of(ids: list, texts: list[str | None], share: float = SHARE) -> Index:
    """Sketches and shingles of a block of items."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    sets: list[list[bytes]] = []
    sketches: dict[tuple[int, int], list[tuple[int, int]]] = {}
    needed = []
    item = 0
    for some in texts_of(batch):
        words = words_of(some, plain=True)
        for row in range(len(some)):
            a, b = int(words.bounds[row]), int(words.bounds[row + 1])
            length = min(SHINGLE, b - a)
            own: dict[int, bytes] = {}
            if length:
                sub = _row(words, a, b)
                for h, at in zip(*shingles(sub, length)):
                    run = b" ".join(sub.string(w) for w in range(at, at + length))
                    own[int(h)] = b" " + run + b" "
            sets.append(list(own.values()))
            needed.append(max(1, _needed(len(own), share)))
            if own:
                # Of so many shingles a document that holds the share lacks at least one less.
                sketch = sorted(own)[: len(own) - needed[-1] + 1]
                part = (length, len(own).bit_length())
                sketches.setdefault(part, []).extend((h, item) for h in sketch)
            item += 1
    parts = []
    for (length, bits), entries in sorted(sketches.items()):
        entries.sort()
        hashes = np.array([h for h, _ in entries], dtype=np.uint64)
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        seen[hashes >> np.uint64(64 - FILTER_BITS)] = True
        least = _needed(1 << (bits - 1), share) + length - 1
        items = np.array([i for _, i in entries])
        parts.append(Part(length, least, hashes, items, seen))
    return Index(parts, ids, sets, needed)


def _row(words: Words, a: int, b: int) -> Words:
    return Words(
        words.data, words.starts[a:b], words.ends[a:b], words.rows[a:b], words.hashes[a:b],
        None, np.array([0, b - a]),
    )


def matches(index: Index, texts: Texts) -> Iterator[tuple[int, int, int]]:
    """(row, item, shingles found) of the rows that hold an item."""
    words = words_of(texts, plain=True)
    counts = np.diff(words.bounds)
    found: set[tuple[int, int]] = set()
    runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for part in index.parts:
        if part.length not in runs:
            runs[part.length] = shingles(words, part.length)
        hashes, first = runs[part.length]
        hit = np.flatnonzero(part.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        hit = hit[counts[words.rows[first[hit]]] >= part.least_words]
        low = np.searchsorted(part.hashes, hashes[hit], side="left")
        high = np.searchsorted(part.hashes, hashes[hit], side="right")
        for at in np.flatnonzero(high > low):
            row = int(words.rows[first[hit[at]]])
            found.update((row, int(i)) for i in part.items[low[at] : high[at]])
    joined: dict[int, bytes] = {}
    for row, item in sorted(found):
        if row not in joined:
            joined = {row: words.joined(row)}
        n = sum(shingle in joined[row] for shingle in index.shingles[item])
        if n >= index.needed[item]:
            yield row, item, n


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list]]:
    """The items in blocks; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item_id, text in rows.toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        size += len(text or "")
        if size >= block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """One row for each document and item it holds."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    spark = docs.sparkSession
    result = spark.createDataFrame([], SCHEMA)
    for ids, texts in blocks(items):
        held = shared(spark, index_of(ids, texts, share))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held()
            for batch in batches:
                doc_ids = batch.column("doc_id")
                for some in texts_of(batch):
                    rows = []
                    for row, item, n in matches(index, some):
                        size = len(index.shingles[item])
                        doc_id = doc_ids[some.first + row].as_py()
                        rows.append((doc_id, index.ids[item], size, n, n / size))
                    if rows:
                        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
                        yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        result = result.unionAll(source.mapInArrow(run, SCHEMA))
    return result


def clean(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    spark = docs.sparkSession
    for ids, texts in blocks(items):
        held = shared(spark, index_of(ids, texts, share))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held()
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for some in texts_of(batch):
                    for row, _, _ in matches(index, some):
                        keep[some.first + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
