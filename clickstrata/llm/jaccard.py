"""Similarity join of shingle sets: size-aware, light sets by subsets, heavy ones by lists.

A document's set is its distinct shingles of some words, in lower case; documents whose
sets have a Jaccard similarity of a given share or more are linked (``Rule``: three words
and 0.9 unless said).

Two linked sets of sizes m and n share at least 9 (m + n) / 19 elements at 0.9. Small sets
enumerate their subsets of just that size for each size a partner can have: a common
subset is a link. For larger sets there are too many. They go into inverted lists:
sets of similar size are cut by hash into more parts than linked sets can have
differences, so linked sets agree on some parts; a list holds the sets with the same
part. There are as many parts more as may be empty, so that empty ones need no list, but
for sets that have still more of them, and two more again, so that linked sets share three
lists, two of them short or two of them long: documents that merely have a passage in common
mostly share one, and such pairs, the more the larger the corpus, are dropped before anything
is looked up for them.
(Lists of single elements would hold every document with a common passage.)
The boundary between the two is where the keys of the corpus, counted by set size,
cost least.

Sets that are equal are one class and are searched once. Short lists give all their
pairs. Long ones first give a star, which joins most members of a group of near
copies; only members still in different components are then compared, so a group of
thousands does not give all its pairs. (Those that share two long lists are compared, in
blocks of bounded size.)
Candidates are checked against the whole
sets. Sets and elements are compared by 64-bit hashes.

Defined results: a document without words, null or empty, has an empty set and is
linked with nothing; rows with the same id are one document; rows with a null id are
linked, but name no component (null, if nothing else is in it); an empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, comb, exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.bloom import Bloom, bloom
from clickstrata.llm.common import release, shared, store
from clickstrata.llm.components import components
from clickstrata.llm.wordtable import Texts, mixed, shingles, texts_of, words_of

# What a key of an inverted list costs, in keys of subsets: lists also hold sets that
# are not similar.
LIST_COST = 8
# The sizes up to which subsets are thought of.
MOST_LIGHT = 40
# Inverted lists that linked sets share at least: so two short ones, or two long ones.
SHARED = 3
OF_A_KIND = 2
# Lists up to this long give all their pairs.
SHORT_LIST = 16
# Sets in up to this many long lists are in a list for each two of them.
NARROW = 16
# Lists of two long lists that are made at once.
TWOS_AT_ONCE = 1 << 18
# Sets of a block of a family of lists, and the ratio of sizes in it.
BLOCK_SETS = 512
SIZE_STEP = 1.05
# What a pair of a list costs, in pairs of a large family, where most sizes allow no link; and
# a member of a list, in pairs of the list.
PAIR_COST = 4
MEMBER_COST = 256
# Pairs whose summaries are compared at once.
PAIRS_AT_ONCE = 1024
# Whole sets, and summaries, in a file.
SETS_A_FILE = 1000
SUMMARIES_A_FILE = 10_000
# Counts in the summary of a set.
BUCKETS = 256

# Keys have 48 bits: the zeros are compressed in the shuffle, and sets that meet by chance
# are dropped later. The lowest of the bits tells subsets from lists.
MARK = 1 << 16
_KEPT = ~np.uint64(2 * MARK - 1)

_ONE = np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """Words of a shingle; links have a similarity of at least ``top / base``."""

    shingle: int = 3
    top: int = 9
    base: int = 10

    def overlap(self, m: int, n: int) -> int:
        """Fewest common elements of linked sets of sizes m and n."""
        return -(-self.top * (m + n) // (self.top + self.base))

    def partner_sizes(self, n: int) -> range:
        return range(-(-self.top * n // self.base), n * self.base // self.top + 1)

    def parts(self, high: int) -> int:
        """One more than the elements in which linked sets up to this size can differ."""
        return 2 * high * (self.base - self.top) // (self.top + self.base) + 1


RULE = Rule()


class Classes:
    """Size classes such that linked sets are in the same or in neighbouring ones.

    Linked sets of a class and of the one before agree on ``spare + SHARED`` of its parts or
    more.
    """

    def __init__(self, largest: int, rule: Rule = RULE):
        self.low, self.parts, self.spare = [1], [], []
        before = 1
        while True:
            high = self.low[-1] * rule.base // rule.top
            needed = rule.parts(high)
            # About as many parts of the smallest set here are empty, and three deviations.
            empty = needed * exp(-before / needed)
            self.spare.append(ceil(empty + 3 * sqrt(empty)))
            self.parts.append(needed + self.spare[-1] + SHARED - 1)
            if self.low[-1] > largest + 1:
                break
            before = self.low[-1]
            self.low.append(high + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.low), sizes, side="right") - 1


def subset_sizes(n: int, boundary: int, rule: Rule = RULE) -> list[int]:
    """Sizes of the subsets that a set of n elements enumerates.

    Equal sets are one class already, so only common subsets with a set of another
    size, or with a different one of the same size, matter.
    """
    sizes = {rule.overlap(n, m) for m in rule.partner_sizes(n) if 0 < m <= boundary and m != n}
    if rule.overlap(n, n) < n <= boundary:
        sizes.add(rule.overlap(n, n))
    return sorted(c for c in sizes if 0 < c <= n)


def boundary_of(histogram: dict[int, int], rule: Rule = RULE) -> int:
    """The largest light size for which all keys of the corpus cost least."""
    classes = Classes(2 * MOST_LIGHT, rule)
    best, least = 0, None
    for boundary in range(MOST_LIGHT + 1):
        cost = 0
        for n, count in histogram.items():
            if n <= boundary:
                cost += count * sum(comb(n, c) for c in subset_sizes(n, boundary, rule))
            if 0 < n <= MOST_LIGHT and rule.partner_sizes(n)[-1] > boundary:
                at = int(classes.of(np.array([n]))[0])
                cost += count * LIST_COST * (classes.parts[at] + classes.parts[at + 1])
        if least is None or cost < least:
            best, least = boundary, cost
    return best


class Sets:
    """The distinct shingles of some texts, row by row."""

    def __init__(self, texts: Texts, rule: Rule = RULE):
        words = words_of(texts, lower=True)
        hashes, first = shingles(words, rule.shingle)
        rows = words.rows[first]
        counts = np.diff(words.bounds)
        for n in range(1, rule.shingle):
            short = np.flatnonzero(counts == n)
            if len(short):
                own, at = shingles(words, n)
                own = own[np.isin(words.rows[at], short)]
                hashes, rows = np.concatenate([hashes, own]), np.concatenate([rows, short])
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        self.hashes, self.rows = hashes[new], rows[new]
        self.sizes = np.bincount(self.rows, minlength=len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        # Sums do not depend on the order of the elements.
        self.spread = mixed(self.hashes + _ONE)
        totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.spread)])
        self.sums = totals[self.bounds[1:]] - totals[self.bounds[:-1]]
        self.prints = mixed(self.sums ^ self.sizes.astype(np.uint64) << np.uint64(44))


def light_keys(sets: Sets, row: int, boundary: int, rule: Rule = RULE) -> np.ndarray:
    """A key for each subset of the sizes that matter."""
    n = int(sets.sizes[row])
    own = sets.spread[sets.bounds[row] : sets.bounds[row + 1]]
    keys = []
    for c in subset_sizes(n, boundary, rule):
        left = np.array([sets.sums[row]])
        # Leave out n - c elements in all ways: those after the last one left out.
        last = np.array([-1])
        for _ in range(n - c):
            pairs = [(at, k) for at in range(len(left)) for k in range(last[at] + 1, n)]
            picked = np.array([k for _, k in pairs])
            left = left[[at for at, _ in pairs]] - own[picked]
            last = picked
        keys.append(mixed(left ^ np.uint64(c) << np.uint64(50)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def list_keys(
    sets: Sets, rows: np.ndarray, rule: Rule = RULE
) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the inverted lists these rows are in: two cuts, one for each class."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    classes = Classes(int(sets.sizes.max()) + 1, rule)
    own_class = classes.of(sets.sizes)
    parts_of, spare_of = np.array(classes.parts), np.array(classes.spare)
    chosen = np.zeros(len(sets.sizes), dtype=bool)
    chosen[rows] = True
    inside = chosen[sets.rows]
    element_rows, spread = sets.rows[inside], sets.spread[inside]
    out_rows, out_keys = [], []
    for step in (0, 1):
        parts = np.where(chosen, parts_of[own_class + step], 0)
        begin = np.concatenate([[0], np.cumsum(parts)])
        part = ((spread >> np.uint64(32)) * parts[element_rows].astype(np.uint64)) >> np.uint64(32)
        at = begin[element_rows] + part.astype(np.int64)
        n = int(begin[-1])
        # Sums of 64-bit values, exactly, as sums of their halves.
        value = mixed(spread)
        low = np.bincount(at, (value & np.uint64(0xFFFFFFFF)).astype(float), n).astype(np.uint64)
        high = np.bincount(at, (value >> np.uint64(32)).astype(float), n).astype(np.uint64)
        total = low + (high << np.uint64(32))
        row = np.repeat(np.arange(len(parts)), parts)
        number = (np.arange(n) - begin[row]).astype(np.uint64)
        tag = mixed((own_class[row] + step).astype(np.uint64) << np.uint64(32) | number)
        filled = np.bincount(at, minlength=n) > 0
        empty = np.bincount(row, ~filled, len(parts))
        needed = filled | (empty[row] > spare_of[own_class[row] + step])
        out_rows.append(row[needed])
        out_keys.append(mixed(total ^ tag)[needed])
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def prints(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, set size, and the fingerprint of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                sets = Sets(texts, rule)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.first, len(texts)),
                        pa.array(sets.sizes.astype(np.int64)),
                        pa.array(sets.prints.view(np.int64)),
                    ],
                    ["doc_id", "n", "print"],
                )

    return _source(docs).mapInArrow(run, "doc_id long, n long, print long")


def keys(docs: DataFrame, boundary: int, rule: Rule = RULE) -> DataFrame:
    """(key, print): what sets must share to be candidates.

    Keys of subsets have the mark, and one is enough; those of lists have not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A set that this task has had is not given again.
        had: set[int] = set()
        for batch in batches:
            for texts in texts_of(batch):
                sets = Sets(texts, rule)
                fresh = []
                for row in np.flatnonzero(sets.sizes):
                    own = int(sets.prints[row])
                    if own not in had:
                        had.add(own)
                        fresh.append(row)
                fresh = np.array(fresh, dtype=np.int64)
                sizes = sets.sizes[fresh]
                light = fresh[sizes <= boundary]
                heavy = fresh[sizes * rule.base // rule.top > boundary]
                rows, found = list_keys(sets, heavy, rule)
                found = found & _KEPT
                for row in light:
                    own = light_keys(sets, row, boundary, rule) & _KEPT | np.uint64(MARK)
                    rows = np.concatenate([rows, np.full(len(own), row)])
                    found = np.concatenate([found, own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(sets.prints[rows].view(np.int64))],
                    ["key", "print"],
                )

    return _source(docs).mapInArrow(run, "key long, print long")


_FOUND = ["key", "x", "y"]


def candidates(found: DataFrame) -> DataFrame:
    """(mark, x, y) of pairs that share a key, and (key, x, null) of members of long lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(key, x, y, members: bool) -> pa.RecordBatch:
            empty = np.ones(len(x), dtype=bool) if members else None
            # Of a pair's key only the mark is needed; the rest would be a third of what is written.
            key = key if members else key & MARK
            return pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(x, pa.int64()), pa.array(y, mask=empty)],
                _FOUND,
            )

        # The list that the last batch ended in, as far as it may be short, else its star.
        held_key, held = None, np.zeros(0, np.int64)
        centre = None
        for batch in batches:
            key = batch.column("key").to_numpy()
            x = batch.column("print").to_numpy()
            if not len(key):
                continue
            if centre is not None:
                same = int(np.searchsorted(key, held_key, side="right")) if key[0] == held_key else 0
                own = np.unique(x[:same])
                own = own[own != centre]
                if len(own):
                    at = np.full(len(own), held_key)
                    yield rows(at, own, np.full(len(own), centre), False)
                    yield rows(at, own, own, True)
                key, x = key[same:], x[same:]
                if not len(key):
                    continue
                centre = None
            elif len(held):
                key = np.concatenate([np.full(len(held), held_key), key])
                x = np.concatenate([held, x])
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (x[1:] != x[:-1])
            key, x = key[new], x[new]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lengths = np.diff(np.append(starts, len(key)))
            held_key, held = key[-1], x[starts[-1] :]
            if lengths[-1] <= SHORT_LIST:
                starts, lengths = starts[:-1], lengths[:-1]
            else:
                centre, held = held[0], held[:0]
            for k in range(1, SHORT_LIST):
                for j in range(k):
                    has = starts[(lengths > k) & (lengths <= SHORT_LIST)]
                    if len(has):
                        yield rows(key[has], x[has + j], x[has + k], False)
            long = lengths > SHORT_LIST
            if long.any():
                at = np.repeat(starts[long], lengths[long])
                member = at + np.arange(len(at)) - np.repeat(
                    np.cumsum(lengths[long]) - lengths[long], lengths[long]
                )
                star = member != at
                yield rows(key[member[star]], x[member[star]], x[at[star]], False)
                yield rows(key[member], x[member], x[member], True)
        for k in range(1, len(held)):
            own = held[:k]
            yield rows(np.full(k, held_key), own, np.full(k, held[k]), False)

    # Lists with much the same members mostly get the same centre, one of four.
    order = F.xxhash64("print", F.pmod(F.shiftright("key", 17), F.lit(4)))
    dealt = found.repartition("key").sortWithinPartitions("key", order)
    return dealt.mapInArrow(run, "key long, x long, y long")


def sharing(found: DataFrame) -> DataFrame:
    """Distinct pairs, smaller first, that share a subset, or two lists.

    Sets that share fewer short ones share two long ones, whose members are compared as such.
    """
    return (
        found.where(F.col("y").isNotNull() & (F.col("x") != F.col("y")))
        .groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .agg(F.sum(F.when(F.expr(f"key & {MARK} > 0"), OF_A_KIND).otherwise(1)).alias("shared"))
        .where(F.col("shared") >= OF_A_KIND)
        .select("x", "y")
    )


def summaries(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The fingerprint, the size and a summary of each set.

    The summary counts the elements by hash, up to 255 of each: two summaries differ in
    all by no more than the number of elements in which their sets differ.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                sets = Sets(texts, rule)
                bucket = (sets.spread >> np.uint64(40)) % np.uint64(BUCKETS)
                at = sets.rows * BUCKETS + bucket.astype(np.int64)
                counts = np.minimum(np.bincount(at, minlength=len(texts) * BUCKETS), 255)
                counts = counts.astype(np.uint8).reshape(len(texts), BUCKETS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.prints.view(np.int64)),
                        pa.array(sets.sizes.astype(np.int64)),
                        pa.array([row.tobytes() for row in counts], pa.binary()),
                    ],
                    ["print", "n", "summary"],
                )

    return _source(docs).mapInArrow(run, "print long, n long, summary binary")


def whole_sets(docs: DataFrame, wanted: Bloom, rule: Rule = RULE) -> DataFrame:
    """The fingerprint and the elements of the sets of some documents, by hash of their ids."""
    held = shared(docs.sparkSession, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = held()
        for batch in batches:
            code = batch.column("code").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(wanted.has(code)))
            for texts in texts_of(batch):
                sets = Sets(texts, rule)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.prints.view(np.int64)),
                        pa.array(
                            [
                                sets.hashes[a:b].tobytes()
                                for a, b in zip(sets.bounds, sets.bounds[1:])
                            ],
                            pa.binary(),
                        ),
                    ],
                    ["print", "elements"],
                )

    coded = _source(docs).select(F.xxhash64("doc_id").alias("code"), "text")
    return coded.mapInArrow(run, "print long, elements binary")


class Sources:
    """The documents that stand for the classes, by which sets are computed when needed."""

    def __init__(self, docs: DataFrame, classes: DataFrame, rule: Rule):
        self.docs, self.classes, self.rule = docs, classes, rule

    def sets(self, wanted: DataFrame) -> DataFrame:
        """The elements of the wanted prints, a row for each, and perhaps of some more.

        Tasks pick the documents by a filter of bounded size; no text is shuffled.
        """
        wanted = wanted.select(F.col("print").alias("own")).distinct()
        ids = wanted.join(self.classes, F.col("own") == F.col("print"))
        codes = store(ids.select(F.xxhash64("id").alias("code")), "codes", few=True)
        sets = whole_sets(self.docs, bloom(codes), self.rule).dropDuplicates(["print"])
        return store(sets, "sets", rows=codes.count(), a_file=SETS_A_FILE)


def possible(pairs: DataFrame, sets: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The pairs (x, y) whose sizes and summaries allow a link: none is lost, few sets are joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            sizes = zip(batch.column("m").to_pylist(), batch.column("n").to_pylist())
            for row, (a, b, (m, n)) in enumerate(zip(batch.column("a"), batch.column("b"), sizes)):
                if rule.base * min(m, n) < rule.top * max(m, n):
                    continue
                a = np.frombuffer(a.as_buffer(), dtype=np.uint8).astype(np.int64)
                b = np.frombuffer(b.as_buffer(), dtype=np.uint8)
                keep[row] = np.abs(a - b).sum() <= m + n - 2 * rule.overlap(m, n)
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    left = sets.select(F.col("print").alias("x"), F.col("n").alias("m"), F.col("summary").alias("a"))
    right = sets.select(F.col("print").alias("y"), "n", F.col("summary").alias("b"))
    return pairs.join(left, "x").join(right, "y").mapInArrow(run, "x long, y long")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule = RULE) -> DataFrame:
    """The pairs (x, y) that are similar enough, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for row, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"))):
                a = np.frombuffer(a.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(b.as_buffer(), dtype=np.uint64)
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep[row] = rule.base * both >= rule.top * (len(a) + len(b) - both)
            yield batch.select(["x", "y"]).filter(pa.array(keep))

    left = sets.select(F.col("print").alias("x"), F.col("elements").alias("a"))
    right = sets.select(F.col("print").alias("y"), F.col("elements").alias("b"))
    return pairs.join(left, "x").join(right, "y").mapInArrow(run, "x long, y long")


def twos(held: DataFrame, wanted: Bloom | None = None) -> DataFrame:
    """(key, x, component) for each two of the ``keys`` of a set, or for those wanted of them."""
    inside = shared(held.sparkSession, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = inside()
        for batch in batches:
            named = zip(batch.column("x").to_numpy(), batch.column("component").to_numpy())
            for (x, component), keys in zip(named, batch.column("keys")):
                own = mixed(np.sort(keys.values.to_numpy()).view(np.uint64))
                step = max(1, TWOS_AT_ONCE // len(own))
                for at in range(0, len(own) - 1, step):
                    one = np.arange(at, min(at + step, len(own) - 1))
                    later = len(own) - 1 - one
                    begin = np.repeat(np.cumsum(later) - later, later)
                    one = np.repeat(one, later)
                    two = one + 1 + np.arange(len(one)) - begin
                    key = mixed(own[one] + own[two] * np.uint64(3))
                    if wanted is not None:
                        key = key[wanted.has(key)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            pa.array(np.full(len(key), x)),
                            pa.array(np.full(len(key), component)),
                        ],
                        ["key", "x", "component"],
                    )

    rows = held.select("x", "component", "keys")
    return rows.mapInArrow(run, "key long, x long, component long")


def settled(
    members: DataFrame, named: DataFrame, search: Found, rule: Rule = RULE
) -> DataFrame:
    """Pairs (x, y) of members of long lists, in different components, that may be links.

    Such links share a subset, or two lists at least. A list that merely holds documents with
    a common passage grows with the corpus, but few of these meet in a second one. So sets
    are put into a list for each two of their lists. Of those that are not all one component
    the short ones give their pairs, the others are compared as families. Sets in
    many lists, as in groups of near copies, are only put into those that other sets are in,
    and are compared with each other as families.
    """
    placed = members.join(named, members["x"] == named["node"], "left").select(
        "key", "x", F.coalesce("component", "x").alias("component")
    )
    placed = store(placed, "members", few=True)
    by_subset = F.expr(f"key & {MARK} > 0")
    lists = placed.where(~by_subset).groupBy("x", "component")
    lists = lists.agg(F.collect_list("key").alias("keys"))
    held = store(lists.where(F.size("keys") >= OF_A_KIND), "held", few=True)
    broad = held.where(F.size("keys") > NARROW)
    narrow = held.where(F.size("keys") <= NARROW)
    wide = broad.select(F.explode("keys").alias("key"), "x", "component")
    found = twos(narrow).withColumn("broad", F.lit(False))
    if not broad.isEmpty():
        near = narrow.select(F.explode("keys").alias("key"), "x", "component")
        near = near.join(wide.select("key").distinct(), "key", "left_semi")
        near = near.groupBy("x", "component").agg(F.collect_list("key").alias("keys"))
        codes = twos(near.where(F.size("keys") >= OF_A_KIND)).select(F.col("key").alias("code"))
        wanted = bloom(store(codes.distinct(), "codes", few=True))
        found = found.unionAll(twos(broad, wanted).withColumn("broad", F.lit(True)))
    found = store(found, "twos", few=True)
    met = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("sets"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("broad").alias("all_broad"),
    )
    met = met.where((F.col("low") < F.col("high")) & ~F.col("all_broad")).select("key", "sets")
    met = store(found.join(met, "key"), "met", few=True)
    one = met.where(F.col("sets") <= SHORT_LIST)
    two = one.select("key", F.col("x").alias("y"), F.col("component").alias("y_in"), F.col("broad").alias("y_broad"))
    pairs = one.join(two, "key").where(
        (F.col("x") < F.col("y")) & (F.col("component") != F.col("y_in")) & ~(F.col("broad") & F.col("y_broad"))
    )
    close = possible(pairs.select("x", "y").distinct(), search.known, rule)

    crowded = met.where(F.col("sets") > SHORT_LIST).select("key", "x", "component")
    left = placed.where(by_subset).unionAll(crowded).withColumn("node", F.col("x"))
    # Families of sets in many lists are kept apart from the others.
    left = left.unionAll(wide.withColumn("node", F.xxhash64("x")))
    pairs = store(close.unionAll(in_families(left, search, rule)).distinct(), "likely", few=True)
    release(placed, held, found, met)
    return pairs


def in_families(placed: DataFrame, search: Found, rule: Rule = RULE) -> DataFrame:
    """Pairs (x, y) of members of one list (key, x, component, node) that may be links.

    Lists that are not all one component are put together into families by their nodes, so that
    a group that shares many lists is compared once. Where lists overlap so little that they
    have fewer pairs one by one, each is a family. A large family is cut
    by size, and a crowded size further by hash, into blocks of bounded size; blocks whose
    sizes allow a link are compared in one task, by summaries. Blocks that lie in one and
    the same component are not compared.
    """
    lists = placed.groupBy("key").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("node").alias("y"),
        F.count(F.lit(1)).cast("double").alias("sets"),
    )
    lists = lists.where(F.col("low") < F.col("high")).select("key", "y", "sets")
    open_ = store(placed.join(lists, "key"), "open", few=True)
    families = components(open_.select(F.col("node").alias("x"), "y").distinct()).toDF("node", "family")
    listed = open_.where(F.col("node") == F.col("y")).join(families, "node")
    cost = listed.groupBy("family").agg(F.sum(F.col("sets") * (F.col("sets") + MEMBER_COST)).alias("by_list"))
    cost = families.groupBy("family").agg(F.count(F.lit(1)).cast("double").alias("sets")).join(cost, "family")
    one_by_one = PAIR_COST * F.col("by_list") < F.col("sets") * F.col("sets")
    families = families.join(cost, "family").select("node", "family", one_by_one.alias("by_list"))
    whole = open_.select("node", "x", "component").distinct()
    whole = whole.join(families.where(~F.col("by_list")).select("node", "family"), "node")
    listed = open_.join(families.where("by_list").select("node"), "node", "left_semi")
    people = (
        whole.select("family", "x", "component")
        .unionAll(listed.select("key", "x", "component"))
        .join(search.classes.select(F.col("print").alias("x"), "n"), "x")
    )
    people = store(people, "families", few=True)
    small = people.groupBy("family").agg((F.count(F.lit(1)) <= BLOCK_SETS).alias("small"))
    step = F.when(F.col("small"), F.lit(0)).otherwise(F.floor(F.log("n") / log(SIZE_STEP)))
    people = people.join(small, "family").withColumn("step", step).drop("small")
    crowds = people.groupBy("family", "step").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("parts")
    )
    part = F.pmod(F.xxhash64("x"), F.col("parts"))
    blocked = people.join(crowds, ["family", "step"]).withColumn(
        "block", F.col("step") * (1 << 40) + part
    )
    blocked = store(blocked.drop("parts"), "blocks", few=True)
    blocks = blocked.groupBy("family", "step", "block").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
    )
    reach = ceil(log(rule.base / rule.top) / log(SIZE_STEP)) + 1
    ahead = F.explode(F.sequence(F.col("step"), F.col("step") + reach))
    one = blocks.withColumn("step", ahead)
    two = blocks.toDF("family", "step", "second", "low2", "high2", "least2", "most2")
    apart = (F.col("low") < F.col("high")) | (F.col("low2") < F.col("high2"))
    tasks = one.join(two, ["family", "step"]).where(
        (F.col("block") <= F.col("second"))
        & (F.col("least2") * rule.top <= F.col("most") * rule.base)
        & (apart | (F.col("low") != F.col("low2")))
    )
    tasks = tasks.select("family", F.col("block").alias("one"), F.col("second").alias("two"))
    sides = tasks.withColumn("block", F.explode(F.array_distinct(F.array("one", "two"))))
    rows = (
        sides.join(blocked, ["family", "block"])
        .join(search.known.select(F.col("print").alias("x"), "summary"), "x")
        .select("family", "one", "two", "block", "x", "component", "n", "summary")
    )
    compared = lambda table: block_pairs(table, rule)
    return rows.groupBy("family", "one", "two").applyInArrow(compared, "x long, y long")


def block_pairs(table: pa.Table, rule: Rule = RULE) -> pa.Table:
    """Pairs within a block or between two whose summaries allow a link, smaller first."""
    block, x = table["block"].to_numpy(), table["x"].to_numpy()
    component, n = table["component"].to_numpy(), table["n"].to_numpy()
    counts = np.stack([np.frombuffer(s.as_buffer(), np.uint8) for s in table["summary"]])
    counts = counts.astype(np.int16)
    one = block == table["one"][0].as_py()
    left = np.flatnonzero(one)
    right = left if one.all() else np.flatnonzero(~one)
    found_x, found_y = [], []
    rows = max(1, PAIRS_AT_ONCE // max(1, len(right)))
    for begin in range(0, len(left), rows):
        at = left[begin : begin + rows, None]
        # As many elements in common as a link needs.
        needed = -(-rule.top * (n[at] + n[right]) // (rule.top + rule.base))
        fits = (component[right] != component[at]) & (np.minimum(n[at], n[right]) >= needed)
        if one.all():
            fits &= right > at
        row, other = np.nonzero(fits)
        needed, at, other = needed[fits], at[row, 0], right[other]
        apart = np.abs(counts[other] - counts[at]).sum(axis=1, dtype=np.int64)
        near = apart <= n[at] + n[other] - 2 * needed
        at, other = at[near], other[near]
        found_x.append(np.minimum(x[at], x[other]))
        found_y.append(np.maximum(x[at], x[other]))
    return pa.table(
        {
            "x": pa.array(np.concatenate(found_x), pa.int64()),
            "y": pa.array(np.concatenate(found_y), pa.int64()),
        }
    )


@dataclass
class Found:
    """What a search has before it compares elements.

    ``own``: doc_id, n, print of every row; ``classes``: print, least id, n; ``members``:
    (key, x) of long lists; ``known``: summaries; ``likely``: pairs (x, y) of the other lists;
    ``lists``: all lists; ``rows``: the number of rows.
    """

    own: DataFrame
    classes: DataFrame
    lists: DataFrame
    members: DataFrame
    known: DataFrame
    likely: DataFrame
    sources: Sources
    rows: int


def searched(docs: DataFrame, rule: Rule = RULE) -> Found:
    own = store(prints(docs, rule), "prints", few=True)
    rows = own.count()
    full = own.where(F.col("n") > 0)
    # One row for each different set; its least id stands for the class.
    classes = store(
        full.groupBy("print").agg(F.min("doc_id").alias("id"), F.first("n").alias("n")),
        "classes",
        rows=rows,
    )
    sizes = classes.groupBy(F.least("n", F.lit(MOST_LIGHT + 1)).alias("size")).count()
    boundary = boundary_of({r["size"]: r["count"] for r in sizes.collect()}, rule)
    found = store(candidates(keys(docs, boundary, rule)), "candidates", few=True)
    members = found.where(F.col("y").isNull()).select("key", "x").distinct()

    known = store(
        summaries(docs, rule).dropDuplicates(["print"]),
        "summaries",
        rows=rows,
        a_file=SUMMARIES_A_FILE,
    )
    likely = store(possible(sharing(found), known, rule), "likely", few=True)
    return Found(own, classes, found, members, known, likely, Sources(docs, classes, rule), rows)


def links(docs: DataFrame, rule: Rule = RULE) -> tuple[DataFrame, DataFrame]:
    """All links between classes of equal sets (x, y), and the members of the classes.

    Members are (doc_id, n_shingles, class) rows; those without words have no class. The
    copies in a class are linked with each other and with those of every linked class.
    """
    search = searched(docs, rule)
    likely = search.likely
    if not search.members.isEmpty():
        apart = docs.sparkSession.createDataFrame([], "node long, component long")
        likely = likely.unionAll(settled(search.members, apart, search, rule)).distinct()
    sets = search.sources.sets(likely.select(F.explode(F.array("x", "y")).alias("print")))
    pairs = store(verified(likely, sets, rule), "links", few=True)
    release(sets, search.likely, search.known, search.lists)
    own = F.when(F.col("n") > 0, F.col("print")).alias("class")
    return pairs, search.own.select("doc_id", F.col("n").alias("n_shingles"), own)


def link_counts(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, set size, class and number of links of every row."""
    pairs, members = links(docs, rule)
    sizes = members.where(F.col("class").isNotNull()).groupBy("class").count()
    ends = pairs.unionAll(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    others = (
        ends.join(sizes.toDF("y", "others"), "y").groupBy("x").agg(F.sum("others").alias("others"))
    )
    counts = sizes.join(others, F.col("class") == F.col("x"), "left").select(
        "class", (F.col("count") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    return members.join(counts, "class", "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def linked(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """doc_id, set size and component of every document."""
    search = searched(docs, rule)
    own, classes, found = search.own, search.classes, search.lists
    members, sources = search.members, search.sources
    full = own.where(F.col("n") > 0)
    named = similar(search.likely, sources, rule)
    if not members.isEmpty():
        named = similar(settled(members, named, search, rule), sources, rule, named)

    # A component is named by the least id of its classes; a class of null ids has none.
    groups = named.toDF("node", "group")
    grouped = store(
        classes.join(groups, classes["print"] == groups["node"], "left").select(
            "print", "id", F.coalesce("group", "print").alias("group")
        ),
        "grouped",
        rows=search.rows,
    )
    names = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    final = grouped.join(names, "group").select("print", "component_id")
    release(found, search.known, search.likely)
    return (
        full.join(final, "print")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionAll(
            own.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id"))
        )
    )


def similar(
    likely: DataFrame, sources: Sources, rule: Rule = RULE, before: DataFrame | None = None
) -> DataFrame:
    """(node, component) by the links among the likely pairs (x < y) and the components before.

    Each y is compared with its least x first, which joins most members of a group of
    near copies; of the other pairs only those between different components are left.
    """
    first = store(
        likely.groupBy("y").agg(F.min("x").alias("x")).select("x", "y"), "first", rows=likely.count()
    )
    sets = sources.sets(likely.select(F.explode(F.array("x", "y")).alias("print")))
    found = store(verified(first, sets, rule), "similar", few=True)
    known = found
    if before is not None:
        known = found.unionAll(before.select(F.col("node").alias("x"), F.col("component").alias("y")))
    named = components(known)
    at = lambda side: named.toDF(side, f"{side}_in")
    rest = likely.join(first, ["x", "y"], "left_anti").join(at("x"), "x", "left").join(at("y"), "y", "left")
    apart = F.coalesce("x_in", "x") != F.coalesce("y_in", "y")
    more = store(
        verified(rest.where(apart).select("x", "y"), sets, rule), "similar", few=True
    )
    release(sets, first)
    if more.isEmpty():
        return named
    return components(more.unionAll(named.select(F.col("node").alias("x"), F.col("component").alias("y"))))


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is not among ``ids``.

    What a filter of bounded size knows not to be among them is not shuffled.
    """
    held = shared(docs.sparkSession, bloom(ids.select(F.xxhash64("doc_id").alias("code"))))
    coded = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("code"), F.struct(*docs.columns).alias("row"))

    def rows(there: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = held()
            for batch in batches:
                inside = wanted.has(batch.column("code").to_numpy().view(np.uint64))
                own = batch.column("row").filter(pa.array(inside == there))
                yield pa.RecordBatch.from_arrays([own], ["row"])

        kept = coded.mapInArrow(run, f"row {docs.schema.simpleString()}")
        return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))

    tested = rows(True)
    same = tested["doc_id"].cast("long") == ids["doc_id"]
    return rows(False).unionAll(tested.join(ids, same, "left_anti"))


def representatives(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One document of each component, the one with the least id, with all its columns.

    Of rows with one id the least stays. Rows with a null id all stay.
    """
    found = linked(docs, rule)
    spare = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = without(docs, store(spare, "spare", few=True))
    repeated = found.groupBy("doc_id").count().where(
        (F.col("count") > 1) & F.col("doc_id").isNotNull()
    )
    repeated = store(repeated.select("doc_id"), "repeated", few=True)
    if repeated.isEmpty():
        return kept
    row = F.min(F.struct(*docs.columns)).alias("row")
    single = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(row)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionAll(
        single.select(*(F.col("row")[c].alias(c) for c in docs.columns))
    )
