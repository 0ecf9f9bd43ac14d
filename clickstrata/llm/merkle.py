"""Merkle manifest of a table, with proofs from one octopus multiproof per leaf partition.

Leaves are hashes of whole rows. Each language has a tree over its leaves in order of
doc_id; a tree over their roots, in order of language, gives the root of the table. Every
two consecutive nodes become their hash, a last one alone becomes its own; hashes are
SHA-256 over hex text.

Building: leaves are sorted into ranges and numbered by counts of the ranges before. 1024
consecutive nodes are a block, which one task turns into the ten levels above; the block
tops are the leaves of the next tier, so each tier is a thousandth of the one before. All
nodes are stored, a folder for each tier.

Proving: the wanted leaves of a block work out together which nodes they lack: at each
level the siblings that none of them can derive. These coordinates are fetched in one join
with the stored nodes; the block then derives its inner nodes once, and reads off each
leaf's own proof. A block lacks one node per level above it and those of its unwanted
leaves, however many of its leaves are wanted.

A block holds 1024 rows of a language, so a language with a third of all rows is many
blocks. Only two numbers for each tier (number of blocks left, lowest level lacking) come
to the driver.

Defined results: null values hash as ``-``; a null language is a tree of its own, the
first; null ids come first in their tree; rows with the same id are ordered by their leaf,
equal rows are leaves of their own; an empty table has no leaves, nodes or proofs. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstrata.llm.common import store

# Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels of a block, which has two to that power of nodes.
TIER = 10

_NODES = "tree string, level int, place long, digest string"
_COORDINATES = "tree string, block long, level int, place long"


def hashed(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as the leaves hash it: ``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of a row; a changed value may be given for any of its columns."""
    values = [changed.get(name, F.col(name)) for name in FIELDS]
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


@dataclass
class Manifest:
    """Leaves (tree, place, n, carried columns, leaf) and the nodes of each tier.

    ``n`` is the number of leaves of the tree. ``top`` is the manifest over the roots of
    the trees, None for that manifest itself.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    top: Manifest | None


def numbered(leaves: DataFrame, *order: str) -> DataFrame:
    """Leaves with their place in their tree and the tree's number of leaves.

    The last column, ``row``, tells equal leaves apart, so that they need not all lie in
    one range.
    """
    rows = store(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    keys = ("tree", *order, "row")
    schema = f"{rows.schema.simpleString()[7:-1].replace(':', ' ')},range int,at long"

    def count(batches):
        # Rows of a range come sorted, so those of one tree follow each other.
        tree, at = object(), 0
        for batch in batches:
            places = []
            for own in batch.column("tree").to_pylist():
                at = at + 1 if own == tree else 0
                tree = own
                places.append(at)
            yield batch.append_column("at", pa.array(places, pa.int64()))

    ranges = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("range", F.spark_partition_id())
        .mapInArrow(count, schema)
    )
    ranges = store(ranges, "ranges")
    counts = ranges.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select(
        F.col("tree").alias("name"),
        F.col("range").alias("part"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(tree).alias("n"),
    )
    same = (F.col("range") == F.col("part")) & F.col("tree").eqNullSafe(F.col("name"))
    placed = ranges.join(places, same).withColumn("place", F.col("before") + F.col("at"))
    return placed.drop("name", "part", "before", "range", "at", "row")


def heights(n: Column) -> Column:
    """Levels above the leaves of a tree with n of them."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def _levels(table: pa.Table, level: int) -> pa.Table:
    """The nodes above those of a block, which are all on one level, and next to each other."""
    table = table.sort_by("place")
    tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
    place, digests = table["place"][0].as_py(), table["digest"].to_pylist()
    levels, places, out = [], [], []
    for _ in range(TIER):
        if n == 1:
            break
        digests = [hashed(*digests[k : k + 2]) for k in range(0, len(digests), 2)]
        level, place, n = level + 1, place >> 1, (n + 1) >> 1
        levels += [level] * len(digests)
        places += range(place, place + len(digests))
        out += digests
    return pa.table(
        {
            "tree": pa.array([tree] * len(out), pa.string()),
            "level": pa.array(levels, pa.int32()),
            "place": pa.array(places, pa.int64()),
            "digest": pa.array(out, pa.string()),
        }
    )


def _above(level: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        return _levels(table, level)

    return run


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """(tree, level, place, digest) of all nodes, a stored table for each tier; leaves first."""
    sizes = leaves.select("tree", "n")
    here = leaves.select(
        "tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"), "n"
    )
    tiers, level = [here.drop("n")], 0
    most = sizes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = here.withColumn("block", F.shiftright("place", TIER))
        above = blocks.groupBy("tree", "block").applyInArrow(_above(level), _NODES)
        tier = store(above, "nodes")
        tiers.append(tier)
        level += TIER
        most = (most - 1 >> TIER) + 1
        # The number of nodes of a tree on this level: one more than the last one's place.
        tops = tier.where(F.col("level") == level)
        counts = tops.groupBy("tree").agg((F.max("place") + 1).alias("n"))
        counts = counts.withColumnRenamed("tree", "name")
        here = tops.join(counts, F.col("tree").eqNullSafe(F.col("name"))).drop("name")
    return tiers


def build(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of a table. ``claimed`` is a leaf to be tested by each row's proof, its
    own unless said otherwise."""
    own = leaf()
    rows = docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        own.alias("leaf"),
        (own if claimed is None else claimed).alias("claimed"),
    )
    leaves = store(numbered(rows, "doc_id", "leaf"), "numbered")
    tiers = _tiers(leaves)
    return Manifest(leaves, tiers, _over_roots(leaves, tiers))


def _over_roots(leaves: DataFrame, tiers: list[DataFrame]) -> Manifest:
    ends = leaves.where(F.col("place") == 0).select(
        F.col("tree").alias("name"), heights(F.col("n")).alias("height")
    )
    nodes = tiers[0].where(F.col("place") == 0)
    for tier in tiers[1:]:
        nodes = nodes.unionAll(tier.where(F.col("place") == 0))
    roots = nodes.join(
        ends, F.col("tree").eqNullSafe(F.col("name")) & (F.col("level") == F.col("height"))
    )
    # All roots are one tree; the null language is the first of them.
    roots = roots.select(
        F.lit("").alias("tree"), F.col("name").alias("lang"), F.col("digest").alias("leaf")
    )
    over = store(numbered(roots.withColumn("claimed", F.col("leaf")), "lang"), "roots")
    return Manifest(over, _tiers(over), None)


def lacking(places: list[int], n: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes from which the root follows, given these leaves."""
    known, out, level = sorted(set(places)), [], 0
    while n > 1:
        have = set(known)
        out += [(level, at ^ 1) for at in known if (at ^ 1) < n and (at ^ 1) not in have]
        known = sorted({at >> 1 for at in known})
        level, n = level + 1, (n + 1) >> 1
    return out


def _lacks(table: pa.Table) -> pa.Table:
    """The coordinates a block's wanted leaves lack, and that of the root to be met."""
    places, n = table["place"].to_pylist(), table["n"][0].as_py()
    found = lacking(places, n) + [((n - 1).bit_length(), 0)]
    return pa.table(
        {
            "tree": pa.array([table["tree"][0].as_py()] * len(found), pa.string()),
            "block": pa.array([table["block"][0].as_py()] * len(found), pa.int64()),
            "level": pa.array([level for level, _ in found], pa.int32()),
            "place": pa.array([place for _, place in found], pa.int64()),
        }
    )


_PROOF = "siblings array<struct<left:boolean,digest:string>>, subroot string"
_STEP = pa.struct([("left", pa.bool_()), ("digest", pa.string())])


def _expanded(wanted: pa.Table, fetched: pa.Table) -> pa.Table:
    """Each leaf's proof, from the leaves of a block and the nodes it lacked.

    A step without a digest has no sibling: the node alone is hashed.
    """
    n = wanted["n"][0].as_py()
    coordinates = zip(fetched["level"].to_pylist(), fetched["place"].to_pylist())
    nodes = dict(zip(coordinates, fetched["digest"].to_pylist()))
    places = wanted["place"].to_pylist()
    nodes.update(((0, at), digest) for at, digest in zip(places, wanted["leaf"].to_pylist()))
    # What follows from these, once for all leaves: the steps of each node to its parent.
    known, steps, level, size = sorted(set(places)), [], 0, n
    while size > 1:
        own = {}
        for at in known:
            other = nodes[level, at ^ 1] if (at ^ 1) < size else None
            own[at] = {"left": bool(at & 1), "digest": other}
            if (level + 1, at >> 1) not in nodes:
                pair = (other, nodes[level, at]) if at & 1 else (nodes[level, at], other)
                nodes[level + 1, at >> 1] = hashed(*(x for x in pair if x is not None))
        steps.append(own)
        known = sorted({at >> 1 for at in known})
        level, size = level + 1, (size + 1) >> 1
    proofs = [[own[at >> height] for height, own in enumerate(steps)] for at in places]
    columns = {name: wanted[name] for name in wanted.column_names if name != "block"}
    columns["siblings"] = pa.array(proofs, pa.list_(_STEP))
    columns["subroot"] = pa.array([nodes[level, 0]] * len(places), pa.string())
    return pa.table(columns)


def _proved(leaves: DataFrame, tiers: list[DataFrame]) -> DataFrame:
    """The given leaves of one manifest with their siblings, and the root of their tree."""
    wanted = leaves.withColumn("block", F.shiftright("place", TIER))
    lacks = wanted.select("tree", "block", "place", "n").groupBy("tree", "block")
    lacks = store(lacks.applyInArrow(_lacks, _COORDINATES), "lacking")
    least = lacks.agg(F.min("level")).first()[0] or 0
    # Tier t has the levels from (t - 1) * TIER + 1 to t * TIER; tier 0 has the leaves.
    nodes = None
    for number, tier in enumerate(tiers):
        if number * TIER >= least:
            tier = tier.where(F.col("level") >= least)
            nodes = tier if nodes is None else nodes.unionAll(tier)
    named = nodes.toDF("name", "height", "at", "digest")
    fetched = lacks.join(
        named,
        F.col("tree").eqNullSafe(F.col("name"))
        & (F.col("level") == F.col("height"))
        & (F.col("place") == F.col("at")),
    ).drop("name", "height", "at")
    schema = f"{leaves.schema.simpleString()[7:-1].replace(':', ' ')}, {_PROOF}"
    groups = fetched.groupBy("tree", "block")
    return wanted.groupBy("tree", "block").cogroup(groups).applyInArrow(_expanded, schema)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of the wanted rows of ``manifest.leaves``, all of them if None.

    Columns: tree (the language), place, doc_id, leaf, claimed, siblings from the leaf to the
    root of the table, subroot, root.
    """
    own = _proved(manifest.leaves if wanted is None else wanted, manifest.tiers)
    top = _proved(manifest.top.leaves, manifest.top.tiers).select(
        F.col("lang").alias("name"),
        F.col("siblings").alias("upper"),
        F.col("subroot").alias("root"),
    )
    # Proofs of the roots have a row for each language.
    whole = own.join(store(top, "root_proofs"), F.col("tree").eqNullSafe(F.col("name")))
    return whole.withColumn("siblings", F.concat("siblings", "upper")).drop("name", "upper", "n")


def folded(start: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and its siblings."""

    def step(digest: Column, sibling: Column) -> Column:
        other = F.coalesce(sibling["digest"], F.lit(""))
        both = F.when(sibling["left"], F.concat(other, digest)).otherwise(F.concat(digest, other))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(siblings, start, step)


def proof_digest(siblings: Column) -> Column:
    """One hash over all siblings of a proof, from the leaf up."""
    digests = F.transform(siblings, lambda x: F.coalesce(x["digest"], F.lit("")))
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


# Rows whose id gives this remainder are tampered with in the query.
TAMPERED = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 = 0"


def tampered_leaf() -> Column:
    """The row's leaf as it would be with one more in n_chars, for some rows."""
    return F.when(F.expr(TAMPERED), leaf(n_chars=F.col("n_chars") + 1)).otherwise(leaf())


def audited(docs: DataFrame) -> DataFrame:
    """Every row's leaf, roots and proof, and whether its claimed leaf meets the root."""
    proofs = prove(build(docs, tampered_leaf()))
    root = folded(F.col("claimed"), F.col("siblings"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("siblings")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(n_chars: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END" for v in values]
    return f"sha256({' || '.join(parts)})"


# That SQL has no crc32: each byte goes into the remainder, which then takes eight steps.
_TAMPERED_SQL = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, step: xor(x >> 1, 3988292384 * (x & 1))))) % 7 = 0"""

_SIBLING = "s.level = f.level AND s.place = xor(f.place, 1)"
_STEP_SQL = """f.level + 1, f.place // 2, (f.n + 1) // 2,
           sha256(CASE WHEN f.place % 2 = 1 THEN coalesce(s.digest, '') || f.digest
                       ELSE f.digest || coalesce(s.digest, '') END),
           f.proof || coalesce(s.digest, '')"""

# DuckDB SQL of ``audited`` over ``documents``.
SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
           CASE WHEN {_TAMPERED_SQL} THEN {_sql_leaf("(n_chars + 1)")}
                ELSE {_sql_leaf("n_chars")} END AS claimed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS "row"
    FROM leaves),
nodes AS (
    SELECT lang, 0 AS level, place, n, leaf AS digest FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, any_value((n + 1) // 2),
           sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY lang, level, place // 2),
roots AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
           count(*) OVER () AS n
    FROM nodes WHERE n = 1),
uppers AS (
    SELECT 0 AS level, place, n, digest FROM roots
    UNION ALL
    SELECT level + 1, place // 2, any_value((n + 1) // 2),
           sha256(string_agg(digest, '' ORDER BY place))
    FROM uppers WHERE n > 1 GROUP BY level, place // 2),
folds AS (
    SELECT "row", lang, 0 AS level, place, n, claimed AS digest, '' AS proof FROM placed
    UNION ALL
    SELECT f."row", f.lang, {_STEP_SQL}
    FROM folds f LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND {_SIBLING}
    WHERE f.n > 1),
whole AS (
    SELECT f."row", 0 AS level, r.place, r.n, f.digest, f.proof, r.digest AS subroot
    FROM folds f JOIN roots r ON f.lang IS NOT DISTINCT FROM r.lang WHERE f.n = 1
    UNION ALL
    SELECT f."row", {_STEP_SQL}, f.subroot
    FROM whole f LEFT JOIN uppers s ON {_SIBLING} WHERE f.n > 1)
SELECT p.doc_id, p.leaf, w.subroot, u.digest AS root, sha256(w.proof) AS proof_sha256,
       w.digest AS folded_root, w.digest = u.digest AS verified
FROM placed p JOIN whole w ON p."row" = w."row" AND w.n = 1 JOIN uppers u ON u.n = 1
"""
