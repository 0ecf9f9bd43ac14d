"""Mixing sources to target weights: random keys, range sort, prefix sums, exact cuts.

Every source gets a share of the mix by weight, at most a given number of times its own
size; what is above that is shared out anew among the rest by weight. A document's key is
a hash of a seed, its id and its text, so a source's documents are in a random order that
any run finds again. Rows are sorted into ranges of (source, key); sizes are summed per
range, the sums of earlier ranges give each range its place, and a running sum inside the
range gives each document its own. A source repeats as a whole as often as its target
holds it; of one more pass it gives the words up to the target, so the document at the cut
gives its first words only. Taken words of a source add up to its target without fraction.

A range is a part of a source (a source with a third of all rows has many), and no task
holds more than one range's rows, nor does anything go to the driver. Only tables with a
row for each source, and each range, are put in order by one task.

Defined results: a null or empty text has size 0 and nothing taken; a null source is a
source of its own, the last; rows with a null id count like others; equal rows are
neighbours in the order and may be cut differently; a source without words has target 0;
an empty table gives no rows. Other columns are not read, but carried by ``mixed``.
"""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstrata.llm.common import SPACES, store, text_of, words_of

# Weights of the sources in order of their names, again and again.
WEIGHTS = (3, 1, 2)
# Words of the mix, as a share of all words.
SHARE = Fraction(3, 2)
# How often a source may be in the mix at most.
MOST = 2
SEED = "mix"

_EXACT = "decimal(38,0)"


def sized(docs: DataFrame, carried: Column, seed: str = SEED) -> DataFrame:
    """Source, number of words, random key and a carried column of each row.

    ``row`` tells equal rows apart, so that a range need not hold all of them.
    """
    parts = (F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    return docs.select(
        carried.alias("carried"),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(text_of())).cast("long").alias("size"),
        F.md5(F.concat_ws(":", *parts).cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target, passes, cut) from (source, source_size).

    Sources are taken in the order in which growing shares reach their limits: one is at
    its limit if what the earlier ones leave, shared by weight, gives it that much. All
    in whole numbers; a target is one division.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    )
    by_limit = Window.orderBy(F.col("limit") * (F.lit(lcm(*weights)) / F.col("weight")).cast("int"), "place")
    known = (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast(_EXACT))
        .withColumn("limit", (F.col("source_size") * most).cast(_EXACT))
        .withColumn("all", (F.sum("source_size").over(every) * share.numerator).cast(_EXACT))
        .withColumn(
            "spent",
            F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn("open", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    )
    exact = lambda name: F.col(name).cast(_EXACT)
    full = F.col("limit") * exact("open") * share.denominator <= (
        F.col("all") - exact("spent") * share.denominator
    ) * F.col("weight")
    marked = known.withColumn("full", full)
    spent = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(every)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every)
    shared = (
        marked.withColumn("left", (F.col("all") - spent * share.denominator).cast(_EXACT))
        .withColumn("top", (F.col("left") * F.col("weight")).cast(_EXACT))
        .withColumn("bottom", (open_ * share.denominator).cast(_EXACT))
    )
    whole = F.when(F.col("full"), F.col("limit").cast("long")).otherwise(F.expr("top div bottom"))
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        F.col("top").cast("double") / F.col("bottom").cast("double")
    )
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    return (
        shared.withColumn("words", whole)
        .withColumn("passes", passes)
        .select(
            "source",
            "source_size",
            target.alias("target"),
            "passes",
            (F.col("words") - F.col("passes") * F.col("source_size")).alias("cut"),
        )
    )


def _planned(docs: DataFrame, carried: Column, seed: str, **rule) -> DataFrame:
    """carried, source, size, key, source_size, target, passes, and words of the last pass."""
    rows = store(sized(docs, carried, seed), "sizes")
    ranges = (
        rows.repartitionByRange("source", "key", "row")
        .sortWithinPartitions("source", "key", "row")
        .withColumn("range", F.spark_partition_id())
    )
    ranges = store(ranges, "ranges")
    sums = ranges.groupBy("source", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = store(
        sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))), "range_sums"
    )
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), **rule)
    named = goals.withColumnRenamed("source", "name")
    places = sums.drop("words").join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    places = places.withColumnsRenamed({"source": "name", "range": "part"})
    inside = (
        Window.partitionBy("source", "range")
        .orderBy("key", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = ranges.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    left = F.col("cut") - F.col("before") - F.col("inside")
    return (
        own.join(
            places,
            (F.col("range") == F.col("part")) & F.col("source").eqNullSafe(F.col("name")),
        )
        .withColumn("last", F.greatest(F.lit(0), F.least("size", left)))
        .drop("name", "part", "before", "inside", "cut", "range", "row")
    )


def mix(docs: DataFrame, seed: str = SEED, **rule) -> DataFrame:
    """Each document's size, its source's size and target, and the words the mix takes of it."""
    taken = F.col("passes") * F.col("size") + F.col("last")
    return _planned(docs, F.col("doc_id"), seed, **rule).select(
        F.col("carried").alias("doc_id"),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        "source",
        F.col("passes").cast("int").alias("passes"),
    )


def mixed(docs: DataFrame, seed: str = SEED, **rule) -> DataFrame:
    """The mix itself: (epoch, document), the columns of a document as they are.

    A text cut in the last epoch is its first words with single spaces. A document without
    words is in no epoch.
    """
    plan = _planned(docs, F.struct(*docs.columns), seed, **rule)
    copies = plan.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("passes") + 1)).alias("epoch")
    ).withColumn("words", F.when(F.col("epoch") <= F.col("passes"), F.col("size")).otherwise(F.col("last")))
    text = F.col("carried")["text"]
    head = F.array_join(F.slice(words_of(text_of("carried.text")), 1, F.col("words").cast("int")), " ")
    cut = F.when(F.col("words") < F.col("size"), head).otherwise(text)
    document = F.col("carried").withField("text", cut)
    return copies.where(F.col("words") > 0).select("epoch", document.alias("document"))


# DuckDB SQL of ``mix`` over ``documents`` with the settings above.
_WORDS = f"len(list_filter(string_split_regex(coalesce(text, ''), '{SPACES}'), lambda x: x <> ''))"
SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
           md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source),
weighed AS (
    SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS HUGEINT) AS weight,
           2 * source_size AS "limit", 3 * sum(source_size) OVER () AS total
    FROM sources),
known AS (
    SELECT *, coalesce(sum("limit") OVER (
                  ORDER BY "limit" * (6 // weight), place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
           sum(weight) OVER (ORDER BY "limit" * (6 // weight), place
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM weighed),
marked AS (
    SELECT *, "limit" * open * 2 <= (total - 2 * spent) * weight AS "full" FROM known),
shared AS (
    SELECT *, (total - 2 * sum(CASE WHEN "full" THEN "limit" ELSE 0 END) OVER ()) * weight AS top,
           2 * sum(CASE WHEN "full" THEN 0 ELSE weight END) OVER () AS bottom
    FROM marked),
goals AS (
    SELECT source, source_size,
           CASE WHEN "full" THEN CAST("limit" AS DOUBLE)
                ELSE CAST(top AS DOUBLE) / CAST(bottom AS DOUBLE) END AS target,
           CASE WHEN "full" THEN "limit" ELSE top // bottom END AS words
    FROM shared),
placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
                 ELSE words // source_size * size
                      + greatest(0, least(size, words % source_size - before)) END AS BIGINT) AS taken,
       p.source, CAST(CASE WHEN source_size = 0 THEN 0 ELSE words // source_size END AS INTEGER) AS passes
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
"""
