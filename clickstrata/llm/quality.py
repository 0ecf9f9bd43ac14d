"""Line-first cleaning: rules per line, then a verdict per document.

A line that breaks a punctuation, navigation or boilerplate rule is removed. A
document is rejected if it is too short or too repetitive as a whole, or if the
removed lines hold too much of its text.

Defined results: a null or empty text has no words and fails the base rules;
lines without a word are neither judged nor counted; repeated rows are judged
each for itself; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickstrata.llm.common import SPACES, computed, text_of, words_of

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
# A document that loses more of its characters than this is rejected.
MOST_LOST = 0.5

# Wording that marks legal notices, site chrome and placeholders.
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie|"
    "licensed under|released under|javascript|lorem ipsum|click here|read more|"
    "sign (in|up)|log in|subscribe|follow us|share this|back to top|copyright"
)
SENTENCE_END = "[.!?:;,…。！？][\"'”’»)\\]]*$"


def line_rules(line: Column) -> dict[str, Column]:
    """The rules a line can break. ``line`` is trimmed and has a word.

    punctuation: much of it is symbols or repeated marks, or it is short and has
    no sentence end. navigation: items set apart by bars, arrows or slashes.
    boilerplate: a short line with the wording of notices.
    """
    length = F.char_length(line)
    symbols = F.char_length(F.regexp_replace(line, "[^#*$%&|<>]+", ""))
    marks = F.regexp_count(line, F.lit(r"[!?.]{2,}(\s|$)"))
    spaces = F.regexp_count(line, F.lit(SPACES))
    bars = F.regexp_count(line, F.lit("(^|\\s)[|»›>/•·]+(?=\\s|$)"))
    return {
        "punctuation": (symbols * 10 > length)
        | (marks * 2 > spaces + 1) & (spaces >= 4)
        | (spaces < 2) & ~line.rlike(SENTENCE_END) & ~line.rlike("[0-9]"),
        "navigation": (bars >= 2) & (bars * 4 > spaces),
        "boilerplate": (length < 200) & F.lower(line).rlike(BOILERPLATE),
    }


def repeated_words(frame: DataFrame) -> DataFrame:
    """Add n_repeat_words: words in windows of eight that occur twice or more in the text.

    Needs the array column ``words``. Only texts with an equal pair of windows
    have them sorted. Windows are compared by 64-bit hashes of word hashes,
    within one text.
    """
    n_windows = F.size("words") - (WINDOW - 1)
    frame = computed(frame, hashes=F.transform("words", lambda w: F.xxhash64(w)))
    frame = computed(
        frame,
        windows=F.when(
            n_windows > 0,
            F.transform(
                F.sequence(F.lit(1), F.greatest(n_windows, F.lit(1))),
                lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("hashes")
    frame = computed(
        frame,
        placed=F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(
                F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop("windows")
    same = lambda x, i: F.get("placed", i)["h"] == x["h"]
    frame = computed(
        frame,
        starts=F.array_sort(
            F.transform(
                F.filter(
                    "placed",
                    lambda x, i: F.coalesce(same(x, i - 1), F.lit(False))
                    | F.coalesce(same(x, i + 1), F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("placed")
    # The words of a window that the next one does not cover as well.
    covered = F.transform(
        "starts",
        lambda s, i: F.least(F.coalesce(F.get("starts", i + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    return frame.select("*", total.alias("n_repeat_words")).drop("starts")


def assess(docs: DataFrame) -> DataFrame:
    """Counts, base rules, cleaned text and verdict of every document."""
    text = text_of()
    frame = docs.select("doc_id", text.alias("text"))
    frame = computed(frame, words=words_of(F.col("text")))
    frame = frame.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", "[^#*$%&|<>]+", ""))
        .cast("long")
        .alias("n_symbols"),
    )
    frame = repeated_words(frame).drop("words")
    frame = computed(
        frame,
        lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    ).drop("text")
    trimmed = lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    frame = computed(
        frame,
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        trimmed=F.transform("lines", trimmed),
    ).drop("lines")
    broken = lambda x: F.concat_ws(
        ",", *(F.when(rule, F.lit(name)) for name, rule in line_rules(x).items())
    )
    frame = computed(frame, broken=F.transform("trimmed", broken))
    chars = lambda lines: F.aggregate(
        lines, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)
    )
    good = F.filter("trimmed", lambda x, i: F.get("broken", i) == "")
    frame = computed(frame, good=good)
    frame = computed(frame, n_chars=chars("trimmed"), kept_chars=chars("good"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )
    lost = F.col("n_chars") - F.col("kept_chars")
    return frame.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (lost <= F.col("n_chars") * MOST_LOST)).alias("kept"),
        F.size("trimmed").cast("long").alias("n_lines"),
        (F.size("trimmed") - F.size("good")).cast("long").alias("n_bad_lines"),
        F.array_join("good", "\n").alias("cleaned"),
    )
