"""Personal data: candidates, boosted trees, redaction; SQL expressions only.

Certain forms of addresses, card and phone numbers always count (``base``). For
the rest, high-recall patterns propose spans which may overlap; boosted trees, one
set for each kind, score them by format and context, and those above a calibrated
threshold are added unless they touch a span already chosen.

The trees learn from the candidates that show what they are, inside certain spans or
not: check sums, octets, announcing words, the grouping of digits, the end of a host
name on the one side; dates, decimals, marked numbers, failed check sums and ends of
sentences on the other. Candidates without such signs are scored, but not learnt from,
and what makes a span certain (``+``, ``@``) is no feature. A few written examples are
added, so that both sides of each kind are known for any corpus.

Spans are code points, end exclusive. Defined results: a null or empty text has
no spans; repeated rows are searched each for itself; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickstrata.llm.boosting import Trees, fit
from clickstrata.llm.common import computed, store, text_of

KINDS = ("email", "ip", "card", "phone")

# The base forms. A local part can only begin where a run of its characters
# does, or where the last match ended: so each run is scanned once. Maximal
# chains of digits never overlap, so lengths beyond 13 to 19 are left out here.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# The generators of further candidates, and the kind their spans get.
SPELLED_DOT = r" ?(?:\(dot\)|\[dot\]|\{dot\}) ?"
SPELLED_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?"
    rf"[A-Za-z0-9-]++(?: ?\. ?|{SPELLED_DOT})[A-Za-z0-9-]++(?:(?:\.| \. |{SPELLED_DOT})[A-Za-z0-9-]++)*+"
)
SPACED_IP = r"(?<![0-9])[0-9]{1,3}(?: ?[.\[\]]{1,3} ?[0-9]{1,3}){3}(?![0-9])"
DIGITS = r"(?<![0-9+])\+?\(?[0-9][0-9 ()./_-]{6,38}[0-9](?![0-9])"
# Numbers as long as a card's, also beside others.
NUMBER = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ ./_-][0-9]{4}){3})(?![0-9])"
GENERATORS = (("email", SPELLED_EMAIL), ("ip", SPACED_IP), ("digits", DIGITS), ("number", NUMBER))
CONTEXT = 24
# What each side of a kind weighs in all.
WEIGHT = 1000.0
# Words that announce a number.
PHONE_WORDS = r"(?i)\b(tel|phone|call|fax|mobile|cell|whatsapp|sms)\b[^\n]{0,12}$"
CARD_WORDS = r"(?i)\b(card|visa|mastercard|amex|credit|debit|pan)\b[^\n]{0,12}$"
ID_WORDS = (
    r"(?i)\b(order|id|ref|invoice|isbn|issn|version|nr|no|number|item|article|serial|ticket|case)"
    r"\b[^\n]{0,8}$"
)
# Forms of numbers that are no personal data, and of telephone numbers without a plus.
DATE = (
    r"^\(?(?:[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ](?:19|20)[0-9]{2}|"
    r"(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|(?:(?:19|20)[0-9]{2}[-./ ]+)+(?:19|20)[0-9]{2})"
    r"(?![0-9])"
)
DECIMAL = r"^[0-9]+\.[0-9]+$|^[1-9][0-9]{0,2}(?:[. ][0-9]{3})+$"
NATIONAL = (
    r"^\(?[2-9][0-9]{2}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}$|"
    r"^\(?0[0-9]{1,5}\)?[ /.-]{1,3}[0-9][0-9 .-]{4,}$"
)
# The end of a sentence, where a host name or an address would go on.
LOOSE = r"[A-Za-z0-9\])}]\. "
FEATURES = [
    "digits", "groups", "longest", "luhn", "octets", "before", "word", "shape", "lead", "loose",
    "host",
]
# Examples of personal data, and of what looks like it.
PRIVATE = (
    "write to name (at) host (dot) org",
    "a.name [at] mail.host.com",
    "from 192[.]0[.]2[.]17 today",
    "card 4111.1111.1111.1111 expires",
    "tel 030 1234567",
    "call (555) 010-9999",
)
PUBLIC = (
    "look @ this. Then go",
    "two (at) 3.50 each",
    "1. 2. 3. 4 steps",
    "about 812.1.2.3 or 1.2.3.999",
    "the run 4111.1111.1111.1112 fails",
    "on 2024-01-31 and 31.01.2024",
    "pi is 3.14159265 so 1 234 567 890",
    "order #12345678 or AB123456789",
    "keys 1234567890 1234567894",
)


def _array(of: str) -> Column:
    return F.array().cast(f"array<{of}>")


HIT = "struct<start:int,end:int,value:string>"


def located(text: str, pattern: str, gate: Column | None = None) -> Column:
    """Leftmost non-overlapping matches with their places.

    The pieces between the matches tell where each begins.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"))
    start = lambda at, x: at["at"] + F.char_length(x["gap"])
    placed = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), _array(HIT).alias("hits")),
        lambda at, x: F.struct(
            (start(at, x) + F.char_length(x["hit"])).alias("at"),
            F.concat(
                at["hits"],
                F.array(
                    F.struct(
                        start(at, x).alias("start"),
                        (start(at, x) + F.char_length(x["hit"])).alias("end"),
                        x["hit"].alias("value"),
                    )
                ),
            ).alias("hits"),
        ),
        lambda at: at["hits"],
    )
    found = F.col(text).rlike(pattern)
    return F.when(found if gate is None else gate & found, placed).otherwise(_array(HIT))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits pass the check sum of card numbers."""
    digits = F.filter(F.split(F.reverse(digits_of(value)), ""), lambda d: d != "")
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: str = "text") -> dict[str, Column]:
    """The spans of each kind that always count."""
    count = lambda x: F.char_length(digits_of(x["value"]))
    return {
        "email": located(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(
            located(text, IP), lambda x: x["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
        ),
        "card": F.filter(located(text, CARD), lambda x: luhn(x["value"])),
        "phone": F.filter(
            located(text, PHONE, F.contains(text, F.lit("+"))),
            lambda x: (count(x) >= 9) & (count(x) <= 15),
        ),
    }


def _kinded(hits: Column, kind: int) -> Column:
    return F.transform(
        hits, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"], x["end"], x["value"])
    )


def search(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, the base spans, and all candidates with their context; whole: all columns as well.

    Those are called own_0, own_1, ... so that they clash with none.
    """
    own = [F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(docs.columns)] if whole else []
    frame = docs.select("doc_id", text_of().alias("text"), *own)
    frame = computed(frame, **base_spans())
    gates = {"email": F.col("text").rlike(r"@|[(\[{]at[)\]}]"), "ip": None, "digits": None, "number": None}
    frame = computed(
        frame, **{f"c_{name}": located("text", p, gates[name]) for name, p in GENERATORS}
    )
    base = F.concat(*(_kinded(F.col(kind), at) for at, kind in enumerate(KINDS)))
    found = F.concat(
        *(_kinded(F.col(f"c_{name}"), at) for at, (name, _) in enumerate(GENERATORS))
    )
    frame = computed(
        frame,
        base=F.when(F.size(base) > 0, F.array_sort(base)).otherwise(base),
        found=found,
    )
    before = lambda x: F.substring(
        F.col("text"), F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1,
        F.least(x["start"], F.lit(CONTEXT)),
    )
    touch = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    with_context = F.transform(
        "found",
        lambda x: F.struct(
            x["kind"].alias("generator"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["value"].alias("value"),
            before(x).alias("before"),
            F.transform(F.filter("base", lambda b: touch(b, x)), lambda b: b["kind"]).alias("over"),
        ),
    )
    return frame.select(
        "doc_id",
        "base",
        with_context.alias("candidates"),
        *(c for c in frame.columns if c.startswith("own_")),
    )


def features_of(x: Column) -> dict[str, Column]:
    """Format and context of a candidate as small whole numbers."""
    value, digits = F.ltrim(x["value"], F.lit("+")), digits_of(x["value"])
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    longest = F.array_max(F.transform(groups, F.char_length))
    octets = F.size(F.filter(groups, lambda g: g.rlike(rf"^{OCTET}$")))
    word = (
        F.when(x["before"].rlike(PHONE_WORDS), 1)
        .when(x["before"].rlike(CARD_WORDS), 2)
        .when(x["before"].rlike(ID_WORDS), 3)
    )
    last = F.right(x["before"], F.lit(1))
    shape = F.when(value.rlike(DATE), 1).when(value.rlike(DECIMAL), 2).when(value.rlike(NATIONAL), 3)
    return {
        "digits": F.least(F.char_length(digits), F.lit(20)),
        "groups": F.least(F.size(groups), F.lit(6)),
        "longest": F.least(F.coalesce(longest, F.lit(0)), F.lit(20)),
        "luhn": ((F.char_length(digits) > 0) & luhn(value)).cast("int"),
        "octets": F.least(octets, F.lit(5)),
        "before": F.when(last.rlike("[A-Za-z0-9]"), 1).when(last.rlike("[#/_.=-]"), 2).otherwise(0),
        "word": F.coalesce(word, F.lit(0)),
        "shape": F.coalesce(shape, F.lit(0)),
        "lead": value.rlike(r"^\(?0").cast("int"),
        "loose": value.rlike(LOOSE).cast("int"),
        "host": value.rlike("(?:^|[^A-Za-z0-9-])[A-Za-z]{2,24}$").cast("int"),
    }


def kind_of(x: Column, f: dict[str, Column]) -> Column:
    """A digit run is a card if as long as one, else a phone number; so is one announced as such."""
    phone = (f["digits"] < 13) | ((f["word"] == 1) & (f["digits"] <= 15))
    phone = phone & (x["generator"] == 2)
    return (
        F.when(x["generator"] < 2, x["generator"])
        .when(phone, F.lit(KINDS.index("phone")))
        .otherwise(F.lit(KINDS.index("card")))
    )


def featured(candidates: Column) -> Column:
    """Candidates with their kind and, as ``f``, their features."""

    def whole(x: Column) -> Column:
        f = F.struct(*(c.alias(n) for n, c in features_of(x).items()))
        own = (x[n].alias(n) for n in ("generator", "start", "end", "value", "over"))
        return F.struct(*own, f.alias("f"))

    def kinded(x: Column) -> Column:
        kind = kind_of(x, {n: x["f"][n] for n in FEATURES})
        return F.struct(
            kind.alias("kind"), *(x[n].alias(n) for n in ("start", "end", "value", "over", "f"))
        )

    return F.transform(F.transform(candidates, whole), kinded)


def evidence(x: Column) -> Column:
    """Whether a candidate shows that it is personal data; null if it shows neither."""
    f = {n: x["f"][n] for n in FEATURES}
    alike, elsewhere = F.array_contains(x["over"], x["kind"]), F.size(x["over"]) > 0
    marked = (f["before"] > 0) | (f["word"] == 3)
    number = f["shape"].isin(1, 2)
    spelled = x["value"].rlike(r"[(\[{](?:at|dot)[)\]}]")
    # Without its plus an undivided number without a word for it tells nothing.
    told = (f["groups"] > 1) | (f["word"] == 1)
    email = (
        F.when(alike, F.when(f["host"] == 1, True))
        .when((f["host"] == 0) | (f["loose"] == 1), False)
        .when(spelled, True)
    )
    ip = (
        F.when(alike, True)
        .when((f["octets"] != 4) | (f["loose"] == 1), False)
        .when(F.contains(x["value"], F.lit("[")), True)
    )
    card = (
        F.when(alike, True)
        .when((f["digits"] > 19) | number | marked | elsewhere, False)
        .when(f["luhn"] == 1, True)
        .when(f["word"] != 2, False)
    )
    phone = (
        F.when(alike, F.when(told, True))
        .when((f["digits"] < 7) | number | elsewhere | (f["octets"] == 4) & (f["groups"] == 4), False)
        .when(f["word"] == 1, True)
        .when(marked | (f["groups"] == 1) & (f["lead"] == 0), False)
        .when((f["shape"] == 3) & (f["digits"] >= 9), True)
    )
    found = F.lit(None).cast("boolean")
    for at, one in enumerate((email, ip, card, phone)):
        found = F.when(x["kind"] == at, one).otherwise(found)
    return found


def examples(spark: SparkSession) -> DataFrame:
    """The candidates of the written examples: x, and whether they are personal data."""
    texts = F.array(
        *(
            F.struct(F.lit(text).alias("text"), F.lit(yes).alias("yes"))
            for yes, group in ((True, PRIVATE), (False, PUBLIC))
            for text in group
        )
    )
    docs = spark.range(1).select(F.inline(texts)).withColumn("doc_id", F.lit(0))
    found = search(docs, whole=True).withColumnRenamed("own_1", "yes")
    return found.select("yes", F.explode(featured(F.col("candidates"))).alias("x")).select("x", "yes")


def fit_selector(found: DataFrame) -> list[Trees]:
    """Boosted trees for each kind, from the candidates that show what they are.

    They are counted by feature vector; vectors are a few small numbers, so their
    table does not grow with the data. The two sides of a kind weigh the same.
    """
    rows = found.select(F.explode(featured(F.col("candidates"))).alias("x"))
    rows = rows.select("x", evidence(F.col("x")).alias("yes"))
    rows = rows.where(F.col("yes").isNotNull()).unionAll(examples(found.sparkSession))
    counts = rows.groupBy("x.kind", "x.f").agg(
        F.count_if("yes").alias("yes"), F.count_if(~F.col("yes")).alias("no")
    )
    table = counts.collect()
    models = []
    for kind in range(len(KINDS)):
        own = sorted(
            ((r.f.asDict(), r.yes, r.no) for r in table if r.kind == kind),
            key=lambda r: tuple(r[0].values()),
        )
        yes, no = max(1, sum(r[1] for r in own)), max(1, sum(r[2] for r in own))
        models.append(fit([(f, WEIGHT * p / yes, WEIGHT * n / no) for f, p, n in own], FEATURES))
    return models


def select_spans(found: DataFrame, models: list[Trees]) -> DataFrame:
    """doc_id, base spans and all spans: those added score high and touch no other span."""
    frame = computed(found, open=featured(F.filter("candidates", lambda x: F.size(x["over"]) == 0)))

    def scores_high(x: Column) -> Column:
        f = {n: x["f"][n] for n in FEATURES}
        high = F.lit(False)
        for kind, model in enumerate(models):
            own = model.score(f) >= model.threshold
            high = F.when(x["kind"] == kind, own).otherwise(high)
        return high

    frame = computed(frame, extra=F.filter("open", scores_high))
    # Of candidates that overlap, the one of the first generator stays.
    clear = F.filter(
        "extra",
        lambda x, i: ~F.exists(
            F.slice("extra", 1, i),
            lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]),
        ),
    )
    added = F.transform(
        clear,
        lambda x: F.struct(
            x["kind"].alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["value"].alias("value"),
        ),
    )
    spans = F.array_sort(F.concat(F.col("base"), added))
    return frame.withColumn("spans", spans).drop("candidates", "open", "extra")


def as_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"]),
        ),
        ",",
    )


def detect(docs: DataFrame) -> DataFrame:
    """Spans of every document; the search result is stored, fitted on, and scored."""
    found = store(search(docs), "pii")
    return select_spans(found, fit_selector(found))


def mask(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are one."""
    names = F.array(*(F.lit(f"[{kind}]") for kind in KINDS))
    ordered = F.array_sort(
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"], x["kind"]))
    )
    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.when(x["start"] < a["at"], F.struct(
            F.greatest(a["at"], x["end"]).alias("at"), a["out"].alias("out")
        )).otherwise(
            F.struct(
                x["end"].alias("at"),
                F.concat(
                    a["out"],
                    F.substring(text, a["at"] + 1, x["start"] - a["at"]),
                    F.get(names, x["kind"]),
                ).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with their spans masked; a column n_chars follows the new text."""
    models = fit_selector(store(search(docs), "pii"))
    found = select_spans(search(docs, whole=True), models)
    own = {c: F.col(f"own_{i}") for i, c in enumerate(docs.columns)}
    found = computed(found, masked=mask(own["text"].cast("string"), F.col("spans")))
    new = own | {"text": F.col("masked")}
    if "n_chars" in own:
        changed = F.char_length("masked").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("spans") > 0, changed).otherwise(own["n_chars"])
    return found.select(*(new[c].alias(c) for c in docs.columns))
