"""Personal data: rules with checks, and boosted trees for what the rules leave out.

Generators propose spans on the whole text of each document: the four base rules before their
checks, and wide forms of them that may overlap the others. A base match that passes its check is
found for good. Base matches are labelled by their check, wide spans by the checked matches they
overlap; boosted trees learn from these which format and which surroundings mean personal data. Wide
forms match base forms too, and features do not show the marks that only base forms have, as otherwise
all that lacks them would be labelled wrong or look unlike what is right. For
each kind a threshold is calibrated on labelled wide spans the trees did not see, and wide spans
without a label that score above it are added. A kind with too few spans to calibrate adds none.

Every step is an expression, a join or a tree ensemble of Spark's own library.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolake.llm.text import let, running_totals, text_of
from radiolake.session import stage

KINDS = ("email", "ip", "card", "phone")
#: The base rules. Possessive quantifiers and the conditions on where a match may begin change no
#: match: they keep long runs from being tried again from each of their characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wide forms: base forms and spelt-out addresses, addresses of sixteen bytes, digit groups with other
#: separators, phones without a plus.
_DIGITS = r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,30}+"
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?:::?[0-9A-Fa-f]{1,4}+|\.[0-9]{1,4}+){3,7}+",
    "card": _DIGITS,
    "phone": _DIGITS.replace("(?<![0-9A-Za-z])", r"(?:\+|(?<![0-9A-Za-z+]))", 1),
}
#: What a text must contain for a rule to be tried.
_NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+"}
_WIDE_NEEDS = {"email": r"@|[\[(]at[\])]", "ip": r"[0-9A-Fa-f]:|\.[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: Words before a span that speak for its kind.
CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|pay|credit|amex",
    "phone": "phone|call|tel|mobile|fax|ring",
}
CONTEXT = 32
#: The trees learn from this many labelled spans at most, taken by a hash of their place.
TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 3
#: A threshold needs this precision on this many labelled wide spans of its kind.
PRECISION, CALIBRATION_ROWS = 0.98, 50

_SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"


def _spans(text: Column, kind: str, pattern: str, needs: str) -> Column:
    """Matches from left to right, without overlap, in code points; the end is exclusive."""

    def placed(found: Column) -> Column:
        def of(between: Column) -> Column:
            before = running_totals(
                F.transform(found, lambda m, i: F.length(m) + F.length(F.get(between, i)))
            )
            return let(
                before,
                lambda b: F.transform(
                    found,
                    lambda m, i: let(
                        (F.get(b, i) + F.length(F.get(between, i))).cast("int"),
                        lambda at: F.struct(
                            F.lit(kind).alias("kind"),
                            at.alias("start"),
                            (at + F.length(m)).alias("end"),
                            m.alias("match"),
                        ),
                    ),
                ),
            )

        return F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(
            let(F.split(text, pattern, -1), of)
        )

    return F.when(
        text.rlike(needs), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    ).otherwise(F.array().cast(_SPAN))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check digit of card numbers, from the right, for up to 40 digits."""

    def worth(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)
    )
    return (F.length(digits).between(1, 40)) & (total % 10 == 0)


def _passes(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9]?)"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _with_context(span: Column, text: Column, good: Column) -> Column:
    first = F.greatest(span["start"] - CONTEXT, F.lit(0))
    return F.struct(
        span["kind"].alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        span["match"].alias("match"),
        F.lower(F.substring(text, first + 1, span["start"] - first)).alias("before"),
        F.substring(text, span["end"] + 1, F.lit(1)).alias("after"),
        good.alias("label"),
    )


def proposals(documents: DataFrame) -> DataFrame:
    """row, doc_id, text_hash, base (checked spans) and proposed (all spans with context and label).

    Narrow: each text is searched where it lies, and only spans leave it.
    """
    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64(text_of()).alias("text_hash"),
        text_of().alias("text"),
    )
    text = F.col("text")
    raw = F.concat(*[_spans(text, k, BASE[k], _NEEDS[k]) for k in KINDS])
    wide = F.concat(*[_spans(text, k, WIDE[k], _WIDE_NEEDS[k]) for k in KINDS])

    def passes(s: Column) -> Column:
        check = F.lit(False)
        for k in KINDS:
            check = F.when(s["kind"] == k, _passes(k, s["match"])).otherwise(check)
        return check

    def judged(good: Column, s: Column) -> Column:
        """A wide span that overlaps a checked one of its kind is right, one that overlaps any other or
        is of the base form and fails the check is wrong, and one by itself is open."""

        def overlaps(g: Column) -> Column:
            return (g["start"] < s["end"]) & (s["start"] < g["end"])

        same = F.exists(good, lambda g: (g["kind"] == s["kind"]) & overlaps(g))
        form = F.lit(False)
        for k in KINDS:
            form = F.when(s["kind"] == k, s["match"].rlike(f"^{BASE[k]}$")).otherwise(form)
        return F.when(same, F.lit(1)).when(F.exists(good, overlaps) | (form & ~passes(s)), F.lit(0))

    found = let(
        raw,
        lambda r: let(
            F.filter(r, passes),
            lambda good: F.struct(
                good.alias("base"),
                F.concat(
                    F.transform(r, lambda s: _with_context(s, text, passes(s).cast("int"))),
                    F.transform(wide, lambda s: _with_context(s, text, judged(good, s))),
                ).alias("proposed"),
                F.size(r).alias("n_raw"),
            ),
        ),
    )
    return numbered.select("row", "doc_id", "text_hash", found.alias("f")).select(
        "row", "doc_id", "text_hash", "f.base", "f.proposed", "f.n_raw"
    )


FEATURES = (
    "f_length", "f_digits", "f_letters", "f_separators", "f_kinds_of_separators", "f_groups",
    "f_longest_group", "f_parenthesis", "f_luhn", "f_cue", "f_joined_before",
    "f_joined_after", *[f"f_is_{k}" for k in KINDS],
)


def _plain(kind: Column, match: Column) -> Column:
    """A match without the marks that tell base forms from wide ones of the same kind."""
    email = F.regexp_replace(match, r"\x20?(?:@|\[at\]|\(at\))\x20?", "@")
    email = F.regexp_replace(email, r"\x20?(?:\.|\[dot\]|\(dot\))\x20?", ".")
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.regexp_replace(match, "::?", "."))
        .when(kind == "phone", F.translate(match, "+", ""))
        .otherwise(match)
    )


def featured(spans: DataFrame) -> DataFrame:
    """spans with FEATURES; they need kind, match, before and after."""
    spans = spans.withColumn("plain", _plain(F.col("kind"), F.col("match")))
    match, digits = F.col("plain"), _digits(F.col("plain"))
    separators = F.regexp_replace(match, "[0-9A-Za-z]", "")
    groups = F.array_remove(F.split(match, "[^0-9A-Za-z]+"), "")
    cue = F.lit(False)
    for k in KINDS:
        cue = F.when(F.col("kind") == k, F.col("before").rlike(CUES[k])).otherwise(cue)
    columns = {
        "f_length": F.least(F.length(match), F.lit(200)),
        "f_digits": F.length(digits),
        "f_letters": F.length(F.regexp_replace(match, "[^A-Za-z]", "")),
        "f_separators": F.length(separators),
        "f_kinds_of_separators": F.size(F.array_distinct(F.split(separators, ""))),
        "f_groups": F.size(groups),
        "f_longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "f_parenthesis": match.contains("("),
        "f_luhn": _luhn(digits),
        "f_cue": cue,
        "f_joined_before": F.col("before").rlike("[0-9a-z]$"),
        "f_joined_after": F.col("after").rlike("^[0-9A-Za-z]"),
    } | {f"f_is_{k}": F.col("kind") == k for k in KINDS}
    return spans.withColumns(
        {n: F.coalesce(c.cast("double"), F.lit(0.0)) for n, c in columns.items()}
    ).drop("plain")


def _fitted(labelled: DataFrame) -> GBTClassificationModel | None:
    """Trees over a bounded sample; None where it does not hold both labels."""
    order = F.xxhash64("text_hash", "start", "end", "kind")
    sample = stage(labelled.orderBy(order, "wide").limit(TRAIN_ROWS), "pii_sample")
    if sample.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=11).fit(
        assembled.select("features", F.col("label").cast("double").alias("label"))
    )


def _added(found: DataFrame) -> DataFrame:
    """row, kind, start, end of the open wide spans that score above their kind's threshold."""
    spans = stage(
        featured(
            found.select("row", "text_hash", "n_raw", F.posexplode("proposed").alias("i", "s")).select(
                "row", "text_hash", (F.col("i") >= F.col("n_raw")).alias("wide"), "s.*"
            )
        ).select("row", "text_hash", "wide", "kind", "start", "end", "label", *FEATURES),
        "pii_spans",
    )
    unseen = F.pmod(F.xxhash64("text_hash", F.lit(5)), F.lit(2)) == 0
    model = _fitted(spans.filter("label IS NOT NULL").filter(~unseen))
    nothing = spans.filter("false").select("row", "kind", "start", "end")
    if model is None:
        return nothing
    scored = model.transform(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(spans.filter("wide"))
    ).withColumn("score", F.round(vector_to_array("probability")[1], 3))

    # Precision at or above each score, per kind: of rounded scores there are a thousand.
    tested = scored.filter(F.col("label").isNotNull() & unseen)
    at = tested.groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("label").alias("good"))
    down = Window.partitionBy("kind").orderBy(F.col("score").desc())
    bounds = (
        at.select("kind", "score", F.sum("n").over(down).alias("n"), F.sum("good").over(down).alias("good"))
        .filter((F.col("n") >= CALIBRATION_ROWS) & (F.col("good") >= PRECISION * F.col("n")))
        .groupBy(F.col("kind").alias("_kind"))
        .agg(F.min("score").alias("_bound"))
    )
    return (
        scored.filter("label IS NULL")
        .join(F.broadcast(bounds), F.col("kind") == F.col("_kind"))  # a row per kind
        .filter("score >= _bound")
        .select("row", "kind", "start", "end")
        .distinct()
    )


def _text_of_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, base and spans (kind, start, end; by kind as in KINDS, then start): one row
    for each row.

    A NULL or empty text has no spans. Repeated rows are searched each. No documents give no rows.
    """
    found = stage(proposals(documents), "pii_found")
    more = (
        _added(found)
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    )
    order = F.array(*[F.lit(k) for k in KINDS])

    def keyed(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                F.array_position(order, s["kind"]).alias("o"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )

    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return found.join(more, "row", "left").select(
        "doc_id",
        "text_hash",
        "base",
        F.sort_array(F.concat(keyed(F.col("base")), keyed(F.coalesce("more", none)))).alias("spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    """personal_data() in the columns of the registered query."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_text_of_spans(F.col("base")), 256).alias("base_sha256"),
        _text_of_spans(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; n_chars follows, if there.

    Spans that overlap are replaced together, by the kind that begins first.
    """
    found = (
        personal_data(documents)
        .filter(F.size("spans") > 0)
        .groupBy("doc_id", "text_hash")  # repeated rows have equal spans
        .agg(F.first("spans").alias("__spans"))
        .withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    )
    match = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text_of()) == F.col("__hash"))
    in_place = F.sort_array(
        F.transform(
            "__spans",
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        free = s["start"] >= a["at"]
        parts = F.concat(
            a["parts"],
            F.array(
                F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]),
                F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
            ),
        )
        return F.struct(
            F.greatest(a["at"], -s["end"]).alias("at"),
            F.when(free, parts).otherwise(a["parts"]).alias("parts"),
        )

    redacted = F.aggregate(
        in_place,
        start,
        step,
        lambda a: F.concat(
            F.array_join(a["parts"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))
        ),
    )
    out = documents.join(found, match, "left").withColumn(
        "text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(redacted)
    )
    if "n_chars" in documents.columns:
        out = out.withColumn(
            "n_chars",
            F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")),
        )
    return out.select(*documents.columns)
