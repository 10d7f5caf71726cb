"""Quality rules with thresholds that each language and source sets itself.

One pass measures every document. Measures go into histograms with buckets of bounded relative
width, one per language, source and measure: a quantile sketch whose merge is a sum of counts, so
it combines before every exchange and does not depend on the order of rows. Documents that fail the
base rules are not in them. The thresholds are tail quantiles of each sketch, drawn towards those of
the language, and these towards those of all, the more the fewer documents there are; a join brings
them to the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolake.llm.text import SPACES, count_of, join_same, let, only, space_words, text_of, total

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


@dataclass(frozen=True)
class Fence:
    """A measure is an outlier above a group's upper quantile, or below its lower one, by a margin.

    `upper` and `lower` are percents of the group's documents. `upper` stays below the share of
    documents that bad sources spoil, so 90 for what junk shows and 99 for what good texts show now
    and then too. The margin is `slack` percent of the quantile and `least` thousandths, which keep
    a source of equal documents from rejecting the first one that differs a little.
    """

    measure: str
    upper: int
    slack: int
    least: int
    lower: int | None = None


FENCES = (
    Fence("word_length", upper=90, slack=10, least=100, lower=1),
    Fence("symbols_per_word", upper=90, slack=50, least=50),
    Fence("duplicate_lines", upper=99, slack=50, least=50),
    Fence("repeated_words", upper=99, slack=100, least=50),
)
#: A group's quantile counts as many documents as the group has, that of the level above as many as this.
PRIOR = 200


def _repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur at least twice."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        again = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: F.coalesce(
                            F.when(i > 0, F.get(s, i - 1)["h"] == x["h"]), F.lit(False)
                        )
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["p"],
                )
            ),
        )
        return let(
            again,
            lambda at: total(
                F.transform(
                    at,
                    lambda p, i: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))
                    ).cast("long"),
                )
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))),
    )
    several = let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            covered(h)
        ),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(several)


def measured(documents: DataFrame) -> DataFrame:
    """The document's columns it needs and the base counts, one row per row. Narrow.

    A NULL text counts as empty. Empty texts have zero everywhere.
    """
    text = text_of()
    has_word = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0
    )
    words = let(
        space_words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words")
        ),
    )
    lines = let(
        has_word,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return documents.withColumns(
        {
            "_w": words,
            "_l": lines,
            "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
            "n_symbols": count_of(text, SYMBOLS),
        }
    ).withColumns(
        {
            "n_words": F.col("_w")["n_words"],
            "n_repeat_words": F.col("_w")["n_repeat_words"],
            "n_lines": F.col("_l")["n_lines"],
            "n_dup_lines": F.col("_l")["n_dup_lines"],
        }
    ).drop("_w", "_l")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


#: Part and whole of each measure; it counts thousandths, rounded down.
MEASURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
}


def _thousandths(measure: str) -> Column:
    part, whole = MEASURES[measure]
    return F.expr(f"{part} * 1000 div greatest({whole}, 1)")


def bucket(value: Column) -> Column:
    """A whole number below 128 stands for itself, a larger one for its seven leading bits."""
    shift = F.length(F.bin(value)) - 7
    cut = F.pow(F.lit(2), F.greatest(shift, F.lit(0))).cast("long")
    return value - value % cut


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: the sketches of all documents that pass the base rules.

    Two sketches are merged by adding n.
    """
    each = counts.filter(~base_failed()).select(
        "lang",
        "source",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("measure"), _thousandths(k).alias("v")) for k in MEASURES])
        ).alias("m"),
    )
    return (
        each.select("lang", "source", "m.measure", bucket(F.col("m.v")).alias("bucket"))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _by_measure(values: dict[str, int | None]) -> Column:
    named = [F.when(F.col("measure") == k, F.lit(v)) for k, v in values.items() if v is not None]
    return F.coalesce(*named)


def _tails(sketch: DataFrame, *keys: str) -> DataFrame:
    """Per key and measure the number of documents and the fence's lower and upper quantile.

    A window holds one sketch, of a few thousand buckets at most.
    """
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys, "measure").orderBy("bucket")
    whole = Window.partitionBy(*keys, "measure")
    ranked = merged.select(
        *keys,
        "measure",
        "bucket",
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(whole).alias("n"),
    )

    def quantile(percents: dict[str, int | None], name: str) -> Column:
        reached = 100 * F.col("upto") >= _by_measure(percents) * F.col("n")
        return F.min(F.when(reached, F.col("bucket"))).alias(name)

    return ranked.groupBy(*keys, "measure").agg(
        F.max("n").alias("n"),
        quantile({f.measure: f.lower for f in FENCES}, "low"),
        quantile({f.measure: f.upper for f in FENCES}, "high"),
    )


def _drawn(name: str, count: str, towards: Column) -> Column:
    """The mean of a quantile, counted `count` times, and that of the level above, counted PRIOR times."""
    return F.floor((F.col(name) * F.col(count) + towards * PRIOR) / (F.col(count) + PRIOR))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and, per measure, the bounds <measure>_low and <measure>_high."""
    names = ("n", "low", "high")
    own = _tails(sketch, "lang", "source")
    lang = _tails(sketch, "lang").withColumnsRenamed({k: f"{k}_2" for k in names})
    every = _tails(sketch).withColumnsRenamed({k: f"{k}_3" for k in names})
    joined = join_same(join_same(own, lang, ["lang", "measure"]), every, ["measure"])

    def drawn(name: str) -> Column:
        return _drawn(name, "n", _drawn(f"{name}_2", "n_2", F.col(f"{name}_3")))

    taken = joined.select("lang", "source", "measure", drawn("low").alias("low"), drawn("high").alias("high"))
    bounds = []
    for fence in FENCES:
        here = F.col("measure") == fence.measure
        high = F.expr(f"high + high * {fence.slack} div 100 + {fence.least}")
        bounds.append(F.max(F.when(here, high)).alias(f"{fence.measure}_high"))
        if fence.lower is not None:
            low = F.expr(f"low - low * {fence.slack} div 100 - {fence.least}")
            bounds.append(F.max(F.when(here, low)).alias(f"{fence.measure}_low"))
    return taken.groupBy("lang", "source").agg(*bounds)


def judged(counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """counts with base_failed and kept. The side of the bounds has a row per language and source;
    Spark broadcasts it while it is small and splits hot sources otherwise."""
    kept = ~F.col("base_failed")
    for fence in FENCES:
        value = _thousandths(fence.measure)
        kept = kept & (value <= F.coalesce(F.col(f"{fence.measure}_high"), value))
        if fence.lower is not None:
            kept = kept & (value >= F.coalesce(F.col(f"{fence.measure}_low"), value))
    return (
        join_same(counts, bounds, ["lang", "source"], "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", kept)
        .select(*counts.columns, "base_failed", "kept")
    )


def _verdicts(counts: DataFrame) -> DataFrame:
    """judged() with the counts' own bounds. The bounds are stored first: Spark then knows their size
    when it plans the join, and does not exchange the documents for a few rows."""
    from radiolake.session import stage

    return judged(counts, stage(thresholds(sketches(counts)), "quality_bounds"))


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and kept: one row for each row.

    Documents without a word fail. NULL languages and sources form groups of their own. Rows that
    repeat count as often as they occur. No documents give no rows.
    """
    from radiolake.session import stage

    counts = measured(only(documents, "doc_id", "text", "lang", "source")).drop("text")
    return _verdicts(stage(counts, "quality_counts"))


def quality_filter(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns they came with.

    The text is measured once, stored with its counts, and exchanged only if the bounds of all
    languages and sources are too many to broadcast.
    """
    from radiolake.session import stage

    names = documents.columns
    inner = documents.select(
        "text", "lang", "source", F.struct(*[documents[c] for c in names]).alias("_all")
    )
    counts = stage(measured(inner).drop("text"), "quality_documents")
    return _verdicts(counts).filter("kept").select("_all.*")
