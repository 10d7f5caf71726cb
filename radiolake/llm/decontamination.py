"""Words of documents that lie inside an occurrence of a benchmark window.

A prefix-filtered set join. The tokens of a window are its pairs of neighbouring words (of a window
of one word, that word). A window that occurs has all its tokens in the document, so the one that
is rarest in the corpus is a sufficient prefix. One pass over the texts keeps, per document, the
positions of tokens that occur in any window, found by a bitmap of fixed size; their counts over all
documents give the rarity. Positions of prefix tokens are joined with the windows they stand for,
bounded by position and document length, and verified token by token over the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolake.llm.bitmap import bitmap_of, in_bitmap
from radiolake.llm.text import alnum_words, ascii_lower, let, text_of
from radiolake.session import stage

WINDOW = 10
_SINGLE = "\x00"


def words_of(column: str = "text") -> Column:
    return alnum_words(ascii_lower(text_of(column)))


def pair_tokens(words: Column) -> Column:
    """Tokens of a list of two words or more, by position."""
    return F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1)),
    )


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, tokens, k: every different window of the items. Items without words have none."""
    items = benchmark.select("item_id", words_of().alias("words")).filter(F.size("words") > 0)
    spans = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))),
        lambda i: F.slice(F.col("words"), i, F.lit(size)),
    )
    each = items.select("item_id", F.explode(spans).alias("w"))
    return each.select(
        "item_id",
        F.when(F.size("w") == 1, F.array(F.xxhash64(F.col("w")[0], F.lit(_SINGLE))))
        .otherwise(pair_tokens(F.col("w")))
        .alias("tokens"),
        F.size("w").alias("k"),
    ).distinct()


def token_hits(documents: DataFrame, bitmap: Column, single: bool) -> DataFrame:
    """row, doc_id, text_hash, p, t: the tokens of each document that the bitmap holds, with their
    positions, and at position -1 its number of words. One pass over the texts, one row in a few
    leaves it. Words by themselves are looked up only where an item consists of one."""

    def tokens(words: Column) -> Column:
        """The number of words, the token at each position, then the words, if they are wanted."""
        parts = [F.array(F.size(words).cast("long")), pair_tokens(words)]
        if single:
            parts += [
                F.array(F.lit(None).cast("long")),
                F.transform(words, lambda w: F.xxhash64(w, F.lit(_SINGLE))),
            ]
        return F.concat(*parts)

    # The list is never empty; the outer form keeps Spark from adding a filter that computes it twice.
    numbered = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    each = numbered.select(
        "row",
        "doc_id",
        F.xxhash64(text_of()).alias("text_hash"),
        F.posexplode_outer(let(words_of(), tokens)).alias("p", "t"),
    )
    return each.filter((F.col("p") == 0) | in_bitmap(bitmap, F.col("t"))).withColumn("p", F.col("p") - 1)


def _occurrences(hits: DataFrame, counts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """row, window, start, k: each occurrence of a window in a document.

    `hits` has the positions of tokens, `counts` the words of each document, `prefixes` the windows
    by their prefix token.
    """
    start = F.col("p") - F.col("offset")
    candidates = (
        hits.join(prefixes, F.col("t") == F.col("prefix"))
        .filter(start >= 0)
        .select("row", "window", "k", "tokens", start.alias("start"))
        .join(counts.select("row", "n_words"), "row")
        .filter(F.col("start") + F.col("k") <= F.col("n_words"))
    )
    expected = candidates.select(
        "row", "window", "start", "k", F.size("tokens").alias("n"), F.posexplode("tokens").alias("j", "t")
    ).withColumn("p", F.col("start") + F.col("j"))
    return (
        expected.join(hits, ["row", "p", "t"])
        .groupBy("row", "window", "start", "k", "n")
        .agg(F.count("*").alias("there"))
        .filter("there = n")
        .select("row", "window", "start", "k")
    )


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items (sorted ids as text): one row per row.

    NULL texts have no words and hit nothing; so do all documents without a benchmark. Windows
    of items with a NULL id mark words but name no item. Repeated rows get a row each.
    """
    of_items = stage(windows(benchmark), "item_windows")
    wanted = stage(
        of_items.groupBy("tokens", "k").agg(F.lit(0)).select("tokens", "k").withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )
    single = wanted.filter("k = 1").limit(1).count() > 0
    every = stage(
        token_hits(documents, bitmap_of(wanted.select(F.explode("tokens").alias("token"))), single), "token_hits"
    )
    counts = every.filter("p = -1").select("row", "doc_id", "text_hash", F.col("t").alias("n_words"))
    hits = every.filter("p >= 0").select("row", "p", "t")
    if single:  # the words follow the pairs and a gap: position p of a word is at n_words + p
        hits = hits.join(counts.select("row", "n_words"), "row").select(
            "row", F.when(F.col("p") >= F.col("n_words"), F.col("p") - F.col("n_words")).otherwise(F.col("p")).alias("p"), "t"
        )

    seen = hits.groupBy(F.col("t").alias("token")).agg(F.count("*").alias("n"))
    each = wanted.select("window", F.posexplode("tokens").alias("offset", "token"))
    rarest = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "offset")
    prefix = (
        each.join(seen, "token", "left")
        .withColumn("place", F.row_number().over(rarest))
        .filter("place = 1")
        .select("window", "offset", F.col("token").alias("prefix"))
    )
    found = stage(_occurrences(hits, counts, stage(wanted.join(prefix, "window"), "prefixes")), "occurrences")
    words = (
        found.select("row", F.explode(F.expr("sequence(start, start + k - 1)")).alias("word"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        found.select("row", "window")
        .distinct()
        .join(wanted, "window")
        .join(of_items.filter("item_id IS NOT NULL"), ["tokens", "k"])
        .select("row", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    nothing = F.array().cast("array<string>")
    return (
        counts.join(words, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", nothing).alias("items"),
        )
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without an occurrence of a benchmark window, with the columns they came with."""
    hit = (
        contamination(documents, benchmark)
        .filter("n_hit > 0")
        .select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text_of()) == F.col("__hash"))
    return documents.join(hit, same, "left_anti")
