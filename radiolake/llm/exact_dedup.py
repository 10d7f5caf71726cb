"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal when they are identical after each run of white space is one space. The key of a
text is the 64-bit hash of that form; the index keeps, on shared files, its directory and its buckets:

1. Entries: a slim row per document (key, digest, place), written once. Equal entries are counted
   before they are exchanged, so a text that a third of all rows share is one row per task.
2. Directory: a bucket is all keys with the same leading bits. It starts with one bucket; while a
   bucket holds more than CAPACITY keys the directory doubles and the bucket is split by the next bit.
   One scan of the keys counts DOUBLINGS levels at once, the next one only reads buckets still overfull.
3. Bytes: whole texts of keys that occur twice meet in an aggregate on the bytes themselves. Texts of
   other keys stay where they are, but for those a full bitmap lets through.
4. Buckets: owner tasks take ranges of buckets, link the different texts of one key as a chain and
   write the bucket files, in key order.

Every row is then looked up by key and digest. Two different texts with equal key and digest would
raise an error rather than lose one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radiolake.llm.bitmap import bitmap_of, in_bitmap
from radiolake.llm.hot_join import join_unique
from radiolake.llm.text import SPACES, text_of
from radiolake.session import stage

#: Keys in a bucket; rows of 60 bytes, so an owner task of a few buckets stays small.
CAPACITY = 65_536
#: Directory levels that one scan of the keys settles.
DOUBLINGS = 8
KEY_BITS = 64

#: A document's place: doc_id first, then row. Rows are counted below this number.
_ROWS = "5000000000000000000BD"
_NO_ID = "9223372036854775808BD"


def normalised(column: str = "text") -> Column:
    """White space runs as one space; NULL as the empty text.

    Plain replacements first, as a regular expression reads a text far more slowly; only texts that
    then still have two spaces in a row need one.
    """
    spaced = text_of(column)
    for control in SPACES.replace(" ", ""):
        spaced = F.replace(spaced, F.lit(control), F.lit(" "))
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def _key(text: Column, bits: int) -> Column:
    """The leading `bits` of the hash, the others 0; fewer than 64 make collisions for tests."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - bits), 64 - bits)


def _prefix(depth: int) -> Column:
    """The leading bits of a key as a number; at depth 0 all keys have the same."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


@dataclass(frozen=True)
class Index:
    """`entries`: row, doc_id, key, digest. `directory`: slot, bucket, depth; a slot is the leading
    `depth` bits of a key. `buckets`: bucket, key, link, digest, n, keep_id, keep_row."""

    entries: DataFrame
    directory: DataFrame
    depth: int
    buckets: DataFrame


def directory_of(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """The directory (slot, bucket, depth) over the different values of column `key`, and its depth.

    A bucket is split while it holds more than `capacity` keys, one at least. Its number is its
    first slot.
    """
    found: list[DataFrame] = []
    open_keys, depth = keys.select("key").distinct(), 0
    while depth < KEY_BITS:
        deeper = min(KEY_BITS, depth + DOUBLINGS)
        counts = open_keys.groupBy(_prefix(deeper).alias("prefix")).agg(F.count("*").alias("n"))
        # A bucket that is open was too large at `depth` already; only the first one is new to that level.
        levels = F.sequence(F.lit(depth + 1 if depth else 0), F.lit(deeper))
        totals = stage(
            counts.select(F.explode(levels).alias("depth"), "prefix", "n")
            .select("depth", F.expr(f"shiftrightunsigned(prefix, {deeper} - depth)").alias("prefix"), "n")
            .groupBy("depth", "prefix")
            .agg(F.sum("n").alias("n")),
            "directory_levels",
        )
        fits = totals.filter(F.col("n") <= capacity).select("depth", "prefix")
        parents = fits.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        found.append(
            fits.withColumn("parent", F.shiftrightunsigned("prefix", 1))
            .join(parents, ["depth", "parent"], "left_anti")
            .select("depth", "prefix")
        )
        overfull = totals.filter((F.col("depth") == deeper) & (F.col("n") > capacity)).select("prefix")
        if overfull.isEmpty():
            break
        open_keys = open_keys.withColumn("prefix", _prefix(deeper)).join(overfull, "prefix", "left_semi").select("key")
        depth = deeper
    buckets = stage(reduce(DataFrame.unionByName, found), "directory_buckets")
    whole = buckets.agg(F.max("depth")).first()[0] or 0
    slots = F.expr(f"sequence(0L, shiftleft(1L, {whole} - depth) - 1)")
    first = F.expr(f"shiftleft(prefix, {whole} - depth)")
    directory = buckets.select(first.alias("bucket"), "depth", F.explode(slots).alias("s"))
    return directory.select((F.col("bucket") + F.col("s")).alias("slot"), "bucket", "depth"), whole


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS, row: str | None = None
) -> Index:
    """The index of all rows of `docs` (doc_id, text), on shared files.

    `row` names a column that numbers the rows below 5e18; without it they are numbered as they are read.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    entries = stage(
        docs.select("doc_id", number.alias("row"), normalised().alias("_text")).select(
            "row",
            "doc_id",
            _key(F.col("_text"), key_bits).alias("key"),
            F.unhex(F.sha2("_text", 256)).alias("digest"),
        ),
        "entries",
    )
    place = F.expr(
        f"CAST(coalesce(CAST(doc_id AS DECIMAL(20, 0)), {_NO_ID}) * {_ROWS} + row AS DECIMAL(38, 0))"
    )
    counted = entries.groupBy("key", "digest").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("keep_id"), F.min(place).alias("place")
    )
    keep_row = F.expr(f"CAST(pmod(place, {_ROWS}) AS BIGINT)").alias("keep_row")
    groups = stage(counted.select("key", "digest", "n", "keep_id", keep_row), "key_groups")
    directory, depth = directory_of(groups, capacity)
    same = same_bytes(docs, groups.filter("n > 1").select("key"), key_bits)
    checked = groups.join(same, ["key", "digest"], "left").withColumn(
        "n",
        F.when(F.coalesce("texts", F.lit(1)) == 1, F.col("n")).otherwise(
            F.raise_error(F.lit("two texts share key and digest"))
        ),
    )
    slot = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    placed = checked.withColumn("slot", slot).join(directory.select("slot", "bucket"), "slot")
    # A range of buckets lies in one task, so the chain needs no further exchange.
    chain = Window.partitionBy("bucket", "key").orderBy("digest")
    buckets = stage(
        placed.repartitionByRange("bucket")
        .withColumn("link", F.row_number().over(chain))
        .select("bucket", "key", "link", "digest", "n", "keep_id", "keep_row"),
        "buckets",
    )
    return Index(entries, directory, depth, buckets)


def same_bytes(docs: DataFrame, repeated: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """key, digest, texts: how many different byte strings have them, for all repeated keys."""
    bits = bitmap_of(repeated.select(F.col("key").alias("token")))
    read = docs.select(normalised().alias("_text")).withColumn("key", _key(F.col("_text"), key_bits))
    different = read.filter(in_bitmap(bits, F.col("key"))).groupBy("key", "_text").agg(F.count("*").alias("_n"))
    return (
        different.select("key", F.unhex(F.sha2("_text", 256)).alias("digest"))
        .groupBy("key", "digest")
        .agg(F.count("*").alias("texts"))
    )


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, link.

    Of equal texts the row with the smallest doc_id is kept; a NULL doc_id comes last, and of rows
    equal in doc_id as well one is kept, any of them. NULL texts are empty, and all empty texts are
    equal; texts of any length count whole. Other columns, whatever their names, are not read. No
    rows give none. `bucket` and `link` tell where the index holds the text.
    """
    index = build_index(docs, capacity, key_bits)
    found = join_unique(
        index.entries,
        index.buckets.select("key", "digest", "bucket", "link", "n", "keep_id", "keep_row"),
        ["key", "digest"],
        "n",
    )
    return found.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "bucket",
        "link",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The kept rows with all their columns, texts unchanged. The rows are numbered in a staged copy,
    so that a row that goes is known by its number alone."""
    own = stage(docs.withColumn("_row_of", F.monotonically_increasing_id()), "numbered")
    index = build_index(own, row="_row_of")
    groups = index.buckets.select("key", "digest", "n", "keep_row")
    gone = join_unique(index.entries, groups, ["key", "digest"], "n").filter("row <> keep_row")
    return own.join(gone.select(F.col("row").alias("_row_of")), "_row_of", "left_anti").drop("_row_of")
