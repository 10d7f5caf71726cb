"""Phrases of up to four words and how often they occur, by dynamic itemset counting; and their scores.

The texts lie in SHARDS shards that are scanned in a cycle. All words are counted from the first step
on. As soon as both subphrases of a phrase (without its last, and without its first word) have been
seen LEAST times, counting of the phrase begins with the next shard, whatever lengths are being
counted at that time, and ends when it has seen each shard once. So lengths are interleaved, and a
count is whole after one cycle. The scans end when no phrase is incomplete.

When a subphrase reached the bound is told to the tasks by a table of 2 ** SLOT_BITS slots, one byte
each: the first step at which a phrase of that slot reached it. Its size does not follow the data. A
phrase that shares slots with frequent ones is counted without need, but as the table alone decides
when a phrase begins and ends, its count is whole too.

Tasks count in numpy, exactly: words are numbered per chunk by their bytes and phrases by the numbers
of their words. Counts are summed in a chunk, in the task and then by phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from radiolake.llm.hot_join import join_unique
from radiolake.llm.text import text_of
from radiolake.session import scratch_dir, stage

SHARDS = 4
LEAST = 30
LONGEST = 4
SLOT_BITS = 24
#: Bytes of text that a task counts at once.
CHUNK = 8 << 20
UNKNOWN_LANG = "und"
INSIDE_PERCENT = 80
TOP = 2_000

_NEVER = 255
_SCHEMA = "key binary, act int, n long"
_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _hashes(values: pa.Array) -> np.ndarray:
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one word more."""
    return _mixed(h * _MIX + word)


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class _Words:
    """The words of a chunk in order: number, language and piece of each."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _KIND.take(raw)
        inside = kind == 0
        outside = ~inside
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= outside[:-1]
        ends[:-1] &= outside[1:]
        first = offsets[:-1][np.diff(offsets) > 0]
        begins[first] = inside[first]
        ends[first[1:] - 1] = inside[first[1:] - 1]
        starts = np.flatnonzero(begins)
        many = np.diff(np.searchsorted(starts, offsets))
        # A piece never goes on into the next text.
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts] + np.repeat(np.arange(len(many), dtype=np.int32), many)
        letters = _LOWER.take(raw[inside])
        bounds = np.append(0, np.cumsum(np.flatnonzero(ends) + 1 - starts)).astype(np.int32)
        coded = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.later = pc.binary_join_element_wise(pa.scalar(b"", pa.binary()), coded.dictionary, pa.scalar(b" ", pa.binary()))
        self.word = coded.indices.to_numpy().astype(np.int64)
        named = langs.dictionary_encode()
        self.langs = named.dictionary
        self.ends = pc.binary_join_element_wise(
            pa.scalar(b"", pa.binary()), named.dictionary.cast(pa.binary()), pa.scalar(b"\n", pa.binary())
        )
        self.lang = np.repeat(named.indices.to_numpy().astype(np.int64), many)

    def phrases(self, at: np.ndarray, k: int, age: np.ndarray, ages: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Of the phrases of k words that begin at `at`: language, words, age and how often each occurs. Equal
        phrases have one age, below `ages`. Codes are sorted by value and taken apart again; only those
        too long for that need the place of an occurrence, which costs several times as much."""
        size = max(1, len(self.vocabulary))
        code, top = self.lang[at] * ages + age, max(1, len(self.langs)) * ages
        if top * size**k < 1 << 62:
            for j in range(k):
                code = code * size + self.word[at + j]
            code, n = np.unique(code, return_counts=True)
            words = []
            for _ in range(k):
                code, word = np.divmod(code, size)
                words.append(word)
            return code // ages, words[::-1], code % ages, n
        for j in range(k):
            if top * size >= 1 << 62:
                code = np.unique(code, return_inverse=True)[1]
                top = len(at)
            code, top = code * size + self.word[at + j], top * size
        _, index, n = np.unique(code, return_index=True, return_counts=True)
        place = at[index]
        return self.lang[place], [self.word[place + j] for j in range(k)], age[index], n

    def rows(self, at: np.ndarray, k: int, age: np.ndarray, ages: int, step: int) -> pa.RecordBatch:
        lang, (first, *rest), age, n = self.phrases(at, k, age, ages)
        parts = [self.vocabulary.take(pa.array(first)), *(self.later.take(pa.array(w)) for w in rest)]
        return _counted([*parts, self.ends.take(pa.array(lang))], step - age, n)


def _counted(parts: list[pa.Array], act: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of counts. Phrase, line end and language are one binary key, which is exchanged and compared at less
    cost than three columns; no phrase has a line end."""
    key = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))
    return pa.RecordBatch.from_arrays(
        [key, pa.array(act.astype(np.int32)), pa.array(n.astype(np.int64))], names=["key", "act", "n"]
    )


def _chunk_rows(words: _Words, slots: np.ndarray, step: int, shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    total = len(words.word)
    if not total:
        return
    if step < shards:
        yield words.rows(np.arange(total), 1, np.full(total, step), shards, step)
        used, n = np.unique(words.lang, return_counts=True)
        yield _counted([words.ends.take(pa.array(used))], np.zeros(len(n)), n)
    word_hash = _hashes(words.vocabulary)[words.word]
    h = _mixed(_hashes(words.langs)[words.lang] + word_hash)
    for k in range(2, LONGEST + 1):
        if total < k:
            return
        reached = slots[_slot(h, bits)].astype(np.int16)  # of the phrases of k - 1 words
        act = np.maximum(reached[:-1], reached[1:]) + 1
        counting = (act <= step) & (act > step - shards) & (words.piece[k - 1 :] == words.piece[: total - k + 1])
        at = np.flatnonzero(counting)
        if len(at):
            yield words.rows(at, k, step - act[at], shards, step)
        h = _extended(h[:-1], word_hash[k - 1 :])


def _scan(slots, step: int, shards: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            part = np.cumsum(size, dtype=np.int64) // CHUNK
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
            for a, b in zip(cuts, cuts[1:]):
                rows = batch.slice(a, b - a)
                words = _Words(rows.column("lang"), rows.column("text"))
                yield from _chunk_rows(words, slots.value, step, shards, bits)

    return run


def _slots_of(bits: int):
    """Slots of phrases, the same as in a scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [key.split(b"\n", 1) for key in batch.column("key").to_pylist()]
            langs = _hashes(pa.array([lang.decode() for _, lang in keys], pa.string()))
            split = [phrase.split(b" ") for phrase, _ in keys]
            lengths = np.array([len(p) for p in split], np.int64)
            flat = pd.util.hash_array(np.array([w for p in split for w in p], object), categorize=False)
            first = np.cumsum(lengths) - lengths
            h = _mixed(langs + flat[first])
            for j in range(1, LONGEST):
                longer = np.flatnonzero(lengths > j)
                h[longer] = _extended(h[longer], flat[first[longer] + j])
            yield pa.RecordBatch.from_arrays([pa.array(_slot(h, bits))], names=["slot"])

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, bits: int = SLOT_BITS) -> DataFrame:
    """lang, k, phrase (binary, words joined by a space), n: all phrases of 1 to LONGEST words that occur
    `least` times or more in a language, and with k = 0 the number of its words.

    `docs` has lang and text; NULL texts are empty, a NULL lang is UNKNOWN_LANG; other columns are not
    read. Occurrences overlap and lie within a piece. Texts of any length count whole; repeated rows
    count each. No words give no rows.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "shards")
    named = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"),
        text_of().alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"),
    )
    named.write.partitionBy("shard").parquet(path)
    texts = spark.read.schema("lang string, text string, shard int").parquet(path)
    slots = np.full(1 << bits, _NEVER, np.uint8)
    # The words of a phrase: none before the line end, or one more than it has spaces.
    text = F.col("key").cast("string")
    k = F.when(text.startswith("\n"), 0).otherwise(F.size(F.split(F.substring_index(text, "\n", 1), " ")))
    known, step, last = None, 0, -1
    while step < shards or step <= last + shards:
        held = spark.sparkContext.broadcast(slots)
        shard = texts.filter(F.col("shard") == step % shards).select("lang", "text")
        found = shard.mapInArrow(_scan(held, step, shards, bits), _SCHEMA).withColumn("reach", F.lit(None).cast("int"))
        if known is not None:
            found = found.unionByName(known)
        total = found.groupBy("key").agg(
            F.min("act").alias("act"), F.sum("n").alias("n"), F.min("reach").alias("reach")
        )
        now = F.when((F.col("n") >= least) & k.between(1, LONGEST - 1), F.lit(step))
        # A count that is whole and too small is not needed any more.
        wanted = (F.col("n") >= least) | (F.col("act") + shards - 1 > step) | text.startswith("\n")
        known = stage(total.withColumn("reach", F.coalesce("reach", now)).filter(wanted), "phrase_counts")
        held.destroy()
        if _mark(slots, known.filter(F.col("reach") == step), step, bits):
            last = step
        step += 1
    return known.filter((F.col("n") >= least) | text.startswith("\n")).select(
        F.expr("substring(CAST(key AS STRING), instr(CAST(key AS STRING), '\n') + 1)").alias("lang"),
        k.alias("k"),
        F.substring_index(text, "\n", 1).cast("binary").alias("phrase"),
        "n",
    )


def _mark(slots: np.ndarray, reached: DataFrame, step: int, bits: int) -> bool:
    """Note the step in the slots of these phrases. The driver gets the slots as bits, 2 ** bits / 8 bytes."""
    slot = reached.select("key").mapInArrow(_slots_of(bits), "slot long")
    bit = F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")
    held = slot.groupBy(F.shiftright("slot", 6).alias("i")).agg(F.bit_or(bit).alias("bits")).toArrow()
    if held.num_rows == 0:
        return False
    words = np.zeros(len(slots) // 64, np.int64)
    words[held.column("i").to_numpy()] = held.column("bits").to_numpy()
    new = np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)
    slots[new & (slots == _NEVER)] = step
    return True


def _with_counts(df: DataFrame, part: str, counts: DataFrame, name: str) -> DataFrame:
    """df with the count of the phrase in column `part`; a word may be part of a large share of rows."""
    uses = df.groupBy("lang", part).agg(F.count("*").alias("_uses"))
    known = stage(
        counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)).join(uses, ["lang", part]), "parts"
    )
    return join_unique(df, known, ["lang", part], "_uses").drop("_uses", part)


def collocations(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, bits: int = SLOT_BITS) -> DataFrame:
    """lang, phrase, k, a, l, r, n, score, inside: every phrase of 2 to LONGEST words with a >= least.

    Of the cuts in two parts the one of lowest score counts, then the earliest; l and r are the counts
    of its parts, score is floor(2000000 * a / (l + r)), n the words of the language. `inside`: the
    words stand in a longer phrase that has INSIDE_PERCENT of its occurrences or more.
    """
    counts = stage(phrase_counts(docs, least, shards, bits), "counts")
    some = counts.filter("k >= 2").select(
        "lang", "phrase", "k", F.col("n").alias("a"), F.split(F.col("phrase").cast("string"), " ").alias("words")
    )
    cut = some.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    parts = stage(
        cut.select(
            "lang",
            "phrase",
            "k",
            "a",
            "cut",
            F.expr("CAST(array_join(slice(words, 1, cut), ' ') AS BINARY)").alias("left_part"),
            F.expr("CAST(array_join(slice(words, cut + 1, k - cut), ' ') AS BINARY)").alias("right_part"),
        ),
        "cuts",
    )
    halves = counts.filter(F.col("k").between(1, LONGEST - 1))
    scored = stage(_with_counts(parts, "left_part", halves, "l"), "left_counts")
    score = F.expr("(2000000 * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + r)")
    lowest = (
        _with_counts(scored, "right_part", halves, "r")
        .withColumn("score", score)
        .groupBy("lang", "phrase", "k", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    )
    spans = [(i, m) for m in range(2, LONGEST) for i in range(1, LONGEST - m + 2)]
    inner = F.array(
        *[
            F.expr(f"CASE WHEN k > {m} AND k >= {i + m - 1} THEN CAST(array_join(slice(words, {i}, {m}), ' ') AS BINARY) END")
            for i, m in spans
        ]
    )
    around = (
        some.filter("k > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .filter("phrase IS NOT NULL")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    sizes = F.broadcast(counts.filter("k = 0").select("lang", F.col("n").alias("n")))
    joined = lowest.join(around, ["lang", "phrase"], "left").join(sizes, "lang")
    inside = F.coalesce(F.col("around") * 100 >= F.col("a") * INSIDE_PERCENT, F.lit(False))
    return joined.select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score", inside.alias("inside"))


def top_collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language that no longer one stands for, by score, count and bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs).filter(~F.col("inside")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score"
    )
