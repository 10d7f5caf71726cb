"""A hidden Markov language model: Baum-Welch over the training texts, exact likelihood of every text.

Tokens are lower-cased words and one end per text. A word is emitted in two steps: a state emits one
of CLASSES classes (a hash of the word; the end has a class of its own), and the class emits the
word with a probability counted over all training tokens,

    P(word | class) = (count + 1) / (tokens of the class + words of the class + 1),

where the one over goes to each word never seen. So every word has a probability, nothing is cut
from the vocabulary, and what a task must hold is CLASSES x STATES numbers, whatever the corpus.

Word counts come from one grouped aggregation and are joined back to the words of each text. Each
round of Baum-Welch sends every training segment through the forward and backward recursions where
it lies; expected counts are summed within a task, then over tasks, and only the sums, of the model's
own size, reach the driver. The likelihood of a text is the scaled forward recursion over all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.llm.arrow_words import numbered_words, portions
from radiolake.llm.text import ascii_lower, join_same, space_words, text_of
from radiolake.session import stage

CLASSES, STATES, ROUNDS = 8192, 8, 7
END = CLASSES  # the class of the end
#: Words with 1 / HEAVY of all tokens or more are broadcast: there cannot be more than HEAVY.
HEAVY = 1 << 16
#: Training reads texts in segments of this many tokens; a likelihood is never cut.
SEGMENT = 128
#: Tokens in the recursion at a time, which bounds a worker's memory.
CHUNK = 200_000
#: Bytes of text whose words are numbered together.
TOGETHER = 4_000_000
#: Added to expected counts, so that no probability is zero.
SMOOTH_CLASS, SMOOTH_MOVE = 0.02, 1.0


class Model:
    """start: first state of a text; inner: of a later segment; move: state to state; emit: class by state."""

    def __init__(self, start: np.ndarray, inner: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.inner, self.move, self.emit = (np.ascontiguousarray(x, np.float64) for x in (start, inner, move, emit))


def first_model(class_counts: np.ndarray) -> Model:
    """Each state prefers an eighth of the classes and some states to follow it, by a fixed random
    draw. Equal moves would be a point that rounds leave slowly."""
    draw = np.random.default_rng(7)
    favoured = draw.integers(0, STATES, len(class_counts))
    weight = np.where(favoured[:, None] == np.arange(STATES)[None, :], 1.0, 0.05)
    emit = (class_counts[:, None] + SMOOTH_CLASS) * weight
    move = draw.gamma(0.5, size=(STATES, STATES)) + 0.02
    even = np.full(STATES, 1 / STATES)
    return Model(even, even, move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _grid(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sequences, longest first, and how many still run at each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, running


def log_likelihoods(model: Model, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 of the probability of each class sequence tokens[start : start + length].

    All sequences step together; a sequence's forward vector is scaled to sum one at each step
    and the scales multiply to the probability.
    """
    out = np.zeros(len(lengths))
    order, running = _grid(starts, lengths)
    at = starts[order]
    score = np.zeros(len(order))
    alpha, one = np.tile(model.start, (len(order), 1)), np.ones(STATES)
    for t, n in enumerate(running):
        now = alpha[:n] if t == 0 else alpha[:n] @ model.move
        now = now * model.emit[tokens[at[:n] + t]]
        scale = now @ one
        score[:n] += np.log10(scale)
        alpha = now * (1 / scale)[:, None]
    out[order] = score
    return out


class Counts:
    """Expected counts of one round, of the model's size."""

    def __init__(self) -> None:
        self.start, self.inner = np.zeros(STATES), np.zeros(STATES)
        self.move, self.emit = np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))

    def add(self, model: Model, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> None:
        """Forward and backward over segments; `first` marks those that begin a text."""
        order, running = _grid(starts, lengths)
        at, first = starts[order], first[order]
        emit, move, one = model.emit.astype(np.float32), model.move.astype(np.float32), np.ones(STATES, np.float32)
        seen, forward, places = [], [], []
        for t, n in enumerate(running):
            place = tokens[at[:n] + t]
            e = emit[place]
            if t == 0:
                now = np.where(first[:, None], model.start, model.inner).astype(np.float32) * e
            else:
                now = (forward[-1][:n] @ move) * e
            scale = 1 / (now @ one)
            now *= scale[:, None]
            e *= scale[:, None]  # scaled alike, the backward vectors give posteriors that sum to one
            seen.append(e)
            forward.append(now)
            places.append(place)
        beta = np.ones((0, STATES), np.float32)
        for t in range(len(running) - 1, -1, -1):
            n, m = int(running[t]), len(beta)
            if m < n:  # segments that end here
                beta = np.concatenate([beta, np.ones((n - m, STATES), np.float32)])
            if t:
                after = seen[t] * beta
                self.move += move * (forward[t - 1][:n].T @ after)
            forward[t] *= beta
            if t:
                beta = after @ move.T
        self.start += forward[0][first].sum(axis=0)
        self.inner += forward[0][~first].sum(axis=0)
        gamma, place = np.concatenate(forward), np.concatenate(places)
        for s in range(STATES):
            self.emit[:, s] += np.bincount(place, gamma[:, s], CLASSES + 1)

    def rows(self) -> pa.RecordBatch:
        """kind, place, values: 0 emissions by class, 1 moves by state, 2 start, 3 inner."""
        used = np.flatnonzero(self.emit.sum(axis=1))
        kinds = [0] * len(used) + [1] * STATES + [2, 3]
        places = [*used.tolist(), *range(STATES), 0, 0]
        values = np.concatenate([self.emit[used], self.move, self.start[None, :], self.inner[None, :]])
        lists = pa.ListArray.from_arrays(
            np.arange(0, values.size + 1, STATES, dtype=np.int32), pa.array(values.ravel())
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(places, pa.int32()), lists], names=["kind", "place", "v"]
        )


def _segments(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of a batch, and start, length and whether it begins a text for each segment."""
    tokens = lists.values.to_numpy().astype(np.int64)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    many = -(-lengths // SEGMENT)
    text = np.repeat(np.arange(len(lengths)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    starts = offsets[:-1][text] + nth * SEGMENT
    return tokens, starts, np.minimum(SEGMENT, offsets[1:][text] - starts), nth == 0


def _expected(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_row = Counts(), False
        for batch in batches:
            tokens, starts, lengths, first = _segments(batch.column("classes"))
            step = max(1, CHUNK // SEGMENT)
            for k in range(0, len(starts), step):
                cut = slice(k, k + step)
                counts.add(model, tokens, starts[cut], lengths[cut], first[cut])
                any_row = True
        if any_row:
            yield counts.rows()

    return run


def trained(training: DataFrame, class_counts: np.ndarray, kinds: int, rounds: int = ROUNDS) -> Model:
    """Baum-Welch from `first_model` over the column `classes` of all training rows, which have
    `kinds` different words."""
    model = first_model(class_counts)
    for _ in range(rounds):
        each = training.select("classes").mapInArrow(_expected(model), "kind int, place int, v array<double>")
        sums = (
            each.groupBy("kind", "place")
            .agg(*[F.sum(F.col("v")[s]).alias(f"s{s}") for s in range(STATES)])
            .toPandas()  # CLASSES + STATES + 3 rows at most
        )
        if sums.empty:
            return model
        values = sums[[f"s{s}" for s in range(STATES)]].to_numpy()
        kind, place = sums["kind"].to_numpy(), sums["place"].to_numpy()
        emit = np.zeros((CLASSES + 1, STATES))
        emit[place[kind == 0]] = values[kind == 0]
        move = np.zeros((STATES, STATES))
        move[place[kind == 1]] = values[kind == 1]
        start, inner = values[kind == 2].sum(axis=0) + SMOOTH_MOVE, values[kind == 3].sum(axis=0) + SMOOTH_MOVE
        # A class is smoothed towards its share of all tokens, where new words have as many tokens
        # as there are known words.
        share = (class_counts + max(kinds, 1) / len(class_counts)) / (class_counts.sum() + max(kinds, 1))
        emit += SMOOTH_CLASS * CLASSES * share[:, None]
        move += SMOOTH_MOVE
        model = Model(start / start.sum(), inner / inner.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def _scored(model: Model):
    """Each row's likelihood; the texts of a batch go through the recursion together."""

    kept = ["doc_id", "text_hash", "held_out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("classes")
            tokens = lists.values.to_numpy().astype(np.int64)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            scores = log_likelihoods(model, tokens, offsets[:-1], np.diff(offsets))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(np.diff(offsets) - 1), pa.array(scores)],
                names=[*kept, "n_words", "class_score"],
            )

    return run


def _class_of(word):
    return F.pmod(F.xxhash64(word), F.lit(CLASSES)).cast("int")


def _words():
    return space_words(ascii_lower(text_of()))


def _text_hash():
    return F.xxhash64(text_of()).alias("text_hash")


def _held_out():
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return (F.crc32(identity) % 7 == 2).alias("held_out")


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts, a row per word and portion of text."""
    for batch in batches:
        texts = batch.column("text")
        for first, last in portions(texts, TOGETHER):
            words, vocabulary, _ = numbered_words(texts.slice(first, last - first), lower=True)
            yield pa.RecordBatch.from_arrays(
                [vocabulary, pa.array(np.bincount(words, minlength=len(vocabulary)))], names=["word", "c"]
            )


def _seldom_words(heavy):
    """For each row its heavy words summed in one row, and a row for each other word.

    The sums have a key that is no word, as it begins with a space, and of their own, so that they spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lb, li = heavy.value
        for batch in batches:
            texts = batch.column("text")
            for first, last in portions(texts, TOGETHER):
                rows = batch.slice(first, last - first)
                words, vocabulary, bounds = numbered_words(rows.column("text"), lower=True)
                place = pc.fill_null(pc.index_in(vocabulary, value_set=known), -1).to_numpy()[words]
                row = np.repeat(np.arange(len(rows)), np.diff(bounds))
                often, seldom = place >= 0, np.flatnonzero(place < 0)
                n = np.bincount(row[often], minlength=len(rows))
                sums = (np.bincount(row[often], x[place[often]], len(rows)) for x in (lb, li))
                own = pc.binary_join_element_wise("", rows.column("text_hash").cast(pa.string()), " ")
                keys = rows.select(["doc_id", "text_hash"])
                yield _with_words(keys, own, n, *sums)
                for k in range(0, len(seldom), CHUNK):
                    at = seldom[k : k + CHUNK]
                    none = pa.nulls(len(at), pa.float64())
                    found = keys.take(pa.array(row[at]))
                    yield _with_words(found, vocabulary.take(pa.array(words[at])), none.cast(pa.int64()), none, none)

    return run


def _with_words(rows: pa.RecordBatch, word: pa.Array, n, base, inner) -> pa.RecordBatch:
    kept = [rows.column("doc_id"), rows.column("text_hash")]
    sums = [pa.array(n, pa.int64()), pa.array(base, pa.float64()), pa.array(inner, pa.float64())]
    return pa.RecordBatch.from_arrays([*kept, word, *sums], names=["doc_id", "text_hash", "word", "n", "base", "inner"])


def _word_scores(texts: DataFrame, counted: DataFrame, sizes: DataFrame, n: int, v: int) -> DataFrame:
    """doc_id, text_hash, base, inner, known, words: sums over the words of the texts.

    Words that make up 1 / HEAVY of all training tokens or more are HEAVY at most: their table is
    broadcast, which also takes the frequent words out of the exchange. The rest is joined by word.
    Counted words have their two logarithms beside them, so that a word costs one lookup; only one
    that was never counted looks for its class.
    """
    c, sized = F.col("c"), F.broadcast(sizes)  # CLASSES rows
    base = F.log10((c + 1) / F.lit(float(n + v + 1)))
    inner = F.log10((c + 1) / (F.col("tokens") + F.col("kinds") + 1))
    is_heavy = F.col("c") * HEAVY >= n
    ready = counted.join(sized, "class").select("word", "c", base.alias("lb"), inner.alias("li"))
    found = ready.filter(is_heavy).toArrow().combine_chunks()
    heavy = tuple(found.column(x).combine_chunks() for x in ("word", "lb", "li"))
    held = texts.sparkSession.sparkContext.broadcast((heavy[0].cast(pa.string()), heavy[1].to_numpy(), heavy[2].to_numpy()))
    words = texts.select("doc_id", "text_hash", "text").mapInArrow(
        _seldom_words(held), "doc_id long, text_hash long, word string, n long, base double, inner double"
    )
    # A partition's words are few beside those of the texts: kept in a hash table, nothing is sorted.
    light = ready.filter(~is_heavy).drop("c").hint("shuffle_hash")
    classes = sized.withColumnRenamed("class", "_class")
    is_new = F.col("lb").isNull() & F.col("n").isNull()
    met = words.join(light, "word", "left").join(
        classes, F.when(is_new, _class_of(F.col("word"))) == F.col("_class"), "left"
    )
    return met.groupBy("doc_id", "text_hash").agg(
        F.sum(F.coalesce("base", "lb", F.log10(F.lit(1 / (n + v + 1.0))))).alias("base"),
        F.sum(F.coalesce("inner", "li", F.log10(1 / (F.col("tokens") + F.col("kinds") + 1)))).alias("inner"),
        F.sum(F.coalesce("n", F.col("lb").isNotNull().cast("long"))).alias("known"),
        F.sum(F.coalesce("n", F.lit(1))).alias("words"),
    )


def scores(documents: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row.

    Training takes the rows whose crc32(doc_id as text) mod 7 is not 2; a NULL doc_id counts as
    an empty text. A NULL or empty text is its end alone. Repeated rows count as often as they
    occur. Without any training row all counts are zero and the first model scores.
    """
    classes = F.concat(
        F.transform(_words(), lambda w: _class_of(w).cast("short")), F.array(F.lit(END).cast("short"))
    )
    slim = stage(documents.select("doc_id", _text_hash(), _held_out(), classes.alias("classes")), "classes")
    training = slim.filter("NOT held_out")

    counted = stage(
        documents.filter(~_held_out())
        .select(text_of().alias("text"))
        .mapInArrow(_counted_words, "word string, c long")
        .groupBy("word")
        .agg(F.sum("c").alias("c"))
        .withColumn("class", _class_of(F.col("word"))),
        "word_counts",
    )
    ends = training.count()
    by_class = (
        counted.groupBy("class").agg(F.sum("c").alias("tokens"), F.count("*").alias("kinds")).toPandas()
    )  # CLASSES rows at most
    tokens, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    tokens[by_class["class"]] = by_class["tokens"]
    kinds[by_class["class"]] = by_class["kinds"]
    tokens[END], kinds[END] = ends, min(ends, 1)
    n, v = int(tokens.sum()), int(kinds.sum())

    model = trained(training, tokens, v, rounds)
    by_model = slim.mapInArrow(
        _scored(model), "doc_id long, text_hash long, held_out boolean, n_words long, class_score double"
    )
    sizes = documents.sparkSession.createDataFrame(
        [(c, int(tokens[c]), int(kinds[c])) for c in range(CLASSES)], "class int, tokens long, kinds long"
    )
    hashed = documents.select("doc_id", text_of().alias("text"), _text_hash())
    by_word = _word_scores(hashed, counted, sizes, n, v)
    # Rows that repeat are summed together; the mean over their words is that of each.
    end = float(np.log10((ends + 1) / (n + v + 1)))
    found = join_same(by_model, by_word, ["doc_id", "text_hash"], "left")

    def of_row(name: str):
        return F.when(F.col("words") > 0, F.col(name) / F.col("words") * F.col("n_words")).otherwise(F.lit(0.0))

    return found.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.round(of_row("known")).cast("long") + min(ends, 1)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (of_row("base") + F.lit(end)).alias("base_score"),
        (of_row("inner") + F.col("class_score")).alias("score"),
    )
