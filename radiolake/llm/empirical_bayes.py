"""Document quality by hierarchical empirical Bayes: the text's evidence, its host's and its path's.

Evidence of a text is a log-odds. Word and word-shape counts of one half of the labelled documents
give naive Bayes weights in a table of fixed size; a logistic regression on a few measures, fitted on
a bounded sample of the other half, calibrates them. Hosts and paths then lend strength. The share
of good documents of a host is shrunk towards the global share, that of a path towards its host's,
each by a weight estimated from how much the shares spread: sparse sites stay near their prior, well
known ones are themselves. All of that is grouped sums, combined before their exchange.

Toxic texts are found apart from quality, as a few words in ordinary prose would be lost in a mean:
slots have weights of their own, toxic against not toxic, and a text's measures are its strongest
slots. A second regression calibrates them. A document goes if either says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolake.llm.bitmap import bitmap_of, in_bitmap
from radiolake.llm.text import ascii_lower, count_of, join_same, space_words, text_of
from radiolake.session import stage

#: Words and shapes are hashed into this many slots, so the weights take 512 KB.
SLOTS = 1 << 16
#: The regression is fitted on this many labelled rows at most, by a hash of their id.
FIT_ROWS = 20_000
#: Strength of a prior in documents, at least and at most.
STRENGTH = (2.0, 1000.0)
#: Documents below this probability are dropped.
KEEP = 0.5
#: Documents at or above this probability of being toxic are dropped.
TOXIC = 0.5
#: So many of a text's strongest slots speak for its being toxic.
STRONGEST = 5
#: A slot's share of toxic documents is shrunk towards the share of all by so many documents.
TOXIC_PRIOR = 4.0


def _slots(text: Column) -> Column:
    """A slot for every word and one for its shape: letters, digits and marks, runs as one."""
    words = space_words(text)
    shape = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(text, r"[a-z\x80-\x{10FFFF}]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"
    )

    def hashed(values: Column, seed: int) -> Column:
        return F.transform(values, lambda w: F.pmod(F.xxhash64(w, F.lit(seed)), F.lit(SLOTS)).cast("int"))

    return F.concat(hashed(F.transform(words, ascii_lower), 1), hashed(space_words(shape), 2))


MEASURES = ("evidence", "marks", "capitals", "size", "repeats")
#: Rows whose slots a task holds as numbers at once.
ROWS = 512

TOXIC_MEASURES = ("toxic_first", "toxic_sum", "size")


def _measured(documents: DataFrame, host: Column, path: Column) -> DataFrame:
    text = text_of()
    n = F.greatest(F.length(text), F.lit(1))
    return documents.select(
        "doc_id",
        host.alias("host"),
        path.alias("path"),
        _slots(text).alias("slots"),
        (count_of(text, "#*$%&|<>!") / n).alias("marks"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / n).alias("capitals"),
        F.log1p(F.length(text).cast("double")).alias("size"),
        (
            1 - F.size(F.array_distinct(F.split(text, "\n"))) / F.size(F.split(text, "\n"))
        ).alias("repeats"),
    )


def _weights(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each slot, for good and for toxic; SLOTS x 4 counts reach the driver.

    A document counts for the labels it has.
    """
    named = ("good", "toxic")
    sums = [a for c in named for a in (F.coalesce(F.sum(c), F.lit(0)).alias(c), F.count(c).alias(f"n_{c}"))]
    counts = (
        labelled.select(*named, F.explode("slots").alias("slot")).groupBy("slot").agg(*sums).toPandas()
    )
    good, bad, toxic, judged = np.zeros((4, SLOTS))
    good[counts["slot"]] = counts["good"]
    bad[counts["slot"]] = counts["n_good"] - counts["good"]
    toxic[counts["slot"]] = counts["toxic"]
    judged[counts["slot"]] = counts["n_toxic"]
    total_good, total_bad = good.sum(), bad.sum()
    weights = np.log((good + 1) / (total_good + SLOTS)) - np.log((bad + 1) / (total_bad + SLOTS))

    n, n_toxic = labelled.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (n_toxic + 0.5) / (n + 1)
    p = (toxic + TOXIC_PRIOR * share) / (judged + TOXIC_PRIOR)
    return weights, np.log(p / (1 - p)) - np.log(share / (1 - share))


def _strongest(values: np.ndarray, slots: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the greatest value above zero, and the sum of the STRONGEST greatest, each slot once."""
    above = values > 0
    pairs = np.unique(row[above] * SLOTS + slots[above])  # by row
    row, slot = pairs // SLOTS, pairs % SLOTS
    by_slot = np.zeros(SLOTS)
    by_slot[slots] = values
    value = by_slot[slot]
    order = np.lexsort((-value, row))
    row, value = row[order], value[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    first, some = np.zeros(rows), np.zeros(rows)
    first[row[rank == 0]] = value[rank == 0]
    np.add.at(some, row[rank < STRONGEST], value[rank < STRONGEST])
    return first, some


def _evidence(weights: np.ndarray, toxic: np.ndarray, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                lists = batch.column("slots")
                offsets = lists.offsets.to_numpy()
                slots = lists.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)
                sums = np.concatenate([[0.0], np.cumsum(weights[slots])])
                lengths = np.maximum(np.diff(offsets), 1)
                mean = (sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]]) / lengths
                row = np.repeat(np.arange(len(lists)), np.diff(offsets))
                added = (mean, *_strongest(toxic[slots], slots, row, len(lists)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *map(pa.array, added)],
                    names=[*kept, "evidence", "toxic_first", "toxic_sum"],
                )

    return run


def _shrunk(sums: DataFrame, prior: Column, strength: Column) -> Column:
    return (F.col("good") + strength * prior) / (F.col("n") + strength)


def _strength(groups: DataFrame, prior: str) -> Column:
    """Of a Beta prior, by moments: the spread of the groups' shares beyond what their sizes give.

    A scalar subquery.
    """
    p = F.greatest(F.least(F.col(prior), F.lit(0.999)), F.lit(0.001))
    share = F.col("good") / F.col("n")
    within = p * (1 - p)
    n = F.sum("n")
    # Weighted squared deviations: expected within * (groups) + between * (n - sum(n^2) / n).
    deviation = F.sum(F.col("n") * F.pow(share - p, 2))
    between = (deviation - F.sum(within)) / F.greatest(n - F.count("*"), F.lit(1.0))
    mean_within = F.sum(F.col("n") * within) / n
    value = F.when(between <= 0, F.lit(STRENGTH[1])).otherwise(mean_within / between - 1)
    return groups.agg(
        F.coalesce(F.greatest(F.least(value, F.lit(STRENGTH[1])), F.lit(STRENGTH[0])), F.lit(STRENGTH[1])).alias("s")
    ).scalar()


def _fitted(scored: DataFrame, fit: DataFrame, label: str, measures: tuple[str, ...], share: float, name: str) -> DataFrame:
    """scored with the probability of the label as column `name`; the share where all labels are equal."""
    fit = stage(fit.filter(F.col(label).isNotNull()).orderBy(F.xxhash64("doc_id", F.lit(4))).limit(FIT_ROWS), "evidence_fit")
    if fit.select(label).distinct().count() < 2:
        return scored.withColumn(name, F.lit(share))
    assemble = VectorAssembler(inputCols=list(measures), outputCol="features")
    model = LogisticRegression(labelCol=label, regParam=1e-3, maxIter=50).fit(assemble.transform(fit))
    return (
        model.transform(assemble.transform(scored))
        .withColumn(name, vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def quality(documents: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path, evidence_score, host_share, path_share, quality, toxic_score, kept: one row
    for each row.

    `labels` has doc_id, quality and toxic; a document is good with quality 1. It is kept where
    quality is at least KEEP and toxic_score is below TOXIC. NULL labels do not count; of repeated
    labels the worst counts. NULL hosts and paths are sites of their own. NULL and empty texts have
    no words, and only their measures speak. With labels of one kind only, or none, evidence is the
    global share and everything follows it; without toxic labels nothing is toxic.
    """
    judged = (
        labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy("doc_id")
        .agg(
            F.min((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    features = _measured(documents.select("doc_id", "text", *_inputs(documents)), host, path)
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))
    # Slots go into an exchange for documents with a label only; texts are hashed for those alone.
    known, token = judged.filter(half == 0), F.xxhash64("doc_id")
    bits = bitmap_of(known.select(token.alias("token")))
    told = features.filter((half == 0) & in_bitmap(bits, token)).select("doc_id", F.array_distinct("slots").alias("slots"))
    words = stage(told.join(known, "doc_id").select("good", "toxic", "slots"), "evidence_words")
    weights, toxic = _weights(words)
    # All documents meet their labels after their slots have become three numbers.
    kept = [c for c in features.columns if c != "slots"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema if f.name != "slots")
    evidence = features.select(*kept, "slots").mapInArrow(
        _evidence(weights, toxic, kept), f"{schema}, evidence double, toxic_first double, toxic_sum double"
    )
    scored = stage(evidence.join(judged, "doc_id", "left"), "evidence")

    share, toxic_share = scored.agg(
        F.coalesce(F.avg("good"), F.lit(0.5)), F.coalesce(F.avg("toxic"), F.lit(0.0))
    ).first()
    fit = scored.filter(half == 1)
    p = _fitted(scored, fit, "good", MEASURES, float(share), "evidence_score")
    p = _fitted(p, fit, "toxic", TOXIC_MEASURES, float(toxic_share), "toxic_score")
    kept = (F.col("quality") >= KEEP) & (F.col("toxic_score") < TOXIC)
    return _with_sites(p, float(share), "toxic_score").withColumn("kept", kept)


def _inputs(documents: DataFrame) -> list[str]:
    return [c for c in documents.columns if c not in ("doc_id", "text")]


def _with_sites(scored: DataFrame, share: float, *others: str) -> DataFrame:
    # A label, where there is one, is better evidence of the site than the text's.
    value = F.coalesce(F.col("good").cast("double"), F.col("evidence_score"))
    paths = scored.groupBy("host", "path").agg(F.sum(value).alias("good"), F.count("*").alias("n"))
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    overall = hosts.agg(F.coalesce(F.sum("good") / F.sum("n"), F.lit(share)).alias("p")).scalar()
    at_host = hosts.withColumn("prior", overall)
    host_share = at_host.withColumn("host_share", _shrunk(at_host, F.col("prior"), _strength(at_host, "prior"))).select(
        "host", "host_share", F.col("prior").alias("overall")
    )
    at_path = join_same(paths, host_share, ["host"])
    path_share = at_path.withColumn(
        "path_share", _shrunk(at_path, F.col("host_share"), _strength(at_path, "host_share"))
    ).select("host", "path", "host_share", "path_share", "overall")

    def logit(p: Column) -> Column:
        held = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
        return F.log(held / (1 - held))

    # The text's odds, with the site's prior in place of the global one it was fitted with.
    odds = logit(F.col("evidence_score")) + logit(F.col("path_share")) - logit(F.col("overall"))
    return (
        join_same(scored, path_share, ["host", "path"], "left")
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id", "host", "path", "evidence_score", "host_share", "path_share", "quality", *others,
        )
    )
