"""Near-duplicate documents by min-max hashing of five-word shingles.

Each permutation is evaluated once per shingle and gives two signature values, its minimum and its
maximum. 64 permutations give 128 values in 32 bands of four. Two documents of similarity 0.75
share no band with a probability of 0.684 ** 32 = 5e-6, and agree in fewer than 70 of the values
(a pair that is then not confirmed) with about 1e-7; larger similarities are missed less. All else
is exact: no bucket is cut, and every link is confirmed on the full sets.

Documents with equal sets are one node from the start, so copies cost a row each and no pair.

1. Each bucket of a band gives a spanning forest over the pairs its signatures do not exclude, at most
   one edge less than it has members. The components of all these edges are clusters: no link leaves one.
2. Each node brings its set to its cluster once. There pairs are confirmed on full sets, the most
   alike first, and give a spanning forest of confirmed links; pairs a tree holds already need no test.

Pairs are compared inside tasks and never become rows. Large groups are dealt over many tasks in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.llm.bitmap import bitmap_of, in_bitmap
from radiolake.llm.components import components
from radiolake.llm.text import ascii_lower, space_words, text_of
from radiolake.session import stage

SHINGLE = 5
PERMUTATIONS, BANDS, BAND_WIDTH = 64, 32, 4
#: A link needs 100 * shared >= PERCENT * union.
PERCENT = 75
#: Of 128 signature values, how many agree at least in a pair worth confirming.
POSSIBLE = 70
#: Rows of a block: of a bucket's signatures, and of a cluster's sets.
BUCKET_BLOCK, CLUSTER_BLOCK = 512, 256
_STRIDE = 8192

_seeded = np.random.default_rng(20240501)
_MULTIPLY = _seeded.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * 2 + 1
_ADD = _seeded.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_POSITION = _seeded.integers(0, 2**63, SHINGLE, dtype=np.uint64) * 2 + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of a document's shingles, from the hashes of its words."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total += _mixed(words[j : n - size + 1 + j] + _POSITION[j])  # the sum keeps word order: each place has its own shift
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> bytes:
    """128 values: the minima of all permutations, then the maxima."""
    keys = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    for i in range(0, len(keys), _STRIDE):
        values = np.multiply.outer(_MULTIPLY, keys[i : i + _STRIDE])
        values += _ADD[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low.tobytes() + high.tobytes()


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    lists = batch.column("words")
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    for a, b in pairwise(lists.offsets.to_numpy()):
        yield shingle_set(flat[a:b])


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_shingles", pa.int64()),
        ("node", pa.binary()),
        ("signature", pa.binary()),
    ]
)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, nodes, signatures = [], [], []
        for s in _sets(batch):
            counts.append(len(s))
            nodes.append(_digest(s) if len(s) else None)
            signatures.append(signature(s) if len(s) else None)
        columns = [batch.column("doc_id"), batch.column("text_hash"), counts, nodes, signatures]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, _SIGNED, strict=True)],
            schema=_SIGNED,
        )


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(_sets(batch))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["node", "shingles"],
        )


def _word_hashes(text):
    return F.transform(space_words(ascii_lower(text)), lambda w: F.xxhash64(w)).alias("words")


def _pairs_of(size: int, first: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a group; between two blocks only those that have a member in either."""
    if diagonal:
        return np.triu_indices(size, 1)
    left, right = np.flatnonzero(first), np.flatnonzero(~first)
    return np.repeat(left, len(right)), np.tile(right, len(left))


def _possible(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group that the signatures do not exclude, those that agree most first."""
    n = rows.num_rows
    values = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(n, -1)
    sizes = rows.column("n_shingles").to_numpy()
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    a, b = _pairs_of(n, rows.column("block").to_numpy() == i, i == j)
    low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    near = 100 * low >= PERCENT * high
    a, b = a[near], b[near]
    score = np.empty(len(a), np.int16)
    for k in range(0, len(a), 1 << 16):
        cut = slice(k, k + (1 << 16))
        score[cut] = (values[a[cut]] == values[b[cut]]).sum(axis=1)
    order = np.argsort(-score, kind="stable")
    order = order[score[order] >= POSSIBLE]
    return a[order], b[order]


def _forest(a: np.ndarray, b: np.ndarray, size: int, holds=None) -> list[tuple[int, int]]:
    """Pairs that make a spanning forest of those that hold; no pair inside a tree is tried."""
    parent, taken = list(range(size)), []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = x, y
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        while parent[q] != q:
            parent[q] = q = parent[parent[q]]
        if p != q and (holds is None or holds(x, y)):
            parent[p] = q
            taken.append((x, y))
    return taken


def _bucket_forest(rows: pa.Table) -> list[tuple[int, int]]:
    a, b = _possible(rows)
    return _forest(a, b, rows.num_rows)


def _verified_forest(rows: pa.Table) -> list[tuple[int, int]]:
    lists = rows.column("shingles").combine_chunks()
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    sets = [flat[x:y] for x, y in pairwise(lists.offsets.to_numpy())]

    def linked(x: int, y: int) -> bool:
        small, large = sorted((sets[x], sets[y]), key=len)
        place = np.minimum(np.searchsorted(large, small), len(large) - 1)
        shared = int((large[place] == small).sum())
        return 100 * shared >= PERCENT * (len(small) + len(large) - shared)

    a, b = _possible(rows)
    return _forest(a, b, rows.num_rows, linked)


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _by_group(choose):
    """Apply choose to each run of rows with equal key, i, j; give its pairs as nodes a < b."""

    def breaks(table: pa.Table) -> np.ndarray:
        parts = [table.column(c).to_numpy() for c in ("key", "i", "j")]
        return np.flatnonzero(np.any([x[1:] != x[:-1] for x in parts], axis=0)) + 1

    def chosen(table: pa.Table) -> pa.RecordBatch:
        nodes = table.column("node").to_pylist()
        pairs = []
        for x, y in pairwise([0, *breaks(table).tolist(), table.num_rows]):
            if y - x > 1:
                pairs += [sorted((nodes[x + p], nodes[x + q])) for p, q in choose(table.slice(x, y - x))]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], schema=_PAIR
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            # The last group may go on in the next batch; a group has two blocks at most.
            whole = int(breaks(table).max(initial=0))
            if whole:
                yield chosen(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
        if waiting:
            yield chosen(pa.Table.from_batches(waiting).combine_chunks())

    return run


def _buckets(nodes: DataFrame) -> DataFrame:
    """node, key, members: the nodes of each bucket with two or more."""
    width = BAND_WIDTH * 4
    keys = F.array(
        *[F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(BANDS)]
    )
    each = nodes.select("node", F.explode(keys).alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    return each.join(shared, "key")


def _forests(grouped: DataFrame, block: int, choose) -> DataFrame:
    """Distinct pairs that choose gives for the groups (key, members). A large group is dealt into
    blocks of about `block` rows, and every two blocks meet in a task of their own."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    carried = [c for c in grouped.columns if c not in ("key", "members")]
    spread = grouped.withColumn(
        "block", F.expr(f"cast(pmod(xxhash64(node), ceil(members / {block})) AS INT)")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    together = (
        spread.select(
            "key",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            *carried,
        )
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )
    return together.mapInArrow(_by_group(choose), "a binary, b binary").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: one row for each row.

    A NULL or empty text, or one without words, has no shingles and is linked with nothing; its
    component is its own doc_id. Texts of one to four words have one shingle. Repeated rows are
    copies: they share a component, and each row whose doc_id is the component's is kept. Rows
    with a NULL doc_id take part in links, are nobody's representative and are kept only where no
    linked document has an id (component_id NULL). No documents give no rows.
    """
    signed = stage(
        documents.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), _word_hashes(text_of())).mapInArrow(
            _signed, "doc_id long, text_hash long, n_shingles long, node binary, signature binary"
        ),
        "signed",
    )
    nodes = stage(
        signed.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min("text_hash").alias("text_hash"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "nodes",
    )
    signatures = nodes.select("node", "signature", "n_shingles")
    in_buckets = _buckets(nodes).join(signatures, "node")
    clusters = components(stage(_forests(in_buckets, BUCKET_BLOCK, _bucket_forest), "candidates"))
    sizes = clusters.groupBy("label").agg(F.count("*").alias("members"))
    clustered = stage(
        clusters.join(sizes, "label")
        .withColumn("key", F.xxhash64("label"))
        .select("key", "members", "node")
        .join(nodes, "node"),
        "clusters",
    )
    wanted = clustered.select("text_hash").distinct()
    # Most texts are in no cluster; the bitmap drops them where they are read.
    texts = (
        documents.select(F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
        .filter(in_bitmap(bitmap_of(wanted.withColumnRenamed("text_hash", "token")), F.col("text_hash")))
        .join(wanted, "text_hash", "left_semi")
        .groupBy("text_hash")
        .agg(F.first("text").alias("text"))
    )
    sets = texts.select(_word_hashes(F.col("text"))).mapInArrow(_expanded, "node binary, shingles array<long>")
    with_sets = clustered.select("key", "members", "node", "signature", "n_shingles").join(sets, "node")
    labels = components(stage(_forests(with_sets, CLUSTER_BLOCK, _verified_forest), "verified"))

    linked = nodes.join(labels, "node").select("node", "label", "first_id")
    ids = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    own = nodes.join(linked.select("node", "label"), "node", "left").join(ids, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("component_id"))
    found = own.select("node", component.alias("component_id"))
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "node")
        .join(found, "node", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicate(documents: DataFrame) -> DataFrame:
    """One document of each component, with the columns they came with; repeated rows count once."""
    verdicts = stage(near_duplicates(documents), "verdicts")
    keys = [F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")]
    match = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text_of()) == F.col("__hash"))
    kept = verdicts.filter("kept")
    repeated = kept.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select("__doc", "__hash")
    others = verdicts.filter("NOT kept").select(*keys).distinct()
    once = (
        documents.join(repeated, match, "left_semi")
        .withColumn("__hash", F.xxhash64(text_of()))
        .dropDuplicates(["doc_id", "__hash"])
        .drop("__hash")
    )
    return documents.join(others.union(repeated), match, "left_anti").union(once)
