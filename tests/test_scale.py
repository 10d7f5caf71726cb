"""What a query takes must not follow from how its files are cut, and a worker holds few rows at once."""

from __future__ import annotations

import math
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import fx
from conftest import ROOT
from radiolake.functions.crypto import xor_lists
from radiolake.llm import collocations, hmm, packing
from radiolake.operators import decode
from radiolake.schemas import RAW_MESSAGES
from radiolake.session import scratch_dir
from radiolake_checks import queries, records, views

_PARSE = """
import sys
import pyarrow as pa
from radiolake.functions import crypto
from radiolake.llm import packing
from radiolake.operators import decode
from radiolake_checks import records
fields = pa.RecordBatch.from_arrays([decode.to_array([1, None], pa.int64())], names=["portnum"]).to_struct_array()
data = decode.to_array([b"ab", None], pa.binary())
decode.envelope_udf(records.SPEC).func(data)
list(records._given(fields))
crypto.xor_bytes.func(data, data)
assert "pandas" not in sys.modules
"""


def test_workers_do_not_load_pandas():
    subprocess.run([sys.executable, "-c", _PARSE], cwd=ROOT, check=True, timeout=120)


def test_a_parse_holds_few_records_at_once():
    blob = fx.envelope(payload=b"x" * 10)
    batch = pa.array([blob, None, b"\x0a\x05", blob[:-3]] * 2500)
    parse = decode.envelope_udf(records.SPEC).func
    parse(batch.slice(0, 8))
    tracemalloc.start()
    parsed = parse(batch)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - held < 6_000_000
    first = parse(batch.slice(0, 4)).to_pylist()
    assert parsed.to_pylist() == first * 2500
    assert parse(batch.slice(0, 0)).to_pylist() == []


def test_arrays_are_those_of_arrow():
    columns = {
        pa.int64(): [2**62 + 1, None, -5], pa.int32(): [None, 7], pa.float32(): [1.5, None],
        pa.bool_(): [True, None, False], pa.string(): ["\u00e9", None, ""], pa.binary(): [None, b"", b"a"],
    }
    for kind, values in columns.items():
        for given in (values, [v for v in values if v is not None], [None], []):
            made = decode.to_array(given, kind)
            made.validate(full=True)
            assert made.equals(pa.array(given, kind))


def test_xor_of_lists_over_many_rows():
    data = pa.array([b"\x01\x02", None, b"", b"\x03"] * 400, pa.binary())
    streams = pa.array([[b"\xff\xff\xff", None, b"a"], [b"a"], [b"a"], None] * 400, pa.list_(pa.binary()))
    assert list(xor_lists(data, streams)) == [[b"\xfe\xfd", b"", b""], None, None, None] * 400
    assert list(xor_lists(data.slice(3, 1), streams.slice(3, 1))) == [None]
    assert list(xor_lists(data.slice(0, 0), streams.slice(0, 0))) == []


def test_rows_as_fields():
    packet = pa.struct([("id", pa.int64()), ("rx_snr", pa.float64()), ("want_ack", pa.bool_())])
    kind = pa.struct([("packet", packet), ("gateway_id", pa.string())])
    rows = [{"packet": {"id": 2**53 + 1, "rx_snr": None, "want_ack": False}, "gateway_id": ""}, None, {"packet": None}]
    given = [{"packet": {"id": 2**53 + 1, "want_ack": False}, "gateway_id": ""}, None, {}]
    assert records._given(pa.array(rows, kind)) == given
    assert records._given(pa.array(rows, kind).slice(1, 2)) == given[1:]


def test_one_row_group_is_dealt_over_all_cores(spark, tmp_path):
    events = spark.range(0, 64, 1, 1).select(
        F.col("id").alias("event_id"), F.lit("2024-01-02").cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit("a").alias("props"),
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made = views.messages(spark, str(tmp_path))
    assert len(made.inputFiles()) >= spark.sparkContext.defaultParallelism
    assert sorted(r.seq for r in made.select("seq").collect()) == list(range(64))


def test_streamed_files_have_many_row_groups(spark):
    rows = spark.range(0, 400_000, 1, 2).select(
        F.lit("t").alias("topic"), F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("payload"),
        F.lit("2024-01-02").cast("timestamp").alias("ingest_ts"), F.col("id").alias("seq"),
    )
    path = scratch_dir(spark, "streamed")
    queries._append(rows, path)
    stored = spark.read.schema(RAW_MESSAGES).parquet(path)
    files = stored.inputFiles()
    assert len(files) == queries.FILES
    assert all(pq.ParquetFile(f.removeprefix("file://")).num_row_groups >= 3 for f in files)
    assert stored.count() == 400_000


def test_packing_forgets_words_seen_once():
    words = packing.Words(packing.VOCABULARY)
    texts = [" ".join(f"w{i}" for i in range(k, k + 1000)) for k in range(0, 300_000, 1000)]
    found = [ids.tolist() for k in range(0, 300, 20) for ids in words.ids(texts[k : k + 20])]
    assert len(words.known) < 225_000
    for k in (0, 150, 299):
        assert found[k] == words.tokenizer.encode(texts[k], add_special_tokens=False).ids


def test_packing_remembers_words_that_come_again():
    words = packing.Words(packing.VOCABULARY)
    name = np.array(list("abcdefghij"))
    spelt = ["".join(name[[int(d) for d in f"{i:06d}"]]) for i in range(500_000)]
    often = [" ".join(spelt[k : k + 1000]) for k in range(0, 20_000, 1000)]
    once = [" ".join(spelt[k : k + 1000]) for k in range(20_000, 500_000, 1000)]
    learned, learn = [], words._learn

    def counted(missing):
        learned.append(len(missing))
        learn(missing)

    words._learn = counted
    for k in range(24):
        texts = [*(often[:10] if k % 2 else often[10:]), *once[20 * k : 20 * k + 20]]
        found = [ids.tolist() for ids in words.ids(texts)]
        assert found[3] == words.tokenizer.encode(texts[3], add_special_tokens=False).ids
    assert sum(learned) < 510_000
    assert len(words.known) < 500_000


def test_packing_splits_odd_words():
    words = packing.Words(packing.VOCABULARY)
    texts = [
        "",
        " \t\r\n\x0b\x0c ",
        "It's,it's \xc9t\xe9...*** don't!! A-b a_b __ 12ab ab12 'S \u0130x \u0178\u01c5\u023a x\u0301y.",
        "one\xa0two\x1cthree\u2003four\x85 <|endoftext|> a<|endoftext|>b <| |> caf\xe9</w> \u4e2d\u6587\uff01 \U0001f600!\x00",
        "last",
    ]
    wanted = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in words.ids(texts)] == wanted
    assert [ids.tolist() for ids in packing._ids_of(words, pa.array(["skipped", *texts]).slice(1))] == wanted
    assert list(words.ids([])) == []


def test_counted_phrases_have_one_key():
    langs, texts = ["en", "a\nb", "", "en"], ["a b, A b\nc", "a  b.\ta b", "a b", "\xc9a b"]
    words = collocations._Words(pa.array(langs), pa.array(texts))
    batches = list(collocations._chunk_rows(words, np.zeros(1 << 8, np.uint8), 1, 4, 8))
    assert {tuple(b.schema.names) for b in batches} == {("key", "act", "n")}
    found = {k: n for b in batches for k, n in zip(b["key"].to_pylist(), b["n"].to_pylist())}
    assert found == {
        b"\nen": 7, b"a\nen": 2, b"b\nen": 3, b"c\nen": 1, "\xc9a\nen".encode(): 1,
        b"a b\nen": 2, "\xc9a b\nen".encode(): 1,
        b"\na\nb": 4, b"a\na\nb": 2, b"b\na\nb": 2, b"a b\na\nb": 2,
        b"\n": 2, b"a\n": 1, b"b\n": 1, b"a b\n": 1,
    }


def test_odd_languages_are_told_apart(spark):
    rows = [("en", "a b c. A b"), ("en\nx", "a b, a B"), (None, "a b"), ("en ", "a b"), ("", "")] * 3
    found = collocations.phrase_counts(spark.createDataFrame(rows, "lang string, text string").repartition(2), least=3)
    wanted = {("en", 0, ""): 15, ("en", 1, "a"): 6, ("en", 1, "b"): 6, ("en", 1, "c"): 3, ("en", 2, "a b"): 6}
    wanted |= {("en", 2, "b c"): 3, ("en", 3, "a b c"): 3}
    for lang, n in (("en\nx", 2), ("und", 1), ("en ", 1)):
        wanted |= {(lang, 0, ""): 6 * n, (lang, 1, "a"): 3 * n, (lang, 1, "b"): 3 * n, (lang, 2, "a b"): 3 * n}
    assert {(r.lang, r.k, r.phrase.decode()): r.n for r in found.collect()} == wanted


def test_hmm_does_not_split_texts_again_for_each_use(spark):
    rows = [(i, f"a B b{i}\n\tc\x0bd \xc9a" if i % 5 else None) for i in range(40)]
    found = hmm.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rounds=1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    training = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    words = {i: ["a", "b", f"b{i}", "c", "d", "\xc9a"] if t else [] for i, t in rows}
    counts = Counter(w for i, _ in training for w in [*words[i], None])
    n, v = sum(counts.values()), len(counts)
    for r in found.collect():
        tokens = [*words[r.doc_id], None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
        assert abs(r.base_score - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)) < 1e-9
