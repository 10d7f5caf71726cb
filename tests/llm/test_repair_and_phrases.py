"""Phrases, exact copies and turn repair against brute force, and odd input for them."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from radiolake.llm import collocations, exact_dedup, turn_repair

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- phrases ---


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def phrase_counts(docs):
    found = Counter()
    for lang, text in docs:
        for w in pieces(text):
            found[lang or "und", ()] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    found[lang or "und", tuple(w[i : i + k])] += 1
    return found


def random_docs(count, seed):
    rnd = random.Random(seed)
    vocabulary = ["A", "b", "ç", "dd", "\U0001f600", "e-e", " f", "g\x00"]
    out = []
    for i in range(count):
        lang = rnd.choice(["en", "en", "en", "fr", None])
        text = "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n"]) for _ in range(rnd.randint(0, 40)))
        out.append((lang, text))
    return out


@pytest.mark.parametrize("bits", [6, 24])
def test_phrase_counts(spark, bits):
    docs = random_docs(150, 5) + [("en", None), ("en", ""), ("xx", " . \n")] + [("de", "same words again and again")] * 40
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = {
        (r.lang, tuple(bytes(r.phrase).decode().split(" ")) if r.k else ()): r.n
        for r in collocations.phrase_counts(frame, least=9, shards=3, bits=bits).collect()
    }
    want = phrase_counts(docs)
    assert got == {x: n for x, n in want.items() if (n >= 9 if x[1] else n > 0)}
    assert any(len(p) == 4 for _, p in got)


def test_scores_and_containment(spark):
    docs = random_docs(120, 8) + [("en", "one two three four")] * 30
    counts = phrase_counts(docs)
    frame = spark.createDataFrame(docs, "lang string, text string")
    found = collocations.collocations(frame, least=9, shards=2).collect()
    assert len(found) == sum(n >= 9 and len(p) > 1 for (_, p), n in counts.items())
    for r in found:
        p = tuple(bytes(r.phrase).decode().split(" "))
        f = lambda q: counts[r.lang, q]
        score, cut = min((2_000_000 * f(p) // (f(p[:j]) + f(p[j:])), j) for j in range(1, len(p)))
        assert (r.a, r.score, r.l, r.r, r.n) == (f(p), score, f(p[:cut]), f(p[cut:]), f(()))
        longer = [n for (lang, q), n in counts.items() if lang == r.lang and len(q) > len(p) and n >= 9
                  and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        assert r.inside == any(100 * n >= 80 * r.a for n in longer)


def test_phrases_of_odd_rows(odd, nothing):
    assert collocations.phrase_counts(nothing).count() == 0
    got = collocations.phrase_counts(odd, least=1).filter("k = 0").collect()
    want = phrase_counts([(r.lang, r.text) for r in odd.select("lang", "text").collect()])
    assert {(r.lang, ()): r.n for r in got} == {x: n for x, n in want.items() if not x[1]}


# --- exact copies ---


def same(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("capacity, bits", [(65_536, 64), (3, 64), (2, 4)])
def test_exact_groups(spark, odd, capacity, bits):
    rnd = random.Random(2)
    texts = ["a b", "a  b", "a\n\tb ", "a b ", "", None, " ", "c", " ", "a  b", "x" * 9_000]
    rows = [(rnd.randint(-50, 50), rnd.choice(texts)) for _ in range(300)] + [(i, f"t{i % 90}") for i in range(200)]
    rows += [(None, "only"), (None, "only"), (-(2**63), "c"), (2**63 - 1, "far")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = defaultdict(list)
    for i, text in rows:
        groups[same(text)].append(i)
    found = exact_dedup.exact_groups(frame, capacity, bits).collect()
    want = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want.update((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [(r.text_sha256, r.doc_id == r.keep_id or r.keep_id is None) for r in found if r.kept]
    assert len(kept) == len(groups) == len({t for t, _ in kept}) and all(own for _, own in kept)


def test_directory_doubles_where_buckets_are_overfull(spark):
    keys = spark.range(5_000).select(F.xxhash64("id").alias("key"))
    directory, depth = exact_dedup.directory_of(keys, 100)
    rows = directory.collect()
    assert sorted(r.slot for r in rows) == list(range(1 << depth))
    slot = F.shiftrightunsigned("key", 64 - depth)
    size = keys.withColumn("slot", slot).join(directory, "slot").groupBy("bucket", "depth").count().collect()
    assert max(r["count"] for r in size) <= 100 and sum(r["count"] for r in size) == 5_000
    for r in size:  # what is split held too much
        whole = [s["count"] for s in size if r.depth and s.bucket >> (depth - r.depth + 1) == r.bucket >> (depth - r.depth + 1)]
        assert not whole or sum(whole) > 100


def test_deduplicate_keeps_one_row_and_all_columns(odd, nothing):
    out = exact_dedup.deduplicate(odd)
    assert out.columns == odd.columns
    rows, kept = odd.select("doc_id", "text").collect(), out.select("doc_id", "text").collect()
    assert Counter(same(r.text) for r in kept) == Counter(dict.fromkeys({same(r.text) for r in rows}, 1))
    assert {same(r.text): r.doc_id for r in kept}[same("a")] == 4
    assert exact_dedup.deduplicate(nothing).count() == 0


# --- turn repair ---


def repaired(turns):
    """The least (cost, audit) and its turns, by trying each edit of each turn in each state."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserts(ways):
        for _ in range(3):
            for state, (cost, audit, out) in list(ways.items()):
                for x in "ua":
                    if x in follow[state]:
                        put(ways, x, (cost + 5, audit + "I", (*out, f"{name[x]}:")))
        return ways

    ways = inserts({"": (0, "", ())})
    for role, text, fault in turns:
        after = {}
        for state, (cost, audit, out) in ways.items():
            put(after, state, (cost + 2, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                if role[:1] and role[0] in follow[state]:
                    put(after, role[0], (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for x in "ua":
                    if x in follow[state]:
                        put(after, x, (cost + more + 1, audit + "R", (*out, f"{name[x]}:{text}")))
        ways = inserts(after)
    return min(w for s, w in ways.items() if s in ("", "a"))


def report(rows, damage=True):
    shown = lambda v: " " if v is None else str(v)
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv]
        role, text = shown(role), shown(text)
        fate = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20 if damage else 19
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        by[conv] += [((turn is not None, turn or 0, role, digest), turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[0])
        numbers = [t for _, t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, faults = set(), []
        for _, _, role, text in turns:
            end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else None if end in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] for _, _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, texts = repaired([(r, x, f) for (_, _, r, x), f in zip(turns, faults)])
        digest = hashlib.sha256("\n".join(texts).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string"


def random_turns(count, seed, convs):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "alien"], ["Yes.", "No", "Why?", "", None, " \t", "é!\n", "x" * 50]
    return [(rnd.choice(convs), rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"t{rnd.random()}.") for _ in range(count)]


@pytest.mark.parametrize("block, fan", [(512, 64), (2, 2)])
def test_turn_repair(spark, monkeypatch, block, fan):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    monkeypatch.setattr(turn_repair, "FAN", fan)
    rows = random_turns(260, 4, [None, 1, 1, 1, 2, *range(3, 40)]) + [(77, 1, "user", "Hi."), (77, 1, "user", "Hi.")]
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    assert sorted((tuple(r) for r in turn_repair.repair_report(frame).collect()), key=str) == report(rows)


def test_repaired_turns_follow_the_grammar(spark):
    rows = random_turns(120, 9, [None, 1, 2, 3])
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", pos int, audit string")
    repairs, ordered = turn_repair.repair(frame)
    told = {r.conv_id: r for r in repairs.collect()}
    assert {(c, r.cost, r.audit) for c, r in told.items()} == {(r[0], r[6], r[7]) for r in report(rows, damage=False)}
    turns = defaultdict(list)
    for r in turn_repair.repaired(ordered, repairs).orderBy("conv_id", "position").collect():
        assert r.position == len(turns[r.conv_id])
        turns[r.conv_id].append(r.role[0])
    for conv, initials in turns.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(initials))
        assert len(initials) == len(told[conv].audit.replace("D", ""))


def test_no_turns(spark):
    assert turn_repair.repair_report(spark.createDataFrame([], TURNS)).count() == 0


def test_stacks_are_those_of_the_grammar():
    assert len(turn_repair.STACKS) == 8
    words = {"": (0,)}
    for _ in range(7):
        words = {**words, **{w + x: t for w, s in words.items() for x in "sua" if (t := turn_repair._push(s, x))}}
    assert {w for w, s in words.items() if s[-1] in turn_repair._ACCEPT} == {
        w for w in words if re.fullmatch("(s?(ua)+)?", w)
    }
