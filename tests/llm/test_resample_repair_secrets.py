"""Importance resampling, conversation repair and secret scans against plain Python, with awkward rows in each."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fitmesh.llm import conversations, resample, secrets

LONG = "long " * 20_000 + "é" * 3000
LOWER = {i: i + 32 for i in range(65, 91)}


# importance resampling


def test_crc_matrices_equal_zlib():
    rng = random.Random(1)
    data = np.frombuffer(rng.randbytes(6000), np.uint8)
    spans = [(rng.randrange(3000), rng.choice([0, 1, 2, 5, 8, 9, 17, 255, 256, 257, 300, 512, 513, 2900])) for _ in range(600)] + [(5, 7)] * 3
    got = resample.crc_spans(data, *(np.array(x) for x in zip(*spans)))
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in spans]


def test_features_that_share_a_key_are_told_apart(monkeypatch):
    monkeypatch.setattr(resample, "mix", lambda x: np.zeros_like(x))  # every key is the last eight bytes alone
    data = np.frombuffer(b"aaaaaaaa-same-endbbbbbbbb-same-end", np.uint8)
    got = resample.crc_spans(data, np.array([0, 17, 0]), np.array([17, 17, 17]))
    assert got.tolist() == [zlib.crc32(x) for x in (b"aaaaaaaa-same-end", b"bbbbbbbb-same-end", b"aaaaaaaa-same-end")]


def features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, longest, buckets, min_words, percent, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        n, own = features(text, longest)
        weight, score = sum(gain[bucket(f)] for f in own), None
        if key is not None:
            h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, n, len(own), weight, score, None])
    able = sorted((r for r in rows if r[0] is not None and r[1] >= min_words), key=lambda r: (-r[4], r[0], r[2], r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_draws_equal_plain_python(spark, longest):
    rng = random.Random(longest)
    vocabulary = ["Alpha", "beta", "über", "日本", "x9", "gamma-ray", "end."]
    docs = [(k % 45, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 9)))) for k in range(60)]
    docs += [(None, "alpha beta gamma"), (None, None), (70, None), (71, ""), (72, "... --"), (73, LONG), (74, LONG), (75, "same same"), (75, "same same"), (76, "w" * 70_000)]
    target = ["alpha beta", None, "", "日本 x9 alpha"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rank": F.lit("mine"), "id": F.lit(1), "weight": F.lit(0)}).repartition(5)
    got = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=50, min_words=2, percent=30)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(docs, target, longest, 50, 2, 30, 2024)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert resample.resample(none, some, min_words=1).collect() == []
    got = resample.resample(some, none, min_words=1, percent=50)
    assert sorted((r["doc_id"], r["rank"] is not None) for r in got.collect()) in ([(1, True), (2, False)], [(1, False), (2, True)])


def test_documents_like_the_target_are_drawn_more_often(spark):
    docs = [(k, ("wanted words here " if k % 4 == 0 else "other stuff there ") * 8) for k in range(400)]
    target = spark.createDataFrame([("wanted words here",)] * 40, "text string")
    drawn = resample.resample(spark.createDataFrame(docs, "doc_id long, text string"), target, longest=2, percent=20).where("rank is not null")
    assert drawn.count() == 80 and drawn.where("doc_id % 4 = 0").count() >= 76


# conversation repair


def cheapest(rows):
    """Best (cost, audit) over all edits with up to two insertions in a gap. Rows are (initial, must go, truncated)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = (math.inf, "")

    def walk(i, state, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        for inserted in range(3):
            if inserted:
                state, cost, audit = step[state, "a" if state == "u" else "u"], cost + 5, audit + "I"
            if i == len(rows):
                if state in ("", "a"):
                    best = min(best, (cost, audit))
                continue
            initial, gone, cut = rows[i]
            walk(i + 1, state, cost + 2, audit + "D")
            if not gone:
                if (state, initial) in step:
                    walk(i + 1, step[state, initial], cost + 5 * cut, audit + "K")
                for r in "ua":
                    if (state, r) in step:
                        walk(i + 1, step[state, r], cost + 1 + 5 * cut, audit + "R")

    walk(0, "", 0, "")
    return best


@pytest.mark.parametrize("block", [512, 2, 1])
def test_integer_minimum_equals_enumeration(monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        rows = [(rng.choice("suaat"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(8))]
        dp = conversations.Repair()
        for initial, gone, cut in rows:
            dp.add(initial, gone, cut and not gone)
        assert dp.best() == cheapest([(i, g, c and not g) for i, g, c in rows])


def brute_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults, states, illegal = set(), [0, 0, 0], [], 0
    for k, (_, role, text) in enumerate(rows):
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            faults[kind] += 1
        states.append((role[:1], kind in (0, 1), kind == 2))
        illegal += k > 0 and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = cheapest(states)
    out, at, last = [], 0, ""
    for letter in audit:
        want = {"u": "user", "a": "assistant"}["a" if last == "u" else "u"]
        if letter == "I":
            out.append((want, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                out.append((role if letter == "K" else want, text))
        if out:
            last = out[-1][0][:1]
    return (len(rows), gaps, *faults, illegal, cost, audit), out


def test_repair_of_awkward_conversations(spark):
    rng = random.Random(9)
    said = ["Yes.", "No!", "Why?", "cut off", " \t", "", "A b. "]
    given = [(c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", "User", "u"]), rng.choice(said)) for c in range(60) for _ in range(rng.randrange(1, 7))]
    given += [(100, None, "user", "Hi."), (100, None, "user", "Hi."), (101, 1, None, None), (None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (102, 7, "user", LONG + "."), (102, 8, "assistant", LONG)]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "audit": F.lit("mine"), "cost": F.lit(1)}).repartition(4)
    report = conversations.repair(df)
    want = {}
    for c, t, r, x in given:
        want.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    want = {c: brute_repair(rows) for c, rows in want.items()}
    got = {r["conv"]: tuple(r)[1:] for r in report.collect()}
    assert got == {c: w[0] for c, w in want.items()}
    turns = {}
    for r in conversations.repaired_rows(df, report).collect():
        turns.setdefault(r["conv"], []).append((r["place"], r["role"], r["text"]))
    assert {c: [t[1:] for t in sorted(ts)] for c, ts in turns.items()} == {c: w[1] for c, w in want.items() if w[1]}
    digests = {r["conv"]: r["sha256"] for r in conversations.repaired_digests(df, report).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in w[1]).encode()).hexdigest() for c, w in want.items() if w[1]}


def test_a_very_long_conversation_and_no_conversation(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id", F.lit(".")).alias("text"))
    report = conversations.repair(rows).collect()
    cost = {"a": 0, "u": math.inf}  # the least cost so far by the last turn left
    for k in range(20_000):
        at = {"a": min(cost["a"], cost["u"] + 5), "u": min(cost["u"], cost["a"] + 5)}
        role = "u" if k % 3 == 0 else "a"
        cost = {s: min(cost[s] + 2, at[other] + (role != s)) for s, other in (("a", "u"), ("u", "a"))}
    assert len(report) == 1 and report[0]["cost"] == min(cost["a"], cost["u"] + 5) and len(report[0]["audit"].replace("I", "")) == 20_000
    empty = rows.where("turn < 0")
    assert conversations.repair(empty).collect() == [] and conversations.repaired_rows(empty, conversations.repair(empty)).collect() == []


def test_damage_follows_the_hash(spark):
    given = [(c, t, "assistant", "A. b!") for c in range(20) for t in range(5)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in given:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            want += [(c, t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    got = conversations.damage(spark.createDataFrame(given, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


# secret scans


@pytest.mark.parametrize("regex, query", [
    ("abcd", [[{"abc", "bcd"}]]),
    ("ABC|xyz", [[{"abc"}, {"xyz"}]]),
    ("(?i:to_?ken)x", [[{"tok", "oke", "ken", "enx"}, {"to_", "o_k", "_ke", "ken", "enx"}]]),
    ("abc[0-9]+def", [[{"abc"}], [{"def"}]]),
    ("[0-9a-f]{32,}", []), ("ab", []), ("(abc)?", []), ("(abc)+z", [[{"abc"}]]), ("abc|d", []), ("\\babc$", [[{"abc"}]])])
def test_trigram_queries(regex, query):
    assert {frozenset(c) for c in secrets.trigram_query(regex)} == {frozenset(frozenset(s) for s in c) for c in query}


def test_queries_hold_for_every_match():
    rng = random.Random(2)
    pieces = ["token", "=", " ", "api_key", "APIKEY", ": ", "password", "abcdefgh1", "AKIA", "X" * 16, "ghp_" + "a" * 36, "eyJ", "-----BEGIN RSA PRIVATE KEY-----", "://me:pass@", "'", "xoxb-", "sk_live_", "0" * 32]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6)))
        for rule in secrets.BASE + secrets.ADDED:
            if re.search(rule.regex, text):
                assert all(any(all(t in text.lower() for t in s) for s in clause) for clause in secrets.trigram_query(rule.regex))


def brute_secrets(text, rules):
    out = [(m.start(), k, m.end(), m[0]) for k, r in enumerate(rules) for m in re.finditer(r.regex, text or "", re.ASCII) if len(m[r.group]) >= r.at_least]
    return [(rules[k].kind, a, b, v) for a, k, b, v in sorted(out)]


def test_secrets_of_awkward_texts(spark):
    rng = random.Random(4)
    pieces = ["token", "=", " ", "\n", "é日", "API_KEY", "apikey", ": ", "Passwd", "abcdefgh1", "short", "AKIA", "X" * 12, "ghp_" + "a" * 36, "://me:pass@", '"', "'", "0a" * 16, "0a" * 15, "eyJabcdefgh.eyJabcdefgh.x", "ſecret=abcdefgh1"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    texts += [None, "", "token=abcdefgh; " * 3000, "x" * 50_000 + "AKIA" + "B" * 20, LONG, texts[0], texts[0]]
    df = spark.createDataFrame([(i % 250, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns({"secrets": F.lit("mine"), "_key": F.lit(1), "gram": F.lit("g"), "_clauses": F.lit(2), "c0": F.lit(7)})
    got = secrets.scan_secrets(df.repartition(3))
    assert got.columns == [c for c in df.columns if c != "secrets"] + ["secrets"]
    rows = got.collect()
    found = sorted(((r["doc_id"], r["text"], [tuple(s) for s in r["secrets"]]) for r in rows), key=repr)
    assert found == sorted(((i % 250, t, brute_secrets(t, secrets.BASE + secrets.ADDED)) for i, t in enumerate(texts)), key=repr)
    assert {(r["_key"], r["gram"], r["c0"]) for r in rows} == {(1, "g", 7)}


def test_rules_without_trigrams_and_empty_tables(spark):
    rules = (secrets.Rule("digits", "[0-9]{4,}"), secrets.Rule("never", "zzzqqq"))
    df = spark.createDataFrame([(1, "a 12345"), (2, None)], "doc_id long, text string")
    assert [[tuple(s) for s in r["secrets"]] for r in secrets.scan_secrets(df, rules).orderBy("doc_id").collect()] == [[("digits", 2, 7, "12345")], []]
    assert secrets.scan_secrets(df, rules[:1]).count() == 2 and secrets.scan_secrets(df.where("doc_id > 5")).collect() == []


def test_native_scan_uses_no_python(spark):
    plan = secrets.scan_secrets(spark.createDataFrame([(1, "token=abcdefgh1")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("MapInArrow", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"))
