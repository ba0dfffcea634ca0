"""Prefix trie, periodic runs and document fingerprints against plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import re
import struct
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from test_llm_small import ODD

from tallyrule.llm import fingerprints, periodic, prefixtrie
from tallyrule.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix trie ---------------------------------------------------------------------


def brute_trie(rows, head, donor):
    """Nodes of the rebuilt conversations; ``rows`` of (id, turn, role, text) without ties in a turn."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {c: tuple(own.get(donor(c), [])[: head(c)] + v[head(c) :]) for c, v in own.items()}
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        out, todo = [], [k]
        while todo:
            out.append(todo.pop())
            todo += children[out[-1]]
        return out

    nodes = []
    for k, m in members.items():
        under = below(k)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        ends = ",".join(map(str, sorted(c for c in m if built[c] == k)))
        parent = min(members[k[:-1]]) if k else None
        leaves = sum(not children[x] for x in under)
        nodes.append((min(m), len(k), parent, len(m), len(children[k]), leaves, saved, sha(ends)))
    return sorted(nodes, key=repr)


def spark_trie(spark, rows, head, donor, most):
    turns = spark.createDataFrame(rows, "c long, t long, role string, text string").repartition(3)
    turns = turns.withColumns({n: F.lit(1) for n in ("id", "at", "h1", "n", "bytes", "__n", "__at")})
    built = prefixtrie.with_shared_heads(prefixtrie.turn_rows(turns, "c", "t", "role", "text"), head, donor, most)
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(*built).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(prefixtrie, "BLOCK", 3)  # so that conversations are summed in several blocks
    monkeypatch.setattr(prefixtrie, "IDS", 4)
    r = random.Random(seed)
    rows = []
    for c in range(-3, 40):
        if r.random() < 0.9:
            for t in range(r.choice([1, 2, 3, 5, 9, 14])):
                text = r.choice(["", "é", "same words", None, "b c"]) if r.random() < 0.8 else f"text {c}"
                rows.append((c, None if t == 0 else t * r.choice([1, 3]) + 10 * t, r.choice(["user", "bot", None]), text))
    for c in range(100, 115):  # one conversation many times
        rows += [(c, t, "user", f"turn {t}") for t in range(6)]
    rows.append((None, 1, "user", "nobody's"))
    h = lambda c: zlib.crc32(str(c).encode()) % 4
    head = F.crc32(F.col("id").cast("string").cast("binary")) % 4
    donor = lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1)
    assert spark_trie(spark, rows, head, F.col("id") - F.col("id") % 5, 3) == brute_trie(rows, h, donor)


def test_trie_of_repeated_rows_and_of_nothing(spark):
    rows = [(1, 1, "a", "x")] * 3 + [(2, 1, "a", "x"), (2, 2, "a", "x"), (2, 2, "a", "x")]
    found = spark_trie(spark, rows, F.lit(0), F.col("id"), 0)
    assert found == brute_trie([(c, k, "a", "x") for c in (1, 2) for k in (1, 2, 3)], lambda c: 0, lambda c: c)
    assert spark_trie(spark, [(None, 1, "a", "x")], F.lit(0), F.col("id"), 0) == []


def test_trie_of_a_conversation_longer_than_a_block(spark):
    rows = [(1, t, "a", f"{t % 7}") for t in range(2500)] + [(2, t, "a", f"{t % 7}") for t in range(2600)]
    found = spark_trie(spark, rows, F.lit(0), F.col("id"), 0)
    assert len(found) == 2601 and sum(n[3] for n in found) == 2501 + 2601
    assert sum(n[5] == 1 for n in found) == 2601 and max(n[6] for n in found) == 2500


# --- periodic runs ---------------------------------------------------------------------


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            run = w[s : i + q]
            if len(run) >= max(6, 4 * q) and not any(run[d:] == run[:-d] for d in range(1, q)):
                out.append((s, len(run), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    r = random.Random(7)
    for _ in range(150):
        texts = []
        for _ in range(r.randint(0, 6)):
            w = [b"%d" % r.randint(0, r.choice([1, 2, 5, 30])) for _ in range(r.randint(0, 120))]
            for _ in range(r.randint(0, 3)):
                if w:
                    a, m = r.randrange(len(w)), r.randint(0, 400)
                    u = w[a : a + r.randint(1, 90)]
                    w = w[:a] + (u * (m // len(u) + 1))[:m] + w[a + r.randint(0, len(u)) :]
            texts.append(w)
        assert periodic.find_runs_in(texts) == [brute_runs(w) for w in texts]


def test_runs_at_large_scales():
    words = [b"%d" % k for k in range(3000)]
    for period in (8, 9, 16, 17, 255, 256, 257, 700, 750):
        text = words[:100] + (words[1000 : 1000 + period] * 5)[: 4 * period] + words[:50]
        assert periodic.find_runs_in([text]) == [[(100, 4 * period, period)]], period
        assert periodic.find_runs_in([text[: 100 + 4 * period - 1] + words[:50]]) == [[]]


def brute_collapse(w):
    gone = {k for s, n, q in brute_runs(w) for k in range(s + q, s + n)}
    return b" ".join(x for k, x in enumerate(w) if k not in gone).decode()


def test_runs_of_odd_texts(spark):
    rows = [*ODD, (10, "x " * 7), (11, "a b " * 4 + "a"), (12, "w\x1cw " * 6 + " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({n: F.lit(1) for n in ("Runs", "start", "length")})
    found = periodic.find_runs(docs)
    assert found.columns == ["doc_id", "text", "start", "length", "runs"]
    words = lambda t: (t or "").encode().split()
    got = sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["runs"]]) for r in found.collect()), key=repr)
    assert got == sorted(((i, t, [(0, 20_000, 1)] if i == 5 else brute_runs(words(t))) for i, t in rows), key=repr)
    kept = {r["doc_id"]: r["text"] for r in periodic.collapse_runs(docs).collect()}
    assert kept[5] == "long" and kept[10] == "x" and kept[11] == "a b" and kept[1] == ""
    assert periodic.find_runs(docs.limit(0)).collect() == []


@needs_tables
def test_runs_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", texts[r["doc_id"]].encode())
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(brute_collapse(w))
    assert any(r["n_runs"] for r in rows)


# --- fingerprints ------------------------------------------------------------------------


def h64(data, *seeds):
    seed = 42
    for s in seeds:
        seed = xxhash.xxh64_intdigest(struct.pack("<i", s), seed)
    return xxhash.xxh64_intdigest(data, seed)


def brute_print(text):
    lanes = [0] * (2 + 16 + 128)
    for p in (text or "").split("\n"):
        lanes[0] += 1
        for i in range(8):
            h = h64(p.encode(), i)
            lanes[2 + 2 * i] += h & 0xFFFFFFFF
            lanes[3 + 2 * i] += h >> 32
        words = re.findall(rb"[^\x20\x09-\x0D]+", p.encode())
        for k in range(0, len(words), 3):
            lanes[1] += 1
            h = 42
            for w in words[k : k + 3]:
                h = xxhash.xxh64_intdigest(w, h)
            other = h64(struct.pack("<Q", h), 1)
            for j in range(32):
                lanes[18 + 2 * j] += h >> j & 1
                lanes[19 + 2 * j] += h >> (j + 32) & 1
                lanes[82 + 2 * j] += other >> j & 1
                lanes[83 + 2 * j] += other >> (j + 32) & 1
    return [x % 2**32 for x in lanes]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ([2 * v - f[1] for v in f[18:]] for f in (a, b))
    both = sum(v * v for v in x) + sum(v * v for v in y)
    return min(1.0, max(0.0, 2 * sum(v * w for v, w in zip(x, y)) / both)) if both else 0.0


def test_fingerprints_equal_brute_force(spark):
    rows = [(k, t) for k, (_, t) in enumerate([*ODD, (0, "a b c d\n\n e f\n"), (0, "\n e f\n\na b c d")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({n: F.lit(1) for n in ("fingerprint", "__p", "__k0", "__h0", "__f")})
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs, ["doc_id"]).collect()}
    assert got == {k: brute_print(t) for k, t in rows}
    assert got[len(rows) - 1] == got[len(rows) - 2]  # the same paragraphs, two of them empty, in another order
    assert sorted(fingerprints.fingerprints(docs.limit(0), ["doc_id"]).columns) == ["doc_id", "fingerprint"]
    assert fingerprints.fingerprints(docs.limit(0), ["doc_id"]).collect() == []


def test_fingerprints_do_not_depend_on_order_and_take_insertions(spark):
    r = random.Random(3)
    paragraphs = [" ".join(r.choice("abcdef") * r.randint(1, 4) for _ in range(20)) for _ in range(30)]
    shuffled = r.sample(paragraphs, 30)
    rows = [(0, "\n".join(paragraphs)), (1, "\n".join(shuffled)), (2, "\n".join(paragraphs[:10])), (3, "\n".join(paragraphs[10:]))]
    f = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    f = f.groupBy().pivot("doc_id", [0, 1, 2, 3]).agg(F.first("fingerprint"))
    row = f.select(
        (F.col("0") == F.col("1")).alias("same"),
        (fingerprints.combined(F.col("2"), F.col("3")) == F.col("0")).alias("inserted"),
        (fingerprints.without(F.col("0"), F.col("3")) == F.col("2")).alias("deleted"),
        fingerprints.likeness(F.col("0"), F.col("1")).alias("one"),
        fingerprints.likeness(F.col("0"), F.col("3")).alias("most"),
        fingerprints.likeness(F.col("2"), F.col("3")).alias("little"),
    ).first()
    assert row["same"] and row["inserted"] and row["deleted"] and row["one"] == 1.0
    assert abs(row["most"] - 0.8) < 0.2 and row["little"] < 0.3


def brute_edits(texts):
    """``texts`` in ring order: (n_chars, sha of edited, fingerprint, edited, next)."""
    out = []
    for k, t in enumerate(texts):
        following, m = texts[(k + 1) % len(texts)], len(t) // 2
        edited = t[: len(t) - m] + following[:m]
        out.append((len(t), sha(edited), *map(brute_print, (t, edited, following))))
    return out


def test_edits_equal_brute_force(spark):
    rows = [(3, "a b c\nd e f\ng"), (1, "\n\n"), (None, "x\ny"), (2, None), (5, "é\n🙂 b\nc d e f g\nh"), (4, ""), (6, "one"), (7, "two three\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({n: F.lit(1) for n in ("k", "h", "n", "t", "c", "id", "copies", "fingerprint")})
    got = {r["doc_id"]: tuple(r)[1:] for r in fingerprints.fingerprint_edits(docs).collect()}
    ring = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == dict(zip([i for i, _ in ring], brute_edits([t or "" for _, t in ring])))


def test_edits_of_repeated_rows_of_one_and_of_none(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (1, "a\nb"), (2, "c d\ne")], "doc_id long, text string")
    got = sorted(tuple(r) for r in fingerprints.fingerprint_edits(docs).collect())
    one, two = brute_edits(["a\nb", "c d\ne"])
    assert got == [(1, *one)] * 3 + [(2, *two)]
    alone = fingerprints.fingerprint_edits(docs.filter("doc_id = 2")).collect()
    assert [tuple(r)[1:] for r in alone] == brute_edits(["c d\ne"])
    assert fingerprints.fingerprint_edits(docs.limit(0)).collect() == []


@needs_tables
def test_fingerprint_query_equals_brute_force(spark):
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = dict(zip([i for i, _ in texts], brute_edits([t for _, t in texts])))
    rows = QUERIES["op13_multiset_hash"](spark, SF).collect()
    assert len(rows) == len(texts)
    digits = lambda f: "".join(f"{x:08x}" for x in f)
    for r in rows:
        n, edited_sha, own, edited, following = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, edited_sha)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (digits(own), digits(edited))
        assert r["near_edited"] == pytest.approx(brute_likeness(own, edited))
        assert r["near_next"] == pytest.approx(brute_likeness(own, following))


@needs_tables
def test_fingerprint_plan_is_native(spark):
    plan = QUERIES["op13_multiset_hash"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
