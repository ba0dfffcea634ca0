"""Small cases of every training-data operator against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyrule.llm import (
    decontam,
    langid,
    linededup,
    queries,
    sentencepiece_fst,
    sharding,
    simhash,
    substring,
    topk,
    toxicity,
    urlfilter,
)
from tallyrule.llm.common import connected_components
from tallyrule.scratch import exists

DOCS = "doc_id long, text string"
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (4, "one"),
    (5, "long " * 20_000),
    (None, "a b c d e f g h i j k l m n o p"),
    (7, "a b c d e f g h i j k l m n o p"),
    (8, "a b c d e f g h i j k l m n o p q"),
    (9, "Ünïcödé 你好 🙂 " * 30),
]


def docs_of(spark, rows):
    # extra columns whose names clash with the operators' own
    names = ("n_words", "hits", "items", "kept", "score", "ids", "fp", "shard", "__d", "__cut", "__r", "__m")
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({n: F.lit(1) for n in names})


def text_rows(seed, n, vocabulary=6):
    r = random.Random(seed)
    return [(i, " ".join(r.choice("abcdefgh"[:vocabulary]) for _ in range(r.randint(0, 60)))) for i in range(n)]


# --- connected components and SimHash -----------------------------------------------


def brute_components(prints: dict[int, int], bits: int) -> dict[int, int]:
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = list(prints)
    for x in keys:
        for y in keys:
            if x < y and (prints[x] ^ prints[y]).bit_count() <= bits:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in keys}


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = connected_components(edges).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(60)}
    assert connected_components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [16_384, 3])
def test_links_equal_brute_force(spark, hot):
    r = random.Random(5)
    prints = [r.getrandbits(64) for _ in range(40)]
    for base in prints[:10]:
        for _ in range(12):
            p = base
            for b in r.sample(range(64), r.randint(0, 5)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = connected_components(simhash.link_fingerprints(df, 4, hot_bucket=hot)).collect()
    want = brute_components({i: p & (1 << 64) - 1 for i, p in enumerate(prints)}, 4)
    members = defaultdict(set)
    for i, c in want.items():
        members[c].add(prints[i])
    found = defaultdict(set)
    for row in got:
        found[row["root"]].add(row["node"])
    assert sorted(map(sorted, found.values())) == sorted(sorted(m) for m in members.values() if len(m) > 1)


def test_fingerprint_by_definition():
    for t in ("", "One two", "A b C d e f G h " * 5, ODD[5][1], "é\u00a0x y z"):
        words = t.encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(t) & (1 << 64) - 1 == want


def test_near_duplicates_of_odd_rows(spark):
    got = simhash.near_duplicates(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert len(by[4]) == 1
    assert {c for _, c in by[None]} == {7}
    assert simhash.near_duplicates(docs_of(spark, ODD).limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b = "a b c d e f g h", "one two three four five six seven"
    rows = [(4, a)] * 3 + [(4, b), (1, a), (1, a), (None, a)] + [(None, "q w e r t z u i o")] * 3 + [(9, b), (6, None), (6, "")]
    got = simhash.drop_near_duplicates(docs_of(spark, rows), max_bits=0)
    assert got.columns == docs_of(spark, rows).columns
    by = defaultdict(list)
    for x in got.collect():
        by[x["text"] or ""].append(x["doc_id"])
    assert by == {a: [1], b: [4], "q w e r t z u i o": [None], "": [6]}


# --- lines --------------------------------------------------------------------------


def brute_lines(rows, least=20, docs=3):
    def key(x):
        k = x.strip(" \t\n\x0b\x0c\r")
        return k.encode().lower() if len(k) >= least else None

    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            held[k].append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < docs or i == max(held[key(x)])]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_lines_equal_brute_force(spark):
    r = random.Random(2)
    pool = [f"line number {i} of the common pool" for i in range(12)] + ["short", "", "  "]
    rows = [(i, "\n".join(r.choice((str.upper, str, str.title))(r.choice(pool)) + r.choice(("", " ", "\r")) for _ in range(r.randint(0, 9)))) for i in range(40)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((x["doc_id"], x["text"] or "", x["n_lines"], x["n_dropped"]) for x in got) == brute_lines(rows)


def test_runs_hold_only_what_decides(spark):
    runs = linededup.LineRuns(spark, fanout=2, buckets=2)
    for batch in ([(1, 1, 5), (1, 1, 7), (2, 2, 5)], [(1, 1, 3), (3, 3, 3)], [(2, 2, 9)]):
        runs.add(spark.createDataFrame(batch, "h1 long, h2 long, doc long"))
    assert sorted(map(tuple, runs.totals().collect())) == [(1, 1, 3, 7), (2, 2, 2, 9), (3, 3, 1, 3)]
    # Each key found its run once: without the anti-join, (1, 1) and (2, 2) would be in several,
    # and no run's row, with the notes, would count their documents.
    held = [tuple(r) for name in runs.runs() for r in runs._run(name).select("h1", "h2").collect()]
    assert sorted(held) == [(1, 1), (2, 2), (3, 3)]
    paths = list(runs.paths.values())
    assert len(paths) == 4 and all(exists(spark, p) for p in paths)
    runs.drop()
    assert not any(exists(spark, p) for p in paths)


def test_lines_of_rows_that_share_an_id(spark):
    line = "the line that documents share"
    rows = [(1, line), (1, line), (2, line), (3, "another line that they share"), (4, "another line that they share")]
    rows += [(None, "another line that they share"), (None, "another line that they share"), (5, line + "\nx")]
    kept = lambda least: sorted((r["doc_id"] or 0, r["n_dropped"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, DOCS), min_docs=least).collect())
    assert kept(3) == [(0, 1), (0, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0), (5, 0)]
    assert kept(4) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 0)]


def test_lines_of_odd_rows(spark):
    got = linededup.dedup_lines(docs_of(spark, ODD), min_chars=3).collect()
    assert len(got) == len(ODD)
    assert {(r["text"], r["n_lines"]) for r in got if r["doc_id"] in (1, 2)} == {(None, 1), ("", 1)}
    assert linededup.dedup_lines(docs_of(spark, ODD).limit(0)).count() == 0


# --- substrings ---------------------------------------------------------------------


def brute_windows(rows, size):
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, t in rows:
        w = (t or "").split()
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for j in range(size)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_substrings_equal_brute_force(spark, chunk):
    rows = text_rows(3, 60, vocabulary=3)
    got = substring.duplicate_spans(spark.createDataFrame(rows, DOCS), min_words=6, chunk_seeds=chunk).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute_windows(rows, 6)


def brute_parse(refs, owners, words, below, size):
    """Greedy factors word by word, without an index."""

    def held(at, n):
        ids = [d for t, d in zip(refs, owners, strict=True) if d < below and any(t[i : i + n] == words[at : at + n] for i in range(len(t) - n + 1))]
        return min(ids) if ids and at + n <= len(words) else None

    out, at = [], 0
    while at + size <= len(words):
        n = 0
        while held(at, n + 1) is not None:
            n += 1
        if n >= size:
            out.append((at, at + n, held(at, n)))
        end = at + max(1, n)
        for k in range(at + 1, end):
            if k + size > end and held(k, size) is not None:
                out.append((k, k + size, held(k, size)))
        at = end
    return out


def test_factors_equal_a_plain_greedy_parse():
    r = random.Random(1)
    for _ in range(400):
        letters = [b"a", b"b", b"c", b"dd", b"e"][: r.choice([1, 2, 3, 5])]
        refs = [[r.choice(letters) for _ in range(r.randint(0, 25))] for _ in range(r.randint(0, 5))]
        owners = [r.randint(0, 6) for _ in refs]
        words = [r.choice(letters) for _ in range(r.randint(0, 25))]
        below, size = r.randint(0, 7), r.randint(1, 6)
        got = substring.Reference(refs, owners).parse(words, below, size)
        assert got == brute_parse(refs, owners, words, below, size)


def test_factors_carry_a_source_that_holds_them(spark):
    rows = text_rows(5, 60, vocabulary=3)
    texts = dict(rows)
    found = 0
    for r in substring.duplicate_spans(spark.createDataFrame(rows, DOCS), min_words=6, chunk_seeds=200).collect():
        words, covered = r["text"].split(), set()
        for f in r["factors"]:
            found += 1
            assert f["source"] < r["doc_id"]
            assert f" {' '.join(words[f['from']:f['to']])} " in f" {texts[f['source']]} "
            covered.update(range(f["from"], f["to"]))
        assert covered == {k for s in r["spans"] for k in range(s["from"], s["to"])}
    assert found > 60


def test_a_hot_window_is_dealt_to_many_sources():
    doc = np.arange(300, dtype=np.int64)
    chunk = [(int(i), 0, np.array([7], np.uint64), np.array([0], np.uint64), np.array([3])) for i in doc]
    asked = pd.concat([substring._questions([c], 4) for c in chunk])
    out = substring._answers(asked, 4, fan=10)
    asks = out[out["sources"].notna()]
    sources = np.concatenate([substring._unpack(x, np.int64) for x in asks["sources"]])
    ids = substring._opened(asks)[0]
    assert sorted(ids) == list(range(1, 300)) and (sources < ids).all()
    assert np.bincount(sources).max() == 10
    assert set(substring._opened(out[out["sources"].isna()])[0]) == set(sources)


def test_substrings_want_whole_number_ids(spark):
    with pytest.raises(TypeError):
        substring.duplicate_spans(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_substrings_of_odd_rows(spark):
    got = substring.duplicate_spans(docs_of(spark, ODD)).collect()
    removed = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in got}
    assert removed[(None, 16)] == 0 and removed[(7, 16)] == 0 and removed[(8, 17)] == 16
    assert removed[(5, 20_000)] == 0 and removed[(1, 0)] == 0
    assert substring.duplicate_spans(docs_of(spark, ODD).limit(0)).count() == 0


def test_a_hot_seed_reaches_its_block_once_a_chunk():
    rows = [(i, "w " * 50 + "a b c d e f g") for i in range(30)]
    chunk = []
    for i, t in rows:
        h, g = substring.seeds(t.encode().split(), 6)
        at = np.sort(np.unique(h, return_index=True)[1])
        chunk.append((i, 0, h[at], g[at], at))
    out = substring._questions(chunk, 4)
    asked = out[out["seeds"].notna()]
    assert sum(substring._seeds_of(x).size for x in asked["seeds"]) == len(set().union(*(set(x[2].tolist()) for x in chunk)))
    settled = out[out["seeds"].isna()]
    asks = settled[settled["sources"].notna()]
    assert set(substring._opened(asks)[0]) == set(range(1, 30))
    assert set(substring._opened(settled[settled["sources"].isna()])[0]) == {0}


def test_repeated_windows_of_one_document(spark):
    rows = [(i, "w " * (20 + i) + "x " * i + "w " * 9) for i in range(6)] + [(10, "w " * 3000)]
    got = substring.duplicate_spans(spark.createDataFrame(rows, DOCS), min_words=6, chunk_seeds=3).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute_windows(rows, 6)


# --- decontamination ----------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_hits(text, items, size):
    w, hit, found = WORD.findall(lowered(text)), set(), set()
    for name, t in items:
        v = WORD.findall(lowered(t))
        n = min(size, len(v))
        grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
        for k in range(len(w) - n + 1) if n else ():
            if tuple(w[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [decontam.MAX_BLOCK_BYTES, 150])
def test_contamination_equals_brute_force(spark, block):
    rows = text_rows(7, 50, vocabulary=4) + [(90, "A, b-C d"), (91, None), (92, "É é")]
    items = [(1, "a b c a b c"), (2, "a b"), (3, ""), (4, None), (5, "d d d d d d d a"), (6, "É"), (7, "c"), (7, "zz")]
    got = decontam.find_contamination(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string"), window=5, max_bytes=block
    ).collect()
    texts = dict(rows)
    for r in got:
        n_hit = sum(s["to"] - s["from"] for s in r["hits"])
        assert (r["n_words"], n_hit, r["items"]) == brute_hits(texts[r["doc_id"]], items, 5), r["doc_id"]


def test_contamination_of_odd_rows_and_removal(spark):
    items = spark.createDataFrame([(1, "b c d e"), (None, "你好")], "item_id long, text string")
    df = docs_of(spark, ODD)
    assert decontam.find_contamination(df, items).count() == len(ODD)
    kept = decontam.remove_contamination(df, items)
    assert kept.columns == df.columns
    assert {r["text"] for r in kept.collect() if r["doc_id"] == 7} == {"a  f g h i j k l m n o p"}
    assert decontam.find_contamination(df, items.limit(0)).filter("size(hits) > 0").count() == 0
    assert decontam.find_contamination(df.limit(0), items).count() == 0


def test_documents_go_by_coverage(spark):
    item = "a b c d e f g h i"
    rows = [(1, "x " + item), (2, "x y " + item), (3, item), (4, "x y z")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(rows, DOCS)

    def left(**options):
        return {r["doc_id"]: r["text"] for r in decontam.remove_contamination(docs, items, **options).collect()}

    assert left() == {2: "x y ", 4: "x y z"}
    assert left(coverage=0.8) == {4: "x y z"}
    assert left(coverage=1.0) == {1: "x ", 2: "x y ", 4: "x y z"}


@pytest.mark.parametrize("slice_bits", [decontam.SLICE_BITS, 8])
def test_contamination_keeps_items_off_the_driver(spark, monkeypatch, slice_bits):
    def refuse(*_):
        raise AssertionError("an automaton on the driver")

    monkeypatch.setattr(decontam.ItemAutomaton, "__init__", refuse)
    monkeypatch.setattr(decontam, "SLICE_BITS", slice_bits)
    monkeypatch.setattr(decontam, "MAX_FILTER_BITS", 8 * slice_bits)  # at 64 bits nearly every window passes
    monkeypatch.setattr(decontam, "GROUP_BYTES", 60)  # blocks are built for parts of their stretches
    items = [(i, t) for i, t in text_rows(11, 60, vocabulary=5)]
    items += [(100 + i, "A b! c, d e f a") for i in range(30)] + [(None, "a b c d e f a"), (200, "b b")]
    rows = text_rows(12, 80, vocabulary=6) + [(1000 + i, "x a b c d e f a x") for i in range(40)]
    found = decontam.find_contamination(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string"), window=6, max_bytes=100
    )
    texts = dict(rows)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        n_hit = sum(s["to"] - s["from"] for s in r["hits"])
        assert (r["n_words"], n_hit, r["items"]) == brute_hits(texts[r["doc_id"]], items, 6), r["doc_id"]
        assert all(a["to"] < b["from"] for a, b in zip(r["hits"], r["hits"][1:]))


# --- URLs ---------------------------------------------------------------------------


def test_urls(spark):
    rules = spark.createDataFrame([*queries.URL_RULES, ("", "/", "block"), (None, "/", "block")], urlfilter.RULE_SCHEMA)
    rows = [
        ("http://a.example.NET/en/1?x", "example.net/en/", "allow"),
        ("https://example.net/en", "net/", "block"),
        ("https://example.net", None, "allow"),
        ("x://my.org/fr/a#b", "org/fr/", "allow"),
        ("x://notexample.com/de/", None, "allow"),
        ("x://example.com/de/?q", "example.com/de/", "block"),
        ("example.net/en/", None, "allow"),
        (None, None, "allow"),
        ("", None, "allow"),
        ("x://net/" + "p" * 50_000, "net/", "block"),
    ]
    df = spark.createDataFrame([(k % 3, u) for k, (u, _, _) in enumerate(rows)], "page_id long, url string")
    df = df.withColumns({"rule": F.lit("old"), "h": F.lit(1), "p": F.lit(2), "block": F.lit(3)})
    for most in (1000, 0):
        got = urlfilter.filter_urls(df, rules, broadcast_rows=most).collect()
        assert {(r["url"], r["rule"], r["verdict"]) for r in got} == set(rows) and len(got) == len(rows)
    assert urlfilter.filter_urls(df, rules.limit(0)).filter("verdict = 'allow' and rule is null").count() == len(rows)
    assert urlfilter.filter_urls(df.limit(0), rules).count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(500).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"))
    pages = keys.select(F.concat(F.lit("http://"), "host", "path").alias("url"))
    got = urlfilter.filter_urls(pages, keys.withColumn("verdict", F.lit("block")))
    assert got.filter("verdict = 'block'").count() == 500


# --- sharding -----------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 100, 1009])
def test_permutation_is_one(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 3)).collect()]
    assert sorted(got) == list(range(n))
    if n > 50:
        assert got != list(range(n))


def test_shards_are_gapless_and_even(spark):
    rows = spark.createDataFrame([(i % 7 if i % 5 else None, i % 3) for i in range(101)], "k long, v long")
    got = sharding.shard_rows(rows, ["k"], 8, 1).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {len(s) for s in by.values()} <= {12, 13} and len(got) == 101
    again = sharding.shard_rows(rows.repartition(5), ["k"], 8, 1).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.shard_rows(rows.limit(0), ["k"], 8).count() == 0


# --- top-k --------------------------------------------------------------------------


def test_top_products_equal_brute_force(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(300, 6)) * r.choice([0.1, 1, 5], size=(300, 1))
    v[50:60] = v[40]
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)]
    bad = [(500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (None, [1.0] * 6), (520, []), (521, []), (540, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("dim", F.lit(0))
    got = topk.top_products(df, F.col("vec_id") % 20 == 0, k=5, bucket=32, query_block=4).collect()
    ints = np.floor(64 * v).astype(int)
    want = set()
    for q in range(0, 300, 20):
        s = sorted(((-int(ints[q] @ ints[c]), c) for c in range(300) if c != q))[:5]
        want |= {(q, k + 1, c, -x) for k, (x, c) in enumerate(s)}
    want.add((520, 1, 521, 0))
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    assert topk.top_products(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_blocks_and_mixed_dimensions(spark):
    rows = [(0, [1.0, 2.0])] * 10 + [(i, [float(i), 1.0]) for i in range(1, 9)]
    rows += [(20, [1.0]), (20, [1.0, 0.0]), (21, [3.0]), (22, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_products(df, F.col("vec_id") % 20 == 0, k=3, scale=1, bucket=4, query_block=4).collect()
    want = []
    for i, v in rows:
        if i % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i and len(v) == len(w))[:3]
            want += [(i, k + 1, j, int(-x)) for k, (x, j) in enumerate(s)]
    assert sorted(tuple(x) for x in got) == sorted(want)


def test_coordinate_pruning_loses_nothing():
    r = np.random.default_rng(2)
    q = r.integers(-50, 50, 8)
    c = np.concatenate([q + r.integers(-20, 20, (200, 8)), r.integers(-60, 60, (800, 8))])
    c = c[np.argsort(-(c**2).sum(axis=1))]
    norms = np.sqrt((c.astype(float) ** 2).sum(axis=1))
    s = c @ q
    for bound in np.quantile(s[s > 0], [0.1, 0.5, 0.9, 0.99, 1.0]):
        kept = topk.prune(q, float(bound), c, norms)
        assert set(np.flatnonzero(s >= bound)) <= set(range(len(c)) if kept is None else kept)


# --- SentencePiece ------------------------------------------------------------------


def test_encoding_equals_the_library(spark):
    sp = pytest.importorskip("sentencepiece")
    path = sentencepiece_fst.tokenizer_path()
    lib = sp.SentencePieceProcessor(model_file=path)
    model = sentencepiece_fst.load_model(path)
    r = random.Random(1)
    p = sentencepiece_fst.Processor(model)
    texts = [t for _, t in ODD if t is not None] + ["  two  spaces\n\tx ", "\x00", " " * 40, "a▁b", "....----====", "don't"]
    texts += ["".join(r.choice(p.pieces[259:]) for _ in range(r.randint(1, 8))).replace("▁", " ") for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], DOCS).withColumn("IDS", F.lit(0))
    got = sentencepiece_fst.round_trip(df, model).collect()
    for row in got:
        t = row["text"] or ""
        assert row["ids"] == lib.encode(t) and row["n_ids"] == len(row["ids"])
        assert row["exact"] == (row["text"] is not None and "▁" not in t)
    back = sentencepiece_fst.decode_ids(sentencepiece_fst.encode_texts(df.drop("IDS"), model), model).collect()
    assert all(row["decoded"] == lib.decode(row["ids"]) for row in back)
    assert sentencepiece_fst.round_trip(df.limit(0), model).count() == 0


def test_known_words_are_not_cut_again(monkeypatch):
    """Whole words are looked up; the stretch pattern runs on words not seen before only."""
    p = sentencepiece_fst.Processor(sentencepiece_fst.load_model(sentencepiece_fst.tokenizer_path()))
    text = "It's nothing. As  said,\n\n- as said:  nothing.  "
    want = p.encode(text).tolist()
    monkeypatch.setattr(p, "stretch", None)
    assert p.encode(text).tolist() == want and len(p.encode("as nothing. It's")) > 0
    with pytest.raises(AttributeError):
        p.encode("never")


@pytest.mark.parametrize("limit", [None, 2])
def test_words_and_their_spaces_equal_the_library(monkeypatch, limit):
    sp = pytest.importorskip("sentencepiece")
    path = sentencepiece_fst.tokenizer_path()
    lib = sp.SentencePieceProcessor(model_file=path)
    if limit:
        for name in ("MEMO", "MEMO_CHARS", "PARTS", "PAIRS", "HEADS"):
            monkeypatch.setattr(sentencepiece_fst, name, limit)
    p = sentencepiece_fst.Processor(sentencepiece_fst.load_model(path))
    r = random.Random(7)
    bits = [" ", "  ", "▁", "\n", "\t", "the", "The", "don't", "...", "%%%", "é", "日本", "\U0001f600", "\x00", "_", "x" * 60]
    texts = ["", " ", "  ", "▁", " a", "a ", "a  ", "  a", "a▁ b", "a ▁b", "\u00a0a", " ▁ "]
    texts += ["".join(r.choices(bits, k=r.randint(1, 12))) for _ in range(400)]
    ids = [p.encode(t).tolist() for t in texts]
    assert ids == [lib.encode(t) for t in texts]
    byte = p.bytes
    ids += [[byte[0xE2]], [byte[0x96], byte[0x81]], [], [byte[0xE2], byte[0x96], byte[0x81]], [0, 1, 2], []]
    ends = np.cumsum([0, *map(len, ids)])
    back = list(p.decode_lists(pa.array([k for x in ids for k in x], pa.int32()), ends))
    assert back == [p.decode(x) for x in ids]
    assert back[: len(texts)] == [lib.decode(x) for x in ids[: len(texts)]]
    assert list(p.decode_lists(pa.array([], pa.int32()), np.array([0, 0]))) == [""]


# --- classifiers --------------------------------------------------------------------


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def toxicity_accuracy(spark):
    """On held-out rows of the small dense case; checks what holds at any accuracy."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        rows.append((i, " ".join(r.choices(words, k=60) + (["vile", "awful"] if toxic else []))))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    labels += [(0, 1), (None, 1), (5, None)]
    docs = spark.createDataFrame(rows + [(-1, None), (-2, ""), (None, "vile")], DOCS).withColumn("score", F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_documents(docs, toxicity.train(docs, marks)).collect()
    held = [x for x in got if x["doc_id"] is not None and x["doc_id"] >= 0 and fold(x["doc_id"]) == 2]
    assert all(0 <= x["score"] <= 1 for x in got) and len(got) == len(rows) + 3
    none = toxicity.train(docs, marks.limit(0))
    assert toxicity.score_documents(docs, none).filter("predicted = 1").count() == 0
    assert toxicity.drop_toxic(docs.limit(0), marks).count() == 0
    return np.mean([x["predicted"] == (x["doc_id"] % 8 == 0) for x in held])


def test_toxicity_on_held_out_rows(spark):
    assert toxicity_accuracy(spark) > 0.97


def test_toxicity_risk_equals_its_definition():
    r = random.Random(5)
    rows = [np.array(sorted(r.sample(range(40), r.randint(0, 9))), dtype=np.int64) for _ in range(60)]
    weights = [0.0] * (1 << toxicity.BITS)
    weights[:40] = [r.uniform(-1, 1) for _ in range(40)]
    for bias, prior in ((-1.0, 0.2), (3.0, 0.9)):
        model = toxicity.Model(weights, bias)

        def loss(row, sign):
            return float(np.log(1 + np.exp(-sign * (bias + sum(weights[k] for k in row)))))

        one = sum(loss(x, 1) for x in rows[:20]) / 20
        zero = sum(loss(x, -1) for x in rows[:20]) / 20
        unknown = sum(loss(x, -1) for x in rows[20:]) / 40
        got, _ = toxicity.risk(model, rows[:20], rows[20:], prior)
        assert got == pytest.approx(prior * one + max(0, unknown - prior * zero))


def test_toxicity_learning_lowers_the_risk_of_rows_not_learnt_from():
    r = random.Random(6)

    def row(toxic):
        return np.array(sorted({*r.sample(range(20, 200), 15), *([r.randrange(5)] if toxic else [])}), dtype=np.int64)

    positive, unlabelled = [row(True) for _ in range(200)], [row(r.random() < 0.2) for _ in range(600)]
    model = toxicity.fit(positive[:150], unlabelled[:450], 0.2)
    blank = toxicity.Model([0.0] * (1 << toxicity.BITS), float(np.log(0.2 / 0.8)))
    learnt, plain = (toxicity.risk(m, positive[150:], unlabelled[450:], 0.2)[0] for m in (model, blank))
    assert learnt < plain
    assert np.argsort(model.weights)[-5:].max() < 5  # the five marks weigh most


def plain_grams(text):
    """Buckets of the byte n-grams with their counts, one at a time."""
    b = b" " + b" ".join(text.lower().encode().split()) + b" "
    found = Counter()
    for n in langid.ORDERS:
        for k in range(len(b) - n + 1):
            code = int.from_bytes(bytes([n]) + b[k : k + n], "big")
            found[(code * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - langid.BITS)] += 1
    return found


def plain_mixture(counts, models, penalty=1.0):
    """Greedy choice of languages and plain EM; ``models`` are languages' bucket probabilities."""
    total = sum(counts.values())

    def value(share):
        return sum(c * math.log(sum(p * models[x][g] for x, p in share.items())) for g, c in counts.items())

    def em(share):
        for _ in range(langid.EM_STEPS):
            new = dict.fromkeys(share, 0.0)
            for g, c in counts.items():
                whole = sum(p * models[x][g] for x, p in share.items())
                for x, p in share.items():
                    new[x] += c * p * models[x][g] / whole / total
            step, share = max(abs(new[x] - share[x]) for x in share), new
            if step < 1e-4:
                break
        return share

    share = max(({x: 1.0} for x in sorted(models)), key=value)
    cost = penalty * math.log(max(2.0, total / len(langid.ORDERS))) * len(langid.ORDERS)
    while len(share) < len(models):
        slopes = {
            x: sum(c * models[x][g] / sum(p * models[y][g] for y, p in share.items()) for g, c in counts.items()) - total
            for x in sorted(models)
            if x not in share
        }
        nxt = max(slopes, key=slopes.get)
        trial = em({**{x: 0.9 * p for x, p in share.items()}, nxt: 0.1})
        if slopes[nxt] <= cost or value(trial) - value(share) <= cost:
            break
        share = trial
    return share


def test_mixtures_equal_plain_expectation_maximisation(spark):
    r = random.Random(8)
    tongues = {x: [f"{x}{a}{b}" for a in "abcde" for b in "lmn"] for x in ("qu", "xi", "za")}
    rows = [(i, " ".join(r.choices(tongues[x], k=30)), x) for i, x in enumerate(r.choices(sorted(tongues), k=90))]
    rows += [(100 + i, " ".join(sum((r.choices(tongues[x], k=k) for x, k in zip(sorted(tongues), ks)), [])), None)
             for i, ks in enumerate([(30, 30, 0), (5, 40, 1), (20, 20, 20), (0, 0, 50), (3, 0, 2)])]
    rows += [(200, None, "qu"), (201, "", "xi"), (202, "12 3", None), (0, rows[0][1], rows[0][2]), (203, "Quam " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        langid.train(docs, max_languages=2)
    got = {x["doc_id"]: x for x in langid.identify(docs, langid.train(docs, max_languages=3)).collect()}
    seen = {x: Counter() for x in tongues}
    for i, t, x in rows:
        if x is not None and t is not None and fold(i) != 2:
            seen[x].update(plain_grams(t))
    size = 1 << langid.BITS
    models = {}
    for x, c in seen.items():
        whole = sum(c.values()) + langid.SMOOTHING * size
        models[x] = {g: (c[g] + langid.SMOOTHING) / whole for g in range(size)}
    for i, t, _ in rows:
        if t is None or not any(map(str.isalpha, t)):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        want = plain_mixture(plain_grams(t), models)
        assert set(got[i]["langs"]) == set(want)
        assert dict(zip(got[i]["langs"], got[i]["shares"])) == pytest.approx(want, abs=1e-6)
        assert got[i]["lang_pred"] == max(sorted(want), key=want.get) and got[i]["score"] == max(got[i]["shares"])


def test_any_number_of_languages(spark):
    rows = [(i, f"word{i} tongue{i}", f"l{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.train(docs, max_languages=100)
    known = sum(fold(i) != 2 for i in range(700))
    assert len(langid.train(docs, max_languages=700).languages) == known


def test_language_on_held_out_rows_and_mixtures(spark):
    r = random.Random(6)
    words = {"x": ["kala", "poro", "tuuli", "meri"], "y": ["brzo", "crkva", "vrh", "smrt"], "z": ["the", "wind", "sea", "fish"]}
    rows = [(i, " ".join(r.choices(words[k], k=30)), k) for i in range(300) for k in [r.choice("xyz")]]
    odd = [(-1, None, "x"), (-2, "", "y"), (-3, "12 34", None), (None, "kala poro", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = langid.identify(docs.withColumn("langs", F.lit(0)), model).collect()
    for x in got:
        if x["doc_id"] is not None and x["doc_id"] < 0:
            assert (x["lang_pred"], x["score"]) == ("und", 0.0)
        elif x["doc_id"] is not None and fold(x["doc_id"]) == 2:
            assert x["lang_pred"] == x["lang"]
    mixed = " ".join(r.choices(words["x"], k=60) + r.choices(words["z"], k=30))
    name, share, names, shares = model.predict(mixed)
    assert name == "x" and set(names) == {"x", "z"} and abs(sum(shares) - 1) < 1e-6 and 0.5 < share < 0.8
    empty = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}


def test_digest_of_nothing():
    assert decontam.items_digest([]) == hashlib.sha256(b"").hexdigest()


# --- sharding against plain Python ------------------------------------------------------


def plain_place(number, n, seed):
    """The Feistel permutation, step by step."""
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(number, b)
        for k in range(1, sharding.ROUNDS + 1):
            half = right if k % 2 else left
            v = int(hashlib.md5(f"{seed}:{k}:{half}".encode()).hexdigest()[:13], 16)
            if k % 2:
                left = (left + v) % a
            else:
                right = (right + v) % b
        number = left * b + right
        if number < n:
            return number


def test_shards_equal_plain_feistel(spark):
    r = random.Random(4)
    ids = r.sample(range(10_000), 333)
    rows = spark.createDataFrame([(i, f"t{i % 3}") for i in ids], "doc_id long, t string").repartition(5)
    rows = rows.withColumns({c: F.lit(1) for c in ("__n", "__copy", "__at", "__part", "__place", "row_number")})
    got = sharding.shard_rows(rows, ["doc_id"], 16, 17).collect()
    want = {i: plain_place(k, len(ids), 17) for k, i in enumerate(sorted(ids))}
    assert sorted(want.values()) == list(range(len(ids)))
    assert {x["doc_id"]: (x["shard"], x["slot"]) for x in got} == {i: (p % 16, p // 16) for i, p in want.items()}


def test_shards_of_many_equal_rows(spark):
    rows = spark.range(9000).select(F.lit(7).alias("doc_id"))
    got = sharding.shard_rows(rows, ["doc_id"], 4).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert sorted((x["n"], x["m"]) for x in got) == [(2250, 2249)] * 4
