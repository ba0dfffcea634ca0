"""The registered training-data queries on the smallest tables."""

from __future__ import annotations

import os
import zlib

import pytest
import xxhash
from oracle import compare
from test_llm_small import WORD, brute_components, brute_lines, fold, lowered

import corpus_pipeline
from tallyrule.llm import sentencepiece_fst
from tallyrule.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], SF)
    assert ok, msg


def test_languages_of_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op1_language_mixture"](spark, SF).filter("held_out").collect()
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.9 * len(rows) > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables not present")
def test_toxic_held_out_documents_are_found(spark):
    """The smaller tables have 14 held-out toxic documents or fewer."""
    sf = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_toxicity_nnpu"](spark, sf).collect() if r["held_out"] and marks.get(r["doc_id"]) is not None]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and fold(r["doc_id"]) == 2 for r in rows)
    toxic = [r["predicted"] for r in rows if marks[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in rows if marks[r["doc_id"]] == 0]
    assert len(toxic) >= 100 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)


def test_shards_are_reproducible(spark):
    rows = QUERIES["op8_feistel"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert sorted(rows) == sorted(QUERIES["op8_feistel"](spark, SF).collect())


def brute_print(text):
    words = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_cut(text, grams, coverage=0.9):
    """The text without its windows, or ``None`` if they are too much of it; ``grams`` by length."""
    places = [m.span() for m in WORD.finditer(lowered(text))]
    w = WORD.findall(lowered(text))
    hit = sorted({k + j for n, g in grams.items() for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in g for j in range(n)})
    if hit and len(hit) >= coverage * len(w):
        return None
    out, at = [], 0
    for k in hit:
        if k - 1 not in hit:
            out.append(text[at : places[k][0]])
        at = places[k][1]
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    toxic = {r["doc_id"] for r in QUERIES["op5_toxicity_nnpu"](spark, SF).filter("predicted = 1").collect()}
    lines = brute_lines([(i, r["text"]) for i, r in docs.items() if i not in toxic])
    texts = {i: t for i, t, _, _ in lines}
    roots = brute_components({i: brute_print(t) for i, t in texts.items()}, 4)
    grams = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        v = WORD.findall(lowered(r["text"]))
        n = min(10, len(v))
        if n:
            grams.setdefault(n, set()).update(tuple(v[k : k + n]) for k in range(len(v) - n + 1))
    cut = {i: brute_cut(t, grams) for i, t in texts.items() if roots[i] == i}
    kept = spark.createDataFrame([(i, t) for i, t in cut.items() if t is not None], "doc_id long, text string")
    model = sentencepiece_fst.load_model(sentencepiece_fst.tokenizer_path())
    coded = sentencepiece_fst.round_trip(kept, model).select("doc_id", "ids", "n_ids", "exact").collect()
    want = [(r["doc_id"], docs[r["doc_id"]]["lang"], docs[r["doc_id"]]["source"], *r[1:]) for r in coded]
    got = [tuple(r) for r in QUERIES["pipeline"](spark, SF).collect()]
    assert len(got) > 0 and sorted(got) == sorted(want)


def test_toxicity_of_held_out_documents(spark):
    found = QUERIES["op5_toxicity_nnpu"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (fold(r["doc_id"]) == 2) for r in rows)


def test_components_equal_brute_force(spark):
    prints = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = r["text"].encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        prints[r["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    want = brute_components(prints, 4)
    got = QUERIES["op10_simhash_blocks"](spark, SF).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {
        i: (p, want[i]) for i, p in prints.items()
    }


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name
        before = docs.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(rows) == before and all(r["exact"] for r in rows)


@pytest.mark.parametrize("rows", [14, 0])
def test_pipeline_of_odd_rows(spark, scratch, rows):
    clean = [f"{w} words that nobody repeats are in text {w} and in no other one {w}" for w in ("red", "blue")]
    odd = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "long " * 20_000), (None, clean[0]), (7, clean[1])]
    odd += [(i, f"shared line of more than twenty letters\n{i} own {i * i} things {i + 70} said {i}") for i in range(10, 16)]
    path = scratch("odd")
    names = "doc_id long, text string, lang string, source string, n_chars long, hits int, __d int"
    table = [(i, t, "en", "web", len(t or ""), 1, 2) for i, t in odd[:rows]]
    spark.createDataFrame(table, names).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, None), (None, 1), (5, 0)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [("a", None), ("b", ""), ("c", "not to be found"), ("c", "not to be found")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = corpus_pipeline.run(spark, path).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    found = {r["doc_id"]: r for r in got}
    assert len(found) == len(got)
    assert set(found) == ({1, 4, 5, None, 7, *range(10, 16)} if rows else set())
    if rows:
        assert found[1]["n_ids"] == 0 and not found[1]["exact"] and all(r["exact"] for r in got if r["doc_id"] != 1)
        assert found[15]["n_ids"] > found[14]["n_ids"] + 5
