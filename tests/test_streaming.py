from __future__ import annotations

from collections import Counter

from conftest import write_text
from merchants import GOLDEN

from tallyrule.plans.schemas import MERCHANT_SCHEMA
from tallyrule.sources import read_partitioned
from tallyrule.streaming import stream_clusters


def as_line(row):
    return "\t".join("" if v is None else v for v in row)


def test_stream_labels_new_files_once(spark, scratch):
    src, out, ckpt = scratch("src"), scratch("out"), scratch("ckpt")
    rows = [(r, lab) for r, lab in GOLDEN if None not in r]
    first, second = rows[:20], rows[20:]
    write_text(src, "a.tsv", ["HEADER", "skip\tme", *(as_line(r) for r, _ in first), "skip\tme"])
    q = stream_clusters(spark, src, out, drop_row=("skip\tme",), checkpoint=ckpt)
    q.awaitTermination(120)
    assert q.exception() is None
    assert read_partitioned(spark, out, MERCHANT_SCHEMA).count() == len(first)

    # A second run with the same checkpoint picks up only the new file.
    write_text(src, "b.tsv", ["HEADER", *(as_line(r) for r, _ in second)])
    q = stream_clusters(spark, src, out, drop_row=("skip\tme",), checkpoint=ckpt)
    q.awaitTermination(120)
    back = read_partitioned(spark, out, MERCHANT_SCHEMA)
    assert Counter(r["brands_part"] for r in back.collect()) == Counter(lab for _, lab in rows)


def test_stream_one_file_per_batch_without_a_dropped_row(spark, scratch):
    src, out = scratch("src"), scratch("out")
    rows = [(r, lab) for r, lab in GOLDEN if None not in r]
    thirds = [rows[i::3] for i in range(3)]
    for i, part in enumerate(thirds):
        write_text(src, f"{i}.tsv", ["HEADER"] + [as_line(r) for r, _ in part])
    q = stream_clusters(spark, src, out, checkpoint=scratch("ckpt"), max_files_per_trigger=1)
    q.awaitTermination(180)
    assert q.exception() is None
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3
    back = read_partitioned(spark, out, MERCHANT_SCHEMA)
    assert Counter(r["brands_part"] for r in back.collect()) == Counter(lab for _, lab in rows)
