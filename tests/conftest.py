from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tallyrule.scratch import checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tallyrule-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(s) is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyrule-tests-"))
    yield s


@pytest.fixture
def scratch(spark):
    """A fresh path under the session's checkpoint folder (never reused)."""
    from tallyrule.scratch import scratch_path

    counter = iter(range(1_000_000))
    return lambda name="t": scratch_path(spark, f"{name}{next(counter)}")


def local_path(p: str) -> str:
    return p[len("file:"):] if p.startswith("file:") else p


def write_text(path: str, name: str, lines: list[str], newline: str = "\n") -> str:
    """Write a small hand-made text fixture file under ``path``."""
    d = local_path(path)
    os.makedirs(d, exist_ok=True)
    full = os.path.join(d, name)
    with open(full, "w", encoding="utf-8", newline="") as f:
        f.write(newline.join(lines) + newline)
    return full
