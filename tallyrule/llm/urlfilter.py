"""URL filter: blocked Bloom filter in front of an exact join.

Listed entries are canonical ``(host, path)`` pairs. A URL is looked up under
every host suffix of its host and every prefix of its path whose length some
listed path has. Lookups that the Bloom filter rules out end there; possible
hits go to an exact join on host and path, which removes the false positives.
Everything is DataFrame expressions, without Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 8  # 64-bit words in a block: 512 bits, one cache line
PROBES = 6
KEYS_PER_BLOCK = 40  # about 12.8 bits a key

RULE_SCHEMA = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks))


def _bits(host: Column, path: Column) -> list[Column]:
    """Positions 0 to 511 of a key's probes, cut from a second hash."""
    h = F.xxhash64(F.lit(1), host, path)
    return [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(WORDS * 64 - 1)) for i in range(PROBES)]


def _masks(host: Column, path: Column) -> list[Column]:
    """The key's bits as one 64-bit mask for each word of its block."""
    pos = _bits(host, path)
    out = []
    for w in range(WORDS):
        m = F.lit(0).cast("long")
        for p in pos:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
            m = m.bitwiseOR(F.when(F.shiftright(p, 6) == w, bit).otherwise(F.lit(0).cast("long")))
        out.append(m)
    return out


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0..w7)``: the filter of the listed keys; one row per block in use."""
    rows = listed.select(
        _block(F.col("host"), F.col("path"), blocks).alias("block"),
        *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("host"), F.col("path")))],
    )
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` is ``(host, path, verdict)``. A rule fits its host and all its
    subdomains if the URL's path starts with the rule's path. The longest rule
    (host and path together, then host) wins; of equal rules the smaller
    verdict. Without a rule the verdict is ``default`` and ``rule`` is null.

    Null URLs and URLs without ``://`` have an empty host and path, which no
    rule can fit. Rules with a null field or an empty host are ignored.
    Repeated rows each get their answer; columns of ``pages`` that have one of
    the four names are replaced. An empty rule list gives ``default`` to all.

    The rule table and the filter are broadcast only if the rules number at
    most ``broadcast_rows``, which is counted first; beyond it both are
    shuffled joins.
    """
    rules = rules.select(*(F.col(c).cast("string") for c in ("host", "path", "verdict"))).filter(
        "host is not null and path is not null and verdict is not null and host != ''"
    )
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    n = rules.count()
    # Bounded by the longest listed path, whatever the number of rules.
    lengths = sorted(r[0] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    small = n <= broadcast_rows
    hint = F.broadcast if small else (lambda df: df)
    blocks = max(1, -(-n // KEYS_PER_BLOCK))

    judged = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))}).drop("rule", "verdict")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda k: k <= F.length("path")),
        lambda k: F.substring(F.col("path"), F.lit(1), k),
    )
    lookups = (
        judged.select("host", "path")
        .filter("host != ''")
        .distinct()
        .select("host", "path", F.explode(suffixes).alias("h"), prefixes.alias("ps"))
        .select("host", "path", "h", F.explode("ps").alias("p"))
    )
    masks = _masks(F.col("h"), F.col("p"))
    bloom = hint(bloom_blocks(rules, blocks))
    possible = lookups.withColumn("block", _block(F.col("h"), F.col("p"), blocks)).join(bloom, "block")
    for i, m in enumerate(masks):
        possible = possible.filter(F.col(f"w{i}").bitwiseAND(m) == m)
    exact = hint(rules.select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v")))
    best = (
        possible.select("host", "path", "h", "p")
        .join(exact, ["h", "p"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct((F.length("h") + F.length("p")).alias("n"), F.length("h").alias("k"), "h", "p", "v")
            ).alias("best")
        )
        .select("host", "path", F.concat("best.h", "best.p").alias("rule"), F.col("best.v").alias("verdict"))
    )
    return judged.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
