"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are sorted by length and packed into buckets. A query keeps a lower
bound on its k-th best product, first from the bucket of the longest vectors,
then from every bucket that its task has read. For another bucket that bound, divided by the lengths of the query and of the
bucket's longest vector, is the cosine a candidate must reach: over one, the
bucket is skipped; if high, candidates are pruned by the query's largest
coordinates; if low, by length alone. What is left is verified by exact
integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrule.llm.common import ship, staged

BUCKET = 2_048  # candidates in a bucket
PACKED = 8  # buckets packed by one task
HELD_BLOCKS = 32  # query blocks whose best products a task keeps at once
QUERY_BLOCK = 512
FOCUS = 4  # coordinates looked at by coordinate pruning
COORDINATE_COSINE = 0.6  # local thresholds from here on prune by coordinates
SLACK = 1e-9  # relative; pruning never decides on rounding


def scaled(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    return F.coalesce(
        F.forall(
            vector,
            lambda x: F.coalesce(
                ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)
            ),
        ),
        F.lit(False),
    )


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``q`` with all of ``c``, saturating at the range of a long."""
    if not q.shape[1] or not q.size or not c.size:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    most = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(c.astype(np.float64)).max()) * q.shape[1]
    if most < 2**53:  # every partial sum is exact in a double
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    wide = q.astype(object) @ c.astype(object).T
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if scores.size > k:
        floor = np.partition(scores, scores.size - k)[scores.size - k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(scores.size)
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def prune(q: np.ndarray, bound: float, c: np.ndarray, norms: np.ndarray) -> np.ndarray | None:
    """Places in a bucket (longest first) whose product with ``q`` can reach ``bound``; ``None`` for all."""
    if bound <= 0 or not norms.size:
        return None
    length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
    longest = float(norms[0])
    if length * longest < bound * (1 - SLACK):
        return np.empty(0, dtype=np.int64)
    cosine = min(1.0, bound * (1 - SLACK) / (length * longest))
    # Length: the product is at most the product of the lengths.
    n = int(np.searchsorted(-norms, -bound * (1 - SLACK) / length, side="right"))
    if cosine < COORDINATE_COSINE or n == 0:
        return np.arange(n)
    # Coordinates: a unit vector within that cosine of the query's has each
    # coordinate within this interval around the query's own.
    u = q / length
    focus = np.argsort(-np.abs(u))[:FOCUS]
    unit = c[:n][:, focus] / np.maximum(norms[:n, None], 1e-300)
    half = np.sqrt(np.maximum(0.0, (1 - cosine**2) * (1 - u[focus] ** 2))) + 1e-9
    middle = u[focus] * cosine
    # Beyond the query's own coordinate the interval runs to the pole of the cap.
    low = np.where(u[focus] <= -cosine, -np.inf, middle - half)
    high = np.where(u[focus] >= cosine, np.inf, middle + half)
    return np.flatnonzero(((unit >= low) & (unit <= high)).all(axis=1))


def _blob(v: np.ndarray) -> bytes:
    """The numbers in the narrowest signed type that holds them all."""
    if not v.size:
        return b""
    low, high = int(v.min()), int(v.max())
    return v.astype(np.result_type(np.min_scalar_type(min(low, -1)), np.min_scalar_type(min(-1, -high - 1)))).tobytes()


def _matrix(blob: bytes, n: int, dim: int) -> np.ndarray:
    """``n`` vectors of a blob, in the type they were stored in."""
    if not n or not dim:
        return np.zeros((n, dim), dtype=np.int64)
    return np.frombuffer(blob, dtype=f"i{len(blob) // (n * dim)}").reshape(n, dim)


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows ``(dim, id, v)`` of a partition, in their order, as blocks of at most ``size`` of one ``dim``."""

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in parts:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            while len(rest) and (len(rest) >= 2 * size or rest["dim"].iloc[0] != rest["dim"].iloc[-1]):
                n = int((rest["dim"] == rest["dim"].iloc[0]).to_numpy().argmin()) or len(rest)
                yield block(rest.iloc[: min(n, size)])
                rest = rest.iloc[min(n, size) :].reset_index(drop=True)
        while rest is not None and len(rest):
            yield block(rest.iloc[:size])
            rest = rest.iloc[size:]

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        norm = float(_lengths(v).max())
        return pd.DataFrame(
            [(int(pdf["dim"].iloc[0]), len(pdf), norm, pdf["id"].to_numpy(dtype=np.int64).tobytes(), _blob(v))],
            columns=["dim", "n", "norm", "ids", "m"],
        )

    return rows.mapInPandas(pack, "dim int, n int, norm double, ids binary, m binary")


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    bucket: int = BUCKET,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest products, ranks from 1.

    Components become ``floor(scale * x)``; the score is the integer product.
    Queries are the rows where ``is_query`` holds, candidates every row with
    another id; ties go to the smaller id; fewer candidates give fewer rows.
    Vectors that are null or hold a null or non-finite component, and rows
    with a null id, take no part. Vectors of different lengths have no product
    with each other; vectors without components score 0. Rows that share an id
    are candidates each, and a query id that repeats gives its ranks for each
    of its rows. Scores beyond a long saturate. An empty table gives no rows.

    Queries and candidates meet in packed blocks. A task holds one bucket and
    the best products so far of at most ``HELD_BLOCKS`` query blocks, ``k`` a
    query; what it hands on are those, not the buckets' own. A bucket's size
    follows from ``bucket`` alone, whatever the number of partitions.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.size(vector).alias("dim"),
        F.col(vec_id).cast("long").alias("id"),
        scaled(F.col(vector), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    )
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n = rows.count()
    parts = n // (PACKED * bucket) + 1
    sorted_rows = rows.withColumn("w", norm).repartitionByRange(parts, "dim", F.desc("w"), "id")
    # Blocks are numbered in the written tables: equal blocks stay apart, and a number is of one dimension.
    buckets = staged(
        _packed(sorted_rows.sortWithinPartitions("dim", F.desc("w"), "id").select("dim", "id", "v"), bucket).withColumn(
            "b", F.monotonically_increasing_id()
        ),
        "buckets",
    )
    n_queries = rows.filter("q").count()
    queries = rows.filter("q").select("dim", "id", "v").repartition(n_queries // (PACKED * query_block) + 1, "dim", "id")
    blocks = staged(
        _packed(queries.sortWithinPartitions("dim", "id"), query_block).withColumn("qb", F.monotonically_increasing_id()),
        "queries",
    )

    # The longest bucket of each dimension seeds the bounds: one row a dimension.
    seeds = buckets.groupBy("dim").agg(F.max(F.struct("norm", "b", "ids", "m")).alias("s")).select("dim", "s.*")

    def seed(pdf: pd.DataFrame) -> pd.Series:
        out = []
        for dim, ids, m, own, c in zip(*(pdf[x] for x in ("dim", "ids", "m", "sids", "sm")), strict=True):
            q_ids, c_ids = np.frombuffer(ids, np.int64), np.frombuffer(own, np.int64)
            got = products(_matrix(m, q_ids.size, dim), _matrix(c, c_ids.size, dim))
            bounds = np.full(q_ids.size, np.iinfo(np.int64).min)
            for i, q in enumerate(q_ids):
                s = got[i][c_ids != q]
                if s.size >= k:
                    bounds[i] = np.partition(s, s.size - k)[s.size - k]
            out.append(bounds.tobytes())
        return pd.Series(out, dtype=object)

    def seeded(parts_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts_:
            norms = [_lengths(_matrix(m, c, d)) for m, d, c in zip(pdf["m"], pdf["dim"], pdf["n"], strict=True)]
            bounds = seed(pdf)
            reach = [
                float(np.min(np.where(np.frombuffer(t, np.int64) > 0, np.frombuffer(t, np.int64) / np.maximum(x, 1e-300), 0)))
                for t, x in zip(bounds, norms, strict=True)
            ]
            yield pd.DataFrame(
                {"dim": pdf["dim"], "qb": pdf["qb"], "qids": pdf["ids"], "qm": pdf["m"], "bounds": bounds, "reach": reach}
            )

    bounded = staged(
        blocks.join(seeds.select("dim", F.col("ids").alias("sids"), F.col("m").alias("sm")), "dim").mapInPandas(
            seeded, "dim int, qb long, qids binary, qm binary, bounds binary, reach double"
        ),
        "bounds",
    )

    # Which block meets which bucket: keys only, a bucket no query of the block can use is left out.
    # Salted, since all vectors may have the same dimension.
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        bounded.select("dim", "qb", "reach", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        .join(buckets.select("dim", "b", "norm", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int").alias("salt")), ["dim", "salt"])
        .filter(F.col("norm") >= F.col("reach") * F.lit(1 - SLACK))
        .select("qb", "b")
        .repartition("qb")  # keys only; where the blocks are small enough to be broadcast, a task reads all of a query block
    )

    def scan(parts_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, _Best] = {}
        for pdf in parts_:
            for qb, dim, qids, qm, bounds, ids, m in zip(
                *(pdf[x] for x in ("qb", "dim", "qids", "qm", "bounds", "ids", "m")), strict=True
            ):
                if qb in held:
                    held[qb] = held.pop(qb)  # last used goes last
                else:
                    if len(held) >= HELD_BLOCKS:
                        first = next(iter(held))
                        yield held.pop(first).rows().assign(qb=first)
                    held[qb] = _Best(dim, qids, qm, bounds, k)
                held[qb].read(ids, m)
        for qb, found_ in held.items():
            yield found_.rows().assign(qb=qb)

    found = (
        pairs.join(bounded.drop("reach"), "qb")
        .join(buckets.select("b", "ids", "m"), "b")
        .mapInPandas(scan, "query_id long, row int, vec_id long, score long, qb long")
    )
    order = Window.partitionBy("qb", "row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


class _Best:
    """The best ``k`` verified products of a block of queries over the buckets read so far."""

    def __init__(self, dim: int, qids: bytes, qm: bytes, bounds: bytes, k: int):
        self.dim, self.k = dim, k
        self.ids = np.frombuffer(qids, np.int64)
        self.q = _matrix(qm, self.ids.size, dim).astype(np.int64)
        self.bound = np.frombuffer(bounds, np.int64).copy()
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.ids]

    def _keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ok = (scores >= self.bound[i]) & (ids != self.ids[i])
        if not ok.any():
            return
        ids = np.concatenate((self.found[i][0], ids[ok]))
        scores = np.concatenate((self.found[i][1], scores[ok]))
        top = best(ids, scores, self.k)
        self.found[i] = ids[top], scores[top]
        if top.size == self.k:
            self.bound[i] = max(self.bound[i], scores[top[-1]])

    def read(self, ids: bytes, m: bytes) -> None:
        c_ids = np.frombuffer(ids, np.int64)
        c = _matrix(m, c_ids.size, self.dim).astype(np.int64)
        norms = _lengths(c)
        wanted = [prune(self.q[i], float(self.bound[i]), c, norms) for i in range(self.ids.size)]
        most = [i for i, w in enumerate(wanted) if w is None or w.size > c_ids.size // 4]
        if most:  # little pruned: one product of matrices for all of them
            got = products(self.q[most], c)
            for row, i in enumerate(most):
                at = slice(None) if wanted[i] is None else wanted[i]
                self._keep(i, c_ids[at], got[row][at])
        done = set(most)
        for i, w in enumerate(wanted):
            if i not in done and w.size:
                self._keep(i, c_ids[w], products(self.q[i : i + 1], c[w])[0])

    def rows(self) -> pd.DataFrame:
        sizes = [x.size for x, _ in self.found]
        at = np.repeat(np.arange(self.ids.size), sizes)
        return pd.DataFrame(
            {
                "query_id": self.ids[at],
                "row": at.astype(np.int32),
                "vec_id": np.concatenate([x for x, _ in self.found]),
                "score": np.concatenate([x for _, x in self.found]),
            }
        )
