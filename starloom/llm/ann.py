"""Nearest neighbours by inner product: inverted lists with an adaptive scan.

Vectors get one more component that makes all of equal length, so the largest inner
product is the smallest distance; then all are rotated at random. Lists come from
k-means on a bounded sample; every vector is put into the list of its nearest centre,
and a query probes the lists of its nearest centres. In a list, distances grow column
block by column block. A random rotation makes the distance over the first t of D
columns, times D / t, an estimate of the whole; a candidate is given up once that
estimate exceeds the query's limit by more than chance allows (a hypothesis test with
margin ``1 + EPSILON / sqrt(t)``). The limit is the distance of the k-th best so far.
What survives all columns is scored exactly on the original vectors.

The first limit of a query comes from a small part of the sample, whose best are
candidates like all others. The share of lists that a query probes is measured on the sample, so that the recall
there reaches ``target``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.bounded import hash_sample

#: Vectors that lists, rotation and probed share are fitted on at most.
FIT_ROWS = 20_000
#: Centres of one level: beyond so many lists, each is parted by a second level.
MOST_CENTRES = 1_024
#: Coarse centres within whose lists a vector looks for the nearest ones, at least.
WIDE = 32
TARGET = 0.96
EPSILON = 2.1
BLOCK = 16
#: Vectors, and queries, that one task scans against each other at once.
CELL = 4_096
CHUNK = 512


@dataclass(frozen=True)
class Index:
    centres: np.ndarray  # of extended vectors
    inner: np.ndarray  # second level: centres of what is left of a vector after its first
    rotation: np.ndarray
    longest: float  # the length of all extended vectors
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray

    def extended(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x**2).sum(1), 0))
        return np.column_stack((x, rest))

    @property
    def lists(self) -> int:
        return len(self.centres) * len(self.inner)

    def nearest_lists(self, x: np.ndarray, n: int, query: bool = False) -> np.ndarray:
        """Numbers of the (at most) n lists whose centres are nearest, nearest first. A
        list's centre is one of the first level and one of the second, added up."""
        x = self.extended(x, query)
        near = x @ self.centres.T - 0.5 * (self.centres**2).sum(1)
        k = len(self.inner)
        if k == 1:
            return np.argsort(-near, axis=1, kind="stable")[:, :n]
        wide = min(len(self.centres), max(WIDE, 2 * -(-n // k)))
        top = np.argsort(-near, axis=1, kind="stable")[:, :wide]
        between = self.centres @ self.inner.T + 0.5 * (self.inner**2).sum(1)
        both = np.take_along_axis(near, top, 1)[:, :, None] + (x @ self.inner.T)[:, None] - between[top]
        numbers = (top[:, :, None] * k + np.arange(k)).reshape(len(x), -1)
        order = np.argsort(-both.reshape(len(x), -1), axis=1, kind="stable")[:, :n]
        return np.take_along_axis(numbers, order, 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the vectors that take part: not null, without null or
    non-finite components, not zero, of the dimension that most of them have."""
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vec")).filter(
        F.col("id").isNotNull() & (F.size("vec") > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda v: v != 0)
    )
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), "dim").first()
    return rows.filter(F.size("vec") == (top["dim"] if top else 0))


def one_each(rows: DataFrame) -> DataFrame:
    """One vector of each id: of several, the smallest component by component. Only the
    ids are shuffled where no id stands twice."""
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    twice = materialise(twice, "twice")
    if twice.isEmpty():
        return rows
    least = rows.join(twice, "id").groupBy("id").agg(F.min("vec").alias("vec"))
    return rows.join(twice, "id", "left_anti").unionByName(least)


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors])


def _kmeans(x: np.ndarray, n: int, rng, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), n, replace=False)]
    for _ in range(rounds):
        of = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        count = np.bincount(of, minlength=n)
        total = np.zeros_like(centres)
        np.add.at(total, of, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def build(rows: DataFrame, k: int, fit_rows: int = FIT_ROWS, target: float = TARGET, seed: int = 7) -> Index | None:
    """Fits the index on the ``fit_rows`` vectors of the smallest id hashes; the
    number of vectors and their greatest length are taken from all rows."""
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest")).first()
    if not facts["n"]:
        return None
    sample = hash_sample(rows, "id", fit_rows, facts["n"]).toPandas()
    ids, x = sample["id"].to_numpy(np.int64), _matrix(sample["vec"])
    rng = np.random.default_rng(seed)
    lists = max(1, round(facts["n"] ** 0.5))  # as many as a list has vectors
    coarse = int(min(MOST_CENTRES, lists, len(x)))
    rotation, _ = np.linalg.qr(rng.standard_normal((x.shape[1] + 1, x.shape[1] + 1)))
    none = np.zeros((1, x.shape[1] + 1))
    index = Index(none, none, rotation, float(facts["longest"]), 1, ids, x)
    extended = index.extended(x)
    centres = _kmeans(extended, coarse, rng)
    own = (extended @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
    parts = int(min(-(-lists // coarse), len(x)))
    inner = _kmeans(extended - centres[own], parts, rng) if parts > 1 else none
    index = Index(centres, inner, rotation, index.longest, 1, ids, x)
    # of how many lists must a query of the sample look into the nearest?
    asked = np.arange(0, len(x), max(1, len(x) // 400))
    own = np.concatenate([index.nearest_lists(x[a : a + CHUNK], 1)[:, 0] for a in range(0, len(x), CHUNK)])
    depth = []
    for some in np.array_split(asked, -(-len(asked) * index.lists // 2_000_000)):
        dots = x[some] @ x.T
        dots[np.arange(len(some)), some] = -np.inf
        best = np.argsort(-dots, axis=1)[:, : min(k, len(x) - 1)]
        ranked = index.nearest_lists(x[some], index.lists, True)
        place = np.full((len(some), index.lists), index.lists, np.int64)
        np.put_along_axis(place, ranked, np.arange(ranked.shape[1])[None].repeat(len(some), 0), 1)
        depth.append(np.take_along_axis(place, own[best], 1).ravel())
    depth = np.sort(np.concatenate(depth))
    probes = int(depth[min(len(depth) - 1, int(np.ceil(target * len(depth))))]) + 1 if len(depth) else 1
    few = rng.choice(len(x), min(len(x), 4_096), replace=False)
    return Index(centres, inner, rotation, index.longest, min(probes, index.lists), ids[few], x[few])


def _top(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The k best of each query: (query, score, id), score down, then id up."""
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], score[keep], ids[keep]


def scan(index: Index, q_ids, q, limits, x_ids, x, k: int):
    """(position of the query, score, id) of the best of one list's part; limits:
    inner products that the k-th best of each query reaches at least."""
    rotated_q = (index.extended(q, True) @ index.rotation).astype(np.float32)
    rotated_x = (index.extended(x) @ index.rotation).astype(np.float32)
    q_length, dim = (q**2).sum(1), rotated_q.shape[1]
    best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    limits = limits.copy()
    for at in range(0, len(x), CHUNK):
        part = rotated_x[at : at + CHUNK]
        # limits as squared distances, with room for rounding
        most = q_length + index.longest**2 - 2 * limits + 1e-4 * (q_length + index.longest**2)
        a, b = rotated_q[:, :BLOCK], part[:, :BLOCK]
        partial = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * (a @ b.T)
        done = min(BLOCK, dim)
        i, j = np.nonzero(partial * (dim / done) <= (most * (1 + (EPSILON / done**0.5 if done < dim else 0)) ** 2)[:, None])
        partial = partial[i, j]
        while done < dim and len(i):
            columns = slice(done, done + BLOCK)
            partial = partial + ((rotated_q[i, columns] - part[j, columns]) ** 2).sum(1)
            done = min(done + BLOCK, dim)
            keep = partial * (dim / done) <= most[i] * (1 + (EPSILON / done**0.5 if done < dim else 0)) ** 2
            i, j, partial = i[keep], j[keep], partial[keep]
        other = q_ids[i] != x_ids[at + j]
        i, j = i[other], j[other]
        score = np.einsum("ij,ij->i", q[i], x[at + j])
        best = _top(*(np.concatenate(c) for c in zip(best, (i, score, x_ids[at + j]))), k)
        number = np.bincount(best[0], minlength=len(q))
        full = np.flatnonzero(number == k)
        limits[full] = np.maximum(limits[full], best[1][np.cumsum(number)[full] - 1])
    return best


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    fit_rows: int = FIT_ROWS,
    target: float = TARGET,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (inner product of
    the original vectors in double precision): of each query the ``k`` nearest found
    among ``vectors``, its own id left out; ties to the smaller id.

    Null ids, and vectors that are null, empty, zero, of another dimension than most,
    or hold null or non-finite components take no part on either side. Repeated rows
    are one candidate or query, and so are several vectors of one id: the smallest
    component by component. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = one_each(usable(vectors, key, vector))
    index = build(rows, k, fit_rows, target)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asks = one_each(usable(queries, key, vector).filter(F.size("vec") == index.sample.shape[1]))
    sent = spark.sparkContext.broadcast(index)
    kind = rows.schema["vec"].dataType.simpleString()

    def assign(frames):
        for frame in frames:
            for lot in (frame.iloc[a : a + CHUNK] for a in range(0, len(frame), CHUNK)):
                yield lot.assign(list=sent.value.nearest_lists(_matrix(lot["vec"]), 1)[:, 0])

    def probe(frames):
        ix = sent.value
        for frame in frames:
            for lot in (frame.iloc[a : a + CHUNK] for a in range(0, len(frame), CHUNK)):
                x = _matrix(lot["vec"])
                dots = x @ ix.sample.T
                dots[lot["id"].to_numpy()[:, None] == ix.sample_ids[None]] = -np.inf
                least = -ix.longest * np.sqrt((x**2).sum(1))  # no inner product is smaller
                seeds = np.argsort(-dots, axis=1, kind="stable")[:, :k]
                scores = np.einsum("ij,ikj->ik", x, ix.sample[seeds])
                if seeds.shape[1] == k:
                    least = np.maximum(least, np.where(np.isfinite(np.take_along_axis(dots, seeds[:, -1:], 1)[:, 0]), scores[:, -1], -np.inf))
                yield lot.assign(
                    limit=least,
                    lists=list(ix.nearest_lists(x, ix.probes, True)),
                    seeds=list(ix.sample_ids[seeds]),
                    scores=list(scores),
                )

    placed = materialise(rows.mapInPandas(assign, f"id bigint, vec {kind}, list bigint"), "placed")
    ddl = f"id bigint, vec {kind}, limit double, lists array<bigint>, seeds array<bigint>, scores array<double>"
    asked = materialise(asks.mapInPandas(probe, ddl), "asked")
    seeded = asked.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("seeds", "scores")).alias("s"))
    seeded = seeded.select("query_id", F.col("s.seeds").alias("vec_id"), F.col("s.scores").alias("score")).filter("query_id <> vec_id")
    probing = asked.select("id", "vec", "limit", F.explode("lists").alias("list"))
    # a list is scanned in cells of bounded size, however many vectors or queries it has
    sizes = placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).toPandas()
    loads = probing.groupBy("list").agg(F.count(F.lit(1)).alias("n")).toPandas()
    parts = pd.DataFrame({"list": np.arange(index.lists)})
    for name, of in (("x_parts", sizes), ("q_parts", loads)):
        counts = of.set_index("list")["n"].reindex(parts["list"]).fillna(0)
        parts[name] = np.maximum(1, -(-counts.to_numpy() // CELL)).astype(int)
    parts = spark.createDataFrame(parts)  # a row for each list: the root of the number of vectors
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    all_parts = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells = ["list", "x_part", "q_part"]
    left = placed.join(parts, "list").select("id", "vec", "list", part("x_parts").alias("x_part"), all_parts("q_parts").alias("q_part"))
    right = probing.join(parts, "list").select(
        "id", "vec", "limit", "list", part("q_parts").alias("q_part"), all_parts("x_parts").alias("x_part")
    )

    def cell(_, xs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(xs) or not len(qs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q_ids = qs["id"].to_numpy(np.int64)
        at, score, ids = scan(
            sent.value, q_ids, _matrix(qs["vec"]), qs["limit"].to_numpy(), xs["id"].to_numpy(np.int64), _matrix(xs["vec"]), k
        )
        return pd.DataFrame({"query_id": q_ids[at], "vec_id": ids, "score": score})

    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInPandas(cell, "query_id bigint, vec_id bigint, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.unionByName(seeded).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
