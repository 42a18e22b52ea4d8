"""Connected components of items that share signatures and pass an exact test.

Items of one bucket (one signature) are candidates of each other. In a few rounds, each
bucket tests its members against one of them, and what links is merged into components:
a bucket of near copies, however large, costs a round in proportion to its size. Buckets
that still hold several components are compared by short sketches inside tasks, and only
pairs that the sketches leave become rows. A bucket over ``CELL`` members is first split
by lanes (linked items lie in equal or adjacent ones), then dealt over cells of two
blocks each, so that no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import arrow_schema, in_batches, slices
from starloom.llm.hashing import mix
from starloom.operators.lookup import Census, spread_join

#: Rounds with one leader in each bucket, before pairs across components.
STAR_ROUNDS = 3
#: Members of a bucket, or of a block of a larger one, that are compared in one task.
CELL = 2048
#: A signature that a task meets more often than this within ``FLUSH`` rows is salted.
OFTEN = 8
#: The salt takes the low bits of a signature, which keeps the others.
SALTS = 31
FLUSH = 200_000
POSTINGS = "sig bigint, id bigint"
#: Tasks that buckets with one smallest member are dealt to, so that few meet a pair again.
HOMES = 4
#: Pairs that a task remembers, so as not to return them again for another bucket.
SEEN_PAIRS = 500_000
#: Pairs of places that a task compares at once.
PAIRS = 100_000


def connected(edges: DataFrame) -> DataFrame:
    """``id`` and ``comp`` (the smallest id of its component) of every id in
    ``edges`` (a, b). Each round hooks every id on its smallest neighbour and
    contracts; with ids in no order (digests), what is left of the edges shrinks
    geometrically."""
    live = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    hooks = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        hook = materialise(hook.select("id", F.least("id", "low").alias("to")), "hooks")
        hooks.append(hook)
        live = (
            live.join(hook.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
            .join(hook.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        live = materialise(live, "edges")
    if not hooks:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("comp")).limit(0)
    comp = hooks[0].select("id", F.col("to").alias("comp"))
    for hook in hooks[1:]:
        nxt = hook.select(F.col("id").alias("comp"), "to")
        comp = comp.join(nxt, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    return materialise(comp, "components")


class Poster:
    """Collects the postings of a task as batches of ``POSTINGS``.

    A signature that stands more than ``OFTEN`` times in a batch is salted from there
    on: its first rows go where all tasks send theirs, the others are spread.
    """

    schema = pa.schema([("sig", pa.int64()), ("id", pa.int64())])

    def __init__(self, flush: int = FLUSH):
        self.flush, self.n = flush, 0
        self.sigs: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, sigs: np.ndarray, own) -> bool:
        """Unsigned signatures of an id, or of as many ids; whether to ``take`` now."""
        self.sigs.append(sigs)
        self.ids.append(np.full(len(sigs), own, np.int64) if np.ndim(own) == 0 else own)
        self.n += len(sigs)
        return self.n >= self.flush

    def take(self) -> pa.RecordBatch:
        sigs = np.concatenate(self.sigs) if self.sigs else np.zeros(0, np.uint64)
        sigs = sigs & ~np.uint64(SALTS)
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64)
        self.sigs, self.ids, self.n = [], [], 0
        order = np.argsort(sigs, kind="stable")
        s = sigs[order]
        new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
        rank = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        often = order[rank >= OFTEN]
        sigs[often] |= np.uint64(1) + mix(ids[often].view(np.uint64)) % np.uint64(SALTS)
        return pa.RecordBatch.from_arrays([pa.array(sigs.view(np.int64)), pa.array(ids)], schema=self.schema)


def shared_buckets(postings: DataFrame) -> DataFrame:
    """(sig, id, weight) of the signatures that two or more ids have, from ``postings``
    (sig, id); now and then an id twice. A salted row is one of several by itself. An
    id's weight is how many it meets over all its signatures, or fewer where those are
    salted: a hint at whom to compare first."""
    once = postings.repartition("sig").groupBy("sig", "id").agg(F.count(F.lit(1)).alias("n")).drop("n")
    salted = F.col("sig").bitwiseAND(SALTS) > 0
    sized = once.withColumn("size", F.count(F.lit(1)).over(W.partitionBy("sig"))).filter((F.col("size") > 1) | salted)
    sized = materialise(sized.withColumn("sig", F.col("sig").bitwiseAND(~SALTS)), "buckets")
    return sized.select("sig", "id").join(sized.groupBy("id").agg(F.sum("size").alias("weight")), "id")


def _priority(k: int):
    """Order in which a bucket's leader is chosen: first the member that meets most
    others (near copies of one text mostly link with that text, if not with each
    other), then members by chance."""
    if k:
        return F.xxhash64("id", F.lit(k))
    return F.least("weight", F.lit(1 << 40)) * (1 << 20) + F.pmod(F.xxhash64("id"), F.lit(1 << 20))


def linked_components(
    buckets: DataFrame,
    test: Callable[[DataFrame], DataFrame],
    marks: DataFrame,
    table: Callable[[list[bytes]], object],
    near: Callable[[object, np.ndarray, np.ndarray], np.ndarray],
    first: Callable[[object, np.ndarray, np.ndarray], np.ndarray] | None = None,
    star_rounds: int = STAR_ROUNDS,
    merge_alike: bool = False,
) -> DataFrame:
    """``id`` and ``comp`` of the ids that are linked with others.

    ``buckets`` (sig, id, weight) is a stored frame; ``test`` gets distinct candidate pairs
    (a, b), a < b, and returns those that link. ``marks`` (id, lane, mark) has a short
    sketch of each id, and a lane that links never leave by more than one. ``table`` puts
    some marks in order for ``near``, which tells of pairs of their places whether they
    may link; ``first``, if the marks tell it, gives the signature in whose bucket alone a
    pair is to be returned. Every pair that shares a bucket is tested unless its two
    sides are in one component already or lanes or marks rule it out. With
    ``merge_alike`` (and without ``first``), of open buckets with the same members one is
    compared: a passage that some texts share makes many.
    """
    members = buckets.withColumn("comp", F.col("id"))
    known = None  # id, comp of all that linked so far

    def settle(found, known):
        """All links so far, after those among ``found``."""
        linked = materialise(test(materialise(found.distinct(), "pairs")), "linked")
        if linked.isEmpty():
            return known, False
        if known is not None:  # earlier components, each as a star
            linked = linked.unionByName(known.select(F.col("comp").alias("a"), F.col("id").alias("b")))
        return connected(linked), True

    for k in range(star_rounds + 1):
        lead = [F.max_by(c, _priority(k)).alias(f"lead_{c}") for c in ("id", "comp")]
        heads = members.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *lead)
        heads = heads.filter("low < high").drop("low", "high")
        # a bucket of a third of all rows is a hot key of this join, whose lookup is unique
        members = materialise(members.join(heads, "sig"), "open")
        if members.isEmpty():
            break
        if k < star_rounds:
            found = members.filter("comp <> lead_comp")
            found = found.select(F.least("id", "lead_id").alias("a"), F.greatest("id", "lead_id").alias("b"))
        else:
            left = members.select("sig", "id", "comp")
            found = _across(_without_alike(left) if merge_alike else left, marks, table, near, first)
        known, more = settle(found, known)
        members = members.drop("lead_id", "lead_comp")
        if more:
            members = members.drop("comp").join(known, "id", "left")
            members = members.select("sig", "id", "weight", F.coalesce("comp", "id").alias("comp"))
    return known if known is not None else buckets.select("id", F.col("id").alias("comp")).limit(0)


def _without_alike(members: DataFrame) -> DataFrame:
    """Of buckets that have the same ids, one (told by their number and four sums over
    digests of the ids); ``home``: the bucket's smallest id and one of ``HOMES`` numbers.
    Buckets with many ids in common mostly have the smallest in common."""
    sums = []
    for digest in (F.xxhash64("id"), F.xxhash64("id", F.lit(1))):
        sums += [F.sum(digest.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(digest, 32))]
    sums = [F.count(F.lit(1)), *sums, F.min("id")]
    names = [f"s{i}" for i in range(len(sums))]
    told = members.groupBy("sig").agg(*[s.alias(n) for s, n in zip(sums, names)])
    kept = told.groupBy(*names).agg(F.min("sig").alias("sig"))
    kept = kept.select("sig", F.xxhash64(names[-1], F.pmod(F.xxhash64("sig"), F.lit(HOMES))).alias("home"))
    return members.join(materialise(kept, "unlike"), "sig")


_CELL = ["sig", "lane", "i", "j"]


def _across(members: DataFrame, marks: DataFrame, table, near, first) -> DataFrame:
    """Pairs (a, b) of different components in one bucket that lanes and marks allow."""
    big = members.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL).select("sig")
    big = materialise(big, "big")
    marked = members.join(marks, "id")
    zero = F.lit(0).cast("bigint")
    home = (F.col("home") if "home" in members.columns else F.col("sig")).alias("home")
    plain = ("sig", zero.alias("lane"), zero.alias("i"), zero.alias("j"), zero.alias("block"), F.lit(True).alias("own"), home)
    body = ("id", "comp", "mark")
    if big.isEmpty():
        cells = marked.select(*plain, *body)
    else:
        marked = materialise(marked, "marked")
        small = marked.join(big, "sig", "left_anti").select(*plain, *body)
        # each member lies in its own lane and visits the next one
        laned = marked.join(big, "sig").withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
        laned = laned.withColumn("lane", F.col("lane") + F.when(F.col("own"), 0).otherwise(1))
        laned = materialise(laned, "lanes")
        parts = laned.groupBy("sig", "lane").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("parts"), F.max("own").alias("any_own"))
        laned = laned.join(parts.filter("any_own").drop("any_own"), ["sig", "lane"])
        laned = laned.withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")))
        laned = laned.withColumn("x", F.explode(F.sequence(zero, F.col("parts") - 1)))
        ends = (F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"))
        laned = laned.select("sig", "lane", *ends, "block", "own", *body)
        cells = small.unionByName(laned.withColumn("home", F.xxhash64(*_CELL)))
    dealt = cells.repartition("home").sortWithinPartitions(*_CELL).drop("home")
    return in_batches(dealt, _compare(table, near, first), "a bigint, b bigint")


def _pairs_of(starts: np.ndarray, ends: np.ndarray):
    """All pairs i < j of places within each of the spans, as arrays of at most about
    ``PAIRS`` each."""
    held, n = [], 0
    for size in np.unique(ends - starts).tolist():
        if size < 2:
            continue
        of = starts[ends - starts == size]
        each = np.triu_indices(size, 1)
        step = max(1, PAIRS // len(each[0]))
        for low in range(0, len(of), step):
            base = of[low : low + step, None]
            for at in range(0, len(each[0]), PAIRS):
                i, j = (base + e[None, at : at + PAIRS] for e in each)
                held.append((i.ravel(), j.ravel()))
                n += i.size
                if n >= PAIRS:
                    yield tuple(np.concatenate(k) for k in zip(*held))
                    held, n = [], 0
    if held:
        yield tuple(np.concatenate(k) for k in zip(*held))


def _compare(table, near, first):
    schema = arrow_schema("a bigint, b bigint")

    def compared(rows):
        """Pairs (a, b) that may link, of whole cells in order."""
        column = {c: rows.column(c).to_numpy() for c in (*_CELL, "block", "id", "comp")}
        own = rows.column("own").to_numpy(zero_copy_only=False)
        keys = np.stack([column[c] for c in _CELL])
        starts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(0))))
        marks = table(rows.column("mark").to_pylist())
        for i, j in _pairs_of(starts, np.append(starts[1:], rows.num_rows)):
            good = (column["comp"][i] != column["comp"][j]) & (column["id"][i] != column["id"][j])
            good &= own[i] | own[j]
            good &= (column["i"][i] == column["j"][i]) | (column["block"][i] != column["block"][j])
            i, j = i[good], j[good]
            if first is not None:  # a pair that shares many buckets is met in one of them
                good = first(marks, i, j) & ~SALTS == column["sig"][i]
                i, j = i[good], j[good]
            good = near(marks, i, j)
            a, b = column["id"][i[good]], column["id"][j[good]]
            yield np.minimum(a, b), np.maximum(a, b)

    def run(batches):
        held, seen = None, set()

        def found(rows):
            for a, b in compared(rows):
                new = {p for p in zip(a.tolist(), b.tolist()) if p not in seen}
                if len(seen) > SEEN_PAIRS:
                    seen.clear()
                seen.update(new)
                if new:
                    columns = zip(*new)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        for batch in batches:
            for part in slices([batch], CELL):
                rows = pa.Table.from_batches([part])
                held = rows if held is None else pa.concat_tables([held, rows])
                if held.num_rows < 2 * CELL:
                    continue
                last = [held.column(c)[-1].as_py() for c in _CELL]
                same = np.logical_and.reduce([held.column(c).to_numpy() == v for c, v in zip(_CELL, last)])
                whole = int(np.argmax(same))  # the last cell may go on
                if whole:
                    yield from found(held.slice(0, whole))
                    held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield from found(held)

    return run


def filter_pairs(pairs: DataFrame, items: DataFrame, column: str, keep) -> DataFrame:
    """The pairs (a, b) of a stored frame that ``keep`` tells to keep, given lists of the
    ``column`` of their two items. An item of many pairs is spread over several tasks."""
    census = Census(pairs, ["a"], ["b"])
    for side in "ab":
        named = items.select(F.col("id").alias(side), F.col(column).alias(f"of_{side}"))
        pairs = spread_join(pairs, named, [side], "inner", census=census)
    pairs = pairs.select("a", "b", "of_a", "of_b")

    def run(batches):
        for part in slices(batches):
            good = keep(*(c.to_pylist() for c in part.columns[2:]))
            yield pa.RecordBatch.from_arrays(list(part.columns[:2]), names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return in_batches(pairs, run, "a bigint, b bigint")


def near_pairs(table, near):
    """What of :func:`linked_components` tells of marks, as ``keep`` of :func:`filter_pairs`."""

    def keep(xs, ys):
        at = np.arange(len(xs))
        return near(table(xs + ys), at, at + len(xs)) if xs else []

    return keep
