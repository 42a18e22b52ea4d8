"""Connected components of texts by the Jaccard similarity of their word n-gram sets.

What two sets must share to be candidates, and what sketches say of them, is given;
here equal sets become one, candidates are tested exactly, links become components.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import arrow_schema, in_batches, slices
from starloom.llm.components import POSTINGS, Poster, filter_pairs, linked_components, near_pairs, shared_buckets
from starloom.llm.membership import bitmap, perhaps
from starloom.llm.shingles import lane, links, set_id, shingle_set
from starloom.operators.lookup import spread_join

SETS = "key bigint, tag bigint, n bigint, id bigint, mark binary, tokens binary"


def sets_once(batches, size: int):
    """(tokens, id) of the texts of a task, last column of its batches; copies are left
    out as far as a bounded memory of those seen goes."""
    seen: set[int] = set()
    for part in slices(batches):
        for data in part.column(part.num_columns - 1).to_pylist():
            tokens = shingle_set(data, size)
            own = set_id(tokens)
            if own not in seen:
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(own)
                yield tokens, own


def narrowed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tag, data): ``tag`` tells texts of one key apart."""
    tag = F.xxhash64(F.col(text)).alias("tag")
    return docs.select(F.col(key).cast("bigint").alias("key"), tag, F.col(text).cast("binary").alias("data"))


def set_components(
    narrow: DataFrame,
    size: int,
    percent: int,
    signatures: Callable[[np.ndarray], np.ndarray],
    mark: Callable[[np.ndarray], bytes],
    table: Callable[[list[bytes]], object],
    near: Callable[[object, np.ndarray, np.ndarray], np.ndarray],
    first: Callable[[object, np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Rows (key, tag, n, low): the size of each row's set and the smallest key that
    links reach (100 * intersection of at least ``percent`` * union).

    Sets are candidates if ``signatures`` (unsigned hashes) of both have one in common
    and their marks may link: see :func:`linked_components`.
    An empty set links with nothing.
    """
    context = narrow.sparkSession.sparkContext

    def post(batches):
        posted = Poster()
        for tokens, own in sets_once(batches, size):
            if len(tokens) and posted.add(signatures(tokens), own):
                yield posted.take()
        yield posted.take()

    buckets = materialise(shared_buckets(in_batches(narrow.select("data"), post, POSTINGS)), "buckets")
    wanted = context.broadcast(bitmap(buckets.select("id").distinct(), "id"))
    schema = arrow_schema(SETS)

    def run(batches):
        seen: set[int] = set()  # copies need not hold their set again
        for part in slices(batches):
            rows = []
            for k, tag, data in zip(*(c.to_pylist() for c in part.columns)):
                tokens = shingle_set(data, size)
                own = set_id(tokens) if len(tokens) else None
                held = (None, None)
                if own in wanted.value and own not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(own)
                    held = (mark(tokens), tokens.tobytes())
                rows.append((k, tag, len(tokens), own, *held))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    sets = materialise(in_batches(narrow, run, SETS), "sets")
    items = sets.filter("tokens IS NOT NULL")
    marks = items.groupBy("id").agg(F.first("n").alias("n"), F.first("mark").alias("mark"))
    marks = materialise(marks.select("id", lane(F.col("n"), percent).alias("lane"), "mark"), "marks")
    sent = [wanted]

    def test(pairs):
        left = materialise(filter_pairs(pairs, marks, "mark", near_pairs(table, near)), "near")
        ends = left.select(F.col("a").alias("id")).unionByName(left.select(F.col("b").alias("id")))
        asked = context.broadcast(bitmap(ends, "id"))  # whole sets are moved for these only
        sent.append(asked)
        whole = materialise(items.select("id", "tokens").filter(perhaps(asked, "id")).dropDuplicates(["id"]), "whole")
        return filter_pairs(left, whole, "tokens", lambda xs, ys: [links(x, y, percent) for x, y in zip(xs, ys)])

    comp = linked_components(buckets, test, marks, table, near, first, merge_alike=first is None)
    for held in sent:
        held.destroy()
    # a set or a component may hold a third of all rows: both joins spread such keys
    named = spread_join(sets.filter("id IS NOT NULL").select("key", "tag", "n", "id"), comp, ["id"])
    named = materialise(named.select("key", "tag", "n", F.coalesce("comp", "id").alias("comp")), "named")
    names = named.groupBy("comp").agg(F.min("key").alias("low"))
    whole = spread_join(named, names, ["comp"], "inner", census=named).select("key", "tag", "n", "low")
    blank = sets.filter("id IS NULL").select("key", "tag", "n", F.col("key").alias("low"))
    return whole.unionByName(blank)
