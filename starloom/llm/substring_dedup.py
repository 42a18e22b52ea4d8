"""Removal of long repeated word sequences with a compacted De Bruijn graph.

Edges are k-mers of words. Of the 26 edges (k = 25) in a window of 50 words, the one
with the smallest hash stands for the window (the leftmost, if repeated), so equal
windows are stood for by equal edges, and about one edge in thirteen is kept. Edges
seen in one document only can't be in a repeat and go.

Consecutive kept edges of a document make a step (with the hash of all words from the
first to the end of the second). The earliest occurrence of each step, a document and
a position, is its source. Where the source of the next step is the place at which
this one's source ends, the path has no branch, and the steps compact into one. What
a compacted path covers stands word for word in its source, as the coordinates prove:
if that document is an earlier one, the windows inside need no further check.

Windows with a repeated edge outside such paths (first occurrences, the ends of
repeats) are compared by the hash of all their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import in_batches, map_rows, slices
from starloom.llm.hashing import Runs, signed, word_hashes
from starloom.llm.membership import bitmap, perhaps

WINDOW = 50
EDGE = 25


def edges(runs: Runs, n: int, window: int, edge: int) -> np.ndarray:
    """For each window of a text of n words: where its edge starts."""
    start = np.arange(n - edge + 1)
    value, at = runs.of(start, start + edge), start
    span, have = window - edge + 1, 1
    while have < span:  # sliding minimum by doubling, leftmost on ties
        step = min(have, span - have)
        first = value[:-step] <= value[step:]
        value, at = np.where(first, value[:-step], value[step:]), np.where(first, at[:-step], at[step:])
        have += step
    return at


def _occurrences(window: int, edge: int):
    """Rows (edge, key, tag, pos, step, gap) of the kept edges of each text."""
    names = ["edge", "key", "tag", "pos", "step", "gap"]

    def run(batches):
        for part in slices(batches):
            held = []
            for k, tag, data in zip(*(c.to_pylist() for c in part.columns)):
                ws = (data or b"").split()
                n = len(ws)
                if n < window or k is None:
                    continue
                runs = Runs(word_hashes(ws))
                at = edges(runs, n, window, edge)
                pos = at[np.concatenate(([True], at[1:] != at[:-1]))]
                pos = np.unique(pos)
                gap = np.append(np.diff(pos), 0)
                step = runs.of(pos, np.append(pos[1:], pos[-1]) + edge)
                held.append((signed(runs.of(pos, pos + edge)), np.full(len(pos), k), np.full(len(pos), tag), pos, signed(step), gap))
            if held:
                columns = [pa.array(np.concatenate(c)) for c in zip(*held)]
                columns[3], columns[5] = columns[3].cast(pa.int32()), columns[5].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _paths(repeated: DataFrame) -> DataFrame:
    """Compacted unbranched paths that stand in an earlier document: key, tag,
    start and length in edges' words (``start``, ``reach``: start of the last edge)."""
    steps = repeated.filter("gap > 0")
    source = steps.groupBy("step").agg(F.min(F.struct("key", "tag", "pos")).alias("src"), F.count(F.lit(1)).alias("n"))
    source = source.filter("n > 1").select("step", F.col("src.key").alias("src_key"), F.col("src.tag").alias("src_tag"), F.col("src.pos").alias("src_pos"))
    copied = steps.join(source, "step").filter("src_key < key")
    by = W.partitionBy("key", "tag").orderBy("pos")
    ended = ((F.col(c) + F.col("gap")).alias(c) for c in ("src_pos", "pos"))
    before = F.lag(F.struct("src_key", "src_tag", *ended)).over(by)
    goes_on = F.coalesce(before == F.struct("src_key", "src_tag", "src_pos", "pos"), F.lit(False))
    numbered = copied.withColumn("goes_on", goes_on).withColumn("path", F.sum((~F.col("goes_on")).cast("int")).over(by))
    return numbered.groupBy("key", "tag", "path").agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.col("gap")).alias("reach"))


def _open_windows(window: int, edge: int):
    """Rows (h1, h2, key, tag, pos) of windows whose edge is repeated and that no
    compacted path covers."""

    def run(batches):
        for part in slices(batches):
            held = []
            for k, tag, data, at, paths in zip(*(c.to_pylist() for c in part.columns)):
                ws = data.split()
                n = len(ws)
                h = word_hashes(ws)
                runs = Runs(h)
                ask = np.isin(edges(runs, n, window, edge), at)
                for p in paths or ():
                    ask[p["start"] : max(p["start"], p["reach"] + edge - window + 1)] = False
                pos = np.flatnonzero(ask)
                if len(pos):
                    second = Runs(h, 1)
                    held.append((signed(runs.of(pos, pos + window)), signed(second.of(pos, pos + window)), np.full(len(pos), k), np.full(len(pos), tag), pos))
            if held:
                columns = [pa.array(np.concatenate(c)) for c in zip(*held)]
                columns[4] = columns[4].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "key", "tag", "pos"])

    return run


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, edge: int = EDGE):
    """(texts, spans): the narrow rows, and ``key``, ``tag`` and ``spans`` (first
    word, word after the last; sorted by first word) of those with words to remove."""
    texts = docs.select(
        F.col(key).cast("bigint").alias("key"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).cast("binary").alias("data")
    )
    context = docs.sparkSession.sparkContext
    found = in_batches(texts, _occurrences(window, edge), "edge bigint, key bigint, tag bigint, pos int, step bigint, gap int")
    found = materialise(found, "places")
    # an edge or a window may hold a third of all rows: their lows are aggregated in two
    # steps, and the joins that bring them back look up a key that is unique
    shared = found.groupBy("edge").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    shared = materialise(shared.select("edge"), "shared")
    known = context.broadcast(bitmap(shared, "edge"))
    repeated = found.filter(perhaps(known, "edge")).join(shared, "edge")
    repeated = materialise(repeated.drop("edge").distinct(), "edges")
    paths = materialise(_paths(repeated), "paths")

    at = repeated.groupBy("key", "tag").agg(F.collect_set("pos").alias("at"))
    listed = paths.groupBy("key", "tag").agg(F.collect_list(F.struct("start", "reach")).alias("paths"))
    state = at.join(listed, ["key", "tag"], "left")
    involved = context.broadcast(bitmap(repeated.select("key").distinct(), "key"))
    asked = texts.filter(perhaps(involved, "key")).dropDuplicates(["key", "tag"]).join(state, ["key", "tag"])
    asked = asked.select("key", "tag", "data", "at", "paths")
    windows = in_batches(asked, _open_windows(window, edge), "h1 bigint, h2 bigint, key bigint, tag bigint, pos int")
    windows = materialise(windows, "windows")
    lows = windows.groupBy("h1", "h2").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    lows = materialise(lows.drop("high"), "lows")
    later = windows.join(lows, ["h1", "h2"]).filter("low < key")
    spans = later.select("key", "tag", F.struct(F.col("pos").alias("start"), (F.col("pos") + window).alias("end")).alias("span"))
    # steps are shorter than a window or longer: only paths of a window or more cover windows
    whole = paths.withColumn("end", F.col("reach") + edge).filter(F.col("end") - F.col("start") >= window)
    spans = spans.unionByName(whole.select("key", "tag", F.struct("start", "end").alias("span")))
    spans = materialise(spans.groupBy("key", "tag").agg(F.sort_array(F.collect_list("span")).alias("spans")), "spans")
    for sent in (known, involved):
        sent.destroy()
    return texts, spans


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, edge: int = EDGE
) -> DataFrame:
    """``key``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by
    one space) of each row: every word is removed that lies in a window of
    ``window`` words which also starts in a row of a smaller key. Windows are
    judged on the input.

    Null and empty texts have no words; a row with a null key neither loses words
    nor takes any from others; rows of equal keys don't take from each other;
    repeated rows each give a row; other columns are not read.
    """
    texts, spans = repeats(docs, key, text, window, edge)
    hit = docs.sparkSession.sparkContext.broadcast(bitmap(spans.select("key").distinct(), "key"))

    def each(k, data, spans):
        ws = (data or b"").split()
        if not spans:
            return k, len(ws), 0, b" ".join(ws).decode()
        keep, at = [], 0
        for s in spans:
            keep += ws[at : max(at, s["start"])]
            at = max(at, s["end"])
        keep += ws[at:]
        return k, len(ws), len(ws) - len(keep), b" ".join(keep).decode()

    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    clean = texts.filter(~perhaps(hit, "key")).select("key", "data", none.alias("spans"))
    cut = texts.filter(perhaps(hit, "key")).join(spans, ["key", "tag"], "left").select("key", "data", "spans")
    ddl = "key bigint, n_words bigint, n_removed bigint, kept string"
    made = map_rows(clean, lambda: each, ddl).unionByName(map_rows(cut, lambda: each, ddl))
    return made.withColumnRenamed("key", key)
