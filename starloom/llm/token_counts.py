"""Token counts of texts under a sentence-piece model.

A map-side two-tier lookup. The model never joins a space to what stands before
it, so a text falls into pre-tokens (a run of spaces and the word after it) whose
token counts add up to that of the text. Pass one finds the frequent pre-tokens of
all texts with bounded summaries per task; their counts go to every worker as a
compact table. Pass two looks pre-tokens up there, and encodes the misses through a
cache of the worker. No pre-token is shuffled, only the bounded summaries.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import arrow_schema, in_batches, slices

#: Entries of the broadcast table, and of each task's summary: about 1 MB.
TABLE_ENTRIES = 32_768
#: Pre-tokens that a worker's cache holds at most, in two generations.
CACHE_ENTRIES = 400_000
#: Longer pre-tokens are encoded each time: neither table nor cache holds them.
LONGEST_KEPT = 64
#: Summaries meet in so many tasks before the driver reads them.
MERGERS = 24

_PIECES = re.compile(" *[^ ]+| +")


def pre_tokens(text: str) -> list[str]:
    """Keys of a text: each is encoded alone (the model puts one space before
    it), and the counts of all add up to that of the text. An empty key is one
    lone space."""
    if not text:
        return []
    if "▁" in text:  # the model's own sign for a space
        text = text.replace("▁", " ")
    if text[-1] != " " and text[0] != " " and "  " not in text:
        return text.split(" ")
    return [p[1:] for p in _PIECES.findall(" " + text)]


def _trim(seen: Counter, entries: int) -> Counter:
    return Counter(dict(seen.most_common(entries)))


def _summary(entries: int):
    def run(batches):
        seen: Counter = Counter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                seen.update(pre_tokens(text or ""))
            if len(seen) > 16 * entries:
                seen = _trim(seen, 4 * entries)
        yield _packed(seen, entries)

    return run


def _packed(seen: Counter, entries: int) -> pa.RecordBatch:
    kept = [(k, n) for k, n in seen.most_common(entries) if n > 1 and len(k) <= LONGEST_KEPT]
    return pa.RecordBatch.from_pydict({"summary": pa.array([zlib.compress(pickle.dumps(kept), 1)], pa.binary())})


def _merged(blobs, entries: int) -> Counter:
    total: Counter = Counter()
    for blob in blobs:
        for key, n in pickle.loads(zlib.decompress(blob)):
            total[key] += n
        if len(total) > 16 * entries:
            total = _trim(total, 4 * entries)
    return total


def frequent_pre_tokens(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> list[str]:
    """The most frequent pre-tokens over whole texts of all rows, by summaries of
    bounded size: a task trims its counts whenever they outgrow them. What the
    trimming loses only costs a cache lookup later."""

    def merge(batches):
        yield _packed(_merged((b for x in batches for b in x.column(0).to_pylist()), entries), entries)

    summaries = in_batches(docs.select(text), _summary(entries), "summary binary")
    met = in_batches(summaries.repartition(MERGERS), merge, "summary binary")
    total = _merged((r.summary for r in met.toLocalIterator()), entries)
    return [k for k, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:entries]]


class _Lengths(dict):
    """Token counts by pre-token: the broadcast table, and behind it the
    worker's cache in two generations."""

    def __init__(self, table: dict[str, int], model: str, entries: int):
        super().__init__(table)
        self.encode = sentencepiece.SentencePieceProcessor(model_file=model).encode
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.half = max(1, entries // 2)

    def __missing__(self, key: str) -> int:
        n = self.young.get(key)
        if n is not None:
            return n
        n = self.old.get(key)
        if n is None:
            n = len(self.encode(key)) if key else 1
        if len(key) <= LONGEST_KEPT:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[key] = n
        return n


def count_tokens(
    docs: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    entries: int = TABLE_ENTRIES,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row.

    Null and empty texts have no bytes and no tokens; a null key stays null;
    repeated rows each give a row; other columns are not read.
    """
    spark = docs.sparkSession
    encode = sentencepiece.SentencePieceProcessor(model_file=model).encode
    table = {k: len(encode(k)) if k else 1 for k in frequent_pre_tokens(docs, text, entries)}
    shared = spark.sparkContext.broadcast(table)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ddl = f"key {narrow.schema['key'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    schema = arrow_schema(ddl)

    def run(batches):
        lengths = _Lengths(shared.value, model, cache_entries)
        look = lengths.__getitem__
        for part in slices(batches):
            texts = part.column(1)
            counts = [sum(map(look, pre_tokens(t))) if t else 0 for t in texts.to_pylist()]
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([part.column(0), n_bytes, pa.array(counts, pa.int64())], schema=schema)

    return in_batches(narrow, run, ddl).select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
