"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds the normalised words of the test items in blocks of seven words,
at every seventh word. Any run of thirteen words of an item holds one whole block, so
a single scan of a normalised text meets every copied window; from each block found,
the agreement with the item is followed both ways, and a run of thirteen words or
more marks its words. The automaton is no larger than the items themselves, where one
of all windows would be thirteen times that. Hit words are mapped back to the text.

Items beyond ``AUTOMATON_BYTES`` are dealt over several automata. A task then takes its
texts in lots, and scans each lot with one automaton after the other, so that an
automaton is built once for a lot, which costs little beside the scan of it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import arrow_schema, in_batches, slices

WINDOW = 13
#: Bytes of items in one automaton (about 60 times that in memory).
AUTOMATON_BYTES = 1 << 20
#: Bytes of texts that a task scans together where there are several automata.
LOT_BYTES = 16 << 20

_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) runs of digits, letters and non-ASCII characters."""
    return data.translate(_NORMAL).split()


def _joined(ws: list[bytes]) -> str:
    return (b" " + b" ".join(ws) + b" ").decode("latin-1")


class Matcher:
    """Windows of ``items`` ((id, words) each) in texts."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.items, self.window, block = items, window, (window + 1) // 2
        places: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for i, (_, ws) in enumerate(items):
            if 0 < len(ws) < window:
                places[_joined(ws)].append((i, 0, len(ws)))
            for at in range(0, len(ws) - block + 1, block) if len(ws) >= window else ():
                places[_joined(ws[at : at + block])].append((i, at, block))
        self.automaton = ahocorasick.Automaton()
        for text, where in places.items():
            self.automaton.add_word(text, where)
        if places:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def runs(self, ws: list[bytes]) -> list[tuple[int, int, int]]:
        """(first word, word after the last, item) of every run of a window or more."""
        if self.automaton is None or not ws:
            return []
        joined = _joined(ws)
        found = list(self.automaton.iter(joined))
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 0x20)
        lasts = np.searchsorted(spaces, [end for end, _ in found]).tolist()
        out, seen = [], {}  # seen: where the last run on the same diagonal ended
        for stop, (_, where) in zip(lasts, found):
            for item, offset, length in where:
                theirs, a = self.items[item][1], stop - length
                b, shift = stop, stop - length - offset
                if seen.get((item, shift), 0) >= stop:
                    continue
                while a > 0 and a - shift > 0 and ws[a - 1] == theirs[a - 1 - shift]:
                    a -= 1
                while b < len(ws) and b - shift < len(theirs) and ws[b] == theirs[b - shift]:
                    b += 1
                seen[item, shift] = b
                if b - a >= min(self.window, len(theirs)):
                    out.append((a, b, item))
        return out


def _spans(data: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets of runs of hit words in the text itself."""
    at = np.array([m.span() for m in _WORD.finditer(data)])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [(int(points[at[a][0]]), int(points[at[b - 1][1]])) for a, b in zip(edges[::2], edges[1::2])]


def _blocks(benchmark: DataFrame, item: str, text: str, most: int):
    """The items in lists of at most about ``most`` bytes, one at a time."""
    sized = benchmark.select(F.col(item).cast("string").alias("id"), F.col(text).cast("binary").alias("data")).filter(
        "octet_length(data) > 0"
    )
    total = sized.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n = -(-total // most) or 1
    for k in range(n):
        part = sized.filter(F.pmod(F.xxhash64("id", "data"), F.lit(n)) == k) if n > 1 else sized
        yield [(r.id, words(bytes(r.data))) for r in part.toLocalIterator()]


def _scan(lot: list[bytes | None], blocks) -> list[tuple[int, np.ndarray | None, set]]:
    """For each text its number of words, its hit words (None: none), and the ids of
    the items that hit."""
    texts = [words(data or b"") for data in lot]
    hits: list[np.ndarray | None] = [None] * len(lot)
    ids: list[set] = [set() for _ in lot]
    for matcher in blocks:
        for at, ws in enumerate(texts):
            for a, b, i in matcher.runs(ws):
                if hits[at] is None:
                    hits[at] = np.zeros(len(ws), bool)
                hits[at][a:b] = True
                ids[at].add(matcher.items[i][0])
    return [(len(ws), hit, found) for ws, hit, found in zip(texts, hits, ids)]


def _scanner(docs: DataFrame, benchmark: DataFrame, item: str, item_text: str, window: int, automaton_bytes: int):
    """For tasks: what gives lots of texts and their findings, in order, from an
    iterable of (texts, anything that goes with them)."""
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in _blocks(benchmark, item, item_text, automaton_bytes)]

    def scan(parts):
        one = [Matcher(blocks[0].value, window)] if len(blocks) == 1 else None
        if one:
            for texts, extra in parts:
                yield extra, _scan(texts, one)
            return
        held, size = [], 0

        def findings():
            found = iter(_scan([t for texts, _ in held for t in texts], (Matcher(b.value, window) for b in blocks)))
            for texts, extra in held:
                yield extra, [next(found) for _ in texts]

        for texts, extra in parts:
            held.append((texts, extra))
            size += sum(len(t or b"") for t in texts)
            if size > LOT_BYTES:
                yield from findings()
                held, size = [], 0
        if held:
            yield from findings()

    return scan


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``items`` (ids as strings, sorted, of items with
    occurring windows) and ``spans`` (code-point offsets of runs of hit words).

    A window is ``window`` consecutive words of an item, or all of a shorter one.
    Null and empty texts have no words; items without words have no windows; an
    item with a null id hits but is not listed; equal ids are listed once. A null
    key stays null and repeated rows each give a row; other columns are not read.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))
    scan = _scanner(docs, benchmark, item, item_text, window, automaton_bytes)
    ddl = (
        f"key {narrow.schema['key'].dataType.simpleString()}, n_words bigint, n_hit bigint, "
        "items array<string>, spans array<struct<start: bigint, end: bigint>>"
    )
    schema = arrow_schema(ddl)

    def row(k, data, n, hit, ids):
        if hit is None:
            return k, n, 0, [], []
        spans = [{"start": a, "end": b} for a, b in _spans(data, hit)]
        return k, n, int(hit.sum()), sorted(ids - {None}), spans

    def run(batches):
        parts = ((c[1], c) for c in ([x.to_pylist() for x in part.columns] for part in slices(batches)))
        for (keys, texts), found in scan(parts):
            made = [row(k, data, *f) for k, data, f in zip(keys, texts, found)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    return in_batches(narrow, run, ddl).withColumnRenamed("key", key)


def is_contaminated(share: int = 20):
    """One word in ``share`` or more is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """The rows, with all their columns, of which less than one word in ``share``
    lies in an occurrence of a window. Null, empty and other texts without words stay,
    and so does every text if the benchmark has no words; repeated rows fare alike."""
    scan = _scanner(docs, benchmark, item, item_text, window, automaton_bytes)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for _, found in scan((list(lot), None) for lot in texts):
            yield pd.Series([hit is None or share * int(hit.sum()) < n for n, hit, _ in found], dtype=bool)

    return docs.filter(clean(F.col(text).cast("binary")))
