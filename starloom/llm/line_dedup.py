"""Removal of repeated lines, equal or within a few edits.

How many edits are allowed follows the length of the shorter line: one for every
``PER_EDIT`` characters, up to a given number; below, equal lines link, through their ids.

Lines within e edits: if the shorter is split into e + 1 segments, one of them stands
unchanged in the longer, near its place. Every line is indexed by its segments (with
its length and the segment's number) and probes, for each length that a shorter
partner can have, the substrings at the places that a segment can have moved to,
chosen so that no pair within the limit is missed and few are probed twice. What meets
is verified with a banded bit-parallel edit distance.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import arrow_schema, free_names, in_batches, slices
from starloom.llm.components import POSTINGS, Poster, filter_pairs, linked_components, shared_buckets
from starloom.llm.hashing import Runs, mix
from starloom.llm.membership import bitmap, perhaps
from starloom.operators.lookup import spread_join

EDITS = 2
#: Characters of the shorter line for each edit that is allowed.
PER_EDIT = 16
#: Characters whose lines are signed together.
TOGETHER = 400_000
#: Lines whose marks a task remembers.
MARKS_KEPT = 50_000


def compared(line: str) -> str:
    """What of a line is compared: all but white space at its ends."""
    return line.strip(" \t\r\v\f")


def line_id(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the segments: as even as can be, the longer ones last."""
    short, longer = divmod(length, edits + 1)
    sizes = [short] * (edits + 1 - longer) + [short + 1] * longer
    return [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def allowed(length, edits: int):
    """Edits within which a line of this length links with one as long or longer."""
    return np.minimum(edits, np.asarray(length) // PER_EDIT)


@lru_cache(4096)
def _probes(n: int, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and seeds of the substrings that a line of n characters signs: its
    own segments, and its probes into lines of up to ``edits`` characters less."""
    found = []
    for length in range(max(n - edits, 0), n + 1):
        more, limit = n - length, int(allowed(length, edits))
        if limit < max(more, 1):
            continue
        for i, (start, size) in enumerate(segments(length, limit)):
            low = max(start - i, start + more - (limit - i), 0)
            high = min(start + i, start + more + (limit - i), n - size)
            found += [(at, at + size, length * 64 + i) for at in range(low, high + 1)]
    start, end, seed = np.array(found, np.int64).reshape(-1, 3).T
    return start, end, mix(seed.astype(np.uint64))


def signatures(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of lines, and for each the place of its line."""
    length = np.array([len(x) for x in lines])
    base = np.cumsum(length) - length
    runs = Runs(mix(np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)))
    order = np.argsort(length, kind="stable")
    sigs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        start, end, seed = _probes(int(length[at[0]]), edits)
        own = base[at][:, None]
        sigs.append(mix(runs.of((own + start).ravel(), (own + end).ravel()) ^ np.tile(seed, len(at))))
        places.append(np.repeat(at, len(seed)))
    return np.concatenate(sigs), np.concatenate(places)


def mark(line: str) -> bytes:
    """Length, and parities of the characters and of the pairs of characters, 64 bits each."""
    raw = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    pairs = (raw[1:] * np.uint64(0x9E3779B97F4A7C15) + raw[:-1] * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(58)
    out = len(line).to_bytes(8, "little")
    for values in (raw & np.uint64(63), pairs):
        odd = np.bincount(values.astype(np.int64), minlength=64) & 1
        out += np.packbits(odd.astype(np.uint8)).tobytes()
    return out


def table(marks: list[bytes]):
    """Lengths and both parities of marks."""
    return np.frombuffer(b"".join(marks), np.uint64).reshape(-1, 3).T.copy()


def near(held, i: np.ndarray, j: np.ndarray, edits: int) -> np.ndarray:
    """Which of the pairs of places can link by their marks: an edit changes two
    characters and four pairs of characters at most."""
    n, chars, pairs = held
    n = n.astype(np.int64)
    most = allowed(np.minimum(n[i], n[j]), edits)
    good = np.abs(n[i] - n[j]) <= most
    good &= np.bitwise_count(chars[i] ^ chars[j]) <= 2 * most
    return good & (np.bitwise_count(pairs[i] ^ pairs[j]) <= 4 * most)


def within(a: str, b: str, edits: int) -> bool:
    """Edit distance of at most ``edits``: the set of reachable diagonals for each
    number of edits as a few bits, one step for each character."""
    if abs(len(a) - len(b)) > edits:
        return False
    n = len(commonprefix((a, b)))
    a, b = a[n:], b[n:]
    n = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - n], b[: len(b) - n]
    width = (1 << (2 * edits + 1)) - 1  # bit e: a is ahead of b by e - edits characters
    reach = [((1 << (d + 1)) - 1) << edits & width for d in range(edits + 1)]
    for j, c in enumerate(b):
        same = 0
        for e in range(max(0, edits - j), min(2 * edits, len(a) - 1 - j + edits) + 1):
            same |= (a[j + e - edits] == c) << e
        before, new = 0, 0
        for d in range(edits + 1):
            # equal; changed or left out of a, from one edit less; one more of a, within this step
            new = (reach[d] & same) | before | before >> 1 | new << 1
            before, reach[d] = reach[d], new & width
            new = reach[d]
        if not any(reach):
            return False
    end = len(a) - len(b) + edits
    return any(r >> end & 1 for r in reach)


def linked(a: str, b: str, edits: int) -> bool:
    return within(a, b, int(allowed(min(len(a), len(b)), edits)))


def _postings(edits: int):
    def run(batches):
        posted, seen = Poster(), set()
        lines, ids, chars = [], [], 0

        def sign():
            sigs, places = signatures(lines, edits)
            return posted.add(sigs, np.array(ids, np.int64)[places])

        for part in slices(batches):
            for text in part.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    line = compared(line)
                    if len(line) < PER_EDIT or (own := line_id(line)) in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(own)
                    lines.append(line)
                    ids.append(own)
                    chars += len(line)
                    if chars > TOGETHER:
                        full = sign()
                        lines, ids, chars = [], [], 0
                        if full:
                            yield posted.take()
        if lines:
            sign()
        yield posted.take()

    return run


LINES = "id bigint, key bigint, tag bigint, no int, line string, mark binary"


def _lines(wanted):
    """Rows of the lines compared; line and mark only for those wanted."""
    schema = arrow_schema(LINES)

    def run(batches):
        known: dict[int, bytes] = {}
        for part in slices(batches):
            made = []
            for k, tag, text in zip(*(c.to_pylist() for c in part.columns)):
                for no, line in enumerate((text or "").split("\n") if k is not None else ()):
                    line = compared(line)
                    if not line:
                        continue
                    own = line_id(line)
                    if len(line) < PER_EDIT or own not in wanted.value:
                        made.append((own, k, tag, no, None, None))
                        continue
                    if own not in known:
                        if len(known) > MARKS_KEPT:
                            known.clear()
                        known[own] = mark(line)
                    made.append((own, k, tag, no, line, known[own]))
            if made:
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*made), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """``key``, ``tag`` (hash of the text) and ``removed`` (line numbers from 0):
    lines that link, over any number of steps, with one that stands earlier (smaller
    key, then line number)."""
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))
    context = docs.sparkSession.sparkContext
    posted = in_batches(texts.filter("key IS NOT NULL").select("text"), _postings(edits), POSTINGS)
    buckets = materialise(shared_buckets(posted), "buckets")
    wanted = context.broadcast(bitmap(buckets.select("id").distinct(), "id"))
    lines = materialise(in_batches(texts, _lines(wanted), LINES), "lines")
    wanted.destroy()
    items = lines.filter("line IS NOT NULL").groupBy("id").agg(F.first("line").alias("line"), F.first("mark").alias("mark"))
    items = materialise(items.join(buckets.select("id").distinct(), "id", "left_semi"), "items")
    lane = F.floor(F.length("line") / (edits + 1)).cast("bigint").alias("lane")
    comp = linked_components(
        buckets,
        lambda pairs: filter_pairs(pairs, items, "line", lambda xs, ys: [linked(x, y, edits) for x, y in zip(xs, ys)]),
        items.select("id", lane, "mark"),
        table,
        lambda held, i, j: near(held, i, j, edits),
    )
    # a line or a group of lines may hold a third of all rows: both joins spread such keys
    at = F.struct("key", "tag", "no").alias("at")
    placed = spread_join(lines.filter("line IS NOT NULL").select("id", at), comp, ["id"]).select("at", F.coalesce("comp", "id").alias("comp"))
    placed = placed.unionByName(lines.filter("line IS NULL").select(at, F.col("id").alias("comp")))
    placed = materialise(placed, "placed")
    firsts = placed.groupBy("comp").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter("first < last")
    later = spread_join(placed, firsts.select("comp", "first"), ["comp"], "inner", census=placed).filter("first < at")
    return later.groupBy("at.key", "at.tag").agg(F.sort_array(F.collect_set("at.no")).alias("removed"))


def _cut(docs: DataFrame, key: str, text: str, edits: int) -> tuple[DataFrame, str]:
    """``docs`` and, in one more column of the name returned, the numbers of the lines
    to take out (null: none)."""
    spot, tag, gone = free_names(docs, "spot", "tag", "gone")
    removed = materialise(repeated_lines(docs, key, text, edits), "removed")
    hit = docs.sparkSession.sparkContext.broadcast(bitmap(removed.select("key"), "key"))
    removed = removed.toDF(spot, tag, gone)
    clean = docs.filter(~perhaps(hit, key)).withColumn(gone, F.lit(None).cast("array<int>"))
    on = (F.col(key).cast("bigint") == F.col(spot)) & (F.xxhash64(F.col(text)) == F.col(tag))
    cut = docs.filter(perhaps(hit, key)).join(removed, on, "left").drop(spot, tag)
    return clean.unionByName(cut), gone


def _kept(text: str, gone: str):
    return F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains(gone, i.cast("int")))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """All rows and columns of ``docs``, with repeated lines taken out of ``text``,
    and two more columns: ``n_lines`` (lines of the text as given) and ``n_removed``.

    The first of each group of lines stays. Blank lines are never removed. A null text
    stays null and has no lines, an empty one has one; a text whose lines all go is
    empty. A row with a null key neither loses lines nor takes any from others; repeated
    rows count as one and lose the same lines. Columns of ``docs`` called like the two
    new ones are replaced; others keep their values.
    """
    found, gone = _cut(docs, key, text, edits)
    lines = F.split(F.col(text), "\n", -1)
    return found.withColumns(
        {
            "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("bigint"),
            "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("bigint"),
            text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(_kept(text, gone), "\n")),
        }
    ).drop(gone)


def strip_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, length: str | None = None) -> DataFrame:
    """The rows and columns of ``docs`` with repeated lines taken out of ``text``, as by
    :func:`dedup_lines`; the column ``length``, if named, follows where lines went. A row
    that loses lines and keeps no other than blank ones goes: all it said stands earlier."""
    found, gone = _cut(docs, key, text, edits)
    blank = F.forall(_kept(text, gone), lambda line: line.rlike(r"^[ \t\r\x0B\f]*$"))
    found = found.filter(F.col(gone).isNull() | ~blank)
    found = found.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(_kept(text, gone), "\n")))
    if length is not None:
        kind = docs.schema[length].dataType
        found = found.withColumn(length, F.when(F.col(gone).isNull(), F.col(length)).otherwise(F.length(text).cast(kind)))
    return found.select(*docs.columns)
