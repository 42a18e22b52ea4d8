"""Grouping of spelling variants in a frequency-vector trie.

Words are arranged by how often each group of letters occurs in them, group by group,
the most frequent letters first. Words one edit apart differ by at most one letter too
many and one too few, so a depth-first search with a budget of one surplus and one
deficit meets all of them; the words of the leaves it reaches are verified.

The upper levels of the trie are dealt over tasks: a word goes to the node of its own
length and counts, and to the nodes of those with one letter less, where it meets each
word near it exactly once. Each task builds the lower levels for the words of a node
and searches them for all of these words at once. A node of more than ``CELL`` words
is dealt over cells of two blocks each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import arrow_schema, in_batches, slices
from starloom.llm.hashing import mix
from starloom.operators.lookup import spread_join

LEAST_CHARS = 5
LEAST_COUNT = 3
#: A form occurs so many times as often as its variant, at least.
TIMES = 2
#: Letters (one group each) whose counts deal words over tasks, and groups of a task's trie.
ROUTED = 8
LOWER = 16
#: Words of a trie node that is not split further.
LEAF = 16
CELL = 4096
#: Rows that a task searches together, and entries of its counters.
TOGETHER = 60_000
ENTRIES = 300_000
#: Longer words are verified one by one.
WIDTH = 48
#: Pairs verified together.
PAIRS = 40_000

_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")


def _counted(damage: int):
    """(word, n) of the runs of letters in a task's texts."""
    schema = arrow_schema("word string, n bigint")

    def packed(total):
        kept = [(w, n) for w, n in ((w.decode(), n) for w, n in total.items()) if len(w) >= LEAST_CHARS]
        return pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], f.type) for i, f in enumerate(schema)], schema=schema)

    def run(batches):
        total: Counter = Counter()
        for part in slices(batches):
            for key, text in zip(*(c.to_pylist() for c in part.columns)):
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(_RUN.findall((text or "").encode().lower())).items():
                    if len(word) < LEAST_CHARS:
                        continue
                    if damage and (h := zlib.crc32(word, start)) % damage == 0:
                        chars = word.decode()
                        at = h % len(chars)
                        word = (chars[:at] + chars[at + 1 :]).encode()
                    total[word] += n
            if len(total) > ENTRIES:
                yield packed(total)
                total = Counter()
        yield packed(total)

    return run


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = 0) -> DataFrame:
    """(word, n): runs of letters (A-Z as a-z, and U+00C0 to U+00FF) of ``LEAST_CHARS`` or
    more that occur ``LEAST_COUNT`` times or more. With ``damage``, a run loses a letter
    in texts where ``damage`` divides the CRC-32 of "key:run" (a null key is empty), at
    that place modulo its length. A null text has no words."""
    counts = in_batches(docs.select(F.col(key).cast("string"), F.col(text)), _counted(damage), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def letter_order(words: DataFrame) -> list[str]:
    """Letters by how many words have them, most first; at most 90."""

    def run(batches):
        seen: Counter = Counter()
        for part in slices(batches):
            for word in part.column(0).to_pylist():
                seen.update(set(word))
        yield pa.RecordBatch.from_pydict({"letter": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    seen = in_batches(words.select("word"), run, "letter string, n bigint").groupBy("letter").agg(F.sum("n").alias("n"))
    return [r.letter for r in seen.orderBy(F.desc("n"), "letter").collect()]


def groups_of(order: list[str]) -> np.ndarray:
    """Group of each letter by its code: the first letters each have their own, the
    others share the last four."""
    out = np.zeros(256, np.int64)
    own = ROUTED + LOWER - 4
    for k, letter in enumerate(order):
        out[ord(letter)] = k if k < own else own + k % 4
    return out


def vectors(words: list[str], group: np.ndarray) -> np.ndarray:
    """Counts of the letter groups of each word."""
    n = ROUTED + LOWER
    length = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    at = np.repeat(np.arange(len(words)), length) * n + group[letters]
    return np.bincount(at, minlength=n * len(words)).reshape(-1, n)


_TIMES = mix(np.arange(1, ROUTED + 2, dtype=np.uint64)) | np.uint64(1)
ROUTES = "node bigint, hole tinyint, word string, n bigint"


def _routes(group):
    """Rows of each word: at its own node (hole -1), and at that of each word with a
    letter less (hole: the routed letter, or ROUTED for any other)."""
    schema = arrow_schema(ROUTES)

    def run(batches):
        for part in slices(batches, 8192):
            words, n = part.column(0).to_pylist(), part.column(1).to_numpy()
            length = np.array([len(w) for w in words], np.int64)
            top = vectors(words, group)[:, :ROUTED]
            full = np.column_stack((top, length - top.sum(1))).astype(np.uint64)
            node = (full * _TIMES).sum(1, dtype=np.uint64)  # a hole takes its letter's share off
            nodes, holes, at = [node], [np.full(len(words), -1)], [np.arange(len(words))]
            for k in range(ROUTED + 1):
                has = np.flatnonzero(full[:, k])
                nodes.append(node[has] - _TIMES[k])
                holes.append(np.full(len(has), k))
                at.append(has)
            at = np.concatenate(at)
            columns = [
                pa.array(mix(np.concatenate(nodes)).view(np.int64)),
                pa.array(np.concatenate(holes), pa.int8()),
                pa.array(words, pa.string()).take(pa.array(at)),
                pa.array(n[at]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def search(low: np.ndarray):
    """Places i < j of the words that meet in the leaves of a trie over the counts
    ``low`` (a row for each word), each looked for with one surplus and one deficit; as
    arrays of two rows."""
    every = np.arange(len(low))
    ones = np.ones(len(low), np.int64)
    stack = [(0, every, every, ones, ones)]
    while stack:
        level, words, asked, surplus, deficit = stack.pop()
        if len(words) <= LEAF or level == low.shape[1]:
            for some in np.array_split(asked, len(asked) * len(words) // PAIRS + 1):
                met = np.stack((np.repeat(some, len(words)), np.tile(words, len(some))))
                yield met[:, met[0] < met[1]]
            continue
        here = low[words, level]
        asks = low[asked, level]
        for count in np.unique(here).tolist():
            more = count - asks  # the words below have so many more than is asked for
            s, d = surplus - (more == 1), deficit - (more == -1)
            alive = (np.abs(more) <= 1) & (s >= 0) & (d >= 0)
            if alive.any():
                stack.append((level + 1, words[here == count], asked[alive], s[alive], d[alive]))


def one_edit(table: np.ndarray, length: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i and j (rows of letters, zeros behind) are exactly one edit apart."""
    swap = length[i] > length[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)  # j is as long or longer
    a, b = table[i], table[j]
    longer = length[j] - length[i]
    same = a == b
    out = (longer == 0) & (same.shape[1] - same.sum(1) == 1)
    at = np.flatnonzero(longer == 1)
    # equal up to a place, and from there on with the longer word's next letter
    before = np.logical_and.accumulate(same[at, :-1], 1).sum(1)
    moved = a[at, :-1] == b[at, 1:]
    behind = np.logical_and.accumulate(moved[:, ::-1], 1).sum(1)
    out[at] = before + behind >= same.shape[1] - 1
    return out


def one_edit_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    n = len(commonprefix((a, b)))
    return a != b and (a[n + 1 :] == b[n + 1 :] if len(a) == len(b) else a[n:] == b[n + 1 :])


#: All pairs of a leaf of so many words.
_EACH = [np.stack(np.triu_indices(n, 1)) for n in range(LEAF + 1)]
NEAR = "word string, n_near bigint, top bigint, best string"


def _near(group):
    """For each word of a node, how many words near it meet it there, and the best: the
    one that occurs most, the first of those by code points."""
    schema = arrow_schema(NEAR)

    def pairs(words, holes, node, cells):
        """Verified pairs of the nodes of which these are all rows."""
        all_counts = vectors(words, group)
        length = np.array([len(w) for w in words], np.int64)
        short = length < WIDTH
        table = np.zeros((len(words), WIDTH), np.uint8)
        flat = np.frombuffer("".join(w for w in words if len(w) < WIDTH).encode("latin-1"), np.uint8)
        filled = np.arange(WIDTH)[None] < np.where(short, length, 0)[:, None]
        table[filled] = flat
        reduced = np.column_stack((all_counts[:, :ROUTED], length))
        has = np.flatnonzero(holes >= 0)
        reduced[has, ROUTED] -= 1
        own = has[holes[has] < ROUTED]
        reduced[own, holes[own]] -= 1
        starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        ends = np.append(starts[1:], len(words))
        waiting, n = [], 0

        def verified():
            i, j = np.concatenate(waiting, 1)
            blocks, i_no, j_no = cells
            good = (holes[i] != holes[j]) | (holes[i] < 0)
            good &= (i_no[i] == j_no[i]) | (blocks[i] != blocks[j])
            good &= np.abs(length[i] - length[j]) <= 1
            i, j = i[good], j[good]
            good = (reduced[i] == reduced[j]).all(1)
            i, j = i[good], j[good]
            good = np.zeros(len(i), bool)
            quick = np.flatnonzero(short[i] & short[j])
            for part in np.array_split(quick, max(1, len(quick) // PAIRS)):
                good[part] = one_edit(table, length, i[part], j[part])
            for k in np.flatnonzero(~(short[i] & short[j])).tolist():
                good[k] = one_edit_apart(words[i[k]], words[j[k]])
            return i[good], j[good]

        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a == 1:
                continue
            for met in (_EACH[b - a],) if b - a <= LEAF else search(all_counts[a:b, ROUTED:]):
                waiting.append(met + a)
                n += met.shape[1]
                if n > 10 * PAIRS:
                    yield verified()
                    waiting, n = [], 0
        if waiting:
            yield verified()

    def summed(words, counts, node, holes, cells):
        near: dict[str, list] = {}
        for i, j in pairs(words, holes, node, cells):
            for x, y in zip(np.concatenate((i, j)).tolist(), np.concatenate((j, i)).tolist()):
                other = (-counts[y], words[y])
                held = near.get(words[x])
                if held is None:
                    near[words[x]] = [1, other]
                else:
                    held[0] += 1
                    held[1] = min(held[1], other)
        rows = [(w, n, -top, best) for w, (n, (top, best)) in near.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < TOGETHER:
                continue
            last = _cell_numbers(held)
            whole = int(np.searchsorted(last, last[-1]))  # the last node may go on
            if whole:
                yield searched(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield searched(held)

    def _cell_numbers(table):
        """Rows of one cell of one node get one number, rising."""
        keys = np.stack([table.column(k).to_numpy() for k in ("node", "i", "j")])
        return np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(0))))

    def searched(table):
        column = {c: table.column(c).to_numpy() for c in ("hole", "n", "i", "j", "block")}
        cells = (column["block"], column["i"], column["j"])
        words = table.column("word").to_pylist()
        return summed(words, column["n"].tolist(), _cell_numbers(table), column["hole"].astype(np.int64), cells)

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, top, best) of the words (word, n) that have others one edit away;
    ``best`` is that of the largest n (``top``), the first by code points among those."""
    group = groups_of(letter_order(words))
    routes = in_batches(words.select("word", "n"), _routes(group), ROUTES)
    routes = materialise(routes, "routes")
    parts = routes.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("parts")).filter("parts > 1")
    parts = materialise(parts, "parts")
    zero = F.lit(0).cast("bigint")
    if parts.isEmpty():
        cells = routes.select("*", *(zero.alias(c) for c in ("i", "j", "block")))
    else:
        laid = routes.join(parts, "node", "left").withColumn("parts", F.coalesce("parts", F.lit(1)).cast("bigint"))
        laid = laid.withColumn("block", F.pmod(F.xxhash64("word"), F.col("parts")))
        laid = laid.withColumn("x", F.explode(F.sequence(zero, F.col("parts") - 1)))
        cells = laid.select("node", "hole", "word", "n", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "block")
    dealt = cells.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    found = in_batches(dealt, _near(group), NEAR)
    best = F.min(F.struct((-F.col("top")).alias("less"), "best")).alias("first")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("first.less")).alias("top"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form; no circles): where the forms
    end. Each round doubles how far every word has got."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        # a form of very many words is a hot key of this join
        step = spread_join(at, at.toDF("root", "next"), ["root"], census=at)
        step = materialise(step, "step")
        at = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.filter("next IS NOT NULL").isEmpty():
            return at


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = 0) -> DataFrame:
    """A row per word of :func:`vocabulary`: ``word``, ``form`` (the near word that occurs
    most, if ``TIMES`` times as often or more, else null; ties go to the first by code
    points), ``root`` (from the word, forms followed to the last; the word itself if it
    has none), ``n``, ``n_near`` (words exactly one letter inserted, deleted or replaced
    away) and ``form_n`` (the form's n or null).

    Null and empty texts have no words; repeated rows count each time; without a word
    there is no row. Other columns are not read.
    """
    words = materialise(vocabulary(docs, key, text, damage), "words")
    near = words.join(near_words(words), "word", "left")
    has = F.col("top") >= TIMES * F.col("n")
    near = near.withColumns({"form": F.when(has, F.col("best")), "form_n": F.when(has, F.col("top"))})
    near = materialise(near, "near")
    found = near.join(roots(near.filter("form IS NOT NULL")), "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )
