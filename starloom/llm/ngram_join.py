"""Jaccard join of word n-gram sets by prefixes of token combinations.

Tokens are hashed shingles in a global order: rare ones first, by hash, then those of
the frequent classes, class by class. A set of n tokens can miss at most
floor((1 - threshold) * n) of them in a set that it links with, so its prefix goes on
until it has one unit more than that. A rare token is a unit and a signature by
itself. Of c tokens in a frequent class, c - 1 are units, and every combination of two
is a signature: if fewer than c - 1 are missed, two are shared. Prefixes are extended
over as many classes as that takes. Linked sets therefore share a signature; what
shares one is tested exactly.

Frequent tokens are dealt over classes by hash, about two to four of a set to a class,
so that the number of combinations stays in proportion to the set. That number of
classes depends on a set's size, so sets sign for every size level that a smaller
partner can have.

Which tokens count as frequent is found over all texts; it decides how many
candidates there are, never which sets link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import free_names, in_batches
from starloom.llm.bounded import most_frequent
from starloom.llm.hashing import mix, signed
from starloom.llm.membership import bitmap, perhaps
from starloom.llm.set_join import narrowed, set_components, sets_once
from starloom.llm.shingles import mark, near, table

SHINGLE = 5
PERCENT = 80
#: A token that can be a signature of more sets than this is frequent ...
RARE_SETS = 8
#: ... or of twice, four times, ... as many, until the frequent ones fit in 16 MB.
FREQUENT_TOKENS = 2_000_000


def misses(n: int, percent: int) -> int:
    """Tokens of n that may be missing in a linked set."""
    return n - -(-percent * n // 100)


def classes(level: int, percent: int) -> int:
    """Classes of frequent tokens in sets of 2 ** (level - 1) tokens or more: about a
    quarter as many, and so few that their units always suffice. None: every token is
    a unit and a signature by itself."""
    return min(1 << max(level - 2, 0), -(-percent * (1 << level - 1) // 100) - 1)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a set; sets that link but are not equal share one."""
    if not len(tokens):
        return tokens
    units = misses(len(tokens), percent) + 1
    often = _among(tokens, frequent)
    rare = tokens[~often][:units]
    if len(rare) == units:
        return rare
    out, units = [rare], units - len(rare)
    common = mix(tokens[often])  # the class comes from other bits than the order
    for level in range(int(-(-percent * len(tokens) // 100)).bit_length(), len(tokens).bit_length() + 1):
        of = classes(level, percent)
        if of < 1:
            out.append(mix(common[np.argsort(common)][:units] + np.uint64(level)))
            continue
        of = common % np.uint64(of)
        order = np.lexsort((common, of))
        c, of = common[order], of[order]
        start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        count = np.diff(np.append(start, len(c)))
        enough = int(np.searchsorted(np.cumsum(count - 1), units)) + 1
        for a, n in zip(start[:enough].tolist(), count[:enough].tolist()):
            i, j = np.triu_indices(n, 1)
            out.append(mix(c[a + i] * np.uint64(3) + mix(c[a + j]) + np.uint64(level)))
    return np.concatenate(out)


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(tokens), bool)
    return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens


def _reach(tokens: np.ndarray, percent: int) -> tuple[int, int]:
    """Units that a prefix needs, and how far the first count of tokens looks."""
    units = misses(len(tokens), percent) + 1
    return units, units + units // 2


def _often(counted: DataFrame, rare_sets: int, most: int) -> np.ndarray:
    """Sorted tokens counted over ``rare_sets`` times, or over the next doubling
    of that which leaves at most ``most`` of them."""
    kept = most_frequent(counted, "token", rare_sets, most).toPandas()
    return np.sort(kept["token"].to_numpy(np.int64).view(np.uint64))


def frequent_tokens(texts: DataFrame, size: int, percent: int, rare_sets: int, most: int) -> np.ndarray:
    """Sorted frequent tokens, counted over all texts where they can be signatures:
    first within one and a half prefixes of each set, then, for sets which frequent
    tokens push further than that, in the rest."""
    context = texts.sparkSession.sparkContext

    def count(chosen):
        def run(batches):
            held, n = [], 0
            for tokens, _ in sets_once(batches, size):
                held.append(chosen(tokens))
                n += len(held[-1])
                if n > 500_000:
                    yield packed(held)
                    held, n = [], 0
            if held:
                yield packed(held)

        return in_batches(texts, run, "token bigint, n bigint")

    def packed(held):
        tokens, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(signed(tokens)), pa.array(count)], names=["token", "n"])

    first = _often(count(lambda tokens: tokens[: _reach(tokens, percent)[1]]), rare_sets, most // 2)
    sent = context.broadcast(first)

    def rest(tokens):
        units, reach = _reach(tokens, percent)
        rare = ~_among(tokens, sent.value)
        return tokens[reach:][rare[reach:]] if int(rare[:reach].sum()) < units else tokens[:0]

    both = np.union1d(first, _often(count(rest), rare_sets, most // 2))
    sent.destroy()
    return both


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    rare_sets: int = RARE_SETS,
    most_frequent: int = FREQUENT_TOKENS,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of each row: the smallest key
    that links reach, its own included. Sets link if 100 * intersection is at least
    ``percent`` * union.

    Null, empty and blank texts have an empty set and link with nothing, not even
    each other. Equal sets link. A null key stays null; it links others but is never
    a component's name unless the component has no other (then null). Repeated rows
    each give a row; other columns are not read.
    """
    named = _components(docs, key, text, size, percent, rare_sets, most_frequent)
    return named.drop("tag").toDF(key, "n_shingles", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of the smallest key of each component.
    Rows without words, and rows of one key and text, all stay; so do null keys."""
    named = _components(docs, key, text, size, percent, RARE_SETS, FREQUENT_TOKENS)
    later = materialise(named.filter("key <> low").select("key", "tag").distinct(), "later")
    hit = docs.sparkSession.sparkContext.broadcast(bitmap(later.select("key"), "key"))
    spot, tag = free_names(docs, "spot", "tag")
    on = (F.col(key).cast("bigint") == F.col(spot)) & (F.xxhash64(F.col(text)) == F.col(tag))
    asked = docs.filter(perhaps(hit, key)).join(later.toDF(spot, tag), on, "left_anti")
    return docs.filter(~perhaps(hit, key)).unionByName(asked)


def _components(docs: DataFrame, key: str, text: str, size: int, percent: int, rare_sets: int, most_frequent: int) -> DataFrame:
    narrow = narrowed(docs, key, text)
    frequent = frequent_tokens(narrow.select("data"), size, percent, rare_sets, most_frequent)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent)
    found = set_components(
        narrow,
        size,
        percent,
        signatures=lambda tokens: signatures(tokens, frequent.value, percent),
        mark=mark,
        table=table,
        near=lambda held, i, j: near(held, i, j, percent),
    )
    frequent.destroy()
    return found
