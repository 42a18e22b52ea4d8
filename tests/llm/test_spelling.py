"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import more_queries, spelling
from llm_samples import AWKWARD, documents, prose  # noqa: F401
from test_groups import distance

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(pairs, damage):
    total = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if n >= 3 and len(w) >= 5}


def brute(pairs, damage=0):
    words = counted(pairs, damage)
    near = {w: [] for w in words}
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) <= 1 and distance(a, b) == 1:
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    assert [t for _, t in df.dtypes] == ["string"] * 3 + ["bigint"] * 3
    return sorted(tuple(r) for r in df.collect())


def variants(rng, n):
    """Texts of words that stem from a few by edits, in chains; some very long ones."""
    words = [w + "ung" for w in ("haupt", "überse", "contro", "pâtisse", "x" * 60, "zz", "Élé×ve")]
    while len(words) < n:
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "e", "é", "ÿ", "À", "t"])
        words.append("".join(w))
    pairs = list(AWKWARD) + [(9, "Große ſtraße naïve naïve naïve Naïve naïve ßßßßß"), (None, "hauptung " * 3)]
    for i in range(120):
        said = [rng.choice(words[: rng.choice([8, 40, n])]) for _ in range(30)]
        pairs.append((100 + i, rng.choice([" ", ", ", "1", "\n"]).join(said)))
    return pairs


@pytest.mark.parametrize("cell, damage", [(4096, 0), (4096, 97), (6, 5)])
def test_against_all_pairs(documents, monkeypatch, cell, damage):
    monkeypatch.setattr(spelling, "CELL", cell)
    pairs = variants(random.Random(cell + damage), 300)
    assert got(spelling.spelling_variants(documents(pairs), damage=damage)) == brute(pairs, damage)


def test_no_words(documents):
    assert got(spelling.spelling_variants(documents([]))) == []
    assert got(spelling.spelling_variants(documents([(1, None), (2, "four four four"), (3, "")]))) == []


def test_chains_of_forms_end_at_the_root(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"v{i}", "w5") for i in range(300)]
    found = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert found == {w: "w37" for w, _ in chain}
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).isEmpty()


def test_trie_meets_all_within_the_budget():
    rng = np.random.default_rng(3)
    for levels in (1, 4, 16):
        counts = rng.integers(0, 3, (400, levels))
        met = np.concatenate(list(spelling.search(counts)), 1)
        found = set(zip(*met.tolist()))
        assert len(found) == met.shape[1]
        more = counts[:, None] - counts[None]
        near = (np.clip(more, 0, None).sum(2) <= 1) & (np.clip(-more, 0, None).sum(2) <= 1)
        assert found >= set(zip(*np.nonzero(np.triu(near, 1))))
    alike = np.zeros((700, 5), np.int64)
    assert sum(m.shape[1] for m in spelling.search(alike)) == 700 * 699 // 2


def test_one_edit():
    rng = random.Random(8)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    table = np.zeros((len(words), spelling.WIDTH), np.uint8)
    for k, w in enumerate(words):
        table[k, : len(w)] = np.frombuffer(w.encode("latin-1"), np.uint8)
    length = np.array([len(w) for w in words])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(150), np.arange(150)))
    kept = np.abs(length[i] - length[j]) <= 1
    i, j = i[kept], j[kept]
    want = [distance(words[a], words[b]) == 1 for a, b in zip(i, j)]
    assert spelling.one_edit(table, length, i, j).tolist() == want
    assert [spelling.one_edit_apart(words[a], words[b]) for a, b in zip(i, j)] == want


def test_registered_query(spark, documents, tmp_path):
    pairs = variants(random.Random(4), 120)
    documents(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(more_queries.QUERIES["op11_spelling"](spark, str(tmp_path))) == brute(pairs, 97)
