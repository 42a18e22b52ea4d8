"""Register sketches against exact sets."""

import random

import numpy as np
import pytest

from starloom.llm import hyperminhash, more_queries, shingles
from starloom.llm.hashing import mix
from llm_samples import AWKWARD, documents, prose  # noqa: F401
from test_groups import Groups, near_texts, shingles_of


def brute(pairs, percent=85):
    sets, want = [(i, shingles_of(t)) for i, t in pairs], Groups()
    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                want.join(i, j)
    return sorted((i, len(s), want.find(i), i == want.find(i)) for i, s in sets)


def texts(rng):
    """Near copies at and around the limit, from 6 to 400 shingles, in chains."""
    pairs = [p for p in near_texts(rng) if p[0] is not None]
    for k in range(12):
        base = prose(rng, rng.choice([10, 11, 12, 24, 60, 150, 400]))
        for c in range(4):
            pairs.append((1000 + 10 * k + c, " ".join(base)))
            at = rng.randrange(len(base))
            base = base[: max(5, len(base) - rng.randint(0, len(base) // 8))] if c % 2 else base[:at] + ["new"] + base[at + 1 :]
    return pairs


@pytest.mark.parametrize("seed", [5, 6])
def test_against_all_pairs(documents, seed):
    pairs = texts(random.Random(seed))
    got = hyperminhash.near_duplicates(documents(pairs))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(pairs)


def test_odd_rows(documents):
    assert hyperminhash.near_duplicates(documents([])).count() == 0
    pairs = [p for p in AWKWARD if p[0] is not None] + [(20, "naïve Café — 東京 😀 OK"), (21, " \n")]
    assert sorted(map(tuple, hyperminhash.near_duplicates(documents(pairs)).collect())) == brute(pairs)
    named = hyperminhash.near_duplicates(documents([(None, "one two"), (3, "one two"), (None, "three")])).collect()
    assert sorted(map(tuple, named), key=str) == [(3, 1, 3, True), (None, 1, 3, False), (None, 1, None, False)]


def pair(rng, n, m, same):
    tokens = mix(rng.integers(0, 1 << 63, n + m - same).astype(np.uint64))
    return np.sort(tokens[:n]), np.sort(tokens[n - same :])


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_sets_at_the_limit_are_found(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 40), 63, 64, 127, 128, 300, 1023, 1024, 3000]:
        for m in {n, min(n + 1, 100 * n // percent), 100 * n // percent}:
            same = -(-percent * (n + m) // (100 + percent))
            if same > n or same == m:
                continue
            x, y = pair(rng, n, m, same)
            assert shingles.links(x.tobytes(), y.tobytes(), percent)
            assert np.intersect1d(hyperminhash.signatures(x, percent), hyperminhash.signatures(y, percent)).size
            marks = [hyperminhash.mark(z, percent) for z in (y, x)]
            held, at = hyperminhash.table(marks), (np.array([0]), np.array([1]))
            assert hyperminhash.near(held, *at, percent).all()
            both = np.intersect1d(hyperminhash.signatures(x, percent), hyperminhash.signatures(y, percent))
            assert hyperminhash.first(held, *at, percent).view(np.uint64)[0] in both


def test_estimates_are_unbiased_and_blocks_agree_with_pairs():
    rng = np.random.default_rng(2)
    for n, share in ((30, 0.8), (300, 0.6), (300, 0.0), (2500, 0.85)):
        found = []
        for _ in range(150):
            same = round(2 * n * share / (1 + share))
            a, b = (hyperminhash.registers(z, n.bit_length()) for z in pair(rng, n, n, same))
            none = int(((a == hyperminhash.EMPTY) & (b == hyperminhash.EMPTY)).sum())
            found.append(hyperminhash.estimate(n, n, int((a == b).sum()) - none, hyperminhash.BUCKETS - none))
        assert abs(np.mean(found) - same / (2 * n - same)) < 0.01
    sets = [z for n in rng.integers(3, 200, 60).tolist() for z in pair(rng, n, n, int(n * rng.uniform(0.6, 1)))]
    marks = [hyperminhash.mark(z) for z in sets]
    i, j = np.triu_indices(len(marks), 1)
    held = hyperminhash.table(marks)
    met = hyperminhash.near(held, i, j)
    assert met.any() and not met.all()
    pair_at = (np.array([0]), np.array([1]))
    assert [hyperminhash.near(hyperminhash.table([marks[a], marks[b]]), *pair_at)[0] for a, b in zip(i, j)] == met.tolist()
    sigs = [set(hyperminhash.signatures(z).tolist()) for z in sets]
    first = hyperminhash.first(held, i, j).view(np.uint64).tolist()
    assert [f in sigs[a] & sigs[b] if sigs[a] & sigs[b] else f == 0 for f, a, b in zip(first, i, j)].count(False) == 0


def test_registered_query(spark, documents, tmp_path):
    pairs = texts(random.Random(7))
    documents(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    got = more_queries.QUERIES["op12_hyperminhash"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == brute(pairs)
