"""The conversation trie against a plain walk over all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm import conversation_trie, more_queries

DDL = "conv_id bigint, turn int, role string, text string, depth int, words string, place double, total int"


def frame(spark, turns):
    """Further columns clash with those that the operator makes."""
    return spark.createDataFrame([(*t, 9, "w", 0.5, 1) for t in turns], DDL)


def originals(turns):
    found = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            found[c].append((n is not None, n or 0, role or "", text or ""))
    held = {}
    for c, said in found.items():
        said.sort(key=lambda t: (*t[:2], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()))
        held[c] = [t[2:] for t in said]
    return held


def rebuilt(held):
    out = {}
    for c, said in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = held.get(c - c % 20, [])[:h] + said[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in convs.items():
        ends[tuple(said)].append(c)
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, own in members.items():
        words = len(conv_words(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(own) - 1) * words
    sha = lambda k: hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k], sha(k))
        for k, m in members.items()
    )


def conv_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def awkward(rng, n):
    """Few different turns, so that many prefixes meet; nulls, blanks, ties, repeats."""
    said = [("user", "a b"), ("user", "a  b c"), ("assistant", "x"), (None, "x"), ("system", None), ("", ""), ("user", "é ü\tz")]
    turns = []
    for c in range(n):
        count = rng.choice([1, 1, 2, 3, 3, 4, 6])
        turns += [(c, t, *rng.choice(said[: 2 + t % 6])) for t in range(count)]
    turns += [(7, None, "user", "first"), (7, None, "user", "first"), (7, 2, "x", "tie"), (7, 2, "a", "tie"), (7, 2, "a", "tie")]
    turns += [(None, 0, "user", "no conversation"), (995, 3, "user", "no lender"), (1000, 1, "user", "long " * 20_000)]
    rng.shuffle(turns)
    return turns


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [1024, 2])
def test_against_all_prefixes(spark, monkeypatch, seed, block):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    turns = awkward(random.Random(seed), 90)
    held = originals(turns)
    assert got(conversation_trie.conversation_trie(frame(spark, turns))) == brute(held)
    assert got(conversation_trie.conversation_trie(frame(spark, turns), stride=20)) == brute(rebuilt(held))


def test_hot_conversation_and_hot_sequence(spark):
    """One conversation, and copies of one, over many blocks."""
    turns = [(3, i, "user", f"w{i % 5} x") for i in range(2500)]
    turns += [(4, i, "user", f"w{i % 5} x") for i in range(1400)]
    turns += [(100 + c, t, "user", "the same") for c in range(2600) for t in range(2)]
    nodes = got(conversation_trie.conversation_trie(frame(spark, turns)))
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert len(nodes) == 1 + 2500 + 2
    assert (100, 2, 100, 2600, 0, 1, 2599 * 2, sha(range(100, 2700))) in nodes
    assert (3, 1400, 3, 2, 1, 1, 2, sha([4])) in nodes
    assert (3, 2500, 3, 1, 0, 1, 0, sha([3])) in nodes
    assert (3, 0, -1, 2602, 2, 2, 2 * 2599 * 2 + 2 * 1400, sha([])) in nodes


def test_empty_and_turnless(spark):
    assert got(conversation_trie.conversation_trie(frame(spark, []))) == []
    only = [(c, 0, "user", "x") for c in range(990, 999) if zlib.crc32(str(c).encode()) % 4]
    assert got(conversation_trie.conversation_trie(frame(spark, only), stride=20)) == brute(rebuilt(originals(only)))


def test_registered_query(spark, tmp_path):
    turns = awkward(random.Random(9), 60)
    frame(spark, turns).withColumn("extra", F.lit(1)).write.parquet(f"{tmp_path}/conversations.parquet")
    query = more_queries.QUERIES["op13_conversation_trie"]
    assert got(query(spark, str(tmp_path))) == brute(rebuilt(originals(turns)))
