"""The prefix trie of conversations, by collapse of whole sequences.

A turn is told apart by a digest of its role and text; the first d turns of a
conversation by the exclusive or of 128 bits for each (place, digest). Such sums are
associative, so a conversation of any length is numbered and summed up in blocks: no
task has to hold or even see one whole.

Equal conversations collapse into one weighted sequence, whose ends are listed. A
sequence that is a proper prefix of another has a child below it: an anti join with
the parents of all nodes leaves the leaves. Then the prefixes of each sequence, made
once, add their weights up to the nodes.

A node's sum over its subtree needs no walk: the words of all members below it are the
words left in each sequence, times its weight; the words of distinct nodes below it
are counted by the sequence that leads them (the one with the smallest conversation),
which leads from some depth on all nodes to its end.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import arrow_schema, in_batches
from starloom.operators.lookup import spread_join

#: Turns of a conversation, or ids of an end list, that are handled together.
BLOCK = 1024
_NO_TURN = -(1 << 60)  # block of turns without a number: before all others
_KEY = ["depth", "y1", "y2"]


def digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def numbered_turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, place, digest, words) of every turn; places count from 0 in the order
    of ``turn``, null first. Turns with one number stand in order of their digest,
    repeated rows are turns of their own. A null role or text is empty; rows without
    a conversation are left out; other columns are not read."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv"),
        F.coalesce(F.floor(F.col(turn) / BLOCK).cast("bigint"), F.lit(_NO_TURN)).alias("block"),
        F.col(turn).alias("turn"),
        digest(*said).alias("digest"),
        n_words(said[1]).alias("words"),
    )
    turns = materialise(turns, "turns")
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sizes = turns.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = W.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = turns.withColumn("no", F.row_number().over(inside)).join(starts, ["conv", "block"])
    return placed.select("conv", (F.col("start") + F.col("no") - 1).alias("place"), "digest", "words")


def lend_heads(turns: DataFrame, stride: int = 20, most: int = 4) -> DataFrame:
    """(conv, place, digest, words) with borrowed heads: the first h turns (crc32 of the
    decimal id, modulo ``most``) of conversation c come from conversation
    c - c % ``stride``, all if it has fewer, none if there is none; c's own turns after
    its first h follow. ``turns`` is a stored frame."""
    borrowed = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.select("conv").distinct().select(
        "conv", borrowed.alias("h"), (F.col("conv") - F.col("conv") % stride).alias("lender")
    )
    heads = turns.filter((F.col("conv") % stride == 0) & (F.col("place") < most - 1))
    heads = heads.withColumnRenamed("conv", "lender")
    # at most ``stride`` conversations borrow from one, ``most`` turns each
    lent = convs.join(heads, "lender", "left").filter("place IS NULL OR place < h")
    lent = materialise(lent.select("conv", "h", "place", "digest", "words"), "lent")
    short = lent.groupBy("conv", "h").agg(F.count("place").alias("n")).filter("n < h")
    own = materialise(turns.filter(F.col("place") >= borrowed), "own")
    moved = spread_join(own, short.select("conv", (F.col("h") - F.col("n")).alias("less")), ["conv"])
    moved = moved.select("conv", (F.col("place") - F.coalesce("less", F.lit(0))).alias("place"), "digest", "words")
    return lent.filter("place IS NOT NULL").select("conv", "place", "digest", "words").unionByName(moved)


def _end_digests(whole: DataFrame) -> DataFrame:
    """Per sequence, the SHA-256 of its conversations' ids in ascending order. Ids
    come in chunks of at most BLOCK, so a sequence that a third of all conversations
    share is read as a short stream and never held."""
    ddl = "depth bigint, y1 bigint, y2 bigint, ends_sha256 string"
    schema = arrow_schema(ddl)

    def run(batches):
        now, sha = None, None
        for batch in batches:
            made = []
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        made.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*made), schema)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, sha.hexdigest()), schema)], schema=schema)

    chunk = F.floor(F.col("conv") / BLOCK).alias("chunk")
    listed = whole.groupBy(*_KEY, chunk).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    listed = listed.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))
    dealt = listed.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    return in_batches(dealt.select(*_KEY, "ids"), run, ddl)


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, place, digest, words) over all ``convs``
    (conv, each once; those without turns are members of the root).

    A row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over its subtree) and
    ``ends_sha256`` (of the members that end there). No conversation, no node.
    """
    convs = materialise(convs.select("conv").distinct(), "convs")
    place = F.col("place")
    rows = turns.select(
        "conv",
        "place",
        F.floor(place / BLOCK).cast("bigint").alias("block"),
        "words",
        F.xxhash64(place, "digest").alias("z1"),
        F.xxhash64(F.lit(1), "digest", place).alias("z2"),
    )
    rows = materialise(rows, "rows")
    blocks = rows.groupBy("conv", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2")
    )
    blocks = materialise(blocks, "blocks")
    none = F.lit(0).cast("bigint")
    whole = blocks.groupBy("conv").agg(F.sum("n").alias("depth"), F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"), F.sum("w").alias("total"))
    whole = convs.join(whole, "conv", "left").na.fill(0)
    whole = materialise(whole.select("conv", *_KEY, "total"), "whole")
    sequences = whole.groupBy(*_KEY).agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("total").alias("total"))
    sequences = materialise(sequences, "sequences")

    # prefixes of each sequence, once, from one of its conversations
    earlier = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = {"b1": F.bit_xor("x1"), "b2": F.bit_xor("x2"), "bw": F.sum("w")}
    starts = blocks.select("conv", "block", *(F.coalesce(v.over(earlier), none).alias(k) for k, v in before.items()))
    starts = starts.join(sequences.select(F.col("rep").alias("conv"), "total"), "conv")
    upto = W.partitionBy("conv", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    prefixes = rows.join(starts, ["conv", "block"]).select(
        F.col("conv").alias("rep"),
        (place + 1).alias("depth"),
        F.col("b1").bitwiseXOR(F.bit_xor("z1").over(upto)).alias("y1"),
        F.col("b2").bitwiseXOR(F.bit_xor("z2").over(upto)).alias("y2"),
        "z1",
        "z2",
        # words from this turn to the end
        (F.col("total") - F.col("bw") - F.sum("words").over(upto) + F.col("words")).alias("left"),
    )
    prefixes = prefixes.select(
        "rep", *_KEY, F.col("y1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("y2").bitwiseXOR(F.col("z2")).alias("p2"), "left"
    )
    nothing = F.lit(None).cast("bigint")
    roots = sequences.select("rep", *(none.alias(k) for k in _KEY), nothing.alias("p1"), nothing.alias("p2"), F.col("total").alias("left"))
    prefixes = materialise(prefixes.unionByName(roots), "prefixes")

    nodes = prefixes.groupBy(*_KEY).agg(
        F.min(F.struct("rep", "left")).alias("lead"), F.first("p1").alias("p1"), F.first("p2").alias("p2")
    )
    nodes = materialise(nodes.select(*_KEY, "p1", "p2", F.col("lead.rep").alias("conv_id"), F.col("lead.left").alias("left")), "nodes")
    parents = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("y1"), F.col("p2").alias("y2"))
    parents = materialise(parents.agg(F.count(F.lit(1)).alias("n_children")), "parents")
    leaves = sequences.join(parents, _KEY, "left_anti").select("rep", F.lit(1).cast("bigint").alias("leaf"))
    leads = nodes.groupBy(F.col("conv_id").alias("rep")).agg(F.min(F.struct("depth", "left")).alias("from"))
    facts = sequences.select("rep", "weight").join(leaves, "rep", "left").join(leads, "rep", "left")

    # a conversation of a third of all turns is a hot key here, a common first turn below
    weighted = spread_join(prefixes, facts, ["rep"], "inner", census=prefixes)
    led = F.when(F.col("from").isNull(), none).when(F.col("depth") >= F.col("from.depth"), F.col("left")).otherwise(F.col("from.left"))
    sums = weighted.groupBy(*_KEY).agg(
        F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", none)).alias("n_leaves"),
        F.sum(F.col("weight") * F.col("left") - led).alias("saved_tokens"),
    )
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("y1").alias("p1"), F.col("y2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = spread_join(nodes.drop("left"), parent, ["depth", "p1", "p2"], census=nodes)
    found = found.join(sums, _KEY).join(parents, _KEY, "left").join(_end_digests(whole), _KEY, "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", none).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, stride: int | None = None, most: int = 4) -> DataFrame:
    """:func:`prefix_nodes` of ``conversations`` (conv_id, turn, role, text); with
    ``stride``, of conversations rebuilt by :func:`lend_heads`. An empty table has no
    nodes; see :func:`numbered_turns` for nulls, ties and repeats."""
    turns = materialise(numbered_turns(conversations), "numbered")
    convs = turns.select("conv").distinct()
    return prefix_nodes(turns if stride is None else lend_heads(turns, stride, most), convs)
