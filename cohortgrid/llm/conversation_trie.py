"""A trie of conversation prefixes, its subtrees measured on balanced parentheses.

1.  ``rebuild`` numbers each conversation's turns over sorted ranges, so that one
    conversation with any share of the rows is spread over tasks, and puts another
    conversation's first turns before them.
2.  A prefix is named by 128 bits: the exclusive or of hashes of (place, turn). It is a
    running aggregate, so long conversations are summed in stretches.
3.  Nodes are grouped prefixes (map-side combined). Below the last node that two
    conversations share there is a single path, whose figures need no trie. The shared nodes are
    cut into shards: subtrees under the *spine*, the few nodes with very many members.
4.  Each shard is written as balanced parentheses. A tree of the least excess of blocks finds the
    parenthesis that closes a subtree, ranks of ``()`` pairs count leaves, and running sums
    give the tokens saved. The sums of the shards' tops join the spine, which is measured in the same way.
5.  Members that end in a node are dealt by range, written as short pieces of text in order, and the pieces
    of a node stream through one digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import global_row_number
from ..session import materialise

FAMILY, MOST_HEADS = 20, 3
#: Turns of a conversation that are hashed together.
STRETCH = 1 << 16
#: Nodes with more members than this, or than a ``SPINE``-th of all rows, are the spine: ``SPINE`` nodes at most.
LEAST_SPINE, SPINE = 10_000, 50_000
#: Shared nodes of a shard, about.
SHARD = 50_000
BLOCK = 256
WORD = r"[^\x20\x09-\x0D]+"


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).where("conv_id is not null")


def rebuild(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, key, words, n_turns)``: the turns of the rebuilt conversations from place 1 on, and a row of place 0 for each conversation.

    Conversation c starts with the first h turns of conversation ``c - c % 20`` (all if fewer, none if absent) and goes on with its own
    turns after its first h, h being ``crc32(c) % 4``. Null turns come first, equal turns in the order of the MD5 of role and text.
    Rows without conv_id belong to no conversation; repeated rows are turns of their own; an empty table gives no rows.
    """
    turns = _turns(conversations)
    first = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    # The limit on the row number is applied before the shuffle, too: a few rows for each task and conversation.
    heads = turns.where(F.col("conv_id") % FAMILY == 0).withColumn("at", F.row_number().over(first)).where(F.col("at") <= MOST_HEADS)
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "key", "words"))).alias("heads"))

    salted = turns.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    ranked = materialise(global_row_number(salted, [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("key"), F.col("salt")]).drop("salt", "turn"), "ranked")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEADS + 1)
    convs = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count("*").alias("n")).withColumn("h", h)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    convs = convs.withColumn("heads", F.slice(F.coalesce("heads", F.array().cast("array<struct<at:int,key:string,words:bigint>>")), 1, F.col("h").cast("int")))
    convs = convs.withColumn("got", F.size("heads").cast("long")).withColumn("n_turns", F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = materialise(convs.select("conv_id", "first", "h", "got", "n_turns", "heads"), "convs")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("key"), F.lit(0).cast("long").alias("words"), "n_turns")
    head = convs.select("conv_id", F.explode("heads").alias("x"), "n_turns").select("conv_id", F.col("x.at").cast("long").alias("place"), "x.key", "x.words", "n_turns")
    own = ranked.join(convs.drop("heads"), "conv_id").withColumn("at", F.col("rank") - F.col("first")).where("at >= h")
    own = own.select("conv_id", (F.col("got") + F.col("at") - F.col("h") + 1).alias("place"), "key", "words", "n_turns")
    return root.unionByName(head).unionByName(own)


def _prefixes(sequences: DataFrame) -> DataFrame:
    """``(conv_id, depth, p, q, words, ends)``: every prefix of every sequence by name ``p``, its parent's name ``q`` and the words of its last turn."""
    names = ("1", "2")
    seed = {"1": F.lit(0), "2": F.lit(1)}
    rows = sequences.withColumns({f"x{i}": F.when(F.col("place") > 0, F.xxhash64(seed[i], "place", "key")).otherwise(F.lit(0).cast("long")) for i in names})
    rows = rows.withColumn("stretch", F.floor(F.col("place") / STRETCH).cast("long"))
    run = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows_before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each stretch of the conversations that have more than one.
    carry = rows.where(F.col("n_turns") >= STRETCH).groupBy("conv_id", "stretch").agg(*(F.bit_xor(f"x{i}").alias(f"x{i}") for i in names))
    carry = carry.select("conv_id", "stretch", *(F.bit_xor(f"x{i}").over(rows_before).alias(f"c{i}") for i in names)).where("stretch > 0")
    rows = rows.withColumns({f"p{i}": F.bit_xor(f"x{i}").over(run) for i in names}).join(carry, ["conv_id", "stretch"], "left")
    rows = rows.withColumns({f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in names})
    p, q = F.struct("p1", "p2"), F.struct(F.col("p1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("p2"))
    return rows.select("conv_id", F.col("place").alias("depth"), p.alias("p"), q.alias("q"), "words", (F.col("place") == F.col("n_turns")).alias("ends"))


class Parentheses:
    """Balanced parentheses with the least excess of each block in a tree."""

    def __init__(self, opening: np.ndarray):
        self.opening = opening
        self.excess = np.cumsum(np.where(opening, 1, -1))
        blocks = -(-len(opening) // BLOCK)
        self.leaves = 1 << max(0, blocks - 1).bit_length()
        self.padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        self.padded[: len(opening)] = self.excess
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.least[self.leaves : self.leaves + blocks] = self.padded.reshape(blocks, BLOCK).min(1)
        level = self.leaves
        while level > 1:
            self.least[level // 2 : level] = self.least[level : 2 * level].reshape(-1, 2).min(1)
            level //= 2

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place beyond ``after`` in the block whose excess is ``target`` or less, or -1."""
        out = np.full(len(block), -1)
        for a in range(0, len(block), 4096):
            part = slice(a, a + 4096)
            place = block[part, None] * BLOCK + np.arange(BLOCK)
            hit = (self.padded[place] <= target[part, None]) & (place > after[part, None])
            out[part] = np.where(hit.any(1), place[:, 0] + hit.argmax(1), -1)
        return out

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        target = self.excess[opens] - 1
        close = self._in_block(opens // BLOCK, opens, target)
        far = np.flatnonzero(close < 0)
        node, want = self.leaves + opens[far] // BLOCK, target[far]
        climbing = np.ones(len(far), bool)
        while climbing.any():
            beside = climbing & (node % 2 == 0) & (self.least[np.minimum(node + 1, len(self.least) - 1)] <= want)
            node[beside] += 1
            climbing &= ~beside
            node[climbing] //= 2
        while (inner := node < self.leaves).any():
            left = np.where(inner, 2 * node, node)
            node = np.where(inner, np.where(self.least[left] <= want, left, left + 1), node)
        close[far] = self._in_block(node - self.leaves, np.full(len(far), -1), want)
        return close


def _measured(frame: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and savings of every node of a forest, given what hangs below each node outside it."""
    names = list(zip(frame.p1, frame.p2))
    number = {x: i for i, x in enumerate(names)}
    # The root is its own parent's name.
    parent = np.array([-1 if d == 0 else number.get(x, -1) for d, x in zip(frame.depth, zip(frame.q1, frame.q2))], np.int64)
    below: list[list[int]] = [[] for _ in names]
    tops = []
    for i, up in enumerate(parent):
        (below[up] if up >= 0 else tops).append(i)
    order, opening, path = [], [], tops[::-1]
    while path:
        i = path.pop()
        if i < 0:
            opening.append(False)
            continue
        order.append(i)
        opening.append(True)
        path.append(-1)
        path.extend(reversed(below[i]))
    order, opening = np.array(order, np.int64), np.array(opening, bool)
    tree = Parentheses(opening)
    opens = np.flatnonzero(opening)
    closes = tree.find_close(opens)
    preorder = np.cumsum(opening)
    children = np.array([len(x) for x in below], np.int64) + frame.more_children.to_numpy(np.int64)
    pair = np.zeros(len(opening), np.int64)
    pair[opens] = (~opening[opens + 1]) & (children[order] == 0)
    leaf_rank = np.concatenate(([0], np.cumsum(pair)))
    sums = lambda x: np.concatenate(([0], np.cumsum(x[order])))
    more, saved = sums(frame.more_leaves.to_numpy(np.int64)), sums(((frame.n_convs - 1) * frame.words + frame.more_saved).to_numpy(np.int64))
    a, b = preorder[opens] - 1, preorder[closes]
    out = frame.iloc[order][["p1", "p2", "q1", "q2", "conv_id", "depth", "n_convs"]].copy()
    up = parent[order]
    out["parent_conv_id"] = pd.array(np.where(up >= 0, frame.conv_id.to_numpy(np.int64)[up], 0), "Int64")
    out.loc[up < 0, "parent_conv_id"] = pd.NA
    out["n_children"], out["n_leaves"], out["saved_tokens"] = children[order], leaf_rank[closes + 1] - leaf_rank[opens] + more[b] - more[a], saved[b] - saved[a]
    return out


_MEASURED = "p1 long, p2 long, q1 long, q2 long, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


def _end_digests(ends: DataFrame, piece: int = 500) -> DataFrame:
    """``(p, ends_sha256)`` of ``(p, conv_id)``: the digest of each node's ids in order, whose text never stands in memory whole."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2, c = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero((np.diff(p1) != 0) | (np.diff(p2) != 0)) + 1
            runs = np.concatenate(([0], cut, [len(c)]))
            at = np.unique(np.concatenate([np.arange(a, b, piece) for a, b in zip(runs[:-1], runs[1:])])) if len(c) else np.zeros(0, np.int64)
            texts = [",".join(map(str, c[a:b].tolist())) for a, b in zip(at, np.append(at[1:], len(c)))]
            yield pa.RecordBatch.from_arrays([pa.array(p1[at]), pa.array(p2[at]), pa.array(c[at]), pa.array(texts, pa.string())], ["p1", "p2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = state = None
        for batch in batches:
            done = []
            for p1, p2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (p1, p2) != name:
                    if name is not None:
                        done.append((*name, state.hexdigest()))
                    name, state = (p1, p2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _rows(done)
        if name is not None:
            yield _rows([(*name, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["p1", "p2", "ends_sha256"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.select("p.p1", "p.p2", "conv_id").repartitionByRange(n, "p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    short = dealt.mapInArrow(pieces, "p1 long, p2 long, first long, ids string")
    found = short.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(digest, "p1 long, p2 long, ends_sha256 string")
    return found.select(F.struct("p1", "p2").alias("p"), "ends_sha256")


def prefix_trie(sequences: DataFrame, least_spine: int = LEAST_SPINE, shard: int = SHARD) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``sequences`` is as ``rebuild`` returns it. ``conv_id`` is the node's smallest member, ``saved_tokens`` sums the subtree's
    words times members but one, ``ends_sha256`` is the digest of the comma-joined ids of the members that end in the node. No sequence, no node: an empty table
    gives no rows, not even the root. Each conv_id has one sequence. A path that conversations share must fit a task (about 100 bytes a turn).
    """
    members = materialise(_prefixes(sequences), "members")
    nodes = members.groupBy("depth", "p").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.min("q").alias("q"), F.max("ends").alias("ends"))
    nodes = materialise(nodes, "nodes")
    total = nodes.agg(F.sum("n_convs"), F.sum((F.col("n_convs") > 1).cast("long"))).first()
    bound = max(least_spine, (total[0] or 0) // SPINE)
    on_spine = (F.col("n_convs") > bound) | (F.col("depth") == 0)
    spine, shared = nodes.where(on_spine), nodes.where(~on_spine & (F.col("n_convs") > 1))
    alone = nodes.where((F.col("n_convs") == 1) & (F.col("depth") > 0))

    # Where each path of a single conversation leaves the shared nodes.
    tops = materialise(alone.groupBy("conv_id").agg(F.min(F.struct("depth", "q")).alias("x")).select("conv_id", "x.depth", "x.q"), "tops")
    hanging = tops.groupBy(F.col("q").alias("p")).agg(F.count("*").alias("alone"))
    shards = members.join(F.broadcast(spine.select("p")), "p", "left_anti").groupBy("conv_id").agg(F.min(F.struct("depth", "p"))["p"].alias("top"))
    n_shards = max(1, -(-(total[1] or 0) // shard))
    flat = [F.col(f"{side}.p{i}").alias(f"{side}{i}") for side in "pq" for i in (1, 2)]
    zero = F.lit(0).cast("long")
    more = F.coalesce("alone", zero)
    work = shared.join(shards, "conv_id").join(hanging, "p", "left").withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(n_shards)))
    work = work.select("shard", *flat, "conv_id", "depth", "n_convs", "words", more.alias("more_children"), more.alias("more_leaves"), zero.alias("more_saved"))
    measured = materialise(work.groupBy("shard").applyInPandas(_measured, _MEASURED), "shards")
    named = lambda side: F.struct(F.col(f"{side}1").alias("p1"), F.col(f"{side}2").alias("p2"))

    # The tops of the shards, added up for the spine's nodes.
    joined = measured.where("parent_conv_id is null").groupBy(named("q").alias("p")).agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    work = spine.join(joined, "p", "left").join(hanging, "p", "left")
    work = work.select(F.lit(0).alias("shard"), *flat, "conv_id", "depth", "n_convs", "words", (more + F.coalesce("c", zero)).alias("more_children"), (more + F.coalesce("l", zero)).alias("more_leaves"), F.coalesce("s", zero).alias("more_saved"))
    # The members of all nodes are the rows, so that the spine has at most SPINE nodes and the root: one group.
    spine_done = materialise(work.groupBy("shard").applyInPandas(_measured, _MEASURED), "spine")

    owners = spine_done.select(named("p").alias("q"), F.col("conv_id").alias("owner"))
    measured = measured.withColumn("q", named("q")).join(F.broadcast(owners), "q", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "owner"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    tree = measured.select(named("p").alias("p"), *columns).unionByName(spine_done.select(named("p").alias("p"), *columns))
    ends = members.where("ends").join(tops.select("conv_id"), "conv_id", "left_anti").select("p", "conv_id")
    tree = tree.join(_end_digests(ends), "p", "left").select(*columns, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

    at = tops.join(nodes.where(on_spine | (F.col("n_convs") > 1)).select(F.col("p").alias("q"), F.col("conv_id").alias("owner")), "q").select("conv_id", "depth", "owner")
    ended = F.when(F.col("ends"), F.col("conv_id").cast("string")).otherwise("")
    tails = alone.join(at, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("owner", "conv_id").alias("parent_conv_id"), "n_convs", F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), F.sha2(ended, 256).alias("ends_sha256"),
    )
    return tree.unionByName(tails)
