"""Near-duplicate documents by bottom-k sketches.

One hash function orders all word shingles. A document keeps the ``k`` smallest
hashes of its set (its sketch); texts with equal sets form one class and go on as one.

1.  Inverted lists. Two sets of Jaccard similarity 0.8 share at least ``common`` of the
    ``k`` values but for a chance of about 1 in 100,000, so they meet in one of the
    ``k - common + 1`` values of a sketch that are rarest in the corpus. Only those are
    listed, and values that no other sketch has make no list. Passages that many
    documents share are common, and so rarely listed.
2.  Stars. In each list the members of about one size are paired with the smallest id
    alone: linear in the list, whatever its length.
3.  The rest. Documents in lists whose members are not yet in one component are listed again,
    now by the rarest values of their full sets, as many as must hold a common one: an
    exact bound. Such lists are compared in full, members of different components
    only, in blocks of bounded size; no pair leaves a block that isn't a likely link.
4.  In both steps the sketch of the union estimates similarity, and pairs that may reach the
    threshold are verified on their full sets. A sketch that holds a whole set verifies at once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import materialise
from .arrow import lists, slices
from .words import NONSPACE, Words

K = 64
WIDE = 256
BLOCK = 1024


def common_values(k: int, percent: int) -> int:
    """How many of ``k`` sketch values two sets at the threshold share at least, 4.75 standard deviations below the mean."""
    p = percent / 100
    return max(1, math.floor(k * p - 4.75 * math.sqrt(k * p * (1 - p))))


def _floor_hits(u, percent: int):
    """The lowest count of common values among ``u`` that leaves the threshold possible, 5 standard deviations below; Column or array."""
    p = percent / 100
    root = F.sqrt(u) if hasattr(u, "alias") else np.sqrt(u)
    return u * p - root * (5 * math.sqrt(p * (1 - p)))


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def signatures(documents: DataFrame, width: int, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, h1, h2, sketch)``: set size, 128-bit digest of the full set and its ``k`` smallest hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = Words(batch.column(1), NONSPACE).shingle_sets(width)
            digests = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), lists([s[:k].view(np.int64) for s in sets], pa.int64())],
                ["doc_id", "n_shingles", "h1", "h2", "sketch"],
            )

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, h1 long, h2 long, sketch array<long>")


def full_sets(documents: DataFrame, nodes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``(node, shingles)`` of the documents in ``nodes``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = Words(batch.column(1), NONSPACE).shingle_sets(width)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists([s.view(np.int64) for s in found], pa.int64())], ["node", "shingles"])

    rows = documents.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    return rows.join(nodes, "node", "left_semi").mapInArrow(sets, "node long, shingles array<long>")


def listed_values(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``(v, node, n)``: of each sketch the rarest values, as many as must hold a common one, without those no other has."""
    values = classes.select("node", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    held = values.join(shared, "v").groupBy("node", "n", "m").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("held"))
    # Sets so small that no partner exceeds k shingles are their own sketches: for them the bound is exact.
    need = F.when(F.col("n") * 100 > k * percent, F.lit(common_values(k, percent))).otherwise(F.ceil(F.col("m") * percent / 100.0))
    slots = (F.col("m") - need + 1 - (F.col("m") - F.size("held"))).cast("int")
    return held.withColumn("slots", slots).where("slots > 0").select("node", "n", F.explode(F.slice("held", F.lit(1), F.col("slots"))).alias("x")).select(F.col("x.v").alias("v"), "node", "n")


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose sketch of the union leaves the threshold possible."""
    a = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = both.withColumn("u", union).withColumn("hits", F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u")))
    return both.where(F.col("hits") >= _floor_hits(F.size("u"), percent)).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("i") * 100 >= (F.size("sa") + F.size("sb") - F.col("i")) * percent).select("a", "b")


class _Rows:
    """Rows of one or more lists as arrays; ``sketch(i)`` is a sorted array."""

    def __init__(self, batch: pa.RecordBatch):
        for name in ("v", "i", "j", "node", "comp", "n", "place", "side"):
            setattr(self, name, batch.column(name).to_numpy())
        sketches = batch.column("sketch")
        self.flat = sketches.flatten().to_numpy().view(np.uint64)
        self.ends = np.cumsum(sketches.value_lengths().to_numpy())

    def sketch(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i - 1] if i else 0 : self.ends[i]]


def _likely_links(rows: _Rows, lo: int, hi: int, k: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers ``(left, right)`` of likely links among the rows of one block pair, and which of them are sure."""
    own = rows.i[lo] == rows.j[lo]
    at = np.arange(lo, hi)
    left, right = (at, at) if own else (at[rows.side[lo:hi] == 0], at[rows.side[lo:hi] == 1])
    n, after = rows.n, rows.n - rows.place
    found = []
    cat = owner = None
    for x in left:
        near = (rows.comp[right] != rows.comp[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))
        # In the first list that a pair shares, all its common values are at or after the list's place in both sets.
        near &= np.minimum(after[right], after[x]) * (100 + percent) >= percent * (n[right] + n[x])
        if own:
            near &= right > x
        partners = right[near]
        if not len(partners):
            continue
        s = rows.sketch(x)
        if len(partners) <= 16:
            shared = np.array([int((s[np.minimum(np.searchsorted(s, y), len(s) - 1)] == y).sum()) for y in map(rows.sketch, partners)])
        else:
            if cat is None:
                parts = [rows.sketch(r) for r in right]
                cat, owner = np.concatenate(parts), np.repeat(np.arange(len(right)), [len(y) for y in parts])
                order = np.argsort(cat, kind="stable")
                cat, owner = cat[order], owner[order]
            first = np.searchsorted(cat, s, "left")
            spans = np.searchsorted(cat, s, "right") - first
            places = np.repeat(first - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            shared = np.bincount(owner[places], minlength=len(right))[near]
        whole = (n[x] <= k) & (n[partners] <= k)
        u = np.where(whole, n[x] + n[partners] - shared, np.minimum(k, len(s) + np.minimum(n[partners], k) - shared))
        # Where a sketch is cut, all shared values count, also those beyond the union's sketch: no link is lost by that.
        ok = np.where(whole, 100 * shared >= percent * u, shared >= _floor_hits(u, percent))
        if ok.any():
            found.append((np.full(ok.sum(), x), partners[ok], whole[ok]))
    if not found:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    return tuple(np.concatenate(c) for c in zip(*found))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as keep the same nodes connected."""
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    low, p, q = np.arange(len(names)), at[: len(a)], at[len(a) :]
    while True:
        before = low.copy()
        np.minimum.at(low, p, low[q])
        np.minimum.at(low, q, low[p])
        if (low == before).all():
            tree = names[low] != names
            return names[low][tree], names[tree]


def _compare_lists(k: int, percent: int):
    """Compare the lists of a partition, whose rows come sorted; a list that goes on in the next batch waits for it.

    Returns likely links, and for the sure ones (both sketches hold whole sets) a spanning set.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: _Rows, cuts: np.ndarray) -> pa.RecordBatch:
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1 and (rows.comp[lo:hi] != rows.comp[lo]).any():
                    a, b, sure = _likely_links(rows, lo, hi, k, percent)
                    if len(a):
                        out.append((rows.node[a[~sure]], rows.node[b[~sure]], np.zeros((~sure).sum(), bool)))
                        x, y = _spanning(rows.node[a[sure]], rows.node[b[sure]])
                        out.append((x, y, np.ones(len(x), bool)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["a", "b", "sure"])

        waiting = None
        for batch in batches:
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            rows = _Rows(batch)
            new = (np.diff(rows.v) != 0) | (np.diff(rows.i) != 0) | (np.diff(rows.j) != 0)
            cuts = np.concatenate(([0], np.flatnonzero(new) + 1))
            waiting = batch.slice(int(cuts[-1]))
            yield found(rows, cuts)
        if waiting is not None:
            yield found(_Rows(waiting), np.array([0, waiting.num_rows]))

    return compare


def _across(listed: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, sure)``: likely links between components, from lists whose members are in more than one."""

    def open_rows(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members")).where("lo < hi")
        return rows.join(ends.select("v", "members"), "v")

    named = listed.join(comps.withColumnRenamed("component", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rest = materialise(open_rows(named).select("node", "comp").distinct().join(sets, "node"), "rest")
    values = rest.select("node", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    held = values.join(shared, "v").groupBy("node", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("held"))
    slots = (F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1 - (F.col("n") - F.size("held"))).cast("int")
    rows = held.withColumn("slots", slots).where("slots > 0").select("node", "comp", "n", (F.col("n") - F.size("held")).alias("alone"), F.posexplode(F.slice("held", F.lit(1), F.col("slots"))).alias("at", "x"))
    rows = open_rows(materialise(rows.select(F.col("x.v").alias("v"), "node", "comp", "n", (F.col("alone") + F.col("at")).alias("place")), "listed"))
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", "v"), F.col("blocks")).cast("int"))
    # Block i meets every block j >= i once; a list of one block makes one group.
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows = rows.withColumn("meet", F.explode(meets)).select("v", "node", "comp", "n", "place", "meet.*")
    rows = rows.join(rest.select("node", F.slice("shingles", 1, WIDE).alias("sketch")), "node")
    rows = rows.select("v", "i", "j", "node", "comp", F.col("n").cast("long").alias("n"), F.col("place").cast("long").alias("place"), "side", "sketch")
    found = rows.repartition("v", "i", "j").sortWithinPartitions("v", "i", "j").mapInArrow(_compare_lists(WIDE, percent), "a long, b long, sure boolean")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sure").alias("sure"))


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked where ``100 * intersection >= percent * union`` of their sets of
    ``width``-word shingles; ``component_id`` is the smallest doc_id reachable and
    ``kept`` marks it. Null and empty texts have no shingles and stand alone. Rows that
    repeat a doc_id are one document with several texts: its rows are in one component, with all that any of its texts
    is linked to. Equal rows, and texts with equal sets, are links like others. A null doc_id can't be
    named by a link: its component is null and it is kept. An empty table gives no rows. Other columns are ignored.
    """
    signed = materialise(signatures(documents, width, k, id_col, text_col), "signatures")
    several = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi")).where("lo <> hi")
    if several.limit(1).count():
        return _of_repeated_ids(documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), width, percent, k)
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    listed = materialise(listed_values(classes, k, percent), "listed")

    step = F.floor(F.log("n") / F.lit(math.log(100 / percent)))
    sized = listed.withColumn("size_step", step)
    hubs = sized.groupBy("v", "size_step").agg(F.min(F.struct("node", "n")).alias("hub"))
    star = sized.join(hubs, ["v", "size_step"]).where("hub.node <> node").where(F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent)
    star = materialise(star.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    sets = materialise(full_sets(documents, listed.select("node").distinct(), width, id_col, text_col), "sets")
    links = materialise(_verified(_estimated(star, classes, k, percent), sets, percent), "links")

    rest = materialise(_across(listed, components(links), sets, percent), "rest")
    more = materialise(_verified(rest.where("not sure"), sets, percent).unionByName(rest.where("sure").select("a", "b")), "links")
    comps = components(links.unionByName(more))

    named = classes.select("h1", "h2", "node").join(comps, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("named"))
    out = signed.join(named, ["h1", "h2"], "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("named", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _of_repeated_ids(documents: DataFrame, width: int, percent: int, k: int) -> DataFrame:
    """``near_duplicates`` where ids have several texts: rows are linked by numbers of their own, then the rows of an id by the id."""
    # Numbers are given as the table is written, so they are unique whatever is run again.
    rows = materialise(documents.withColumn("row", F.monotonically_increasing_id()), "rows")
    linked = near_duplicates(rows, width, percent, k, "row").select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part"))
    linked = materialise(linked.join(rows.select("row", "doc_id"), "row").select("doc_id", "n_shingles", "part"), "linked")
    named = linked.where("doc_id is not null").groupBy("doc_id", "part").agg(F.count("*").alias("n"))
    stars = named.join(named.groupBy("doc_id").agg(F.min("part").alias("low")), "doc_id").where("part <> low")
    joined = materialise(components(stars.select(F.col("part").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "part"), "joined")
    whole = lambda df: df.join(joined, "part", "left").withColumn("part", F.coalesce("component", "part")).drop("component")
    first = whole(named).groupBy("part").agg(F.min("doc_id").alias("first"))
    out = whole(linked).join(first, "part", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("first")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
