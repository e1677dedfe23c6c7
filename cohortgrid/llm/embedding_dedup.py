"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; the
nearest of the ``2d`` signed axes is its hash. ``hashes`` of them name a vector's own bucket in each
of ``tables`` tables, and it also asks in the ``hashes`` buckets in which one
hash is its second nearest axis (multiprobe). Vectors are compared with those whose own bucket they share or ask in,
by cosine in double precision, in blocks of bounded size, so every link is verified.

Equal vectors of one label are one class and hash once. A pair is counted in the
first table where it meets, so that a block returns sums for each vector and a
spanning set of its links, never the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import materialise
from .arrow import lists
from .words import mix

BLOCK = 1024


def dense(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` for each length among the lists; null lists are left out, null values become NaN."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    end = np.cumsum(length)
    out = []
    for d in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == d)
        out.append((rows, flat[(end[rows] - d)[:, None] + np.arange(d)]))
    return out


def hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_keys(x: np.ndarray, label: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """``(n, tables, hashes + 1)`` bucket names of unit vectors; the first of a table is its own bucket, the others are probes."""
    n, d = x.shape
    width = 1 << (d - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - d)))
    signs = np.random.default_rng([seed, width]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = np.zeros((n, tables, hashes + 1), np.uint64)
    for t in range(tables):
        best, second = np.zeros((n, hashes), np.uint64), np.zeros((n, hashes), np.uint64)
        for h in range(hashes):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, h, r])
            order = np.argpartition(-np.abs(y), min(1, width - 1), axis=1)[:, :2] if width > 1 else np.zeros((n, 1), int)
            size = np.take_along_axis(np.abs(y), order, 1)
            order = np.take_along_axis(order, np.argsort(-size, axis=1, kind="stable"), 1)
            axis = order + width * (np.take_along_axis(y, order, 1) < 0)
            best[:, h], second[:, h] = axis[:, 0], axis[:, -1]
        base = mix(label.astype(np.int64).view(np.uint64) * np.uint64(1000003) + np.uint64(t * 4096 + d))
        for p in range(hashes + 1):
            key = base
            for h in range(hashes):
                key = mix(key + (second if p == h + 1 else best)[:, h] + np.uint64(1))
            out[:, t, p] = key
    return out


def _units(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are finite and not zero, and these as unit vectors; the scale is taken out first, so that no square over- or underflows."""
    with np.errstate(invalid="ignore"):
        top = np.abs(m).max(1)
    ok = np.isfinite(m).all(1) & (top > 0)
    u = m[ok] / top[ok][:, None]
    return ok, u / np.sqrt((u * u).sum(1))[:, None]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors at unit length, with the digest of label and values."""
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        rows, digests, vectors = [], [], []
        for at, m in dense(batch.column(2)):
            ok, units = _units(m)
            rows += at[ok].tolist()
            vectors += list(units)
            for i, v in zip(at[ok], m[ok] + 0.0):
                digests.append(hashlib.blake2b(v.tobytes() + int(labels[i]).to_bytes(8, "little", signed=True), digest_size=16).digest())
        d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        picked = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), pa.array(d[:, 0]), pa.array(d[:, 1]), lists(vectors, pa.float64())], ["vec_id", "label", "h1", "h2", "v"])


class _Members:
    """Members of buckets as arrays, in the order of their buckets."""

    def __init__(self, batch: pa.RecordBatch, tables: int):
        for name in ("key", "i", "j", "side", "place", "cls", "node", "label", "weight"):
            setattr(self, name, batch.column(name).to_numpy())
        n = batch.num_rows
        self.keys = batch.column("keys").flatten().to_numpy().reshape(n, tables, -1)
        self.own = self.keys[:, :, 0]
        self.table, owner = np.divmod(self.place, self.keys.shape[2])
        self.owner = owner == 0
        # Vectors of unequal length are never in one bucket; shorter ones end in zeros here.
        parts = dense(batch.column("v"))
        self.v = np.zeros((n, max(m.shape[1] for _, m in parts)))
        for rows, m in parts:
            self.v[rows, : m.shape[1]] = m
        self.width = pc.list_value_length(batch.column("v")).to_numpy()

    def first_meeting(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the pairs of members of one bucket meet in no earlier table, and in no smaller bucket of this one."""
        table = self.table[p]
        at = np.arange(len(p))
        same = self.own[p] == self.own[q]
        asked = (self.own[p][:, :, None] == self.keys[q][:, :, 1:]).any(2)
        asks = (self.own[q][:, :, None] == self.keys[p][:, :, 1:]).any(2)
        meets = same | asked | asks
        first = meets.argmax(1) == table
        top = np.iinfo(np.int64).max
        lowest = np.minimum(np.where(asked[at, table], self.own[p, table], top), np.where(asks[at, table], self.own[q, table], top))
        return first & (same[at, table] | (lowest == self.key[p]))


def _lowest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest name that each left and right member reaches over the links of a block."""
    top = np.iinfo(np.int64).max
    while True:
        new = np.minimum(left, np.where(near, right[None, :], top).min(1))
        other = np.minimum(right, np.where(near, new[:, None], top).min(0))
        if (new == left).all() and (other == right).all():
            return left, right
        left, right = new, other


def _compare(threshold: float, tables: int, few: int = 24):
    """Compare the buckets of a partition, whose rows come sorted; a bucket that goes on in the next batch waits for it.

    Returns ``cls, node, links, low``: of each member with links in a batch how many rows it links with there, and a name below its own.
    """

    def small(m: _Members, group: np.ndarray, usable: np.ndarray, out: list) -> None:
        """All buckets of few members at once: each member with the one ``step`` rows further on."""
        pairs = []
        rows = np.flatnonzero(usable)
        for step in range(1, few):
            p = rows[:-step]
            q = rows[step:]
            ok = (group[p] == group[q]) & (m.owner[p] | m.owner[q]) & (m.cls[p] != m.cls[q]) & (m.label[p] == m.label[q]) & (m.width[p] == m.width[q])
            if not (group[p] == group[q]).any():
                break
            pairs.append((p[ok], q[ok]))
        if not pairs:
            return
        p, q = (np.concatenate(x) for x in zip(*pairs))
        for s in range(0, len(p), 8192):
            i, j = p[s : s + 8192], q[s : s + 8192]
            cosine = np.einsum("ij,ij->i", m.v[i], m.v[j])
            near = cosine >= threshold
            i, j = i[near], j[near]
            if len(i):
                first = m.first_meeting(i, j)
                out.append((i, np.where(first, m.weight[j], 0), np.minimum(m.node[i], m.node[j])))
                out.append((j, np.where(first, m.weight[i], 0), np.minimum(m.node[i], m.node[j])))

    def large(m: _Members, lo: int, hi: int, out: list) -> None:
        at = np.arange(lo, hi)
        own = m.i[lo] == m.j[lo]
        left, right = (at, at) if own else (at[m.side[lo:hi] == 0], at[m.side[lo:hi] == 1])
        if not len(left) or not len(right):
            return
        near = (m.v[left] @ m.v[right].T >= threshold) & (m.width[left][:, None] == m.width[right][None, :]) & (m.owner[left][:, None] | m.owner[right][None, :])
        near &= (m.cls[left][:, None] != m.cls[right][None, :]) & (m.label[left][:, None] == m.label[right][None, :])
        low_left, low_right = _lowest(near, m.node[left], m.node[right])
        if own:
            near = np.triu(near, 1)
        met = np.zeros(near.shape, bool)
        for t in range(m.table[lo]):
            met |= m.own[left, t][:, None] == m.own[right, t][None, :]
        links_left, links_right = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        p, q = np.nonzero(near & ~met)
        for s in range(0, len(p), 20000):
            i, j = p[s : s + 20000], q[s : s + 20000]
            first = m.first_meeting(left[i], right[j])
            i, j = i[first], j[first]
            links_left += np.bincount(i, m.weight[right[j]], len(left)).astype(np.int64)
            links_right += np.bincount(j, m.weight[left[i]], len(right)).astype(np.int64)
        linked = near.any(1) | (low_left < m.node[left])
        out.append((left[linked], links_left[linked], low_left[linked]))
        linked = near.any(0) | (low_right < m.node[right])
        out.append((right[linked], links_right[linked], low_right[linked]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(batch: pa.RecordBatch) -> pa.RecordBatch:
            m = _Members(batch, tables)
            new = np.concatenate(([True], (np.diff(m.key) != 0) | (np.diff(m.i) != 0) | (np.diff(m.j) != 0)))
            group = np.cumsum(new) - 1
            cuts = np.append(np.flatnonzero(new), batch.num_rows)
            size = np.diff(cuts)
            is_small = (size <= few) & (m.i[cuts[:-1]] == m.j[cuts[:-1]])
            out: list = [(np.zeros(0, np.int64),) * 3]
            small(m, group, is_small[group], out)
            for g in np.flatnonzero(~is_small & (size > 1)):
                large(m, int(cuts[g]), int(cuts[g + 1]), out)
            rows, links, low = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(m.cls[rows]), pa.array(m.node[rows]), pa.array(links.astype(np.int64)), pa.array(low)], ["cls", "node", "links", "low"])

        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("key", "i", "j")]
            same = np.ones(batch.num_rows, bool)
            for c, x in zip(("key", "i", "j"), last):
                same &= batch.column(c).to_numpy() == x
            start = int(same.argmax())
            waiting = batch.slice(start)
            if start:
                yield found(batch.slice(0, start))
        if waiting is not None:
            yield found(waiting)

    return compare


def near_duplicate_vectors(embeddings: DataFrame, threshold: float = 0.98, tables: int = 8, hashes: int = 3, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal, non-null label link where their cosine is at least ``threshold``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable, ``kept`` marks it. Null, empty, zero and non-finite vectors, vectors
    holding nulls, and rows without a label or vec_id link with nothing; without a
    vec_id the component is null and the row is kept. Vectors of unequal length never
    link. Rows that repeat a vec_id are one item with several vectors: its links are counted for each row, and all its
    rows are in one component. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = materialise(rows.where("vec_id is not null and label is not null and v is not null").mapInArrow(_describe, "vec_id long, label long, h1 long, h2 long, v array<double>"), "vectors")
    classes = usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("v").alias("v"))
    # Numbers are given as the table is written, so they are unique whatever is run again.
    classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for at, m in dense(batch.column(2)):
                found = bucket_keys(m, label[at], tables, hashes, seed).reshape(len(at), -1).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), lists(list(found), pa.int64())], ["cls", "keys"])

    keyed = materialise(classes.select("cls", "label", "v").mapInArrow(keys, "cls long, keys array<long>"), "keys")
    each = hashes + 1
    members = keyed.select("cls", "keys", F.posexplode("keys").alias("place", "key")).where(f"place % {each} = 0 or key <> keys[cast(place - place % {each} as int)]").drop("keys")
    full = members.groupBy("key").agg(F.count("*").alias("members"), F.count_if(F.col("place") % each == 0).alias("owners")).where("members > 1 and owners > 0")
    rows_in = members.join(full.drop("owners"), "key").withColumn("blocks", F.ceil(F.col("members") / F.lit(BLOCK)).cast("int"))
    rows_in = rows_in.withColumn("block", F.pmod(F.xxhash64("cls", "key"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows_in = rows_in.select("key", "cls", F.col("place").cast("long").alias("place"), F.explode(meets).alias("meet")).select("key", "cls", "place", "meet.*")
    rows_in = rows_in.join(classes.select("cls", "node", "weight", "label", "v").join(keyed, "cls"), "cls")
    rows_in = rows_in.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cls")
    found = materialise(rows_in.mapInArrow(_compare(threshold, tables), "cls long, node long, links long, low long"), "found")

    # An id with several vectors connects their classes.
    several = usable.groupBy("vec_id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi")).where("lo <> hi").select("vec_id")
    repeated = usable.join(several, "vec_id").select("vec_id", "h1", "h2").distinct().join(classes.select("h1", "h2", "node"), ["h1", "h2"]).select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    comps = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(repeated).where("a <> b"))
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", "cls", "node", "weight").join(sums, "cls", "left").join(comps, "node", "left")
    named = named.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    linked = usable.select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = rows.mapInArrow(_unusable, "vec_id long").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _unusable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vec_id of every row that ``_describe`` leaves out."""
    for batch in batches:
        out = np.ones(batch.num_rows, bool)
        for at, m in dense(batch.column(2)):
            out[at[_units(m)[0]]] = False
        out |= pc.or_(pc.is_null(batch.column(0)), pc.is_null(batch.column(1))).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(out))], ["vec_id"])
