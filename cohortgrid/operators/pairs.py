"""Correlations of all pairs of items, looked at where they are made: block by block, tile by tile.

Each task compares two blocks of items and gives only what is asked of their correlations, so that no row is made, shuffled or joined
for a pair that isn't part of the result. Time stays quadratic in the items, but for sums over items that have every cell (:func:`whole_sums`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Cells of an item up to which it is compared whole, values of one block of items, the least number of blocks, and items of one tile.
MOST_CELLS, BLOCK_VALUES, LEAST_BLOCKS, TILE = 4096, 1 << 21, 8, 1024


def _column(rows: pa.Table, name: str) -> pa.Array:
    return rows.column(name).combine_chunks()


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    return _column(rows, name).flatten().to_numpy(zero_copy_only=False)


def _sizes(rows: pa.Table) -> np.ndarray:
    return pc.list_value_length(_column(rows, "h")).to_numpy(zero_copy_only=False).astype(np.int64)


class Side:
    """The items of one block as dense rows over the cells of both."""

    def __init__(self, rows: pa.Table, at: np.ndarray, width: int):
        self.item, self.label = _column(rows, "item"), _column(rows, "label")
        sizes, flat = _sizes(rows), _flat(rows, "v")
        owner = np.repeat(np.arange(len(rows)), sizes)
        # Correlation doesn't change with an item's level; without it the sums lose fewer digits.
        self.top = np.zeros(len(rows))
        np.maximum.at(self.top, owner, np.abs(flat))
        level = np.bincount(owner, flat, len(rows)) / np.maximum(1, sizes)
        self.x, self.has = np.zeros((len(rows), width)), np.zeros((len(rows), width))
        self.x[owner, at], self.has[owner, at] = flat - level[owner], 1.0
        self.whole = bool((sizes == width).all())
        if self.whole:
            self.x -= self.x.mean(1, keepdims=True)
            square = (self.x * self.x).sum(1)
            varies = (width > 1) & (square > (self.top * 1e-12) ** 2 * width)
            self.z = self.x / np.sqrt(np.where(varies, square, np.nan))[:, None]


def _tile(left: Side, right: Side, p: slice, q: slice) -> tuple[np.ndarray, np.ndarray]:
    """Shared cells and correlation of each item of one tile with each of another; a correlation that is not defined is NaN."""
    if left.whole and right.whole:
        r = left.z[p] @ right.z[q].T
        return np.broadcast_to(left.x.shape[1], r.shape), np.clip(r, -1, 1, out=r)
    x, mx, y, my = left.x[p], left.has[p], right.x[q], right.has[q]
    n = mx @ my.T
    with np.errstate(all="ignore"):
        sa, sb = x @ my.T, mx @ y.T
        va, vb = (x * x) @ my.T - sa * sa / n, mx @ (y * y).T - sb * sb / n
        varies = (n > 1) & (va > (left.top[p, None] * 1e-12) ** 2 * n) & (vb > (right.top[None, q] * 1e-12) ** 2 * n)
        r = np.where(varies, (x @ y.T - sa * sb / n) / (np.sqrt(va) * np.sqrt(vb)), np.nan)
    return n, np.clip(r, -1, 1, out=r)


Tiles = Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]


def _tiles(left: Side, right: Side) -> Tiles:
    """Tiles of all pairs of two blocks, each pair once; ``n`` is 0 where two items have no cell in common or the pair is not counted here."""
    for i in range(0, len(left.item), TILE):
        for j in range(i if left is right else 0, len(right.item), TILE):
            p, q = slice(i, min(i + TILE, len(left.item))), slice(j, min(j + TILE, len(right.item)))
            n, r = _tile(left, right, p, q)
            if left is right and i == j:
                lower = np.tril_indices(len(n))
                n = n.copy()
                n[lower], r[lower] = 0, np.nan
            yield p, q, n, r


Visit = Callable[[Side, Side, Tiles], Iterator[pa.RecordBatch]]


def narrow(measurements: DataFrame, axis: str = "sample") -> bool:
    """Whether an item's cells are few enough to be compared whole."""
    other = "feature" if axis == "sample" else "sample"
    return (measurements.agg(F.approx_count_distinct(other)).first()[0] or 0) <= MOST_CELLS * 0.9


def visit_pairs(cells: DataFrame, visit: Visit, schema: str, labels: DataFrame | None = None) -> DataFrame:
    """What ``visit`` gives for each two blocks of items of ``(item, h, value)``; with ``labels`` ``(item, label)``, of the labelled items."""
    rows = cells.groupBy("item").agg(F.collect_list(F.struct("h", "value")).alias("cells"))
    rows = rows.select("item", F.transform("cells", lambda c: c["h"]).alias("h"), F.transform("cells", lambda c: c["value"]).alias("v"))
    rows = rows.join(labels.select("item", "label"), "item") if labels is not None else rows.withColumn("label", F.lit(0))
    items, width = cells.agg(F.approx_count_distinct("item"), F.approx_count_distinct("h")).first()
    blocks = max(min(LEAST_BLOCKS, -(-items // 64)), -(-items * width // BLOCK_VALUES), 1)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), F.when(j < F.col("block"), 1).otherwise(0).alias("side")))
    rows = rows.withColumn("meet", F.explode(meets)).select("item", "h", "v", "label", "meet.*")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        own = table.column("i")[0] == table.column("j")[0]
        parts = [table] if own else [table.filter(pc.equal(table.column("side"), side)) for side in (0, 1)]
        if not all(map(len, parts)):
            return
        names, at = np.unique(np.concatenate([_flat(part, "h") for part in parts]), return_inverse=True)
        cut = int(_sizes(parts[0]).sum())
        left = Side(parts[0], at[:cut], len(names))
        right = left if own else Side(parts[1], at[cut:], len(names))
        yield from visit(left, right, _tiles(left, right))

    # With many blocks each pair of them is a task of its own, of bounded size.
    return rows.repartition(blocks * (blocks + 1) // 2, "i", "j").groupBy("i", "j").applyInArrow(compare, schema)


def _batch(**columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    """Columns as they are, or of numbers, where NaN is null."""
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v, from_pandas=True) for k, v in columns.items()})


def all_pairs(left: Side, right: Side, tiles: Tiles) -> Iterator[pa.RecordBatch]:
    """``(a, b, n, r)`` with ``a < b``. Names are compared once for each item, and looked up by their numbers."""
    both = left.item if left is right else pa.concat_arrays([left.item, right.item])
    names = both.take(pc.sort_indices(both))
    place = pc.index_in(both, names).to_numpy().astype(np.int32)
    first, second = place[: len(left.item)], place[-len(right.item) :]
    for p, q, n, r in tiles:
        i, j = np.nonzero(n > 0)
        x, y = first[p][i], second[q][j]
        yield _batch(a=names.take(pa.array(np.minimum(x, y))), b=names.take(pa.array(np.maximum(x, y))), n=n[i, j].astype("int64"), r=r[i, j])


def _near(left: Side, right: Side, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of whole items whose correlation is at least ``threshold``, each once: products in single precision leave out what is below it by more than their error, the others are computed again."""
    x, y = (np.nan_to_num(s.z).astype(np.float32) for s in (left, right))
    limit = np.float32(threshold - (x.shape[1] + 8) * 2.0**-22)
    for i in range(0, len(x), TILE):
        for j in range(i if left is right else 0, len(y), TILE):
            r = x[i : i + TILE] @ y[j : j + TILE].T
            if r.max() < limit:
                continue
            a, b = np.nonzero(np.triu(r >= limit, 1) if left is right and i == j else r >= limit)
            for c in range(0, len(a), 16 * TILE):
                p, q = a[c : c + 16 * TILE] + i, b[c : c + 16 * TILE] + j
                near = np.einsum("ij,ij->i", left.z[p], right.z[q]) >= threshold
                yield p[near], q[near]


def _hang(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees that ``a`` and ``b`` are in; ``root`` has the least place of each tree."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while len(a) and (root[root] != root).any():
            root[:] = root[root]


def close_pairs(threshold: float) -> Visit:
    """``(a, b)`` that connect the items which correlations of at least ``threshold`` do, one row an item of two blocks at most, and ``(a, a)`` of every item that has a cell in common with another."""

    def visit(left: Side, right: Side, tiles: Tiles) -> Iterator[pa.RecordBatch]:
        own = left is right
        items, shift = (left.item, 0) if own else (pa.concat_arrays([left.item, right.item]), len(left.item))
        root, met = np.arange(len(items)), np.zeros(len(items), bool)

        def near() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for p, q, n, r in tiles:
                met[p] |= (n > 0).any(1)
                met[q.start + shift : q.stop + shift] |= (n > 0).any(0)
                i, j = np.nonzero(r >= threshold)
                yield i + p.start, j + q.start

        whole = left.whole and right.whole
        for i, j in _near(left, right, threshold) if whole else near():
            _hang(root, i, j + shift)
        seen = items.filter(pa.array(met | (whole and len(items) > 1)))
        yield _batch(a=seen, b=seen)
        hung = np.flatnonzero(root != np.arange(len(items)))
        yield _batch(a=items.take(pa.array(hung)), b=items.take(pa.array(root[hung])))

    return visit


def least(left: Side, right: Side, tiles: Tiles) -> Iterator[pa.RecordBatch]:
    """``(item, least)``: the least correlation of each item that has a cell in common with another, null where none is defined."""
    found = [(np.full(len(s.item), np.inf), np.zeros(len(s.item), bool)) for s in (left, right)]
    for p, q, n, r in tiles:
        high = np.where(np.isnan(r), np.inf, r)
        for (low, met), at, axis in ((found[0], p, 1), (found[1], q, 0)):
            low[at] = np.minimum(low[at], high.min(axis))
            met[at] |= (n > 0).any(axis)
    for side, (low, met) in zip((left, right), found):
        yield _batch(item=side.item.filter(pa.array(met)), least=np.where(np.isinf(low), np.nan, low)[met])


def sums(left: Side, right: Side, tiles: Tiles) -> Iterator[pa.RecordBatch]:
    """``(item, label, same, n_same, other, n_other)``: sums and numbers of the correlations of each item with items of the same label and of others."""
    found = [np.zeros((4, len(s.item))) for s in (left, right)]
    met = [np.zeros(len(s.item), bool) for s in (left, right)]
    # Labels may be text; numbers compare faster.
    codes = np.split(pa.concat_arrays([left.label, right.label]).dictionary_encode().indices.to_numpy(), [len(left.label)])
    for p, q, n, r in tiles:
        known, r = ~np.isnan(r), np.nan_to_num(r)
        same = codes[0][p][:, None] == codes[1][q][None, :]
        for k, (part, axis) in enumerate(((p, 1), (q, 0))):
            found[k][0, part] += (r * same).sum(axis)
            found[k][1, part] += (known & same).sum(axis)
            found[k][2, part] += (r * ~same).sum(axis)
            found[k][3, part] += (known & ~same).sum(axis)
            met[k][part] |= (n > 0).any(axis)
    for side, total, seen in zip((left, right), found, met):
        same, n_same, other, n_other = total[:, seen]
        known = pa.array(seen)
        yield _batch(item=side.item.filter(known), label=side.label.filter(known), same=same, n_same=n_same.astype("int64"), other=other, n_other=n_other.astype("int64"))


def every_cell(cells: DataFrame) -> bool:
    """Whether all items of ``(item, h, value)`` have the same cells."""
    each = cells.groupBy("item").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"))
    low, high, first, last = each.agg(F.min("n"), F.max("n"), F.min("x"), F.max("x")).first()
    return low is not None and (low, first) == (high, last) and cells.select("h").distinct().count() == low


def whole_sums(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """What :func:`sums` gives for each item, of items that all have the same cells: a correlation is a product of unit vectors there, and a sum of products is the product with a sum, so no pair is looked at."""
    lists = cells.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("h", "value"))).alias("cells"))
    lists = lists.select("item", F.transform("cells", lambda c: c["value"]).alias("z")).join(labels.select("item", "label"), "item")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("z").flatten().to_numpy().reshape(batch.num_rows, -1)
            top, width = np.abs(x).max(1, initial=0), x.shape[1]
            x = x - x.mean(1, keepdims=True)
            x -= x.mean(1, keepdims=True)
            square = (x * x).sum(1)
            varies = (width > 1) & (square > (top * 1e-12) ** 2 * width)
            z = np.where(varies[:, None], x / np.sqrt(np.where(varies, square, 1.0))[:, None], 0.0)
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * width), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("label"), own, pa.array(varies)], ["item", "label", "z", "varies"])

    kinds = dict(lists.dtypes)
    units = materialise(lists.select("item", "label", "z").mapInArrow(unit, f"item {kinds['item']}, label {kinds['label']}, z array<double>, varies boolean"), "units")
    added = lambda rows, *by: rows.select(*by, F.posexplode("z").alias("at", "s")).groupBy(*by, "at").agg(F.sum("s").alias("s")).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda c: c["s"]).alias("sum"))
    own = added(units, "label").join(units.groupBy("label").agg(F.count_if("varies").alias("n")), "label")
    every = added(units).withColumnRenamed("sum", "total").join(units.agg(F.count_if("varies").alias("known"), F.count("*").alias("items")), F.lit(True)).where("items > 1")
    dot = lambda c: F.aggregate(F.zip_with("z", c, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    found = units.join(own, "label").join(F.broadcast(every), F.lit(True)).withColumns({"own": dot("sum"), "all": dot("total")})
    of = lambda x, none: F.when(F.col("varies"), x).otherwise(none)
    return found.select("item", "label", of(F.col("own") - 1, 0.0).alias("same"), of(F.col("n") - 1, 0).alias("n_same"), of(F.col("all") - F.col("own"), 0.0).alias("other"), of(F.col("known") - F.col("n"), 0).alias("n_other"))
