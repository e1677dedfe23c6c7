"""Counts of concordant pairs, for one or many weights of the rows.

Times and risks are cut into blocks near quantiles, a cut being a block of its own. Two rows of the same block of times are compared there, two of different ones by their
blocks of risks, and where these are the same within that. So no pair is a row, and a row is sent twice at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Rows of a block, values of their weights, and blocks of a group at most; weights that are added up at once.
ROWS, VALUES, MOST_BLOCKS, AT_ONCE = 1 << 17, 1 << 21, 64, 16


def _inside(t: np.ndarray, event: np.ndarray, r: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pairs, concordant and tied ones of each weight (column of ``w``). Two numbers of times part at the highest bit that differs; rows are compared at each bit with those that share the higher bits."""
    t, r = np.unique(t, return_inverse=True)[1], np.unique(r, return_inverse=True)[1]
    out = np.zeros((3, w.shape[1]), dtype=np.int64)
    for level in range(int(t.max(initial=0)).bit_length()):
        late = (t >> level) & 1 == 1
        at = np.flatnonzero(late | event)
        at = at[np.lexsort((r[at], t[at] >> (level + 1)))]
        later, node = late[at], t[at] >> (level + 1)
        key = node * (r.max() + 1) + r[at]
        asks = np.flatnonzero(~later)
        ends = [np.searchsorted(x, x[asks], side) for x in (node, key) for side in ("left", "right")]
        for c in range(0, w.shape[1], AT_ONCE):
            own = w[at, c : c + AT_ONCE].astype(np.int64)
            upto = np.zeros((len(at) + 1, own.shape[1]), dtype=np.int64)
            np.cumsum(np.where(later[:, None], own, 0), axis=0, out=upto[1:])
            start, end, first, last = (upto[e] for e in ends)
            own = own[asks]
            out[:, c : c + AT_ONCE] += [(own * (end - start)).sum(0), (own * (first - start)).sum(0), (own * (last - first)).sum(0)]
    return out


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x, dtype=np.int64).ravel()))


def weighted_concordance(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., pairs, concordant, tied)``, arrays by weight, of rows ``(by.., time, event, risk, w)`` with ``w`` an array of whole weights. ``rows`` is a table that may be read several times; nothing is null."""
    by = list(by)
    n = rows.groupBy(*by).agg(F.count("*").alias("n"), F.max(F.size("w")).alias("k")).agg(F.max("n"), F.max("k")).first()
    blocks = min(MOST_BLOCKS, -(-(n[0] or 0) // max(1, min(ROWS, VALUES // max(1, n[1] or 1)))))
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        cut = lambda c: F.array_distinct(F.percentile_approx(c, shares)).alias(f"_{c}")
        cuts = F.broadcast(materialise(rows.groupBy(*by).agg(cut("time"), cut("risk")), "cuts"))
        rows = rows.join(cuts, by) if by else rows.join(cuts, F.lit(True))
        # Odd blocks are of one value.
        place = lambda c: (2 * F.size(F.filter(f"_{c}", lambda x: x < F.col(c))) + F.array_contains(f"_{c}", F.col(c)).cast("int")).cast("int")
        rows = rows.withColumns({"tb": place("time"), "kb": place("risk")})
    else:
        rows = rows.withColumns({"tb": F.lit(0), "kb": F.lit(0)})
    rows = rows.select(*by, "time", (F.col("event") == 1).alias("event"), "risk", "w", "tb", "kb")
    keys = [f for f in rows.schema if f.name in by]
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in keys)
    schema = kinds + "tb int, kb int, a array<long>, b array<long>, c array<long>"

    def answer(table: pa.Table, tb: np.ndarray, kb: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> pa.Table:
        own = {f.name: pa.concat_arrays([table.column(f.name).combine_chunks().slice(0, 1)] * len(tb)) if len(tb) else table.column(f.name).combine_chunks().slice(0, 0) for f in keys}
        return pa.table(own | {"tb": pa.array(tb, pa.int32()), "kb": pa.array(kb, pa.int32()), "a": _lists(a), "b": _lists(b), "c": _lists(c)})

    def columns(table: pa.Table, *names: str) -> list[np.ndarray]:
        return [table.column(c).to_numpy() for c in names]

    def in_times(table: pa.Table) -> pa.Table:
        """Pairs of one block of times, and for the others what each of its blocks of risks asks and answers."""
        t, e, r, tb, kb = columns(table, "time", "event", "risk", "tb", "kb")
        w = _matrix(table, "w")
        found = [x[None] for x in _inside(t, e, r, w)] if tb[0] % 2 == 0 else [np.zeros((1, w.shape[1]))] * 3
        if blocks <= 1:
            return answer(table, [0], [-1], *found)
        order = np.argsort(kb, kind="stable")
        names, first = np.unique(kb[order], return_index=True)
        w, e = w[order].astype(np.int64), e[order]
        asks, later = np.add.reduceat(np.where(e[:, None], w, 0), first), np.add.reduceat(w, first)
        cells = [np.concatenate(x) for x in zip(found, (asks, later, 0 * later))]
        return answer(table, np.full(len(names) + 1, tb[0]), np.concatenate([[-1], names]), *cells)

    def in_risks(table: pa.Table) -> pa.Table:
        """Pairs of one block of risks and different blocks of times."""
        e, r, tb = columns(table, "event", "risk", "tb")
        found = _inside(tb, e, r, _matrix(table, "w"))
        return answer(table, [0], [-1], 0 * found[:1], found[1:2], found[2:3])

    def whole(table: pa.Table) -> pa.Table:
        tb, kb = columns(table, "tb", "kb")
        a, b, c = (_matrix(table, x) for x in "abc")
        done = kb < 0
        out = np.stack([x[done].sum(0) for x in (a, b, c)])
        if not done.all():
            ts, i = np.unique(tb[~done], return_inverse=True)
            ks, j = np.unique(kb[~done], return_inverse=True)
            asks, later = (np.zeros((len(ts), len(ks), a.shape[1]), dtype=np.int64) for _ in range(2))
            asks[i, j], later[i, j] = a[~done], b[~done]
            later = np.cumsum(later[::-1], 0)[::-1]
            later = np.concatenate([later[1:], 0 * later[:1]])
            lower = np.cumsum(later, 1) - later
            odd = ks % 2 == 1
            out += [(asks.sum(1) * later.sum(1)).sum(0), (asks * lower).sum((0, 1)), (asks[:, odd] * later[:, odd]).sum((0, 1))]
        return answer(table, [0], [-1], out[:1], out[1:2], out[2:3])

    # Many rows of one time need no comparison there, so they are dealt by risk.
    part = F.when(F.col("tb") % 2 == 1, F.col("kb")).otherwise(-1)
    parts = rows.groupBy(*by, "tb", part.alias("part")).applyInArrow(in_times, schema)
    if blocks > 1:
        parts = parts.unionByName(rows.where("kb % 2 = 0").groupBy(*by, "kb").applyInArrow(in_risks, schema))
    found = parts.groupBy(*by).applyInArrow(whole, schema)
    return found.select(*by, F.col("a").alias("pairs"), F.col("b").alias("concordant"), F.col("c").alias("tied"))
