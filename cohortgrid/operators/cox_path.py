"""Paths of L1-penalised Cox models (Breslow ties) for many folds at once.

Penalties are taken in falling order, each from the solution before. The sequential strong rule leaves most features out
of a penalty's models; what it leaves is fitted by steps that a weighted Gram matrix and the gradient of these few
features give, shortened until the objective falls enough. A penalty is done when the optimality conditions
of *all* features hold, which one pass over the whole table tells; features that break them are let in.

Subjects are written once in order of time, in blocks of bounded size. Sums along the times are those within a block and what the blocks
after or before it come to, so that an evaluation is a pass over the blocks without a shuffle, and only a few numbers for
each block and model go through the driver (:class:`Scan`). With martingale residuals the gradient is a weighted sum over subjects. The driver
keeps coefficients (models by features) and the Gram matrices of the features let in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import global_row_number
from ..session import materialise

#: Values of a row of sums, and subjects of a block at most.
FEATURES, TIMES = 256, 8192
#: Values of all features in a block at most, unless one subject has more.
MOST_SUMS = 1 << 18
#: Sums of up to so many values are sent by each task and added up on the driver.
FEW_SUMS = 1 << 12


def time_blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with a ``time`` as ``(block, column..)``: blocks of ``size`` rows in order of time, every column an array. Equal times may be parted."""
    numbered = global_row_number(rows, [F.col("time")], "nth").withColumn("block", F.floor((F.col("nth") - 1) / size).cast("int"))
    # A number of partitions that is asked for is kept, however small they are: later passes are tasks by file.
    own = numbered.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("nth", *rows.columns))).alias("c"))
    return materialise(own.select("block", *(F.col(f"c.{n}").alias(n) for n in rows.columns)), "blocks")


class Scan:
    """Sums over all earlier or later rows of :func:`time_blocks`, from sums of blocks; rows of equal time count together, wherever they are.

    A block tells its sum, that of its first time and that of its last time. To the sums within a block come those of the blocks after it (before it), and
    to those of its first (last) time what earlier (later) blocks hold of the same time.
    """

    def __init__(self, blocks: DataFrame):
        ends = sorted(tuple(r) for r in blocks.select("block", F.element_at("time", 1), F.element_at("time", -1)).collect())
        self.n, self.first, self.last = len(ends), np.array([e[1] for e in ends], dtype=float), np.array([e[2] for e in ends], dtype=float)

    def later(self, total: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each block: the sum of the blocks after it, and what the first time has in blocks before it."""
        after, same = np.zeros_like(total), np.zeros_like(total)
        after[:-1] = np.cumsum(total[:0:-1], 0)[::-1]
        for b in range(1, self.n):
            if self.last[b - 1] == self.first[b]:
                same[b] = last[b - 1] + (same[b - 1] if self.first[b - 1] == self.last[b - 1] else 0)
        return after, same

    def earlier(self, total: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each block: the sum of the blocks before it, and what the last time has in blocks after it."""
        before, same = np.zeros_like(total), np.zeros_like(total)
        before[1:] = np.cumsum(total[:-1], 0)
        for b in range(self.n - 2, -1, -1):
            if self.first[b + 1] == self.last[b]:
                same[b] = first[b + 1] + (same[b + 1] if self.first[b + 1] == self.last[b + 1] else 0)
        return before, same


def from_end(x: np.ndarray, first: np.ndarray, after: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Sums of ``x`` over the rows of the same or a later time; ``first`` is the place of each row's first equal."""
    out = (np.cumsum(x[::-1], 0)[::-1] + after)[first]
    out[first == 0] += same
    return out


def from_start(x: np.ndarray, last: np.ndarray, before: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Sums of ``x`` over the rows of the same or an earlier time; ``last`` is the place of each row's last equal."""
    out = (np.cumsum(x, 0) + before)[last]
    out[last == len(x) - 1] += same
    return out


def equals(time: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last place of each row's time in ascending ``time``."""
    return np.searchsorted(time, time, "left"), np.searchsorted(time, time, "right") - 1


def array_of(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x, dtype=float).ravel()))


def _summed(rows: DataFrame, key: str) -> DataFrame:
    """Arrays ``v`` of equal length added up by ``key``."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [pdf[key].iat[0]], "v": [np.sum(np.stack(list(pdf.v)), 0)]})

    return rows.groupBy(key).applyInPandas(add, f"{key} long, v array<double>")


class _Cohort:
    """The cohort's blocks, and the passes over them for all models."""

    def __init__(self, x: DataFrame, surv: DataFrame, fold_table: DataFrame):
        self.spark = x.sparkSession
        self.names = [r[0] for r in x.select("feature").distinct().orderBy("feature").collect()]
        pairs = sorted((int(r), int(f)) for r, f in fold_table.select("repeat", "fold").distinct().collect())
        self.models = [(0, 0), *pairs]
        numbers = self.spark.createDataFrame([(i, r, f) for i, (r, f) in enumerate(self.models)], "m int, repeat int, fold int")
        usable = surv.select("subject", F.col("time").cast("double").alias("time"), F.col("event").cast("double").alias("dead")).where("time is not null and dead is not null")
        index = F.broadcast(self.spark.createDataFrame(list(enumerate(self.names)), f"j int, feature {x.schema['feature'].dataType.simpleString()}"))
        cells = x.join(index, "feature").select("subject", F.struct("j", F.col("value").cast("double").alias("value")).alias("c"))
        whole = cells.groupBy("subject").agg(F.array_sort(F.collect_list("c")).alias("c")).where(F.size("c") == len(self.names)).select("subject", F.transform("c", lambda c: c["value"]).alias("x"))
        out = fold_table.join(F.broadcast(numbers), ["repeat", "fold"]).groupBy("subject").agg(F.collect_list("m").alias("out"))
        subjects = whole.join(usable, "subject").join(out, "subject", "left").select("time", "dead", "x", F.coalesce("out", F.array().cast("array<int>")).alias("out"))
        wide = time_blocks(subjects, max(1, min(TIMES, MOST_SUMS // max(1, len(self.names)))))
        self.blocks = wide.withColumn("x", F.flatten("x"))
        self.scan = Scan(self.blocks)
        self.let_in: list[int] | None = None
        self.few = self.blocks
        self.admit([])
        self.events = np.maximum(1.0, self._collect("events", lambda b: [b.dead.sum(0)], 1)[0].sum(0))

    def admit(self, features: list[int]) -> None:
        """Let ``features`` (numbers) into the models: the table ``few`` holds their values of each subject, unless they are all or none."""
        if features == self.let_in:
            return
        self.let_in = features
        p, picks = len(self.names), np.array(features, dtype=int)
        if 0 < len(features) < p:
            def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        v = array_of(batch, "x", i).reshape(-1, p)[:, picks]
                        yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in ("block", "time", "dead", "out")), lists(v.reshape(1, -1))], ["block", "time", "dead", "out", "x"])

            self.few = materialise(self.blocks.select("block", "time", "dead", "out", "x").mapInArrow(pick, "block int, time array<double>, dead array<double>, out array<array<int>>, x array<double>"), "few")
        else:
            self.few = self.blocks

    def _each(self, whole: bool = False) -> tuple[DataFrame, Callable]:
        """The table to pass over, and what makes a block of a row: its let-in values ``v``, all values ``x``, ``keep``, ``dead`` and ``first`` and ``last`` of equal times."""
        n, p = len(self.models), len(self.names)
        own = np.array(self.let_in, dtype=int)
        narrow = 0 < len(own) < p and not whole

        class Block:
            def __init__(self, batch: pa.RecordBatch, i: int):
                self.block = batch.column("block")[i].as_py()
                self.first, self.last = equals(array_of(batch, "time", i))
                out = batch.column("out")[i].values
                self.keep = np.ones((len(self.first), n))
                self.keep[np.repeat(np.arange(len(out)), out.value_lengths().to_numpy()), out.flatten().to_numpy()] = 0
                self.dead = array_of(batch, "dead", i)[:, None] * self.keep
                self.x = array_of(batch, "x", i).reshape(len(self.first), -1)
                self.v = self.x if narrow or len(own) == p else self.x[:, own]

            def weights(self, beta: np.ndarray) -> None:
                self.eta = self.v @ beta.T
                self.w = np.exp(self.eta) * self.keep

            def steps(self, after: np.ndarray, same: np.ndarray) -> np.ndarray:
                self.risk = np.where(self.dead > 0, from_end(self.w, self.first, after[self.block], same[self.block]), 1.0)
                return self.dead / self.risk

        return (self.few if narrow else self.blocks).select("block", "time", "dead", "out", "x"), Block

    def _collect(self, name: str, of: Callable, k: int) -> list[np.ndarray]:
        """``k`` numbers of each model for each block, by ``of``, as arrays (blocks by models)."""
        table, block = self._each()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    b = block(batch, i)
                    yield pa.RecordBatch.from_arrays([pa.array([b.block], pa.int32()), lists(np.concatenate(of(b)).reshape(1, -1))], ["block", "v"])

        out = np.zeros((k, self.scan.n, len(self.models)))
        for r in table.mapInArrow(run, "block int, v array<double>").collect():
            out[:, r.block] = np.reshape(r.v, (k, -1))
        return list(out)

    def hazards(self, beta: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Mean log-likelihood of each model at ``beta`` (models by features let in), and what blocks need of the others for the residuals there."""

        def mass(b) -> list[np.ndarray]:
            b.weights(beta)
            return [b.w.sum(0), b.w[b.last == len(b.w) - 1].sum(0)]

        after, same = self.scan.later(*self._collect("mass", mass, 2))

        def value(b) -> list[np.ndarray]:
            b.weights(beta)
            step = b.steps(after, same)
            return [(b.dead * (b.eta - np.log(b.risk))).sum(0), step.sum(0), step[b.first == 0].sum(0)]

        log, total, first = self._collect("value", value, 3)
        return log.sum(0) / self.events, (after, same, *self.scan.earlier(total, first))

    def _added(self, beta: np.ndarray, sums: tuple, shape: tuple, add: Callable, whole: bool) -> np.ndarray:
        """What ``add`` makes of the blocks' residuals ``r`` and weights ``w``, added up: each task sends its sum."""
        table, block = self._each(whole)
        after, same, before, equal = sums
        size = int(np.prod(shape))
        step = max(1, size) if size <= FEW_SUMS else FEATURES

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for i in range(batch.num_rows):
                    b = block(batch, i)
                    b.weights(beta)
                    w = b.w * from_start(b.steps(after, same), b.last, before[b.block], equal[b.block])
                    add(total, b, b.dead - w, w)
            flat = total.ravel()
            for at in range(0, len(flat), step):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), lists(flat[None, at : at + step])], ["at", "v"])

        added, out = table.mapInArrow(run, "at long, v array<double>"), np.zeros(size)
        for r in added.collect() if size <= FEW_SUMS else _summed(added, "at").toLocalIterator():
            out[r["at"] : r["at"] + len(r.v)] += r.v
        return out.reshape(shape)

    def gradient(self, beta: np.ndarray, sums: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and Gram matrices over the features let in, for each model."""
        n, p = len(self.models), len(self.let_in)

        def add(total: np.ndarray, b, r: np.ndarray, w: np.ndarray) -> None:
            total[:, :, 0] += r.T @ b.v
            for m in range(n):
                total[m, :, 1:] += (b.v.T * w[:, m]) @ b.v

        out = self._added(beta, sums, (n, p, p + 1), add, False)
        return out[:, :, 0] / self.events[:, None], out[:, :, 1:] / self.events[:, None, None]

    def whole_gradient(self, beta: np.ndarray, sums: tuple) -> np.ndarray:
        """The gradient of every feature in every model."""

        def add(total: np.ndarray, b, r: np.ndarray, w: np.ndarray) -> None:
            total += r.T @ b.x

        return self._added(beta, sums, (len(self.models), len(self.names)), add, True) / self.events[:, None]


def _descend(gram: np.ndarray, gradient: np.ndarray, beta: np.ndarray, lam: float, sweeps: int = 2000) -> np.ndarray:
    """Coefficients that minimise the penalised quadratic, by coordinate descent."""
    new, left = beta.copy(), gradient.copy()
    size = np.maximum(np.diag(gram), 1e-12)
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(new)):
            pull = left[j] + size[j] * new[j]
            to = np.sign(pull) * max(abs(pull) - lam, 0.0) / size[j]
            if to != new[j]:
                left -= gram[:, j] * (to - new[j])
                most = max(most, abs(to - new[j]) * size[j])
                new[j] = to
        if most < 1e-12:
            break
    return new


def violation(gradient: np.ndarray, beta: np.ndarray, lam: float) -> np.ndarray:
    """How far each coefficient is from its optimality condition."""
    return np.where(beta != 0, np.abs(gradient - lam * np.sign(beta)), np.maximum(np.abs(gradient) - lam, 0.0))


def fit_path(x: DataFrame, surv: DataFrame, fold_table: DataFrame, lambdas: Sequence[float], tolerance: float = 1e-7, rounds: int = 100) -> DataFrame:
    """``(repeat, fold, lam, feature, coef)`` of the models on all but each fold, and of the whole cohort as fold 0.

    Every coefficient meets its condition to ``tolerance``, in units of the mean gradient; a model that doesn't within ``rounds`` steps is an error.
    Subjects without time, event or one of the features don't count; without subjects or features there are no rows.
    """
    spark, schema = x.sparkSession, f"repeat int, fold int, lam double, feature {x.schema['feature'].dataType.simpleString()}, coef double"
    if not lambdas or not x.limit(1).count() or not surv.limit(1).count():
        return spark.createDataFrame([], schema)
    cohort = _Cohort(x, surv, fold_table)
    n, p = len(cohort.models), len(cohort.names)
    beta, out = np.zeros((n, p)), []
    _, sums = cohort.hazards(beta[:, :0])
    full = cohort.whole_gradient(beta[:, :0], sums)
    before = float(np.abs(full).max(initial=0.0))
    for lam in sorted({float(v) for v in lambdas}, reverse=True):
        # Far below the penalty before, the rule would let in most features; what it is held to here is made good by the check of all conditions.
        keep = (beta != 0).any(0) | (np.abs(full) >= max(2 * lam - max(before, lam), 0.8 * lam)).any(0)
        while True:
            own = np.flatnonzero(keep)
            cohort.admit(own.tolist())
            current, sums = _fit(cohort, beta[:, own], lam, tolerance, rounds)
            beta[:, own] = current
            full = cohort.whole_gradient(current, sums)
            broken = (violation(full, beta, lam) > tolerance).any(0) & ~keep
            if not broken.any():
                break
            keep |= broken
        out += [(r, f, lam, name, float(b)) for (r, f), row in zip(cohort.models, beta) for name, b in zip(cohort.names, row)]
        before = lam
    return spark.createDataFrame(out, schema)


def _fit(cohort: _Cohort, start: np.ndarray, lam: float, tolerance: float, rounds: int) -> tuple[np.ndarray, tuple]:
    """The models of one penalty over the features let in, and the blocks' sums at them."""
    beta = start.copy()
    value, sums = cohort.hazards(beta)
    if not beta.shape[1]:
        return beta, sums
    objective = lambda v, b: v - lam * np.abs(b).sum(1)
    for _ in range(rounds):
        gradient, gram = cohort.gradient(beta, sums)
        far = violation(gradient, beta, lam).max(1)
        open_ = far > tolerance
        if not open_.any():
            return beta, sums
        aim = np.stack([_descend(gram[m], gradient[m], beta[m], lam) if open_[m] else beta[m] for m in range(len(beta))])
        step = np.ones(len(beta))
        # What the step promises to first order; a share of it must come true.
        promised = ((aim - beta) * gradient).sum(1) - lam * (np.abs(aim).sum(1) - np.abs(beta).sum(1))
        while True:
            tried = beta + step[:, None] * (aim - beta)
            # Coefficients that the full step sets to zero are zero.
            tried[(aim == 0) & (step[:, None] == 1)] = 0.0
            new, ahead = cohort.hazards(tried)
            short = objective(new, tried) < objective(value, beta) + 0.01 * step * promised - 1e-12
            if not short.any() or step.min() < 1e-6:
                break
            step[short] /= 2
        beta, value, sums = tried, new, ahead
    raise RuntimeError(f"a model is still {far.max():.2g} from its conditions after {rounds} steps")
