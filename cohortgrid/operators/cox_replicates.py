"""Cox models of one covariate (Efron's ties) for many weightings of the same rows at once, as passes over blocks of :func:`cox_path.time_blocks`."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cox_path import Scan, array_of, lists, time_blocks

#: Values of a block's weights at most, models that are evaluated at once, and tied deaths up to which each tie is a pass over the times.
VALUES, MODELS, TIES = 1 << 20, 16, 64


def _efron(beta: np.ndarray, risk: np.ndarray, dead: np.ndarray, d: np.ndarray, xd: np.ndarray) -> np.ndarray:
    """Log-likelihood, score and information of times by models, from sums ``risk`` and ``dead`` (three, with powers of the covariate) and the numbers and covariate sums of the dead."""
    total = xd.sum(0)
    out = np.stack([beta * total, total, np.zeros_like(total)])
    at = np.nonzero(d > 0)
    n, risk, dead, p = d[at].astype(np.int64), risk[:, at[0], at[1]], dead[:, at[0], at[1]], len(beta)

    def add(a: np.ndarray, model: np.ndarray) -> None:
        mean = a[1] / a[0]
        for k, v in enumerate((-np.log(a[0]), -mean, a[2] / a[0] - mean * mean)):
            out[k] += np.bincount(model, v, p)

    if len(n) and n.max() > TIES:
        cell = np.repeat(np.arange(len(n)), n)
        part = (np.arange(len(cell)) - np.repeat(np.cumsum(n) - n, n)) / n[cell]
        add(risk[:, cell] - part * dead[:, cell], at[1][cell])
        return out
    tie, cell = 0, np.arange(len(n))
    while len(cell):
        add(risk[:, cell] - tie / n[cell] * dead[:, cell] if tie else risk, at[1][cell])
        tie += 1
        cell = cell[n[cell] > tie]
    return out


class Replicates:
    """The rows ``(time, event, risk, w)`` with ``n`` weights each. Times that several blocks hold are added up on the driver, a few numbers for each block and model."""

    def __init__(self, rows: DataFrame, n: int):
        self.n = n
        self.blocks = time_blocks(rows, max(1, VALUES // n)).select("block", "time", F.col("event").cast("array<double>").alias("event"), "risk", F.flatten("w").alias("w"))
        self.scan = Scan(self.blocks)
        first, last = self.scan.first, self.scan.last
        self.shared = np.zeros((self.scan.n, 2), dtype=bool)
        self.shared[1:, 0] = self.shared[:-1, 1] = first[1:] == last[:-1]
        self.sizes = self._pass(lambda b, s, w, x, e: w.sum(0)[None], 1, True, True)[0]

    def _pass(self, of: Callable, k: int, drawn: bool, add: bool) -> np.ndarray:
        """``k`` rows of a number for each model: of each block (empty ones are 0), or with ``add`` of all blocks, which a task adds up."""
        n = self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for i in range(batch.num_rows):
                    block, x, e = batch.column("block")[i].as_py(), array_of(batch, "risk", i), array_of(batch, "event", i)
                    w = array_of(batch, "w", i).reshape(-1, n) if drawn else np.ones((len(x), n), np.int8)
                    found = of(block, np.unique(array_of(batch, "time", i), return_index=True)[1], w, x, e)
                    if add:
                        total = found if total is None else total + found
                    else:
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), lists(found.reshape(1, -1))], ["block", "v"])
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), lists(total.astype(float).reshape(1, -1))], ["block", "v"])

        # All tasks run at once: iterating over the rows would run one after the other.
        found = self.blocks.mapInArrow(run, "block int, v array<double>").toArrow()
        values = [v.values.to_numpy().reshape(-1, n) for v in found.column("v")]
        if add:
            return np.sum(values, 0)
        out = np.zeros((self.scan.n, k, n))
        for block, v in zip(found.column("block").to_pylist(), values):
            out[block, : len(v)] = v
        return out

    def terms(self, beta: np.ndarray, drawn: bool = True) -> np.ndarray:
        """Log-likelihood, score and information of each model at ``beta``."""
        shared = self.shared

        def each(of: Callable) -> np.ndarray:
            """``of`` of some models after the other, so that what it makes of the rows is small."""
            return np.concatenate([of(slice(c, min(c + MODELS, len(beta)))) for c in range(0, len(beta), MODELS)], -1)

        def sums(block: int, starts: np.ndarray, w: np.ndarray, x: np.ndarray, e: np.ndarray) -> np.ndarray:
            """The three sums at risk; where a time is in other blocks too, also those of the first and the last time with those of its dead, their number and covariates."""
            powers = np.stack([np.ones_like(x), x, x * x])

            def of(c: slice) -> np.ndarray:
                own = np.exp(x[:, None] * beta[c]) * w[:, c]
                out = [powers @ own]
                if shared[block].any():
                    for s in (slice(0, starts[1] if len(starts) > 1 else None), slice(starts[-1], None)):
                        died = powers[:, s] * e[s]
                        out += [powers[:, s] @ own[s], died @ own[s], died[:2] @ w[s, c].astype(float)]
                return np.concatenate(out)

            return each(of)

        found = self._pass(sums, 19, drawn, False)
        after = np.zeros_like(found[:, :3])
        after[:-1] = np.cumsum(found[:0:-1, :3], 0)[::-1]

        def inside(block: int, starts: np.ndarray, w: np.ndarray, x: np.ndarray, e: np.ndarray) -> np.ndarray:
            group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(x)))
            keep = np.ones(len(starts), bool)
            keep[0] &= not shared[block, 0]
            keep[-1] &= not shared[block, 1]
            died = np.flatnonzero((e == 1) & keep[group])
            if not len(died):
                return np.zeros((3, len(beta)))
            first = np.flatnonzero(np.diff(group[died], prepend=-1))
            at, y = starts[group[died][first]], x[died][:, None]

            def of(c: slice) -> np.ndarray:
                own = np.exp(x[:, None] * beta[c]) * w[:, c]
                risk, dead, part = [], [], own[died]
                for k in range(3):
                    risk.append(np.cumsum(own[::-1], 0)[::-1][at] + after[block, k, c])
                    dead.append(np.add.reduceat(part, first))
                    if k < 2:
                        own *= x[:, None]
                        part = part * y
                n = w[died, c].astype(float)
                return _efron(beta[c], np.stack(risk), np.stack(dead), np.add.reduceat(n, first), np.add.reduceat(n * y, first))

            return each(of)

        out = self._pass(inside, 3, drawn, True)
        # A time over several blocks: the last block's part of it, whole blocks between, and the first one's.
        b = 0
        while b < self.scan.n:
            if not self.shared[b, 1]:
                b += 1
                continue
            g, end = found[b, 11:].copy(), b
            while self.shared[end, 1]:
                end += 1
                g += found[end, 3:11]
                if self.scan.first[end] != self.scan.last[end]:
                    break
            out += _efron(beta, (after[end] + found[end, :3] - found[end, 3:6] + g[:3])[:, None], g[3:6, None], g[6][None], g[7][None])
            b = end
        return out

    def fit(self, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients by Newton steps until none is of size, and the log-likelihoods without the covariate."""
        beta, null = np.zeros(self.n), None
        for _ in range(rounds):
            ll, score, information = self.terms(beta)
            null = ll if null is None else null
            step = np.where(information > 0, np.clip(score / np.where(information > 0, information, 1.0), -2, 2), 0.0)
            beta = beta + step
            if (np.abs(step) <= 1e-12 * np.maximum(1.0, np.abs(beta))).all():
                break
        return beta, null

    def loglik(self, beta: np.ndarray, drawn: bool = True) -> np.ndarray:
        """Log-likelihoods at ``beta`` of the drawn rows, or of every row once."""
        return self.terms(beta, drawn)[0]
