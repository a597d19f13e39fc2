"""What a task computes with numpy on Arrow batches of plain rows: moments, errors of linear models, recurrences along lists.

A task hands back a few numbers for each group it met (moments, errors), or a row for each
list and grid point (recurrences). Spark deals the rows and brings the tasks' numbers together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Lists that one pass walks side by side.
TOGETHER = 512


def groups(batch: pa.RecordBatch, by: int) -> list[tuple[int, np.ndarray]]:
    """(a row of the group, the group's rows) by the first ``by`` columns; a null is a key of its own."""
    n = batch.num_rows
    code = np.zeros(n, np.int64)
    for i in range(by):
        keys = batch.column(i).dictionary_encode(null_encoding="encode")
        code = code * max(len(keys.dictionary), 1) + keys.indices.to_numpy(zero_copy_only=False)
        _, code = np.unique(code, return_inverse=True)  # stays below the batch's rows
    order = np.argsort(code, kind="stable")
    return [(int(rows[0]), rows) for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1) if len(rows)]


def _values(batch: pa.RecordBatch, by: int, rows: np.ndarray) -> np.ndarray:
    columns = [batch.column(i).to_numpy(zero_copy_only=False)[rows] for i in range(by, batch.num_columns)]
    return np.column_stack(columns).astype(float, copy=False)


def central(x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, means, central co-moments); a constant column has none at all."""
    first = x[0]
    with np.errstate(all="ignore"):
        x = x - first
        mean = x.mean(axis=0)
        x -= mean
        return float(len(x)), first + mean, x.T @ x


def together(a, b):
    """Central co-moments of two disjoint sets of rows as those of their union."""
    if a is None:
        return b
    (n, mean, spread), (m, other, added) = a, b
    with np.errstate(all="ignore"):
        gap = other - mean
        return n + m, mean + gap * m / (n + m), spread + added + np.outer(gap, gap) * n * m / (n + m)


class _Held:
    """Sums of a task by group: the group's key as a batch of one row, its moments, any number of plain sums."""

    def __init__(self):
        self.found: dict[tuple, list] = {}

    def add(self, key: pa.RecordBatch, moments, sums=0.0) -> None:
        name = tuple(c[0].as_py() for c in key.columns)
        held = self.found.setdefault(name, [key, None, 0.0])
        held[1], held[2] = together(held[1], moments), held[2] + sums

    def rows(self) -> Iterator[tuple]:
        yield from self.found.values()


def _listed(rows: Sequence[np.ndarray]) -> pa.Array:
    return pa.array([np.ravel(r) for r in rows], pa.list_(pa.float64()))


def moments(by: int):
    """Task of (keys, numbers): (keys, n, mean, m2) of each group it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            for at, rows in groups(batch, by):
                held.add(batch.select(range(by)).slice(at, 1), central(_values(batch, by, rows)))
        for key, (n, mean, m2), _ in held.rows():
            numbers = [pa.array([int(n)]), _listed([mean]), _listed([m2])]
            yield pa.RecordBatch.from_arrays([*key.columns, *numbers], [*key.schema.names, "n", "mean", "m2"])

    return run


def _moments_of(table: pa.Table):
    """The union of a group's moments."""
    whole = None
    for n, mean, m2 in zip(*(table.column(c).to_pylist() for c in ("n", "mean", "m2"))):
        mean = np.array(mean)
        whole = together(whole, (float(n), mean, np.array(m2).reshape(len(mean), -1)))
    return whole


def covariances(by: int):
    """A group's (keys, n, mean, m2) as one row (keys, n, mean, upper triangle of the covariances)."""

    def run(table: pa.Table) -> pa.Table:
        n, mean, m2 = _moments_of(table)
        key = table.slice(0, 1).select(range(by))
        numbers = [pa.array([int(n)]), _listed([mean]), _listed([(m2 / n)[np.triu_indices(len(mean))]])]
        return pa.table([*key.columns, *numbers], [*key.schema.names, "n", "mean", "cov"])

    return run


def linear_errors(weights: np.ndarray, intercepts: np.ndarray):
    """Task of (split, features, label): (split, n, mean, m2, sums) with the label's moments and, for each linear model, summed squared and absolute errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            for at, rows in groups(batch, 1):
                x = _values(batch, 1, rows)
                with np.errstate(all="ignore"):
                    wrong = x[:, :-1] @ weights.T + intercepts - x[:, -1:]
                    sums = np.concatenate([np.einsum("ij,ij->j", wrong, wrong), np.abs(wrong).sum(axis=0)])
                held.add(batch.select([0]).slice(at, 1), central(x[:, -1:]), sums)
        for key, (n, mean, m2), sums in held.rows():
            numbers = [pa.array([int(n)]), _listed([mean]), _listed([m2]), _listed([sums])]
            yield pa.RecordBatch.from_arrays([*key.columns, *numbers], [*key.schema.names, "n", "mean", "m2", "sums"])

    return run


def linear_metrics(names: Sequence[str]):
    """A split's (split, n, mean, m2, sums) as a row (model, split, n, rmse, mae, r2) for each model."""

    def run(table: pa.Table) -> pa.Table:
        n, _, m2 = _moments_of(table)
        squared, absolute = np.sum(table.column("sums").to_pylist(), axis=0).reshape(2, -1) / n
        spread = float(m2[0, 0]) / n
        r2 = [None] * len(names) if spread == 0 else (1.0 - squared / spread).tolist()
        key = table.column(0).combine_chunks().take(pa.array([0] * len(names)))
        columns = [pa.array(list(names)), key, pa.array([int(n)] * len(names)), pa.array(np.sqrt(squared)), pa.array(absolute), pa.array(r2, pa.float64())]
        return pa.table(columns, ["model", table.schema.names[0], "n", "rmse", "mae", "r2"])

    return run


# ---- recurrences along lists ------------------------------------------------------------


def _doubles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of lists."""
    offsets = np.asarray(column.offsets)
    return column.values.to_numpy(zero_copy_only=False), offsets


def walks(keep: int, kernel: Callable, grid: Sequence[tuple[float, float]], names: Sequence[str]):
    """Task of (``keep`` columns, xs, _h, one more number): a row for each list and grid point.

    ``kernel(columns, h, more, first, second)`` walks lists side by side: ``columns`` are their
    numbers by position, each with the lists that reach so far (the longest lists come first),
    ``h`` each list's starting states and ``more`` its number. It gives arrays of lists by grid points.
    """
    first, second = (np.array([g[i] for g in grid]) for i in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _doubles(batch.column(keep))
            states, start = _doubles(batch.column(keep + 1))
            more = batch.column(keep + 2).to_numpy(zero_copy_only=False).astype(float, copy=False)
            lengths = np.diff(at)
            order = np.argsort(-lengths, kind="stable")
            for a in range(0, len(order), TOGETHER):
                mine = order[a : a + TOGETHER]
                size, begin = lengths[mine], at[mine]
                reach = np.searchsorted(-size, -np.arange(size[0]), side="left") if len(size) else []
                columns = (values[begin[:k] + t][:, None] for t, k in enumerate(reach))
                h = states[start[mine][:, None] + np.arange(len(grid))]
                with np.errstate(all="ignore"):
                    ends = kernel(columns, h, more[mine][:, None], first, second)
                rows = pa.array(np.repeat(mine, len(grid)))
                kept = [batch.column(i).take(rows) for i in range(keep)]
                points = [pa.array(np.tile(p, len(mine))) for p in (first, second)]
                yield pa.RecordBatch.from_arrays([*kept, *points, *(pa.array(e.ravel()) for e in ends)], [*batch.schema.names[:keep], *names])

    return run


def garch_kernel(columns, h, v, alpha, beta):
    """(next variance, log likelihood) from the variances ``h`` on; ``v`` is the variance of the series."""
    h, ll = h.copy(), np.zeros_like(h)
    still = v * (1.0 - alpha - beta)
    for x in columns:
        k = len(x)
        now = h[:k]
        ll[:k] = ll[:k] - 0.5 * (np.log(now) + x * x / now)
        h[:k] = still[:k] + alpha * x * x + beta * now
    return h, ll


def arma_kernel(columns, e, before, phi, theta):
    """(last observation, last shock, summed squares) from the shocks ``e`` and the observation before on."""
    e, sse = e.copy(), np.zeros_like(e)
    prev = before.copy()
    for x in columns:
        k = len(x)
        e[:k] = x - phi * prev[:k] - theta * e[:k]
        prev[:k] = x
        sse[:k] = sse[:k] + e[:k] * e[:k]
    return np.broadcast_to(prev, e.shape), e, sse
