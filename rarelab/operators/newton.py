"""What tasks do in a grouped Newton fit: rows to blocks, blocks to states, states
to the next coefficients.  Apart from the models, so that a Python worker loads
no more than it needs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

FAN_IN = 64  # a group's states of many tasks are merged in two steps
BLOCK_ROWS = 4096  # rows of a group that are one row of the packed table


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _names_of(table, group: list[str]) -> list[tuple]:
    """The group of every row."""
    return list(zip(*(table.column(g).to_pylist() for g in group), strict=True))


def packer(group: list[str], d: int, schema: pa.Schema):
    """Rows to blocks of one group each: ``x`` (rows x features), ``y`` and counts, flat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch = batch.sort_by([(g, "ascending") for g in group])
            tags = _names_of(batch, group)
            cuts = [0, *(i for i in range(1, len(tags)) if tags[i] != tags[i - 1]), len(tags)]
            spans = [(a, min(a + BLOCK_ROWS, hi)) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)
                     for a in range(lo, hi, BLOCK_ROWS)]
            x, y, n = (batch.column(c) for c in ("__x", "__y", "__n"))
            flat = lambda c: [c.slice(a, b - a) for a, b in spans]
            cols = [batch.column(g).take(pa.array([a for a, _ in spans])) for g in group]
            cols += [pa.array([v.flatten().to_numpy(zero_copy_only=False) for v in flat(x)], pa.list_(pa.float64()))]
            cols += [pa.array([v.to_numpy(zero_copy_only=False) for v in flat(c)], pa.list_(pa.float64())) for c in (y, n)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
    return run


def gram(group: list[str], d: int, schema: pa.Schema):
    """Blocks with their group's coefficients to one state per group and task: loss, gradient and Hessian."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list] = {}
        for batch in batches:
            for i, tag in enumerate(_names_of(batch, group)):
                theta, *rest = (batch.column(c)[i].as_py() for c in ("theta", "step", "objective"))
                x = batch.column("__x")[i].values.to_numpy(zero_copy_only=False).reshape(-1, d)
                y, n = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("__y", "__n"))
                x = np.hstack((np.ones((len(y), 1)), x))
                eta = x @ np.asarray(theta)
                p = np.exp(-np.logaddexp(0, -eta))
                hessian = (x * (n * p * (1 - p))[:, None]).T @ x
                state = np.concatenate(([float(n @ (np.logaddexp(0, eta) - y * eta))], x.T @ (n * (p - y)), hessian.ravel()))
                if tag in states:
                    states[tag][0] += state
                else:
                    states[tag] = [state, theta, *rest]
        if states:
            cols = [pa.array([t[j] for t in states], schema.field(g).type) for j, g in enumerate(group)]
            cols += [pa.array([s[j] for s in states.values()], schema.field(c).type)
                     for j, c in enumerate(("state", "theta", "step", "objective"))]
            cols.append(pa.array([TaskContext.get().partitionId() % FAN_IN] * len(states), pa.int32()))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)
    return run


def merge(table: pa.Table) -> pa.Table:
    """Several states of one group as one."""
    width = len(table.column("state")[0])
    total = _numbers(table.column("state").combine_chunks(), width).sum(axis=0)
    at = table.schema.get_field_index("state")
    return table.slice(0, 1).set_column(at, table.schema.field(at), pa.array([total], table.schema.field(at).type))


def newton(group: list[str], d: int, C: float, tol: float, schema: pa.Schema):
    """One damped Newton step of a group, from its whole state."""
    def run(table: pa.Table) -> pa.Table:
        row = merge(table).to_pylist()[0]
        state, theta, step = (np.asarray(row[c], dtype=np.float64) for c in ("state", "theta", "step"))
        loss, gradient, hessian = state[0], state[1:d + 2], state[d + 2:].reshape(d + 1, d + 1)
        penalty = np.eye(d + 1)
        penalty[0, 0] = 0
        objective = 0.5 * float(theta[1:] @ theta[1:]) + C * loss
        done, before = False, row["objective"]
        if objective > before + 1e-12 * abs(before) and np.max(np.abs(step)) > tol:
            step = step / 2.0  # the last step went too far: half of it back
            theta, objective = theta + step, before
        else:
            delta = -np.linalg.solve(C * hessian + penalty, C * gradient + penalty @ theta)
            done = bool(np.max(np.abs(delta)) < tol)
            theta, step = (theta, step) if done else (theta + delta, -delta)
        out = {**{g: row[g] for g in group}, "theta": theta, "step": step, "objective": objective, "done": done}
        return pa.Table.from_pylist([out], schema=schema)
    return run
