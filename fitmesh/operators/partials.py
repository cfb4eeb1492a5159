"""Map-side partial sums of arrays, merged block by block in logarithmic depth.

Tasks turn their Arrow batches into a few named arrays and cut them into blocks.
Each merge stage adds up the arrays of one (name, block, slot), so a wide array is
merged by as many tasks as it has blocks, and only the finished blocks reach the
driver. The shuffles carry arrays, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "name string, block int, slot int, payload array<double>"
_ARROW = pa.schema([("name", pa.string()), ("block", pa.int32()), ("slot", pa.int32()), ("payload", pa.list_(pa.float64()))])
MAX_STATE_BYTES = 1 << 30  # refuse per-task state beyond this
BLOCK = 1 << 16            # values a block
FAN = 16                   # arrays of one block that a merge stage makes one of

_OPS = {"sum": np.add, "min": np.minimum}


def _record(name: str, block: int, slot: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([block], pa.int32()), pa.array([slot], pa.int32()),
         pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(values))],
        schema=_ARROW,
    )


def reduce_arrays(df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]],
                  op: str = "sum") -> dict[str, np.ndarray]:
    """``fold`` maps a task's batches to named arrays; arrays of one name are combined with ``op``.

    The first stage adds up one array a slot as they stream in (a slot for every 16 cores), each further stage ``FAN`` slots.
    """
    combine = _OPS[op]
    slots = max(1, df.sparkSession.sparkContext.defaultParallelism // FAN)

    def partial(batches, slots=slots):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        slot = (ctx.partitionId() if ctx else 0) % slots
        for name, values in fold(batches).items():
            flat = np.ascontiguousarray(values, dtype=float).ravel()
            for at in range(0, max(1, flat.size), BLOCK):
                yield _record(name, at // BLOCK, slot, flat[at:at + BLOCK])

    def merge(batches):
        state: dict[tuple[str, int, int], np.ndarray] = {}
        for batch in batches:
            payload = batch.column("payload")
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("name", "block", "slot")))):
                values = payload[i].values.to_numpy(zero_copy_only=False)
                if key in state:
                    combine(state[key], values, out=state[key])
                else:
                    state[key] = values.copy()
        for (name, block, slot), values in state.items():
            yield _record(name, block, slot // FAN, values)

    parts = df.mapInArrow(partial, _SCHEMA)
    while True:
        parts = parts.repartition("name", "block", "slot").mapInArrow(merge, _SCHEMA)
        if slots == 1:
            break
        slots = -(-slots // FAN)
    table = parts.select("name", "block", "payload").toArrow()
    names, blocks = table.column("name").to_pylist(), table.column("block").to_pylist()
    payload = table.column("payload").combine_chunks()
    found: dict[str, list[np.ndarray]] = {}
    for i in sorted(range(len(names)), key=lambda i: (names[i], blocks[i])):
        found.setdefault(names[i], []).append(payload[i].values.to_numpy(zero_copy_only=False))
    return {name: np.concatenate(values) for name, values in found.items()}
