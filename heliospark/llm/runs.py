"""Running positions, sums, exclusive-ors and composed state maps within a key, without a task per key.

Rows are dealt to tasks by ranges of (key, order), so a key that holds a third of all rows spans many tasks. Each task runs
over its own rows; what a key brings along from earlier tasks is one row per task at most and is added afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliospark.llm.shared import keep

_LOCAL = ("__part", "__row")


def by_range(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """Rows sorted by (key, order) over all tasks, nulls first; rows equal in these may lie in several tasks."""
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    columns = [F.col(key), *(F.col(c) if isinstance(c, str) else c for c in order), F.col("__tie")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tied.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).drop("__tie")


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of an integer column, 0 where null, and which are null."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def changes(values: np.ndarray, null: np.ndarray, before: tuple[int, bool] | None) -> np.ndarray:
    """Where another key starts, given the key of the row before."""
    out = np.empty(len(values), bool)
    out[0] = before is None or before != (int(values[0]), bool(null[0]))
    out[1:] = (values[1:] != values[:-1]) | (null[1:] != null[:-1])
    return out


def _segmented(x: np.ndarray, new: np.ndarray, carried: int, xor: bool) -> np.ndarray:
    run, segment, starts = (np.bitwise_xor if xor else np.add).accumulate(x), np.cumsum(new), np.flatnonzero(new)
    if xor:
        return run ^ np.concatenate([[carried], run[starts] ^ x[starts]])[segment]
    return run - np.concatenate([[-carried], run[starts] - x[starts]])[segment]


IDENTITY = 0b11100100  # a map of four states to four states, two bits each


def applied(code: int, state: int) -> int:
    return code >> 2 * state & 3


def _sum(a: int, b: int) -> int:
    return a + b


def _xor(a: int, b: int) -> int:
    return a ^ b


def _then(first: int, second: int) -> int:
    """The map that applies one map and then another."""
    return sum(applied(second, applied(first, s)) << 2 * s for s in range(4))


def _composed(x: np.ndarray, new: np.ndarray, carried: int) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for i, (code, fresh) in enumerate(zip(x.tolist(), new.tolist())):
        carried = code if fresh else _then(carried, code)
        out[i] = carried
    return out


def _later(combine, carried: Column, own: Column) -> Column:
    if combine is _sum:
        return own + F.coalesce(carried, F.lit(0))
    if combine is _xor:
        return own.bitwiseXOR(F.coalesce(carried, F.lit(0)))
    first = F.coalesce(carried, F.lit(IDENTITY).cast("long"))

    def bits(value: Column, at: Column | int) -> Column:
        return F.call_function("shiftright", value, F.lit(at) if isinstance(at, int) else at).bitwiseAND(F.lit(3))
    states = [F.shiftleft(bits(own, (bits(first, 2 * s) * 2).cast("int")), 2 * s) for s in range(4)]
    return sum(states[1:], states[0])


def _run(key: str, columns: list[str], combines: list, names: list[str]):
    def run(batches):
        from pyspark import TaskContext
        part, row, before, carried = TaskContext.get().partitionId(), 0, None, [IDENTITY if c is _then else 0 for c in combines]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = changes(*(at := plain(batch.column(key))), before)
            before = int(at[0][-1]), bool(at[1][-1])
            values = [np.ones(n, np.int64)] + [plain(batch.column(c))[0] for c in columns]
            found = [_composed(x, new, c) if how is _then else _segmented(x, new, c, how is _xor) for x, c, how in zip(values, carried, combines)]
            carried = [int(f[-1]) for f in found]
            local = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n))]
            row += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found), *local], names=[*batch.schema.names, *names, *_LOCAL])
    return run


def _carries(tails: list, combines: list) -> list[tuple]:
    """What the first key of each task brings along: (task, key, values), only where it does."""
    out, key, held = [], object(), None
    for part, first, last, values in sorted(tails, key=lambda t: t[0]):
        if first == key:
            out.append((part, first, *held))
            if last == first:
                values = [how(a, b) for how, a, b in zip(combines, held, values)]
        key, held = last, values
    return out


def running(df: DataFrame, key: str, order: list[str | Column], sums: tuple[str, ...] = (), xors: tuple[str, ...] = (),
            maps: tuple[str, ...] = (), name: str = "running") -> DataFrame:
    """Add ``position`` (from 1) and ``run_<column>`` for running sums, exclusive-ors and compositions of state maps, each within
    ``key`` and up to the row itself.

    ``key`` is an integer column, null being a key too; nulls among the values count as 0. ``df`` is read twice (for the
    ranges): pass a written table. One row per task reaches the driver.
    """
    columns = [*sums, *xors, *maps]
    combines = [_sum] * (1 + len(sums)) + [_xor] * len(xors) + [_then] * len(maps)
    spark, names = df.sparkSession, ["position", *(f"run_{c}" for c in columns)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    schema = ", ".join([fields, *(f"`{n}` long" for n in names), "__part int", "__row long"])
    table = keep(by_range(df, key, order).mapInArrow(_run(key, columns, combines, names), schema), name)
    ends = table.groupBy("__part").agg(F.min_by(F.struct(key), "__row").alias("first"), F.max_by(F.struct(key, *names), "__row").alias("last"))
    carries = _carries([(r[0], r[1][0], r[2][0], list(r[2][1:])) for r in ends.collect()], combines)
    if carries:
        added = spark.createDataFrame(carries, ", ".join(["__p int", "__k long", *(f"`__{n}` long" for n in names)]))
        table = table.join(F.broadcast(added), (F.col("__part") == F.col("__p")) & F.col(key).eqNullSafe(F.col("__k")), "left")
        table = table.withColumns({n: _later(how, F.col(f"__{n}"), F.col(n)) for n, how in zip(names, combines)})
    return table.select(*df.columns, *names)
