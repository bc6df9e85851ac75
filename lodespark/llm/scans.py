"""Running products of a monoid along the rows of each key, however many rows a key has."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodespark.llm.storage import partitions
from lodespark.staging import stage

# A state is three whole numbers.
State = tuple[int, int, int]
Combine = Callable[[State, State], State]
STATE = ("_x", "_y", "_z")


@dataclass(frozen=True)
class Scan:
    """Rows with their states: products from the first row of the key to this one."""

    local: DataFrame  # states from the first row of the key in the same partition
    key: str
    carried: dict[int, tuple[int, State]]  # by partition: key of its first rows, product before them
    combine: Combine

    def rows(self, *columns: str) -> DataFrame:
        """The chosen columns, and the states as ``_x, _y, _z``."""
        picked = self.local.where("not _tail").select("_part", *STATE, self.key, *columns)
        sent = self.local.sparkSession.sparkContext.broadcast(self.carried)  # a few numbers a partition
        key, combine = self.key, self.combine

        def completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for part, x, y, z, own in zip(*(c.to_pylist() for c in batch.columns[:5])):
                    before = sent.value.get(part)
                    state = (x, y, z)
                    found.append(combine(before[1], state) if before and before[0] == own else state)
                arrays = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
                yield pa.RecordBatch.from_arrays([*arrays, *batch.columns[4:]], names=[*STATE, key, *columns])

        kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
        return picked.mapInArrow(
            completed, ", ".join([*(f"{s} long" for s in STATE), *(f"`{c}` {kinds[c]}" for c in (key, *columns))])
        )


def scan(rows: DataFrame, key: str, order: list[Column], elements: tuple[str, str, str], unit: State, combine: Combine) -> Scan:
    """Dealt by range of ``order``, which begins with ``key``, each partition multiplies its own rows.

    As the product is associative, a partition hands on only that of its last key; these, one a
    partition, are multiplied on the driver. ``key`` and the elements are longs without nulls. A last
    number deals out equal rows, too.
    """
    fields = [f for f in rows.schema if f.name not in ("_part", "_tail", *STATE)]
    names = [f.name for f in fields]

    def told(part: int, whole: bool, tail: bool, columns: dict, states: list[State], size: int) -> pa.RecordBatch:
        arrays = [columns.get(n, pa.nulls(size, kinds[n])) for n in names]
        arrays += [pa.array(c, pa.int64()) for c in zip(*states)]
        arrays += [pa.array([v] * size) for v in (part, whole, tail)]
        names_ = [*names, *STATE, "_part", "_whole", "_tail"]
        return pa.RecordBatch.from_arrays([a.cast(pa.int64()) if n == "_part" else a for n, a in zip(names_, arrays)], names=names_)

    kinds: dict[str, pa.DataType] = {}

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own, state, first = None, unit, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds.update((f.name, f.type) for f in batch.schema)
            states = []
            for k, *element in zip(*(batch[c].to_pylist() for c in (key, *elements))):
                if k != own:
                    own, state = k, unit
                    first = k if first is None else first
                state = combine(state, element)
                states.append(state)
            yield told(part, False, False, {n: batch[n] for n in names}, states, batch.num_rows)
        if own is not None:
            last = {key: pa.array([own], pa.int64())}
            yield told(part, own == first, True, last, [state], 1)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    dealt = rows.repartitionByRange(partitions(rows), *order, F.monotonically_increasing_id())
    local = stage(
        dealt.sortWithinPartitions(*order).mapInArrow(
            multiplied, f"{columns}, _x long, _y long, _z long, _part long, _whole boolean, _tail boolean"
        )
    )
    carried, before = {}, None
    tails = local.where("_tail").select("_part", key, *STATE, "_whole").collect()
    for part, own, *state, whole in sorted(map(tuple, tails)):
        if before is not None:
            carried[part] = before
        same = whole and before is not None and before[0] == own
        before = own, combine(before[1], tuple(state)) if same else tuple(state)
    return Scan(local, key, carried, combine)
