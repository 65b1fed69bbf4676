"""User-defined aggregates and table aggregates with accumulate, retract and merge.

A subclass of :class:`Accumulator` says how one group is folded;
:func:`aggregate` runs it over a frame:

1. every task folds its own rows into one state per group, as many groups as
   it may hold at a time, and hands the states on as binary values;
2. states of a group are merged in two steps, first among :data:`TEAMS` teams
   of tasks, then over the teams, in sorted streams that hold one state at a
   time.

So a group's rows never meet in one task, only its states do: as many as tasks
that have seen it, and after the first step at most :data:`TEAMS`. Accumulate,
retract and merge must not depend on the order of rows and states.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups that a task folds at a time, and teams of tasks in the first merge.
GROUPS_HELD = 200_000
TEAMS = 256
RETRACTIONS = ("-U", "-D")


class Accumulator:
    """One group's state. ``RESULT`` names the columns that :meth:`results`
    gives, one tuple per row: one row for an aggregate, any number for a table
    aggregate. States must be picklable; override :meth:`pack` for others."""

    RESULT: T.StructType

    def create(self) -> object:
        raise NotImplementedError

    def accumulate(self, state: object, *values: object) -> object:
        raise NotImplementedError

    def retract(self, state: object, *values: object) -> object:
        """Take a row back that was accumulated, here or in another state."""
        raise NotImplementedError(f"{type(self).__name__} can't retract")

    def merge(self, state: object, other: object) -> object:
        raise NotImplementedError

    def results(self, state: object) -> Iterator[tuple]:
        raise NotImplementedError

    def pack(self, state: object) -> bytes:
        return pickle.dumps(state)

    def unpack(self, raw: bytes) -> object:
        return pickle.loads(raw)  # written by this job's own tasks


class WeightedAvg(Accumulator):
    """``sum(v * w) / sum(w)``, truncated toward zero, null where the weights
    sum up to 0. Rows with a null value or weight count for nothing."""

    RESULT = T.StructType([T.StructField("wavg", T.LongType())])

    def create(self):
        return 0, 0

    def accumulate(self, state, v, w):
        return state if v is None or w is None else (state[0] + v * w, state[1] + w)

    def retract(self, state, v, w):
        return state if v is None or w is None else (state[0] - v * w, state[1] - w)

    def merge(self, state, other):
        return state[0] + other[0], state[1] + other[1]

    def results(self, state):
        total, weight = state
        q = None if weight == 0 else abs(total) // abs(weight)
        yield (q if q is None or (total >= 0) == (weight > 0) else -q,)


class TopN(Accumulator):
    """Table aggregate: the n largest values with their ranks. Nulls and the
    empty slot's value, the least 32-bit integer, are no values. It can't
    retract: which value would follow a retracted one isn't kept."""

    RESULT = T.StructType([T.StructField("value", T.IntegerType()), T.StructField("rank", T.IntegerType())])

    def __init__(self, n: int = 2):
        self.n = n

    def create(self):
        return ()

    def accumulate(self, state, v):
        if v is None or v == -2147483648 or (len(state) == self.n and v <= state[-1]):
            return state
        return self.merge(state, (v,))

    def merge(self, state, other):
        return tuple(sorted([*state, *other], reverse=True)[: self.n])

    def results(self, state):
        yield from zip(state, range(1, len(state) + 1))


def aggregate(df: DataFrame, by: Sequence[str] | str, values: Sequence[str], acc: Accumulator,
              op: str | None = None) -> DataFrame:
    """``by`` and the accumulator's result columns for every group of ``df``.

    ``values`` are the columns given to :meth:`Accumulator.accumulate`. With a
    changelog column ``op``, rows marked ``-U`` or ``-D`` are retracted. Null
    keys are a group. An empty frame has no groups; no keys at all make the
    whole frame one group.
    """
    keys = [by] if isinstance(by, str) else list(by)
    fields = [df.schema[k] for k in keys]
    partial = T.StructType([*fields, T.StructField("__team", T.IntegerType()), T.StructField("__state", T.BinaryType())])
    final = T.StructType([*fields, *acc.RESULT.fields])
    names = [f.name for f in partial.fields]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        team = TaskContext.get().partitionId() % TEAMS
        states: dict[tuple, object] = {}
        schema = None

        def packed() -> pa.RecordBatch:
            columns = [*([k[i] for k in states] for i in range(len(keys))), [team] * len(states),
                       [acc.pack(s) for s in states.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema)], names)

        for batch in batches:
            if schema is None:
                schema = [batch.schema.field(k).type for k in keys] + [pa.int32(), pa.binary()]
            group = zip(*(batch.column(k).to_pylist() for k in keys)) if keys else iter([()] * batch.num_rows)
            rows = zip(*(batch.column(v).to_pylist() for v in values))
            ops = batch.column(op).to_pylist() if op else [None] * batch.num_rows
            for key, row, o in zip(group, rows, ops):
                state = states[key] if key in states else acc.create()
                states[key] = acc.retract(state, *row) if o in RETRACTIONS else acc.accumulate(state, *row)
            if len(states) > GROUPS_HELD:
                yield packed()
                states = {}
        if states:
            yield packed()

    def merged(rows: DataFrame, extra: list[str], out: T.StructType, last: bool) -> DataFrame:
        """Merge runs of equal keys of sorted partitions, one state at a time."""
        columns = [f.name for f in out.fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state, schema = None, None, None

            def finished() -> list[tuple]:
                key = now[:len(keys)]
                return [(*key, *r) for r in acc.results(state)] if last else [(*key, now[-1], acc.pack(state))]

            def packed(done: list[tuple]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema)], columns)

            for batch in batches:
                if schema is None:
                    own = [batch.schema.field(k).type for k in keys]
                    schema = own + ([arrow[f.name] for f in acc.RESULT.fields] if last
                                    else [pa.int32(), pa.binary()])
                done = []
                for row in zip(*(batch.column(c).to_pylist() for c in [*keys, *extra, "__state"])):
                    key, other = row[:-1], acc.unpack(row[-1])
                    if now is not None and key == now:
                        state = acc.merge(state, other)
                        continue
                    if now is not None:
                        done += finished()
                    now, state = key, other
                if done:
                    yield packed(done)
            if now is not None and (done := finished()):
                yield packed(done)

        # by no key, all is one group: its states, at most one per team, meet in one task
        spread = rows.repartition(*keys, *extra) if keys or extra else rows.coalesce(1)
        ordered = spread.sortWithinPartitions(*keys, *extra) if keys or extra else spread
        return ordered.mapInArrow(run, out)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = {f.name: to_arrow_type(f.dataType) for f in acc.RESULT.fields}
    used = [*dict.fromkeys([*keys, *values, *([op] if op else [])])]
    states = df.select(*used).mapInArrow(fold, partial)
    once = merged(states, ["__team"], partial, False)
    return merged(once.select(*[F.col(k) for k in keys], "__state"), [], final, True)
