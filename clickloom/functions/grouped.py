"""Python functions over all values of a key, one Arrow batch in memory at a time.

Spark deals rows out by key, sorts them (on disk where they do not fit) and hands each
task its rows in key order; the function reads them as they come.  So a key may have any
number of rows: what is held is one batch and whatever the function keeps.  A key still is the
work of one task, as an arbitrary function cannot be cut in parts.  Functions that can be
are faster as ``udfs.fold_in_batches``.

* ``fold_values``: one result for each key, from an iterator over its values.
* ``stream_groups``: any rows for each key, from an iterator over its record batches.
* ``register_fold``: the same fold as a table function for SQL.
"""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

Fold = Callable[[Iterator], object]

_ROWS_OUT = 10_000


def run_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where the rows of a key begin, in a batch ordered by ``keys``; NULL is a key."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices
        new[1:] |= np.diff(codes.to_numpy(zero_copy_only=False)) != 0
    return np.nonzero(new)[0]


def same_key(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def key_at(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


class _Runs:
    """(key, iterator over its values) for each key of batches in key order.

    As with ``itertools.groupby`` the values of a key are to be read before the next key;
    what is left unread is passed over.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch], keys: Sequence[str], value: str, nulls: bool):
        self.batches, self.keys, self.value, self.nulls = batches, keys, value, nulls
        self.pieces = self._pieces()
        self.next = next(self.pieces, None)

    def _pieces(self) -> Iterator[tuple[tuple, list]]:
        for batch in self.batches:
            if not batch.num_rows:
                continue
            starts = run_starts(batch, self.keys)
            names = [batch.column(k).take(pa.array(starts)).to_pylist() for k in self.keys]
            values = batch.column(self.value).to_pylist()
            ends = [*starts[1:].tolist(), batch.num_rows]
            for key, a, b in zip(zip(*names), starts.tolist(), ends):
                yield key, values[a:b]

    def _values(self, key: tuple) -> Iterator:
        while self.next is not None and same_key(self.next[0], key):
            piece, self.next = self.next[1], None
            yield from piece if self.nulls else (v for v in piece if v is not None)
            self.next = next(self.pieces, None)

    def __iter__(self) -> Iterator[tuple[tuple, Iterator]]:
        while self.next is not None:
            key = self.next[0]
            values = self._values(key)
            yield key, values
            for _ in values:
                pass
            while self.next is None:  # the values were given up in the middle of a piece
                self.next = next(self.pieces, None)
                if self.next is None:
                    return
                if same_key(self.next[0], key):
                    self.next = None


def fold_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fold: Fold,
    kind: str = "bigint",
    out: str = "n",
    order: Sequence[str | Column] = (),
    nulls: bool = False,
) -> DataFrame:
    """Rows (keys, ``out``): ``fold`` of an iterator over all values of each key.

    Values come in ``order`` if one is given.  NULLs are left out unless ``nulls``; a key that has
    only NULLs still gets its row.  A function that wants a list takes ``list(values)``,
    and that list then has to fit.
    """
    keys = list(keys)
    fields = {f.name: f for f in df.schema}
    result = to_arrow_type(_parse_datatype_string(kind))
    kinds = [to_arrow_type(fields[k].dataType) for k in keys] + [result]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*held), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, out])

        for key, values in _Runs(batches, keys, value, nulls):
            held.append((*key, fold(values)))
            if len(held) == _ROWS_OUT:
                yield batch()
                held = []
        if held:
            yield batch()

    schema = ", ".join([f"`{k}` {fields[k].dataType.simpleString()}" for k in keys] + [f"`{out}` {kind}"])
    columns = list(dict.fromkeys([*keys, value, *(o for o in order if isinstance(o, str))]))
    rows = df.select(*columns) if all(isinstance(o, str) for o in order) else df
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.select(*keys, value).mapInArrow(run, schema)


def stream_groups(
    df: DataFrame,
    keys: Sequence[str],
    f: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """``f(key, batches)`` for each key, ``batches`` being its rows as they are read, in ``order``."""

    def each(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(tuple(k.as_py() for k in key), batches)

    # Spark reads the kind of function off its annotations.
    each.__annotations__ = {
        "key": tuple[pa.Scalar, ...],
        "batches": Iterator[pa.RecordBatch],
        "return": Iterator[pa.RecordBatch],
    }
    rows = df.repartition(*keys).sortWithinPartitions(*keys, *order) if order else df
    return rows.groupBy(*keys).applyInArrow(each, schema)


class _Pushed:
    """Runs ``fold`` beside the caller, who hands it values batch by batch."""

    def __init__(self, fold: Fold):
        self.waiting: queue.Queue = queue.Queue(maxsize=2)
        self.done = threading.Event()
        self.result, self.error = None, None
        self.thread = threading.Thread(target=self._run, args=(fold,), daemon=True)
        self.thread.start()

    def _values(self) -> Iterator:
        while (values := self.waiting.get()) is not None:
            yield from values

    def _run(self, fold: Fold) -> None:
        try:
            self.result = fold(self._values())
        except BaseException as error:  # noqa: BLE001  raised again where the result is asked for
            self.error = error
        finally:
            self.done.set()

    def push(self, values: list | None) -> None:
        while not self.done.is_set():
            try:
                return self.waiting.put(values, timeout=0.05)
            except queue.Full:
                continue

    def finish(self):
        self.push(None)
        self.thread.join()
        if self.error:
            raise self.error
        return self.result


def register_fold(spark: SparkSession, name: str, fold: Fold, key: str, out: str, nulls: bool = False) -> None:
    """``fold`` as a table function for SQL, over a table of a key and a value column:

    ``SELECT * FROM name(TABLE(SELECT k, v FROM t) PARTITION BY k ORDER BY v)``

    calls it for each key, each time with a new object and a batch of results.  Where keys are many, let it have
    those of a bucket one after another:

    ``SELECT * FROM name(TABLE(SELECT k, v FROM t) PARTITION BY pmod(hash(k), 4096) ORDER BY (k, v))``

    ``key`` and ``out`` are the columns of the result, as ``"k bigint"`` and ``"n bigint"``.
    """
    made = _parse_datatype_string(f"{key}, {out}")
    names, kinds = made.names, [to_arrow_type(f.dataType) for f in made]

    class OverKeys:
        def __init__(self):
            self.key, self.values, self.running = None, None, None
            self.held: list[tuple] = []

        def end(self) -> None:
            """The result of the key read last."""
            if self.running is not None:
                self.held.append((*self.key, self.running.finish()))
            elif self.values is not None:
                self.held.append((*self.key, fold(iter(self.values))))
            self.values, self.running = None, None

        def results(self) -> pa.Table:
            found, self.held = self.held, []
            return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*found), kinds)})

        def eval(self, rows: pa.RecordBatch):
            column = rows.schema.names[0]
            starts = run_starts(rows, [column]).tolist()
            values = rows.column(1).to_pylist()
            for a, b in zip(starts, [*starts[1:], rows.num_rows]):
                now = key_at(rows, [column], a)
                some = values[a:b] if nulls else [v for v in values[a:b] if v is not None]
                if self.key is not None and same_key(self.key, now):
                    # Only a key that goes on beyond a batch needs a thread that waits for more.
                    if self.running is None:
                        self.running = _Pushed(fold)
                        self.running.push(self.values)
                    self.running.push(some)
                    continue
                self.end()
                self.key, self.values = now, some
                if len(self.held) == _ROWS_OUT:
                    yield self.results()

        def terminate(self):
            self.end()
            if self.held:
                yield self.results()

    spark.udtf.register(name, F.arrow_udtf(OverKeys, returnType=f"{key}, {out}"))
