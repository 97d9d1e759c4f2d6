"""Records that go over several lines of text files, read by as many tasks as files have blocks.

Spark reads a large text file in blocks, each in a task of its own, so a record may begin in
one block and end in another. Each task joins the lines of its own block and sends on only
what stands at its edges: the lines before its first record, and its last record. These few
pieces meet in a small job, ordered by block; everything else stays where it was read.

Where a line's meaning hangs on what came before it, such as an open quote, a first pass
notes for each block the state at its end for every state at its beginning. Followed from block
to block, that gives the state each block begins in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.sources.records import UNIT
from maskwright.sources.routing import BLOCK, LINE, PARTITION
from maskwright.sources.scratch import new_folder

#: The number of a record within its block, from 1; 0 is the part before the first one.
PLACE = "place"
HEAD = "head"
_LAST = "__last"
_STATE = "__state"
_ROW = "__row"

#: Blocks, with their files' names, that are broadcast at most; more are joined by a shuffle.
BROADCAST_BLOCKS = 200_000

#: For a line and the state before it: whether a record begins with it, and the state after it.
Step = Callable[[str, int], tuple[bool, int]]


def joined_by_head(lines: DataFrame, head: Column) -> DataFrame:
    """Records that begin with a line for which ``head`` holds and go on to the next such line.

    ``lines`` are those of ``read_lines``, in the order that Spark reads them. The result has the
    same columns, where ``line`` is a whole record, its lines joined by ``\\n``, and ``place``, its
    number in the block it begins in. Lines before a file's first record are one of place 0.
    """
    marked = lines.withColumn(HEAD, F.coalesce(head, F.lit(False)))
    return _joined(marked, lambda: lambda line, head, state: (head, 0))


def joined_by_state(lines: DataFrame, states: int, make: Callable[[], Step]) -> DataFrame:
    """The same where the step that ``make`` makes in each task tells where records begin.

    A file begins in state 0, of ``states``.
    """
    # Only blocks that begin in another state than a file does are listed.
    entered = _entered(lines, states, make).where(F.col(_STATE) != 0)
    on = [UNIT, BLOCK]
    if entered.count() <= BROADCAST_BLOCKS:
        marked = lines.join(F.broadcast(entered), on, "left")
    else:
        # A join by shuffle deals lines out by block; their numbers put them in order again.
        numbered = lines.withColumn(_ROW, F.monotonically_increasing_id())
        joined = numbered.join(entered.hint("merge"), on, "left").repartition(*on)
        marked = joined.sortWithinPartitions(*on, _ROW).drop(_ROW)
    marked = marked.withColumns({_STATE: F.coalesce(_STATE, F.lit(0)), HEAD: F.lit(False)})

    def stepped():
        step = make()
        return lambda line, head, state: step(line, state)

    return _joined(marked, stepped)


def _joined(marked: DataFrame, make) -> DataFrame:
    pieces = _pieces(marked, make)
    edge = (F.col(PLACE) == 0) | F.col(_LAST)
    # Two for each block at most. Both reads give the same pieces, as blocks are the same.
    edges = _stored(pieces.where(edge).drop(_LAST), "edges")
    return pieces.where(~edge).drop(_LAST).unionByName(_met(edges))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, str]]:
    for row, (unit, block, line) in enumerate(
        zip(*(batch.column(name).to_pylist() for name in (UNIT, BLOCK, LINE)))
    ):
        yield (unit, block), row, line


def _entered(lines: DataFrame, states: int, make: Callable[[], Step]) -> DataFrame:
    """(unit, block, state at its beginning) of all blocks."""

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        key, after = None, []
        for batch in batches:
            done = []
            for own, _, line in _runs(batch):
                if own != key:
                    if key is not None:
                        done.append((*key, after))
                    key, after = own, list(range(states))
                after = [step(line, state)[1] for state in after]
            if done:
                yield table_of(done)
        if key is not None:
            yield table_of([(*key, after)])

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()))
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, [UNIT, BLOCK, "exits"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, state = None, 0
        for batch in batches:
            rows = []
            for own, block, after in zip(*(c.to_pylist() for c in batch.columns)):
                if own != unit:
                    unit, state = own, 0
                rows.append((own, block, state))
                state = after[state]
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int32())
                columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [UNIT, BLOCK, _STATE])

    kind = f"{UNIT} string, {BLOCK} bigint"
    blocks = lines.select(UNIT, BLOCK, LINE).mapInArrow(exits, f"{kind}, exits array<int>")
    ordered = blocks.repartition(UNIT).sortWithinPartitions(UNIT, BLOCK)
    return _stored(ordered.mapInArrow(follow, f"{kind}, {_STATE} int"), "blocks")


def _pieces(marked: DataFrame, make) -> DataFrame:
    """The records of each block, as far as they lie in it."""
    kept = [UNIT, BLOCK] + ([PARTITION] if PARTITION in marked.columns else [])
    given = [*kept, LINE, HEAD] + ([_STATE] if _STATE in marked.columns else [])
    schema = T.StructType([marked.schema[name] for name in (*kept, LINE)])
    schema = schema.add(PLACE, "long").add(_LAST, "boolean")
    has_state, has_partition = _STATE in given, PARTITION in given

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        key, partition, state, place, own = None, None, 0, 0, []
        done: list[tuple] = []

        def close(last: bool) -> None:
            if own:
                values = (*key, partition) if has_partition else key
                done.append((*values, "\n".join(own), place, last))
                own.clear()

        for batch in batches:
            heads = batch.column(HEAD).to_pylist()
            for now, row, line in _runs(batch):
                if now != key:
                    close(True)
                    key, place = now, 0
                    state = batch.column(_STATE)[row].as_py() if has_state else 0
                    partition = batch.column(PARTITION)[row].as_py() if has_partition else None
                head, state = step(line, heads[row], state)
                if head:
                    close(False)
                    place += 1
                own.append(line)
            if done:
                yield table_of(done, batch)
                done.clear()
            final = batch
        close(True)
        if done:
            yield table_of(done, final)

    def table_of(rows: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds = [batch.schema.field(name).type for name in (*kept, LINE)]
        kinds += [pa.int64(), pa.bool_()]
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return marked.select(given).mapInArrow(join, schema)


def _met(edges: DataFrame) -> DataFrame:
    """Last records of blocks with the lines of later blocks that belong to them."""
    schema = edges.schema

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict | None = None
        parts: list[str] = []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if first is None or row[UNIT] != first[UNIT] or row[PLACE] > 0:
                    if first is not None:
                        done.append({**first, LINE: "\n".join(parts)})
                    first, parts = row, []
                parts.append(row[LINE])
            if done:
                yield pa.RecordBatch.from_pylist(done, batch.schema)
            final = batch
        if first is not None:
            yield pa.RecordBatch.from_pylist([{**first, LINE: "\n".join(parts)}], final.schema)

    ordered = edges.repartition(UNIT).sortWithinPartitions(UNIT, BLOCK, PLACE)
    return ordered.mapInArrow(meet, schema)


def first_of_file() -> Column:
    """Whether a joined record is the first one of its file."""
    return (F.col(BLOCK) == 0) & (F.col(PLACE) == 1)
