"""Small helpers for the operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes in a text column, one row at least."""
    for batch in batches:
        texts = batch.column(column)
        start = used = 0
        for i, text in enumerate(texts):
            size = len(text.as_buffer()) if text.is_valid else 0
            if i > start and used + size > limit:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += size
        if batch.num_rows > start:
            yield batch.slice(start)


def mapped(names: list[str], work: Callable[[pa.RecordBatch], list], column: str = "text", limit: int = 8_000_000):
    """A mapInArrow function: `work` returns the output columns of one slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, column, limit):
            yield pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in work(part)], names)

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups with their bounds, from batches sorted by `keys`.

    Only the last group of a batch waits for the next one.
    """
    import pyarrow.compute as pc

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        bounds = _bounds(table, keys, pc)
        rest = table.slice(bounds[-2])
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
    if rest is not None:
        yield rest, [0, rest.num_rows]


def _bounds(table: pa.Table, keys: list[str], pc) -> list[int]:
    n = table.num_rows
    new = None
    for key in keys:
        column = table.column(key)
        differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), False)
        new = differs if new is None else pc.or_(new, differs)
    cuts = pc.indices_nonzero(new).to_pylist() if n > 1 else []
    return [0, *[c + 1 for c in cuts], n]
