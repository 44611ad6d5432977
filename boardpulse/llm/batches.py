"""Arrow batches cut into pieces of bounded text, for operators that hold much per character."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20


#: Rows of an Arrow batch: with texts of some kilobytes, a batch takes a few megabytes in Spark and in Python.
ROWS_PER_BATCH = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_batches(frame: DataFrame, run: Run, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over batches of bounded rows; a larger setting of the session is lowered for that."""
    conf = frame.sparkSession.conf
    if not 0 < int(conf.get(_ROWS)) <= ROWS_PER_BATCH:
        conf.set(_ROWS, str(ROWS_PER_BATCH))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back_memory()

    return frame.mapInArrow(tidy, schema)


def give_back_memory() -> None:
    """Returns freed memory to the system: Python workers stay for later stages and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
    if trim:
        trim(0)


def by_text_size(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def replaced(batch: pa.RecordBatch, drop: str, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without one column and with new ones at the end."""
    kept = [n for n in batch.schema.names if n != drop]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new.values()], [*kept, *new])


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list array of numpy rows."""
    ends = np.cumsum([0, *(len(r) for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else [], kind))
