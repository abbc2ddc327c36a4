"""What the operators of this package share: Arrow batches and hashing.

Arrow batches are bounded in bytes by Spark itself (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB), so no operator changes a
setting of the session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.sources.scratch import discard, shared_dir, stash

__all__ = ["SPACES", "WORD", "annotate", "crc_bucket", "discard", "lists", "shared_dir", "stash", "utf8", "with_columns"]

#: Words of the contracts that split at ASCII white space: the same set that bytes.split() uses.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def crc_bucket(doc_id, n: int):
    """crc32 of the id as text, modulo n: the folds of the contracts."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def with_columns(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    """The batch with further columns; a column of the same name is replaced."""
    kept = [i for i, name in enumerate(batch.schema.names) if name not in names]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + arrays, names=[batch.schema.names[i] for i in kept] + names)


def annotate(df: DataFrame, function: Callable[[list[bytes | None]], list[pa.Array]], added: T.StructType, text: str = "text") -> DataFrame:
    """`df` with the columns `added` that `function` makes of the text; input columns of the same names are replaced.

    One narrow Arrow pass: no shuffle, one batch in memory at a time. All other columns are carried through as they are.
    """
    names = [f.name for f in added]
    schema = T.StructType([f for f in df.schema if f.name not in names] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield with_columns(batch, names, function(utf8(batch.column(batch.schema.names.index(text)))))

    return df.mapInArrow(run, schema)


def lists(flat: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list array of the consecutive runs of `flat`."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(flat))
