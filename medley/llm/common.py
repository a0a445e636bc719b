"""Small helpers shared by the training-data operators.

Conventions of every operator here: only the named id and text columns are
read, so extra or clashing columns never matter; a NULL text counts as the
empty text; rows that repeat are separate rows unless a docstring says
otherwise; an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medley.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LOWER_AZ = str.maketrans(UPPER, LOWER)


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text with NULL read as empty."""
    return F.coalesce(df[text_col], F.lit(""))


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (a NULL id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts lineage so that several readers share one computation; the files are
    on storage all executors see, so a lost executor costs nothing."""
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


SMALL = 16 << 20        # bytes of a written table that is sent to every task rather than shuffled


def sent_if_small(table: DataFrame, most: int = SMALL) -> DataFrame:
    """A written table, marked to be broadcast if its files have at most ``most``
    bytes; a larger one is joined as the planner sees fit."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(table) if size <= most else table


SLICE = 1 << 20         # bytes of text a task handles at once


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of at most ``most`` bytes in a text column,
    or of one row with a longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(upto[at - 1]) if at else 0
            end = max(int(np.searchsorted(upto, before + most, side="right")), at + 1)
            yield batch.slice(at, end - at)
            at = end


__all__ = ["WORD", "sent_if_small", "text_slices", "LOWER_AZ", "text_of", "fold_of", "written"]
