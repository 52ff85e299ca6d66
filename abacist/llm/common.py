"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SPACES = r"\x20\x09-\x0D"
SLICE = 1000
"""Rows that a Python worker turns into results at once."""
WORD = rf"[^{SPACES}]+"


def give_back() -> None:
    """Return freed memory to the system. Spark keeps a worker for later tasks, beside which other stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def per_batch(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Apply a pandas-to-pandas function to slices of every Arrow batch; no rows are gathered."""

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), SLICE):
                yield fn(batch.iloc[i:i + SLICE].reset_index(drop=True))
            batch = None
            give_back()

    return df.mapInPandas(run, schema)


def per_slice(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Apply a function from a slice of an Arrow batch to a list of columns; a worker holds one slice as Python objects."""
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE // 2):
                columns = fn(batch.slice(i, SLICE // 2))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)
            batch = columns = None
            give_back()

    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, inside one expression."""
    return F.transform(F.array(value), body)[0]


def uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends only on the key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(2**53))


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
