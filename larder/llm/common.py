"""Helpers of the operators: tables, per-text Arrow maps, equality classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without the columns that an operator is about to add; names compare without case, as Spark does."""
    taken = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def fresh(name: str, *frames: DataFrame) -> str:
    """The name, or the name with underscores after it, such that no frame has a column of that name."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts, or lists, hold about `limit` bytes; a longer one is a run of its own."""
    values = batch.column(column)
    lengths = pc.multiply(pc.list_value_length(values), 32) if pa.types.is_list(values.type) else pc.binary_length(values)
    sizes = pc.fill_null(lengths, 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


Derive = Callable[[list], Sequence[Sequence]]


def with_derived(
    df: DataFrame, column: str, fields: Sequence[StructField], make: Callable[[], Derive], limit: int = SLICE_BYTES
) -> DataFrame:
    """Add columns computed from one text or binary column, a bounded run of rows at a time.

    `make` runs once per task and returns a function from a list of values (None for null) to one list per field.
    Columns that already carry a field's name are replaced. Rows are neither moved nor shuffled.
    """
    kept = without(df, [f.name for f in fields])
    schema = StructType([*kept.schema.fields, *fields])
    at = kept.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        derive = make()
        kinds = [to_arrow_type(f.dataType) for f in fields]
        names = schema.fieldNames()
        for batch in batches:
            for part in slices(batch, at, limit):
                new = derive(part.column(at).to_pylist())
                arrays = [pa.array(values, kind) for values, kind in zip(new, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)
        pa.default_memory_pool().release_unused()  # the worker lives on for later tasks

    return kept.mapInArrow(run, schema)
