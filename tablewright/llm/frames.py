"""What the operators share around Spark: Arrow stages, hashes of rows, unused column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TEACHING = "pmod(crc32(cast({id} as string)), 3) != 1"  # rows from which labels may be learned


def arrow_stage(
    df: DataFrame, schema: StructType | str, fn: Callable[..., Iterator[dict]], whole: bool = False
) -> DataFrame:
    """Run `fn` on every Arrow batch, or once on the batches of a partition if `whole`.

    It yields dicts of columns in the shape of `schema`.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # like Spark's own batches: no field is called non-null
    fields = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches) if whole else (c for batch in batches for c in fn(batch)):
            arrays = [
                v if isinstance(v, pa.Array) else pa.array(v, f.type)
                for v, f in ((columns[f.name], f) for f in fields)
            ]
            arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)
        pa.default_memory_pool().release_unused()  # workers live on for other stages

    return df.mapInArrow(run, kind)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
