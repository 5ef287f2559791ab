"""Run a Python function over blocks of rows next to the rows themselves.

The input columns travel inside one struct, so result columns cannot clash with them, whatever they
are called, and no join is needed to bring results back to their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

BLOCK_BYTES = 8 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns as one struct ``row``, with computed columns beside it."""
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]) if df.columns else F.struct(F.lit(None).alias("none"))
    return df.select(row.alias("row"), *[c.alias(k) for k, c in extra.items()])


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.Table]:
    """Arrow batches joined to blocks of about ``block_bytes``; a larger row is a block of its own."""
    held, size = [], 0
    for batch in batches:
        step = max(1, int(batch.num_rows * block_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= block_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    held = []
    # Workers live on between tasks; what this one has freed must not add up with the next one's.
    pa.default_memory_pool().release_unused()


def map_rows(
    df: DataFrame,
    inputs: dict[str, Column],
    result: str,
    fn: Callable[[dict[str, list]], dict[str, list]],
    out: str = "result",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows of ``df`` as struct ``row`` and what ``fn`` makes of them as struct ``out``.

    ``fn`` gets the ``inputs`` of a block as Python lists and returns one list for each field of the
    DDL text ``result``, a value per row.
    """
    source = packed(df, **inputs)
    result_type = _parse_datatype_string(result)
    schema = StructType([source.schema["row"], StructField(out, result_type)])
    arrow = to_arrow_schema(result_type)
    names = list(inputs)

    def run(batches):
        for block in blocks(batches, block_bytes):
            got = fn({k: block.column(k).to_pylist() for k in names})
            value = pa.StructArray.from_arrays(
                [pa.array(got[f.name], type=f.type) for f in arrow], fields=list(arrow)
            )
            row = block.column("row").combine_chunks()
            rows = row if isinstance(row, pa.Array) else pa.concat_arrays(row.chunks)
            yield pa.RecordBatch.from_arrays([rows, value], names=["row", out])

    return source.mapInArrow(run, schema)


def task_rows(
    df: DataFrame,
    schema: str,
    fn: Callable[[Iterator[pa.Table]], Iterator[dict[str, list]]],
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows that ``fn`` makes from all blocks of a partition, given and returned as columns."""
    spark_schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        for got in fn(blocks(batches, block_bytes)):
            arrays = [v if isinstance(v := got[f.name], pa.Array) else pa.array(v, type=f.type) for f in arrow]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, spark_schema)
