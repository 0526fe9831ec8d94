"""Overlapping chunks as a table function, for use in SQL.

    SELECT * FROM overlapping_chunks(1000, 100, TABLE(docs))

The numbers are the chunk's size and what it shares with the one before; the
table has the columns ``id`` and ``content``. Texts come in Arrow batches. A
text is cut by itself, so the table needs no ``PARTITION BY``, which would send
all texts of a value to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

SCHEMA = "id string, chunk_index int, total_chunks int, chunk_id string, chunk_content string"


class OverlappingChunks:
    def eval(self, size: pa.Array, overlap: pa.Array, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        length, shared = size[0].as_py(), overlap[0].as_py()
        if length < 1 or not 0 <= shared < length:
            raise ValueError("a chunk is longer than its overlap")
        step = length - shared
        out = {"id": [], "chunk_index": [], "total_chunks": [], "chunk_id": [], "chunk_content": []}
        for key, text in zip(rows.column("id").to_pylist(), rows.column("content").to_pylist()):
            if text is None:
                continue
            total = max(1, -(-(len(text) - shared) // step))
            for i in range(total):
                out["id"].append(key)
                out["chunk_index"].append(i + 1)
                out["total_chunks"].append(total)
                out["chunk_id"].append(f"{key}-{i + 1}")
                out["chunk_content"].append(text if total == 1 else text[i * step : i * step + length])
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
        yield pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def register_table_functions(spark: SparkSession) -> None:
    spark.udtf.register("overlapping_chunks", arrow_udtf(OverlappingChunks, returnType=SCHEMA))
