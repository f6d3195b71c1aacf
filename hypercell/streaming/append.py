"""A stream's micro-batches appended to a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from hypercell.operators.table import Table
from hypercell.sources.storage import Store

_KEY = "_last_batch_"


def append_to(stream: DataFrame, path: str, order: Sequence[str]) -> DataStreamWriter:
    """Rows of each batch in the given total order behind the rows before; a batch that is repeated after a failure is
    recognised by its number, which the manifest keeps beside the rows, so it is appended once wherever the failure was. Start the writer with a checkpoint location."""

    def add(batch: DataFrame, number: int) -> None:
        t = Table.from_filename(path, spark=batch.sparkSession)
        if t._desc.get("_private_keywords_", {}).get(_KEY, -1) >= number:
            return
        t._desc.setdefault("_private_keywords_", {})[_KEY] = number
        if batch.isEmpty():
            Store(batch.sparkSession, path).set_descriptor(t._desc)
        else:
            t.add_dataframe(batch, order)

    return stream.writeStream.foreachBatch(add)
