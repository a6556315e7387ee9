"""Adding columns to whole rows from numpy results, without touching the other columns."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folioworks.llm.words import row_batches


def keep_rows(docs: DataFrame, decide: Callable[[], Callable[[pa.Array], "np.ndarray"]], column: str = "text") -> DataFrame:  # noqa: F821
    """Rows of ``docs`` for which the decision on ``column`` is true; all columns stay as they are.

    ``decide()`` is called once per task and returns the function from a batch of texts to booleans.
    """
    place = docs.columns.index(column)

    def run(batches):
        test = decide()
        for batch in row_batches(batches):
            yield batch.filter(pa.array(test(batch.column(place))))

    return docs.mapInArrow(run, docs.schema)


def with_results(docs: DataFrame, keys: list[str], results: T.StructType, compute: Callable[[], Callable[[pa.Array], list]], column: str = "text") -> DataFrame:
    """Columns ``keys`` of ``docs`` and the computed ones, one output row per row.

    ``compute()`` is called once per task and returns the function from a batch of texts to arrays.
    """
    fields = [docs.schema[k] for k in keys]
    schema = T.StructType([*fields, *results.fields])
    source = docs.select(*keys, docs[column].alias("_text_"))
    n = len(keys)

    def run(batches):
        work = compute()
        for batch in row_batches(batches):
            made = work(batch.column(n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=schema.names)

    return source.mapInArrow(run, schema)
