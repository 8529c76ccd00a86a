"""Row-for-row columns computed from a text column in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.words import texts


def with_text_columns(
    frame: DataFrame,
    text: str,
    columns: Sequence[tuple[str, T.DataType]],
    work: Callable[[list[str | None]], Sequence[list]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """The rows with new columns, of which ``work`` gives the values for a list of texts.

    Columns of the new names are replaced, those in ``drop`` are left out. Names
    of any kind are allowed, as columns go by number on the way. A call gets a
    few megabytes of text, or one longer row.
    """
    fields = frame.schema.fields
    gone = {n for n, _ in columns} | set(drop)
    kept = [i for i, f in enumerate(fields) if f.name not in gone]
    at = [f.name for f in fields].index(text)
    names = [f"c{i}" for i in kept] + [f"n{k}" for k in range(len(columns))]
    types = [fields[i].dataType for i in kept] + [t for _, t in columns]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    made_types = [to_arrow_type(t) for _, t in columns]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in texts(batch, f"c{at}"):
                made = work(part.column(f"c{at}").to_pylist())
                own = [part.column(f"c{i}") for i in kept]
                new = [pa.array(v, t) for v, t in zip(made, made_types)]
                yield pa.RecordBatch.from_arrays([*own, *new], names=names)

    numbered = frame.toDF(*[f"c{i}" for i in range(len(fields))])
    return numbered.mapInArrow(batches, schema).toDF(*[fields[i].name for i in kept], *[n for n, _ in columns])
