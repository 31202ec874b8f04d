"""Per-key fetching inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Rows whose bodies a task holds at once.
FETCH_ROWS = 64


def fetch_map(
    df: DataFrame,
    key: str,
    fetch: Callable[..., str],
    chunks: int | None = None,
    inputs: tuple[str, ...] = (),
    threads: int = 10,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, body, error) for every row of `df`, and its columns `keep`.

    `fetch(key, *inputs)` runs on the executors. A failing item gets its message in `error` and does
    not stop the others. `chunks` spreads the rows evenly over that many tasks; without it the
    present partitions are kept. A lost task is run again, so `fetch` has to be repeatable. Rows come as
    Arrow batches, of which FETCH_ROWS rows at a time become Python objects.
    """
    rows = df.select(key, *inputs, *keep)
    arguments = 1 + len(inputs)
    if chunks is not None:
        rows = rows.repartition(chunks)
    schema = T.StructType(
        [rows.schema[key], T.StructField("body", T.StringType()), T.StructField("error", T.StringType())]
        + [rows.schema[name] for name in keep]
    )

    def attempt(values: tuple) -> tuple[str | None, str | None]:
        try:
            return fetch(*values), None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, FETCH_ROWS):
                    part = batch.slice(start, FETCH_ROWS)
                    values = [column.to_pylist() for column in part.columns[:arguments]]
                    bodies, errors = zip(*pool.map(attempt, zip(*values)))
                    texts = [pa.array(x, pa.string(), from_pandas=True) for x in (bodies, errors)]
                    yield pa.RecordBatch.from_arrays([part.column(0), *texts, *part.columns[arguments:]], schema.names)

    return rows.mapInArrow(run, schema)
