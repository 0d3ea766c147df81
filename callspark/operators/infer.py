"""Batch inference: any Python predictor over a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


#: Rows that are sent on together, unless a batch of the model has more.
ROWS_OUT = 500


class Predictor(Protocol):
    """A model. ``setup`` runs once per task, ``predict`` once per batch of rows."""

    def setup(self) -> None: ...

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame: ...


def map_predict(
    df: DataFrame,
    predictor: Callable[[], Predictor],
    schema: str,
    batch_size: int = 10,
    fallback: Mapping[str, object] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds the predictor's columns, ``error`` and ``processing_time`` (seconds) to every row.

    The predictor is made in the task, so that a model is loaded there and not shipped. If a batch
    fails its rows are tried one by one; those that fail alone get ``fallback`` and the message.
    ``partitions`` spreads a table that sits in few partitions before the model sees it.
    """
    added = T.StructType.fromDDL(schema)
    names = [f.name for f in added.fields]
    taken = [n for n in [*names, "error", "processing_time"] if n in df.columns]
    if taken:
        raise ValueError(f"columns already present: {taken}")
    default = {n: (fallback or {}).get(n) for n in names}
    out = T.StructType([
        *df.schema.fields, *added.fields, T.StructField("error", T.StringType()),
        T.StructField("processing_time", T.DoubleType()),
    ])

    def predict(model: Predictor, rows: pd.DataFrame) -> pd.DataFrame:
        result = model.predict(rows)
        if len(result) != len(rows):
            raise ValueError(f"{len(rows)} rows in, {len(result)} out")
        return result[names].set_axis(rows.index)

    def one_by_one(model: Predictor, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for i in range(len(rows)):
            row = rows.iloc[i:i + 1]
            begin = time.perf_counter()
            try:
                part = predict(model, row).assign(error=None)
            except Exception as failure:
                part = pd.DataFrame([{**default, "error": f"{type(failure).__name__}: {failure}"}], index=row.index)
            parts.append(part.assign(processing_time=time.perf_counter() - begin))
        return pd.concat(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = predictor()
        model.setup()
        for pdf in batches:
            done = []
            for at in range(0, len(pdf), batch_size):
                rows = pdf.iloc[at:at + batch_size]
                begin = time.perf_counter()
                try:
                    result = predict(model, rows).assign(error=None)
                    result["processing_time"] = (time.perf_counter() - begin) / len(rows)
                except Exception:
                    result = one_by_one(model, rows)
                done.append(result)
                if sum(map(len, done)) >= ROWS_OUT or at + batch_size >= len(pdf):  # texts leave before the batch ends
                    done = pd.concat(done)
                    yield pd.concat([pdf.loc[done.index], done], axis=1)[out.names]
                    done = []

    source = df.repartition(partitions) if partitions else df
    return source.mapInPandas(run, out)
