"""Models made of lookup tables and numbers, with saving and loading.

A fitted encoder is a few key tables (one row per category) plus some scalars. Such a
model can sit in a ``PipelineModel`` and be saved with it: tables go to Parquet, the rest
to the usual metadata file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.operators.aggregates import _SET_ID, KeyedTables
from latemark.operators.lookup import BROADCAST_ROWS, fits_broadcast, key_counts, lookup_join, row_bytes
from latemark.session import checkpointed

ROWS = "rows"


@dataclass
class LookupTable:
    """One row per key: the key, ``rows`` behind it, and the values to look up."""

    frame: DataFrame
    key: str
    values: list[str]
    table_rows: int
    total_rows: int
    table_bytes: int | None = None

    def fits(self, broadcast_rows: int) -> bool:
        return fits_broadcast(self.frame, self.table_rows, self.table_bytes, broadcast_rows)

    def join_to(
        self, df: DataFrame, broadcast_rows: int = BROADCAST_ROWS, counted: DataFrame | None = None
    ) -> DataFrame:
        return lookup_join(
            df, self.frame, self.key, self.values, self.table_rows, self.total_rows,
            ROWS, broadcast_rows, counted, self.table_bytes,
        )


def materialise(tables: KeyedTables, names: dict[str, dict[str, str]]) -> dict[str, LookupTable]:
    """Compute the tables once, measure them, and give their value columns final names.

    The aggregate is checkpointed: it is small beside the rows it came from, every later
    join reads it without going back to them, and plans stay short. Measuring returns one
    row per key column.
    """
    tables.combined = checkpointed(tables.combined)
    sizes = {
        row[_SET_ID]: row
        for row in tables.combined.groupBy(_SET_ID).agg(
            F.count(F.lit(1)).alias("table_rows"), F.sum(ROWS).alias("total_rows"),
            # the other keys of a row are null and take little
            F.sum(row_bytes(tables.combined, [*tables.keys, *tables.values])).alias("table_bytes"),
        ).collect()
    }
    lookups = {}
    for key in tables.keys:
        size = sizes.get(tables._set_id(key))
        renamed = names[key]
        frame = tables.table(key).filter(F.col(key).isNotNull()).select(
            key, ROWS, *[F.col(old).alias(new) for old, new in renamed.items()]
        )
        lookups[key] = LookupTable(
            frame, key, list(renamed.values()),
            *((size["table_rows"], size["total_rows"], size["table_bytes"]) if size else (0, 0, 0)),
        )
    return lookups


class _TableModelWriter(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model = self.instance
        described = [
            {"key": t.key, "values": t.values, "table_rows": t.table_rows, "total_rows": t.total_rows,
             "table_bytes": t.table_bytes}
            for t in model.lookups.values()
        ]
        DefaultParamsWriter.saveMetadata(
            model, path, self.sparkSession,
            extraMetadata={"lookups": described, "scalars": model.scalars},
        )
        for index, table in enumerate(model.lookups.values()):
            table.frame.write.parquet(f"{path}/tables/{index}")


class _TableModelReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        for index, told in enumerate(metadata["lookups"]):
            frame = self.sparkSession.read.parquet(f"{path}/tables/{index}")
            model.lookups[told["key"]] = LookupTable(frame, **told)
        model.scalars = metadata["scalars"]
        return model


class TableModel(Model, MLReadable, MLWritable):
    """Base of fitted models: ``lookups`` by key column, ``scalars`` by name."""

    broadcastRows = Param(
        Params._dummy(), "broadcastRows", "lookup tables up to this many rows are broadcast, if small in bytes too", TypeConverters.toInt
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(broadcastRows=BROADCAST_ROWS)
        self.lookups: dict[str, LookupTable] = {}
        self.scalars: dict = {}

    def _fitted(self, lookups: dict[str, LookupTable], scalars: dict):
        self.lookups, self.scalars = lookups, scalars
        return self

    @property
    def broadcast_rows(self) -> int:
        return self.getOrDefault(self.broadcastRows)

    @broadcast_rows.setter
    def broadcast_rows(self, rows: int) -> None:
        self._set(broadcastRows=rows)

    def _joined(self, df: DataFrame) -> DataFrame:
        large = [k for k, t in self.lookups.items() if not t.fits(self.broadcast_rows)]
        counts = key_counts(df, large) if large else {}
        columns = df.columns
        for key, table in self.lookups.items():
            columns = [key, *(c for c in columns if c != key), *table.values]
        # rows are shuffled before broadcast tables widen them
        for key, table in sorted(self.lookups.items(), key=lambda t: t[0] not in large):
            df = table.join_to(df, self.broadcast_rows, counts.get(key))
        return df.select(*columns)

    def write(self) -> MLWriter:
        return _TableModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableModelReader(cls)
