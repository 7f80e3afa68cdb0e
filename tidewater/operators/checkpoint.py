"""How far a consumer has read each table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater import paths
from tidewater.operators.keyed_table import KeyedTable


class Checkpoint:
    """One JSON object per table below ``path``; each consumer has its own path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, table_name: str) -> str:
        return f"{self.path}/{table_name}.json"

    def get(self, table_name: str) -> dict | None:
        return paths.read_json(self.spark, self._file(table_name))

    def last_commit(self, table_name: str) -> int | None:
        state = self.get(table_name)
        return None if state is None else int(state["last_processed_commit"])

    def put(self, table_name: str, commit: int, table_path: str) -> None:
        state = {
            "last_processed_commit": commit,
            "table_name": table_name,
            "path": table_path,
            "inserted_time": str(dt.datetime.now(dt.timezone.utc)),
        }
        paths.write_json(self.spark, self._file(table_name), state)

    def clear(self, table_name: str) -> None:
        paths.delete(self.spark, self._file(table_name))


@dataclass
class Increment:
    """What came after ``begin`` (None: first run) up to ``end``."""

    table: KeyedTable
    name: str
    begin: int | None
    end: int | None

    @property
    def is_empty(self) -> bool:
        """Decided from commit numbers, without a Spark job."""
        return self.end is None or self.begin == self.end

    def rows(self, deletes: bool = False) -> DataFrame:
        if self.is_empty and self.begin is None:
            return self.table.incremental(0, 0, deletes)
        return self.table.incremental(self.begin, self.end, deletes)

    def done(self, checkpoint: Checkpoint) -> None:
        """Move the checkpoint; call it after the results are written."""
        if not self.is_empty:
            checkpoint.put(self.name, self.end, self.table.path)


def next_increment(table: KeyedTable, name: str, checkpoint: Checkpoint) -> Increment:
    return Increment(table, name, checkpoint.last_commit(name), table.last_commit())
