"""Tables of batches: what readers see is switched as a whole by one catalog operation.

A batch is written to files of its own and added to a base table as partitions that nobody reads yet. Readers go through
a view, the pointer, that names for each part of the table (a season) the one batch that holds it. Replacing the view
is a single operation of the catalog: before it all parts show the old rows, after it all show the new ones, however
many parts the batch has and wherever a job or the driver fails. The names are literals on partition columns, so
Spark prunes all other batches when it plans, as with any filter.

Rows of different kinds (records and rejects) are views on the pointer, so they switch together.

Batches that the pointer no longer names stay until the next replacement: a reader that was planned before finishes.
A table takes one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import remove_folder

BATCH, KIND = "_batch", "_kind"
VALID = "valid"


def text_literal(value: str) -> str:
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


@dataclass(frozen=True)
class BatchTable:
    """``name``: the qualified name that readers use; ``part``: the text column whose values are replaced."""

    spark: SparkSession
    name: str
    part: str

    @property
    def base(self) -> str:
        return f"{self.name}__batches"

    @property
    def pointer(self) -> str:
        return f"{self.name}__live"

    def create(self, columns: T.StructType, views: Mapping[str, tuple[str, list[str]]], location: str | None = None) -> None:
        """Create what is missing. ``columns``: of all kinds, without ``part``; ``views``: name and columns by kind."""
        spark = self.spark
        if spark.catalog.tableExists(self.pointer):
            return
        database, _, _ = self.name.rpartition(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database or 'default'}")
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        place = f" LOCATION {text_literal(location)}" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.base} ({listed}, {BATCH} string, {KIND} string, {self.part} string) "
                  f"USING parquet PARTITIONED BY ({BATCH}, {KIND}, {self.part}){place}")
        self._point({}, [])
        for kind, (view, shown) in views.items():
            names = ", ".join(f"`{c}`" for c in shown)
            spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {names} FROM {self.pointer} WHERE {KIND} = {text_literal(kind)}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.pointer)

    def live(self) -> dict[str, str]:
        """The batch that holds each part."""
        return self._property("live") or {}

    def _property(self, key: str):
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.pointer}").filter(F.col("key") == f"batches.{key}").collect()
        return json.loads(rows[0]["value"]) if rows else None

    def _point(self, live: Mapping[str, str], retired: list[list[str]]) -> None:
        """The switch."""
        held = ", ".join(text_literal(f"{part}/{batch}") for part, batch in sorted(live.items()))
        condition = f"concat({self.part}, '/', {BATCH}) IN ({held})" if held else "false"
        properties = {"live": json.dumps(dict(live)), "retired": json.dumps(retired)}
        told = ", ".join(f"'batches.{k}' = {text_literal(v)}" for k, v in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.pointer} TBLPROPERTIES ({told}) AS SELECT * FROM {self.base} WHERE {condition}")

    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.base}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"].rstrip("/")

    def replace(self, rows: DataFrame, clear: Iterable[str] = ()) -> int:
        """Replace the parts that ``rows`` hold and those of ``clear``; returns the valid rows written.

        ``rows`` has the columns of the base table but for the batch. A part of ``clear`` without rows is empty
        afterwards. If a step before the switch fails, nothing changes and what the batch left is removed.
        """
        batch = uuid.uuid4().hex
        root = self.location()
        folder, seen = f"{root}/{BATCH}={batch}", Observation()
        counts = (F.count_if(F.col(KIND) == VALID).alias("rows"), F.collect_set(F.struct(KIND, self.part)).alias("parts"))
        try:
            rows.observe(seen, *counts).write.partitionBy(KIND, self.part).parquet(folder)
            found = [(row[0], row[1]) for row in seen.get["parts"]]
            if any(part is None for _, part in found):
                raise ValueError(f"rows without a value of {self.part}")
            self._add(batch, found)
            old = self.live()
            live = {p: b for p, b in old.items() if p not in set(clear)} | {part: batch for _, part in found}
            gone = self._property("retired") or []
            self._point(live, [[p, b] for p, b in old.items() if live.get(p) != b])
        except BaseException:
            if batch not in self.live().values():
                self._drop([batch])
                remove_folder(self.spark, folder)
            raise
        self.spark.catalog.refreshTable(self.base)
        self._drop([], gone)
        return seen.get["rows"]

    def _add(self, batch: str, found: list[tuple[str, str]]) -> None:
        if found:
            parts = " ".join(f"PARTITION {self._spec(batch, kind, part)}" for kind, part in sorted(found))
            self.spark.sql(f"ALTER TABLE {self.base} ADD IF NOT EXISTS {parts}")

    def _spec(self, batch: str, kind: str, part: str) -> str:
        return f"({BATCH} = {text_literal(batch)}, {KIND} = {text_literal(kind)}, {self.part} = {text_literal(part)})"

    def _drop(self, batches: Iterable[str], retired: Iterable[list[str]] = ()) -> None:
        """Remove the partitions of whole batches and of single (part, batch) pairs, with their files."""
        batches, pairs = set(batches), {(p, b) for p, b in retired}
        if not batches and not pairs:
            return
        dropped, folders, used, root = [], [], set(), self.location()
        for row in self.spark.sql(f"SHOW PARTITIONS {self.base}").collect():
            batch, kind, part = (unquote(x.partition("=")[2]) for x in row["partition"].split("/"))
            if batch in batches or (part, batch) in pairs:
                dropped.append(f"PARTITION {self._spec(batch, kind, part)}")
                folders.append((batch, f"{root}/{row['partition']}"))
            else:
                used.add(batch)
        if dropped:
            self.spark.sql(f"ALTER TABLE {self.base} DROP IF EXISTS {', '.join(dropped)}")
        # Of a batch that holds nothing any more the whole folder goes.
        whole = {f"{root}/{BATCH}={batch}" for batch, _ in folders if batch not in used}
        for folder in whole.union(folder for batch, folder in folders if batch in used):
            remove_folder(self.spark, folder)

    def drop(self, views: Iterable[str]) -> None:
        """Remove the table. Files stay where a location was given."""
        for view in (*views, self.pointer):
            self.spark.sql(f"DROP VIEW IF EXISTS {view}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.base}")
