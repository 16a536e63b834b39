"""A folder of immutable table versions and a small commit log that says which one is current.

A version is a list of parts: cells (hive partitions) of the folders that loads have written. A load that
replaces some cells leaves the files of all others where they are. It becomes visible with one more commit
line, which is written aside and renamed, so a crash at any point leaves the last good version current and
the next publish free to go on. It is a pointer for one writer at a time, not a transaction log: of two
writers that saw the same version the second is refused, and nothing is merged.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import listed, read_text, remove, write_new
from ..sinks.parquet import write_partitioned
from .tables import ROW_ID, row_id_columns

_LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("token", T.StringType()),
        T.StructField("parts", T.ArrayType(T.StructType([T.StructField("folder", T.StringType())]))),
    ]
)
# Files of loads that never became a version may belong to one that is still being written.
ORPHAN_AFTER_HOURS = 24.0


class Part(NamedTuple):
    """Files of one load in one cell. ``cell`` is a hive path such as ``usage_date=2025-07-01/service=compute``,
    or empty where a load was not taken apart; files and bytes are -1 then."""

    folder: str
    cell: str
    rows: int
    files: int = -1
    bytes: int = -1


@dataclass(frozen=True)
class Version:
    version: int
    root: str
    parts: list[Part]
    token: str | None
    schema: str
    note: dict = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        """The schema it was written with, partition columns included: their types are not in the files."""
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts)

    @property
    def folders(self) -> list[str]:
        return [f"{self.root}/data/{folder}" for folder in dict.fromkeys(part.folder for part in self.parts)]

    @property
    def metrics(self) -> dict:
        """What was observed while the version was written; nothing of rows that it has kept."""
        return self.note.get("metrics", {})

    @property
    def in_cells(self) -> bool:
        """Whether every part is one cell, so that some can be replaced."""
        return all(part.cell for part in self.parts)


def within(cell: str, groups: Collection[str]) -> bool:
    """Whether a cell is one of those given, or inside one: ``a=1/b=2`` is inside ``a=1``."""
    steps = cell.split("/")
    return any("/".join(steps[: i + 1]) in groups for i in range(len(steps)))


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    @property
    def _path(self) -> str:
        return f"{self.root}/commits"

    def _lines(self) -> list[str]:
        """Names of the commit lines, oldest first. Lines that are still being written are hidden."""
        return [f.name for f in listed(self.spark, self._path) if f.name.endswith(".json") and f.name[0] not in "._"]

    def _log(self) -> DataFrame:
        """One line per publish."""
        return self.spark.read.schema(_LOG).json(self._path)

    def current(self) -> Version | None:
        """The last committed version, if any."""
        lines = self._lines()
        if not lines:
            return None
        line = json.loads(read_text(self.spark, f"{self._path}/{lines[-1]}"))
        parts = [Part(**part) for part in line["parts"]]
        return Version(line["version"], self.root, parts, line["token"], line["schema"], line["note"])

    def committed(self, token: str) -> bool:
        """Whether a version with this token was published: makes a replayed batch a no-op."""
        lines = self._lines()
        if not lines:
            return False
        last = self.current()
        return last.token == token or not self._log().where(F.col("token") == token).isEmpty()

    def _paths(self, version: Version, parts: Iterable[Part]) -> list[str]:
        """Where parts lie: whole folders of which all cells are read, single cells of others."""
        parts = list(parts)
        wanted, live = Counter(p.folder for p in parts), version.note.get("cells", {})
        out = []
        for part in parts:
            folder = f"{self.root}/data/{part.folder}"
            whole = not part.cell or wanted[part.folder] == live.get(part.folder)
            out.append(folder if whole else f"{folder}/{part.cell}")
        return list(dict.fromkeys(out))

    def read(self, row_id: bool = False, only: Callable[[Part], bool] | None = None) -> DataFrame:
        """The current version, or only some of its parts. One scan, whatever the number of loads."""
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"{self.root} has no published version")
        schema = self.schema or version.struct
        parts = [p for p in version.parts if only is None or only(p)]
        names = [F.col(f"`{name}`") for name in schema.names] + (row_id_columns() if row_id else [])
        if not parts:
            return self._empty(schema, row_id)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*self._paths(version, parts)).select(*names)

    def _empty(self, schema: T.StructType, row_id: bool = False) -> DataFrame:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        identity = [F.lit(None).cast("bigint").alias(c) for c in ROW_ID] if row_id else []
        return self.spark.range(0).select(*nothing, *identity)

    def read_or_empty(self) -> DataFrame:
        return self._empty(self.schema) if self.current() is None else self.read()

    def _inventory(self, folder: str, partition_by: Sequence[str]) -> list[Part]:
        """Rows, files and bytes of each cell of a folder, from the files themselves: rows come from their
        footers. One line per cell comes to the driver."""
        path = f"{self.root}/data/{folder}"
        if not any(f.name[0] not in "._" for f in listed(self.spark, path)):
            return []  # no rows, no cells
        steps = len(partition_by) + 1
        files = (
            self.spark.read.parquet(path)
            .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        cell = F.array_join(F.slice(F.split("file", "/"), -steps, len(partition_by)), "/")
        counted = files.groupBy(cell.alias("cell")).agg(
            F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("size").alias("bytes")
        )
        # The paths are those of URIs, the cells those of the file system.
        return sorted(Part(folder, unquote(r["cell"]), r["rows"], r["files"], r["bytes"]) for r in counted.collect())

    def publish(
        self,
        df: DataFrame,
        *,
        partition_by: Sequence[str] = (),
        arranged: bool = False,
        append: bool = False,
        in_cells: bool = False,
        keep: Callable[[Part], bool] | None = None,
        expect_rows: int | None = None,
        token: str | None = None,
        note: dict | None = None,
        metrics: Mapping[str, Column] | None = None,
    ) -> Version:
        """Write a new version and commit it. ``append`` keeps all parts of the last one and adds to them;
        ``keep`` keeps those it says, whose files stay as they are. ``in_cells`` takes an inventory of the
        partitions written, so that later loads can keep some. ``arranged`` keeps the frame's own partitions
        and order; a row count other than ``expect_rows`` leaves the old version current. ``note`` is kept
        with the version, and so are the values of ``metrics``, aggregates of the rows it writes."""
        folder = f"load={uuid.uuid4().hex}"
        seen = write_partitioned(
            df, f"{self.root}/data/{folder}", partition_by, arranged=arranged, metrics=metrics
        )
        written = seen.pop("rows")
        if expect_rows is not None and written != expect_rows:
            raise ValueError(f"{self.root}: {written} rows written, {expect_rows} expected; not published")
        parts = self._inventory(folder, partition_by) if in_cells else [Part(folder, "", written)]
        last = self.current()
        keep = (lambda part: True) if append else keep
        kept = [p for p in last.parts if keep(p)] if last and keep else []
        cells = {folder: len(parts)} if in_cells else {}
        older = last.note.get("cells", {}) if kept else {}
        still = {p.folder for p in kept}
        cells |= {f: n for f, n in older.items() if f in still}
        version = Version(
            (last.version if last else 0) + 1,
            self.root,
            [*kept, *parts],
            token,
            df.schema.json(),
            {**(note or {}), "cells": cells, **({"metrics": seen} if seen else {})},
        )
        line = {
            "version": version.version,
            "token": token,
            "schema": version.schema,
            "note": version.note,
            "parts": [part._asdict() for part in version.parts],
        }
        if not write_new(self.spark, f"{self._path}/{version.version:012d}.json", json.dumps(line)):
            raise RuntimeError(f"{self.root}: version {version.version} already exists, by another writer")
        return version

    def expire(self, keep: int = 2, orphans_after_hours: float = ORPHAN_AFTER_HOURS) -> int:
        """Delete the folders that only versions before the last ``keep`` use, and those of loads that ended
        without a version and are older than ``orphans_after_hours``; give their number. Keep as many
        versions as readers may still hold."""
        named: set[str] = set()
        used: set[str] = set()
        if self._lines():
            log = self._log().select("version", F.array_distinct("parts.folder").alias("folders"))
            for nth, line in enumerate(log.orderBy(F.desc("version")).collect()):
                named.update(line["folders"])
                used.update(line["folders"] if nth < keep else ())
        before = time.time() - 3600 * orphans_after_hours
        gone = [
            f.name
            for f in listed(self.spark, f"{self.root}/data")
            if f.name not in used and (f.name in named or f.modified < before)
        ]
        for folder in gone:
            remove(self.spark, f"{self.root}/data/{folder}")
        for file in listed(self.spark, self._path):
            if file.name.startswith("_") and file.modified < before:
                remove(self.spark, f"{self._path}/{file.name}")
        return len(gone)

