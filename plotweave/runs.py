"""Iterations that can be continued: a run folder with one committed manifest per turn.

A turn's tables are written under names of their own; then its manifest is written beside them
and renamed, which is the commit. What was not committed is never read. A run that is started
again on the same folder goes on after the last committed turn.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plotweave.session import file_system

_MANIFEST = re.compile(r"turn-(\d+)\.json")


class Run:
    """The folder ``path``; ``settings`` must be the same whenever it is continued.

    Without ``settings`` the run is only read.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict | None = None):
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings
        self.files, self.folder = file_system(spark, self.path)
        if settings is not None:
            self.files.mkdirs(self.folder)
        names = [x.getPath().getName() for x in self.files.listStatus(self.folder)]
        self.turns = [self._read(n) for n in sorted(n for n in names if _MANIFEST.fullmatch(n))]
        if [t["turn"] for t in self.turns] != list(range(1, len(self.turns) + 1)):
            raise ValueError(f"turns are missing in {self.path}")
        for turn in self.turns:
            if settings is not None and turn["settings"] != settings:
                raise ValueError(f"{self.path} holds another run: {turn['settings']}, not {settings}")

    def _read(self, name: str) -> dict:
        stream = self.files.open(self.spark._jvm.org.apache.hadoop.fs.Path(self.folder, name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, tables: dict[str, DataFrame], **facts) -> dict[str, DataFrame]:
        """Write the next turn's ``tables`` and commit them with ``facts``; returns them as stored."""
        turn = len(self.turns) + 1
        paths = {name: f"turn-{turn:06d}-{name}-{uuid.uuid4().hex}" for name in tables}
        for name, table in tables.items():
            table.write.parquet(f"{self.path}/{paths[name]}")
        manifest = {"turn": turn, "settings": self.settings, "tables": paths, **facts}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        draft = path(self.folder, f".turn-{turn:06d}-{uuid.uuid4().hex}")
        stream = self.files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        final = path(self.folder, f"turn-{turn:06d}.json")
        if self.files.exists(final) or not self.files.rename(draft, final):
            raise RuntimeError(f"turn {turn} in {self.path} was committed by another run")
        self.turns.append(manifest)
        return {name: self.table(turn, name) for name in tables}

    def table(self, turn: int, name: str, schema: StructType | str | None = None) -> DataFrame:
        """A committed table of a turn."""
        return self._stored([self.turns[turn - 1]], name, schema)

    def tables(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """A committed table of all turns together."""
        return self._stored(self.turns, name, schema)

    def _stored(self, turns: list[dict], name: str, schema: StructType | str | None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*[f"{self.path}/{t['tables'][name]}" for t in turns])


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """The history of a run's committed turns, ended or not: a row per turn and cluster."""
    run = Run(spark, path)
    if not run.turns:
        raise ValueError(f"no turn was committed in {path}")
    return run.tables("history")
