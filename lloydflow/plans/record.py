"""The record of a run beside its outputs: what a restarted driver may take over.

The folder ``prefix + "Run"`` holds small files that are only ever added: the
settings, and one entry per finished round.  A file is created exclusively (the file system
refuses a second creation), after the output it tells of, and ends with a mark, so a
file left unfinished by a lost driver counts as absent; the next try takes the
next version number.  Nothing is overwritten: a run that is refused changes nothing.
"""

from __future__ import annotations

import json
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..sources.sinks import iteration_path

_END = "\n"


class RunRecord:
    """Entries ``name.vN`` of the run under ``prefix``."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix = spark, prefix
        self.folder = iteration_path(prefix, "Run")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        p = self._path(path)
        return p.getFileSystem(self._conf).exists(p)

    def _versions(self) -> dict[str, list[int]]:
        """The versions of every entry in the folder, complete or not (a handful a round)."""
        folder = self._path(self.folder)
        fs = folder.getFileSystem(self._conf)
        found: dict[str, list[int]] = {}
        if fs.exists(folder):
            for status in fs.listStatus(folder):
                m = re.fullmatch(r"(\w+)\.v(\d+)", status.getPath().getName())
                if m:
                    found.setdefault(m[1], []).append(int(m[2]))
        return {name: sorted(v) for name, v in found.items()}

    def _read(self, name: str, version: int) -> dict | None:
        p = self._path(f"{self.folder}/{name}.v{version}")
        fs = p.getFileSystem(self._conf)
        stream = fs.open(p)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if not text.endswith(_END):
            return None
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    def entry(self, name: str) -> dict | None:
        """The latest complete version of an entry."""
        for version in reversed(self._versions().get(name, [])):
            found = self._read(name, version)
            if found is not None:
                return found
        return None

    def add(self, name: str, entry: dict) -> None:
        """Create the next version of an entry; fails if another driver creates it at the same time."""
        version = max(self._versions().get(name, [0])) + 1
        p = self._path(f"{self.folder}/{name}.v{version}")
        try:
            stream = p.getFileSystem(self._conf).create(p, False)
        except Py4JJavaError as e:
            raise FileExistsError(f"{self.folder} is written by another run") from e
        try:
            stream.write(bytearray((json.dumps(entry) + _END).encode()))
        finally:
            stream.close()

    def begin(self, settings: dict) -> None:
        """Claim an unused prefix for a new run; nothing changes if it is not unused."""
        if "settings" in self._versions() or self.exists(iteration_path(self.prefix, 1)):
            raise FileExistsError(f"{self.prefix} already holds a run: resume it or choose another prefix")
        self.add("settings", settings)

    def resume(self, settings: dict, most: int) -> list[dict]:
        """The entries of the rounds on record, in order and at most ``most``, after a check of the settings."""
        known = self.entry("settings")
        if known is None:
            if self.exists(iteration_path(self.prefix, 1)):
                raise ValueError(f"{self.prefix} holds rounds without a run record: they can't be resumed")
            self.add("settings", settings)
            return []
        if known != json.loads(json.dumps(settings)):
            raise ValueError(f"the run under {self.prefix} had other settings or centres")
        rounds: list[dict] = []
        while len(rounds) < most and (e := self.entry(f"round{len(rounds) + 1}")):
            rounds.append(e)
        return rounds
