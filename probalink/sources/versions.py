"""Tables of several versions in a shared folder: a version is a list of Parquet files, and the newest one is the table.

Every change writes new files into a folder of their own, and then the list of the next version, which gets its name in one step that
fails where another writer was first. A reader takes the newest list and reads its files, which no change touches: it sees a whole
version, never a gap or a half. A run that dies before the list has its name has changed nothing, and tasks that are repeated write
what only the finished write's list names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probalink.sources.storage import CLEANUP, remove
from probalink.sources.tables import merged


class Conflict(RuntimeError):
    """Another writer has made the version that a change was about to make."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = hadoop.FileContext.getFileContext(self._files.getUri(), spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the versions that are there, in order; none for a table that was never written."""
        place = self._path(f"{self.path}/versions")
        if not self._files.exists(place):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def listed(self, version: int) -> dict:
        """What a version consists of: its files, below the table's folder, and its columns."""
        stream = self._files.open(self._path(f"{self.path}/versions/{version}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict]:
        """The newest version, 0 without files if there is none."""
        have = self.versions()
        return (have[-1], self.listed(have[-1])) if have else (0, {"files": [], "schema": None})

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is now, or as it was. The files are those of one version, whatever is written meanwhile."""
        listed = self.newest()[1] if version is None else self.listed(version)
        if listed["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self._frame(listed["files"], listed["schema"])

    def _frame(self, files: Sequence[str], schema: dict) -> DataFrame:
        kind = T.StructType.fromJson(schema)
        if not files:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/{f}" for f in files])

    def _written(self, df: DataFrame, required: Sequence[str]) -> list[str]:
        """df as new files, which no version lists yet. A null in a required column is an error, and its files go."""
        folder = f"data/{uuid.uuid4().hex}"
        nulls = Observation()
        counted = df.observe(nulls, F.count("*").alias("rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{n}") for n, c in enumerate(required)])
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            counted.write.parquet(f"{self.path}/{folder}")
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        missing = [c for n, c in enumerate(required) if nulls.get[f"null_{n}"]]
        if missing:
            remove(self.spark, f"{self.path}/{folder}")
            raise ValueError(f"{missing[0]} is null")
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.path}/{folder}"))]
        return [f"{folder}/{n}" for n in sorted(names) if n.endswith(".parquet")]

    def _publish(self, number: int, files: Sequence[str], schema: T.StructType) -> int:
        """Gives the list of version `number` its name, unless it has one."""
        text = json.dumps({"files": list(files), "schema": json.loads(schema.json())})
        aside, place = (self._path(f"{self.path}/versions/{n}") for n in (f".{uuid.uuid4().hex}", f"{number}.json"))
        stream = self._files.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._context.rename(aside, place, options)
        except Py4JJavaError as e:
            self._files.delete(aside, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise Conflict(f"version {number} of {self.path} is there already") from None
            raise
        return number

    def replace(self, df: DataFrame, required: Sequence[str] = ()) -> int:
        """A version of df's rows alone; df may read the table. required: columns that must have a value in every row."""
        number = self.newest()[0]
        return self._publish(number + 1, self._written(df, required), df.schema)

    def append(self, df: DataFrame, required: Sequence[str] = ()) -> int:
        """A version with df's rows added. Columns go by their names, and must be those of the table."""
        number, listed = self.newest()
        if listed["schema"] is None:
            return self.replace(df, required)
        kind = T.StructType.fromJson(listed["schema"])
        rows = self._frame([], listed["schema"]).unionByName(df).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in kind])
        return self._publish(number + 1, [*listed["files"], *self._written(rows, required)], kind)

    def merge(self, updates: DataFrame, key: str, columns: Sequence[str]) -> int:
        """A version in which the rows of updated keys have the updates' `columns`, nulls included. Only files that hold such a key are
        written anew: what comes to the driver are their names. Keys are unique in updates; those that the table lacks change nothing,
        nor do null keys."""
        number, listed = self.newest()
        table = self._frame(listed["files"], listed["schema"])
        keys = updates.select(key).where(F.col(key).isNotNull()).distinct()
        hit = table.select(key, F.col("_metadata.file_path").alias("__file")).join(keys, key, "left_semi").select("__file").distinct().collect() if listed["files"] else []
        touched = {"/".join(r["__file"].split("/")[-3:]) for r in hit}
        if not touched:
            return number
        stale = [f for f in listed["files"] if f in touched]
        rows = merged(self._frame(stale, listed["schema"]), updates, key, columns)
        kind = T.StructType.fromJson(listed["schema"])
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in kind])
        return self._publish(number + 1, [*[f for f in listed["files"] if f not in touched], *self._written(rows, ())], kind)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes versions before the newest `keep`, and files that none of these list: also those of a write that is not done yet, so
        it is for times when nobody writes."""
        have = self.versions()
        kept = {f for n in have[-keep:] for f in self.listed(n)["files"]}
        for n in have[:-keep]:
            remove(self.spark, f"{self.path}/versions/{n}.json")
        place = self._path(f"{self.path}/data")
        for folder in self._files.listStatus(place) if self._files.exists(place) else []:
            name = f"data/{folder.getPath().getName()}"
            for file in self._files.listStatus(folder.getPath()):
                if f"{name}/{file.getPath().getName()}" not in kept:
                    self._files.delete(file.getPath(), False)
            if not self._files.listStatus(folder.getPath()):
                self._files.delete(folder.getPath(), True)

    def drop(self) -> None:
        remove(self.spark, self.path)
