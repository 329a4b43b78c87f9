"""The current state as Parquet snapshots behind one pointer.

A commit writes new directories and then one small record that names, for every
table and bucket, the directories to read. Readers follow the newest complete
record, so a job that dies half way changes nothing and a table is never
overwritten while it is read. Every attempt to commit writes folders of its own, and
a version is published by renaming its record to a name that must be free.

A pass works in a unit: it reads the version it began with, sees what it has written
itself, and publishes all of it as one record under the next version's name. If another
writer has published in between, that name is taken, the unit is refused and nothing of
it is ever read; so no update can be lost to one that did not see it.
"""

import copy
import json
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from reelmill import schemas

BUCKET = StructField("bucket", IntegerType(), True)
#: Ends the name of a folder that replaced all rows of its buckets.
REWRITTEN = "-all"


def _version(folder: str) -> int:
    return int(folder.split("-")[0].removeprefix("v="))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: the configured one, else (tests) a local one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
    return tempfile.mkdtemp(prefix="reelmill-")


def work_dir(spark: SparkSession) -> str:
    """A new directory below the shared folder."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex[:12]}"


@dataclass
class Write:
    """Rows for one table: added, or replacing everything in ``buckets``."""

    rows: DataFrame
    buckets: list[int] | None = None


class StateStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._writer = uuid.uuid4().hex[:8]
        self._record: tuple[str, dict] = ("", {"version": 0, "tables": {}, "applied": {}})

    # -- pointer ------------------------------------------------------------

    def _names(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [entry.getPath().toString() for entry in fs.globStatus(path) or []]

    def pointer(self) -> dict:
        """The newest complete commit record."""
        done = self._names("commits/c=*/_SUCCESS")
        newest = max(done, default="").rsplit("/", 1)[0]
        if newest != self._record[0]:
            self._record = (newest, json.loads(self.spark.read.text(newest).first()["value"]))
        return self._record[1]

    def applied(self, stream: str) -> int:
        """Last batch id of ``stream`` that is part of the state (-1: none)."""
        return self.pointer()["applied"].get(stream, -1)

    def last_id(self, table: str) -> int:
        """The highest id that a commit has noted, also of rows deleted since (0: none)."""
        return self.pointer().get("ids", {}).get(table, 0)

    @contextmanager
    def unit(self) -> Iterator["Unit"]:
        """Everything committed inside is published together at the end, or not at all."""
        work = Unit(self)
        yield work
        work.publish()

    # -- read ---------------------------------------------------------------

    def bucket_of(self, video_id: Column) -> Column:
        return F.pmod(F.xxhash64(video_id), F.lit(self.buckets)).cast("int")

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """Current rows of a table plus their ``bucket``; only some buckets if given."""
        dirs = self.pointer()["tables"].get(table, {})
        wanted = dirs if buckets is None else {str(b): dirs.get(str(b), []) for b in buckets}
        rows = self._folders(table, [(b, v) for b, vs in wanted.items() for v in vs])
        return self._shown(table, rows, buckets)

    def _shown(self, table: str, rows: DataFrame, buckets: list[int] | None) -> DataFrame:
        """``rows`` without those that another table hides (see schemas.HIDDEN_BY)."""
        marks, keys = schemas.HIDDEN_BY.get(table, ("", {}))
        marked = self.pointer()["tables"].get(marks, {})
        here = sorted(int(b) for b in marked if buckets is None or int(b) in buckets)
        if not here:
            return rows
        gone = self.read(marks, here).select(*[F.col(mark).alias(c) for c, mark in keys.items()])
        return rows.join(gone, list(keys), "left_anti").select(*rows.columns)

    def read_versions(self, table: str, wanted: set[tuple[int, int]]) -> DataFrame:
        """The rows that the commits of ``wanted`` (bucket, version) pairs added to a table.

        Folders of other commits are not read. A folder that a rewrite made holds rows of
        all versions before it.
        """
        dirs = self.pointer()["tables"].get(table, {})
        versions = {}
        for bucket, version in wanted:
            versions.setdefault(str(bucket), set()).add(version)
        chosen = []
        for bucket, folders in dirs.items():
            asked = versions.get(bucket, set())
            chosen += [(bucket, f) for f in folders if f.endswith(REWRITTEN) or _version(f) in asked]
        return self._folders(table, chosen)

    def _folders(self, table: str, folders: list[tuple[str, str]]) -> DataFrame:
        schema = StructType([*schemas.TABLES[table].fields, BUCKET])
        paths = [f"{self.root}/{table}/{folder}/bucket={bucket}" for bucket, folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*paths).select(*schema.names)

    def requests(self, after: int = 0) -> list[str]:
        """Folders of request documents that published versions above ``after`` sent."""
        found = []
        for name in self._names("commits/c=*/_SUCCESS"):
            record = name.rsplit("/", 1)[0]
            if int(record.rsplit("=", 1)[1]) > after:
                found.append(record)
        if not found:
            return []
        sent = self.spark.read.schema("requests array<string>").json(found)
        return sorted(r.folder for r in sent.select(F.explode("requests").alias("folder")).collect())

    # -- write --------------------------------------------------------------

    def staging(self, label: str) -> str:
        """A new place for an intermediate result."""
        return f"{self.root}/_staged/{self._writer}/{label}-{uuid.uuid4().hex[:8]}"

    def stage(self, rows: DataFrame, label: str) -> DataFrame:
        """Write an intermediate result and read it back.

        Cuts the lineage in the shared folder and gives the planner the exact
        size, so small change sets are broadcast and large ones are not.
        """
        path = self.staging(label)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that a change set falls into: at most ``self.buckets`` numbers."""
        return sorted(r["bucket"] for r in changes.select("bucket").distinct().collect())

    def _publish(self, record: str, name: str) -> None:
        """Give a finished record its name; an error if another has that name."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        source, target = fs.Path(record), fs.Path(name)
        hadoop = self.spark._jsc.hadoopConfiguration()
        context = fs.FileContext.getFileContext(source.getFileSystem(hadoop).getUri(), hadoop)
        kind = self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self.spark._jvm.java.lang.reflect.Array.newInstance(kind, 1)
        options[0] = kind.getEnumConstants()[0]  # NONE: never overwrite
        try:
            context.rename(source, target, options)
        except Exception as refused:
            if self._names(name.removeprefix(f"{self.root}/")):
                raise RuntimeError(f"another writer has published {name}") from refused
            raise

    def commit(
        self,
        writes: dict[str, Write],
        applied: dict[str, int] | None = None,
        ids: dict[str, int] | None = None,
        base: int | None = None,
    ) -> int:
        """Write all tables, then publish them together as the next version.

        ``ids`` notes the highest id given so far by table; see :meth:`last_id`. The
        commit is refused if the newest version isn't ``base``, the one its rows come from.
        """
        work = Unit(self)
        if base is not None and work.base != base:
            raise RuntimeError(f"another writer has published version {work.base}, these rows are of {base}")
        work.commit(writes, applied, ids)
        return work.publish()


class Unit(StateStore):
    """One version in the making: reads see the version it began with and its own writes."""

    def __init__(self, store: StateStore):
        super().__init__(store.spark, store.root, store.buckets)
        self._working = copy.deepcopy(store.pointer())
        self._working["requests"] = []
        self.base = self._working["version"]
        self._changed = False

    def pointer(self) -> dict:
        return self._working

    @contextmanager
    def unit(self) -> Iterator["Unit"]:
        """A pass within a pass: published by the outer one."""
        yield self

    def send(self, folder: str) -> None:
        """Name a folder of request documents that count when this unit is published."""
        self._working["requests"].append(folder)
        self._changed = True

    def commit(
        self,
        writes: dict[str, Write],
        applied: dict[str, int] | None = None,
        ids: dict[str, int] | None = None,
        base: int | None = None,
    ) -> int:
        """Write folders that later reads of this unit see; nothing is published."""
        record, attempt = self._working, uuid.uuid4().hex[:8]
        folders = {
            name: f"v={self.base + 1:08d}-{attempt}{REWRITTEN if write.buckets else ''}"
            for name, write in writes.items()
        }

        def put(name: str) -> None:
            rows = writes[name].rows.select(*schemas.TABLES[name].names, "bucket")
            # few, even files per bucket whatever the join before it did
            even = rows.hint("rebalance", "bucket").write
            even.partitionBy("bucket").parquet(f"{self.root}/{name}/{folders[name]}")

        with ThreadPoolExecutor(max(len(writes), 1)) as pool:
            list(pool.map(put, writes))
        for name, write in writes.items():
            dirs = record["tables"].setdefault(name, {})
            for bucket in write.buckets or []:
                dirs.pop(str(bucket), None)
            for path in self._names(f"{name}/{folders[name]}/bucket=*"):
                bucket = path.rsplit("=", 1)[1]
                dirs[bucket] = dirs.get(bucket, []) + [folders[name]]
        record["applied"].update(applied or {})
        noted = record.setdefault("ids", {})
        noted.update({name: max(n, noted.get(name, 0)) for name, n in (ids or {}).items()})
        self._changed = True
        return self.base + 1

    def publish(self) -> int:
        """Make everything written so far the next version; refused if there is one already."""
        if not self._changed:
            return self.base
        version = self.base + 1
        record = self._working | {"version": version}
        line = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(record)).alias("value"))
        draft = f"{self.root}/commits/_draft-{uuid.uuid4().hex[:8]}"
        line.write.text(draft)
        self._publish(draft, f"{self.root}/commits/c={version:010d}")
        self._changed = False
        return version
