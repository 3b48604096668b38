"""Tables published together, all or nothing.

Data files are written to new folders and never changed. A snapshot is one small file that lists, for
every table, the folders that make it up. Publishing is the rename of that file to the next number: until
then readers see the old snapshot, whatever was written; after it they see all tables of the commit. A
name that is taken means that someone else published first, and the commit is refused.

    store = SnapshotStore(spark, "/shared/indices")
    with store.transaction() as t:
        t.replace_parts("indice_zone", weeks, "annee")   # only the years of `weeks` change
        t.replace("normals", normals)                    # the whole table
    store.read("indice_zone")
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.sources.sinks import merge_observations, replace_weeks


class Conflict(RuntimeError):
    """Another writer published since the transaction began."""


class AuditFailed(RuntimeError):
    """What was written is not what can be read back; nothing was published."""


@dataclass
class Table:
    """The folders of a table, each with its part (null in a table without parts) and rows."""

    schema: dict
    parts: list[dict] = field(default_factory=list)

    def folders(self, only: Iterable | None = None) -> list[str]:
        wanted = None if only is None else set(only)
        return [p["folder"] for p in self.parts if wanted is None or p["part"] in wanted]


class SnapshotStore:
    """Tables under one folder of a file system that all executors share and whose rename is atomic and
    refuses a taken name (as HDFS's). Folders no snapshot lists are the retention's business."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- the list of snapshots ---

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def versions(self) -> list[int]:
        folder = self._path("snapshots")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _load(self, version: int) -> dict:
        text = self.spark.read.text(f"{self.root}/snapshots/v{version:09d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def tables(self, version: int | None = None) -> dict[str, Table]:
        """The tables of a snapshot, by default the latest; none before the first."""
        version = max(self.versions(), default=0) if version is None else version
        if version == 0:
            return {}
        return {n: Table(t["schema"], t["parts"]) for n, t in self._load(version)["tables"].items()}

    def history(self) -> DataFrame:
        """One row for each snapshot and table: version, table_name, n_parts, n_rows."""
        rows = [
            (v, n, len(t.parts), sum(p["rows"] for p in t.parts))
            for v in self.versions() for n, t in sorted(self.tables(v).items())
        ]
        return self.spark.createDataFrame(rows, "version long, table_name string, n_parts long, n_rows long")

    def _publish(self, version: int, tables: Mapping[str, Table]) -> None:
        text = json.dumps(
            {"version": version, "tables": {n: {"schema": t.schema, "parts": t.parts} for n, t in tables.items()}}
        )
        target, draft = self._path("snapshots", f"v{version:09d}.json"), self._path("drafts", uuid.uuid4().hex)
        fs = target.getFileSystem(self._conf)
        fs.mkdirs(target.getParent())
        out = fs.create(draft, False)
        out.write(text.encode())
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            self._hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(draft, target, none)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"snapshot {version} was published by another writer") from None
            raise

    # --- reading and writing ---

    def has(self, name: str) -> bool:
        return name in self.tables()

    def read(self, name: str, version: int | None = None, parts: Iterable | None = None) -> DataFrame:
        """A table as of a snapshot, or only some of its parts; other folders are not listed."""
        return self._frame(self.tables(version)[name], parts)

    def _frame(self, table: Table, parts: Iterable | None = None) -> DataFrame:
        schema, folders = StructType.fromJson(table.schema), table.folders(parts)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def transaction(self) -> Transaction:
        return Transaction(self)

    def merge(self, name: str, batch: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> None:
        """Merge a batch into a table in parts of years and publish it."""
        with self.transaction() as t:
            t.merge(name, batch, keys, values, F.year(date))


class Transaction:
    """Changes on top of the snapshot that was the latest at the start. Left without an exception, it
    counts what it wrote again and publishes; else nothing is published."""

    def __init__(self, store: SnapshotStore):
        self.store = store
        self.base = max(store.versions(), default=0)
        self.tables = store.tables(self.base)
        self.version: int | None = None
        self._written: dict[str, tuple[int, Table]] = {}  # table -> rows that went in, new folders

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def read(self, name: str, parts: Iterable | None = None) -> DataFrame:
        return self.store._frame(self.tables[name], parts)

    def _write(self, name: str, df: DataFrame, by: Sequence[str], part: Column | None) -> list[dict]:
        """New folders with the rows of `df`, one for each value of `part`."""
        folder, seen = f"{self.store.root}/data/{name}/{uuid.uuid4().hex}", Observation()
        spark, schema, count = self.store.spark, df.schema, F.count(F.lit(1)).alias("n")
        if part is None:
            df.observe(seen, count).write.parquet(folder)
            found = spark.read.schema(schema).parquet(folder)
            made = [{"part": None, "folder": folder, "rows": found.count()}]
        else:
            # ranges of keys inside each part: files sorted by key, and a large part is many tasks
            order = ["_part", *by]
            keyed = df.withColumn("_part", part.cast("string")).repartitionByRange(*order).sortWithinPartitions(*order)
            keyed.observe(seen, count).write.partitionBy("_part").parquet(folder)
            found = spark.read.schema(f"{_ddl(schema)}, _part string").parquet(folder)
            made = [
                {"part": r["_part"], "folder": f"{folder}/_part={r['_part']}", "rows": r["n"]}
                for r in found.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
            ]
        went_in, before = self._written.get(name, (0, Table({})))
        self._written[name] = (went_in + seen.get["n"], Table(json.loads(schema.json()), before.parts + made))
        return made

    def replace(self, name: str, df: DataFrame) -> None:
        """The table becomes `df`."""
        made = self._write(name, df, [], None)
        self.tables[name] = Table(json.loads(df.schema.json()), made)

    def replace_parts(
        self, name: str, df: DataFrame, part: str | Column, keys: Sequence[str] = (), also: Iterable[str] = ()
    ) -> list[str]:
        """The parts that `df` has rows of become those rows, and the parts `also` even without rows; the
        others stay. Parts must be few (years), not null and plain names. Gives the parts replaced."""
        part = F.col(part) if isinstance(part, str) else part
        old = self.tables.get(name)
        if old is not None:
            df = df.select(*[f["name"] for f in old.schema["fields"]])
        made = self._write(name, df, keys, part)
        gone = {p["part"] for p in made} | {str(a) for a in also}
        if None in gone or "__HIVE_DEFAULT_PARTITION__" in gone:
            raise ValueError(f"rows of {name} without a part")
        kept = [] if old is None else [p for p in old.parts if p["part"] not in gone]
        self.tables[name] = Table(json.loads(df.schema.json()), kept + made)
        return sorted(gone)

    def merge(self, name: str, batch: DataFrame, keys: Sequence[str], values: Sequence[str], part: Column) -> None:
        """Merge a batch by key (see `merge_observations`). Only the parts of the batch are read and
        written again; `part` is a function of the keys."""
        if name not in self.tables:
            self.replace_parts(name, batch, part, keys)
            return
        columns = [f["name"] for f in self.tables[name].schema["fields"]]
        touched = [r[0] for r in batch.select(part.cast("string")).distinct().collect()]
        merged = merge_observations(self.read(name, touched), batch.select(*columns), keys, values)
        self.replace_parts(name, merged, part, keys)

    def replace_weeks(self, name: str, fresh: DataFrame, weeks: DataFrame) -> None:
        """Recomputed weeks (`semaine`) take the place of the stored ones, those without a row too. Parts
        are ISO years; only those of the weeks are read and written again."""
        year = F.substring("semaine", 1, 4)
        touched = [r[0] for r in weeks.select(year).distinct().collect()]
        if name in self.tables:
            fresh = replace_weeks(self.read(name, touched), fresh, weeks)
        self.replace_parts(name, fresh, year, ["semaine"], touched)

    def audit(self) -> DataFrame:
        """For every table written, in order: rows that went in and rows that can be read back."""
        rows = [
            (i, name, n, self.store._frame(table).count()) for i, (name, (n, table)) in enumerate(self._written.items())
        ]
        found = self.store.spark.createDataFrame(rows, "position int, table_name string, n_read long, n_loaded long")
        return found.withColumn("ok", F.col("n_read") == F.col("n_loaded"))

    def commit(self) -> int:
        """Publish; the number of the new snapshot, or of the old one where nothing was written."""
        if not self._written:
            return self.base
        wrong = self.audit().where(~F.col("ok")).collect()
        if wrong:
            raise AuditFailed("; ".join(f"{r.table_name}: {r.n_read} rows in, {r.n_loaded} read back" for r in wrong))
        self.store._publish(self.base + 1, self.tables)
        self.version = self.base + 1
        return self.version


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
