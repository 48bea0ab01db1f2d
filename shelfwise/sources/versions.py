"""Tables in versions: data folders that are never changed, and small commits that name them.

Layout below a table's folder::

    <area>/load=<id>/[<column>=<value>/]*.parquet   rows of one load, never touched again
    commits/v=<n>/*.parquet                         one file: what version n consists of

An area is one of several row sets of a table that change together (the rows, an index of them, sums
of them). A commit lists, for each area, the parts of the version and the load that holds each: the
whole area as one part, or one part for each value of the column it is stored by. A load writes its
folders first and commits last. The commit is one file that appears at once, so readers see the old
version or the new one; a load that dies leaves folders that no commit names. A plan that was made
before a load goes on reading the old folders until they are expired.

Commits hold as many rows as the table has parts (the days of a calendar, say) and are read on the
driver, like the file listing of any table. One writer at a time: of two, one fails at its commit.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwise.session import freed_shuffles, many_writers, open_files

ROWS = "rows"
_COMMIT = (
    "area string, part string, load string, load_parts int, stored_by string, schema string, "
    "label string, n_rows long, committed_at timestamp"
)
#: Commits that a driver remembers, so many.
REMEMBERED = 500
_READ: dict[tuple[str, int], Version] = {}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def part_name(value) -> str:
    """The name of a part, as the folder of its value is called."""
    if value is None:
        return _NO_VALUE
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


@dataclass(frozen=True)
class Area:
    """One area of a version: part name (None: the whole area) -> load that holds it."""

    schema: StructType
    stored_by: str | None = None
    parts: Mapping[str | None, str] = field(default_factory=dict)
    load_parts: Mapping[str, int] = field(default_factory=dict)

    def days(self) -> list[str]:
        return sorted(p for p in self.parts if p not in (None, _NO_VALUE))


@dataclass(frozen=True)
class Version:
    number: int
    areas: Mapping[str, Area]
    labels: tuple[str, ...] = ()


class VersionedTable:
    """A table at ``path`` that changes by commits."""

    def __init__(self, spark: SparkSession, path: str, tight: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        #: Whether all areas are compressed like those stored by a column.
        self.tight = tight

    # --- versions

    def _commits(self) -> DataFrame | None:
        if not _FileSystem(self.spark, self.path).exists("commits"):
            return None
        return self.spark.read.schema(f"{_COMMIT}, v int").parquet(f"{self.path}/commits")

    def _numbers(self) -> list[int]:
        """The numbers that commits took, those of commits that died among them."""
        files = _FileSystem(self.spark, self.path)
        if not files.exists("commits"):
            return []
        return sorted(int(f.removeprefix("v=")) for f in files.folders("commits"))

    def version(self, number: int | None = None) -> Version | None:
        """A version by its number; the current one, or None before the first commit.

        The current one is found by listing folders; commits never change, so each is read once.
        """
        files = _FileSystem(self.spark, self.path)
        known = [number] if number is not None else reversed(self._numbers())
        for n in known:
            if (self.path, n) in _READ:
                return _READ[self.path, n]
            if files.exists(f"commits/v={n}") and files.has_rows(f"commits/v={n}"):
                return self._read_commit(n)
        if number is not None:
            raise ValueError(f"{self.path} has no version {number}")
        return None

    def _read_commit(self, number: int) -> Version:
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits/v={number}").collect()
        areas: dict[str, Area] = {}
        for row in rows:
            area = areas.setdefault(row["area"], Area(
                StructType.fromJson(json.loads(row["schema"])), row["stored_by"], {}, {}))
            if row["load"] is not None:
                area.parts[row["part"]] = row["load"]
                area.load_parts[row["load"]] = row["load_parts"]
        found = Version(number, areas, tuple(sorted({r["label"] for r in rows if r["label"]})))
        while len(_READ) >= REMEMBERED:
            _READ.pop(next(iter(_READ)))
        _READ[self.path, number] = found
        return found

    def knows(self, number: int) -> bool:
        """Whether a version is there and has not expired."""
        files = _FileSystem(self.spark, self.path)
        return files.exists(f"commits/v={number}") and files.has_rows(f"commits/v={number}")

    def history(self) -> DataFrame:
        """(v, label, n_rows, committed_at) of every version that is still known."""
        commits = self._commits()
        if commits is None:
            return self.spark.createDataFrame(
                [], "v int, label string, n_rows long, committed_at timestamp")
        return commits.groupBy("v").agg(
            F.max("label").alias("label"), F.max("n_rows").alias("n_rows"),
            F.max("committed_at").alias("committed_at"))

    def as_sql(self, area: str = ROWS) -> str:
        """A query over the folders of the current version, for a view in the catalog."""
        found = self.version().areas[area]
        columns = ", ".join(
            f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in found.schema)
        parts: dict[str, list[str | None]] = {}
        for part, load in found.parts.items():
            parts.setdefault(load, []).append(part)
        texts = []
        for load, some in sorted(parts.items()):
            text = f"SELECT {columns} FROM parquet.`{self.path}/{area}/load={load}`"
            if None not in some and len(some) < found.load_parts[load]:
                days = ", ".join(f"'{p}'" for p in some if p != _NO_VALUE)
                live = [f"`{found.stored_by}` IN ({days})"] if days else []
                live += [f"`{found.stored_by}` IS NULL"] if _NO_VALUE in some else []
                text += f" WHERE {' OR '.join(live)}"
            texts.append(text)
        empty = ", ".join(
            f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in found.schema)
        return " UNION ALL ".join(texts) or f"SELECT {empty} WHERE false"

    def has(self, label: str) -> bool:
        """Whether a commit carries this label; lets a repeated load be recognised."""
        return not self.history().filter(F.col("label") == label).isEmpty()

    # --- reading

    def read(self, area: str = ROWS, version: int | None = None,
             parts: Iterable[str] | None = None) -> DataFrame:
        """An area of a version, or some parts of it. The column it is stored by prunes folders."""
        found = self.version(version)
        if found is None or area not in found.areas:
            raise ValueError(f"{self.path} has no area {area!r} yet")
        return self.read_area(area, found.areas[area], parts)

    def read_area(self, name: str, area: Area, parts: Iterable[str] | None = None,
                  with_load: bool = False) -> DataFrame:
        """The rows of an area; with the name of the load that holds each, if wanted."""
        wanted = dict(area.parts)
        if parts is not None:
            chosen = set(parts)
            wanted = {p: load for p, load in wanted.items() if p in chosen}
        by_load: dict[str, list[str | None]] = {}
        for part, load in wanted.items():
            by_load.setdefault(load, []).append(part)
        paths = []
        for load, some in sorted(by_load.items()):
            root = f"{self.path}/{name}/load={load}"
            if None in some or len(some) == area.load_parts[load]:
                paths.append(root)  # the whole load
            else:
                paths.extend(f"{root}/{area.stored_by}={part}" for part in sorted(some))
        schema = StructType([
            *(StructField(f.name, f.dataType, True) for f in area.schema),
            StructField("load", StringType(), True)])
        columns = [f"`{f.name}`" for f in (schema if with_load else area.schema)]
        if not paths:
            return self.spark.createDataFrame([], schema).select(*columns)
        return (
            self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}")
            .parquet(*paths).select(*columns)
        )

    # --- writing

    def new_load(self) -> str:
        """A name for the folders of a load; later loads sort behind earlier ones."""
        return f"{max(self._numbers(), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"

    def write(self, area: str, load: str, df: DataFrame, stored_by: str | None = None,
              sorted_by: Sequence[str] = (), gather: bool = True) -> int:
        """The rows of an area of a load; returns how many. Nothing is committed yet. Without
        ``gather`` each task writes the parts of its rows: for rows that lie by part already, or rows
        of a few parts that lie in all tasks.

        Facts are compressed more tightly than Spark would. Small tables are not: the planner takes
        the size of files for that of rows and would broadcast more of them."""
        rows = Observation()
        gathered = df.hint("rebalance", F.col(stored_by)) if stored_by and gather else df
        if sorted_by:
            gathered = gathered.sortWithinPartitions(*([stored_by] if stored_by else []), *sorted_by)
        writer = gathered.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        if stored_by or self.tight:
            writer = writer.option("compression", "zstd")
        target = f"{self.path}/{area}/load={load}"
        writers = many_writers if gather else open_files
        spark = df.sparkSession  # of a stream's batch: not the table's own
        with freed_shuffles(spark):
            if stored_by:
                with writers(spark):
                    writer.partitionBy(stored_by).parquet(target)
            else:
                writer.parquet(target)
        return rows.get["rows"]

    def commit(self, areas: Mapping[str, Area], label: str | None = None,
               n_rows: int | None = None) -> int:
        """Make these areas the next version; areas that are not named stay as they are."""
        found = self.version()
        number = max(self._numbers(), default=0) + 1
        now = datetime.datetime.now()
        rows = []
        for name, area in {**(found.areas if found else {}), **areas}.items():
            schema = area.schema.json()
            of_load: dict[str, int] = dict(area.load_parts)
            parts = area.parts or {None: None}
            rows.extend(
                (name, part, load, of_load.get(load, 1), area.stored_by, schema, label, n_rows, now)
                for part, load in parts.items())
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("errorifexists").parquet(
            f"{self.path}/commits/v={number}")
        return number

    def replace(self, df: DataFrame, stored_by: str | None = None, label: str | None = None,
                area: str = ROWS, gather: bool = True) -> int:
        """A new version with these rows in place of all; returns their number."""
        load = self.new_load()
        n = self.write(area, load, df, stored_by, gather=gather)
        self.commit({area: self.whole(df, area, load, stored_by)}, label, n)
        return n

    def append(self, df: DataFrame, label: str | None = None, area: str = ROWS) -> int:
        """A new version with these rows besides all others; returns the number of new rows."""
        load = self.new_load()
        n = self.write(area, load, df)
        self.commit({area: self.appended(df, area, load)}, label, n)
        return n

    def appended(self, df: DataFrame, area: str, load: str, stored_by: str | None = None) -> Area:
        """The current area with one more load as a part of its own."""
        found = self.version()
        before = found.areas.get(area) if found else None
        return Area(
            df.schema, stored_by, {**(before.parts if before else {}), load: load},
            {**(before.load_parts if before else {}), load: 1})

    def whole(self, df: DataFrame, area: str, load: str, stored_by: str | None = None) -> Area:
        """An area that consists of one load, with a part for each value it is stored by."""
        if stored_by is None:
            return Area(df.schema, None, {None: load}, {load: 1})
        values = self.parts_of(area, load, stored_by)
        return Area(df.schema, stored_by, dict.fromkeys(values, load), {load: len(values)})

    def parts_of(self, area: str, load: str, stored_by: str) -> list[str]:
        """The names of the parts that a load wrote, as its folders are called; reads no rows."""
        folders = _FileSystem(self.spark, self.path).folders(f"{area}/load={load}")
        return [f.removeprefix(f"{stored_by}=") for f in folders if f.startswith(f"{stored_by}=")]

    def replace_parts(self, df: DataFrame, stored_by: str, parts: Iterable[str],
                      label: str | None = None, area: str = ROWS) -> int:
        """A new version in which ``df`` stands for these parts; all others stay where they are."""
        load = self.new_load()
        n = self.write(area, load, df, stored_by)
        self.commit({area: self.with_parts(df, area, load, stored_by, parts)}, label, n)
        return n

    def with_parts(self, df: DataFrame, area: str, load: str, stored_by: str,
                   replaced: Iterable[str]) -> Area:
        """The current area without ``replaced``, with what a load wrote."""
        found = self.version()
        before = found.areas.get(area) if found else None
        gone = set(replaced)
        kept = {p: x for p, x in (before.parts if before else {}).items() if p not in gone}
        written = self.parts_of(area, load, stored_by)
        clash = set(written) & set(kept)
        if clash:
            raise ValueError(f"parts {sorted(clash)[:3]} are written but not replaced")
        counts = {x: n for x, n in (before.load_parts if before else {}).items()
                  if x in set(kept.values())}
        return Area(df.schema, stored_by, {**kept, **dict.fromkeys(written, load)},
                    {**counts, load: len(written)})

    # --- old versions

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the commits before the last ``keep`` and the loads that no kept one names,
        loads that were never committed among them; returns what was deleted."""
        commits = self._commits()
        if commits is None:
            return []
        numbers = sorted(r[0] for r in commits.select("v").distinct().collect())
        kept = numbers[-keep:]
        live = {(r["area"], r["load"]) for r in
                commits.filter(F.col("v").isin(kept)).select("area", "load").distinct().collect()}
        files = _FileSystem(self.spark, self.path)
        dead = [f"commits/v={n}" for n in numbers[:-keep]]
        for area in files.folders(""):
            if area != "commits":
                dead.extend(f"{area}/{load}" for load in files.folders(area)
                            if (area, load.removeprefix("load=")) not in live)
        for name in dead:
            files.delete(name)
        for n in numbers[:-keep]:
            _READ.pop((self.path, n), None)
        return dead


class _FileSystem:
    """Folders below a root, on whatever file system Spark knows for it."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._root = root
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(self, name: str) -> list[str]:
        where = self._path(f"{self._root}/{name}" if name else self._root)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where) if s.isDirectory())

    def has_rows(self, name: str) -> bool:
        """Whether a folder holds a finished file."""
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self._root}/{name}")))
        return any(not n.startswith(("_", ".")) for n in names)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self._root}/{name}"))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self._root}/{name}"), True)

