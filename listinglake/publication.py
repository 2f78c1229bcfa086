"""Tables written aside and made live by a pointer.

Data goes to a fresh generation folder that no reader knows. ``publish`` then adds one small
pointer file, ``_live/<version>.json`` below the root, which names the live folders of every
table of that root. So one commit covers any number of tables, a job that dies half-way leaves
the live rows as they were, and whoever has read a pointer keeps one consistent state.

A table is made of parts, each a folder with its rows counted. A publication may replace some
parts and keep the others by name, so what did not change is neither read nor written.

A pointer appears complete, by a rename. A writer that started from an older version than the
newest is refused if it says what it ``expected``. ``sweep`` deletes what only old pointers name.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listinglake.errors import PublicationConflictError
from listinglake.session import exists, file_names, get_text, hadoop_path, has_delta, put_text

POINTERS = "_live"
GENERATIONS = "generations"
#: Folders above a table in which its pointer may lie.
_LEVELS = 3
#: Seconds after which a generation that was never published counts as left behind.
LEFT_BEHIND = 24 * 3600


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int


@dataclass(frozen=True)
class Table:
    """One table of a pointer: where its parts lie, relative to the root."""

    name: str
    schema: str
    format: str = "parquet"
    parts: dict[str, Part] = field(default_factory=dict)
    notes: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts.values())

    def rows_in(self, keys: Iterable[str]) -> int:
        return sum(self.parts[key].rows for key in keys if key in self.parts)

    def read(self, spark: SparkSession, root: str, keys: Iterable[str] | None = None) -> DataFrame:
        """All parts, or those of ``keys``; one scan with a given schema."""
        schema = StructType.fromJson(json.loads(self.schema))
        wanted = self.parts if keys is None else [key for key in keys if key in self.parts]
        folders = [f"{root}/{self.parts[key].folder}" for key in wanted]
        if not folders:
            return spark.createDataFrame([], schema)
        if self.format != "parquet":
            return spark.read.format(self.format).load(folders[0])
        return spark.read.schema(schema).parquet(*folders)

    def with_parts(self, newer: Table, gone: Iterable[str] = ()) -> Table:
        """This table with the parts of ``newer`` in place of its own; ``gone`` leave."""
        left = {key: part for key, part in self.parts.items() if key not in set(gone)}
        return replace(newer, parts={**left, **newer.parts}, notes={**self.notes, **newer.notes})


@dataclass(frozen=True)
class Live:
    """What one pointer names."""

    root: str
    version: int
    tables: dict[str, Table]

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        table = self.tables.get(name)
        return table.read(spark, self.root) if table else None


def _fresh(name: str) -> str:
    at = f"{name}/{GENERATIONS}" if name else GENERATIONS
    return f"{at}/{int(time.time())}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, root: str, name: str = "", notes: dict[str, int] | None = None) -> Table:
    """Write ``frame`` as the only part of a new generation of ``name``; nothing is live yet.

    The count comes with the write, not from a second run of the plan.
    """
    counted, folder = Observation(), _fresh(name)
    kind = "delta" if has_delta(frame.sparkSession) else "parquet"
    writer = frame.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(kind)
    writer.save(f"{root.rstrip('/')}/{folder}")
    rows = counted.get.get("rows", 0)
    return Table(name, frame.schema.json(), kind, {"": Part(folder, rows)}, notes or {})


def stage_parts(
    frame: DataFrame, root: str, name: str, by: str, files: int = 1, suffix: str = "", notes: dict[str, int] | None = None
) -> Table:
    """Write one part per value of the whole-number column ``by``, which is not stored in them.

    A value is dealt to ``files`` tasks by its rows' hash. Keys of the parts are the values,
    with ``suffix`` behind them. The counts are read from the file footers.
    """
    folder, spark = _fresh(name), frame.sparkSession
    others = [c for c in frame.columns if c != by]
    deal = F.pmod(F.xxhash64(*others), F.lit(files))
    at = f"{root.rstrip('/')}/{folder}"
    frame.repartition(by, deal).write.partitionBy(by).parquet(at)
    rows: dict[str, Part] = {}
    if [1 for _ in _folders(spark, at)]:
        counts = spark.read.parquet(at).groupBy(by).agg(F.count(F.lit(1)).alias("rows")).collect()
        rows = {f"{row[by]}{suffix}": Part(f"{folder}/{by}={row[by]}", row["rows"]) for row in counts}
    return Table(name, frame.select(*others).schema.json(), "parquet", rows, notes or {})


def _folders(spark: SparkSession, folder: str) -> list[str]:
    files, target = hadoop_path(spark, folder)
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = file_names(spark, f"{root}/{POINTERS}", ".json")
    return sorted(int(name[:-5]) for name in names if name[:-5].isdigit())


def _pointer(root: str, version: int) -> str:
    return f"{root}/{POINTERS}/{version:020d}.json"


def _load(spark: SparkSession, root: str, version: int) -> Live:
    found = json.loads(get_text(spark, _pointer(root, version)))
    tables = {}
    for name, entry in found["tables"].items():
        parts = {key: Part(**part) for key, part in entry.pop("parts").items()}
        tables[name] = Table(**entry, parts=parts)
    return Live(root, version, tables)


def live(spark: SparkSession, root: str) -> Live | None:
    """What the newest pointer of ``root`` names; None when nothing was published."""
    root = root.rstrip("/")
    versions = _versions(spark, root)
    return _load(spark, root, versions[-1]) if versions else None


def publish(spark: SparkSession, root: str, tables: Iterable[Table], expected: int | None = None) -> Live:
    """Make staged ``tables`` live together; other tables of ``root`` stay as they are.

    ``expected`` is the version the tables were built from, 0 for none.
    """
    root = root.rstrip("/")
    now = live(spark, root)
    version = now.version if now else 0
    if expected is not None and version != expected:
        raise PublicationConflictError(f"{root}: built from version {expected}, but {version} is live")
    merged = {**(now.tables if now else {}), **{table.name: table for table in tables}}
    text = json.dumps({"tables": {name: asdict(table) for name, table in merged.items()}})
    target = _pointer(root, version + 1)
    aside = f"{root}/{POINTERS}/.{version + 1}-{uuid.uuid4().hex}"
    put_text(spark, aside, text)
    files, path = hadoop_path(spark, target)
    moved = not files.exists(path) and files.rename(hadoop_path(spark, aside)[1], path)
    if not moved or get_text(spark, target) != text:
        raise PublicationConflictError(f"{root}: version {version + 1} was published by another writer")
    return Live(root, version + 1, merged)


def locate(spark: SparkSession, path: str) -> tuple[Live, str] | None:
    """Pointer and name of the table at ``path``, published there or from a folder above."""
    root, name = path.rstrip("/"), ""
    for _ in range(_LEVELS + 1):
        if exists(spark, f"{root}/{POINTERS}"):
            found = live(spark, root)
            if found and name in found.tables:
                return found, name
        root, _, last = root.rpartition("/")
        if not root or root.endswith(("/", ":")):
            return None
        name = f"{last}/{name}" if name else last
    return None


def sweep(spark: SparkSession, root: str, keep: int = 2, left_behind: float = LEFT_BEHIND) -> int:
    """Delete pointers but the newest ``keep`` and the generations only those named.

    Generations that no pointer ever named are deleted once they are ``left_behind`` seconds
    old: another writer may still be about to publish a younger one. Gives the folders deleted.
    """
    root = root.rstrip("/")
    versions = _versions(spark, root)
    pointers = [_load(spark, root, version) for version in versions]

    def generations(found: Iterable[Live]) -> set[str]:
        parts = (p.folder for f in found for t in f.tables.values() for p in t.parts.values())
        return {"/".join(f.split("/")[: f.split("/").index(GENERATIONS) + 2]) for f in parts}

    kept, named = generations(pointers[-keep:]), generations(pointers)
    files, _ = hadoop_path(spark, root)
    deleted = 0
    for name in {name for found in pointers for name in found.tables}:
        at = f"{name}/{GENERATIONS}" if name else GENERATIONS
        for folder in _folders(spark, f"{root}/{at}"):
            _, target = hadoop_path(spark, f"{root}/{at}/{folder}")
            age = time.time() - files.getFileStatus(target).getModificationTime() / 1000
            if f"{at}/{folder}" not in kept and (f"{at}/{folder}" in named or age > left_behind):
                deleted += bool(files.delete(target, True))
    for version in versions[:-keep]:
        files.delete(hadoop_path(spark, _pointer(root, version))[1], False)
    return deleted
