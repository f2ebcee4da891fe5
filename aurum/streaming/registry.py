"""R-06: versioned schemas of the streamed feeds.

The file source fixes a stream's schema when it starts, so a feed's schema is
kept in numbered versions (``<root>/v00000001.json``).  A restart looks at the
files that landed since the last version was written, adds their new columns
(and widens numbers), and reads everything, old files included, under the newest
version.  Columns never go and never change to a type that old rows don't fit.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from aurum.sources import tables

#: Types in the order in which a later one holds all values of an earlier one.
WIDENED = [["tinyint", "smallint", "int", "bigint"], ["float", "double"], ["int", "double"]]


class SchemaConflict(ValueError):
    pass


def widened(name: str, a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both; structs get the fields of both."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    x, y = a.simpleString(), b.simpleString()
    if x == y or y == "void":
        return a
    if x == "void":
        return b
    for order in WIDENED:
        if x in order and y in order:
            return a if order.index(x) > order.index(y) else b
    raise SchemaConflict(f"column {name!r} is {x} and {y}")


def merged(old: StructType, new: StructType) -> StructType:
    """``old``, widened, then the columns that only ``new`` has (all nullable)."""
    by_name = {f.name: f for f in new.fields}
    out = [StructField(f.name, widened(f.name, f.dataType, by_name[f.name].dataType) if f.name in by_name else f.dataType, True) for f in old.fields]
    return StructType(out + [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in {g.name for g in old.fields}])


class SchemaRegistry:
    """The versions of one feed's schema, in a folder that all jobs share."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def versions(self, spark: SparkSession) -> list[str]:
        return [n for n in tables.names_under(spark, self.root) if n.startswith("v") and n.endswith(".json")]

    def latest(self, spark: SparkSession) -> tuple[int, StructType, str | None] | None:
        """Number, schema and time (UTC) up to which landed files were looked at."""
        names = self.versions(spark)
        if not names:
            return None
        note = json.loads(tables.read_text(spark, f"{self.root}/{names[-1]}"))
        return note["version"], StructType.fromJson(note["schema"]), note["seen"]

    def register(self, spark: SparkSession, schema: StructType, seen: str | None = None) -> StructType:
        """The newest schema widened by ``schema``; a change is written as the next version."""
        last = self.latest(spark)
        now = merged(last[1], schema) if last else merged(schema, StructType([]))
        if last is None or now != last[1] or seen is not None and seen != last[2]:
            version = last[0] + (now != last[1]) if last else 1
            note = {"version": version, "schema": json.loads(now.json()), "seen": seen or (last[2] if last else None)}
            p, fs = tables._path(spark, self.root)
            fs.mkdirs(p)
            tables.write_text(spark, f"{self.root}/v{version:08d}.json", json.dumps(note))
        return now

    def evolve(self, spark: SparkSession, landing: str, declared: StructType, source_format: str = "json") -> StructType:
        """Register the declared columns, and those of the files that landed since the
        last look.  Columns that are known keep their types: only widening numbers
        and new columns are taken from the files."""
        known = self.register(spark, declared)
        seen = self.latest(spark)[2]
        started = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=2)  # files of the last moment are looked at again
        r = spark.read.format(source_format)
        if source_format == "csv":
            r = r.option("header", "true")
        if seen:
            r = r.option("modifiedAfter", seen).option("timeZone", "UTC")
        if not tables.path_exists(spark, landing):
            return known
        try:
            found = r.load(landing).schema
        except Exception as e:  # noqa: BLE001  no file landed since: nothing to infer a schema from
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            found = StructType([])
        have = {f.name: f.dataType for f in known.fields}
        fresh = []
        for f in found.fields:
            if f.dataType.simpleString() == "void" or f.name.startswith("_corrupt"):
                continue
            if f.name in have:
                try:
                    widened(f.name, have[f.name], f.dataType)
                except SchemaConflict:  # text of a column that is declared otherwise (dates in JSON): the declaration holds
                    continue
            fresh.append(f)
        return self.register(spark, StructType(fresh), started.strftime("%Y-%m-%dT%H:%M:%S"))
