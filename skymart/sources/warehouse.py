"""Named tables in four layers: folders of parquet files with versions, and views in a catalog.

A table is replaced by writing its successor aside and naming that in a new version, so that readers
of the old one go on and a refresh that fails changes nothing. Rows are added in loads: staged,
numbered, and published in one step.
"""

from __future__ import annotations

import uuid
import zlib
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymart import schema
from skymart.operators.numbering import dense, placed
from skymart.sources.commits import DATA, STAGED, Log, Version

FILE_KEY, MONTH, LOAD = "file_key", "fl_month", "_load"
RAW_TABLES = {
    "flight_raw": schema.FLIGHT_RAW,
    "airport_raw": schema.AIRPORT_RAW,
    "airline_raw": schema.AIRLINE_RAW,
}
#: Columns whose values are looked for one by one: their files get bloom filters.
LOOKED_FOR = ("reporting_airline", "origin")
#: Distinct values a file's bloom filter is made for.
BLOOM_VALUES = 4096
_PLACE, _NUMBER = "_place", "_number"


def month_of(date: Column) -> Column:
    """The month of a date as one whole number, such as 202401."""
    return F.year(date) * 100 + F.month(date)


class Warehouse:
    """Tables under ``root``/layer/name; without a root below the catalog's databases, with views."""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark, self.root = spark, root

    def location(self, layer: str, name: str) -> str:
        if layer not in schema.LAYERS:
            raise ValueError(f"unknown layer {layer}")
        if self.root:
            return f"{self.root}/{layer}/{name}"
        return f"{self.spark.catalog.getDatabase(layer).locationUri}/{name}"

    def log(self, layer: str, name: str) -> Log:
        return Log(self.spark, self.location(layer, name))

    def exists(self, layer: str, name: str) -> bool:
        return bool(self.log(layer, name).versions())

    def read(
        self, layer: str, name: str, where: Column | None = None, version: int | None = None
    ) -> DataFrame:
        """The table, or its rows ``where``; a raw table that was never loaded is empty.

        ``where`` may use what files are partitioned by, though it is no column of the table:
        file_key and fl_month of flight_raw. ``version`` reads an older state that is still there.
        """
        log = self.log(layer, name)
        found = log.latest() if version is None else log.read(version)
        raw = RAW_TABLES.get(name) if layer == "staging" else None
        if found is None:
            if raw is None:
                raise LookupError(f"there is no table {layer}.{name}")
            return self.spark.createDataFrame([], raw)
        table = T.StructType.fromJson(found["table"])
        stored = T.StructType.fromJson(found["stored"])
        paths = [f"{log.folder.root}/{DATA}/{part}" for part in sorted(found["parts"])]
        if not paths:
            return self.spark.createDataFrame([], table)
        reader = self.spark.read.schema(stored).option("basePath", f"{log.folder.root}/{DATA}")
        rows = reader.parquet(*paths)
        if where is not None:
            rows = rows.filter(where)
        return rows.select(*self._columns(table, found["number"]))

    @staticmethod
    def _columns(table: T.StructType, number: str | None) -> list[Column]:
        first = F.substring_index(LOAD, "-", 1).cast("long")
        id_ = first + F.col(_NUMBER) - 1
        return [id_.alias(c) if c == number else F.col(c) for c in table.fieldNames()]

    def replace(
        self, df: DataFrame, layer: str, name: str, *by: str, hide: tuple[str, ...] = ()
    ) -> DataFrame:
        """Write ``df`` as the whole table, partitioned ``by`` columns, and read it back.

        Columns to ``hide`` are only partitioned by.
        """
        load = _Load(self, layer, name, by, hide)
        load.write(df)
        return load.publish(everything=True)

    def replace_partitions(
        self, df: DataFrame, layer: str, name: str, *by: str, hide: tuple[str, ...] = ()
    ) -> DataFrame:
        """Replace all rows with those values of the first ``by`` column that occur in ``df``."""
        load = _Load(self, layer, name, by, hide)
        load.write(df)
        return load.publish(everything=False)

    def stage(
        self, df: DataFrame, layer: str, name: str, *by: str, number: str, files: list[dict]
    ) -> _Load:
        """Write rows aside, numbered without a gap; nothing shows before they are published.

        Publishing them replaces the rows of earlier loads that share values of the first ``by``
        column. ``files`` (path and bytes) are noted before the first row is written. Any number of
        loads may be staged at a time, and be published in any order.
        """
        load = _Load(self, layer, name, by, tuple(c for c in by if c not in RAW_TABLES[name].names))
        load.begin(files)
        load.write(load.numbered(df, _NUMBER), number)
        return load

    def numbered(self, df: DataFrame, layer: str, name: str, key: str) -> DataFrame:
        """``df`` with a dense ``key`` from 1 in front, for one replace() of that table."""
        load = _Load(self, layer, name, (), ())
        return load.numbered(df, key).select(key, *df.columns)

    def loads(self, layer: str, name: str) -> DataFrame:
        """One row for each file of every load that began: what was loaded, and whether it shows."""
        rows = [
            (load["load"], file.get("path"), file.get("bytes"), load.get("rows"), load.get("first"),
             load.get("last"), "version" in load)
            for load in self.log(layer, name).loads()
            for file in load["files"] or [{}]
        ]
        return self.spark.createDataFrame(
            rows,
            "load string, path string, bytes long, rows long, first_id long, last_id long,"
            " committed boolean",
        )

    def clean(self, layer: str, name: str, versions: int = 1, hours: float = 24) -> None:
        """Delete what the last ``versions`` do not name, and staged rows older than ``hours``.

        Older versions can't be read any more, and loads that have staged longer can't be published.
        """
        log = self.log(layer, name)
        kept = {
            part.split("/")[0] for number in log.versions()[-versions:] for part in log.read(number)["parts"]
        }
        for place, keep in ((DATA, kept), (STAGED, set())):
            for own in log.folder.names(place):
                if own not in keep and log.folder.age(f"{place}/{own}") >= hours:
                    log.folder.delete(f"{place}/{own}")

    def show_view(self, layer: str, name: str, version: Version) -> None:
        """Point the catalog's view of a table to a version.

        It selects the live parts of a table over all files, one for each set of columns.
        """
        table, stored = (T.StructType.fromJson(version[k]) for k in ("table", "stored"))
        parts = sorted(version["parts"])
        columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table]
        source, live = "(SELECT 1)", "false"
        if parts:
            ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in stored]
            at = stored.names.index(LOAD)
            source = f"{layer}.{name}__files_{zlib.crc32(','.join(ddl).encode()):08x}"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {source} ({', '.join(ddl)}) USING parquet PARTITIONED BY"
                f" ({', '.join(f'`{c}`' for c in stored.names[at:])})"
                f" LOCATION '{self.location(layer, name)}/{DATA}'"
            )
            self.spark.sql(f"MSCK REPAIR TABLE {source}")
            first = f"CAST(substring_index(`{LOAD}`, '-', 1) AS BIGINT) + `{_NUMBER}` - 1"
            columns = [f"{first if c == version['number'] else f'`{c}`'} AS `{c}`" for c in table.names]
            key = stored.names[at + 1] if "/" in parts[0] else None
            path = f"'{LOAD}=', `{LOAD}`" + (f", '/{key}=', `{key}`" if key else "")
            names = ", ".join("'" + unquote(part).replace("'", "\\'") + "'" for part in parts)
            live = f"concat({path}) IN ({names})"
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {layer}.{name} AS"
            f" SELECT {', '.join(columns)} FROM {source} WHERE {live}"
        )

    def create(self) -> None:
        """Create the databases of a catalog, and the empty raw tables that do not exist yet."""
        for layer in schema.LAYERS if self.root is None else ():
            self.spark.sql(f"create database if not exists {layer}")
        for name, table in RAW_TABLES.items():
            if not self.exists("staging", name):
                empty = {"table": table.jsonValue(), "stored": table.jsonValue(), "parts": {}}
                version = self.log("staging", name).commit(
                    lambda base, new=empty: base or {**new, "number": None, "next": 1}
                )
                if self.root is None:
                    self.show_view("staging", name, version)


class _Load:
    """Rows on their way into a table."""

    def __init__(
        self, warehouse: Warehouse, layer: str, name: str, by: tuple[str, ...], hide: tuple[str, ...]
    ) -> None:
        self.warehouse, self.layer, self.name, self.by, self.hide = warehouse, layer, name, by, hide
        self.id, self.files = uuid.uuid4().hex, []
        self.log = warehouse.log(layer, name)
        self.at = f"{STAGED}/{self.id}"
        self.rows = self.number = None

    def begin(self, files: list[dict]) -> None:
        self.files = files
        self.log.begin(self.id, files)

    def numbered(self, df: DataFrame, key: str) -> DataFrame:
        """The rows, written once, with a dense number from 1 in the order of their partitions."""
        path = f"{self.log.folder.root}/{self.at}/rows"
        rows = placed(df, _PLACE)
        rows.write.parquet(path)
        written = self.warehouse.spark.read.schema(rows.schema).parquet(path)
        return dense(written, _PLACE, key)

    def write(self, df: DataFrame, number: str | None = None) -> None:
        """Stage the table's files; with a ``number`` sorted by date, with bloom filters."""
        self.number = number
        writer = df.write
        if number:
            writer = df.sortWithinPartitions(*self.by, "fl_date").write
            for column in LOOKED_FOR:
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(BLOOM_VALUES))
        path = f"{self.log.folder.root}/{self.at}/parts"
        writer.partitionBy(*self.by).parquet(path)
        if number:
            self.rows = self.warehouse.spark.read.schema(df.schema).parquet(path).count()
        fields = [f for f in df.schema.fields if f.name not in self.by]
        last = [df.schema[c] for c in self.by]
        self.stored = T.StructType([*fields, T.StructField(LOAD, T.StringType()), *last])
        shown = [f for f in df.schema.fields if f.name not in self.hide]
        table = T.StructType(shown) if not number else RAW_TABLES[self.name]
        self.table, self.stored_as = table.jsonValue(), self.stored.jsonValue()

    def publish(self, everything: bool = False) -> DataFrame:
        """Make the staged rows show, in place of all rows or of those of the same first key."""
        folder, now = self.log.folder, f"{self.at}/parts"
        keys = [k for k in folder.names(now) if "=" in k] if self.by else [""]

        def change(base: Version | None) -> Version:
            nonlocal now
            first = base["next"] if base and self.number else 1
            target = f"{LOAD}={first}-{self.id}"
            if now != f"{DATA}/{target}":
                folder.move(now, f"{DATA}/{target}")
                now = f"{DATA}/{target}"
            kept = {} if everything or base is None else base["parts"]
            kept = {path: 1 for path in kept if path.partition("/")[2] not in keys}
            parts = {**kept, **{f"{target}/{key}" if key else target: 1 for key in keys}}
            rows = self.rows or 0
            load = {"load": self.id, "rows": self.rows, "first": first, "last": first + rows - 1}
            return {
                "table": self.table,
                "stored": self.stored_as,
                "number": self.number,
                "parts": parts,
                "next": first + rows,
                "load": load if self.number else None,
            }

        version = self.log.commit(change)
        folder.delete(self.at)
        self.folder_name = now.rpartition("=")[2]
        if self.warehouse.root is None:
            self.warehouse.show_view(self.layer, self.name, version)
        return self.warehouse.read(self.layer, self.name)
