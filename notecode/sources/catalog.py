"""A folder of named tables and views: creation, whole and partial rewrites, appends, parameters and file listings.

Every write publishes a new version of its table (see ``VersionedTarget``), so a table can be
rewritten from itself, readers see old or new rows only, and two writers at once cannot lose rows.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import VersionedTarget


class Catalog:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        self._views: dict[str, str] = {}

    def _target(self, name: str) -> VersionedTarget:
        return VersionedTarget(self.spark, f"{self.root}/{name}")

    def bootstrap(self) -> list[str]:
        """Create every table that is not there, empty; the names of those created."""
        missing = [n for n in self.schemas if not self._target(n).current()]
        for n in missing:
            self.overwrite(n, self.spark.createDataFrame([], self.schemas[n]))
        return missing

    def exists(self, name: str) -> bool:
        return name in self._views or self._target(name).current() > 0

    def first_of(self, names: Iterable[str]) -> DataFrame | None:
        """The first of the named tables that is there and has a row."""
        for n in names:
            if self.exists(n) and not (df := self.table(n)).isEmpty():
                return df
        return None

    def table(self, name: str) -> DataFrame:
        if name in self._views:
            return self.sql(self._views[name])
        folders = self._target(name).folders()
        if not folders:
            raise ValueError(f"no table {name}")
        return self.spark.read.schema(self.schemas[name]).parquet(*[f"{self.root}/{name}/data/{f}" for f in folders])

    def _shaped(self, name: str, rows: DataFrame) -> DataFrame:
        schema = self.spark.createDataFrame([], self.schemas[name]).schema
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def overwrite(self, name: str, rows: DataFrame) -> int:
        t = self._target(name)
        base = t.current()
        return t._commit(base, [t._write(self._shaped(name, rows))])

    def append(self, name: str, rows: DataFrame) -> int:
        """Add rows; what is there is not written again."""
        t = self._target(name)
        base = t.current()
        return t._commit(base, [*t.folders(base), t._write(self._shaped(name, rows))])

    def insert_union(self, name: str, *parts: DataFrame) -> int:
        """Append the rows of all parts, columns by position as in INSERT ... SELECT ... UNION ALL."""
        names = self.spark.createDataFrame([], self.schemas[name]).columns
        first, *rest = [p.toDF(*names[: len(p.columns)]) for p in parts]
        for p in rest:
            first = first.union(p)
        return self.append(name, first)

    def insert_values(self, name: str, id_column: str | None = None, at_column: str | None = None, **values) -> int:
        """Append one row; a fresh id and the present time go into the columns named for them."""
        row = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
        if id_column:
            row = row.withColumn(id_column, F.expr("uuid()"))
        if at_column:
            row = row.withColumn(at_column, F.current_timestamp())
        return self.append(name, row)

    def merge_update(self, name: str, source: DataFrame, key: str, updates: dict[str, Column]) -> int:
        """MERGE ... WHEN MATCHED UPDATE: columns of matched rows get expressions over the row (``t.``) and its source row (``s.``); a key matches once."""
        one = source.dropDuplicates([key])
        j = self.table(name).alias("t").join(one.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
        hit = F.col(f"s.{key}").isNotNull()
        return self.overwrite(name, j.select(*[F.when(hit, updates[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in updates else F.col(f"t.{c}") for c in self.table(name).columns]))

    def update_where(self, name: str, condition: Column, values: dict[str, Column]) -> int:
        hit = F.coalesce(condition, F.lit(False))
        return self.overwrite(name, self.table(name).withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}))

    def create_view(self, name: str, query: str) -> None:
        """A view kept with the catalog: its query, over ``{table}`` names in braces, runs whenever it is read."""
        t = self._target(f"_views/{name}")
        t._commit(t.current(), [t._write(self.spark.createDataFrame([(query,)], "query string"))])
        self._views[name] = query

    def open_views(self, names: Iterable[str]) -> None:
        """Take views that an earlier session created into this one."""
        for n in names:
            self._views[n] = self._target(f"_views/{n}").read().head()[0]

    def sql(self, query: str, args: dict | list | None = None) -> DataFrame:
        """A query over the catalog's tables, named in braces, with bound parameters (``:name`` or ``?``)."""
        used = {n: self.table(n) for n in {*self.schemas, *self._views} if "{" + n + "}" in query and self.exists(n)}
        return self.spark.sql(query, args=args, **used)


def list_files(spark: SparkSession, folder: str, suffixes: Iterable[str]) -> dict[str, list[str]]:
    """The files of a folder by suffix, in order; a folder that is not there has none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().toString() for f in fs.listStatus(path)) if fs.exists(path) else []
    return {s: [n for n in names if n.lower().endswith(s)] for s in suffixes}


def find_file(spark: SparkSession, folder: str, part: str, suffix: str = ".txt") -> str | None:
    """The last file of a folder whose name has ``part``, letter case aside."""
    hits = [n for n in list_files(spark, folder, (suffix,))[suffix] if part.lower() in n.rsplit("/", 1)[-1].lower()]
    return hits[-1] if hits else None


def serialize(row) -> dict:
    """A row as plain values for JSON: decimals as floats, dates and times in ISO form."""
    plain: dict[type, Callable] = {decimal.Decimal: float, datetime.datetime: lambda v: v.isoformat(), datetime.date: lambda v: v.isoformat()}
    return {k: plain.get(type(v), lambda x: x)(v) for k, v in row.asDict(recursive=True).items()}


_DECODERS: dict[str, Callable] = {**dict.fromkeys(("BYTE", "SHORT", "INT", "LONG", "BIGINT", "SMALLINT", "TINYINT"), int), **dict.fromkeys(("FLOAT", "DOUBLE", "DECIMAL"), float), "BOOLEAN": lambda v: v.lower() in ("true", "1", "t")}


def decode_result(columns: list[tuple[str, str]], rows: list[list[str | None]]) -> list[dict]:
    """Rows of strings, as a SQL service over HTTP returns them, by (name, type) of their columns."""
    read = [(name, _DECODERS.get(kind.split("(")[0].upper(), str)) for name, kind in columns]
    return [{name: None if v is None else f(v) for (name, f), v in zip(read, row)} for row in rows]
