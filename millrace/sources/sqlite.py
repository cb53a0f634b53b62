"""Python data source over page stores kept as one SQLite file per (source, host).

Bodies are zstd blobs in such stores and come out unpacked; a body that is no
such blob comes out as it is.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from ..session import ship
from .files import unpacked_blob

COLUMNS = "id long, url string, final_url string, status int, kind string, ctype string, nbytes long, fetched_at double, attempts int, err string, html binary"


class StoreFile(InputPartition):
    def __init__(self, path: str, source: str, host: str) -> None:
        self.path, self.source, self.host = path, source, host


class StoreReader(DataSourceReader):
    """One input partition per file; predicates on source, host and kind prune files or rows at the source."""

    def __init__(self, schema: StructType, root: str) -> None:
        self.fields = schema.fieldNames()
        self.root = root
        self.keep: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) else None
            if name in ("source", "host", "kind") and isinstance(f, EqualTo):
                self.keep[name] = {f.value} & self.keep.get(name, {f.value})
            elif name in ("source", "host", "kind") and isinstance(f, In):
                self.keep[name] = set(f.value) & self.keep.get(name, set(f.value))
            else:
                yield f

    def partitions(self) -> list[StoreFile]:
        out = []
        for path in sorted(glob.glob(os.path.join(self.root, "*", "*.sqlite"))):
            source, host = os.path.basename(os.path.dirname(path)), os.path.basename(path)[: -len(".sqlite")]
            if source in self.keep.get("source", {source}) and host in self.keep.get("host", {host}):
                out.append(StoreFile(path, source, host))
        return out

    def read(self, part: StoreFile) -> Iterator[tuple]:
        if part is None:
            return
        kinds = sorted(self.keep.get("kind", ()))
        where = f" WHERE kind IN ({','.join('?' * len(kinds))})" if "kind" in self.keep else ""
        stored = [f for f in self.fields if f not in ("source", "host")]
        with sqlite3.connect(f"file:{part.path}?mode=ro", uri=True) as c:
            for row in c.execute(f"SELECT {','.join(stored) or '1'} FROM pages{where}", kinds):
                values = dict(zip(stored, row)) | {"source": part.source, "host": part.host}
                if "html" in values:
                    values["html"] = unpacked_blob(values["html"])
                yield tuple(values[f] for f in self.fields)


class SqliteStore(DataSource):
    """``spark.read.format("sqlite_store").load(folder)`` of ``<source>/<host>.sqlite`` files."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_store"

    def schema(self) -> str:
        return "source string, host string, " + COLUMNS

    def reader(self, schema: StructType) -> StoreReader:
        return StoreReader(schema, self.options["path"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(SqliteStore)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
