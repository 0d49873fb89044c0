"""Folders of tables in whatever file system Spark reads them from."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Where a table keeps its folded rows and what they replace. Listings skip such names.
FOLDED = "_folded"
FOLDED_RUN = "compacted"


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def make(spark: SparkSession, path: str) -> None:
    store, place = _open(spark, path)
    store.mkdirs(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Gives whether there was something to remove."""
    store, place = _open(spark, path)
    return store.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path``, none if it does not exist."""
    store, place = _open(spark, path)
    if not store.exists(place):
        return []
    return sorted(each.getPath().getName() for each in store.listStatus(place) if each.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """The files right below ``path``, none if it does not exist."""
    store, place = _open(spark, path)
    if not store.exists(place):
        return []
    return sorted(each.getPath().getName() for each in store.listStatus(place) if each.isFile())


def partition_values(spark: SparkSession, table: str, below: str, column: str) -> list[str]:
    """Values of the partition ``column`` right below the folder ``below`` of a table."""
    store, place = _open(spark, table)
    if not store.exists(place):
        raise FileNotFoundError(f"there is no table at {table}")
    prefix = f"{column}="
    found = names(spark, below)
    return [name.removeprefix(prefix) for name in found if name.startswith(prefix)]


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _open(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file in one step: whoever sees it sees all of it. It must not exist yet."""
    store, place = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    stream = store.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.rename(draft, place):
        raise FileExistsError(f"{path} exists already")


def leaves(spark: SparkSession, table: str, schema: T.StructType, below: Sequence[str]) -> list[str]:
    """The folders with files below some folders of a table, relative to it.

    Spark lists them, in parallel where there are many.
    """
    found = spark.read.schema(schema or "_none int").option("basePath", table).parquet(*below).inputFiles()
    depth = len(_open(spark, table)[1].toUri().getPath().rstrip("/")) + 1
    paths = {spark._jvm.java.net.URI(file).getPath() if "%" in file else _path(file) for file in found}
    return sorted({path[depth:].rpartition("/")[0] for path in paths})


def _path(uri: str) -> str:
    """The path of a URI without escapes."""
    scheme, _, rest = uri.rpartition("://")
    if scheme:
        return "/" + rest.partition("/")[2]
    return uri.partition(":")[2] if ":/" in uri else uri


def folded(spark: SparkSession, table: str) -> dict:
    """The newest version of what was folded: by period the folders that count and those that
    they replace, relative to the folded tree and to the table."""
    place = f"{table.rstrip('/')}/{FOLDED}/versions"
    numbers = [int(name) for name in files(spark, place) if name.isdigit()]
    if not numbers:
        return {"number": 0, "periods": {}}
    return json.loads(read_text(spark, f"{place}/{max(numbers)}"))


def publish_folded(spark: SparkSession, table: str, version: dict) -> None:
    place = f"{table.rstrip('/')}/{FOLDED}/versions"
    make(spark, place)
    publish_text(spark, f"{place}/{version['number']}", json.dumps(version))
