"""Several tables published at once, so that a reader sees all of them in one version or none.

Each version's tables are written to a folder of their own. Only when all are there, a small
manifest that names them is put in place by a rename, which no two writers can win with the
same number. Readers follow the newest manifest; what a failed export left is never named.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .files import read_auto, write_auto

_MANIFESTS, _NAME = "_versions", re.compile(r"(\d{8})\.json")


def _fs(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, directory: str) -> list[int]:
    """The published versions, oldest first."""
    fs, at = _fs(spark, f"{directory.rstrip('/')}/{_MANIFESTS}")
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)


def publish(tables: dict[str, DataFrame], directory: str, fmt: str = "parquet") -> int:
    """Writes the tables and publishes them together; the number of the new version.

    If a table can't be written, nothing is published and the error goes on. If another
    writer publishes at the same time, one of the two gets a `FileExistsError`.
    """
    spark, directory = SparkSession.active(), directory.rstrip("/")
    folder, suffix = f"data-{uuid.uuid4().hex}", ".csv" if fmt == "csv" else ""
    known = versions(spark, directory)
    entries = {}
    for name, df in tables.items():
        entries[name] = {"path": f"{folder}/{name}{suffix}", "schema": json.loads(df.schema.json())}
        write_auto(df, f"{directory}/{entries[name]['path']}")
    version = known[-1] + 1 if known else 1
    fs, aside = _fs(spark, f"{directory}/{folder}/manifest.json")
    with_manifest = fs.create(aside, False)
    with_manifest.write(bytearray(json.dumps({"version": version, "tables": entries}).encode()))
    with_manifest.close()
    _, place = _fs(spark, f"{directory}/{_MANIFESTS}/{version:08}.json")
    fs.mkdirs(place.getParent())
    if fs.exists(place) or not fs.rename(aside, place):
        raise FileExistsError(f"version {version} of {directory} has been published by another writer")
    return version


def read_bundle(spark: SparkSession, directory: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the newest if none is named, all of the same export."""
    directory = directory.rstrip("/")
    known = versions(spark, directory)
    if not known or version not in (None, *known):
        raise FileNotFoundError(f"{directory} has no published version" + (f" {version}" if version else ""))
    at = f"{directory}/{_MANIFESTS}/{version or known[-1]:08}.json"
    entries = json.loads(spark.read.text(at, wholetext=True).first()["value"])["tables"]
    return {n: read_auto(spark, f"{directory}/{e['path']}", StructType.fromJson(e["schema"])) for n, e in entries.items()}
