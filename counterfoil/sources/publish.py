"""Publishing a list so that readers always find a whole one.

Overwriting a folder removes the old list first: a job that dies then leaves nothing. Here every
version is written to a folder of its own, checked, described by a manifest, and becomes the
current one by replacing one small file in a single rename. Until then readers see the version
before; a version that was never finished is never seen, and goes with the next clean-up.

Paths are Hadoop's, so a shared file system or HDFS serves; the rename must replace atomically,
which plain object stores do not offer.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CURRENT, MANIFEST, DATA = "_CURRENT", "_MANIFEST", "data"


class NotPublished(FileNotFoundError):
    """Nothing is published here."""


class BrokenVersion(RuntimeError):
    """A version does not hold what its manifest says."""


@dataclass(frozen=True)
class Manifest:
    version: str
    rows: int
    files: int
    bytes: int
    format: str
    schema: str
    label: str
    time: float


class _Folder:
    """The few file operations needed, through Hadoop."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        given = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = given.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(given).toString().rstrip("/")

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Rename over an existing file, in one step."""
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        array = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        array[0] = options.OVERWRITE
        contexts = self.jvm.org.apache.hadoop.fs.FileContext
        context = contexts.getFileContext(self.fs.getUri(), self.conf)
        context.rename(self.path(source), self.path(target), array)

    def names(self) -> list[str]:
        if not self.exists(""):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(""))]

    def size(self, name: str) -> tuple[int, int]:
        """Data files and their bytes."""
        files = [
            s for s in self.fs.listStatus(self.path(name))
            if not s.getPath().getName().startswith(("_", "."))
        ]
        return len(files), sum(s.getLen() for s in files)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _reader(spark: SparkSession, fmt: str, schema: T.StructType):
    reader = spark.read.schema(schema).format(fmt)
    return reader.option("header", True).option("mode", "FAILFAST") if fmt == "csv" else reader


def publish(
    rows: DataFrame,
    root: str,
    fmt: str = "parquet",
    label: str = "",
    keep: int = 2,
    expected: int | None = None,
) -> Manifest:
    """Write ``rows`` as a new version below ``root`` and make it the current one.

    The written rows are counted by reading them back; if ``expected`` is given and they are not
    as many, or if they cannot be read, the job stops before the switch. Afterwards all but the
    ``keep`` last versions go, as do those that were never finished. One publisher at a time. Rows
    keep the order within a part file.
    """
    if keep < 1:
        raise ValueError("the current version must be kept")
    spark = rows.sparkSession
    folder = _Folder(spark, root)
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{folder.root}/{version}/{DATA}"
    writer = rows.write.option("header", True) if fmt == "csv" else rows.write
    writer.format(fmt).save(path)
    count = _reader(spark, fmt, rows.schema).load(path).count()
    if expected is not None and count != expected:
        raise BrokenVersion(f"{version}: expected {expected} rows, wrote {count}")
    files, size = folder.size(f"{version}/{DATA}")
    schema = rows.schema.json()
    manifest = Manifest(version, count, files, size, fmt, schema, label, time.time())
    folder.write(f"{version}/{MANIFEST}", json.dumps(asdict(manifest)))
    _switch(folder, version)
    clean(spark, root, keep)
    return manifest


def _check(spark: SparkSession, folder: _Folder, manifest: Manifest) -> None:
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    held = _reader(spark, manifest.format, schema).load(f"{folder.root}/{manifest.version}/{DATA}")
    count = held.count()
    if count != manifest.rows:
        raise BrokenVersion(f"{manifest.version}: {manifest.rows} rows were written, {count} found")


def _switch(folder: _Folder, version: str) -> None:
    name = f"_next-{uuid.uuid4().hex}"
    folder.write(name, version)
    folder.replace(name, CURRENT)


def current(spark: SparkSession, root: str) -> Manifest:
    """What is published now."""
    folder = _Folder(spark, root)
    if not folder.exists(CURRENT):
        raise NotPublished(f"nothing is published at {root}")
    return Manifest(**json.loads(folder.read(f"{folder.read(CURRENT)}/{MANIFEST}")))


def versions(spark: SparkSession, root: str) -> list[Manifest]:
    """All finished versions, oldest first."""
    folder = _Folder(spark, root)
    names = sorted(n for n in folder.names() if n.startswith("v-"))
    return [
        Manifest(**json.loads(folder.read(f"{n}/{MANIFEST}")))
        for n in names
        if folder.exists(f"{n}/{MANIFEST}")
    ]


def read_published(
    spark: SparkSession, root: str, version: str | None = None, check: bool = False
) -> DataFrame:
    """The current list, or an older version that is still kept.

    The files must be as many and as large as the manifest says; ``check`` counts the rows too.
    """
    folder = _Folder(spark, root)
    told = current(spark, root)
    if version is not None and version != told.version:
        found = [m for m in versions(spark, root) if m.version == version]
        if not found:
            raise NotPublished(f"no version {version} at {root}")
        (told,) = found
    if folder.size(f"{told.version}/{DATA}") != (told.files, told.bytes):
        raise BrokenVersion(f"{told.version}: files are missing or changed")
    if check:
        _check(spark, folder, told)
    schema = T.StructType.fromJson(json.loads(told.schema))
    return _reader(spark, told.format, schema).load(f"{folder.root}/{told.version}/{DATA}")


def roll_back(spark: SparkSession, root: str, version: str) -> Manifest:
    """Make a kept version the current one again."""
    read_published(spark, root, version, check=True)
    _switch(_Folder(spark, root), version)
    return current(spark, root)


def clean(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete unfinished versions and all but the ``keep`` last; the current one always stays."""
    folder = _Folder(spark, root)
    if not folder.exists(CURRENT):
        return
    now = folder.read(CURRENT)
    finished = [m.version for m in versions(spark, root)]
    kept = {now, *finished[-keep:]}
    for name in folder.names():
        if (name.startswith("v-") and name not in kept) or name.startswith("_next-"):
            folder.delete(name)
