"""Where datasets lie, and the few file-system calls Spark has no DataFrame API for."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from eclusa.errors import IngestionError

# Folders of a stream's micro-batches are named after this column, and their values are the
# batch's number and the query's id, which no value of a user's own column is like.
BATCH_COLUMN = "lote"
_BATCH_FOLDER = re.compile(BATCH_COLUMN + r"=[0-9]+-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
# Files of table formats that plain files must not be written over, and their formats.
TABLE_LOGS = {"_delta_log": "delta", ".hoodie": "hudi", "metadata/version-hint.text": "iceberg"}


def uri(bucket: str, path: str, scheme: str = "s3") -> str:
    """Location of a control row's bucket and path. A bucket may name its own scheme."""
    if "://" in bucket:
        return f"{bucket}/{path}"
    return f"{scheme}://{bucket}/{path}"


def workspace(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A session on one machine that has none gets a folder in its warehouse; on a cluster that
    may be a folder of the driver's machine alone, so there the setting must be made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise IngestionError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.eclusa"
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the workspace that nobody has used yet."""
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


class Files:
    """Hadoop file system of one location, reached through the running session."""

    def __init__(self, spark: SparkSession, location: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(location).getFileSystem(conf)

    def qualified(self, location: str) -> str:
        return self._path(location).makeQualified(
            self._fs.getUri(), self._fs.getWorkingDirectory()
        ).toString()

    def exists(self, location: str) -> bool:
        return self._fs.exists(self._path(location))

    def first_entry(self, location: str) -> str | None:
        """Name of some visible file or folder at the location, or None."""
        if not self.exists(location):
            return None
        entries = self._fs.listStatusIterator(self._path(location))
        while entries.hasNext():
            name = entries.next().getPath().getName()
            if not name.startswith(("_", ".")):
                return name
        return None

    def names(self, location: str, start: str) -> list[str]:
        """Names in the folder that begin with ``start``, which may be hidden ones."""
        found = self._fs.globStatus(self._path(f"{location}/{start}*")) or []
        return sorted(f.getPath().getName() for f in found)

    def below(self, location: str) -> list[tuple[str, str]]:
        """Folder, relative to the location, and name of each visible file in it or below."""
        found, waiting = [], [""]
        while waiting:
            folder = waiting.pop()
            for entry in self._fs.listStatus(self._path(f"{location}/{folder}" if folder else location)):
                name = entry.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if entry.isDirectory():
                    waiting.append(f"{folder}/{name}" if folder else name)
                else:
                    found.append((folder, name))
        return found

    def folders(self, location: str, depth: int) -> list[str]:
        """Partition folders so many levels below the location, relative to it."""
        found = [""]
        for _ in range(depth):
            found = [
                f"{folder}/{entry.getPath().getName()}".lstrip("/")
                for folder in found
                for entry in self._fs.listStatus(self._path(f"{location}/{folder}" if folder else location))
                if entry.isDirectory() and "=" in entry.getPath().getName()
            ]
        return found

    def remove_empty(self, location: str, folder: str) -> None:
        """Remove the folders around ``folder``, below the location, that hold nothing."""
        while "/" in folder:
            folder = folder.rpartition("/")[0]
            place = self._path(f"{location}/{folder}")
            if not self._fs.exists(place) or len(self._fs.listStatus(place)):
                return
            self._fs.delete(place, False)

    def make_folder(self, location: str) -> None:
        self._fs.mkdirs(self._path(location))

    def touch(self, location: str) -> None:
        self._fs.create(self._path(location), True).close()

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._path(old), self._path(new))

    def remove(self, location: str) -> None:
        self._fs.delete(self._path(location), True)


def owned_by_stream(spark: SparkSession, location: str) -> str | None:
    """Which kind of stream wrote the dataset: one with a file ``log``, one in ``batches``, or None.

    Readers of a log see only the files it names; folders of batches cannot lie
    beside other files.
    """
    files = Files(spark, location)
    if files.exists(f"{location}/_spark_metadata"):
        return "log"
    return "batches" if _BATCH_FOLDER.fullmatch(files.first_entry(location) or "") else None


def folder_columns(spark: SparkSession, location: str) -> list[str]:
    """Partition columns that the dataset's folders show, outermost first."""
    files, found = Files(spark, location), []
    while (name := files.first_entry(location)) and "=" in name and not name.startswith("part-"):
        found.append(unquote(name.split("=", 1)[0]))
        location = f"{location}/{name}"
    return found


def table_format(spark: SparkSession, location: str) -> str | None:
    """Format of the table that lies at the location, if its log is there."""
    files = Files(spark, location)
    for log, fmt in TABLE_LOGS.items():
        if files.exists(f"{location}/{log}"):
            return fmt
    return None


def segments(location: str) -> list[str]:
    """Path parts of a qualified location."""
    return [part for part in urlparse(location).path.split("/") if part]


def overlaps(spark: SparkSession, one: str, other: str) -> bool:
    """True if the locations are equal or one lies inside the other."""
    a, b = Files(spark, one).qualified(one), Files(spark, other).qualified(other)
    if urlparse(a)[:2] != urlparse(b)[:2]:
        return False
    a, b = segments(a), segments(b)
    short = min(len(a), len(b))
    return a[:short] == b[:short]
