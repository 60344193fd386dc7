"""Create-if-absent files on Spark's own file systems: commit records of runs
and versions of published tables.

A file that must not exist before it is created decides who was first; that
is one call on every file system Spark writes to that has such a create
(HDFS and local ones; object stores with conditional writes). The files hold a
few lines of JSON and are the only things that the driver reads or writes.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.session import delete_path
from sluice.sources.csv import CSV_OPTIONS, READ_OPTIONS


class PublishConflict(RuntimeError):
    """Another publisher committed the version that this one was to be."""


class Files:
    """The few file system calls that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """Files and folders directly under ``folder``, sorted."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def create(self, name: str, content: dict, replace: bool = False) -> bool:
        """Write ``content`` to a file; False if it must be new and is not."""
        try:
            out = self._fs.create(self._path(name), replace)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        return True

    def read(self, name: str) -> dict | None:
        """The content of a file; None if there is none, or none yet."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._path(name))
        try:
            line = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        return json.loads(line) if line and line.endswith("}") else None

    def age(self, name: str, now: float) -> float:
        """Seconds since a file or folder was last written."""
        return now - self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        delete_path(self.spark, f"{self.root}/{name}")


# --- runs that can be repeated -------------------------------------------------

class RunLedger:
    """One commit record per sink of a run, under ``<output>/_ledger``.

    ``sink(name, action)`` runs an action only if this run has not committed
    the sink before, and then commits it. An action that fails leaves no
    record, so calling the run again with the same batch id repeats that sink
    and skips those before it; an action must therefore replace what an
    earlier attempt of itself left. ``finish`` closes the run. A batch id is
    one run: two drivers must not work on it at a time.
    """

    def __init__(self, spark: SparkSession, output_dir: str, batch_id: str):
        self.files, self.batch_id = Files(spark, f"{output_dir.rstrip('/')}/_ledger"), str(batch_id)
        self.files.create(f"{self.batch_id}/started", {"batch_id": self.batch_id, "at": time.time()})

    @staticmethod
    def unfinished(spark: SparkSession, output_dir: str) -> str | None:
        """The batch id of the latest run that was started and not finished."""
        files = Files(spark, f"{output_dir.rstrip('/')}/_ledger")
        open_runs = [b for b in files.names("") if files.read(f"{b}/finished") is None]
        return open_runs[-1] if open_runs else None

    @staticmethod
    def started(spark: SparkSession, output_dir: str, batch_id: str) -> dict | None:
        return Files(spark, f"{output_dir.rstrip('/')}/_ledger").read(f"{batch_id}/started")

    @staticmethod
    def holds_other(spark: SparkSession, output_dir: str, batch_id: str) -> bool:
        """Whether the directory has the ledger of another batch id."""
        return any(b != str(batch_id) for b in Files(spark, f"{output_dir.rstrip('/')}/_ledger").names(""))

    def committed(self, sink: str) -> dict | None:
        return self.files.read(f"{self.batch_id}/{sink}")

    def sink(self, name: str, action: Callable[[], dict | None]) -> dict:
        """The sink's record: of an earlier attempt, or of ``action`` run now."""
        record = self.committed(name)
        if record is None:
            record = {"at": time.time(), **(action() or {})}
            self.files.create(f"{self.batch_id}/{name}", record, replace=True)
        return record

    def finish(self) -> None:
        self.files.create(f"{self.batch_id}/finished", {"at": time.time()}, replace=True)


_WRITER = "_writer"


def hold_table(spark: SparkSession, root: str, by: str) -> None:
    """Claim the table at ``root`` for writer ``by`` until ``release_table``.

    For writes in place of several steps: a second writer is refused
    (``PublishConflict``) while the first is between steps, even if it died
    there; called again, the first finds its own claim and goes on. A claim
    that will never be taken up again is the file ``_writer`` of the table.
    """
    files = Files(spark, root)
    if not files.create(_WRITER, {"by": by}):
        holder = held_by(spark, root)
        if holder != by:
            raise PublishConflict(f"{root} is being written by {holder}")


def held_by(spark: SparkSession, root: str) -> str | None:
    """The writer that holds the table at ``root``."""
    return (Files(spark, root).read(_WRITER) or {}).get("by")


def release_table(spark: SparkSession, root: str) -> None:
    Files(spark, root).delete(_WRITER)


# --- tables published under one name --------------------------------------------

VERSIONS = "_versions"
#: Seconds after which an empty version file is that of a publisher that died.
ABANDONED = 60.0


def _name(version: int) -> str:
    return f"{VERSIONS}/{version:012d}"


def _versions(files: Files) -> dict[int, dict]:
    """Records of the committed versions, oldest first."""
    found = {int(n): files.read(f"{VERSIONS}/{n}") for n in files.names(VERSIONS) if n.isdigit()}
    return {v: record for v, record in found.items() if record is not None}


def current_version(spark: SparkSession, root: str) -> int:
    """The latest version of a published table; 0 if there is none."""
    return max(_versions(Files(spark, root)), default=0)


def _commit(files: Files, record: dict, based_on: int) -> int | None:
    """The number under which ``record`` became the current version, or None."""
    numbers = [int(n) for n in files.names(VERSIONS) if n.isdigit()]
    for later in (n for n in numbers if n > based_on):
        if files.read(_name(later)) is not None or files.age(_name(later), time.time()) < ABANDONED:
            return None
    version = max([based_on, *numbers]) + 1
    return version if files.create(_name(version), record) else None


def publish_version(
    df: DataFrame,
    root: str,
    fmt: str = "parquet",
    based_on: int | None = None,
    write: Callable[[DataFrame, str], None] | None = None,
    by: str | None = None,
    extra: dict | None = None,
) -> int:
    """Publish ``df`` as the next version of the table under ``root``.

    The rows go to a folder of their own; then one create-if-absent file makes
    it the current version. Readers see the version before or this one, never
    a gap or a mixture, and one that holds an older version goes on reading
    it. ``based_on`` is the version the caller started from (by default the
    current one when this is called): if another publisher has committed a
    later one by then, nothing is published and ``PublishConflict`` is raised.
    ``write(df, folder)`` replaces the plain write, e.g. by ``publish`` with
    its options. ``by`` names the publisher in the version's record, which also keeps ``extra``.
    """
    spark = df.sparkSession
    files = Files(spark, root)
    based_on = current_version(spark, root) if based_on is None else based_on
    folder = f"data/{uuid.uuid4().hex}"
    if write is None:
        df.write.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).save(f"{files.root}/{folder}")
    else:
        write(df, f"{files.root}/{folder}")
    record = {"folder": folder, "format": fmt, "schema": df.schema.json(), "at": time.time(), "by": by, **(extra or {})}
    version = _commit(files, record, based_on)
    if version is None:
        files.delete(folder)
        raise PublishConflict(f"{root} has a version later than {based_on}")
    return version


def published_by(spark: SparkSession, root: str, by: str, after: int = 0) -> int | None:
    """The first version later than ``after`` that publisher ``by`` committed."""
    return next((v for v, r in _versions(Files(spark, root)).items() if v > after and r["by"] == by), None)


def version_record(spark: SparkSession, root: str, version: int) -> dict:
    """What was committed with a version: ``location``, ``format``, ``schema``,
    the time ``at``, the publisher ``by`` and the ``extra`` of its publisher."""
    files = Files(spark, root)
    record = files.read(_name(version))
    if record is None:
        raise FileNotFoundError(f"{root} has no version {version}")
    schema = StructType.fromJson(json.loads(record["schema"]))
    return record | {"schema": schema, "location": f"{files.root}/{record['folder']}"}


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table under ``root`` as of ``version`` (by default the current one)."""
    record = version_record(spark, root, current_version(spark, root) if version is None else version)
    reader = spark.read.format(record["format"]).schema(record["schema"])
    if record["format"] == "csv":
        reader = reader.options(**READ_OPTIONS)
    return reader.load(record["location"])


def expire_versions(spark: SparkSession, root: str, keep_seconds: float, now: float | None = None) -> list[int]:
    """Delete versions that were replaced more than ``keep_seconds`` ago, and
    folders that old which no version names (of publishers that failed).

    The current version stays, however old. Returns the versions deleted.
    """
    files, now = Files(spark, root), time.time() if now is None else now
    records = _versions(files)
    order = list(records)
    gone = [v for v, later in zip(order, order[1:]) if records[later]["at"] < now - keep_seconds]
    for v in gone:
        files.delete(_name(v))
        files.delete(records[v]["folder"])
    named = {r["folder"] for v, r in records.items() if v not in gone}
    for folder in (f"data/{n}" for n in files.names("data")):
        if folder not in named and files.age(folder, now) > keep_seconds:
            files.delete(folder)
    return gone
