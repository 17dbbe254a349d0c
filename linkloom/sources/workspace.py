"""Run folders for tables that cut lineage, below the shared checkpoint folder."""

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession

_open_scopes: ContextVar[tuple["Scope", ...]] = ContextVar("linkloom_scopes", default=())

# Digits of a mark's number; marks sort by name.
MARK_DIGITS = 9
MARKS = "_marks"


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediate tables.

    ``spark.checkpoint.dir`` decides, then a folder set on the context. Only a
    local session without either gets a temporary folder: on a cluster that
    would be one machine's disk, lost together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    from_context = spark.sparkContext.getCheckpointDir()
    if from_context:
        return from_context
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="linkloom-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


class Scope:
    """Owns the workspaces that are opened while it is the innermost scope."""

    def __init__(self):
        self.owned: list[Workspace] = []

    def close(self) -> None:
        """Drop every owned run folder; results that read them cannot be read any more."""
        while self.owned:
            self.owned.pop().drop()


@contextmanager
def scope() -> Iterator[Scope]:
    """Free the stored tables of all results made within, at the end or on failure.

    Lazy results read tables of their run folders, so use or write them within. Scopes nest; a named run
    is not owned by a scope, as it is there to outlive a failure.
    """
    own = Scope()
    token = _open_scopes.set((*_open_scopes.get(), own))
    try:
        yield own
    finally:
        _open_scopes.reset(token)
        own.close()


class MarkLog:
    """Numbered marks in a folder: what they name is complete, and the highest one counts.

    A mark is a small file that gets its name by a rename once it is written, so it is there whole or not at
    all, and a number is given once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/{MARKS}"

    def numbers(self) -> list[int]:
        path, files = _path(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict:
        return json.loads(self.spark.read.text(self._file(number), wholetext=True).first()[0])

    def last(self) -> tuple[int, dict] | None:
        """The highest mark and its number."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def add(self, state: dict) -> int:
        """Add the next mark. Fails if another writer has just taken its number."""
        number = max(self.numbers(), default=-1) + 1
        draft, files = _path(self.spark, f"{self.folder}/_draft-{uuid.uuid4().hex}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        path, _ = _path(self.spark, self._file(number))
        if files.exists(path) or not files.rename(draft, path):
            files.delete(draft, False)
            raise RuntimeError(f"mark {number} in {self.folder} was taken by another writer")
        return number

    def forget(self, number: int) -> None:
        path, files = _path(self.spark, self._file(number))
        files.delete(path, False)

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:0{MARK_DIGITS}d}"


class Workspace:
    """Parquet tables of one run, in a folder of its own.

    Without ``run_id`` the folder is new and belongs to the innermost ``scope``, if there is one. A named run
    is found again under its name: ``mark`` notes the tables that are complete, and ``recover`` goes
    back to the last mark. Only one driver at a time may work on a name.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, run_id: str | None = None):
        if run_id is not None and not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run_id):
            raise ValueError(f"run id {run_id!r}: use letters, digits, '_', '.' and '-'")
        self.spark = spark
        self.named = run_id is not None
        self.run = f"run-{run_id or uuid.uuid4().hex}"
        self.folder = f"{(root or checkpoint_root(spark)).rstrip('/')}/{self.run}"
        self._log = MarkLog(spark, self.folder)
        self._bucketed: dict[str, str] = {}
        scopes = _open_scopes.get()
        if scopes and not self.named:
            scopes[-1].owned.append(self)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(
        self, frame: DataFrame, name: str, partition_by: str | None = None, **metrics
    ) -> tuple[DataFrame, dict]:
        """Write ``frame`` as a table and return it re-read, plus its metrics.

        The re-read frame has no lineage behind the files, so a lost executor
        costs only the tasks that ran there. ``metrics`` are aggregate columns
        gathered while the rows pass into the files, without a second job.
        ``partition_by`` puts rows that differ in this column into folders of their own.
        """
        schema = frame.schema
        observed = Observation() if metrics else None
        if observed:
            frame = frame.observe(observed, *(col.alias(key) for key, col in metrics.items()))
        writer = frame.write.partitionBy(partition_by) if partition_by else frame.write
        writer.parquet(self.path(name))
        stored = self.spark.read.schema(schema).parquet(self.path(name))
        return stored, dict(observed.get) if observed else {}

    def table(self, schema, *names: str) -> DataFrame:
        """Stored tables of one schema, read as one."""
        return self.spark.read.schema(schema).parquet(*map(self.path, names))

    def store_bucketed(self, frame: DataFrame, name: str, *keys: str) -> DataFrame:
        """Write ``frame`` hashed into buckets by ``keys``, sorted by them, and return it as a table.

        Joins on the keys take the buckets as they are, and filters on a single key read its buckets only. The catalog
        entry, unlike the files of ``store``, must stay until the last read; ``drop`` removes both.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._bucketed[name] = self._entry(name)
        (
            frame.repartition(buckets, *keys)
            .write.format("parquet")
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
            .option("path", self.path(name))
            .saveAsTable(self._entry(name))
        )
        return self.spark.table(self._entry(name))

    def reopen_bucketed(self, name: str, schema: str, buckets: int, *keys: str) -> DataFrame:
        """The table that ``store_bucketed`` wrote, in a session that may not know it."""
        entry, by = self._entry(name), ", ".join(keys)
        if name in self._bucketed:
            return self.spark.table(entry)
        self._bucketed[name] = entry
        self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        self.spark.sql(
            f"CREATE TABLE {entry} ({schema}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS "
            f"LOCATION '{self.path(name)}'"
        )
        return self.spark.table(entry)

    def mark(self, state: dict) -> None:
        """In a named run, note ``state`` with the names of the ``tables`` it needs; all others go."""
        if self.named:
            self._log.add(state)
        self.keep(state["tables"])

    def recover(self) -> dict | None:
        """The state of the last mark of a named run. Tables that it does not name go: they may be half-written."""
        found = self._log.last() if self.named else None
        self.keep(found[1]["tables"] if found else [])
        return found[1] if found else None

    def keep(self, tables: list[str]) -> None:
        """Drop all tables but these; ``a/b`` keeps of table ``a`` its part ``b``."""
        path, files = _path(self.spark, self.folder)
        if not files.exists(path):
            return
        parts = [t.split("/", 1) for t in tables]
        for status in files.listStatus(path):
            name = status.getPath().getName()
            inner = [p[1] for p in parts if p[0] == name and len(p) == 2]
            if name == MARKS or [name] in parts:
                continue
            if not inner:
                self.drop(name)
                continue
            for part in files.listStatus(status.getPath()):
                if part.isDirectory() and part.getPath().getName() not in inner:
                    files.delete(part.getPath(), True)

    def release(self) -> None:
        """After a failure: a named run keeps its folder for the next try, any other goes."""
        if not self.named:
            self.drop()

    def drop(self, *names: str) -> None:
        """Delete tables of this run, or without names the whole run folder."""
        for name in names or tuple(self._bucketed):
            if name in self._bucketed:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed.pop(name)}")
        for target in map(self.path, names) if names else [self.folder]:
            path, files = _path(self.spark, target)
            files.delete(path, True)

    def _entry(self, name: str) -> str:
        return re.sub(r"\W", "_", f"{self.run}_{name}")


def exists(spark: SparkSession, target: str) -> bool:
    """Whether there is a file or folder of this name."""
    path, files = _path(spark, target)
    return files.exists(path)


def delete(spark: SparkSession, target: str) -> None:
    """Delete a file or folder, if it is there."""
    path, files = _path(spark, target)
    files.delete(path, True)


def _path(spark: SparkSession, target: str):
    """A path and its file system. Spark has no public call for either."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
