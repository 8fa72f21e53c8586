"""Tables in versions: a write never touches what readers see, and one small file switches them.

A table is a folder.  Every write goes to data folders of its own,
``<part column>=<value>/version=<token>`` (or ``version=<token>`` without
parts), and is published by one file in ``_versions`` that names, for every
part, the folder that holds it now.  A reader takes the newest such file once
and reads exactly those folders, so it sees one version whole, whatever is
written meanwhile.  A write of some parts (a daily upsert) names the old
folders for all others: they are neither read nor copied.

The files of ``_versions`` are numbered and created without overwriting, so of
two writers that start from one version the second fails instead of undoing the
first.  What no kept version names is removed by ``expire``.  The list of
parts is all that the driver holds: choose parts so that there are thousands of
them, not millions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grievance.session import shared_path

#: Partition column that tells the writes of a part apart.
VERSION = "version"
_FOLDER = "_versions"
#: Tells the rows of an increment from those of the table while they are merged.
_INCOMING = "_incoming"
#: The names of the only part of a table without parts, and of the part of rows without a value.
WHOLE, NO_VALUE = "", "__HIVE_DEFAULT_PARTITION__"


def _name(value: object) -> str:
    return NO_VALUE if value is None else str(value)


def read_json(spark: SparkSession, path: str):
    """The content of a small file; ``None`` where there is none, or one that was not written to its end."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(source) or not fs.getFileStatus(source).getLen():
        return None
    stream = fs.open(source)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def write_json(spark: SparkSession, path: str, content, overwrite: bool) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, overwrite)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()


class ConcurrentWrite(RuntimeError):
    """Another writer published the next version first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    part: str | None = None  # part column
    parts: dict[str, str] = field(default_factory=dict)  # part value -> token
    note: dict = field(default_factory=dict)  # what the writer wants to know again


class VersionedTable:
    """A table at ``path``, in parts by the column ``part`` (a string, integer or date column of the table) or whole."""

    def __init__(self, spark: SparkSession, path: str, part: str | None = None):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self._conf = sc._jsc.hadoopConfiguration()

    # --- files ----------------------------------------------------------

    def _fs(self):
        return self._path(self.path).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.path}/{_FOLDER}")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> Version | None:
        """The version of that number; ``None`` while its file is being written, or if the writer was lost in that."""
        read = read_json(self.spark, f"{self.path}/{_FOLDER}/{number:010d}.json")
        return None if read is None else Version(**read)

    def versions(self) -> list[Version]:
        """All published versions, oldest first."""
        return [v for v in map(self._load, self._numbers()) if v is not None]

    def current(self) -> Version | None:
        for number in reversed(self._numbers()):
            if (found := self._load(number)) is not None:
                return found
        return None

    def _publish(self, base: Version | None, schema: T.StructType, parts: dict[str, str], note: dict) -> Version:
        newest = self.current()
        if (newest.number if newest else 0) != (base.number if base else 0):
            raise ConcurrentWrite(f"{self.path} was written meanwhile (version {newest.number if newest else 0})")
        made = Version(max([0, *self._numbers()]) + 1, schema.json(), self.part, parts, note)
        try:
            write_json(self.spark, f"{self.path}/{_FOLDER}/{made.number:010d}.json", asdict(made), overwrite=False)
        except Py4JJavaError as e:
            raise ConcurrentWrite(f"version {made.number} of {self.path} exists") from e
        return made

    def _folder(self, part: str | None, value: str, token: str) -> str:
        return f"{self.path}/{VERSION}={token}" if part is None else f"{self.path}/{part}={value}/{VERSION}={token}"

    def folders(self, version: Version | None = None) -> dict[str, str]:
        """The folder of every part."""
        version = version or self.current()
        return {v: self._folder(version.part, v, t) for v, t in version.parts.items()} if version else {}

    # --- reading --------------------------------------------------------

    def read(self, version: Version | None = None, parts: Iterable[object] | None = None) -> DataFrame:
        """One version (default: the newest), or only some of its parts."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        folders = self.folders(version)
        wanted = list(folders.values()) if parts is None else [folders[v] for v in sorted(map(_name, set(parts))) if v in folders]
        schema = T.StructType.fromJson(json.loads(version.schema))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        with_version = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        return self.spark.read.schema(with_version).option("basePath", self.path).parquet(*wanted).select(*schema.names)

    def files(self, version: Version | None = None) -> dict[str, list[str]]:
        """The data files of every part."""
        out = {}
        for value, folder in self.folders(version).items():
            names = [s.getPath().getName() for s in self._fs().listStatus(self._path(folder))]
            out[value] = sorted(f"{folder}/{n}" for n in names if n.endswith(".parquet"))
        return out

    # --- writing --------------------------------------------------------

    def _written(self, df: DataFrame, sort: Sequence[str], watch: Callable[[DataFrame], DataFrame] | None = None) -> tuple[T.StructType, dict[str, str]]:
        """Write ``df`` under a new token; its schema and parts."""
        if VERSION in df.columns:
            raise ValueError(f"the column name {VERSION!r} is taken")
        token = uuid.uuid4().hex
        columns = [VERSION] if self.part is None else [self.part, VERSION]
        if sort:  # neighbours in the order of the parts share a task, so a part is few files and a hot part many tasks
            df = df.repartitionByRange(*sort)
        if self.part is not None:
            df = df.sortWithinPartitions(self.part, *[c for c in sort if c != self.part])
        names = [c for c in df.columns if c != self.part] + ([] if self.part is None else [self.part])
        df = df.select(*names)
        if watch:  # behind the sort: a range partitioning reads its input twice
            df = watch(df)
        df.withColumn(VERSION, F.lit(token)).write.mode("append").partitionBy(*columns).parquet(self.path)
        if self.part is None:
            there = self._fs().exists(self._path(self._folder(None, WHOLE, token)))
            return df.schema, {WHOLE: token} if there else {}
        found = self._fs().globStatus(self._path(f"{self.path}/{self.part}=*/{VERSION}={token}"))
        values = [unquote(s.getPath().getParent().getName().split("=", 1)[1]) for s in found or []]
        return df.schema, dict.fromkeys(sorted(values), token)

    def replace(self, df: DataFrame, sort: Sequence[str] = (), note: dict | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> Version:
        """All rows anew, in the order of ``sort`` in files and parts; ``df`` may read the version that it replaces.

        ``watch`` is applied to the rows as they are written (see ``operators.metrics``).
        """
        base = self.current()
        schema, parts = self._written(df, sort, watch)
        return self._publish(base, schema, parts, note or {})

    def replace_parts(self, df: DataFrame, values: Iterable[object], sort: Sequence[str] = (), base: Version | None = None,
                      watch: Callable[[DataFrame], DataFrame] | None = None) -> Version:
        """The rows of the parts ``values`` anew (``df`` has rows of these parts only); all other parts stay as they are.

        ``watch`` is applied to the rows where they lie by ``sort``.
        """
        base = base or self.current()
        if base and base.part != self.part:
            raise ValueError(f"{self.path} is kept in parts by {base.part!r}")
        schema, written = self._written(df, sort, watch)
        touched = {_name(v) for v in values}
        if not set(written) <= touched:
            raise ValueError(f"rows of other parts: {sorted(set(written) - touched)[:5]}")
        return self._publish(base, schema, {k: t for k, t in (base.parts if base else {}).items() if k not in touched} | written, base.note if base else {})

    def expire(self, keep: int = 2) -> int:
        """Forget all but the ``keep`` newest versions and delete the folders that none of these names; how many went.

        Readers of a forgotten version fail; writes that are not published yet must not run meanwhile.
        """
        numbers = self._numbers()
        kept = [v for n in numbers[-keep:] if (v := self._load(n))]
        named = {self._path(f).toUri().getPath() for v in kept for f in self.folders(v).values()}
        for n in numbers[:-keep]:
            self._fs().delete(self._path(f"{self.path}/{_FOLDER}/{n:010d}.json"), False)
        gone = 0
        for pattern in (f"{VERSION}=*", f"*=*/{VERSION}=*"):
            for s in self._fs().globStatus(self._path(f"{self.path}/{pattern}")) or []:
                if s.getPath().toUri().getPath() not in named:
                    self._fs().delete(s.getPath(), True)
                    gone += 1
        return gone


# --- parts of ids, and the merge that touches only some -----------------------

#: The part column of a table of complaints, and ids in one part: new and lately changed complaints share few.
ID_PART, ID_WIDTH = "id_range", 1_000_000


def id_range(key: str = "complaint_id", width: int = ID_WIDTH) -> Column:
    """The part of an id: ids are given in order of arrival, so a day's records touch few parts."""
    return F.floor(F.col(key) / F.lit(width)).cast("bigint")


def with_id_range(df: DataFrame, key: str = "complaint_id", width: int = ID_WIDTH) -> DataFrame:
    return df.withColumn(ID_PART, id_range(key, width))


def kept_width(table: VersionedTable, width: int | None) -> int | None:
    """The width of the id parts that the table has, which ``width`` must not contradict; else ``width``."""
    version = table.current()
    kept = version.note.get("id_width") if version else None
    if kept and width not in (None, kept):
        raise ValueError(f"{table.path} is kept in parts of {kept} ids, not {width}; a full refresh can change that")
    return kept or width


def merge_increment(table: VersionedTable, increment: DataFrame, key: str = "complaint_id") -> Version:
    """Upsert ``increment`` (one row per key, with the part column) into the parts that it has rows of.

    Only these parts are read and written again; of the others not even a file
    is listed.  The key must decide the part, so that a row never moves.  Old
    and new rows are dealt out once, in the order of parts and keys, and the
    replaced ones are dropped where both then lie together (as ``merge_upsert``
    drops them: rows without a key replace nothing).
    """
    spark = increment.sparkSession
    base = table.current()
    path = shared_path(spark, "increment")
    increment.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(increment.schema).parquet(path)
    touched = [r[0] for r in rows.select(table.part).distinct().collect()]  # at most as many as the table has parts
    if base is None:
        return table.replace_parts(rows, touched, sort=(table.part, key))
    old = table.read(base, touched).withColumn(_INCOMING, F.lit(False))
    both = old.unionByName(rows.withColumn(_INCOMING, F.lit(True)), allowMissingColumns=True)

    def kept(df: DataFrame) -> DataFrame:
        replaced = F.max(_INCOMING).over(Window.partitionBy(table.part, key)) & F.col(key).isNotNull()
        return df.withColumn("_replaced", replaced).filter(F.col(_INCOMING) | ~F.col("_replaced")).drop(_INCOMING, "_replaced")

    return table.replace_parts(both, touched, sort=(table.part, key), base=base, watch=kept)
