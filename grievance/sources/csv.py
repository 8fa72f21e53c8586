"""CSV complaint extracts: discovery, scan and write."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grievance.session import keep_scans_small

DEFAULT_PATTERN = "*complaints*.csv"

# Suffixes of files whose bytes are a fraction of their text.
COMPRESSED = (".gz", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate")

# File-order columns attached right after the scan, before any shuffle.
FILE_ORDER = ("_src_file", "_src_block", "_src_row")


def _reader(spark: SparkSession, multi_line: bool = True):
    # RFC-4180: quoted fields may hold line breaks and doubled quotes.  Every
    # field stays text; typing happens in the normaliser.  multiLine files are
    # not splittable, so each file is one task: many files give parallelism.
    # ``multi_line=False`` reads each file in byte-range splits (for extracts
    # known to have no quoted line breaks), so one huge file is many tasks.
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
    )


def _discovered(spark: SparkSession, base_path: str, pattern: str, multi_line: bool = True) -> DataFrame:
    try:
        return (
            _reader(spark, multi_line)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .csv(base_path)
        )
    except AnalysisException as exc:
        if exc.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise FileNotFoundError(f"no file matching '{pattern}' under {base_path}") from exc
        raise


def discover_complaint_files(spark: SparkSession, base_path: str, pattern: str = DEFAULT_PATTERN) -> list[str]:
    """All files under ``base_path`` (recursively) whose name matches ``pattern``, sorted.

    Only the file listing reaches the driver; no data is read.
    """
    files = _discovered(spark, base_path, pattern).inputFiles()
    if not files:
        raise FileNotFoundError(f"no file matching '{pattern}' under {base_path}")
    return sorted(files)


def _with_position(df: DataFrame, file: Column | None = None) -> DataFrame:
    return df.select(
        "*",
        (F.col("_metadata.file_path") if file is None else file).alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
        F.monotonically_increasing_id().alias("_src_row"),
    )


def read_complaints_csv(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Scan CSV text with its header names, tagging each row with its file position.

    The position is (file, start of the split within the file, row within the
    split): rows of one split arrive in file order, and splits of a file are
    ordered by their start, so the tuple orders rows as they appear in the file
    whether or not files are split.
    """
    return _with_position(_reader(spark, multi_line).csv(paths))


def scan_complaints(spark: SparkSession, base_path: str, pattern: str = DEFAULT_PATTERN,
                    select: str = "all", multi_line: bool = True) -> DataFrame:
    """Discover then scan every matching file, in the order of their names.

    ``select="single"`` is for feeds that deliver one file: several matches
    are an error, never a choice.  All files are read by the discovery scan.
    Tasks read less at a time where files are compressed (``keep_scans_small``).
    """
    if select not in ("all", "single"):
        raise ValueError(f"select must be 'all' or 'single', not {select!r}")
    found = _discovered(spark, base_path, pattern, multi_line)
    files = sorted(found.inputFiles())
    if not files:
        raise FileNotFoundError(f"no file matching '{pattern}' under {base_path}")
    if select == "single" and len(files) > 1:
        raise ValueError(f"{len(files)} files match '{pattern}' under {base_path}, one was expected: {files[:5]}")
    if any(f.lower().endswith(COMPRESSED) for f in files):
        keep_scans_small(spark)
    # In one folder the names alone are in the order of the paths: the rows carry no folder.
    one_folder = len({f.rpartition("/")[0] for f in files}) == 1
    return _with_position(found, F.substring_index("_metadata.file_path", "/", -1) if one_folder else None)


def write_complaints_csv(df: DataFrame, path: str, records_per_file: int = 0, compression: str = "none") -> None:
    """Write text columns as header CSV (quoted where needed).

    A file is read back by one task: ``records_per_file`` begins another file
    after so many records, whatever a task of the write holds (0: never).
    Compressed files have the codec's suffix behind ``.csv``.
    """
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", compression)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        # Keep padding: the writer strips surrounding blanks by default.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
