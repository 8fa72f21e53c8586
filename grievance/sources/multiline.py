"""CSV files with quoted line breaks, read in byte-range splits, and the rows that cannot be loaded.

A reader that takes a file whole needs one task per file.  Here every file is
read as physical lines in splits (any number of tasks per file), and the
question whether a line begins a record is answered by a parallel prefix
computation:

1. A line maps the reader's state before it (outside or inside a quoted field)
   to the state behind it.  It keeps the state, swaps it, or leads to one state
   whatever came before.  Such maps are composed per split; only one small code
   per line with a quote leaves the scan.
2. The splits' maps are composed along each file (one row per split), which
   gives the state in which every split begins.
3. The lines are read again.  Knowing its first state, each split joins its
   lines into records by itself.  Only what crosses a border between splits -
   at most two pieces each - is shuffled and put together.

The records are parsed by Spark's own CSV expression with the same options as
the whole-file reader, each file by its own header.  Every record is either
loaded or rejected with its file, position and reason; what was loaded with a
loss (an unreadable date, missing fields) is listed too.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grievance.functions.expressions import lenient_bigint, lenient_date, null_if_na_token
from grievance.operators.raw import normalise
from grievance.schemas import COLUMN_MAPPING, RAW_DATE_COLUMNS
from grievance.session import shared_path
from grievance.sources.csv import DEFAULT_PATTERN, FILE_ORDER

#: What a line does to the state (False: outside quotes): keeps it, swaps it, ends outside, ends inside.
KEEPS, SWAPS, ENDS_OUTSIDE, ENDS_INSIDE = 0, 1, 2, 3
#: Splits whose places and first states are broadcast (21 bytes each); more need a larger spark.sql.files.maxPartitionBytes.
MAX_SPLITS = 2_000_000
#: Different headers among the files of one load.
MAX_HEADERS = 100

# A field is quoted (then up to the next comma whatever follows its closing quote) or starts with another
# character and ends at the next comma: there a quote is an ordinary character.  Possessive: no backtracking.
_QUOTED = '"(?:[^"]++|"")*+"[^,]*+'
_FIELDS = f'(?:(?:{_QUOTED}|[^",][^,]*+|),)*+'
_OPEN = '"(?:[^"]++|"")*+'
#: Lines that end inside quotes, if they begin outside, and if they begin inside.
ENDS_INSIDE_FROM_OUTSIDE = rf"^{_FIELDS}{_OPEN}\z"
ENDS_INSIDE_FROM_INSIDE = rf'^(?:[^"]++|"")*+(?:"[^,]*+,{_FIELDS}{_OPEN})?\z'

CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def _lines(spark: SparkSession, base_path: str, pattern: str) -> DataFrame:
    """``file, block, row, line``: physical lines in splits; ``row`` grows along a split."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "\n").text(base_path)
    if not found.inputFiles():
        raise FileNotFoundError(f"no file matching '{pattern}' under {base_path}")
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )


def line_effect(line: Column) -> Column:
    """What a line does to the reader's state (see the codes above)."""
    bare = F.rtrim(line, F.lit("\r"))
    inside_2 = bare.rlike(ENDS_INSIDE_FROM_INSIDE)
    # Nested, so that no line is matched twice with one pattern.
    code = F.when(bare.rlike(ENDS_INSIDE_FROM_OUTSIDE), F.when(inside_2, ENDS_INSIDE).otherwise(SWAPS)).otherwise(F.when(inside_2, KEEPS).otherwise(ENDS_OUTSIDE))
    return F.when(~F.contains(line, F.lit('"')), KEEPS).otherwise(code).cast("tinyint")


def _compose(codes: np.ndarray) -> int:
    """The effect of several lines in a row."""
    fixed = np.flatnonzero(codes >= ENDS_OUTSIDE)
    behind = codes[fixed[-1] + 1 :] if len(fixed) else codes
    swaps = int((behind == SWAPS).sum()) & 1
    if not len(fixed):
        return SWAPS if swaps else KEEPS
    return ENDS_OUTSIDE + (int(codes[fixed[-1]] - ENDS_OUTSIDE) ^ swaps)


def _split_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``split, first_row, effect`` of runs of lines (``split, row, code``) of one split."""
    for batch in batches:
        split, row, code = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        if not len(split):
            continue
        starts = np.flatnonzero(np.concatenate([[True], split[1:] != split[:-1]]))
        ends = np.append(starts[1:], len(split))
        yield pa.RecordBatch.from_arrays(
            [pa.array(split[starts]), pa.array(row[starts]), pa.array([_compose(code[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int8())],
            names=["split", "first_row", "effect"],
        )


def _then(first: Column, second: Column) -> Column:
    """The effect of ``first`` followed by ``second``."""
    swapped = F.when(first == KEEPS, SWAPS).when(first == SWAPS, KEEPS).when(first == ENDS_OUTSIDE, ENDS_INSIDE).otherwise(ENDS_OUTSIDE)
    return F.when(second == KEEPS, first).when(second == SWAPS, swapped).otherwise(second).cast("int")


def split_states(lines: DataFrame) -> DataFrame:
    """``file, block, split, file_no, inside``: whether each split of a file begins inside a quoted field.

    ``file_no`` numbers the files in the order of their names.
    """
    split = F.xxhash64("file", "block").alias("split")
    coded = lines.select(split, "row", line_effect(F.col("line")).alias("code"))
    runs = coded.mapInArrow(_split_effects, "split long, first_row long, effect tinyint")
    # A split has few runs: one per batch of lines.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("first_row", "effect"))), lambda r: r["effect"].cast("int"))
    effects = runs.groupBy("split").agg(F.aggregate(ordered, F.lit(KEEPS), _then).alias("effect"))
    places = lines.select("file", "block").distinct()
    files = places.select("file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("file")))
    placed = _staged(places.join(files, "file").withColumn("split", F.xxhash64("file", "block")).join(effects, "split"), "csv-splits")
    # Along a file: the last split before this one that fixes the state, and how often splits swapped it since.
    before = Window.partitionBy("file_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.when(F.col("effect") == SWAPS, 1).otherwise(0)).over(before), F.lit(0))
    fixed = F.last(F.when(F.col("effect") >= ENDS_OUTSIDE, F.struct("effect", "swaps")), True)
    known = placed.withColumn("swaps", swaps).withColumn("fixed", fixed.over(before))
    start = F.coalesce((F.col("fixed.effect") == ENDS_INSIDE).cast("int"), F.lit(0))
    inside = (start + F.col("swaps") - F.coalesce("fixed.swaps", F.lit(0))) % 2 == 1
    return known.select("file", "block", "split", "file_no", inside.alias("inside"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A record is whole, or a piece: the end of one begun before its split, the unfinished last one, or a split inside one.
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
_RECORDS = pa.schema([("split", pa.int64()), ("row", pa.int64()), ("kind", pa.int8()), ("record", pa.string())])


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits in order (``split, inside, row, code, line``) -> records and pieces of records."""
    split, inside, begun, first, held = None, False, False, 0, []  # begun: the record held began in this split
    done: list[tuple[int, int, int, str]] = []

    def close(ended: bool) -> None:
        if held:
            kind = (WHOLE if begun else HEAD) if ended else (TAIL if begun else MIDDLE)
            done.append((split, first, kind, "\n".join(held)))

    def several() -> Iterator[pa.RecordBatch]:
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done, strict=True), _RECORDS, strict=True)], schema=_RECORDS)
            done.clear()

    for batch in batches:
        splits, starts, rows, codes = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        texts = batch.column(4).cast(pa.string())
        # Outside, a line that stays outside is a record; such runs are passed on as they are.
        opens = np.flatnonzero((codes == SWAPS) | (codes == ENDS_INSIDE))
        changes = np.flatnonzero(splits[1:] != splits[:-1]) + 1
        alone = np.zeros(len(splits), dtype=bool)
        k = 0
        while k < len(splits):
            if splits[k] != split:
                close(ended=False)
                split, inside, held = splits[k], bool(starts[k]), []
                begun = not inside
            if inside:
                if not held:
                    first = int(rows[k])
                held.append(texts[k].as_py())
                inside = codes[k] in (KEEPS, ENDS_INSIDE)
                if not inside:
                    close(ended=True)
                    held, begun = [], True
                k += 1
                continue
            end = min([len(splits), *opens[np.searchsorted(opens, k) :][:1], *changes[np.searchsorted(changes, k, side="right") :][:1]])
            alone[k:end] = True
            if end == k:
                first, held, inside = int(rows[k]), [texts[k].as_py()], True
                k += 1
            else:
                k = end
        if alone.any():
            mask = pa.array(alone)
            kinds = pa.array(np.full(int(alone.sum()), WHOLE, dtype=np.int8))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(2).filter(mask), kinds, texts.filter(mask)], schema=_RECORDS)
        yield from several()
    close(ended=False)
    yield from several()


def read_records(spark: SparkSession, base_path: str, pattern: str = DEFAULT_PATTERN) -> tuple[DataFrame, DataFrame]:
    """All records of the files, their headers included, and the files.

    ``_src_file, _src_block, _src_row`` (number of the file, and where the
    record's first line stands), ``record``, ``open_end`` (the file ends inside
    a quoted field); and ``_src_file, file``.
    """
    lines = _lines(spark, base_path, pattern)
    states = _staged(split_states(lines), "csv-states")
    n_splits = states.count()
    if n_splits > MAX_SPLITS:
        raise ValueError(f"{n_splits} splits: raise spark.sql.files.maxPartitionBytes so that there are at most {MAX_SPLITS}")
    keyed = lines.select(F.xxhash64("file", "block").alias("split"), "row", "line").join(F.broadcast(states.select("split", "inside")), "split")
    joined = keyed.select("split", "inside", "row", line_effect(F.col("line")).alias("code"), "line").mapInArrow(
        _join_lines, "split long, row long, kind tinyint, record string"
    )
    places = states.select("split", F.col("file_no").alias("_src_file"), F.col("block").alias("_src_block"))
    placed = _staged(joined.withColumnRenamed("row", "_src_row").join(F.broadcast(places), "split").drop("split"), "csv-records")
    whole = placed.filter(F.col("kind") == WHOLE).select(*FILE_ORDER, "record", F.lit(False).alias("open_end"))
    # At most two pieces of each split; a record is a tail, then middles, then a head.
    along = Window.partitionBy("_src_file").orderBy("_src_block", "_src_row")
    pieces = placed.filter(F.col("kind") != WHOLE).withColumn("nth", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(along))
    parts = F.array_sort(F.collect_list(F.struct("_src_block", "_src_row", "record", "kind"))).alias("parts")
    again = pieces.groupBy("_src_file", "nth").agg(parts).select(
        "_src_file", F.col("parts")[0]["_src_block"].alias("_src_block"), F.col("parts")[0]["_src_row"].alias("_src_row"),
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), (F.element_at("parts", -1)["kind"] != HEAD).alias("open_end"),
    )
    records = whole.unionByName(again).withColumn("record", F.rtrim("record", F.lit("\r"))).filter("record <> ''")
    return records, states.select(F.col("file_no").alias("_src_file"), "file").distinct()


def n_fields(record: Column) -> Column:
    """Fields of a record: the commas outside quoted fields, and one."""
    return F.length(F.regexp_replace(record, '(?:^|(?<=,))"(?:[^"]++|"")*+"|[^,"]++|"', "")) + 1


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def _column_names(spark: SparkSession, header: str) -> list[str]:
    """The names in a header record, which the parser of the rows reads."""
    one = spark.createDataFrame([(header,)], "header string")
    n = one.select(n_fields(F.col("header")).alias("n")).first()["n"]
    values = one.select(F.from_csv("header", _ddl([f"c{k}" for k in range(n)]), CSV_OPTIONS).alias("h")).first()["h"]
    return [v or f"_c{k}" for k, v in enumerate(values)]


#: Why a record is not read: the file ends inside its quotes, or it has more fields than the header.
OPEN_QUOTE, EXTRA_FIELDS = "open_quote", "extra_fields"


def scan_records(spark: SparkSession, base_path: str, pattern: str = DEFAULT_PATTERN, rename: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Every record as text columns named by its file's header (or by ``rename``), and the files (``_src_file, file``).

    Besides the columns of all headers there are the position, ``_problem``
    (``open_quote`` or ``extra_fields``; the columns then are not to be used),
    ``_missing`` (fields short of the header) and ``_record``.
    """
    records, files = read_records(spark, base_path, pattern)
    first = records.filter("_src_block = 0").groupBy("_src_file").agg(F.min_by("record", "_src_row").alias("header"), F.min("_src_row").alias("head_row"))
    heads = _staged(first.withColumn("header", F.regexp_replace("header", "^\ufeff", "")), "csv-headers")
    headers = [r.header for r in heads.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {base_path}")
    body = records.join(heads, "_src_file").filter("_src_block > 0 OR _src_row > head_row").drop("head_row")
    parts = []
    for header in sorted(headers):
        names = [(rename or {}).get(n, n) for n in _column_names(spark, header)]
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a column occurs twice in the header {header!r}")
        mine = body.filter(F.col("header") == header).withColumn("_n", n_fields(F.col("record")))
        problem = F.when(F.col("open_end"), OPEN_QUOTE).when(F.col("_n") > len(names), EXTRA_FIELDS)
        parsed = mine.select(
            *FILE_ORDER, problem.alias("_problem"), F.greatest(F.lit(0), len(names) - F.col("_n")).alias("_missing"), F.col("record").alias("_record"),
            F.from_csv("record", _ddl(names), CSV_OPTIONS).alias("_row"),
        )
        parts.append(parsed.select("_row.*", *FILE_ORDER, "_problem", "_missing", "_record"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), files


def scan_complaint_records(spark: SparkSession, base_path: str, pattern: str = DEFAULT_PATTERN) -> tuple[DataFrame, DataFrame]:
    """``scan_records`` with the raw column names."""
    return scan_records(spark, base_path, pattern, COLUMN_MAPPING)


def load_with_rejects(scanned: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What ``scan_complaint_records`` found: typed raw rows with their file position, and the table of what was wrong.

    The second frame has ``file, _src_block, _src_row, reason, value, loaded``.
    A record that is not loaded is in it once (``loaded`` false): with reason
    ``open_quote`` or ``extra_fields``, or ``complaint_id`` where it has no
    usable id.  So records = loaded rows + rejected rows.  Losses in loaded
    records are listed as well: ``missing_fields``, and ``date_received`` or
    ``date_sent_to_company`` where no known spelling reads the text.
    """
    text, files = scanned

    def given(name: str) -> Column:
        return null_if_na_token(name) if name in text.columns else F.lit(None).cast("string")

    # Fields and verdicts as columns first: the list of findings names them several times, and each would be read again.
    dates = {f"_date_{c}": given(c) for c in RAW_DATE_COLUMNS}
    text_id = text.select(*FILE_ORDER, "_problem", "_missing", "_record", given("complaint_id").alias("_id"), *[d.alias(c) for c, d in dates.items()])
    judged = text_id.withColumns(
        {"_rejected": F.coalesce("_problem", F.when(lenient_bigint("_id").isNull(), F.lit("complaint_id"))), **{f"_lost{c}": F.col(c).isNotNull() & lenient_date(c).isNull() for c in dates}}
    )
    rejected, kept, unread = F.col("_rejected"), F.col("_rejected").isNull(), F.col("_problem").isNotNull()
    found = [F.struct(rejected.alias("reason"), F.when(unread, F.col("_record")).otherwise(F.col("_id")).alias("value"), F.lit(False).alias("loaded"))]
    found.append(F.struct(F.when(kept & (F.col("_missing") > 0), "missing_fields").alias("reason"), F.col("_missing").cast("string").alias("value"), F.lit(True).alias("loaded")))
    for c in RAW_DATE_COLUMNS:
        lost = kept & F.col(f"_lost_date_{c}")
        found.append(F.struct(F.when(lost, c).alias("reason"), F.col(f"_date_{c}").alias("value"), F.lit(True).alias("loaded")))
    wrong = judged.select(*FILE_ORDER, F.inline(F.array(*found))).filter("reason IS NOT NULL")
    rejects = wrong.join(files, "_src_file").select("file", "_src_block", "_src_row", "reason", "value", "loaded")
    return normalise(text.filter(F.col("_problem").isNull()), keep=FILE_ORDER), rejects
