"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised, each row gets its place on the
Hilbert curve through their grid, and the rows in curve order are cut into runs
of equal row counts.  Neighbours on the curve are neighbours in every
dimension, so a file's minima and maxima are narrow in all of them and a filter
on any prunes files.  Names are quantised in their order, by cut points among
the distinct names, so that a cell holds names next to each other.

Ranks are global without a global window: a range partitioning orders the slim
rows (no text), each partition counts its rows, and the counts of the
partitions before are added to the rank within the partition.

Defined cases
* null text: no bytes, size 16, checksum 0; null dimensions have a code of their own;
* equal places on the curve: ordered by (source, text checksum, id), then by the other columns carried;
* a long text only counts by its size and checksum; a null id is placed like any other;
* repeated rows take consecutive slots; fewer rows than shards leave shards empty;
* an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grievance.llm.common import staged

SHARDS = 40
#: Bytes that a document counts beside its text.
OVERHEAD = 16
#: Bits per dimension of the grid.
BITS = 6


def curve_steps(dims: int) -> list[tuple[int, int]]:
    """One level of the Hilbert curve as a table: ``[state << dims | cell] = (rank of the cell, next state)``.

    A state is the entry corner and the direction of a sub-cube; the rule is
    the Gray code of the corners, rotated and reflected.
    """
    n, full = dims, (1 << dims) - 1

    def rotate(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & full

    def rank_of_gray(g: int) -> int:
        r = 0
        while g:
            r ^= g
            g >>= 1
        return r

    def ones(x: int) -> int:
        return ((x ^ (x + 1)).bit_length() - 1) % n

    table = []
    for entry in range(1 << n):
        for direction in range(n):
            for cell in range(1 << n):
                w = rank_of_gray(rotate(cell ^ entry, n - direction - 1))
                even = (w - 1) & ~1
                corner = 0 if w == 0 else even ^ (even >> 1)
                turn = 0 if w == 0 else ones(w) if w & 1 else ones(w - 1)
                table.append((w, (entry ^ rotate(corner, direction + 1)) * n + (direction + turn + 1) % n))
    return table


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a grid cell; each dimension is an integer below ``2 ** bits``."""
    n = len(dims)
    steps = curve_steps(n)
    rank = F.array(*[F.lit(w) for w, _ in steps])
    turn = F.array(*[F.lit(s) for _, s in steps])
    cells = F.array(*[
        sum((F.shiftleft(F.shiftright(d.cast("int"), b).bitwiseAND(1), i) for i, d in enumerate(dims)), F.lit(0)) for b in reversed(range(bits))
    ])
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("s"))

    def step(acc: Column, cell: Column) -> Column:
        at = F.shiftleft(acc["s"], n).bitwiseOR(cell)
        return F.struct((F.shiftleft(acc["h"], n) + F.get(rank, at)).alias("h"), F.get(turn, at).alias("s"))

    return F.aggregate(cells, start, step, lambda acc: acc["h"])


def name_cuts(docs: DataFrame, name: str, bits: int = BITS) -> list[str]:
    """Cut points that deal the distinct names, in their order, into ``2 ** bits - 1`` cells of equal numbers of names."""
    cells = (1 << bits) - 1
    distinct = docs.select(F.col(name).cast("string").alias("_name")).dropna().distinct()
    ranked, n = order_rows(distinct, ["_name"])
    cell = F.expr(f"(_rank * {cells}L) div {max(n, 1)}L")
    return [r.cut for r in ranked.groupBy(cell.alias("_cell")).agg(F.min("_name").alias("cut")).orderBy("_cell").collect()]


def quantised_name(c: Column, cuts: Sequence[str]) -> Column:
    """A name as the number of cut points up to it; names in one cell are neighbours, null is 0."""
    reached = F.filter(F.array(*[F.lit(x) for x in cuts]), lambda cut: cut <= c.cast("string")) if cuts else F.array()
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(reached)).cast("int")


def quantised_log(c: Column, bits: int = BITS, top: int = 24) -> Column:
    """A size on a logarithmic scale, ``2 ** top`` and more in the last step; null is 0."""
    cells = (1 << bits) - 1
    return F.least(F.lit(cells), F.coalesce(F.floor(F.log2(F.greatest(c, F.lit(0)) + 1) * cells / top), F.lit(0))).cast("int")


def document_dimensions(docs: DataFrame) -> list[Column]:
    """Source, language and length in characters."""
    return [*[quantised_name(F.col(c), name_cuts(docs, c)) for c in ("source", "lang")], quantised_log(F.col("n_chars"))]


def order_rows(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``_rank`` - 0, 1, ... in the order of ``keys`` - and their number."""
    rows = staged(rows, "curve")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(rows.repartitionByRange(width, *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    # One row per partition: how many rows the partitions before it have.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.withColumn("_before", F.coalesce(F.sum("_count").over(earlier), F.lit(0))), "offsets")
    total = offsets.agg(F.sum("_count")).first()[0] or 0
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)).cast("long") - 1
    ranked = placed.join(F.broadcast(offsets.select("_part", "_before")), "_part").withColumn("_rank", local + F.col("_before"))
    return ranked.drop("_part", "_before"), total


def assign(docs: DataFrame, dims: Sequence[Column] | None = None, shards: int = SHARDS,
           id_col: str = "doc_id", text_col: str = "text", tie_col: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot``: shard counts are at most one apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        hilbert_index(list(dims) if dims is not None else document_dimensions(docs)).alias("curve"),
        F.col(tie_col).alias("_tie"),
    )
    ranked, n = order_rows(slim, ["curve", "_tie", "text_crc32", "doc_id", "size"])
    shard = f"(_rank * {shards}L) div {max(n, 1)}L"
    return ranked.withColumn("shard", F.expr(shard).cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard",
        (F.col("_rank") - F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")).alias("slot"),
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, files: int, id_col: str = "doc_id") -> None:
    """Write whole documents by shard, each file a run of the curve (at least ``files`` runs in all)."""
    kept = [c for c in docs.columns if c not in ("shard", "slot", "curve")]
    placed = docs.select(*kept).join(assigned.select(F.col("doc_id").alias(id_col), "curve", "shard", "slot"), id_col)
    runs = placed.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    runs.write.partitionBy("shard").parquet(path)
