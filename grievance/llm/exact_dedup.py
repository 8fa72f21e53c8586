"""Exact duplicates by deterministic block naming.

A text, with A-Z in lower case, is cut into blocks of a fixed number of bytes.
All distinct blocks are sorted and numbered: a block's number is its name.
Then two neighbouring names of a document make a pair, the distinct pairs are
sorted and numbered again, and so on, until one name is left of each document.
Names are given to equal content only, so two documents have the same last
name (after the same number of rounds) exactly if their texts are equal: no
digest decides.

The text moves once, as distinct blocks per map task.  A 128-bit hash is the
blocks' sort key and carries the names back to the documents; that every hash
stands for one block only is checked on the blocks themselves, and if one does
not, the naming starts again with another seed.  A round moves one row per
pair; the rows of copies are combined before each shuffle of distinct blocks,
pairs or groups, and the joins back are plain equi-joins that Spark splits
where a key is hot.

Defined cases: null text is the empty text, and all empty texts are equal; of
rows that tie on the largest id one stays; null ids are smaller than any id, a
group without ids keeps one row with a null ``keep_id``; a long text takes one
more round whenever its length doubles; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged

#: Bytes of a block: nearly all documents are one to four of them.
BLOCK_BYTES = 8192
#: Stands for the missing right half of a pair; names are never negative.
NONE = -1


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def block_hash(block: Column, attempt: int) -> list[Column]:
    """Two 64-bit hashes of a block; another attempt has other seeds."""
    return [F.xxhash64(F.lit(2 * attempt), block), F.xxhash64(F.lit(2 * attempt + 1), block)]


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """A row for each block: ``rid`` (of the row), ``doc_id, text_sha256, n_blocks, pos, block``."""
    text = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("int")
    sized = text.select("rid", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.col("text").cast("binary").alias("text"), n_blocks.alias("n_blocks"))
    cut = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("pos"))
    return cut.select("rid", "doc_id", "text_sha256", "n_blocks", "pos", F.substring("text", F.col("pos") * block_bytes + 1, F.lit(block_bytes)).alias("block"))


def _numbered(keys: DataFrame, name: str) -> DataFrame:
    """The distinct ``keys`` with their ``name``, which grows in their order."""
    return staged(keys.orderBy(*keys.columns).withColumn("name", F.monotonically_increasing_id()), name)


def named_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashes: Callable[[Column, int], list[Column]] = block_hash) -> DataFrame:
    """``rid, doc_id, text_sha256, n_blocks, pos, name`` of all blocks."""
    blocks = _blocks(docs, block_bytes)
    attempt = 0
    while True:
        h1, h2 = hashes(F.col("block"), attempt)
        hashed = blocks.withColumns({"h1": h1, "h2": h2})
        kinds = staged(hashed.select("h1", "h2", "block").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("kinds")), "kinds")
        if kinds.filter("kinds > 1").isEmpty():
            break
        attempt += 1
    where = staged(hashed.drop("block"), "blocks")
    return where.join(_numbered(kinds.select("h1", "h2"), "names"), ["h1", "h2"]).drop("h1", "h2")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashes: Callable[[Column, int], list[Column]] = block_hash) -> DataFrame:
    """``rid, doc_id, text_sha256, round, name`` of every row: equal ``round, name`` if and only if the texts are equal."""
    named = staged(named_blocks(docs, block_bytes, hashes), "named")
    done = named.filter("n_blocks = 1").select("rid", "doc_id", "text_sha256", F.lit(0).alias("round"), "name")
    left = named.filter("n_blocks > 1")
    owners = left.filter("pos = 0").select("rid", "doc_id", "text_sha256")
    most = left.agg(F.max("n_blocks")).first()[0] or 1
    left = left.select("rid", "n_blocks", "pos", "name")
    for k in range(1, (most - 1).bit_length() + 1):
        even, name = F.col("pos") % 2 == 0, F.col("name")
        pairs = left.groupBy("rid", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pair")).agg(
            F.max(F.when(even, name)).alias("a"), F.coalesce(F.max(F.when(~even, name)), F.lit(NONE)).alias("b")
        )
        pairs = staged(pairs, "pairs")
        names = _numbered(pairs.select("a", "b").distinct(), "pair_names")
        left = staged(pairs.join(names, ["a", "b"]).select("rid", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks"), F.col("pair").alias("pos"), "name"), "level")
        last = left.filter("n_blocks = 1").join(owners, "rid")
        done = done.unionByName(last.select("rid", "doc_id", "text_sha256", F.lit(k).alias("round"), "name"))
        left = left.filter("n_blocks > 1")
    return done


def label_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashes: Callable[[Column, int], list[Column]] = block_hash) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs`` (``doc_id, text``).

    Of equal texts the row with the largest id stays.
    """
    known = staged(identities(docs, block_bytes, hashes), "identities")
    groups = known.groupBy("round", "name").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "rid")).alias("top"))
    return known.join(groups, ["round", "name"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256"
    )


#: The same rows in DuckDB.
ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY low) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(low) AS text_sha256
FROM t WINDOW w AS (PARTITION BY low ORDER BY doc_id DESC NULLS LAST)
"""
