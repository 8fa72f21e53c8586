"""Near duplicates by a chosen-path similarity join over minwise tokens.

Documents with equal shingle sets form a class, and one member stands for it.
A node of a tree holds the representatives that agree in the minwise values
along a path.  A tree's root node chooses one or two minwise positions and
every value there makes a child; a node that is too large chooses positions
by its own path and is split again.  Small nodes are compared exhaustively: on
sketches first, then all members with a likely partner on their full sets.
Several independent trees bring the recall to its target.

Large groups of copies do not make pairs of all their members: before any node
is searched, each representative is confirmed against the one leader it shares
most first-level nodes with.  The links found join components; a node is
then only searched for pairs of *different* components, and one whose members
are all connected is done.

Recall: a pair of similarity 0.75 shares a first-level node with probability
1 - 0.25**10 > 0.999999; in nodes that are split, each split keeps it with
probability 0.94 or more per tree.  A sketch of 256 values hides a pair of
that similarity with a probability of 5e-4, one of similarity 0.8 with 1e-8.

Defined cases
* null, empty or blank text: no shingle, linked with nothing, a component of its own;
* fewer words than a shingle has: the sequence as one shingle;
* equal texts and equal sets are one class, so links between them need no comparison;
* a long text is shingled whole;
* repeated rows (same id) belong to one component and give a row each;
* a null id cannot name a component: such rows have a null ``component_id``, are not kept and link nothing;
* an empty table gives no rows; extra columns are not carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged
from grievance.llm.components import components
from grievance.llm.shingles import common, mix, set_keys, shingle_sets, sketches

#: Similarity of linked documents: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Values of a sketch, and the least share of equal values of a pair that is confirmed on full sets.
VALUES = 256
MIN_ESTIMATE = 0.66
#: Minwise positions that the roots of the trees choose.
ROOTS = 10
#: Positions that a split node chooses.
BRANCHES = 2
#: Largest node that is compared as a whole; of larger ones, most members outside the largest component.
NODE = 512
#: Members that meet the others of a larger node in one task.
BLOCK = 2048
#: Levels after which a node is compared in blocks however large it is.
DEPTH = 24
#: Sets confirmed against the same set in one task.
SHARE = 256
#: Bytes of text that a worker hashes together.
BATCH_BYTES = 1_000_000
#: Ids are broadcast up to this number.
BROADCAST_IDS = 1_000_000

SEEDS = np.random.default_rng(8).integers(1, (1 << 64) - 1, VALUES, dtype=np.uint64)


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of text bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, before + BATCH_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _parts(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of rows."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(1).to_pylist()]


def sketch_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, sketch, roots`` of ``doc_id, text``; ``roots`` are the keys of its first-level nodes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                values, sizes = shingle_sets(_texts(batch))
                a, b = set_keys(values, sizes)
                rows, roots = sketches(values, sizes, SEEDS, ROOTS)
                cut = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * ROOTS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(a), pa.array(b), pa.array([r.tobytes() for r in rows], pa.binary()),
                     pa.ListArray.from_arrays(cut, pa.array(roots.ravel()))],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "sketch", "roots"],
                )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return slim.mapInArrow(run, "doc_id long, n_shingles long, key_a long, key_b long, sketch binary, roots array<long>")


def document_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, shingles`` (sorted 64-bit numbers) of the documents whose ids are ``wanted.id``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                values, sizes = shingle_sets(_texts(batch))
                cut = np.concatenate([[0], np.cumsum(sizes)])
                sets = [values[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    small = wanted.count() <= BROADCAST_IDS
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    kept = slim.join(F.broadcast(wanted) if small else wanted, "id", "left_semi")
    return kept.mapInArrow(run, "id long, shingles binary")


def confirm(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the distinct pairs ``a, b`` whose full sets reach the similarity.

    The sets that are compared with one hub ``a`` are dealt to tasks of bounded
    size, and the hub's own set goes to each of them.
    """
    pairs = staged(pairs.select("a", "b").distinct(), "pairs")
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    sets = document_sets(docs, wanted)
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).alias("parts"))
    dealt = pairs.join(hubs, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    hub_rows = hubs.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("a").alias("id"))
    roles = staged(hub_rows.unionByName(dealt.select("a", "part", F.lit(1).alias("kind"), F.col("b").alias("id"))), "roles")
    rows = sets.join(F.broadcast(roles) if roles.count() <= BROADCAST_IDS else roles, "id").select("a", "part", "kind", "id", "shingles")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, dtype=np.uint64)
        for batch in (part for whole in batches for part in _parts(whole)):
            found: list[tuple[int, int]] = []
            for a, kind, other, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                theirs = np.frombuffer(raw, dtype=np.uint64)
                if kind == 0:
                    hub, own = a, theirs
                elif hub == a:
                    both = common(own, theirs)
                    if 100 * both >= percent * (len(own) + len(theirs) - both):
                        found.append((a, other))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    # The hub's row comes first in its part; rows stream through, one set is kept.
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "kind").mapInArrow(compare, "a long, b long").distinct()


def first_nodes(reps: DataFrame) -> DataFrame:
    """``key, id`` of the roots' children with two representatives or more, and ``leader``, the smallest id of a node."""
    rows = reps.select("id", F.explode("roots").alias("key"))
    nodes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader")).filter("n > 1").drop("n")
    return staged(rows.join(nodes, "key"), "nodes")


def leader_pairs(nodes: DataFrame) -> DataFrame:
    """Each representative with the leader it shares most nodes with (``a, b``), if they share as many as likely duplicates do."""
    votes = nodes.filter("id != leader").groupBy("id", "leader").agg(F.count("*").alias("n"))
    best = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("leader")).alias("last"))).alias("best"))
    return best.filter(F.col("best.n") >= 0.4 * ROOTS).select((-F.col("best.last")).alias("a"), F.col("id").alias("b"))


def split(rows: DataFrame) -> DataFrame:
    """Children (``key, id``) of nodes given as ``key, id, sketch``: positions chosen by the node's key."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            own = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(-1, VALUES)
            keys = []
            for branch in range(BRANCHES):
                chosen = mix(key + np.uint64(branch + 1))
                at = (chosen % np.uint64(VALUES)).astype(np.int64)
                keys.append(mix(chosen ^ mix(own[np.arange(len(at)), at].astype(np.uint64) + np.uint64(1))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.concat_arrays([batch.column(1)] * BRANCHES)], names=["key", "id"]
            )

    return rows.select("key", "id", "sketch").mapInArrow(run, "key long, id long")


def _partners(comps: np.ndarray, other: np.ndarray, first_block: bool, i: int) -> np.ndarray:
    """Members that ``i``, one outside the main component, is compared with: those of other components, each pair in one block."""
    may = comps != comps[i]
    if not first_block:
        may &= ~other
    return np.flatnonzero(may)


def _promising(comps: np.ndarray, other: np.ndarray, first_block: bool, own: np.ndarray) -> np.ndarray:
    """Members of a node whose sketch agrees enough with that of a member of another component."""
    found = np.zeros(len(comps), dtype=bool)
    for i in np.flatnonzero(other):
        at = _partners(comps, other, first_block, i)
        hit = at[(own[at] == own[i]).sum(axis=1) >= MIN_ESTIMATE * VALUES]
        found[hit] = True
        found[i] |= len(hit) > 0
    return found


def _links(ids: np.ndarray, comps: np.ndarray, other: np.ndarray, first_block: bool, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of a node on full sets, as many as it takes to join its components."""
    sizes = np.array([len(x) for x in sets])
    tokens, token = np.unique(np.concatenate(sets), return_inverse=True)
    cut = np.concatenate([[0], np.cumsum(sizes)])
    has = np.zeros(len(tokens), dtype=bool)
    comps = comps.copy()
    found = []
    for i in np.flatnonzero(other):
        if not len(_partners(comps, other, first_block, i)):
            continue
        mine = token[cut[i] : cut[i + 1]]
        has[mine] = True
        both = np.add.reduceat(has[token], cut[:-1], dtype=np.int64)
        has[mine] = False
        near = 100 * both >= percent * (sizes + sizes[i] - both)
        for j in _partners(comps, other, first_block, i):
            if near[j] and comps[j] != comps[i]:
                found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                comps[comps == comps[j]] = comps[i]
    return found


def search(nodes: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` between different components, from all nodes that are small enough to compare.

    ``nodes`` has ``key, id``; ``labels`` the components found so far.  Nodes
    of one component are dropped, large ones split by their path.  In a small
    node, members whose sketch is near that of another component's member
    are compared on full sets; a node gives at most as many links as members.
    """
    dealt_schema = "key long, block long, id long, comp long, other boolean"
    parts: DataFrame | None = None
    for depth in range(DEPTH + 1):
        members = nodes.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
        members = staged(members, "members")
        by_comp = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
        stats = by_comp.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("comps"))
        stats = staged(
            stats.filter("comps > 1").select(
                "key", "n", F.col("main.comp").alias("main"),
                ((F.col("n") <= NODE) | (F.col("n") - F.col("main.n") <= NODE) | F.lit(depth == DEPTH)).alias("small"),
                F.when(F.col("n") <= NODE, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK)).cast("long").alias("blocks"),
            ), "stats",
        )
        rows = members.join(stats, "key")
        other = F.col("comp") != F.col("main")
        last = F.col("blocks") - 1
        dealt = rows.filter("small").select(
            "key", "id", "comp", other.alias("other"),
            F.explode(F.when(other, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("blocks"))))).alias("block"),
        )

        def promising(pdf: pd.DataFrame) -> pd.DataFrame:
            own = np.frombuffer(b"".join(pdf["data"]), dtype=np.uint16).reshape(-1, VALUES)
            hit = _promising(pdf["comp"].to_numpy(), pdf["other"].to_numpy(), bool(pdf["block"].iloc[0] == 0), own)
            return pdf.loc[hit, ["key", "block", "id", "comp", "other"]]

        sketched = dealt.join(reps.select("id", F.col("sketch").alias("data")), "id")
        found = staged(_by_node(sketched, promising, dealt_schema), "promising")
        parts = found if parts is None else parts.unionByName(found)
        if stats.filter("NOT small").isEmpty():
            break
        large = rows.filter("NOT small").select("key", "id").join(reps.select("id", "sketch"), "id").select("key", "id", "sketch")
        nodes = staged(split(large).distinct(), "children")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["data"]]
        pairs = _links(pdf["id"].to_numpy(), pdf["comp"].to_numpy(), pdf["other"].to_numpy(), bool(pdf["block"].iloc[0] == 0), sets, percent)
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    sets = document_sets(docs, staged(parts.select("id").distinct(), "wanted")).withColumnRenamed("shingles", "data")
    small = parts.count() <= BROADCAST_IDS
    return _by_node(sets.join(F.broadcast(parts) if small else parts, "id"), link, "a long, b long").distinct()


def _by_node(rows: DataFrame, one: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``one`` applied to the rows of each (node, block): rows stream in node by node, and one node is held."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None

        def emit(parts: list[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
            parts = [p for p in parts if len(p)]
            if parts:
                yield pa.RecordBatch.from_pandas(pd.concat(parts)[names], preserve_index=False)

        for batch in (part for whole in batches for part in _parts(whole)):
            pdf = batch.to_pandas()
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            key, block = pdf["key"].to_numpy(), pdf["block"].to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])]))
            yield from emit([one(pdf.iloc[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)])
            held = pdf.iloc[cut[-1] :]
        if held is not None:
            yield from emit([one(held)])

    columns = ["key", "block", "id", "comp", "other", "data"]
    return rows.select(*columns).repartition("key", "block").sortWithinPartitions("key", "block", "id").mapInArrow(run, schema)


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(sketch_documents(docs), "sketches")
    same = ["key_a", "key_b", "n_shingles"]
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = staged(
        usable.groupBy(*same).agg(F.min("doc_id").alias("id"), F.min_by("sketch", "doc_id").alias("sketch"), F.min_by("roots", "doc_id").alias("roots")), "classes"
    )
    nodes = first_nodes(reps)
    links = staged(confirm(leader_pairs(nodes), docs), "links")
    more = search(nodes.select("key", "id"), components(links), reps, docs)
    labels = components(staged(links.unionByName(more), "links"))
    named = reps.join(labels, "id", "left").select(*same, F.coalesce("component", "id").alias("class"))
    slim = rows.select("doc_id", *same)
    found = slim.join(named, same, "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("class")), F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
