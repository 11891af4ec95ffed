"""Merkle manifest of a dataset as a persistent path-copying tree.

A row's leaf is the digest of its columns. Inside a source the leaves ascend
by ``doc_id``; every ``ARITY`` consecutive nodes become their digest until one
node, the source's subroot, is left. The subroots, ordered by source, give the
root in the same way.

The tree is cut into aligned blocks of ``ARITY ** LEVELS`` consecutive nodes,
each built in one task: the blocks of leaves first, then blocks over the
blocks' tops, and so on (a table per ``LEVELS`` levels, each that much
smaller). Going back down, every block learns the siblings on the way from its
top to the root (its upper path).

A tampered leaf makes a new version of the tree. The version shares all nodes
that the leaf is not under and copies only the leaf's ancestors: first inside
the leaf's block, then along the block's upper path, in the task that holds
the block, so that no task holds all versions of a source. :func:`versions`
returns the copied nodes, :func:`manifest` each row's proof and the root that
its (tampered) leaf folds to.

Positions are counted without a global window: rows are sorted by range
partitions, written, and numbered by partition counts.

Defined cases: null columns enter the leaf as ``-``; a null source comes first
and is a source of its own; null ids come first in their source; equal ids are
ordered by leaf, rows that are equal altogether are separate leaves; a source
of one row has its leaf as subroot; an empty table gives no rows; other
columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import staged

ARITY, LEVELS = 3, 6
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left: string, right: string>>"
_NODES = f"g string, idx bigint, block bigint, total bigint, digest string, path {_PATH}"
_TOPS = "g string, idx bigint, total bigint, digest string"
_ROWS = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_COPIES = "doc_id bigint, source string, over boolean, level int, idx bigint, digest string"


def digest(*columns: Column) -> Column:
    """SHA-256 over the columns: ``-`` for null, else byte count, colon, value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]), 256)


def _parent(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _steps(total: int) -> int:
    """Levels that a block climbs when its level holds ``total`` nodes."""
    if total > BLOCK:
        return LEVELS
    steps = 0
    while total > 1:
        total, steps = -(-total // ARITY), steps + 1
    return steps


class Tree:
    """The nodes of one block, level by level from its lowest."""

    def __init__(self, digests: list[str], total: int):
        self.levels = [digests]
        for _ in range(_steps(total)):
            below = self.levels[-1]
            self.levels.append([_parent(below[i:i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[dict]:
        """Siblings left and right of node ``at`` and of its ancestors."""
        out = []
        for nodes in self.levels[:-1]:
            run = at - at % ARITY
            out.append({"left": "".join(nodes[run:at]), "right": "".join(nodes[at + 1:run + ARITY])})
            at //= ARITY
        return out


def copied(path: list[dict], leaf: str) -> list[str]:
    """The ancestors that a version with another leaf copies, upwards; all
    other nodes are shared."""
    out = []
    for step in path:
        leaf = _parent([step["left"], leaf, step["right"]])
        out.append(leaf)
    return out


def _numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``idx`` (place in its ``g``, by ``order``) and ``total``
    (rows of the ``g``). ``order`` starts with ``g`` and tells rows apart."""
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("part", F.shiftright("at", 33))
    # A row per source and partition that holds some of it.
    held = rows.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("g")
    offsets = held.select(
        "g", "part", "first", F.sum("n").over(own).alias("total"),
        F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    placed = rows.join(offsets, ["g", "part"]).withColumn("idx", F.col("before") + F.col("at") - F.col("first"))
    return placed.drop("at", "part", "first", "before")


def _blocks(nodes: DataFrame, *columns: str) -> DataFrame:
    """A row per aligned block: its at most ``BLOCK`` nodes in order."""
    nodes = nodes.withColumn("block", F.expr(f"idx div {BLOCK}"))
    return nodes.groupBy("g", "block", "total").agg(
        F.sort_array(F.collect_list(F.struct("idx", *columns))).alias("nodes")
    )


def _over_blocks(work: Callable[[dict], Iterator[dict]], schema: str) -> Callable:
    """Arrow function that runs ``work`` on each block row."""
    names = [part.split()[0] for part in schema.replace(_PATH, "x").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(work(batch.slice(i, 1).to_pylist()[0]))
                yield pa.RecordBatch.from_pydict(
                    {name: [r[name] for r in rows] for name in names}, schema=_arrow(schema)
                )
    return run


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    fields = [part.split() for part in schema.replace(_PATH, "path").split(", ")]
    return pa.schema([(name, path if kind == "path" else kinds[kind]) for name, kind in fields])


def _tops(block: dict) -> Iterator[dict]:
    """The block's top as a node of the next level."""
    yield {
        "g": block["g"], "idx": block["block"], "total": -(-block["total"] // BLOCK),
        "digest": Tree([n["digest"] for n in block["nodes"]], block["total"]).top,
    }


def _climbed(block: dict) -> Iterator[dict]:
    """Every node with its path inside the block; the first also carries the top."""
    tree = Tree([n["digest"] for n in block["nodes"]], block["total"])
    for at, node in enumerate(block["nodes"]):
        yield {
            "g": block["g"], "idx": node["idx"], "block": block["block"], "total": -(-block["total"] // BLOCK),
            "digest": tree.top, "path": tree.path(at),
        }


def _climb(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """From ``nodes (g, idx, total, digest)`` up to one node per ``g``: the
    tables of each round, and ``(g, digest)`` of the last nodes."""
    rounds = []
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        done = _blocks(nodes, "digest").mapInArrow(_over_blocks(_climbed, _NODES), _NODES)
        rounds.append(staged(done, f"{label}-{len(rounds)}"))
        nodes = rounds[-1].where(F.col("idx") == F.col("block") * BLOCK).select("g", F.col("block").alias("idx"), "total", "digest")
        most = -(-most // BLOCK)
    return rounds, nodes.select("g", "digest")


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Extend the paths of ``tops (g, path, ...)`` down to the lowest nodes
    of ``rounds``; a key meets the at most ``BLOCK`` nodes of its block."""
    above = tops.withColumn("idx", F.lit(0).cast("bigint"))
    rest = [c for c in tops.columns if c not in ("g", "path")]
    for nodes in reversed(rounds):
        above = nodes.select("g", "idx", "block", F.col("path").alias("own")).join(
            above.withColumnRenamed("idx", "block"), ["g", "block"]
        ).select("g", "idx", F.concat("own", "path").alias("path"), *rest)
    return above


def _located(docs: DataFrame, forged: Column | None) -> DataFrame:
    """A row per block of leaves with its nodes, upper path, subroot and root."""
    text = F.col("text")
    other = F.lit(None).cast("string") if forged is None else forged
    fields = [F.col(c) for c in FIELDS]
    leaves = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        # Null first, then by the bytes of the name.
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("g"),
        digest(*fields).alias("digest"),
        F.when(other.isNotNull() & (other != text), digest(*fields[:-1], other)).alias("forged"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = _numbered(staged(leaves, "merkle-leaves"), ["g", "doc_id", "digest", "row"], "merkle-sorted")
    blocks = staged(_blocks(leaves, "doc_id", "digest", "forged"), "merkle-blocks")
    rounds, subroots = _climb(staged(blocks.mapInArrow(_over_blocks(_tops, _TOPS), _TOPS), "merkle-tops"), "merkle-round")

    # The subroots are the leaves of the tree over the sources, one group "".
    ordered = _numbered(
        subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["g", "name"], "merkle-subroots"
    )
    ordered = staged(ordered, "merkle-sources")
    upper, root = _climb(ordered.drop("name"), "merkle-upper")
    none = F.array().cast(_PATH)
    crown = _descend(upper, root.select("g", F.col("digest").alias("root"), none.alias("path")))
    crown = ordered.drop("g").join(crown.drop("g"), "idx").select(
        F.col("name").alias("g"), F.col("digest").alias("subroot"), "root", "path", F.size("path").alias("over"),
        F.col("idx").alias("place"),
    )
    paths = _descend(rounds, crown)
    return blocks.join(paths.withColumnRenamed("idx", "block"), ["g", "block"])


def _proved(block: dict) -> Iterator[dict]:
    tree = Tree([n["digest"] for n in block["nodes"]], block["total"])
    for at, node in enumerate(block["nodes"]):
        path = tree.path(at) + block["path"]
        proof = hashlib.sha256()
        for step in path:
            proof.update((step["left"] + step["right"]).encode())
        leaf = node["forged"] or node["digest"]
        folded = (copied(path, leaf) or [leaf])[-1]
        yield {
            "doc_id": node["doc_id"], "leaf": node["digest"], "subroot": block["subroot"], "root": block["root"],
            "proof_sha256": proof.hexdigest(), "folded_root": folded, "verified": folded == block["root"],
        }


def _copies(block: dict) -> Iterator[dict]:
    tree = Tree([n["digest"] for n in block["nodes"]], block["total"])
    for at, node in enumerate(block["nodes"]):
        if node["forged"]:
            path = tree.path(at) + block["path"]
            own = len(path) - block["over"]
            for k, value in enumerate(copied(path, node["forged"]), 1):
                over = k > own
                level, place = (k - own, block["place"]) if over else (k, node["idx"])
                yield {
                    "doc_id": node["doc_id"], "source": None if over or not block["g"] else block["g"][1:], "over": over,
                    "level": level, "idx": place // ARITY ** level, "digest": value,
                }


def manifest(docs: DataFrame, forged: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot`` and ``root`` of
    the untouched table, ``proof_sha256`` (digest of the siblings, level by
    level up to the root), ``folded_root`` (from the tampered, else original,
    leaf) and ``verified``.

    ``forged``: the tampered text of a row; null or equal to ``text`` where
    the row is untouched.
    """
    return _located(docs, forged).mapInArrow(_over_blocks(_proved, _ROWS), _ROWS)


def versions(docs: DataFrame, forged: Column) -> DataFrame:
    """The nodes that each tampered row's version of the tree copies:
    ``(doc_id, source, over, level, idx, digest)``, with ``over`` for nodes of
    the tree over the sources. Every other node is shared with the untouched
    tree."""
    return _located(docs, forged).mapInArrow(_over_blocks(_copies, _COPIES), _COPIES)
