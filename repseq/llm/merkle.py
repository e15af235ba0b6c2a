"""Merkle manifest of a dataset: a tree of SHA-256 digests a source, a tree over the sources, and a proof a row.

Leaves are numbered within their source and dealt to aligned blocks of ``FANOUT ** DEPTH``
positions. A block is one row of a table: its ids and a contiguous matrix of 64-byte hex
digests. Block digests are the leaves of the next table, and so on until each source
has one node; the sources' digests go the same way. Then paths go down the same tables,
so that rows are shuffled once, whatever the number of levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.llm.textcore import lean
from repseq.operators.numbering import numbered
from repseq.operators.shared import materialise, small_batches

FANOUT = 3
#: Levels of a block: 3 ** 6 = 729 positions.
DEPTH = 6
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: bytes) -> bytes:
    """Lower-case hex SHA-256, as bytes."""
    return hashlib.sha256(data).hexdigest().encode()


# --- leaves -------------------------------------------------------------------------


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of values: each is ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
    return F.sha2(F.concat(*map(part, columns)), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``(source, doc_id, leaf, changed)``: ``changed`` is the leaf of the text without line ends where ``tampered`` holds, else null."""
    own = leaf([F.col(c) for c in FIELDS])
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    hit = F.coalesce(tampered, F.lit(False)) & F.col("text").contains("\n") if tampered is not None else F.lit(False)
    other = F.when(hit, leaf([*(F.col(c) for c in FIELDS[:-1]), cut]))
    return docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"), other.alias("changed"))


# --- trees in numpy -----------------------------------------------------------------


def levels(nodes: np.ndarray, depth: int | None = None) -> list[np.ndarray]:
    """All levels of the tree over an (n, 64) matrix of hex digests, lowest first.

    Each level is one matrix, its rows reshaped by fanout and hashed run by run; the last run may be shorter.
    It ends at ``depth`` levels above the nodes, or at the first level of one node.
    """
    out = [nodes]
    while len(out) - 1 < depth if depth is not None else len(out[-1]) > 1:
        rows = np.ascontiguousarray(out[-1])
        whole = len(rows) // FANOUT * FANOUT
        runs = rows[:whole].reshape(-1, FANOUT * HEX)
        above = [digest(r) for r in runs]
        if whole < len(rows):
            above.append(digest(rows[whole:].tobytes()))
        out.append(np.frombuffer(b"".join(above), np.uint8).reshape(-1, HEX))
    return out


class Siblings:
    """For every position of a block, what stands left and right of its node at each level, by index arithmetic alone."""

    def __init__(self, tree: list[np.ndarray]):
        self.steps = []
        at = np.arange(len(tree[0]))
        for nodes in tree[:-1]:
            first = at // FANOUT * FANOUT
            place = first[:, None] + np.arange(FANOUT)
            there = place < len(nodes)
            rows = nodes[np.minimum(place, len(nodes) - 1)]
            self.steps.append((rows, there, at - first))
            at = at // FANOUT

    def proofs(self) -> Iterator[bytes]:
        """Siblings of each position, level by level, left to right."""
        n = len(self.steps[0][0]) if self.steps else 0
        if not n:
            return
        every = np.concatenate([rows for rows, _, _ in self.steps], axis=1)
        asked = np.concatenate([there & (np.arange(FANOUT) != own[:, None]) for _, there, own in self.steps], axis=1)
        for rows, keep in zip(every, asked, strict=True):
            yield rows[keep].tobytes()

    def paths(self) -> list[list[tuple[str, str]]]:
        """As ``proofs``, as pairs of what stands before and after at each level."""
        out: list[list[tuple[str, str]]] = [[] for _ in range(len(self.steps[0][0]) if self.steps else 0)]
        for rows, there, own in self.steps:
            for i, path in enumerate(out):
                path.append((rows[i][: own[i]].tobytes().decode(), rows[i][own[i] + 1 :][there[i][own[i] + 1 :]].tobytes().decode()))
        return out

    def folded(self, nodes: np.ndarray) -> np.ndarray:
        """The block's digest as each of ``nodes``, one a position, gives it with the others' siblings."""
        for rows, there, own in self.steps:
            rows = rows.copy()
            rows[np.arange(len(rows)), own] = nodes
            size = there.sum(axis=1) * HEX
            flat = rows.reshape(len(rows), -1)
            nodes = np.frombuffer(b"".join(digest(r[:k]) for r, k in zip(flat, size.tolist(), strict=True)), np.uint8).reshape(-1, HEX)
        return nodes


def climb(node: bytes, path: Sequence[tuple[str, str]]) -> bytes:
    for before, after in path:
        node = digest(before.encode() + node + after.encode())
    return node


def matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, HEX)


# --- tables of blocks ---------------------------------------------------------------

_BLOCK = "source string, block long, total long, ids array<long>, nodes binary, changed binary, top string"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
_PATHS = pa.schema([("source", pa.string()), ("block", pa.int64()), ("path", pa.list_(_STEP))])
_PATH = "array<struct<before:string,after:string>>"
_ROWS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def depth_of(total: int, depth: int) -> int | None:
    """Levels inside a block of a tree of ``total`` nodes: all of the block's, or until one is left where it is the only one."""
    return None if total <= FANOUT**depth else depth


def blocks_of(nodes: DataFrame, depth: int) -> DataFrame:
    """``(source, pos, total, id, node, changed)`` -> a row a block: ids, node matrix and changed matrix (zeros where none) by position, and its digest. Kept in the shared folder."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        rows = np.frombuffer("".join(group["node"].to_pylist()).encode(), np.uint8).reshape(-1, HEX)
        changed = b"".join((x or "").encode().ljust(HEX, b"\0") for x in group["changed"].to_pylist()) if group["changed"].null_count < len(group) else b""
        total = group["total"][0].as_py()
        top = levels(rows, depth_of(total, depth))[-1].tobytes().decode()
        one = [group["source"][:1], group["block"][:1], group["total"][:1], pa.array([group["id"].to_pylist()], pa.list_(pa.int64())), pa.array([rows.tobytes()]), pa.array([changed]), pa.array([top])]
        return pa.table(one, ["source", "block", "total", "ids", "nodes", "changed", "top"])

    cut = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(FANOUT**depth)).cast("long"))
    return materialise(cut.groupBy("source", "block").applyInArrow(build, _BLOCK))


def tables(nodes: DataFrame, most: int, depth: int) -> list[DataFrame]:
    """Tables of blocks from ``nodes`` up to the one where each tree has one block; ``most``: nodes of the largest tree."""
    size = FANOUT**depth
    out = [blocks_of(nodes, depth)]
    while most > size:
        most = -(-most // size)
        blocks = F.expr(f"(total + {size - 1}) DIV {size}")
        above = out[-1].select("source", F.col("block").alias("pos"), blocks.alias("total"), F.lit(None).cast("long").alias("id"), F.col("top").alias("node"), F.lit(None).cast("string").alias("changed"))
        out.append(blocks_of(above, depth))
    return out


def paths_down(level: DataFrame, above: DataFrame | None, depth: int) -> DataFrame:
    """``(source, block, path)`` for the blocks that are nodes of ``level``, whose own blocks have the paths of ``above`` (none: empty)."""

    @lean
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = levels(matrix(row["nodes"]), depth_of(row["total"], depth))
                n = len(tree[0])
                own = Siblings(tree).paths() or [[]] * n
                first = row["block"] * FANOUT**depth
                path = [[*({"before": b, "after": a} for b, a in p), *row["above"]] for p in own]
                yield pa.RecordBatch.from_pydict({"source": [row["source"]] * n, "block": [first + i for i in range(n)], "path": path}, schema=_PATHS)

    return with_paths(level, above).select("source", "block", "total", "nodes", "above").mapInArrow(expand, f"source string, block long, path {_PATH}")


def with_paths(level: DataFrame, above: DataFrame | None) -> DataFrame:
    if above is None:
        return level.withColumn("above", F.array().cast(_PATH))
    path = above.select(F.col("source").alias("__s"), F.col("block").alias("__b"), F.col("path").alias("above"))
    return level.join(path, F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__b"))).drop("__s", "__b")


def down(levels_: list[DataFrame], depth: int) -> DataFrame | None:
    """Paths of the blocks of the lowest of ``levels_``; None where it is the only one."""
    path = None
    for level in reversed(levels_[1:]):
        path = paths_down(level, path, depth)
    return path


def manifest(docs: DataFrame, tampered: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """One row a row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` says of which rows the text lost its line ends after the manifest was made:
    their ``folded_root`` is climbed from the changed leaf along the original siblings.

    Defined results: leaves of a source ascend by doc_id, null first; of equal ids by leaf, and rows
    equal in all are numbered in any order (their leaves are equal, their proofs differ by place). Null
    values are ``-``, null source is a source of its own, first; a text is hashed whole, at any length.
    Other columns are not read. An empty table gives no rows. A source of one row is its own subroot; of one
    source the subroot is the root; a proof without siblings is the digest of nothing.

    No task holds a source: leaves are dealt by ranges and blocks have ``FANOUT ** depth`` rows. The driver
    gets the root and the sizes of the largest trees, nothing else.
    """
    small_batches(docs.sparkSession)
    none = lambda kind: F.lit(None).cast(kind)
    held = materialise(leaves(docs, tampered).withColumn("__tie", F.monotonically_increasing_id()))
    placed = numbered(held, ["source"], ["doc_id", "leaf", "__tie"], "pos", "total")
    most = placed.agg(F.max("total")).first()[0] or 0
    low = tables(placed.select("source", "pos", "total", F.col("doc_id").alias("id"), F.col("leaf").alias("node"), "changed"), most, depth)
    ordered = materialise(numbered(low[-1].select("source", "top"), [], ["source"], "pos", "total"))
    sources = ordered.count()
    high = tables(ordered.select(none("string").alias("source"), "pos", "total", none("long").alias("id"), F.col("top").alias("node"), none("string").alias("changed")), sources, depth)
    root = (high[-1].select("top").first() or [None])[0]
    trunks = paths_down(high[0], down(high, depth), depth).select(F.col("block").alias("__pos"), F.col("path").alias("trunk"))
    trunks = ordered.join(trunks, F.col("pos") == F.col("__pos")).select(F.col("source").alias("__source"), F.col("top").alias("subroot"), "trunk")
    given = with_paths(low[0], down(low, depth)).join(trunks, F.col("source").eqNullSafe(F.col("__source")))
    given = given.select("total", "ids", "nodes", "changed", "subroot", F.concat("above", "trunk").alias("path"))
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    schema = pa.schema([(c.split()[0], kind) for c, kind in zip(_ROWS.split(", "), kinds, strict=True)])

    @lean
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = levels(matrix(row["nodes"]), depth_of(row["total"], depth))
                own, n = Siblings(tree), len(tree[0])
                path = [(s["before"], s["after"]) for s in row["path"]]
                rest = "".join(b + a for b, a in path).encode()
                proofs = [digest(p + rest).decode() for p in own.proofs()] or [digest(rest).decode()] * n
                start = tree[0]
                if row["changed"]:
                    other = matrix(row["changed"])
                    start = np.where(other[:, :1] > 0, other, start)
                met = [x.tobytes() for x in own.folded(start)]
                climbed = {x: climb(x, path).decode() for x in set(met)}
                folded = [climbed[x] for x in met]
                leaves_ = [x.tobytes().decode() for x in tree[0]]
                columns = [row["ids"], leaves_, [row["subroot"]] * n, [root] * n, proofs, folded, [x == root for x in folded]]
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema=schema)

    return given.mapInArrow(prove, _ROWS)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, with rows of an even CRC-32 of their id tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)


_ENC = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END"
_H = lambda text: "sha256(" + " || ".join(_ENC.format(c) for c in (*FIELDS[:-1], text)) + ")"
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substring(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295) AS crc
  FROM documents
), leaves AS MATERIALIZED (
  SELECT source, doc_id, {_H("text")} AS leaf, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN {_H("replace(text, chr(10), '')")} ELSE {_H("text")} END AS met FROM d
), l AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), tree AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS node FROM l
  UNION ALL SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY source, lvl, n, pos // 3
), sub AS MATERIALIZED (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), trunk AS (
  SELECT 0 AS lvl, pos, n, subroot AS node FROM sub
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM trunk WHERE n > 1 GROUP BY lvl, n, pos // 3
), fold AS (
  SELECT source, pos AS own, 0 AS lvl, pos, n, met AS node FROM l
  UNION ALL SELECT f.source, f.own, f.lvl + 1, f.pos // 3, (f.n + 2) // 3, sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.node ELSE t.node END, '' ORDER BY t.pos))
  FROM fold f JOIN tree t ON t.source IS NOT DISTINCT FROM f.source AND t.lvl = f.lvl AND t.pos // 3 = f.pos // 3 WHERE f.n > 1 GROUP BY f.source, f.own, f.lvl, f.n, f.pos
), climb AS (
  SELECT f.source, f.own, 0 AS lvl, s.pos, s.n, f.node FROM fold f JOIN sub s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
  UNION ALL SELECT c.source, c.own, c.lvl + 1, c.pos // 3, (c.n + 2) // 3, sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.node ELSE t.node END, '' ORDER BY t.pos))
  FROM climb c JOIN trunk t ON t.lvl = c.lvl AND t.pos // 3 = c.pos // 3 WHERE c.n > 1 GROUP BY c.source, c.own, c.lvl, c.n, c.pos
), low AS (
  SELECT l.source, l.pos, coalesce(string_agg(t.node, '' ORDER BY t.lvl, t.pos), '') AS proof
  FROM l LEFT JOIN tree t ON t.source IS NOT DISTINCT FROM l.source AND t.n > 1 AND t.pos // 3 = l.pos // CAST(pow(3, t.lvl + 1) AS BIGINT) AND t.pos <> l.pos // CAST(pow(3, t.lvl) AS BIGINT)
  GROUP BY l.source, l.pos
), high AS (
  SELECT s.source, coalesce(string_agg(t.node, '' ORDER BY t.lvl, t.pos), '') AS proof
  FROM sub s LEFT JOIN trunk t ON t.n > 1 AND t.pos // 3 = s.pos // CAST(pow(3, t.lvl + 1) AS BIGINT) AND t.pos <> s.pos // CAST(pow(3, t.lvl) AS BIGINT)
  GROUP BY s.source
)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, sha256(low.proof || high.proof) AS proof_sha256, c.node AS folded_root, c.node = r.node AS verified
FROM l JOIN sub s ON s.source IS NOT DISTINCT FROM l.source JOIN low ON low.source IS NOT DISTINCT FROM l.source AND low.pos = l.pos
  JOIN high ON high.source IS NOT DISTINCT FROM l.source JOIN climb c ON c.source IS NOT DISTINCT FROM l.source AND c.own = l.pos AND c.n = 1, (SELECT node FROM trunk WHERE n = 1) r
"""
