"""Connected components of an edge table: what a task's own edges join, then alternating large-star and small-star."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from repseq.operators.shared import compact

#: Rows of the edge table in a file, so that a small table is not read by a task for each shuffle partition, and edges that a task joins at a time.
FILE_ROWS = 1 << 17


def linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of ``n`` nodes, the least node that edges a-b lead to: roots are hung below the least root beside them until none is beside another."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up


def _stars(e: DataFrame, loops: bool, most: int) -> DataFrame:
    """Edges ``(a, b)`` from each node to the least that ``most`` edges of a task lead to, task by task. ``loops``: also from the least to itself."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ends = pa.chunked_array([*table.column("a").chunks, *table.column("b").chunks])
        nodes = ends.unique()
        nodes = nodes.take(pc.sort_indices(nodes))
        a, b = np.split(pc.index_in(ends, value_set=nodes).to_numpy(), 2)
        root = linked(len(nodes), a, b)
        own = np.arange(len(nodes)) if loops else np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(own)), nodes.take(pa.array(root[own]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if held and sum(b.num_rows for b in held) + batch.num_rows > most:
                yield star(held)
                held = []
            held.append(batch)
        if held:
            yield star(held)

    return e.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in e.dtypes))


def _step(e: DataFrame) -> DataFrame:
    """Edges ``(a, b)``, a > b, after large-star and small-star."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    both = e.select(F.explode(ends).alias("p")).select("p.*")
    low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    pairs = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return large.join(low, "a").select(F.explode(pairs).alias("p")).select("p.*").where("a != b").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, most: int = FILE_ROWS) -> DataFrame:
    """``(node, component)`` for every node of an edge, component = smallest node reachable.

    Any orderable node type; nulls and self-loops add nothing. A task joins its edges of
    whole numbers or strings, ``most`` at a time, before they are kept; so a table of no more than that needs no round.
    Each round takes two map-side combined minima and two joins whose minimum side has unique keys, so a
    hub never gathers its neighbours in one task (its join partition can be split).
    The edge table is written to the shared folder once a round, in few files; the number of rounds
    is logarithmic in the longest path. An edgeless table gives an empty result.
    """
    a, b = F.col(src), F.col(dst)
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    kind = e.schema["a"].dataType
    known = isinstance(kind, IntegralType) or kind == StringType()  # Arrow has their order and their equality
    kept = (lambda few, n: _stars(few, n <= most, most)) if known else None
    e, n = compact(e, most, kept)
    seen = None
    for _ in range(max_rounds):
        if known and n <= most:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
        e, n = compact(_step(e), most, kept)
    else:
        raise RuntimeError(f"components not settled in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
