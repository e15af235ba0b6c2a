"""Near copies by Jaccard similarity of word shingles, exactly: what SimHash links is verified, what it can't see is found by prefixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repseq.llm.textcore import blocks, lean, scrambled
from repseq.operators.components import connected_components
from repseq.operators.shared import compact, free_shuffles, small_side, stored

#: Words of a shingle.
WORDS = 5
#: Least similarity of near copies, as a fraction.
SIMILAR = (4, 5)
#: Different texts that say which shingles are common, and in how many of them one is. It changes cost, never pairs.
ORDER_TEXTS = 16_000
COMMON = 2
#: Rows of one shingle that are lined up together.
LIST_ROWS = 50_000
#: Postings that a task sorts at a time, and that a bucket is planned for; most partitions of buckets.
FLUSH = 1 << 18
BUCKET = 300_000
PARTITIONS = 100_000
#: Times that components are joined by their nearest pairs before all pairs of different ones are sought.
ROUNDS = 1
#: Parity bits for each shingle of a set.
PARITY = 4
#: Sets that a task remembers, so as not to send out copies again.
SEEN = 200_000

def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[slice, list[np.ndarray], np.ndarray]]:
    """Of each block: its texts, their different shingle hashes (ascending), and their fingerprints. A text of fewer words is one shingle; one without words has none."""
    from repseq.llm.simhash import majority, shingle_hashes

    for block in blocks(texts):
        hashes, offs = shingle_hashes(block, width)
        yield slice(block.lo, block.hi), [np.unique(hashes[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], majority(hashes, offs)


def node_of(shingles: np.ndarray) -> int:
    """Equal sets have equal numbers."""
    return xxhash.xxh64_intdigest(shingles.tobytes(), 5) - (1 << 63)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit, of at least ``PARITY`` bits a shingle. Two sets differ in at least as many shingles as their parities in bits."""
    bits = max(64, 1 << (PARITY * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("at"))


def token_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)`` of ``(at, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets, _ in shingle_sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), lists(sets)], ["node", "shingles"])

    return docs.select("text").mapInArrow(lean(run), "node long, shingles array<long>")


def common_shingles(docs: DataFrame, width: int, texts: int = ORDER_TEXTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles that several of a sample of different texts have, ascending, in how many, and the sampled share of all rows."""
    share = min(1.0, texts / max(docs.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit("order"), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = docs.where(draw < share).select("at", "text").dropDuplicates(["at"])
    found = token_sets(some, width).select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).toArrow()
    keys, n = found.column("s").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(keys)
    out = keys[order], n[order], share
    del found, keys, n, some
    free_shuffles(docs.sparkSession)
    return out


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, at, node, size, fp, odd)`` of every row: its set of shingles in short, ``odd`` its parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets, fps in shingle_sets(batch.column("text"), width):
                own = [batch.column(c).slice(at.start, len(sets)) for c in ("doc_id", "at")]
                new = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array(fps.view(np.int64)), lists([parities(s) for s in sets])]
                yield pa.RecordBatch.from_arrays([*own, *new], ["doc_id", "at", "node", "size", "fp", "odd"])

    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, at long, node long, size int, fp long, odd array<long>")


def packed(*columns: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then all second ones, so that high zeros lie together and the shuffle's compression removes them."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def unpacked(data: bytes, kinds: Sequence[type]) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw, n, out, at = np.frombuffer(data, np.uint8), len(data) // sum(sizes), [], 0
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


_POSTING = (np.uint64, np.int64, np.int32, np.int32)  # token (as a step from the one before), node, size, position
_DEALT = np.int32(1 << 30)  # a flag in the position


def postings(docs: DataFrame, width: int, similar: tuple[int, int], buckets: int) -> DataFrame:
    """``(bucket, data)``: the prefixes of all sets, dealt into buckets by token. Two similar sets share a token of their prefixes.

    Shingles are ordered by how many texts of a sample have them, then by hash: one
    order for all rows. Of n shingles, an overlap of at least ``similar`` x n with
    another set cannot avoid the first n - ceil(similar x n) + 1. A token that the sample
    says more than ``LIST_ROWS`` rows have goes to several buckets, by node. A task sends a set out once, as
    long as it remembers it, and sorts ``FLUSH`` postings at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width))  # shingles of a bounded sample
    num, den = similar

    def dealt(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        token, lot, node, size, pos = (np.concatenate([o[c] for o in out]) for c in range(5))
        bucket = (np.where(lot > 0, scrambled(token + lot.astype(np.uint64)), token) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.lexsort((token, bucket))
        token, node, size, bucket = token[order], node[order], size[order], bucket[order]
        pos = np.where(lot > 0, pos | _DEALT, pos)[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets + 1), append=np.uint64(buckets + 1)))
        data = [packed(np.diff(token[a:b], prepend=np.uint64(0)), node[a:b], size[a:b], pos[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), pa.array(data, pa.binary())], ["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, share = shared.value
        seen: set[int] = set()
        out: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            for s in (s for _, sets, _ in shingle_sets(batch.column("text"), width) for s in sets):
                node = node_of(s)
                if not len(s) or node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                n = len(s)
                lot = np.zeros(n, np.int32)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    often = np.where(keys[at] == s, counts[at], 0)
                    order = np.argsort(often, kind="stable")
                    s, often = s[order], often[order]
                    lots = np.ceil(often / share / LIST_ROWS).astype(np.int64)
                    if lots.max() > 1:
                        own = scrambled(s ^ np.uint64(node & (1 << 64) - 1)) >> np.uint64(33)
                        lot = np.where(lots > 1, own.astype(np.int64) % np.maximum(lots, 1) + 1, 0).astype(np.int32)
                p = n - -(-num * n // den) + 1
                out.append((s[:p], lot[:p], np.full(p, node, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)))
                held += p
                if held > FLUSH:
                    yield dealt(out)
                    out, held = [], 0
        if out:
            yield dealt(out)

    return docs.select("text").mapInArrow(lean(run), "bucket int, data binary")


def shared_tokens(docs: DataFrame, width: int, similar: tuple[int, int], expected: int) -> DataFrame:
    """``(token, node, size, held)`` of the postings whose token another set has, ``held`` by how many, and two sets to try each with (or null).

    ``before`` comes before it in an order that differs from token to token; ``centre`` is that
    set of the list that has the smallest share of rarer shingles, so in a group of copies the least changed one.
    """
    buckets = max(1, -(-expected // BUCKET))
    names = ["token", "node", "size", "held", "before", "before_size", "centre", "centre_size"]

    def listed(parts: list[bytes]) -> pa.RecordBatch:
        columns = [unpacked(p, _POSTING) for p in parts]
        token = np.concatenate([np.cumsum(c[0]) for c in columns])
        node, size, pos = (np.concatenate([c[k] for c in columns]) for k in (1, 2, 3))
        del columns
        order = np.lexsort((node, scrambled(token ^ node.view(np.uint64)), token))
        token, node, size, pos = token[order], node[order], size[order], pos[order]
        same = token[1:] == token[:-1]
        once = np.concatenate([[True], ~(same & (node[1:] == node[:-1]))])
        token, node, size, pos = token[once], node[once], size[once], pos[once]
        same = np.concatenate([[False], token[1:] == token[:-1], [False]])
        use = np.flatnonzero(same[:-1] | same[1:] | (pos & _DEALT > 0))
        token, node, size, pos, dealt = token[use], node[use], size[use], pos[use] & ~_DEALT, pos[use] & _DEALT
        first = np.diff(token, prepend=token[:1] ^ np.uint64(1)) != 0 if len(token) else np.zeros(0, bool)
        rank = np.cumsum(first) - 1
        middle = np.lexsort((node, pos / size, token))[first][rank]
        held = np.where(dealt > 0, dealt, np.bincount(rank)[rank] if len(rank) else 0).astype(np.int32)  # the parts of a list that was dealt out agree
        before, alone = np.arange(len(node)) - 1, middle == np.arange(len(node))
        others = [pa.array(c[k], mask=m) for k, m in ((before, first), (middle, alone)) for c in (node, size)]
        return pa.RecordBatch.from_arrays([*map(pa.array, (token.view(np.int64), node, size, held)), *others], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for k, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
                if k != bucket and parts:
                    yield listed(parts)
                    parts = []
                bucket = k
                parts.append(data.as_py())
        if parts:
            yield listed(parts)

    dealt = postings(docs, width, similar, buckets)
    dealt = dealt.repartition(min(buckets, PARTITIONS), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lean(run), "token long, node long, size int, held int, before long, before_size int, centre long, centre_size int")


def similar_links(docs: DataFrame, rows: DataFrame, width: int, similar: tuple[int, int], kept: list[DataFrame]) -> DataFrame:
    """``(src, dst)``: pairs of different nodes whose components are those of all pairs of at least that Jaccard similarity.

    First candidates: nodes whose SimHash fingerprints differ in two bits or fewer, found
    by probing parts of correlated bits, and of each list of a shared token every node with the one
    beside it and the one in the centre. No group gives more of them than its rows have tokens. Of those that pass the
    parities, the nearest of each node is decided on the whole sets, which gives components; then ``ROUNDS``
    times the nearest of each component in another one.
    Then all pairs of different components that share a token early enough in both prefixes,
    ordered by how many sets hold each token, fit by size and pass the parities are decided
    on the whole sets. Places, sizes and parities never rule out a similar pair, so none is lost.
    """
    from repseq.llm.simhash import links, plan

    num, den = similar
    some = stored(rows.where("size > 0").groupBy("node").agg(F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("odd").alias("odd")), kept)
    folded = lambda a, b: f"CASE WHEN SIZE({a}) > SIZE({b}) THEN ZIP_WITH(SLICE({a}, 1, SIZE({b})), SLICE({a}, SIZE({b}) + 1, SIZE({b})), (x, y) -> x ^ y) ELSE {a} END"
    differ = f"AGGREGATE(ZIP_WITH({folded('a', 'b')}, {folded('b', 'a')}, (x, y) -> BIT_COUNT(x ^ y)), 0, (s, x) -> s + x)"

    def passed(pairs: DataFrame) -> DataFrame:
        """Pairs that fit by size and parities, with the number of differing parities."""
        left = some.select(F.col("node").alias("src"), F.col("size").alias("n"), F.col("odd").alias("a"))
        right = some.select(F.col("node").alias("dst"), F.col("size").alias("m"), F.col("odd").alias("b"))
        both = pairs.join(left, "src").join(right, "dst").where(f"{den}L * LEAST(n, m) >= {num}L * GREATEST(n, m)")
        return both.selectExpr("src", "dst", f"{differ} AS d", "n + m AS all").where(f"{num + den}L * d <= {den - num}L * all").select("src", "dst", "d")

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("at").alias("key"))).alias("r")
        reps = small_side(rows.join(wanted, "node", "left_semi").groupBy("node").agg(least).select("r.id", "r.key"))
        texts = docs.join(reps, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("at") == F.col("key")), "left_semi").select("at", "text").dropDuplicates(["at"])
        return stored(token_sets(texts, width), kept)

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("node").alias("src"), F.col("shingles").alias("a")), "src").join(sets.select(F.col("node").alias("dst"), F.col("shingles").alias("b")), "dst")
        return both.where(f"{num + den}L * SIZE(ARRAY_INTERSECT(a, b)) >= {num}L * (SIZE(a) + SIZE(b))").select("src", "dst")  # read once, for components, which keep what they read

    def joined(groups: DataFrame) -> DataFrame:
        """The least pairs that have these components: rounds over them are fewer than over all pairs."""
        return groups.where("node <> component").select(F.col("node").alias("src"), F.col("component").alias("dst"))

    def labelled(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs with the components ``g`` and ``h`` of their ends."""
        out = pairs.join(groups.select(F.col("node").alias("src"), F.col("component").alias("g")), "src", "left").join(groups.select(F.col("node").alias("dst"), F.col("component").alias("h")), "dst", "left")
        return out.withColumn("g", F.coalesce("g", "src")).withColumn("h", F.coalesce("h", "dst"))

    expected = rows.agg(F.sum(F.col("size") * (den - num) / den + 1)).first()[0] or 0
    listed = stored(shared_tokens(docs, width, similar, int(expected)), kept)
    first_of = stored(some.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n")), kept)
    fps = first_of.select("fp")
    near = links(fps, plan(fps)).join(first_of.select(F.col("fp").alias("src"), F.col("least").alias("one")), "src").join(first_of.select(F.col("fp").alias("dst"), F.col("least").alias("other")), "dst").select("one", "other")
    equal = some.join(first_of.where("n > 1").select("fp", "least"), "fp").where("node <> least").select(F.col("node").alias("one"), F.col("least").alias("other"))
    tried = F.explode(F.array(F.struct(F.col("before").alias("other"), F.col("before_size").alias("m")), F.struct(F.col("centre").alias("other"), F.col("centre_size").alias("m"))))
    beside = listed.select("node", "size", tried.alias("t")).where(f"t.other IS NOT NULL AND {den}L * LEAST(size, t.m) >= {num}L * GREATEST(size, t.m)").select(F.col("node").alias("one"), F.col("t.other").alias("other"))
    pairs = near.unionAll(equal).unionAll(beside).select(F.greatest("one", "other").alias("src"), F.least("one", "other").alias("dst")).distinct()
    pairs, _ = compact(passed(pairs))
    sets = sets_of(pairs)
    asked, _ = compact(pairs.select(F.explode(F.array("src", "dst")).alias("end"), F.struct("d", "src", "dst").alias("p")).groupBy("end").agg(F.min("p").alias("p")).select("p.src", "p.dst").distinct())
    groups = small_side(connected_components(verified(asked, sets)))
    for _ in range(ROUNDS):
        across = labelled(pairs.join(asked, ["src", "dst"], "left_anti"), groups).where("g <> h")
        nearest = across.select(F.explode(F.array("g", "h")).alias("end"), F.struct("d", "src", "dst").alias("p")).groupBy("end").agg(F.min("p").alias("p"))
        more, _ = compact(nearest.select("p.src", "p.dst").distinct())
        asked = asked.unionAll(more)
        groups = small_side(connected_components(joined(groups).unionAll(verified(more, sets))))
    # rank: where the token stands in the set's prefix, tokens of shorter lists before; those that no other set has come first of all
    prefix = lambda n: f"({n} - ({num}L * {n} + {den - 1}) DIV {den} + 1)"
    rank = F.expr(f"{prefix('size')} + 1") - F.row_number().over(Window.partitionBy("node").orderBy(F.desc("held"), F.desc("token")))
    found = listed.select("token", "node", "size", rank.alias("rank")).join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    per = found.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
    mixed = stored(found.join(per.where("parts > 1").select("token", F.col("top.component").alias("main")), "token"), kept)
    x = mixed.where("component <> main").select("token", F.col("node").alias("src"), F.col("size").alias("n"), F.col("rank").alias("i"), F.col("component").alias("g"))
    y = mixed.select("token", F.col("node").alias("dst"), F.col("size").alias("m"), F.col("rank").alias("j"), F.col("component").alias("h"), "main")
    # prefixes of similar sets share not one token but `more` further ones, so one that stands before the last `more` in both
    more = f"(({num}L * (n + m) + {num + den - 1}) DIV {num + den} - ({num}L * GREATEST(n, m) + {den - 1}) DIV {den})"
    fits = f"{den}L * LEAST(n, m) >= {num}L * GREATEST(n, m) AND i <= {prefix('n')} - {more} AND j <= {prefix('m')} - {more}"
    across = x.join(y, "token").where(f"g <> h AND (h = main OR dst < src) AND {fits}").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    rest, _ = compact(passed(across).select("src", "dst"))
    return joined(groups).unionAll(verified(rest, sets_of(rest)))


def similar_groups(docs: DataFrame, kept: list[DataFrame], width: int = WORDS, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``(doc_id, at, root)`` of every row; ``at`` is a hash of its text. Rows have one root if a chain of near copies joins them; rows without words are one group.

    ``kept`` gets the tables behind it, to be released when the result has been used.
    """
    docs = with_text_key(docs)
    rows = stored(set_rows(docs, width), kept)
    joined = small_side(connected_components(similar_links(docs, rows, width, similar, kept)).select("node", F.col("component").alias("root")))
    return rows.select("doc_id", "at", "node").join(joined, "node", "left").select("doc_id", "at", F.coalesce("root", "node").alias("root"))
