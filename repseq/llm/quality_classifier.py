"""Document quality: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.llm.learning import DECISION, labelled_sample, remainder, settled_cut, shifted, sigmoid
from repseq.llm.textcore import LOWER, Block, Slices, blocks, lean, scrambled

#: Weights, as a power of two.
HASH_BITS = 20
#: Labelled rows of each class to learn from, and the longest text among them.
SAMPLE_ROWS = 2_500
SAMPLE_BYTES = 1 << 14
FOLDS = 5
#: What a whole text of one n-gram weighs.
SCALE = 20.0

_LETTER = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_KIND = np.where(_SPACE, 0, np.where(_LETTER, 1, 2)).astype(np.int8)
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])


def ngrams(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of a block: 64-bit keys, the text of each, and its value.

    Words are runs of letters and digits (bytes of non-ASCII characters included) and
    runs of other signs. Keys are words, pairs of words, and triples of word shapes; a
    shape says whether a word is lower case, capitalised, upper case, a number or which
    sign, and whether it repeats the word before. Values are shares of the text's keys
    of that sort, so long and short texts weigh the same.
    """
    n = len(block.buf)
    none = np.zeros(0, np.int64)
    if n == 0:
        return np.zeros(0, np.uint64), none, np.zeros(0)
    kind = _KIND[block.buf]
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    edge[1:n] = kind[1:] != kind[:-1]
    edge[block.offs] = True
    cuts = np.flatnonzero(edge)
    at = kind[cuts[:-1]] > 0
    starts, ends = cuts[:-1][at], cuts[1:][at]
    if not len(starts):
        return np.zeros(0, np.uint64), none, np.zeros(0)
    text = np.searchsorted(block.offs, starts, "right") - 1
    words = Slices(LOWER[block.buf]).hashes(starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[block.buf])])
    digit = np.concatenate([[0], np.cumsum((block.buf >= 0x30) & (block.buf <= 0x39))])
    n_upper = upper[ends] - upper[starts]
    shape = np.where(n_upper == 0, 1, np.where((n_upper == 1) & _UPPER[block.buf[starts]], 2, 3)).astype(np.uint64)
    shape[digit[ends] > digit[starts]] = 4
    sign = kind[starts] == 2
    shape[sign] = words[sign]
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    shape = scrambled(shape * np.uint64(2) + again)
    keys, of = [words], [text]
    pair = text[1:] == text[:-1]
    keys.append(scrambled(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[pair])
    of.append(text[1:][pair])
    triple = text[2:] == text[:-2]
    keys.append(scrambled(shape[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + shape[1:-1] * np.uint64(0x165667B19E3779F9) + shape[2:])[triple])
    of.append(text[2:][triple])
    value = []
    for own in of:
        share = SCALE / 3 / np.maximum(np.bincount(own, minlength=block.n), 1)
        value.append(share[own])
    return np.concatenate(keys), np.concatenate(of), np.concatenate(value)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    cut: float

    def logits(self, block: Block) -> np.ndarray:
        """Sparse dot products of the texts of a block with the weights."""
        keys, text, value = ngrams(block)
        bucket = (keys >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        return self.bias + np.bincount(text, self.weights[bucket] * value, block.n)

    def scores(self, block: Block) -> np.ndarray:
        return shifted(self.logits(block), self.cut)


def follow_the_leader(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """FTRL-proximal on sparse rows (buckets, values): weights and bias.

    Each coordinate has its own rate, alpha / (beta + root of its squared gradients);
    l1 keeps coordinates with little evidence at exactly zero.
    """
    z, g2 = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    zb = gb = 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            own, sq = z[at], np.sqrt(g2[at])
            w = np.where(np.abs(own) <= l1, 0.0, -(own - np.sign(own) * l1) / ((beta + sq) / alpha + l2))
            b = -zb / ((beta + gb**0.5) / alpha)
            error = float(sigmoid(np.array(w @ x + b))) - labels[k]
            grad = error * x
            grown = np.sqrt(g2[at] + grad * grad)
            z[at] += grad - (grown - sq) / alpha * w
            g2[at] += grad * grad
            zb += error - ((gb + error * error) ** 0.5 - gb**0.5) / alpha * b
            gb += error * error
    weights = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(g2)) / alpha + l2))
    return weights.astype(np.float32), -zb / ((beta + gb**0.5) / alpha)


def fit(sample: Sequence[tuple[str, str | None, int]]) -> Model:
    """Learns from nine tenths of the sample and sets the cut on the rest. Without both classes every logit is that of the class there is."""
    labels = np.array([y for _, _, y in sample], np.int64)
    if len(sample) < 2 or labels.min() == labels.max():
        bias = 0.0 if not len(sample) else 4.0 * (2 * int(labels[0]) - 1)
        return Model(np.zeros(1 << HASH_BITS, np.float32), bias, 0.0)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for block in blocks(pa.array([t for t, _, _ in sample], pa.string())):
        keys, text, value = ngrams(block)
        bucket = (keys >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        both, place = np.unique(text * (1 << HASH_BITS) + bucket, return_inverse=True)
        total = np.bincount(place, value, len(both))
        cuts = np.searchsorted(both, np.arange(block.n + 1) << HASH_BITS)
        rows += [(both[a:b] & ((1 << HASH_BITS) - 1), total[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    held = np.arange(len(rows)) % 10 == 9
    learn = np.flatnonzero(~held)
    weights, bias = follow_the_leader([rows[k] for k in learn], labels[learn])
    logits = np.array([weights[at] @ x + bias for at, x in (rows[k] for k in np.flatnonzero(held))])
    return Model(weights, bias, settled_cut(logits, labels[held]))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every whole text. Null and empty texts have the score of no words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**HASH_BITS weights, whatever the input
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.lo, block.n), pa.array(shared.value.scores(block))], ["doc_id", "score"])

    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classified(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def classified(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels are learned from rows that are not held out.

    A null doc_id is not held out and not learned from. Repeated rows get equal scores;
    an empty table gives no rows; without labels every score is the same.
    """
    model = fit(labelled_sample(docs, labels, "quality", remainder(FOLDS) != 0, rows, max_bytes))
    held = F.coalesce(remainder(FOLDS) == 0, F.lit(False)).alias("held_out")
    return score_quality(docs, model).select("doc_id", held, "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))
