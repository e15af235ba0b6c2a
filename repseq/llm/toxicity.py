"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repseq.llm.learning import DECISION, best_cut, labelled_sample, remainder, settled_cut, shifted, sigmoid
from repseq.llm.textcore import LOWER, LOWER_WORD, Block, Slices, blocks, lean, scrambled, segment_sums

#: Buckets of the embedding table, as a power of two.
HASH_BITS = 20
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Bytes of a word's beginning that have embeddings of their own, next to the whole word.
PREFIXES = (4, 6)
#: Labelled rows of each class to learn from, and the longest text among them.
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 1 << 14
FOLDS = 4
#: Buckets of words that tell the language, as a power of two; texts for which the common cut counts in a language's own.
LANGUAGE_BITS = 16
POOLED = 20


def word_keys(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of each word of a block (whole word, then its beginnings; a word no longer than a beginning has none of it: 0), and the first word of each text (and the end)."""
    buf = LOWER[block.buf]
    starts, ends, firsts = block.words(LOWER_WORD, buf)
    slices = Slices(buf)
    keys = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint64)
    keys[:, 0] = slices.hashes(starts, ends)
    for k, size in enumerate(PREFIXES, 1):
        longer = ends - starts > size
        keys[longer, k] = scrambled(slices.hashes(starts[longer], starts[longer] + size) + np.uint64(size))
    return keys, firsts


class Table:
    """Hashed embeddings. A bucket knows the key it belongs to; any other key that falls into it, and key 0, has the zero vector."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, bits: int = HASH_BITS):
        """Of keys that share a bucket the one of the longest vector has it."""
        self.shift = np.uint64(64 - bits)
        order = np.argsort(np.linalg.norm(vectors, axis=1), kind="stable")
        self.row = np.zeros(1 << bits, np.int32)
        self.row[(keys[order] >> self.shift).astype(np.int64)] = order + 1
        self.keys = np.concatenate([np.zeros(1, np.uint64), keys])
        self.vectors = np.concatenate([np.zeros((1, vectors.shape[1]), np.float32), vectors.astype(np.float32)])

    def rows(self, keys: np.ndarray) -> np.ndarray:
        row = self.row[(keys >> self.shift).astype(np.int64)]
        return np.where(self.keys[row] == keys, row, 0)


@dataclass
class Net:
    """One filter bank a width, ReLU of the maximum over a text, and a linear output."""

    banks: list[np.ndarray]  # width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    last: float

    def pooled(self, x: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each text that has words, and the word where it begins. Past a text's end are zero vectors."""
        n = len(x)
        ends = np.repeat(firsts[1:], np.diff(firsts))
        best, where = [], []
        for bank in self.banks:
            y = x @ bank[0]
            for k in range(1, len(bank)):
                step = x[k:] @ bank[k]
                step[np.arange(n - k) + k >= ends[: n - k]] = 0
                y[: n - k] += step
            top = np.maximum.reduceat(y, firsts[:-1], axis=0)
            best.append(top)
            if self.track:
                hit = np.flatnonzero((y == np.repeat(top, np.diff(firsts), axis=0)).ravel())
                word, f = hit // y.shape[1], hit % y.shape[1]
                at = np.zeros(top.shape, np.int64)
                at[np.searchsorted(firsts, word[::-1], "right") - 1, f[::-1]] = word[::-1]
                where.append(at)
        return np.concatenate(best, axis=1), np.concatenate(where, axis=1) if self.track else np.zeros(0)

    track = False


@dataclass
class Languages:
    """Which language a text is in, by the words it has: log-odds of hashed words against all languages together."""

    names: list[str]
    weights: np.ndarray  # 2**LANGUAGE_BITS x languages

    def of(self, keys: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The number of each text's language; the last number, of none, without words."""
        n = len(firsts) - 1
        out = np.full(n, len(self.names))
        some = np.flatnonzero(np.diff(firsts) > 0)
        if len(some) and self.names:
            total = segment_sums(self.weights[(keys >> np.uint64(64 - LANGUAGE_BITS)).astype(np.int64)], firsts)
            out[some] = total[some].argmax(axis=1)
        return out


def learned_languages(keys: np.ndarray, firsts: np.ndarray, langs: Sequence[str | None]) -> Languages:
    names = sorted({x for x in langs if x is not None})
    number = {x: k for k, x in enumerate(names)}
    of = np.repeat(np.array([number.get(x, -1) for x in langs]), np.diff(firsts))
    known = of >= 0
    bucket = (keys[known] >> np.uint64(64 - LANGUAGE_BITS)).astype(np.int64)
    counts = np.bincount(bucket * len(names) + of[known], minlength=len(names) << LANGUAGE_BITS).reshape(1 << LANGUAGE_BITS, -1) if names else np.zeros((1 << LANGUAGE_BITS, 0))
    share = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts))
    return Languages(names, (np.log(share) - np.log(share.mean(axis=1, keepdims=True)) if names else share).astype(np.float32))


@dataclass
class Model:
    """``cuts``: the logit that is predicted toxic, of each of ``langs`` and, last, of a text without words."""

    table: Table
    net: Net
    langs: Languages
    cuts: np.ndarray

    def logits(self, block: Block) -> np.ndarray:
        return self.judged(block)[0]

    def judged(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Logits and numbers of the languages of a block's texts."""
        keys, firsts = word_keys(block)
        out = np.full(block.n, -8.0)
        some = np.diff(firsts) > 0
        if some.any():
            rows = self.table.rows(keys)
            x = self.table.vectors[rows[:, 0]]
            for k in range(1, rows.shape[1]):
                x += self.table.vectors[rows[:, k]]
            own = np.append(firsts[:-1][some], firsts[-1])
            best, _ = self.net.pooled(x, own)
            out[some] = np.maximum(best + self.net.bias, 0) @ self.net.out + self.net.last
        return out, self.langs.of(keys[:, 0], firsts)

    def scores(self, block: Block) -> np.ndarray:
        """0 to 1; a text reaches ``DECISION`` where its logit reaches the cut of its language."""
        logits, lang = self.judged(block)
        return shifted(logits, self.cuts[lang])


def train(rows: np.ndarray, firsts: np.ndarray, labels: np.ndarray, vectors: np.ndarray, epochs: int = 2, step: int = 64, rate: float = 0.05, seed: int = 3) -> Net:
    """Adagrad on the logistic loss, batches of ``step`` texts. ``vectors`` (row 0: unknown, stays zero) is changed in place."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    net = Net([rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters).astype(np.float32), 0.0)
    for bank in net.banks:  # the first filter of each width starts from the log-odds
        bank[:, :, 0] = 0
        bank[:, 0, 0] = 1
    net.out[::FILTERS] = 1
    net.track = True
    sums = {"v": np.full(vectors.shape, 1e-6, np.float32), "bias": np.full(n_filters, 1e-6), "out": np.full(n_filters, 1e-6), "last": 1e-6, "banks": [np.full(b.shape, 1e-6, np.float32) for b in net.banks]}
    texts = np.flatnonzero(np.diff(firsts))
    for _ in range(epochs):
        order = rng.permutation(texts)
        for lo in range(0, len(order), step):
            some = order[lo : lo + step]
            lens = firsts[some + 1] - firsts[some]
            own = np.concatenate([[0], np.cumsum(lens)])
            words = np.arange(own[-1]) - np.repeat(own[:-1] - firsts[some], lens)
            of = rows[words]
            x = vectors[of].sum(axis=1)
            best, where = net.pooled(x, own)
            act = np.maximum(best + net.bias, 0)
            error = (sigmoid(act @ net.out + net.last) - labels[some]) / len(some)
            grad_out, grad_last = act.T @ error, error.sum()
            back = error[:, None] * net.out * (act > 0)
            grad_bias = back.sum(axis=0)
            for b, bank in enumerate(net.banks):
                d = back[:, b * FILTERS : (b + 1) * FILTERS]
                at = where[:, b * FILTERS : (b + 1) * FILTERS]
                stop = np.broadcast_to(own[1:, None], at.shape)
                grad_bank = np.zeros_like(bank)
                for k in range(len(bank)):
                    word = at + k
                    inside = (word < stop) & (d != 0)
                    t, f = np.nonzero(inside)
                    w, dd = word[inside], d[inside]
                    np.add.at(grad_bank[k].T, f, dd[:, None] * x[w])
                    grad_x = dd[:, None] * bank[k].T[f]
                    rows_of = of[w]
                    for c in range(rows_of.shape[1]):
                        r, place = np.unique(rows_of[:, c], return_inverse=True)
                        g = np.zeros((len(r), DIM), np.float32)
                        np.add.at(g, place, grad_x)
                        sums["v"][r] += g * g
                        vectors[r] -= rate * g / np.sqrt(sums["v"][r])
                vectors[0] = 0
                sums["banks"][b] += grad_bank**2
                bank -= rate * grad_bank / np.sqrt(sums["banks"][b])
            for name, grad in (("bias", grad_bias), ("out", grad_out)):
                sums[name] += grad**2
                setattr(net, name, (getattr(net, name) - rate * grad / np.sqrt(sums[name])).astype(np.float32))
            sums["last"] += grad_last**2
            net.last -= rate * grad_last / sums["last"] ** 0.5
    net.track = False
    return net


def fit(sample: Sequence[tuple[str, str | None, int]], seed: int = 3) -> Model:
    """Learns from nine tenths of the sample; the other tenth sets the cuts, one a language.

    A text's language is told from its words, by what ``lang`` of the sampled rows says of words. A language's cut
    is that of best balanced accuracy on its texts, drawn towards the cut of all
    languages as if that came from ``POOLED`` texts of the rarer class: with few texts it is near the
    common one, with many its own. Only words and beginnings that at least two texts have get an embedding. It starts
    from the smoothed log-odds of the word.
    """
    labels = np.array([y for _, _, y in sample], np.int64)
    if len(sample) < 2 or labels.min() == labels.max():
        bias = 0.0 if not len(sample) else 4.0 * (2 * int(labels[0]) - 1)
        net = Net([np.zeros((1, DIM, FILTERS), np.float32)], np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32), bias)
        return Model(Table(np.zeros(0, np.uint64), np.zeros((0, DIM), np.float32)), net, Languages([], np.zeros((1, 0), np.float32)), np.zeros(1))
    held = np.arange(len(sample)) % 10 == 9
    texts = pa.array([t for t, _, _ in sample], pa.string())
    got = [word_keys(b) for b in blocks(texts)]
    keys = np.concatenate([k for k, _ in got])
    firsts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in got]))])
    text = np.repeat(np.arange(len(sample)), np.diff(firsts))
    langs = learned_languages(keys[:, 0], firsts, [x for _, x, _ in sample])
    known = np.unique(keys.ravel())
    place = np.stack([np.searchsorted(known, keys[:, k]).astype(np.int32) for k in range(keys.shape[1])], axis=1)
    del keys, got
    learn = ~held[text]
    once = np.unique(np.repeat(text[learn], place.shape[1]) * len(known) + place[learn].ravel())
    has, who = once % len(known), once // len(known)
    yes = np.bincount(has, labels[who], len(known))
    all_ = np.bincount(has, minlength=len(known))
    use = (all_ >= 2) & (known != 0)
    total_yes, total = labels[~held].sum(), (~held).sum()
    odds = np.log((yes + 0.5) / (total_yes + 1)) - np.log((all_ - yes + 0.5) / (total - total_yes + 1))
    rng = np.random.default_rng(seed)
    number = np.where(use, np.cumsum(use), 0).astype(np.int32)
    vectors = np.zeros((int(use.sum()) + 1, DIM), np.float32)
    vectors[1:] = rng.normal(0, 0.02, (len(vectors) - 1, DIM))
    vectors[1:, 0] = (np.clip(odds, -3, 5) * all_ / (all_ + 10.0))[use] / 3
    lens = np.diff(firsts)
    net = train(number[place][learn], np.concatenate([[0], np.cumsum(lens[~held])]), labels[~held], vectors, seed=seed)
    model = Model(Table(known[use], vectors[1:]), net, langs, np.zeros(len(langs.names) + 1))
    logits, lang = (np.concatenate(x) for x in zip(*(model.judged(b) for b in blocks(texts)), strict=True))
    model.cuts[:] = common = settled_cut(logits[held], labels[held])
    for k in range(len(langs.names)):
        own = held & (lang == k)
        rarer = min((labels[own] == 0).sum(), (labels[own] == 1).sum())
        if rarer:
            model.cuts[k] = (rarer * best_cut(logits[own], labels[own]) + POOLED * common) / (rarer + POOLED)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, lang_cut)`` of every whole text, of the text alone; ``lang_cut`` names the language whose cut it was held to.

    Repeated rows get equal scores, null is the empty text, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**HASH_BITS buckets and the sample's words, whatever the input
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs.names, None], object)
        for batch in batches:
            for block in blocks(batch.column("text")):
                logits, lang = model.judged(block)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.lo, block.n), pa.array(shifted(logits, model.cuts[lang])), pa.array(names[lang], pa.string())], ["doc_id", "score", "lang_cut"])

    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, lang_cut string")


def classified(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_cut of every document; labels are learned from rows that are not held out.

    A null doc_id is not held out and not learned from. Null, empty and wordless texts
    get the lowest score; repeated rows get equal scores; an empty table gives no rows;
    without labels every score is the same.
    """
    model = fit(labelled_sample(docs, labels, "toxic", remainder(FOLDS) != 2, rows, max_bytes))
    held = F.coalesce(remainder(FOLDS) == 2, F.lit(False)).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held, "score", (F.col("score") >= DECISION).cast("int").alias("predicted"), "lang_cut")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
