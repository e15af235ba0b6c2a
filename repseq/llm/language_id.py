"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repseq.llm.learning import remainder
from repseq.llm.textcore import give_back, lean, scrambled
from repseq.operators.shared import materialise

ORDER = 5
FOLDS = 4
#: Characters of each language to learn from, and the longest text among them.
SAMPLE_CHARS = 1_500_000
SAMPLE_TEXT = 50_000
#: Characters of all languages together: with more languages each has fewer, so that the models, which are broadcast, have a bound of their own.
TOTAL_CHARS = 48_000_000
#: Texts of each language that set the rejection.
CALIBRATION_TEXTS = 150
#: Characters scored at a time; longer texts go in pieces.
PIECE = 1 << 18
CACHE = 1 << 19
UNKNOWN = "und"

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_SPACE = 32


class _Letters:
    """Which code points are letters; made once a process."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.array([chr(c).isalpha() for c in range(0x110000)])
        return cls.table


def symbols(texts: Sequence[str], before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, each run of anything else as one space, ``ORDER`` - 1 spaces in front of each text; and the text of each symbol (-1: in front).

    ``before`` is the end of the symbols of the text that the first of ``texts`` goes on with.
    """
    lower = [t.lower() for t in texts]
    code = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.array([len(t) for t in lower])
    text = np.repeat(np.arange(len(lower)), lens)
    letter = _Letters.of()[code]
    after = np.zeros(len(code), bool)
    after[1:] = letter[:-1] & (text[1:] == text[:-1])
    if before is not None and len(code):
        after[0] = before[-1] != _SPACE
    keep = letter | after
    own = np.where(letter, code, _SPACE)[keep]
    text = text[keep]
    pad = ORDER - 1
    out = np.full(len(own) + pad * len(lower), _SPACE, np.uint64)
    of = np.full(len(out), -1, np.int64)
    at = np.arange(len(own)) + pad * (text + 1)
    out[at], of[at] = own, text
    if before is not None:
        out[:pad] = before
    return out, of


def gram_keys(seq: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the ``order`` symbols up to each one from the ``order``-th on."""
    n = len(seq) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, order, np.uint64)
    for k in range(order):
        key += (seq[order - 1 - k : len(seq) - k] + np.uint64(1)) * _MULTIPLIERS[k]
    return scrambled(key)


@dataclass
class LanguageModel:
    """Log-probabilities of seen n-grams and log back-off weights of seen contexts, by order, each in a sorted array of hashes."""

    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of each row of ``ORDER`` symbols, given those before it."""
        out = np.full(len(grams), self.floor)
        for n in range(1, ORDER + 1):
            if n > 1:
                own = row_keys(grams[:, ORDER - n : ORDER - 1])
                at, found = _lookup(self.contexts[n - 1], own)
                out = out + np.where(found, self.backoff[n - 1][at], 0)
            own = row_keys(grams[:, ORDER - n :])
            at, found = _lookup(self.keys[n - 1], own)
            out = np.where(found, self.logp[n - 1][at], out)
        return out


def _lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)


def row_keys(rows: np.ndarray) -> np.ndarray:
    """``gram_keys`` of each row."""
    key = np.full(len(rows), rows.shape[1], np.uint64)
    for k in range(rows.shape[1]):
        key += (rows[:, rows.shape[1] - 1 - k] + np.uint64(1)) * _MULTIPLIERS[k]
    return scrambled(key)


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> LanguageModel:
    """The model of different rows of ``ORDER`` symbols and their counts.

    The highest order has counts; a lower one, in how many different contexts its gram
    goes on to the left. Every order takes its discount n1 / (n1 + 2 n2) from each gram
    and gives what it took to the order below; the lowest gives it to all symbols alike,
    unseen ones as one more.
    """
    levels = [(grams, counts.astype(np.float64))]
    for _ in range(ORDER - 1):
        rows, _ = levels[-1]
        key = row_keys(rows[:, 1:])
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        levels.append((rows[first, 1:], np.bincount(place).astype(np.float64)))
    levels.reverse()
    model = LanguageModel([], [], [], [], 0.0)
    below = 1.0 / (len(levels[0][0]) + 1)
    prob: np.ndarray | None = None
    for n, (rows, count) in enumerate(levels, 1):
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        context = row_keys(rows[:, :-1]) if n > 1 else np.zeros(len(rows), np.uint64)
        contexts, place = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(place, count), np.bincount(place)
        gamma = discount * kinds / total
        if n > 1:
            at, found = _lookup(model.keys[-1], row_keys(rows[:, 1:]))
            assert found.all()
            below = prob[at]
        own = (count - discount) / total[place] + gamma[place] * below
        key = row_keys(rows)
        order = np.argsort(key)
        model.keys.append(key[order])
        model.logp.append(np.log(own[order]).astype(np.float32))
        model.contexts.append(contexts)
        model.backoff.append(np.log(gamma).astype(np.float32))
        if n == 1:
            model.floor = float(np.log(gamma[0] * below))
        prob = own[order]
    return model


def count_grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    seq, of = symbols(texts)
    if len(seq) < ORDER:
        return np.zeros((0, ORDER), np.uint64), np.zeros(0, np.int64)
    key = gram_keys(seq, ORDER)
    real = np.flatnonzero(of[ORDER - 1 :] >= 0)
    _, first, counts = np.unique(key[real], return_index=True, return_counts=True)
    at = real[first]
    return np.stack([seq[at + k] for k in range(ORDER)], axis=1), counts


@dataclass
class Identifier:
    """Models of ``langs``, in order of name; ``sharpness`` of the score; the rejection's mean, spreads and limit of each language."""

    langs: list[str]
    models: list[LanguageModel]
    sharpness: float = 1.0
    mean: np.ndarray | None = None
    symbol_sd: np.ndarray | None = None
    text_sd: np.ndarray | None = None
    limit: float = 6.0

    def __post_init__(self):
        self._keys = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._keys = None

    def gram_scores(self, seq: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Log-probabilities (symbols x languages). Grams seen before come from a table of fixed size, others from the models."""
        if self._keys is None:
            size = CACHE
            while size * len(self.langs) > CACHE * 16 and size > 1 << 12:
                size >>= 1
            self._keys, self._logp = np.zeros(size, np.uint64), np.zeros((size, len(self.langs)), np.float32)
        key = gram_keys(seq, ORDER)[real]
        slot = (key & np.uint64(len(self._keys) - 1)).astype(np.int64)
        missing = np.flatnonzero(self._keys[slot] != key)
        out = self._logp[slot]
        if len(missing):
            fresh, first, place = np.unique(key[missing], return_index=True, return_inverse=True)
            at = real[missing[first]]
            grams = np.stack([seq[at + k] for k in range(ORDER)], axis=1)
            own = np.stack([m.score(grams) for m in self.models], axis=1).astype(np.float32)
            out[missing] = own[place]
            slots = (fresh & np.uint64(len(self._keys) - 1)).astype(np.int64)
            self._keys[slots], self._logp[slots] = fresh, own
        return out

    def sums(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of whole texts (texts x languages), and their symbols. Long texts go in pieces, each after the end of the one before."""
        total, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)

        def add(seq: np.ndarray, of: np.ndarray, numbers: np.ndarray) -> None:
            real = np.flatnonzero(of[ORDER - 1 :] >= 0)
            if not len(real):
                return
            got, text = self.gram_scores(seq, real), of[ORDER - 1 :][real]
            cuts = np.flatnonzero(np.diff(text, prepend=-1))
            total[numbers[text[cuts]]] += np.add.reduceat(got, cuts, axis=0, dtype=np.float64)
            count[numbers] += np.bincount(text, minlength=len(numbers))

        group, size = [], 0
        for k, t in enumerate(texts):
            if len(t) > PIECE:
                before = np.full(ORDER - 1, _SPACE, np.uint64)
                for at in range(0, len(t), PIECE):
                    seq, of = symbols([t[at : at + PIECE]], before)
                    add(seq, of, np.array([k]))
                    before = seq[-(ORDER - 1) :]
                continue
            if group and size + len(t) > PIECE:
                add(*symbols([texts[i] for i in group]), np.array(group))
                group, size = [], 0
            group.append(k)
            size += len(t)
        if group:
            add(*symbols([texts[i] for i in group]), np.array(group))
        return total, count

    def identify(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy (nats a symbol; of the language taken) and whether it is rejected.

        The language of least cross-entropy; of equals, the first by name. A text
        without letters is ``und``, with score 0, and rejected.
        """
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        total, count = self.sums(texts)
        some = count > 0
        entropy = -total / np.maximum(count, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        odds = np.exp(-np.minimum((entropy - least[:, None]) * self.sharpness * np.sqrt(np.maximum(count, 1))[:, None], 60))
        score = np.where(some, 1 / odds.sum(axis=1), 0.0)
        rejected = ~some | (self.excess(least, count, best) > self.limit)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], score, np.where(some, least, 0.0), rejected

    def excess(self, entropy: np.ndarray, count: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """By how many standard deviations a text of that length is above its language's cross-entropy."""
        if self.mean is None:
            return np.zeros(len(entropy))
        spread = np.sqrt(self.symbol_sd[lang] ** 2 / np.maximum(count, 1) + self.text_sd[lang] ** 2)
        return (entropy - self.mean[lang]) / spread


def calibrate(found: Identifier, texts: Sequence[str], langs: Sequence[str]) -> None:
    """Sets, from texts that were not learned, the sharpness of the score and the rejection: half as far again as the farthest of texts recognised as their own language, and 6 standard deviations at least."""
    number = {x: k for k, x in enumerate(found.langs)}
    total, count = found.sums(texts)
    use = np.array([c > 0 and x in number for c, x in zip(count, langs, strict=True)], bool)
    n = len(found.langs)
    found.mean, found.symbol_sd, found.text_sd = np.full(n, np.inf), np.full(n, 2.0), np.full(n, 0.2)
    if not use.any():
        found.mean = None
        return
    truth = np.array([number.get(x, 0) for x in langs])[use]
    entropy, count = (-total / np.maximum(count, 1)[:, None])[use], count[use]
    right = entropy.argmin(axis=1) == truth
    for k in range(n):
        own = right & (truth == k)
        if own.sum() >= 10:
            e, c = entropy[own, k], count[own]
            found.mean[k] = np.average(e, weights=np.minimum(c, 2000))
            off = (e - found.mean[k]) ** 2
            found.symbol_sd[k] = np.sqrt(np.mean(off[c <= np.median(c)] * c[c <= np.median(c)])) + 0.5
            found.text_sd[k] = np.sqrt(np.mean(off[c >= np.median(c)])) + 0.02
    best = entropy.argmin(axis=1)
    far = found.excess(entropy[np.arange(len(best)), best], count, best)[right]
    far = far[np.isfinite(far)]
    found.limit = max(6.0, 1.5 * float(far.max())) if len(far) else 6.0
    margin = (entropy - entropy.min(axis=1, keepdims=True)) * np.sqrt(count)[:, None]
    losses = []
    for s in (0.5, 1.0, 2.0, 4.0, 8.0):
        p = np.exp(-np.minimum(margin * s, 60))
        losses.append((-np.log(np.maximum(p[np.arange(len(truth)), truth] / p.sum(axis=1), 1e-12)).mean(), -s))
    found.sharpness = -min(losses)[1]


def sampled(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, sample_text: int = SAMPLE_TEXT, total_chars: int = TOTAL_CHARS) -> DataFrame:
    """``(lang, text)``: of each language different texts of about ``sample_chars`` characters, or all it has, picked by a hash of the text; of many languages, so many of each as make ``total_chars`` together.

    A text of more than ``sample_text`` characters goes in pieces of that size: all of
    them, or, where they are more than ``sample_chars``, as many as make that, spread
    over the text. Copies count once, in the share of a language as in the sample.
    """
    most = -(-sample_chars // sample_text)
    size = F.length("text")
    n = F.ceil(size / F.lit(sample_text))
    at = lambda k: F.floor(k * n / F.least(n, F.lit(most))).cast("int") * sample_text + 1
    cut = F.transform(F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(most)) - 1), lambda k: F.substring(F.col("text"), at(k), F.lit(sample_text)))
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    pieces = known.select("lang", F.explode(F.when(size > sample_text, cut).otherwise(F.array("text"))).alias("text"))
    per = pieces.select("lang", F.xxhash64("text").alias("at"), size.alias("size")).distinct().groupBy("lang").agg(F.sum("size").alias("chars"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    rows = per.collect()  # one a language
    sample_chars = max(1, min(sample_chars, total_chars // max(len(rows), 1)))
    for r in rows:
        share = F.when(F.col("lang") == r.lang, F.lit(min(1.0, sample_chars / max(r.chars, 1)))).otherwise(share)
    picked = pieces.where(draw < share).distinct()
    running = F.sum(size).over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    return picked.withColumn("sofar", running).where(F.col("sofar") <= 2 * sample_chars + min(sample_text, sample_chars)).drop("sofar")


def train(docs: DataFrame, learn, sample_chars: int = SAMPLE_CHARS, sample_text: int = SAMPLE_TEXT) -> Identifier:
    """An identifier of the languages in ``docs.lang``, from rows that ``learn`` allows.

    One task a language makes its model of what ``sampled`` picks, so a task and the
    driver hold a sample and models of bounded size, and all models together those of ``TOTAL_CHARS`` characters. Every eighth text picked is kept
    for calibration instead. A language needs one text with a letter.
    """
    picked = materialise(sampled(docs.where(learn), sample_chars, sample_text))  # read twice
    test = F.pmod(F.xxhash64(F.lit("calibration"), "text"), F.lit(8)) == 0
    held = picked.where(test).select("lang", "text", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")).alias("n")).where(F.col("n") <= CALIBRATION_TEXTS).collect()

    def fit(table: pa.Table) -> pa.Table:
        grams, counts = count_grams([t for t in table.column("text").to_pylist()])
        if not len(grams):
            return pa.table({"lang": pa.array([], pa.string()), "model": pa.array([], pa.binary())})
        m = kneser_ney(grams, counts)
        out = io.BytesIO()
        parts = {f"{name}{k}": a for name in ("keys", "logp", "contexts", "backoff") for k, a in enumerate(getattr(m, name))}
        np.savez(out, floor=m.floor, **parts)
        return pa.table({"lang": table.column("lang").slice(0, 1).combine_chunks(), "model": pa.array([out.getvalue()], pa.binary())})

    models = {}
    for r in picked.where(~test).groupBy("lang").applyInArrow(fit, "lang string, model binary").toLocalIterator():
        with np.load(io.BytesIO(r.model)) as z:
            models[r.lang] = LanguageModel(*([z[f"{name}{k}"] for k in range(ORDER)] for name in ("keys", "logp", "contexts", "backoff")), float(z["floor"]))
    found = Identifier(sorted(models), [models[k] for k in sorted(models)])
    if found.langs:
        calibrate(found, [r.text for r in held], [r.lang for r in held])
    give_back()
    return found


def identified(docs: DataFrame, found: Identifier) -> DataFrame:
    """``docs`` plus lang_pred, lang_score, lang_entropy and lang_rejected, from whole texts. Columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(found)  # models of bounded samples
    docs = docs.drop("lang_pred", "lang_score", "lang_entropy", "lang_rejected")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                lang, score, entropy, rejected = own.identify([t or "" for t in part.column("text").to_pylist()])
                new = [pa.array(lang, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, "lang_pred", "lang_score", "lang_entropy", "lang_rejected"])

    new = StructType.fromDDL("lang_pred string, lang_score double, lang_entropy double, lang_rejected boolean")
    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, *new.fields]))


def learnable():
    """Rows to learn from: crc32 of doc_id as text, modulo 4, is not 2. Null doc_ids are not learned from."""
    return remainder(FOLDS) != 2


def recognised(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that language identification rejects: no letters, or far above the cross-entropy of the nearest language. Columns of its own names are given back as they were."""
    found = train(docs, learnable())
    own = ["lang_pred", "lang_score", "lang_entropy", "lang_rejected"]
    hidden = {c: f"__given_{c}" for c in docs.columns if c in own}
    out = identified(docs.withColumnsRenamed(hidden), found).where("NOT lang_rejected")
    return out.select(*(F.col(hidden.get(c, c)).alias(c) for c in docs.columns))


def predicted(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document.

    ``und`` (score 0) if the text is null or has no letter, or if no language could be
    learned; else one of the learned languages. Null doc_ids are not held out. An empty
    table gives no rows.
    """
    found = train(docs, learnable(), **options)
    rows = identified(docs.select("doc_id", "text"), found)
    held = F.coalesce(remainder(FOLDS) == 2, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held, "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
