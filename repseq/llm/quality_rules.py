"""Quality rules as a short-circuit cascade, ordered by rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from repseq.llm.textcore import NOT_SPACE, Block, Slices, blocks, covered, lean, scrambled, segment_sums, window_hashes

WINDOW = 8
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 16 << 20
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """What rules ask of a block of texts; each part is computed when first asked for."""

    def __init__(self, block: Block):
        self.block, self._kept = block, {}

    def again(self) -> Text:
        """The same texts with what has been computed so far."""
        out = Text(self.block)
        out._kept = dict(self._kept)
        return out

    def _once(self, name: str, make: Callable):
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    @property
    def spans(self):
        return self._once("spans", lambda: self.block.words(NOT_SPACE))

    @property
    def slices(self) -> Slices:
        return self._once("slices", lambda: Slices(self.block.buf))

    def n_words(self) -> np.ndarray:
        return self._once("n_words", lambda: np.diff(self.spans[2]).astype(np.int64))

    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes of words that don't continue a character."""
        return self._once("word_chars", lambda: self.block.per_text(NOT_SPACE[self.block.buf] & ((self.block.buf & 0xC0) != 0x80)))

    def count(self, characters: str) -> np.ndarray:
        def make():
            table = np.zeros(256, bool)
            table[list(characters.encode())] = True
            return self.block.per_text(table[self.block.buf])

        return self._once("count " + characters, make)

    def n_symbols(self) -> np.ndarray:
        return self.count("#*$%&|<>")

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines that have a word: starts, ends, text."""

        def make():
            b = self.block
            breaks = np.flatnonzero(b.buf == 10)
            starts = np.union1d(breaks + 1, b.offs[:-1])
            ends = np.union1d(breaks, b.offs[1:])
            starts = starts[starts < len(b.buf)]
            starts = starts[b.buf[starts] != 10]
            ends = ends[np.searchsorted(ends, starts, "right")] if len(starts) else starts
            words = self.spans[0]
            some = np.searchsorted(words, ends) > np.searchsorted(words, starts)
            starts, ends = starts[some], ends[some]
            return starts, ends, np.searchsorted(b.offs, starts, "right") - 1

        return self._once("lines", make)

    def n_lines(self) -> np.ndarray:
        return np.bincount(self.lines()[2], minlength=self.block.n)

    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier one of their text."""

        def make():
            starts, ends, text = self.lines()
            keys = scrambled(self.slices.hashes(starts, ends) + text.astype(np.uint64))
            _, first = np.unique(keys, return_index=True)
            again = np.ones(len(keys), bool)
            again[first] = False
            return np.bincount(text[again], minlength=self.block.n).astype(np.int64)

        return self._once("n_dup_lines", make)

    def n_repeat_words(self) -> np.ndarray:
        """Words in windows of ``WINDOW`` words that their text has twice or more."""

        def make():
            starts, ends, firsts = self.spans
            out = np.zeros(self.block.n, np.int64)
            if len(starts) < WINDOW:
                return out
            text = np.repeat(np.arange(self.block.n), np.diff(firsts))
            keys = window_hashes(self.slices.hashes(starts, ends), WINDOW)
            whole = np.flatnonzero(text[: len(keys)] == text[WINDOW - 1 :])
            keys = scrambled(keys[whole] + text[whole].astype(np.uint64))
            order = np.argsort(keys)
            same = keys[order][1:] == keys[order][:-1]
            twice = np.zeros(len(keys), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            if not twice.any():
                return out
            hit = covered(whole[twice], WINDOW, len(starts))
            return segment_sums(hit, firsts)

        return self._once("n_repeat_words", make)

    def n_upper(self) -> np.ndarray:
        return self._once("n_upper", lambda: self.block.per_text((self.block.buf >= 65) & (self.block.buf <= 90)))

    def n_letters(self) -> np.ndarray:
        return self._once("n_letters", lambda: self.block.per_text(((self.block.buf | 32) >= 97) & ((self.block.buf | 32) <= 122)))


@dataclass(frozen=True)
class Rule:
    """``fails`` flags the texts of a block to reject."""

    name: str
    fails: Callable[[Text], np.ndarray]


#: The base of the contract.
BASE = (
    Rule("too_few_words", lambda t: t.n_words() < 20),
    Rule("repeats_itself", lambda t: 100 * t.n_repeat_words() > 30 * t.n_words()),
)
#: Production rules beyond the base: markup debris and tables, shouting, exclamations, copied lines, absurd words.
RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols() > t.n_words()),
    Rule("shouting", lambda t: 2 * t.n_upper() > t.n_letters()),
    Rule("exclamations", lambda t: 10 * t.count("!") > 3 * t.n_words()),
    Rule("copied_lines", lambda t: 10 * t.n_dup_lines() > 6 * t.n_lines()),
    Rule("word_length", lambda t: (2 * t.n_words() > t.word_chars()) | (t.word_chars() > 30 * t.n_words())),
)


def cascade(block: Block, rules: Sequence[Rule]) -> np.ndarray:
    """The number of the first rule that fails each text, or -1. A rule sees only texts that all before it passed."""
    failed = np.full(block.n, -1)
    left, text = np.arange(block.n), Text(block)
    for k, rule in enumerate(rules):
        if not len(left):
            break
        bad = rule.fails(text)
        if bad.any():
            failed[left[bad]] = k
            left = left[~bad]
            text = Text(text.block.take(~bad))
    return failed


def measured_order(sample: Sequence[str | None], rules: Sequence[Rule], before: Sequence[Rule] = (), rounds: int = 3) -> list[tuple[str, float, float]]:
    """``(rule, rejection rate, seconds a megabyte)`` in the order to run: rejection per cost, highest first.

    Measured on the texts that pass ``before``, with what those rules ask for already
    computed. After each choice the others are measured again on what it
    leaves, as long as that is something, so each figure is that of the rule in its place (least time of ``rounds``). The order
    changes what is spent, never which texts are kept. Ties and a rule that rejects
    nothing: cheaper first.
    """
    texts, left, found = [], list(rules), []
    for block in blocks(pa.array(list(sample), pa.string())):
        whole = Text(block)
        bad = np.zeros(block.n, bool)
        for rule in before:
            bad |= rule.fails(whole)
        texts.append(block.take(~bad))
    while left:
        measured, known = [], []
        for block in texts:
            text = Text(block)
            for shared in (*before, *(r for r in rules if r not in left)):
                shared.fails(text)
            known.append(text)
        for rule in left:
            least, bad = float("inf"), 0
            for _ in range(rounds):
                fresh = [text.again() for text in known]
                began, bad = time.perf_counter(), 0
                for text in fresh:
                    bad += int(rule.fails(text).sum())
                least = min(least, time.perf_counter() - began)
            n, size = sum(b.n for b in texts), sum(len(b.buf) for b in texts)
            measured.append((rule.name, bad / max(n, 1), least / max(size / 1e6, 1e-6)))
        measured.sort(key=lambda x: (-x[1] / max(x[2], 1e-9), x[2], x[0]))
        rule = next(r for r in left if r.name == measured[0][0])
        texts = [b.take(~rule.fails(Text(b))) for b in texts]
        if not sum(b.n for b in texts):
            return found + measured
        found.append(measured[0])
        left.remove(rule)
    return found


def sampled_texts(docs: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> list[str | None]:
    """At most ``rows`` texts of ``most`` bytes together, the first by hash, for estimates of cost and selectivity only; texts over 100,000 bytes are not sampled."""
    n = docs.count()
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= 100_000)
    share = min(1.0, max(0.01, 1.5 * rows / max(n, 1)))
    at = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    first = short.where(at < int(share * 1_000_000) + 1).select("text", F.octet_length("text").alias("size"), at.alias("at"), F.xxhash64("text").alias("h")).orderBy("at", "h").limit(rows)
    sofar = F.sum(F.coalesce("size", F.lit(0))).over(Window.orderBy("at", "h").rowsBetween(Window.unboundedPreceding, 0))
    return [r.text for r in first.withColumn("sofar", sofar).where(F.col("sofar") <= most).select("text").collect()]


def filter_quality(docs: DataFrame, rules: Sequence[Rule] = BASE + RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``failed_rule``: the first rule of the measured order that rejects the text, null if none does.

    Null text is the empty text. An empty table gives no rows. Column ``failed_rule``
    of the input, if any, is replaced.
    """
    by_name = {r.name: r for r in rules}
    order = [by_name[name] for name, _, _ in measured_order(sampled_texts(docs, sample_rows), rules)]
    names = np.array([r.name for r in order] + [None], object)
    docs = docs.drop("failed_rule")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed = [cascade(b, order) for b in blocks(batch.column("text"))]
            names_of = pa.array(names[np.concatenate(failed)] if failed else [], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names_of], [*batch.schema.names, "failed_rule"])

    schema = StructType([*docs.schema.fields, StructField("failed_rule", StringType())])
    return docs.mapInArrow(lean(run), schema)


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the five statistics of every whole text, ``base_failed``, ``kept`` and ``failed_rule``.

    The base rules decide first, since their statistics are asked of every text; the
    rest of ``rules`` run as a cascade, in measured order, on texts that passed. Null text has no words
    and fails the base, as does the empty text; repeated rows and ties are judged row
    by row; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    by_name = {r.name: r for r in rules}
    order = [by_name[name] for name, _, _ in measured_order(sampled_texts(docs, sample_rows), rules, BASE)]
    names = np.array([r.name for r in order] + [None], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                text = Text(block)
                stats = [getattr(text, name)() for name in STATS]
                base = np.zeros(block.n, bool)
                for rule in BASE:
                    base |= rule.fails(text)
                failed = np.full(block.n, -1)
                if not base.all():
                    failed[~base] = cascade(block.take(~base), order)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.lo, block.n),
                        *(pa.array(s, pa.int64()) for s in stats),
                        pa.array(base),
                        pa.array(~base & (failed < 0)),
                        pa.array(names[failed], pa.string()),
                    ],
                    ["doc_id", *STATS, "base_failed", "kept", "failed_rule"],
                )

    kinds = ", ".join(f"{s} long" for s in STATS)
    return docs.mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {kinds}, base_failed boolean, kept boolean, failed_rule string")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``failed_rule`` depends on the measured order, so the query leaves it out: reruns agree."""
    return quality_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("failed_rule")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents
), g AS (
  SELECT k, i, array_to_string(list_slice(w, i, i + 7), ' ') AS phrase FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), r AS (
  SELECT k, count(DISTINCT place) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS place FROM (SELECT k, i, count(*) OVER (PARTITION BY k, phrase) AS times FROM g) WHERE times > 1) GROUP BY k
), s AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs
  FROM d LEFT JOIN r USING (k)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_upper > n_letters OR 10 * n_bangs > 3 * n_words OR 10 * n_dup_lines > 6 * n_lines OR 2 * n_words > word_chars OR word_chars > 30 * n_words) AS kept
FROM f
"""
