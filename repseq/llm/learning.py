"""What the classifiers share: folds, bounded labelled samples and a calibrated decision."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of each class in a labelled sample.
CLASS_BYTES = 6 << 20
#: A score of this or more is predicted as 1.
DECISION = 0.3


def remainder(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, max_bytes: int, class_bytes: int = CLASS_BYTES) -> list[tuple[str, str | None, int]]:
    """At most ``rows`` of each class, and ``class_bytes`` of their text, as ``(text, lang, label)``, from labelled rows that ``learn`` allows.

    The pick is by a hash of doc_id, so it does not depend on how tables are laid out;
    texts over ``max_bytes`` are not picked. A doc_id labelled both ways counts as 0. The picked ids are at most
    three times ``rows``, the first by that hash, so they are broadcast to the scan of the documents and nothing
    is shuffled by text. Equal texts of one class count once.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.where("label IN (0, 1)")
    per = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in per.items():
        share = F.when(F.col("label") == k, min(1.0, 1.2 * rows / max(n, 1))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(draw < share).orderBy(draw, "doc_id").limit(3 * rows).select(F.col("doc_id").alias("id"), "label")
    short = docs.select("doc_id", "text", "lang").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    found = short.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).select("text", "lang", "label", F.xxhash64("doc_id").alias("at")).orderBy("at", F.xxhash64("text"), "lang").limit(3 * rows).collect()
    out, seen, taken, size = [], set(), {0: 0, 1: 0}, {0: 0, 1: 0}
    for r in sorted(found, key=lambda r: (r.at, r.text or "")):
        key = (r.text or "", r.label)
        if key not in seen and taken[r.label] < rows and size[r.label] < class_bytes:
            seen.add(key)
            taken[r.label] += 1
            size[r.label] += len(r.text or "")
            out.append((r.text or "", r.lang, r.label))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The cut of best balanced accuracy; amid the widest gap among equals."""
    if not len(logits) or labels.min() == labels.max():
        return 0.0
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    low = np.concatenate([[0], np.cumsum(y == 0)]) / (y == 0).sum()
    high = 1 - np.concatenate([[0], np.cumsum(y == 1)]) / (y == 1).sum()
    cuts = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    gap = np.concatenate([[0], x[1:] - x[:-1], [0]])
    gain = np.round(low + high, 9)
    gain[1:-1][gap[1:-1] == 0] = -1
    best = np.flatnonzero(gain == gain.max())
    return float(cuts[best[np.argmax(gap[best])]])


def settled_cut(logits: np.ndarray, labels: np.ndarray, weight: int = 100) -> float:
    """``best_cut``, drawn towards the logit of ``DECISION`` as if that were the cut of ``weight`` rows of the rarer class."""
    rarer = min((labels == 0).sum(), (labels == 1).sum()) if len(labels) else 0
    return (rarer * best_cut(logits, labels) + weight * math.log(DECISION / (1 - DECISION))) / (rarer + weight)


def shifted(logits: np.ndarray, cut: float) -> np.ndarray:
    """Scores of 0 to 1 that reach ``DECISION`` where logits reach ``cut``."""
    return sigmoid(logits - cut + math.log(DECISION / (1 - DECISION)))
