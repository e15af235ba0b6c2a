"""Personal data in texts, plain and disguised.

Plain identifiers are found in the text as it is. Disguised ones are found by transducers,
each a rewriting of the text that remembers what it replaced: look-alike letters and
digits become ASCII and invisible characters go, at and dot signs in words or brackets
become signs, spelled digits become digits. Identifiers are sought in what comes out, and their
spans are carried back through the rewritings to the characters of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from repseq.llm.textcore import lean
from repseq.operators.shared import small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# --- plain identifiers --------------------------------------------------------------
# Possessive repeats and a look behind keep each search linear in the text: a match never begins inside a run whose start has failed.

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """``local@label.label…``: for each sign, the run of letters before it, not beyond the match before, and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[Span]:
    """Four numbers with dots between them, none above 255."""
    for m in _IP.finditer(text):
        if all(len(part := g.lstrip("0")) <= 3 and int(part or 0) <= 255 for g in m.groups()):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    """13 to 19 digits, at most one space or hyphen between two, with a right check digit."""
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 38 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    """A plus sign and 9 to 15 digits."""
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


def plain(text: str) -> dict[str, list[Span]]:
    return {kind: list(find(text)) for kind, find in FINDERS.items()}


# --- transducers --------------------------------------------------------------------


class Tape:
    """A text, and the rewritings that made it out of its source."""

    def __init__(self, text: str):
        self.text = text
        self.edits: list[tuple[list[int], list[int], list[int], list[int]]] = []

    def put(self, text: str) -> None:
        """Another text of the same length, character for character."""
        self.text = text

    def replace(self, pieces: list[tuple[int, int, str]]) -> None:
        """Puts strings in place of slices, which are given in order and do not overlap."""
        if not pieces:
            return
        out, new, new_end, old, old_end = [], [], [], [], []
        at = size = 0
        for lo, hi, s in pieces:
            out += [self.text[at:lo], s]
            size += lo - at
            new.append(size)
            size += len(s)
            new_end.append(size)
            old.append(lo)
            old_end.append(hi)
            at = hi
        self.text = "".join([*out, self.text[at:]])
        self.edits.append((new, new_end, old, old_end))

    def source(self, span: Span) -> Span:
        """Where a slice of the text stands in the source; what it touches of a replaced piece counts whole."""
        begin, end = span
        for edit in reversed(self.edits):
            begin, end = self._back(begin, edit)[0], self._back(end - 1, edit)[1]
        return begin, end

    @staticmethod
    def _back(at: int, edit: tuple[list[int], list[int], list[int], list[int]]) -> Span:
        """What the character at a place was made of."""
        new, new_end, old, old_end = edit
        k = bisect_right(new, at) - 1
        if k >= 0 and at < new_end[k]:
            return old[k], old_end[k]
        moved = at if k < 0 else at - new_end[k] + old_end[k]
        return moved, moved + 1


# Letters of other scripts that look like ASCII letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ѵ": "v", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "υ": "u", "ι": "i", "κ": "k",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "L", "ӏ": "l", "Ӏ": "I", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
# The digits in words, English, German, French, Spanish.
DIGITS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# Words for the signs, and ends of domains, none of them a common word, that make a bare "at" one.
AT_WORDS, DOT_WORDS = "at|ät|arroba|arobase", "dot|punkt|point|punto"
DOMAINS = "com|org|net|edu|gov|mil|info|biz|io|dev|app|eu|uk|ca|au|de|ch|fr|nl|pt|mx|br|pl|jp|cn|ru|example|invalid"

_IN, _OUT = r"[(\[{<][ \t]{0,2}", r"[ \t]{0,2}[)\]}>]"
_GAP = r"[ \t]{1,3}"
_WORD_DOT = rf"(?:{_GAP}(?:{DOT_WORDS}){_GAP}|[ \t]{{0,3}}{_IN}(?:{DOT_WORDS}|\.){_OUT}[ \t]{{0,3}})"
_LABEL, _NAME = "[A-Za-z0-9-]{1,63}", "[A-Za-z0-9_%+.-]{1,64}"
_AT_SIGN = rf"(?:[ \t]{{0,3}}{_IN}(?:{AT_WORDS}|@){_OUT}[ \t]{{0,3}})"
_AT_WORD = rf"(?:(?:{_GAP}|[-_*])(?:{AT_WORDS}|@)(?:{_GAP}|[-_*]))"
_ANY_DOT = rf"(?:\.|{_WORD_DOT})"
_HIDDEN_AT = re.compile(
    rf"(?<=[A-Za-z0-9_%+.-])(?:(?P<sign>{_AT_SIGN})(?={_LABEL}(?:{_ANY_DOT}{_LABEL}){{1,8}})"
    rf"|(?P<word>{_AT_WORD})(?={_LABEL}(?:{_ANY_DOT}{_LABEL}){{0,6}}{_WORD_DOT}(?:{DOMAINS})(?![A-Za-z0-9-]))"
    rf"|(?P<known>{_AT_WORD})(?={_LABEL}(?:\.{_LABEL}){{0,6}}\.(?:{DOMAINS})(?![A-Za-z0-9-])))",
    re.IGNORECASE,
)
_DOTTED_NAME = re.compile(rf"(?:[A-Za-z0-9_%+.-]{{1,64}}{_WORD_DOT}){{1,4}}[A-Za-z0-9_%+.-]{{1,64}}\Z", re.IGNORECASE)
_HOST = re.compile(rf"@{_LABEL}(?:{_ANY_DOT}{_LABEL}){{1,9}}", re.IGNORECASE)
_DOT_IN = re.compile(_WORD_DOT, re.IGNORECASE)
_DIGIT = "|".join(sorted(DIGITS, key=lambda w: (-len(w), w)))
_JOIN = rf"(?:{_WORD_DOT}|[ \t]{{1,2}}|[ \t]?[-,.][ \t]?)"
_CHAIN = re.compile(rf"(?<![^\W_])(?:{_DIGIT}|[0-9]+)(?:{_JOIN}(?:{_DIGIT}|[0-9]+)(?![^\W_])){{2,}}", re.IGNORECASE)
_CHAIN_PART = re.compile(rf"(?P<digit>{_DIGIT})(?![^\W_])|(?P<number>[0-9]+)|(?P<dot>{_WORD_DOT})|(?P<gap>[ \t,.-]+)", re.IGNORECASE)
_PLUS = re.compile(r"(?<![^\W_])[(\[{<]?plus[)\]}>]?[ \t]{0,2}(?=[(]?[0-9])", re.IGNORECASE)
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl|]{1,3}(?=[ -]?[0-9])")


@lru_cache(maxsize=1)
def folding() -> tuple[dict[int, str], re.Pattern, re.Pattern]:
    """Characters -> the ASCII one they stand for, a pattern of those, and one of invisible characters.

    By rule: decimal digits of any script, and whatever compatibility normalisation makes one printable ASCII character; the rest are fixed values.
    """
    table = {ord(k): v for k, v in LOOKALIKES.items()}
    hidden = []
    for cp in [*range(0x80, 0x3400), *range(0xA000, 0xABFF), *range(0xFE00, 0x10000), *range(0x10000, 0x11FFF), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200), *range(0x1FBF0, 0x1FBFA)]:
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind == "Cf" or 0xFE00 <= cp <= 0xFE0F:
            hidden.append(c)
        elif kind == "Nd":
            table.setdefault(cp, str(unicodedata.digit(c)))
        elif len(x := unicodedata.normalize("NFKC", c)) == 1 and " " <= x <= "~":
            table.setdefault(cp, x)
    of = lambda chars: "[" + "".join(f"{a}-{b}" if a != b else a for a, b in ranges(sorted(chars))) + "]"
    return table, re.compile(of(map(chr, table))), re.compile(of(hidden) + "+")


def ranges(chars: list[str]) -> Iterator[tuple[str, str]]:
    """Runs of consecutive characters."""
    begin = last = None
    for c in chars:
        if last is None or ord(c) != ord(last) + 1:
            if begin is not None:
                yield begin, last
            begin = c
        last = c
    if begin is not None:
        yield begin, last


def fold(tape: Tape) -> None:
    """Look-alikes become ASCII, invisible characters go; letters between digits that look like digits become them."""
    table, pattern, hidden = folding()
    if pattern.search(tape.text):
        tape.put(tape.text.translate(table))
    tape.replace([(*m.span(), "") for m in hidden.finditer(tape.text)])
    tape.replace([(*m.span(), "".join("0" if c in "Oo" else "1" for c in m[0])) for m in _LETTER_DIGIT.finditer(tape.text)])


def spell(tape: Tape) -> None:
    """Chains of three or more digit words and numbers, with gaps, commas, hyphens or dot words between, become digits.

    A word alone at the end of a chain of numbers stays, as it may belong to the sentence. Between two
    words a gap goes, otherwise it stays.
    """
    pieces = []
    for m in _CHAIN.finditer(tape.text):
        parts = [(p.lastgroup, *p.span(), p[0]) for p in _CHAIN_PART.finditer(tape.text, *m.span())]
        tokens = [k for k, p in enumerate(parts) if p[0] in ("digit", "number")]
        dotted = any(p[0] == "dot" for p in parts)
        turned = set()
        for n, k in enumerate(tokens):
            near = [parts[j][0] for j in (*tokens[max(0, n - 1) : n], *tokens[n + 1 : n + 2])]
            if parts[k][0] == "digit" and ("digit" in near or len(near) == 2 or dotted):
                turned.add(k)
        for k, (kind, lo, hi, text) in enumerate(parts):
            if k in turned:
                pieces.append((lo, hi, DIGITS[text.lower()]))
            elif kind == "dot" and (k - 1 in turned or k - 1 in tokens) and (k + 1 in turned or k + 1 in tokens):
                pieces.append((lo, hi, "."))
            elif kind == "gap" and k - 1 in turned and k + 1 in turned and "." not in text:
                pieces.append((lo, hi, ""))
    tape.replace(pieces)
    tape.replace([(*m.span(), "+") for m in _PLUS.finditer(tape.text)])


def sign(tape: Tape) -> None:
    """At and dot signs in brackets or words become signs where a name stands before and a host after.

    In brackets always. The bare word "at", or a sign with gaps around, only before a host that ends in a known
    domain: after a dot in brackets or as a word, or, if the name has a digit or a sign in it or the at is a sign, after any.
    Bare dot words count in the host that follows, as long as no dot has stood in it, and in the name before such an at.
    """
    text, pieces = tape.text, []
    for m in _HIDDEN_AT.finditer(text):
        before = text[max(0, m.start() - 320) : m.start()]
        name = re.search(rf"{_NAME}\Z", before)
        if m["known"] and "@" not in m[0] and not re.search(r"[0-9._%+-]", name[0].strip(".")):
            continue
        dotted = _DOTTED_NAME.search(before)
        if dotted:
            shift = m.start() - len(before)
            pieces += [(shift + d.start(), shift + d.end(), ".") for d in _DOT_IN.finditer(before, dotted.start())]
        pieces.append((*m.span(), "@"))
    tape.replace(merged(pieces))
    pieces = []
    for m in _HOST.finditer(tape.text):
        stood = 0
        for d in _DOT_IN.finditer(tape.text, *m.span()):
            if "." in tape.text[m.start() : d.start()].replace("(.)", "") and d[0].strip(" \t")[0] not in "([{<" and not stood:
                break
            stood += 1
            pieces.append((*d.span(), "."))
    tape.replace(pieces)


def merged(pieces: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """In order; of overlapping ones the first."""
    out: list[tuple[int, int, str]] = []
    for p in sorted(set(pieces)):
        if not out or p[0] >= out[-1][1]:
            out.append(p)
    return out


def disguised(text: str) -> dict[str, list[Span]]:
    """Spans, in the source, of what is found after the transducers; empty lists where they change nothing."""
    tape = Tape(text)
    for step in (fold, spell, sign):
        step(tape)
    if tape.text == text:
        return {kind: [] for kind in KINDS}
    return {kind: [tape.source(s) for s in spans] for kind, spans in plain(tape.text).items()}


# --- tables -------------------------------------------------------------------------


@lru_cache(maxsize=1)
def triggers() -> dict[str, str]:
    """Patterns for Arrow's linear matcher, without which a text has none of a kind or no disguise."""
    table, _, hidden = folding()
    odd = "[" + "".join(f"\\x{{{ord(a):X}}}-\\x{{{ord(b):X}}}" for a, b in ranges(sorted({*map(chr, table), *(c for c in map(chr, range(0x110000)) if hidden.match(c))}))) + "]"
    bracket = rf"[(\[{{<][ \t]*(?:{AT_WORDS}|@|{DOT_WORDS}|\.)[ \t]*[)\]}}>]"
    dots = rf"[A-Za-z0-9_%+.-][ \t]+(?:{DOT_WORDS})[ \t]+[A-Za-z0-9]"
    known = rf"[ \t*_-](?:{AT_WORDS}|@)[ \t*_-]+[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:{DOMAINS})"
    digits = rf"(?:{_DIGIT})[ \t,.-]{{1,3}}(?:{_DIGIT}|[0-9])|plus[)\]}}>]?[ \t]*\(?[0-9]|[0-9][OoIl|]+[ -]?[0-9]"
    return {
        "email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]",
        "hidden": f"(?i:{bracket}|{dots}|{known}|{digits})", "odd": odd,
    }


def found(texts: pa.Array) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """Of each text, its plain spans and those that the transducers add: of the same kind and not inside a plain one."""
    texts = pc.fill_null(texts, "")
    may = {k: pc.match_substring_regex(texts, p).to_pylist() if len(p) > 1 else pc.match_substring(texts, p).to_pylist() for k, p in triggers().items()}
    out = []
    for i in range(len(texts)):
        base: dict[str, list[Span]] = {k: [] for k in KINDS}
        more: dict[str, list[Span]] = {k: [] for k in KINDS}
        if any(m[i] for m in may.values()):
            text = texts[i].as_py()
            base |= {k: list(FINDERS[k](text)) for k in KINDS if may[k][i]}
            if may["hidden"][i] or may["odd"][i]:
                for k, spans in disguised(text).items():
                    more[k] = [s for s in dict.fromkeys(spans) if not any(b[0] <= s[0] and s[1] <= b[1] for b in near(base[k], s))]
        out.append((base, more))
    return out


def near(spans: list[Span], s: Span) -> list[Span]:
    """The last of ordered spans that begins where ``s`` does or before."""
    k = bisect_right(spans, (s[0], 1 << 62)) - 1
    return spans[k : k + 1] if k >= 0 else []


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


_OUT_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The four numbers and ``base_sha256`` are of the plain identifiers alone, as they stand in the
    text; ``spans`` has those and what the transducers add (``n_added`` of them), each ``kind:start:end`` in code points of the source,
    end exclusive, by kind, then start. An added span is never inside a plain one of its kind; where it
    holds one and more, both stand.

    Defined results: null and empty texts have none; repeated rows give repeated rows; null doc_id
    stays null; other columns are not read; an empty table gives no rows. Whole texts are read, at any
    length: each search is linear, but for names (64), labels (63) and hosts (10 labels) in a disguise, which have their own
    lengths. One pass over the rows, no shuffle.
    """
    small_batches(docs.sparkSession)
    names = [c.split()[0] for c in _OUT_SCHEMA.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = found(batch.column("text"))
            counts = [[len(base[k]) for base, _ in both] for k in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in both]
            spans = [joined({k: [*base[k], *more[k]] for k in KINDS}) for base, more in both]
            columns = [batch.column("doc_id"), *counts, digests, spans, [sum(map(len, more.values())) for _, more in both]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, _OUT_SCHEMA)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
