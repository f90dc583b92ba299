"""Personal data: plain patterns, and disguised forms found behind an offset-preserving transducer.

The transducer rewrites a text character by character or token by token: look-alike letters and
digits to ASCII, digits written as words to digits, ``at`` and ``dot`` in their usual disguises to
``@`` and ``.``, the latter on both sides of the ``@`` and between the parts of an IP. Each output character keeps the source span it came from, so identifiers found
in the rewritten text are mapped back to source characters. Plain spans stay as they are; a
disguised one is added unless a span of its kind covers it.

Defined cases: a null text counts as empty and has no spans; every row is treated on its own;
spans are in code points, end exclusive. Texts of any length are scanned in linear time. Other
columns stay in ``mask`` and are ignored in ``find``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.llm.common import table_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Characters that look like an ASCII one, by the ASCII character.
LOOKALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıι", "j": "ј", "k": "κк",
    "l": "ӏⅼ", "m": "ⅿм", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "т", "u": "υս",
    "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уү", "z": "ᴢ", "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ",
    "I": "ІΙ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ",
    "Z": "Ζ", "@": "＠﹫", ".": "．․。", "-": "‐‑‒–−－", "+": "＋", "(": "（", ")": "）",
}
# Digits as words.
DIGIT_WORDS = {
    "0": ("zero", "null", "cero", "zéro", "oh"),
    "1": ("one", "eins", "uno", "un"),
    "2": ("two", "zwei", "zwo", "dos", "deux"),
    "3": ("three", "drei", "tres", "trois"),
    "4": ("four", "vier", "cuatro", "quatre"),
    "5": ("five", "fünf", "cinco", "cinq"),
    "6": ("six", "sechs", "seis"),
    "7": ("seven", "sieben", "siete", "sept"),
    "8": ("eight", "acht", "ocho", "huit"),
    "9": ("nine", "neun", "nueve", "neuf"),
}
AT_WORDS, DOT_WORDS = ("at", "arroba", "arobase", "ät"), ("dot", "punkt", "punto", "point")
DROPPED = "​‌‍⁠﻿­"

_CHARS = {other: plain for plain, others in LOOKALIKES.items() for other in others}
_CHARS |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}
_CHARS |= {c: "" for c in DROPPED}
_DIGITS = {word: digit for digit, words in DIGIT_WORDS.items() for word in words}
_SPELLED = "|".join(sorted(map(re.escape, _DIGITS), key=len, reverse=True))
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
#: A run of three or more spelled digits, or of digits and spelled digits.
DIGIT_RUN = re.compile(rf"(?<!\w)(?:(?:{_SPELLED}|[0-9]+)[ ,-]{{1,2}}){{2,}}(?:{_SPELLED}|[0-9]+)(?!\w)", re.I)
DIGIT_WORD = re.compile(rf"(?<!\w)(?:{_SPELLED})(?!\w)", re.I)
_OPEN, _CLOSE = r"\s{0,2}[\[({<]\s{0,2}", r"\s{0,2}[\])}>]\s{0,2}"
#: ``at`` in brackets, as a word, or as the sign itself.
AT = re.compile(rf"(?P<boxed>{_OPEN}(?:{_AT}|@){_CLOSE})|(?P<word>\s(?:{_AT})\s)|@", re.I)
_ANY_DOT = rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|\s(?:{_DOT})\s|\.)"
DOT = re.compile(_ANY_DOT, re.I)
HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_ANY_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}", re.I)
#: A disguised dot right before a place.
DOT_BEFORE = re.compile(rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|\s(?:{_DOT})\s)\Z", re.I)
#: No disguised dot is longer.
LONGEST_DOT = 8 + max(map(len, DOT_WORDS)) + 2
_DIGIT = rf"(?:(?:{_SPELLED})(?!\w)|[0-9]+)"
_PART = rf"{_DIGIT}(?:[ ,-]{{1,2}}{_DIGIT}){{0,2}}"
#: Four parts of up to three digits or spelled digits each, with dots of any form between them.
SPELLED_IP = re.compile(rf"(?<!\w){_PART}(?:{_ANY_DOT}{_PART}){{3}}(?!\w)", re.I)
IP_MEMBER = re.compile(rf"(?P<dot>{_ANY_DOT})|(?P<digit>{_SPELLED}|[0-9]+)|[ ,-]+", re.I)
NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|\s(?:{_DOT})\s)(?=[0-9])", re.I)
PLUS_WORD = re.compile(r"(?<!\w)(?:plus|más)\s{1,2}(?=[0-9]{7})", re.I)
_MARKS = re.compile("[" + re.escape("".join(sorted(_CHARS))) + "]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches of local part, ``@`` and dotted domain: each ``@`` with a domain looks
    back over its local part, so that long runs without one cost nothing."""
    spans, end = [], 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, m.end()))
            end = m.end()
    return spans


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def ips(text: str) -> list[Span]:
    fits = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
    return [m.span() for m in IP.finditer(text) if all(map(fits, m[0].split(".")))]


def cards(text: str) -> list[Span]:
    found = ((m.span(), _digits(m[0])) for m in CARD.finditer(text) if m.end() - m.start() >= 13)
    return [span for span, digits in found if 13 <= len(digits) <= 19 and luhn(digits)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> dict[str, list[Span]]:
    return {kind: find(text) for kind, find in FINDERS.items()}


class Rewriting:
    """A text under rewriting, with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ordered, disjoint spans; a replacement's characters stand for its whole span."""
        text, starts, ends, at = [], [], [], 0
        for start, end, new in edits:
            text += self.text[at:start], new
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            starts += [self.starts[start]] * len(new)
            ends += [self.ends[end - 1]] * len(new)
            at = end
        self.text = "".join((*text, self.text[at:]))
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of spelled digits become digits; what separates two of their members goes."""
    edits = []
    for run in DIGIT_RUN.finditer(text):
        if DIGIT_WORD.search(run[0]):
            for m in re.finditer(rf"({_SPELLED}|[0-9]+)|[ ,-]+", run[0], re.I):
                new = _DIGITS.get(m[0].lower(), m[0]) if m[1] else ""
                edits.append((run.start() + m.start(), run.start() + m.end(), new))
    return edits


def _spelled_ips(text: str) -> list[tuple[int, int, str]]:
    """Spelled digits, also single ones, and disguised dots inside the shape of an IP."""
    edits = []
    for run in SPELLED_IP.finditer(text):
        if IP.fullmatch(run[0]) is None:
            for m in IP_MEMBER.finditer(text, run.start(), run.end()):
                edits.append((*m.span(), "." if m["dot"] else _DIGITS.get(m[0].lower(), m[0]) if m["digit"] else ""))
    return edits


def _local_dots(text: str, end: int, floor: int) -> list[Span]:
    """Disguised dots between the tokens of the local part that ends at ``end``, in order."""
    dots: list[Span] = []
    while True:
        start = end
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start == end:  # nothing before the last dot
            return dots[-2::-1]
        dot = DOT_BEFORE.search(text, max(floor, start - LONGEST_DOT), start)
        if dot is None:
            return dots[::-1]
        dots.append(dot.span())
        end = dot.start()


def _addresses(text: str) -> list[tuple[int, int, str]]:
    """Disguised ``at`` and ``dot`` inside the shape of an address.

    A bare ``at`` counts only with a disguised dot: ``meet at example.com`` is no address.
    """
    edits, end = [], 0
    for at in AT.finditer(text):
        if at.start() < max(end, 1) or text[at.start() - 1] not in LOCAL:
            continue
        host = HOST.match(text, at.end())
        if host is None:
            continue
        before = _local_dots(text, at.start(), end)
        dots = [m.span() for m in DOT.finditer(text, host.start(), host.end()) if m[0] != "."]
        if not before and not dots and not at["boxed"]:
            continue
        edits += [(*span, ".") for span in before]
        if at[0] != "@":
            edits.append((at.start(), at.end(), "@"))
        edits += [(*span, ".") for span in dots]
        end = host.end()
    return edits


def rewritten(text: str) -> Rewriting | None:
    """The text with disguises undone, or nothing where it holds none."""
    out = Rewriting(text)
    passes = (
        lambda t: [(m.start(), m.end(), _CHARS[m[0]]) for m in _MARKS.finditer(t)] if not t.isascii() else [],
        _addresses,
        _spelled_ips,
        _spelled,
        lambda t: [(m.start(), m.end(), ".") for m in NUMBER_DOT.finditer(t)],
        lambda t: [(m.start(), m.end(), "+") for m in PLUS_WORD.finditer(t)],
    )
    changed = False
    for find in passes:
        if edits := find(out.text):
            out.replace(edits)
            changed = True
    return out if changed else None


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and plain with disguised ones, by kind and in order."""
    base = base_spans(text)
    changed = rewritten(text)
    if changed is None:
        return base, base
    full = {}
    for kind, find in FINDERS.items():
        taken = list(base[kind])
        for span in map(changed.source, find(changed.text)):
            if not any(a <= span[0] and span[1] <= b for a, b in taken):
                taken.append(span)
        full[kind] = sorted(taken)
    return base, full


def written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_FOUND = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]
)


def find(docs: DataFrame) -> DataFrame:
    """Spans of every document: counts and digest of the plain ones, and all spans as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                base, full = all_spans(text.as_py() or "")
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((doc_id, *(len(base[k]) for k in KINDS), digest, written(full)))
            yield from table_of(_FOUND, **dict(zip(_FOUND.names, zip(*rows) if rows else [[]] * 7))).to_batches()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def mask_text(text: str) -> str:
    """Every span replaced by its kind in brackets; of overlapping spans the earlier, then longer."""
    _, full = all_spans(text)
    out, at = [], 0
    for start, end, kind in sorted(((a, b, k) for k in KINDS for a, b in full[k]), key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += text[at:start], f"[{kind.upper()}]"
        at = max(at, end)
    return "".join((*out, text[at:]))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with personal data in ``text`` masked; a null text stays null."""

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: None if t is None else mask_text(t))

    return docs.withColumn(text, masked(F.col(f"`{text}`")))
