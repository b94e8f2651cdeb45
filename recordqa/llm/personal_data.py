"""Personal data in texts, disguised or plain, with spans in the source.

Transducers rewrite a text step by step: look-alike characters, invisible ones, spelled digits, and at and dot in
words or brackets. Each keeps how its output maps to its input, so an identifier found in the last output has an exact
span in the source. What the plain text holds is reported whatever the transducers do.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from recordqa.llm.common import map_rows, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, in forms that read each character a bounded number of times.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Digits, at, dot and plus as they are spelled in English, German, French and Spanish.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "punto", "point")
PLUS_WORDS = ("plus", "más")
#: Last labels that a bare "at ... dot ..." must end with; prose seldom does.
LAST_LABELS = "com org net edu gov mil int info biz io co dev app uk us ca au de at ch fr be nl es it pt pl eu".split()
#: Cyrillic and Greek letters that look like a Latin one.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "У": "Y", "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y",
    "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "α": "a", "ν": "v", "ι": "i", "ρ": "p",
}
#: Signs that look like a dot, hyphen or plus beyond those that Unicode itself folds.
SIGNS = {
    "\N{IDEOGRAPHIC FULL STOP}": ".", "\N{HALFWIDTH IDEOGRAPHIC FULL STOP}": ".", "\N{HYPHEN}": "-", "\N{NON-BREAKING HYPHEN}": "-",
    "\N{FIGURE DASH}": "-", "\N{EN DASH}": "-", "\N{EM DASH}": "-", "\N{MINUS SIGN}": "-", "\N{HEAVY PLUS SIGN}": "+",
}
#: Characters that do not show (soft hyphen, joiners, zero-width spaces, direction and variation marks).
INVISIBLE = re.compile("[\u00ad\u034f\u180e\u200b-\u200f\u2060-\u2064\ufe0e\ufe0f\ufeff]+")

_any = "|".join
_WORD = f"(?:{_any(sorted(DIGIT_WORDS, key=len, reverse=True))})"
_DOT = f"(?:{_any(DOT_WORDS)})"
_AT = f"(?:{_any(AT_WORDS)})"
_LABEL = "[A-Za-z0-9-]+"
_OPEN, _CLOSE = r"\x20{0,2}[(\[{<]\x20{0,2}", r"\x20{0,2}[)\]}>]\x20{0,2}"
SPELLED = re.compile(rf"(?<!\w){_WORD}(?:[\x20-]{_WORD})*(?!\w)", re.I)
#: O for 0 and l or I for 1 inside a number.
LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI]+(?=[\x20.-]?[0-9])|(?<=[0-9]\.)[OolI]+(?=[0-9])")
PLUS = re.compile(rf"(?<!\w)(?:{_any(PLUS_WORDS)})[\x20-](?=[0-9])", re.I)
BRACKETED_AT = re.compile(rf"{_OPEN}(?:{_AT}|@){_CLOSE}", re.I)
BRACKETED_DOT = re.compile(rf"{_OPEN}(?:{_DOT}|\.){_CLOSE}", re.I)
DIGIT_DOT = re.compile(rf"(?<=[0-9])\x20{_DOT}\x20(?=[0-9])", re.I)
#: A bare at needs a domain whose dots are words too; a bare dot needs an at before its domain.
BARE_AT = re.compile(
    rf"(?<=[A-Za-z0-9_%+-])\x20{_AT}\x20(?={_LABEL}(?:\x20{_DOT}\x20{_LABEL}){{0,8}}\x20{_DOT}\x20(?:{_any(LAST_LABELS)})(?![A-Za-z0-9-]))", re.I
)
DOMAIN_DOTS = re.compile(rf"@{_LABEL}(?:(?:\x20{_DOT}\x20|\.){_LABEL})+", re.I)
ONE_DOT = re.compile(rf"\x20{_DOT}\x20", re.I)
LAST = re.compile(rf"(?:{_any(LAST_LABELS)})$", re.I)


# --- detection in one text


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, by their at signs: no run of letters is read twice."""
    done = 0
    for m in AT_DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers of at most 255; a longer chain of numbers is taken in fours from its start."""
    for m in DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i : i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts[i : i + 4]):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


FINDERS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (emails, addresses, cards, phones)


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), in order."""
    return [(kind, *span) for kind, find in enumerate(FINDERS) for span in find(text)]


# --- transducers


class Tape:
    """A text and how its pieces map to the source.

    Piece n begins at ``outs[n]``; a copied piece runs along the source from ``starts[n]``, a rewritten one
    stands as a whole for the source from ``starts[n]`` to ``ends[n]``.
    """

    def __init__(self, text: str):
        self.text = text
        self.steps: list[tuple[list[int], list[int], list[int | None]]] = []

    def rewrite(self, pattern: re.Pattern, new: Callable[[re.Match], str | None]) -> None:
        """Replaces the matches of a pattern for which ``new`` has a text."""
        outs, starts, ends, parts, at, size = [], [], [], [], 0, 0
        for m in pattern.finditer(self.text):
            put = new(m)
            if put is None:
                continue
            for piece, start, end in ((self.text[at : m.start()], at, None), (put, m.start(), m.end())):
                if piece:
                    outs.append(size)
                    starts.append(start)
                    ends.append(end)
                    parts.append(piece)
                    size += len(piece)
            at = m.end()
        if at:
            outs.append(size)
            starts.append(at)
            ends.append(None)
            parts.append(self.text[at:])
            self.text = "".join(parts)
            self.steps.append((outs, starts, ends))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a span of the text."""
        last = end - 1
        for outs, starts, ends in reversed(self.steps):
            n = bisect_right(outs, start) - 1
            start = starts[n] if ends[n] is not None else starts[n] + start - outs[n]
            n = bisect_right(outs, last) - 1
            last = ends[n] - 1 if ends[n] is not None else starts[n] + last - outs[n]
        return start, last + 1


@functools.cache
def look_alikes() -> dict[int, str]:
    """Characters that stand for one ASCII character: by Unicode's compatibility folding, as digits of any script, or by looks."""
    table = {}
    for block in (range(0xA0, 0x2500), range(0x3000, 0x3003), range(0xFE50, 0xFFA0), range(0x1D400, 0x1D800)):
        for code in block:
            c = chr(code)
            folded = unicodedata.normalize("NFKC", c)
            digit = unicodedata.decimal(c, None)
            if digit is not None:
                table[code] = str(digit)
            elif len(folded) == 1 and folded.isascii() and folded.isprintable():
                table[code] = folded
    return table | {ord(c): v for c, v in (LOOK_ALIKES | SIGNS).items()}


def _spelled(m: re.Match) -> str:
    return "".join(DIGIT_WORDS[w] for w in re.split(r"[\x20-]", m.group().lower()))


def _dots(m: re.Match) -> str | None:
    return ONE_DOT.sub(".", m.group()) if ONE_DOT.search(m.group()) and LAST.search(m.group()) else None


def normalise(text: str) -> Tape:
    """The text without disguises. The first step maps character for character, so its offsets are the source's."""
    tape = Tape(text if text.isascii() else text.translate(look_alikes()))
    if not tape.text.isascii():
        tape.rewrite(INVISIBLE, lambda m: "")
    tape.rewrite(SPELLED, _spelled)
    tape.rewrite(LETTER_DIGIT, lambda m: "".join("0" if c in "Oo" else "1" for c in m.group()))
    tape.rewrite(PLUS, lambda m: "+")
    tape.rewrite(BRACKETED_AT, lambda m: "@")
    tape.rewrite(BRACKETED_DOT, lambda m: ".")
    tape.rewrite(DIGIT_DOT, lambda m: ".")
    tape.rewrite(BARE_AT, lambda m: "@")
    tape.rewrite(DOMAIN_DOTS, _dots)
    return tape


def identifiers(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans (kind, start, end) of a text, in code points.

    Added is what the text without disguises holds and no base span of its kind contains; a span whose source is
    what was found, letter for letter, was judged by the base patterns already.
    """
    base, added = detect(text), []
    tape = normalise(text)
    if tape.text != text:
        for kind, start, end in detect(tape.text):
            at, to = tape.source(start, end)
            if text[at:to] != tape.text[start:end] and not any(k == kind and s <= at and to <= e for k, s, e in base):
                added.append((kind, at, to))
    return base, added


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every maximal run of overlapping spans replaced by the kind of its first."""
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, by kind as listed, then by start."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, and ``redacted`` if ``with_text``.

    ``spans`` holds base and added spans as kind:start:end, comma-joined, base_sha256 the digest of the base
    ones alone. Null text is empty and gives no spans; repeated rows get a row each; null ids are kept; empty tables give
    no rows; other columns are ignored. Texts of any length are read whole, in a time that grows with
    their length; nothing is shuffled.
    """
    names = ("id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(("redacted",) if with_text else ()))

    def rows(batch):
        out: dict = {n: [] for n in names}
        for ident, text in zip(batch["id"], batch["text"]):
            base, added = identifiers(text)
            counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
            row = (ident, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added))
            for name, v in zip(names, (*row, redacted(text, base + added)) if with_text else row):
                out[name].append(v)
        yield out

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"id {kind}, {counts}, base_sha256 string, spans string" + (", redacted string" if with_text else "")
    found = map_rows(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), rows, schema)
    return found.withColumnRenamed("id", id_col)
