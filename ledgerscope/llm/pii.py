"""Personal data in texts, seen through disguises, at the places of the source text.

Base detectors find plain identifiers. Where a text shows a trace of disguise, transducers rewrite
it (homoglyphs and wide digits, invisible characters, spelled digits, at/dot words) while every
character of the rewritten text keeps the source span that it stands for; the same detectors run
on it, and a span that touches a rewritten character is mapped back to the source and added. Base
spans always stay; an added span that lies inside a base span of its kind is left out.

All scans are linear: runs are entered only at their first character.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_batches, text_bytes

KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def detect(text: str) -> list[Span]:
    """Plain identifiers, by kind as in ``KINDS``, then by place; code points, end exclusive."""
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# Look-alikes of ASCII letters that NFKC does not fold.
HOMOGLYPHS = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    # Greek
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # Latin
    "ı": "i", "ɑ": "a", "ɡ": "g", "ᴏ": "o",
    # signs
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "＋": "+",
}

# Spelled digits.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}

#: spelled digits that must follow each other before they count as a number
LEAST_SPELLED = 4

_NUMBER_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
_DIGIT_SEP = r"(?:[ ,.-]|, | - )"
_NUMBER_PART = rf"(?:[0-9]{{1,3}}|(?:{_NUMBER_WORD})(?:[ -](?:{_NUMBER_WORD})(?!\w)){{0,9}})"
#: four numbers, spelled or not, joined by dot words
_SPELLED_DOTS = re.compile(rf"(?<![\w.]){_NUMBER_PART}(?:[ \t]++dot[ \t]++{_NUMBER_PART}){{3}}(?!\w)", re.I)
_SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:plus[ -]?)?(?:{_NUMBER_WORD}|[0-9]+)(?!\w)(?:{_DIGIT_SEP}{{1,2}}(?:{_NUMBER_WORD}|[0-9]+)(?!\w))*+", re.I
)
#: letters that a regular expression takes for i and s when case is ignored
_FOLDED = str.maketrans({"\u0131": "i", "\u0307": None, "\u017f": "s"})
_WORD = re.compile(r"\w+")
_NUMBER_TOKEN = re.compile(rf"(?<!\w)(?:{_NUMBER_WORD}|[0-9]+)(?!\w)", re.I)
_SPELLED_TOKEN = re.compile(rf"(?<!\w)(?:{_NUMBER_WORD}|plus)(?!\w)", re.I)

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: at and dot in brackets, with the blanks around them
_BRACKETED = re.compile(
    rf"(?<![ \t])[ \t]*+{_OPEN}[ \t]*+(?:(?P<at>at|arroba|@)|(?P<dot>dot|punkt|punto|point|\.))[ \t]*+{_CLOSE}[ \t]*+", re.I
)
#: bare words: an "at" counts only when "dot" words join the labels after it
_BARE = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:[ \t]++dot[ \t]++|\.)[A-Za-z0-9_%+-]++){0,4}(?P<at>[ \t]+at[ \t]+|[ \t]*@[ \t]*)"
    r"[A-Za-z0-9-]+(?P<dots>(?:(?:[ \t]+dot[ \t]+|\.)[A-Za-z0-9-]+){1,6})",
    re.I,
)
_BARE_DOT = re.compile(r"(?<![ \t])[ \t]++dot[ \t]++", re.I)
#: four numbers joined by dot words or bracketed dots
_DOT_NUMBERS = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ \t]+dot[ \t]+[0-9]{1,3}){3}(?![0-9])", re.I)

_TRACE_CHARS = re.compile(
    "[\u00a0\u0131\u0251\u0261\u00ad\u00b2\u00b3\u00b9\u0370-\u052f\u0660-\u0669\u06f0-\u06f9\u0966-\u096f\u1d0f\u2000-\u200f\u2010-\u2015\u2024\u202f\u2060-\u2064\u2070-\u2089"
    "\u2212\u2460-\u24ff\u3000\u3002\ufe00-\ufe0f\ufeff\uff01-\uff5e\U0001d400-\U0001d7ff]"
)
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_BLANK = re.compile("[\u00a0\u2000-\u200a\u202f\u3000]")


#: a long run of digits and the letters that look like some
_LETTER_DIGITS = re.compile(r"(?<![\w+])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl])++(?!\w)")
_LETTER_AMONG_DIGITS = re.compile(r"[0-9][ ().-]{0,2}[OoIl][ ().0-9-]")


class Mapped:
    """A rewritten text; character i stands for source[start[i]:end[i]], ``new[i]`` if rewritten."""

    def __init__(self, text: str, start: array | None = None, end: array | None = None, new: bytes | None = None):
        self.text = text
        self.start = array("q", range(len(text))) if start is None else start
        self.end = array("q", range(1, len(text) + 1)) if end is None else end
        self.new = bytes(len(text)) if new is None else new

    def replaced(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """With each ``[a, b)`` rewritten; edits are sorted and do not overlap."""
        if not edits:
            return self
        text, start, end, new, at = [], array("q"), array("q"), bytearray(), 0
        for a, b, to in edits:
            text += [self.text[at:a], to]
            start += self.start[at:a]
            end += self.end[at:a]
            new += self.new[at:a]
            start += array("q", [self.start[a]]) * len(to)
            end += array("q", [self.end[b - 1]]) * len(to)
            new += b"\1" * len(to)
            at = b
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        new += self.new[at:]
        return Mapped("".join(text), start, end, bytes(new))


def _fold_characters(m: Mapped) -> Mapped:
    edits = []
    for hit in _TRACE_CHARS.finditer(m.text):
        c = hit[0]
        if _INVISIBLE.match(c):
            to = ""
        elif _BLANK.match(c):
            to = " "
        else:
            to = HOMOGLYPHS.get(c) or unicodedata.normalize("NFKC", c)
            if not to.isascii():
                digit = unicodedata.decimal(c, None)
                to = c if digit is None else str(digit)
        if to != c:
            edits.append((hit.start(), hit.end(), to))
    return m.replaced(edits)


def _letters_for_digits(m: Mapped) -> Mapped:
    """O and l among many digits become 0 and 1."""
    edits = []
    for run in _LETTER_DIGITS.finditer(m.text):
        letters = [k for k in range(*run.span()) if m.text[k] in "OoIl"]
        if letters and len(_digits(run[0])) >= max(7, 2 * len(letters)):
            edits += [(k, k + 1, "0" if m.text[k] in "Oo" else "1") for k in letters]
    return m.replaced(edits)


def _spelled(word: str) -> str:
    return SPELLED[word.lower().translate(_FOLDED)]


def _spelled_addresses(m: Mapped) -> Mapped:
    """Spelled digits of four numbers joined by dot words, however few; the dot words are left to ``_at_and_dot``."""
    edits = []
    for run in _SPELLED_DOTS.finditer(m.text):
        numbers = list(_NUMBER_TOKEN.finditer(m.text, *run.span()))
        for n, following in zip(numbers, [*numbers[1:], None]):
            gap = m.text[n.end() : following.start()] if following else ""
            if not "0" <= n[0][0] <= "9":
                edits.append((n.start(), n.end() + (len(gap) if gap in (" ", "-") else 0), _spelled(n[0])))
    return m.replaced(edits)


def _spelled_digits(m: Mapped) -> Mapped:
    m = _spelled_addresses(m)
    edits = []
    for run in _SPELLED_RUN.finditer(m.text):
        tokens = list(_SPELLED_TOKEN.finditer(m.text, *run.span()))
        if sum(t[0].lower().translate(_FOLDED) != "plus" for t in tokens) < LEAST_SPELLED:
            continue
        for k, t in enumerate(tokens):
            follows = tokens[k + 1].start() if k + 1 < len(tokens) else run.end()
            gap = m.text[t.end() : follows]
            to = "+" if t[0].lower().translate(_FOLDED) == "plus" else _spelled(t[0])
            # a comma and blanks between two digits would end a number; a sign is kept
            tail = len(gap) if gap and not gap.strip(" ,") and follows < run.end() else 0
            edits.append((t.start(), t.end() + tail, to))
    return m.replaced(edits)


def _at_and_dot(m: Mapped) -> Mapped:
    m = m.replaced([(h.start(), h.end(), "@" if h["at"] else ".") for h in _BRACKETED.finditer(m.text) if _between_labels(m.text, *h.span())])
    edits = []
    for h in _BARE.finditer(m.text):
        dots = [(d.start(), d.end(), ".") for d in _BARE_DOT.finditer(m.text, h.start(), h.end())]
        plain_at = h["at"].strip() == "@"
        if not plain_at and not _BARE_DOT.search(h["dots"]):
            continue
        if plain_at and h["at"] == "@" and not dots:
            continue
        edits += sorted([*dots, (h.start("at"), h.end("at"), "@")])
    m = m.replaced(edits)
    edits = [(d.start(), d.end(), ".") for h in _DOT_NUMBERS.finditer(m.text) for d in _BARE_DOT.finditer(m.text, *h.span())]
    return m.replaced(edits)


def _between_labels(text: str, a: int, b: int) -> bool:
    return 0 < a and b < len(text) and text[a - 1] in _LOCAL and text[b] in _LOCAL


_LATIN_TRACES = "\u00a0\u00ad\u00b2\u00b3\u00b9"


def _has_traces(text: str) -> bool:
    """Whether a character of the text may be a disguise; cheap for ASCII and Latin texts."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return bool(_TRACE_CHARS.search(text))
    return any(c in text for c in _LATIN_TRACES)


def _has_number_words(text: str) -> bool:
    """Whether a number word stands next to another or to digits, over any separator of a run or a dot word."""
    tokens = [t for t in _WORD.findall(text.lower().translate(_FOLDED)) if t != "dot"]
    flags = bytes(map(SPELLED.__contains__, tokens))
    at = flags.find(1)
    while at >= 0:
        for k in (at - 1, at + 1):
            if 0 <= k < len(tokens) and (flags[k] or tokens[k].isdecimal()):
                return True
        at = flags.find(1, at + 1)
    return False


def _has_at_or_dot(text: str) -> bool:
    return any(c in text for c in "[({<") or " dot " in text.lower() or " @" in text or "@ " in text or "\t" in text


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, both by kind, then by place."""
    base = detect(text)
    folds = _has_traces(text)
    letters = bool(_DIGIT.search(text) and _LETTER_AMONG_DIGITS.search(text))
    if not (folds or letters or _has_number_words(text) or _has_at_or_dot(text)):
        return base, base
    m = _fold_characters(Mapped(text)) if folds else Mapped(text)
    if letters:
        m = _letters_for_digits(m)
    if _has_number_words(m.text):
        m = _spelled_digits(m)
    if _has_at_or_dot(m.text):
        m = _at_and_dot(m)
    if not any(m.new) and len(m.text) == len(text):
        return base, base
    added = []
    for kind, a, b in detect(m.text):
        s, e = m.start[a], m.end[b - 1]
        touched = any(m.new[a:b]) or e - s != b - a
        if touched and not any(k == kind and x <= s and e <= y for k, x, y in base):
            added.append((kind, s, e))
    spans = sorted(set(base + added), key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return base, spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` for every whole text.

    ``spans`` lists ``kind:start:end`` in code points of the source text, comma-joined; counts are of
    ``spans``. Null and empty texts have none. One row per input row, repeated rows and null ids
    included; other columns are ignored.
    """

    def setup():
        def work(keys, texts):
            found = [find(t.decode()) for t in texts]
            counts = [[sum(s[0] == kind for s in spans) for _, spans in found] for kind in KINDS]
            return keys, *counts, [joined(b) for b, _ in found], [joined(s) for _, s in found]

        return work

    return map_batches(
        docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text)),
        setup,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string",
    )


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans merge."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
