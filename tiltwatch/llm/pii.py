"""Personal data in plain and disguised form, with offsets into the source text."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

# The plain forms. Possessive repeats give the same matches without backtracking.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like a Latin one.
_LOOK = str.maketrans(
    "АВЕКМНОРСТХУІЈЅаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινρ",
    "ABEKMHOPCTXYIJSaeopcyxijsdhqwABEZHIKMNOPTYXoivp",
)
# Digits as words in the four languages, and words for the two signs of an address.
_SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_AT_WORDS, _DOT_WORDS, _PLUS_WORDS = "at|arroba|arobase", "dot|punto|punkt|point", "plus|más"

_NUMBER = "|".join(sorted(_SPELLED, key=len, reverse=True))
_SPELLED_RUN = re.compile(
    rf"(?<![^\W\d_])(?:{_NUMBER})(?![^\W\d_])(?:[\x20,-]+(?:{_NUMBER})(?![^\W\d_]))*", re.I
)
_OPEN, _SHUT = r"\x20*[\[({<]\x20*", r"\x20*[\])}>]\x20*"
_DOTTED = re.compile(rf"(?:{_OPEN}(?:{_DOT_WORDS}|\.){_SHUT}|\x20(?:{_DOT_WORDS})\x20|_(?:{_DOT_WORDS})_)", re.I)
#: Bracketed signs are found without the spaces around them, which are added by hand: a search that begins
#: with spaces would start anew at each space of a run.
_BRACKETED = r"[\[({{<]\x20*+(?:{})\x20*+[\])}}>]"
_DOT = re.compile(
    _BRACKETED.format(_DOT_WORDS + r"|\.")
    + rf"|(?<=[A-Za-z0-9])(?:\x20(?:{_DOT_WORDS})\x20|_(?:{_DOT_WORDS})_)(?=[A-Za-z0-9])",
    re.I,
)
_AT = re.compile(
    _BRACKETED.format(_AT_WORDS + "|@")
    + rf"|(?<=[A-Za-z0-9])_(?:{_AT_WORDS})_(?=[A-Za-z0-9])"
    # A bare word counts only before a host whose dots are disguised as well.
    + rf"|(?<=[A-Za-z0-9])\x20(?:{_AT_WORDS})\x20(?=[A-Za-z0-9-]+\x20(?:{_DOT_WORDS})\x20[A-Za-z])",
    re.I,
)
_PLUS = re.compile(rf"(?<![A-Za-z])(?:{_PLUS_WORDS})\x20+(?=[0-9])", re.I)
_MIXED_DIGIT = re.compile(r"(?<=[0-9])[OolI]+(?=[0-9])")
# Without one of these a text holds no disguised at or dot sign.
_HINTS = ("[", "(", "{", "<", "_", *(f" {w} " for w in _DOT_WORDS.split("|")))
_MARKS = "-,.;:!?()[]{}<>\"'*|#%&$/"

Span = tuple[str, int, int]
#: Answers of _plain, at most one per code point.
_SEEN: dict[str, str | None] = {}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """Plain identifiers, leftmost and without overlap per kind, failing ones dropped."""
    found: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        # The leftmost match before this sign starts where its run of local characters does.
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            found.append(("email", start, end))
            at = text.find("@", end)
        else:
            # No later match may be held back by this one, but none of it can match again either.
            end = max(end, at + 1)
            at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m.group().split(".")]
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _plain(char: str) -> str | None:
    """What a character outside ASCII stands for: an ASCII one, nothing, or None for itself."""
    if char not in _SEEN:
        _SEEN[char] = _look_up(char)
    return _SEEN[char]


def _look_up(char: str) -> str | None:
    if unicodedata.category(char) == "Cf":
        return ""
    if (look := char.translate(_LOOK)) != char:
        return look
    if (digit := unicodedata.digit(char, None)) is not None:
        return str(digit)
    if unicodedata.category(char) == "Pd" or char == "−":
        return "-"
    form = unicodedata.normalize("NFKC", char)
    return form if len(form) == 1 and form.isascii() else None


class Rewrite:
    """A text with stretches replaced, and the way back from its offsets."""

    def __init__(self, source: str, changes: list[tuple[int, int, str]]):
        pieces, self._from, self._to = [], [], []
        done = made = 0
        for start, end, text in changes:
            if start < done:
                continue
            for a, b, piece, fixed in ((done, start, source[done:start], False), (start, end, text, True)):
                if piece or fixed:
                    self._from.append(made)
                    self._to.append((a, b, fixed))
                    pieces.append(piece)
                    made += len(piece)
            done = end
        self._from.append(made)
        self._to.append((done, len(source), False))
        pieces.append(source[done:])
        self.text = "".join(pieces)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Source offsets of the rewritten text's ``start`` to ``end``."""
        i = bisect_right(self._from, start) - 1
        a, _, fixed = self._to[i]
        first = a if fixed else a + start - self._from[i]
        i = bisect_right(self._from, end - 1) - 1
        a, b, fixed = self._to[i]
        return first, b if fixed else a + end - self._from[i]


def _characters(text: str) -> Rewrite | None:
    """Lookalike, full-width and invisible characters made plain."""
    odd = {c: p for c in set(text) if c > "\x7f" and (p := _plain(c)) is not None}
    if not odd:
        return None
    where = re.compile("[" + "".join(map(re.escape, odd)) + "]")
    return Rewrite(text, [(m.start(), m.end(), odd[m.group()]) for m in where.finditer(text)])


def _may_spell(text: str) -> bool:
    """Whether the search for spelled digits can change the text; a quick look at its words."""
    bare = text.lower()
    for mark in _MARKS:
        if mark in bare:
            bare = bare.replace(mark, " ")
    spelled = [w in _SPELLED for w in bare.split()]
    if True not in spelled:
        return False
    if _DIGIT.search(text) or _hinted(text):
        return True
    return any(a and b and c for a, b, c in zip(spelled, spelled[1:], spelled[2:]))


def _hinted(text: str) -> bool:
    low = text.lower()
    return any(hint in low for hint in _HINTS)


def _spelled(text: str) -> Rewrite | None:
    """Runs of three digit words or more, or digit words that continue a number, made digits."""
    if not _may_spell(text):
        return None
    changes = []
    for m in _SPELLED_RUN.finditer(text):
        start, end = m.span()
        words = re.split(r"[\x20,-]+", m.group().lower())
        near = re.search(r"[0-9][\x20.-]?\Z", text[max(0, start - 2) : start]) or re.match(
            r"[\x20.-]?[0-9]", text[end : end + 2]
        )
        dotted = len(words) < 4 and (
            _DOTTED.match(text, end) or re.search(_DOTTED.pattern + r"\Z", text[max(0, start - 12) : start], re.I)
        )
        if len(words) >= 3 or near or dotted:
            changes.append((start, end, "".join(_SPELLED[w] for w in words)))
    return Rewrite(text, changes) if changes else None


def _with_spaces(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Matches of a sign; bracketed ones with all spaces around them that no earlier match took."""
    done = 0
    for m in pattern.finditer(text):
        start, end = m.span()
        if text[start] in "[({<":
            while start > done and text[start - 1] == " ":
                start -= 1
            while text[end : end + 1] == " ":
                end += 1
        done = end
        yield start, end


def _signs(text: str) -> Rewrite | None:
    """Disguised at, dot and plus signs, and letters within numbers that stand for digits."""
    changes = []
    if _hinted(text):
        changes = [(*span, s) for s, p in (("@", _AT), (".", _DOT)) for span in _with_spaces(p, text)]
    if _DIGIT.search(text):
        changes += [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
        changes += [
            (m.start(), m.end(), "".join("0" if c in "Oo" else "1" for c in m.group()))
            for m in _MIXED_DIGIT.finditer(text)
        ]
    return Rewrite(text, sorted(changes)) if changes else None


def disguised(text: str) -> list[Span]:
    """Identifiers that appear once the text is normalised, as spans of the source text."""
    steps, now = [], text
    for rewrite in (_characters, _spelled, _signs):
        if (step := rewrite(now)) is not None:
            steps.append(step)
            now = step.text
    if not steps:
        return []
    found = []
    for kind, start, end in detect(now):
        for step in reversed(steps):
            start, end = step.span(start, end)
        found.append((kind, start, end))
    return found


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain spans, and plain with disguised ones, by start and then kind.

    A disguised span is left out where it meets a plain one of its kind.
    """
    if not text:
        return [], []
    base = detect(text)
    # Spans of a kind do not overlap, so the last that starts before an end tells.
    starts = {k: [x[1] for x in base if x[0] == k] for k in KINDS}
    ends = {k: [x[2] for x in base if x[0] == k] for k in KINDS}
    extra = []
    for k, a, b in disguised(text):
        before = bisect_left(starts[k], b)
        if not before or ends[k][before - 1] <= a:
            extra.append((k, a, b))
    return _ordered(base), _ordered(base + extra)


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: plain identifiers, and all of them, per row.

    Spans are structs of kind and code-point offsets, end exclusive, by start
    and then kind. Three transducers run over the whole text, each keeping the
    way back: lookalike characters, spelled digits, and disguised signs. What
    is then detected in the normalised text is mapped back to the source.

    NULL and empty texts have no spans. Repeated rows each get a row; NULL ids
    are carried along. Other columns are not read; an empty table gives an
    empty result.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t.as_py()) for t in batch.column(1)]
            columns = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in found], kind)
                for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "base", "spans"])

    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_kind}, base {SPAN_TYPE}, spans {SPAN_TYPE}")
