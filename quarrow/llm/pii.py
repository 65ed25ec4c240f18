"""Personal data with offset-preserving deobfuscation.

Base spans are found in the text as it stands. Then a chain of transducers
rewrites disguises - homoglyphs, fullwidth forms, invisible characters,
spelled digits, ``at``/``dot`` words - into plain characters. Every step keeps,
for each character it writes, the source offsets it came from; identifiers
found in the rewritten text map back to source spans through those offsets.
Spans found only that way are added; base spans stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, id_and_text, quoted

KINDS = ("email", "ip", "card", "phone")

# Characters that look like an ASCII one.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝνοικρυα", "aeopcyxijsdhqwvoikpua", strict=True))
HOMOGLYPHS |= dict(zip("АВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEKMHOPCTXIJSABEZHIKMNOPTYX", strict=True))
HOMOGLYPHS |= dict(zip("＠．﹒․·∙。＋﹢－‐‑‒–—−（）\u00a0", "@......++-------() ", strict=True))
HOMOGLYPHS |= {chr(0xFF10 + k): str(k) for k in range(10)}
HOMOGLYPHS |= {chr(0xFF21 + k): chr(65 + k) for k in range(26)} | {chr(0xFF41 + k): chr(97 + k) for k in range(26)}
# Characters without a width.
INVISIBLE = "­​‌‍⁠﻿"
# Digits by name.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_EMAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_CARD_LIKE = re.compile(r"[0-9](?:[\x20-]?[0-9]){15}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_ODD = re.compile("[" + re.escape("".join(HOMOGLYPHS) + INVISIBLE) + "]")
_DIGIT_WORD = re.compile(r"(?<![A-Za-z])(?ai:{})(?![A-Za-z])".format("|".join(DIGITS)))
# Fixed value: what may stand between a digit's name and the digit or name beside it.
_APART = " ,.()-"
_GAP = re.compile(r"[\x20,.()-]*+")
_PLUS = re.compile(r"\bplus[\x20-]+(?=[0-9])", re.I)
_AT = re.compile(r"(?<!\x20)(?:\x20*[\[({<]\x20*(?:at|@)\x20*[\])}>]\x20*|\x20+(?:at|AT)\x20+(?=[A-Za-z0-9-]+(?:\x20*[\[({<]\x20*(?:dot|\.)|\x20+(?:dot|DOT)\x20)))", re.I)
# A dot in disguise stands between two parts of a name or a number.
_DOT = re.compile(r"(?<=[A-Za-z0-9_%+-])(?:\x20*[\[({<]\x20*(?:dot|\.)\x20*[\])}>]\x20*|\x20+(?:dot|DOT)\x20+)(?=[A-Za-z0-9_%+-])", re.I)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])\x20+@\x20+(?=[A-Za-z0-9-]+\.[A-Za-z])")
_SIGN = re.compile(r"[\[({<\x20](?:at|dot|@|\.)[\])}>\x20]", re.I)


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """Base spans ``(kind, start, end)`` by kind, then start.

    Leftmost and non-overlapping within a kind; a match that fails its check is
    dropped and not tried again. Every scan is linear in the length of the text.
    """
    found = []
    if "@" in text:
        free = 0  # an address cannot start before the end of the last one
        for m in _EMAIL.finditer(text):
            start = at = m.start()
            while start > free and text[start - 1] in _LOCAL_SET:
                start -= 1
            if start < at:
                free = m.end()
                found.append(("email", start, free))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
    if _CARD_LIKE.search(text):
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


class Tape:
    """A text under rewriting, as pieces that each know their source span."""

    def __init__(self, text: str):
        self.text = text
        self.starts = [0]  # where each piece starts in the rewritten text
        self.source = [(0, len(text), True)]  # its source span; True: character by character

    def place(self, at: int, end: bool) -> int:
        """The source offset of an offset in the rewritten text."""
        k = bisect_right(self.starts, at - end) - 1
        a, b, same = self.source[k]
        return a + at - self.starts[k] if same else (b if end else a)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply ordered, non-overlapping replacements ``(start, end, text)``."""
        if not edits:
            return
        text, starts, source, out, at, size = self.text, [], [], [], 0, 0

        def keep(upto: int) -> None:
            nonlocal at, size
            k = bisect_right(self.starts, at) - 1
            while at < upto:
                stop = min(upto, self.starts[k + 1] if k + 1 < len(self.starts) else len(text))
                a, b, same = self.source[k]
                if stop > at:
                    starts.append(size)
                    source.append((a + at - self.starts[k], a + stop - self.starts[k], True) if same else (a, b, False))
                    out.append(text[at:stop])
                    size += stop - at
                at = stop
                k += 1

        for start, end, new in edits:
            keep(start)
            if new:
                starts.append(size)
                source.append((self.place(start, False), self.place(end, True), False))
                out.append(new)
                size += len(new)
            at = end
        keep(len(text))
        self.text, self.starts, self.source = "".join(out), starts or [0], source or [(0, 0, False)]


def normalised(text: str) -> Tape | None:
    """The text after all transducers, or None where none of them applies."""
    tape = Tape(text)
    if not text.isascii():
        tape.rewrite([(m.start(), m.end(), HOMOGLYPHS.get(m[0], "")) for m in _ODD.finditer(tape.text)])
    runs = _names(tape.text)
    tape.rewrite(runs)
    if runs:
        tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])
    if _SIGN.search(tape.text) or " @ " in tape.text:
        tape.rewrite([(m.start(), m.end(), "@") for m in _AT.finditer(tape.text)])
        tape.rewrite([(m.start(), m.end(), ".") for m in _DOT.finditer(tape.text)])
        tape.rewrite([(m.start(), m.end(), "@") for m in _SPACED.finditer(tape.text)])
    return tape if len(tape.source) > 1 or tape.text != text else None


def _names(text: str) -> list[tuple[int, int, str]]:
    """Digit names with a digit or another digit name beside them."""
    edits, last, words = [], 0, list(_DIGIT_WORD.finditer(text))
    for k, m in enumerate(words):
        ahead = text[last : m.start()].rstrip(_APART)
        last = m.end()
        after = _GAP.match(text, last).end()
        beside = k > 0 if not ahead else "0" <= ahead[-1] <= "9"
        if beside or "0" <= text[after : after + 1] <= "9" or (k + 1 < len(words) and words[k + 1].start() == after):
            edits.append((m.start(), last, DIGITS[m[0].lower()]))
    return edits


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the spans that only deobfuscation shows.

    An added span covers the disguise in the source text, and something that base
    spans (of any kind, together) do not. Text without disguises gets no added spans.
    """
    base = identifiers(text)
    tape = normalised(text)
    if tape is None:
        return base, []
    taken: list[list[int]] = []  # base spans, those that touch as one
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    added = []
    for kind, start, end in identifiers(tape.text):
        a, b = tape.place(start, False), tape.place(end, True)
        k = bisect_right(taken, [a, len(text)])
        if not k or taken[k - 1][1] < b:
            added.append((kind, a, b))
    return base, added


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{kind}:{a}:{b}" for kind, a, b in spans])


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind."""
    out, at, reach = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= reach:
            out += [text[at:a], f"<{kind}>"]
        at = reach = max(reach, b)
    return "".join([*out, text[at:]])


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_email, n_ip, n_card, n_phone, base_sha256, n_added, spans, redacted)``.

    Counts and ``base_sha256`` are of base spans; ``spans`` lists all of them as
    ``kind:start:end`` by kind, then start, in code points with exclusive ends;
    ``redacted`` is the text with all spans replaced. Null or empty text: no
    spans, empty strings. Very long texts are read whole, in linear scans. Repeated
    rows stay repeated, an empty table gives an empty result; extra columns are dropped.
    """
    order = {kind: k for k, kind in enumerate(KINDS)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts = [[] for _ in KINDS]
            digests, more, spans, texts = [], [], [], []
            for text in block.column(1).to_pylist():
                base, added = find(text)
                kinds = [kind for kind, _, _ in base]
                for k, kind in enumerate(KINDS):
                    counts[k].append(kinds.count(kind))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                more.append(len(added))
                both = sorted([*base, *added], key=lambda s: (order[s[0]], s[1], s[2])) if added else base
                spans.append(_joined(both))
                texts.append(redacted(text, both) if both else text)
            columns = [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests), pa.array(more, pa.int64()), pa.array(spans), pa.array(texts)]
            yield pa.record_batch([block.column(0), *columns], names=names)

    names = [id_col, *[f"n_{kind}" for kind in KINDS], "base_sha256", "n_added", "spans", "redacted"]
    data = id_and_text(df, id_col, text_col)
    schema = f"`{id_col}` {data.schema['id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_added long, spans string, redacted string"
    return data.mapInArrow(run, schema)


def without_personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with all spans in ``text_col`` replaced by their kinds.

    Null texts stay null, empty ones empty. Other columns, whatever their names,
    and repeated rows stay; an empty table gives an empty one.
    """

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        parts = []
        for block in blocks([pa.record_batch([texts], names=["text"])], column=0):
            out = []
            for text in block.column(0).to_pylist():
                spans = [s for part in find(text) for s in part] if text else []
                out.append(redacted(text, spans) if spans else text)
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return df.withColumn(text_col, clean(F.col(quoted(text_col))))
