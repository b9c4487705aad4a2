"""Offset-preserving detection of personal data behind disguises.

Base detection runs on the text as it stands. Then two transducers rewrite it:

1. characters: compatibility forms and look-alike letters become their ASCII
   letter, invisible characters vanish;
2. tokens: runs of spelled digits, digits and bracketed or worded dots ("four
   one five", "10 dot 0 dot 0 dot 1") become a number where the whole run then
   is an identifier; bracketed or worded ``at`` / ``dot`` inside an address
   become ``@`` / ``.``.

Each keeps the segments of its output with their source range, so that a span
found in the rewritten text is mapped back to code points of the source. Spans
that touch a base span are not added; base spans always stay.

Defined results: null and empty texts have no spans; repeated rows give
repeated results; a span is ``kind:start:end``, code points, end exclusive,
ordered by start, then kind (email, ip, card, phone), then end. All steps are
linear in the length of a text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, start

KINDS = ("email", "ip", "card", "phone")

# The contract's character classes.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs are maximal, so possessive repeats find the same matches in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The four kinds, each leftmost and non-overlapping; failing matches are dropped."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, 0, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            last = max(last, at)
            at = text.find("@", at + 1)
    first = _DIGIT.search(text)
    if first:
        for m in _IP.finditer(text, first.start()):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text, first.start()):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class Rewrite:
    """A rewritten text and where each of its segments came from."""

    def __init__(self, source: str):
        self.source, self.parts = source, []
        self.at, self.src, self.src_end, self.same = [], [], [], []
        self.size = 0

    def add(self, text: str, begin: int, end: int) -> None:
        """``text`` stands for source[begin:end]."""
        if not text:
            return
        self.at.append(self.size)
        self.src.append(begin)
        self.src_end.append(end)
        self.same.append(len(text) == end - begin)
        self.parts.append(text)
        self.size += len(text)

    def text(self) -> str:
        return "".join(self.parts)

    def back(self, begin: int, end: int) -> tuple[int, int]:
        """Source range of the output range [begin, end), which is not empty.
        A segment of equal length maps character by character, any other as a whole."""
        a, b = bisect_right(self.at, begin) - 1, bisect_right(self.at, end - 1) - 1
        return (self.src[a] + (begin - self.at[a] if self.same[a] else 0),
                self.src[b] + (end - self.at[b]) if self.same[b] else self.src_end[b])


# Letters of other scripts that look like ASCII ones (source row
# above target row), beyond those that Unicode compatibility folding gives.
_ALIKE_FROM = "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαοιυνρΑΒΕΖΗΙΚΜΝΟΡΤΥΧօսո‐‑‒–—−。·"
_ALIKE_TO = "aeopcyxijshdqwABEKMHOPCTYXIJSaoiuvpABEZHIKMNOPTYXoun------.."
ALIKE = dict(zip(_ALIKE_FROM, _ALIKE_TO))
_INVISIBLE = frozenset("­​‌‍⁠﻿")
# Everything but ASCII and plain Latin letters with marks can fold.
_FOLDS = re.compile("[^\x00-\x7fÀ-žƀ-ɏ]+")


@lru_cache(maxsize=65536)
def fold(c: str) -> str:
    """A character's ASCII stand-in: itself if there is none, '' if invisible."""
    if c in _INVISIBLE:
        return ""
    n = ALIKE.get(c) or unicodedata.normalize("NFKC", c)
    return n if len(n) == 1 and " " <= n <= "~" else c


def fold_characters(text: str) -> Rewrite | None:
    """First transducer; None if it leaves the text alone."""
    out, last = None, 0
    for m in _FOLDS.finditer(text):
        folded = [fold(c) for c in m[0]]
        if any(f != c for f, c in zip(folded, m[0])):
            out = out or Rewrite(text)
            out.add(text[last:m.start()], last, m.start())
            for k, f in enumerate(folded, m.start()):
                out.add(f, k, k + 1)
            last = m.end()
    if out:
        out.add(text[last:], last, len(text))
    return out


# English digit names.
DIGIT_NAMES = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
               "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_NAME = "zero|oh|one|two|three|four|five|six|seven|eight|nine"
#: What may stand between two tokens of a run: blanks, hyphens, a comma.
_GAP = r"(?:[ \t-]{1,3}|[ \t]?,[ \t]{0,2})"
#: A dot in words or brackets, with what stands around it.
_SPOKEN = r"(?:[ \t-]{0,3}[\(\[\{<][ \t]?(?:dot|point|\.)[ \t]?[\)\]\}>][ \t-]{0,3}|[ \t-]{1,3}(?:dot|point)\b[ \t-]{1,3})"
_DIGITS = rf"(?:(?:{_NAME})\b|[0-9]++(?:\.[0-9]++)*+(?![A-Za-z_]))"
#: A run of digit names, digits and dots, with a plus in front or not.
_RUN = re.compile(rf"(?:\+[ \t]?|\bplus{_GAP}|(?<![A-Za-z0-9_.+])){_DIGITS}(?:(?:{_SPOKEN}|{_GAP}){_DIGITS})++", re.I)
#: On lower-cased text: what every run that is rewritten has, a name or a dot
#: in words or brackets next to another token.
_PAIR = re.compile(rf"(?:{_NAME})(?:{_GAP}|{_SPOKEN})(?:(?:{_NAME})\b|[0-9])|[0-9](?:{_GAP}(?:{_NAME})\b|{_SPOKEN}(?:(?:{_NAME})\b|[0-9]))")
_RUN_TOKEN = re.compile(rf"plus|\+|{_NAME}|{_SPOKEN}|[0-9.]+", re.I)

_WORD = r"[A-Za-z0-9_%+-]+"
_AT = r"(?:[ \t]{0,2}[\(\[\{<][ \t]?(?:at|@)[ \t]?[\)\]\}>][ \t]{0,2}|[ \t]{1,2}at[ \t]{1,2}|[ \t]?@[ \t]?)"
_DOT = r"(?:[ \t]{0,2}[\(\[\{<][ \t]?(?:dot|\.)[ \t]?[\)\]\}>][ \t]{0,2}|[ \t]{1,2}dot[ \t]{1,2}|\.)"
#: An address in disguise: word (dot word)* AT word (DOT word)+, found from its AT.
_DISGUISED_AT = re.compile(_AT, re.I)
#: The part before the AT, read backwards from it.
_DOT_BACK = r"(?:[ \t]{0,2}[\)\]\}>][ \t]?(?:tod|\.)[ \t]?[\(\[\{<][ \t]{0,2}|[ \t]{1,2}tod[ \t]{1,2}|\.)"
_BEFORE = re.compile(rf"{_WORD}(?:{_DOT_BACK}{_WORD})*", re.I)
_AFTER = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_ANY_DOT = re.compile(_DOT, re.I)


def _addresses(text: str, low: str) -> list[tuple[int, str, int]]:
    """(begin, replacement, end) of the disguised at and dots of addresses."""
    if "dot" not in low and not ("@" in low or "at" in low and any(c in text for c in "([{<")):
        return []
    edits: list[tuple[int, str, int]] = []
    last, backwards = 0, text[::-1]
    for m in _DISGUISED_AT.finditer(text):
        if m.start() < last:
            continue
        after = _AFTER.match(text, m.end())
        found = after and _BEFORE.match(backwards, len(text) - m.start(), len(text) - last)
        if not found:
            continue
        begin = m.start() - len(found[0])
        before = text[begin:m.start()]
        if m[0] == "@" and not re.search(r"dot|[\(\[\{<]", after[0] + before, re.I):
            continue
        if not re.search(r"[\(\[\{<@]", m[0]) and not re.search(r"dot|[\(\[\{<]", after[0], re.I):
            continue  # "look at example.com": prose, not an address
        edits += [(begin + d.start(), ".", begin + d.end()) for d in _ANY_DOT.finditer(before) if d[0] != "."]
        edits.append((m.start(), "@", m.end()))
        edits += [(m.end() + d.start(), ".", m.end() + d.end()) for d in _ANY_DOT.finditer(after[0]) if d[0] != "."]
        last = after.end()
    return edits


def _numbers(text: str, low: str) -> list[tuple[int, str, int]]:
    """(begin, replacement, end) of the tokens of spelled number runs; what
    stands between two tokens of a run is dropped."""
    edits: list[tuple[int, str, int]] = []
    if not _PAIR.search(low):
        return edits
    for run in _RUN.finditer(text):
        tokens = [(t, _value(t[0])) for t in _RUN_TOKEN.finditer(run[0])]
        if all(value == t[0] for t, value in tokens):
            continue  # digits as they are: the base patterns see them
        # joined, or with a blank where a name meets digits: "one 10.0.0.1" is not "110.0.0.1"
        joined = [(a.end(), b.start(), "") for (a, _), (b, _) in zip(tokens, tokens[1:])]
        named = [t[0].lower() in DIGIT_NAMES for t, _ in tokens]
        written = [t[0][0].isdigit() for t, _ in tokens]
        spaced = [(a, b, " " if named[k] and written[k + 1] or written[k] and named[k + 1] else "")
                  for k, (a, b, _) in enumerate(joined)]
        best = _reading(tokens, joined, spaced)
        if best is None:
            continue
        edits += [(run.start() + t.start(), value, run.start() + t.end()) for t, value in tokens]
        edits += [(run.start() + a, gap, run.start() + b) for a, b, gap in best if a < b]
    return edits


def _reading(tokens: list, joined: list, spaced: list) -> list | None:
    """The gaps that make the run an identifier, or else hold one."""
    found = []
    for gaps in (joined, spaced):
        number = tokens[0][1] + "".join(gap + value for (_, _, gap), (_, value) in zip(gaps, tokens[1:]))
        spans = base_spans(number)
        if any(a == 0 and b == len(number) for a, _, b in spans):
            return gaps
        found.append(spans)
    return spaced if found[1] else joined if found[0] else None


def _value(token: str) -> str:
    """What a token of a run stands for."""
    name = token.lower()
    return DIGIT_NAMES.get(name) or ("+" if name == "plus" else "." if re.search(r"dot|point|[\(\[{<]", name) else token)


def rewrite_tokens(text: str) -> Rewrite | None:
    """Second transducer; None if it leaves the text alone."""
    low = text.lower()
    edits = sorted(_addresses(text, low) + _numbers(text, low))
    if not edits:
        return None
    out, last = Rewrite(text), 0
    for begin, value, end in edits:
        if begin < last:
            continue  # both rules want these characters: the first one has them
        out.add(text[last:begin], last, begin)
        out.add(value, begin, end)
        last = end
    out.add(text[last:], last, len(text))
    return out


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a text."""
    if not text:
        return [], []
    base = base_spans(text)
    steps, seen = [], text
    for transducer in (fold_characters, rewrite_tokens):
        step = transducer(seen)
        if step:
            steps.append(step)
            seen = step.text()
    if not steps:
        return base, []
    added = []
    for begin, kind, end in base_spans(seen):
        for step in reversed(steps):
            begin, end = step.back(begin, end)
        # what a base span holds whole is known; a larger one is kept beside it
        if not any(a <= begin and end <= b for a, _, b in base):
            added.append((begin, kind, end))
    return base, added


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by ``<KIND>``; of overlapping spans
    the first names the joint range."""
    if not spans:
        return text
    out, last = [], 0
    end_of = None
    for a, k, b in sorted(spans):
        if end_of is not None and a < end_of:
            end_of = max(end_of, b)
            last = end_of
            continue
        out += [text[last:a], f"<{KINDS[k].upper()}>"]
        last = end_of = b
    return "".join(out) + text[last:]


RESULT = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
          ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
RESULT_SQL = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, n_added long")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts per kind, digest of the base
    spans, all spans, number of added spans."""
    start(docs.sparkSession)

    def scan(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                base, added = find_spans(text)
                kinds = [k for _, k, _ in base]
                rows.append((doc_id, *(kinds.count(k) for k in range(4)),
                             hashlib.sha256(span_text(base).encode()).hexdigest(),
                             span_text(base + added), len(added)))
            yield as_batch(rows, RESULT)

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, RESULT_SQL)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with all personal data in ``text`` replaced by its kind;
    the other columns stay (``n_chars``, where present, follows the new text)."""
    start(docs.sparkSession)
    at = docs.columns.index("text")
    names = docs.columns

    def scan(batches):
        for batch in batches:
            texts = [redacted(t, [s for part in find_spans(t) for s in part]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.mapInArrow(scan, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
