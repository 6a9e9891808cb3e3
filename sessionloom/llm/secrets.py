"""Secret scan: Aho-Corasick keyword prefilter, anchored expressions near hits, checksums.

One automaton pass over a text finds keywords, and an expression is tried only where its
keyword stands. Hexadecimal runs have no keyword; their prefilter looks for 24 letters of that
class in a row. Kinds with a checksum inside the token (GitHub and npm tokens: CRC-32 in base
62; IBAN: remainder of 97; payment cards: Luhn) are reported only if it holds.

Matches of one kind are leftmost and do not overlap: a match that fails a length rule still
uses up its characters. An IBAN or card number is looked for at every place near a word for it
where one may begin, at each length it can have (an IBAN's follows from its country, where that
is in the register; a card number ends at the end of a group of digits); the longest that passes
its checksum is taken, and what passes none uses up nothing. Spans are code points, end exclusive. A null or empty text has no
spans; repeated rows are scanned each; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.llm.common import releasing

# Kinds in the order spans at one place are listed; the first three are the base.
KINDS = ["assign", "access", "hex", "github", "npm", "iban", "card"]

# The expression of each kind and the keywords it can begin at.
EXPRESSIONS = {
    "assign": re.compile(
        rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        rb"""([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE,
    ),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    # The longest a number can reach; where it ends is tried.
    "iban": re.compile(rb"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"),
    "card": re.compile(rb"[0-9](?:[\x20-]?[0-9]){12,18}"),
}
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "iban": ["iban"],
    "card": ["card", "visa", "mastercard"],
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Bytes between a word of "iban" or "card" and its number, before or behind it.
NEAR = 24
# Letters and digits of an IBAN by country, from the register.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
SHORTEST = {"assign": 6, "access": 20, "hex": 24}

_HEX_LETTERS = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"h" * SHORTEST["hex"]


def _keyword_automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for word in keywords:
            machine.add_word(word, (kind, len(word)))
    machine.make_automaton()
    return machine


_machine = _keyword_automaton()


def _crc_holds(token: bytes) -> bool:
    """The last six characters are the CRC-32 of the ones before, in base 62."""
    value = 0
    for letter in token[-6:].decode():
        value = value * 62 + BASE62.index(letter)
    return value == zlib.crc32(token[:-6])


def _iban_holds(number: bytes) -> bool:
    compact = number.replace(b" ", b"").decode()
    digits = "".join(str(int(c, 36)) for c in compact[4:] + compact[:4])
    return 15 <= len(compact) <= 34 and int(digits) % 97 == 1


def _luhn_holds(number: bytes) -> bool:
    digits = [int(c) for c in number.decode() if c.isdigit()][::-1]
    doubled = [sum(divmod(2 * d, 10)) for d in digits[1::2]]
    return len(set(digits)) > 1 and (sum(digits[::2]) + sum(doubled)) % 10 == 0


# Bytes of the longest number, single spaces or dashes between its letters included.
_LONGEST = {"iban": 34 + 33, "card": 19 + 18}
# Where a number may begin: not inside a longer one.
_FIRST = {
    "iban": re.compile(rb"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}"),
    "card": re.compile(rb"(?<![0-9])[0-9]"),
}
_LETTER = {"iban": re.compile(rb"[A-Z0-9]"), "card": re.compile(rb"[0-9]")}


def _number_end(kind: str, raw: bytes, at: int) -> int | None:
    """End of the longest number of a kind that begins at ``at`` and passes its checksum."""
    match = EXPRESSIONS[kind].match(raw, at)
    if not match:
        return None
    ends = [at + m.end() for m in _LETTER[kind].finditer(match[0])]
    sizes = range(19, 12, -1)
    if kind == "iban":
        known = IBAN_LENGTHS.get(match[0][:2].decode())
        sizes = [known] if known else range(34, 14, -1)
    holds = _iban_holds if kind == "iban" else _luhn_holds
    for size in sizes:
        if size <= len(ends):
            end = ends[size - 1]
            if not _LETTER[kind].match(raw, end) and holds(raw[at:end]):
                return end
    return None


def _numbers(kind: str, raw: bytes, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Numbers of a kind that begin at most NEAR bytes behind one of the words or end at most
    NEAR bytes before it, leftmost first, without overlap."""
    ends: dict[int, int | None] = {}
    near = set()
    for start, end in words:
        low, high = max(0, start - NEAR - _LONGEST[kind]), min(len(raw), end + NEAR + 4)
        for m in _FIRST[kind].finditer(raw, low, high):
            at = m.start()
            if at not in ends:
                ends[at] = _number_end(kind, raw, at)
            until = ends[at]
            if until and (0 <= at - end <= NEAR or 0 <= start - until <= NEAR):
                near.add(at)
    upto = 0
    for at in sorted(near):
        if at >= upto:
            upto = ends[at]
            yield at, upto


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= SHORTEST[kind]
    if kind in ("access", "hex"):
        return match.end() - match.start() >= SHORTEST[kind]
    return _crc_holds(match[1])


def _hex_starts(raw: bytes) -> Iterator[int]:
    letters = raw.translate(_HEX_LETTERS)
    at = letters.find(_HEX_RUN)
    while at >= 0:
        yield at
        after = letters.find(b" ", at)
        at = letters.find(_HEX_RUN, after) if after >= 0 else -1


def _anchors(raw: bytes) -> dict[str, list[tuple[int, int]]]:
    """(begin, end) of the keywords of each kind, and of hexadecimal runs their begin twice."""
    found: dict[str, list[tuple[int, int]]] = {"hex": [(at, at) for at in _hex_starts(raw)]}
    for end, (kind, size) in _machine.iter(raw.lower().decode("latin-1")):
        found.setdefault(kind, []).append((end - size + 1, end + 1))
    return {kind: sorted(places) for kind, places in found.items()}


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    spans = []
    for kind, places in _anchors(raw).items():
        if kind in _FIRST:
            spans += [(kind, a, b) for a, b in _numbers(kind, raw, places)]
            continue
        upto = 0
        for at, _ in places:
            match = EXPRESSIONS[kind].match(raw, at) if at >= upto else None
            if match:
                upto = match.end()
                if _valid(kind, match):
                    spans.append((kind, match.start(), match.end()))
    if spans and len(raw) != len(text):
        # Bytes to code points, in one pass over the cut points.
        chars, done, upto = {}, 0, 0
        for cut in sorted({c for _, a, b in spans for c in (a, b)}):
            upto += len(raw[done:cut].decode("utf-8", "surrogatepass"))
            chars[cut] = upto
            done = cut
        spans = [(kind, chars[a], chars[b]) for kind, a, b in spans]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row struct of the input row, spans: array of kind, start, end). No shuffle."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("doc_text"))
    found = T.StructType.fromDDL("spans array<struct<kind:string,start:int,end:int>>")
    return rows.mapInArrow(releasing(_scan), T.StructType([rows.schema["row"], *found.fields]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find(text.as_py())]
            for text in batch["doc_text"]
        ]
        yield pa.RecordBatch.from_arrays([batch["row"], pa.array(spans, span)], ["row", "spans"])
