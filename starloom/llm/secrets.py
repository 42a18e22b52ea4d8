"""Secret scans with assignment-aware lexing.

Three fixed patterns find what looks like a secret by itself. Beyond them, the lexer
reads source and configuration syntax (``NAME = "..."``, ``name: value``,
``"name": "..."``, ``name => '...'``, annotated names, subscripts, ``#define``, elements,
joined and long literals) into name-literal pairs, carries constants through names that
stand for them (``KEY = "..."; db.password = KEY``), in whatever order they stand, and
scores each literal by how sensitive its target name is and how random it looks.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.arrow import map_rows

KINDS = ("assign", "access", "hex", "literal")

# The base patterns, with the least length of what must match.
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

# Words of sensitive names, by weight, and of literals that stand for nothing.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "pass": 2, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3,
    "credential": 3, "credentials": 3, "auth": 1, "bearer": 2, "private": 1, "access": 1, "api": 1, "key": 1,
    "signing": 1, "encryption": 1, "client": 1,
}
HARMLESS = ("example", "changeme", "placeholder", "your_", "your-", "dummy", "xxxx", "****", "todo", "none", "null")
#: A name and a literal flag together from this score on.
FLAG = 5.0

#: What every match of the first base pattern holds; the lexer reads all texts with an assignment.
_ASSIGN_HINTS = (b"passw", b"secret", b"token", b"key")
_IS_HEX = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_RUN = b"h" * LEAST["hex"]
_QUOTE = rb"""[rbfuRBFU]{0,2}["'`]"""
_STATEMENT = re.compile(
    rb"""(?<![\w.$-])(?:(["'])([A-Za-z_$][\w.$-]*+)\1\]?|([A-Za-z_$][\w.$-]*+))[ \t]*"""  # name, "name", ["name"]
    rb"""(?::[ \t]*[A-Za-z_&*][\w.\[\], |&<>*?]*+=[ \t]*(?=%s)|=>|:=|=(?!=)|:(?!:))[ \t]*"""  # : type =, or a sign
    rb"""(?:[(\[{][ \t]*\r?\n\s*(?=%s)|\\\r?\n[ \t]*)?""" % (_QUOTE, _QUOTE)  # the literal on the next line
)
_DEFINE = re.compile(rb"#[ \t]*define[ \t]+([A-Za-z_]\w*+)[ \t]+")
_ELEMENT = re.compile(rb"<([A-Za-z_][\w.-]*+)>[ \t]*([^<>\r\n]*[^<>\s])\s*</\1>")
_BLOCK = re.compile(rb"[|>][+-]?[ \t]*\r?\n")
_BLOCK_LINE = re.compile(rb"([ \t]+)([^\s][^\r\n]*)(?:\r?\n|\Z)")
_TERM = re.compile(
    rb'[rbfuRBFU]{0,2}"""((?:[^\\]|\\.)*?)"""'
    rb"|[rbfuRBFU]{0,2}'''((?:[^\\]|\\.)*?)'''"
    rb'|[rbfuRBFU]{0,2}"((?:[^"\\\r\n]|\\.)*)"'
    rb"|[rbfuRBFU]{0,2}'((?:[^'\\\r\n]|\\.)*)'"
    rb"|`((?:[^`\\]|\\.)*)`"
    rb"|([A-Za-z0-9_$+/.=-]+)",
    re.DOTALL,
)
_JOIN = re.compile(rb"[ \t]*[+.][ \t]*(?=[\"'A-Za-z_$])|[ \t]+(?=[\"'])")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> int:
    """Weight of the sensitive words in a name, whatever its spelling."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return sum(SENSITIVE.get(p, 0) for p in {*parts, *pairs})


_SEAM = max(map(len, HARMLESS)) - 1


class Value:
    """What a name stands for: literals (text, start, end) and earlier values, in
    order. Values share what they are made of, so a constant that is joined with
    itself over and over takes no more room than its statements; the joined text is
    never made, only what its score needs: the number of each character, its ends in
    lower case, and whether a harmless word stands in it, over a seam or not."""

    __slots__ = ("counts", "harmless", "head", "parts", "tail")

    def __init__(self, parts: list):
        self.parts, self.counts = parts, None

    def measured(self) -> Value:
        todo = [self]
        while todo:
            value = todo[-1]
            unknown = [p for p in value.parts if isinstance(p, Value) and p.counts is None] if value.counts is None else []
            if not unknown:
                if value.counts is None:
                    value._join()
                todo.pop()
            todo += unknown
        return self

    def _join(self) -> None:
        counts, self.head, self.tail, self.harmless = Counter(), "", "", False
        for p in self.parts:
            if isinstance(p, Value):
                head, tail, harmless = p.head, p.tail, p.harmless
                counts.update(p.counts)
            else:
                low = p[0].lower()
                head, tail, harmless = low[:_SEAM], low[-_SEAM:], any(h in low for h in HARMLESS)
                counts.update(p[0])
            self.harmless |= harmless or any(h in self.tail + head for h in HARMLESS)
            if len(self.head) < _SEAM:  # then it is all of the text so far
                self.head = (self.head + head)[:_SEAM]
            self.tail = tail if len(tail) == _SEAM else (self.tail + tail)[-_SEAM:]
        self.counts = counts

    def score(self) -> float:
        counts = self.measured().counts
        length = sum(counts.values())
        if length < 6 or self.harmless or self.head[:2] in ("${", "{{", "<%"):
            return -9.0
        entropy = -sum(n / length * math.log2(n / length) for n in counts.values())
        kinds = sum(any(f(c) for c in counts) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
        return (length >= 8) + (kinds >= 2) + (kinds >= 3) + max(0.0, entropy - 2) - 2 * (" " in counts)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, kinds of characters, entropy."""
    return Value([(value, 0, 0)]).score()


def _terms(data: bytes, at: int) -> list:
    parts = []
    while t := _TERM.match(data, at):
        quoted = t.lastindex != 6
        parts.append((t[t.lastindex], quoted, *t.span(t.lastindex)))
        at = t.end()
        if not (j := _JOIN.match(data, at)) or not quoted and j[0].isspace():
            break
        at = j.end()
    return parts


def _block(data: bytes, at: int) -> list:
    """The lines of a block scalar that begins at ``at``: those indented as far as the
    first, or further."""
    parts, indent = [], 0
    while (line := _BLOCK_LINE.match(data, at)) and len(line[1]) >= indent:
        indent = indent or len(line[1])
        parts.append((line[2], True, *line.span(2)))
        at = line.end()
    return parts


def pairs(data: bytes):
    """(name, parts) of each assignment, in order; a part is (literal or name, is a
    literal, start, end) in bytes."""
    found = []
    for m in _STATEMENT.finditer(data):
        block = _BLOCK.match(data, m.end()) if data[m.end() : m.end() + 1] in (b"|", b">") else None
        parts = _block(data, block.end()) if block else _terms(data, m.end())
        found.append((m.start(), m[2] or m[3], parts))
    if b"define" in data:
        found += [(m.start(), m[1], _terms(data, m.end())) for m in _DEFINE.finditer(data)]
    if b"</" in data:
        found += [(m.start(), m[1], [(m[2], True, *m.span(2))]) for m in _ELEMENT.finditer(data)]
    for _, name, parts in sorted(found, key=lambda x: x[0]):
        if parts:
            yield name.decode("latin-1"), parts


def sensitive_literals(data: bytes) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through names, which
    may be given their literal later on."""
    known: dict[str, Value] = {}
    flagged: list[Value] = []
    ahead: list[tuple[int, list]] = []  # targets with names that stand for nothing yet

    def judge(target, value):
        if target >= 2 and target + value.score() >= FLAG:
            flagged.append(value)

    for name, parts in pairs(data):
        held, open_names = [], False
        for raw, quoted, a, b in parts:
            text = raw.decode("utf-8", "replace")
            open_names |= not quoted and text not in known
            held.append((text, a, b) if quoted or text not in known else known[text])
        known[name] = value = Value(held)
        target = name_score(name)
        judge(target, value)
        if open_names and target >= 2:
            ahead.append((target, held))
    for target, held in ahead:
        later = [p if isinstance(p, Value) or p[0] not in known else known[p[0]] for p in held]
        if any(p is not q for p, q in zip(held, later)):
            judge(target, Value(later))
    out, met = set(), set()
    while flagged:
        value = flagged.pop()
        if id(value) not in met:
            met.add(id(value))
            for p in value.parts:
                if isinstance(p, Value):
                    flagged.append(p)
                else:
                    out.add(p[1:])
    return sorted(out)


def scan(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start and then kind."""
    low, found = data.lower(), []
    assigns = b"=" in data or b":" in data
    if assigns and any(h in low for h in _ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(data) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in data:
        found += [("access", *m.span()) for m in _ACCESS.finditer(data) if len(m[0]) >= LEAST["access"]]
    if _RUN in data.translate(_IS_HEX):
        found += [("hex", *m.span()) for m in _HEX.finditer(data) if len(m[0]) >= LEAST["hex"]]
    if assigns or b"</" in data or b"define" in data:
        found += [("literal", a, b) for a, b in sensitive_literals(data)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` (kind, start, end; code points, end exclusive; by
    start, then kind in the order of ``KINDS``) of each row.

    Null and empty texts have none; a null key stays null; repeated rows each give
    a row; other columns are not read.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))

    def each(k, data):
        found = scan(data or b"")
        if found and not data.isascii():
            points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
            found = [(kind, int(points[a]), int(points[b])) for kind, a, b in found]
        return k, [{"kind": kind, "start": a, "end": b} for kind, a, b in found]

    ddl = f"key {narrow.schema['key'].dataType.simpleString()}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return map_rows(narrow, lambda: each, ddl).withColumnRenamed("key", key)
