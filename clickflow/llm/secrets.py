"""Secret scans: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax into name-value pairs: ``name = "x"``,
``name: x``, ``"name": "x"``, ``name := x``, ``name => x``, ``name=x`` and
``export NAME=x``. Constants are propagated: a value that is (or joins with ``+``) names
bound earlier in the text, or that holds ``${NAME}``, stands for the literals bound to
them. A literal is scored by the sensitivity of the name it reaches and by its own look
(length, character classes, entropy, no placeholder); those at ``MIN_SCORE`` or more give
spans of kind ``literal`` where the literal stands. Base spans always stay.

Each text is scanned alone, whole; no shuffle runs. Defined results: a null or empty text
has no spans; repeated rows each get their own row; an empty table gives an empty result;
extra columns are ignored (redaction keeps them, whatever their names). Names and literals may
have any length. Names are read back from their sign no further than the sign before, values
that share a run share its end, and each value is looked into once for each rise of a target's
score, so time grows with the text (but for scoring literals that lie inside one another).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from clickflow.llm.shared import small_batches

#: The base patterns (fixed values), in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "literal")

#: Name parts that make a target sensitive, with their weights.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8,
    "private": 0.5, "access": 0.4, "signing": 0.5, "encryption": 0.5, "key": 0.5, "api": 0.5,
    "salt": 0.6, "pass": 0.7, "pin": 0.4, "cookie": 0.4, "session": 0.3,
}
#: Name parts that say the value describes a secret rather than being one.
HARMLESS = {
    "name", "file", "path", "url", "uri", "length", "size", "count", "type", "id", "field", "label", "policy",
    "expiry", "ttl", "limit", "max", "min", "placeholder", "hint", "regex", "pattern", "index",
}
PLACEHOLDER = re.compile(
    r"^(?:x+|\*+|\.+|<.*>|\{.*\}|%.*%|null|none|nil|true|false|undefined|todo|changeme|change_me|example|"
    r"(?:your|my|the|some|test|dummy|sample|fake)[-_ ].*)$",
    re.IGNORECASE,
)
MIN_SCORE = 1.1

SIGN = re.compile(r"(?::=|=>|[=:])(?![=:>~])")
QUOTED = re.compile(r'"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`((?:[^`\\]|\\.)*)`')
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
JOIN = re.compile(r"[ \t]*\+[ \t]*")
REFERENCE = re.compile(r"\$\{([A-Za-z_]\w*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_]\w*)\}")
IDENTIFIER = re.compile(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*\Z")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|[^A-Za-z0-9]+")
BLANKS = re.compile(r"[ \t]*")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Literal(NamedTuple):
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, in code points, ordered by start, then kind."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def name_score(name: str) -> float:
    """How sensitive a target name is, from its parts."""
    parts = [p.lower().rstrip("0123456789") for p in CAMEL.split(name.rpartition(".")[2])]
    parts = [p for p in parts if p]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts))


def literal_score(text: str) -> float:
    """How much a literal looks like a secret: 0 for placeholders, prose and short values."""
    if len(text) < 8 or PLACEHOLDER.match(text) or any(c.isspace() for c in text):
        return 0.0
    n = len(text)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(text).values())
    classes = sum(
        (
            any(c.islower() for c in text),
            any(c.isupper() for c in text),
            any(c.isdigit() for c in text),
            any(not c.isalnum() for c in text),
        )
    )
    return min(1.0, 0.15 * classes + 0.15 * entropy)


def _name_before(text: str, end: int, floor: int) -> str | None:
    """The name that ends before ``end``, blanks aside, and starts at ``floor`` or later. No name
    holds a sign, so with the last sign's end for a floor each character is visited once."""
    while end > floor and text[end - 1] in " \t":
        end -= 1
    quote = text[end - 1] if end > floor and text[end - 1] in "\"'" else ""
    signs = "_.$ -" if quote else "_.$[]-"
    end -= len(quote)
    start = end
    while start > floor and (text[start - 1].isalnum() or text[start - 1] in signs):
        start -= 1
    if quote:
        if start == floor or text[start - 1] != quote or not _begins_name(text[start]):
            return None
        return text[start:end]
    while start < end and not _begins_name(text[start]):
        start += 1
    return text[start:end] or None


def _begins_name(c: str) -> bool:
    return c.isascii() and c.isalpha() or c in "_$"


class _Lexer:
    """Name-value pairs of one text. A value is a list of literals and of other names' values."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.known: dict[str, list] = {}
        self.bare = (0, 0)

    def pairs(self) -> Iterator[tuple[str, list]]:
        floor = 0
        for sign in SIGN.finditer(self.text):
            name = _name_before(self.text, sign.start(), floor)
            floor = sign.end()
            if name is None:
                continue
            value = self._value(sign.end())
            if value:
                self.known[name] = value
            yield name, value

    def _bare(self, at: int) -> int:
        """The end of the unquoted value at ``at``; values of one run end together."""
        if not self.bare[0] <= at < self.bare[1]:
            m = BARE.match(self.text, at)
            if m is None:
                return at
            self.bare = m.span()
        return self.bare[1]

    def _value(self, at: int) -> list:
        """What the value at ``at`` stands for: literals, and the values of names it refers to."""
        text, known = self.text, self.known
        found: list = []
        while True:
            at = BLANKS.match(text, at).end()
            if m := QUOTED.match(text, at):
                body = next(g for g in m.groups() if g is not None)
                refs = [r for g in REFERENCE.findall(body) for r in g if r]
                if refs and all(r in known for r in refs):
                    found += [known[r] for r in refs]
                elif body:
                    found.append(Literal(at + 1, m.end() - 1))
                after = m.end()
            elif m := REFERENCE.match(text, at):
                if (name := next(g for g in m.groups() if g)) in known:
                    found.append(known[name])
                after = m.end()
            elif (after := self._bare(at)) > at:
                end = after
                while end > at and text[end - 1] == ".":
                    end -= 1
                plain = IDENTIFIER.match(text, at, end)
                word = text[at:end] if plain else None
                if word in known:
                    found.append(known[word])
                elif word is None or any(c.isdigit() for c in word):
                    # An unbound plain name refers to something unseen; configuration values
                    # without quotes are told from names by a digit or a sign.
                    found.append(Literal(at, end))
            else:
                return found
            joined = JOIN.match(text, after)
            if not joined:
                return found
            at = joined.end()


def literal_spans(text: str) -> list[Span]:
    """Spans of literals that reach a sensitive name, ordered, each once."""
    lexer, spans = _Lexer(text), set()
    # The greatest target score with which a value was looked into: nothing new is found with
    # less. Values are kept with it, so that an id stays its value's.
    walked: dict[int, tuple[float, list]] = {}
    for name, value in lexer.pairs():
        target = name_score(name)
        todo = [value] if target else []
        while todo:
            value = todo.pop()
            if walked.get(id(value), (0.0,))[0] >= target:
                continue
            walked[id(value)] = (target, value)
            for x in value:
                if not isinstance(x, Literal):
                    todo.append(x)
                    continue
                word = text[x.start : x.end]
                score = literal_score(word)
                if score and target + score >= MIN_SCORE and word not in lexer.known:
                    spans.add(Span(x.start, 3, x.end))
    return sorted(spans)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those of the lexer that lie in no base span."""
    base = base_spans(text)
    if ":" not in text and "=" not in text:
        return base, base
    more, at, reach = [], 0, 0
    for s in literal_spans(text):
        while at < len(base) and base[at].start <= s.start:
            reach, at = max(reach, base[at].end), at + 1
        if reach < s.end:
            more.append(s)
    return base, sorted(base + more)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def _scan_rows(texts: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")}
    for text in texts:
        base, spans = all_spans(text or "")
        kinds = Counter(s.kind for s in spans)
        for k, name in enumerate(("n_assign", "n_access", "n_hex", "n_literal")):
            out[name].append(kinds[k])
        out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
        out["spans"].append(listed(spans))
    return out


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document its counts by kind, the digest of its base spans and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scan_rows(batch.column(1).to_pylist())
            arrays = [batch.column(0)]
            arrays += [pa.array(v, pa.int64() if k[:2] == "n_" else pa.string()) for k, v in found.items()]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *found])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        run,
        f"doc_id {doc_id}, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string",
    )


def redact(text: str, mask: str = "[SECRET]") -> str:
    """``text`` with every span replaced by ``mask``; of an assignment, only its value."""
    out, at = [], 0
    for s in all_spans(text)[1]:
        start = s.start
        if s.kind == 0:
            start = ASSIGN.match(text, s.start).start(2)
        if s.end <= at:
            continue
        out += [text[at : max(at, start)], mask if start >= at else ""]
        at = s.end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with secrets masked in ``text`` and ``n_chars`` (if there) renewed."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            clean = [None if t is None else redact(t) for t in texts]
            arrays = list(batch.columns)
            arrays[at] = pa.array(clean, batch.schema.field(at).type)
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                old = batch.column(n).to_pylist()
                new = [o if c == t else len(c) for o, c, t in zip(old, clean, texts, strict=True)]
                arrays[n] = pa.array(new, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return small_batches(docs).mapInArrow(run, schema)
