"""Secret scanning: fixed patterns, and an assignment-aware lexer.

The patterns (``assign``, ``access``, ``hex``) run over the whole text. The
lexer reads a text that assigns to a sensitive name as source code or
configuration: tokens, then name-literal pairs (``name = "x"``, ``name: x``,
``"name": "x"``, ``map["name"] = x``, ``name => x``, ``put("name", "x")``,
``<name>x</name>``, ``--name x``), where the right side is a chain of literals
and names. Names stand for what was last assigned to them, or, if nothing was
before, first after; so ``A = "x"``, ``password = A + "y"`` gives both
literals the name ``password``. A pair's score is the weight of its target
name's words times the strength of the joined value; literals of pairs that
reach ``THRESHOLD`` are spans of kind ``pair``, but for those that lie inside a
pattern's span. Work is linear in the text but for sorting.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import prepare, table, text_bytes

# The contract's patterns, and how long a match must be.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")  # greedy, so runs are found whole
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "pair")

# Words of a target name and how sensitive they make it; two words in a row count as one entry.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 1.0, "token": 1.0,
    "apikey": 1.0, "api key": 1.0, "private key": 1.0, "secret key": 1.0, "access key": 1.0, "signing key": 1.0, "encryption key": 1.0,
    "master key": 1.0, "account key": 1.0, "auth key": 1.0, "client secret": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9,
    "pass": 0.8, "jwt": 0.8, "authorization": 0.8, "auth": 0.7, "signature": 0.6, "salt": 0.6, "cookie": 0.6, "session": 0.5, "key": 0.5, "pin": 0.5,
}
# Last words that say the value is about a secret and not one.
ABOUT = frozenset("name id ids file path url uri endpoint field label hint type length len count policy size ttl expiry expires column "
                  "prefix header param parameter format pattern regex class algorithm alg provider manager service store vault arn".split())
STEMS = rb"pass|pwd|secret|token|api_?key|[_-]key|key[_-]|privatekey|accesskey|credential|bearer|jwt|auth|signature|salt|cookie|session"
PLACEHOLDER = re.compile(rb"(?i)^(?:<.*>|\$?\{.*\}|%.*%|\[.*\]|x+|\*+|\.+|-+|_+|none|null|nil|true|false|undefined|todo|tbd|n/?a)$"
                         rb"|change[_ -]?me|place[_ -]?holder|your[_ -]|example|redacted|insert[_ -]|replace[_ -]|dummy|sample")
THRESHOLD = 0.6
STRONG_BITS = 60.0
_VALUE = 512  # characters of a joined value that are scored; the score is at its most long before

_SENSITIVE = re.compile(rb"(?i)(?:" + STEMS + rb")[\w.\-]{0,64}[\"'\]>]{0,2}[ \t]{0,64}(?:=|:|,|<|[\w$])")
_TOKEN = re.compile(rb"""
  (?P<space>[ \t\r\f\v]+)
| (?P<line>\n)
| (?P<string>(?<![\w])[rRbBuUfF]{0,2}(?:\"{3}(?:[^\"\\]|\\.|\"(?!\"\"))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3}|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`))
| (?P<name>[A-Za-z_$@][\w$]*(?:(?:[-.]|->|::)[A-Za-z0-9_$]+)*)
| (?P<op>=>|:=|\+=|\?=|\|\|=|==|!=|<=|>=|<-|::|[=:+.,;(){}\[\]<>/\\])
| (?P<other>\d[\w.]*|.)
""", re.VERBOSE | re.DOTALL)
_BARE = re.compile(rb"[^\s,;\"'`(){}\[\]<>]+")
_REFERENCE = re.compile(rb"\$\{?([A-Za-z_]\w*)\}?$")
_NAME = re.compile(rb"[A-Za-z_$@][\w$]*(?:(?:[-.]|->|::)[A-Za-z0-9_$]+)*$")
_INSIDE = re.compile(rb"\$\{([A-Za-z_]\w*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_]\w*)\}")
_ELEMENT = re.compile(rb"<([A-Za-z_][\w.:-]{0,80})>([^<>\n]+)</([A-Za-z_][\w.:-]{0,80})>")
_FLAG = re.compile(rb"(?<![\w-])--?([A-Za-z][\w-]{0,80})[ \t]+([^\s\"'-][^\s\"']*)")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_WRAP = frozenset({b"str", b"bytes", b"string", b"String", b"unicode", b"b64decode", b"base64.b64decode", b"Buffer.from", b"atob",
                   b"SecretStr", b"SecureString", b"to_secure"})
_ASSIGNS = frozenset({b"=", b":=", b"=>", b":", b"+=", b"?=", b"||=", b"<-"})


class Literal(NamedTuple):
    start: int  # of the content, in bytes
    end: int
    quoted: bool


class Pair(NamedTuple):
    """``name`` gets the ``terms``: literals, and names as bytes."""
    name: bytes
    terms: list


# --- lexer -------------------------------------------------------------------------

class _Reader:
    """Name-literal pairs of a text."""

    def __init__(self, text: bytes) -> None:
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text)]
        self.starts = [t[1] for t in self.tokens]

    def word(self, k: int) -> bytes:
        return self.text[self.tokens[k][1]:self.tokens[k][2]]

    def skip(self, k: int, step: int, lines: bool = False) -> int:
        """The next token from ``k`` on that is no space."""
        while 0 <= k < len(self.tokens) and (self.tokens[k][0] == "space" or lines and (self.tokens[k][0] == "line" or self.word(k) == b"\\")):
            k += step
        return k

    def kind(self, k: int) -> str:
        return self.tokens[k][0] if 0 <= k < len(self.tokens) else "end"

    def content(self, k: int) -> Literal:
        """A string token without its prefix and quotes."""
        _, a, b = self.tokens[k]
        while self.text[a:a + 1] not in (b'"', b"'", b"`"):
            a += 1
        n = 3 if b - a >= 6 and self.text[a:a + 3] in (b'"""', b"'''") else 1
        return Literal(a + n, b - n, True)

    def is_op(self, k: int, *ops: bytes) -> bool:
        return self.kind(k) == "op" and self.word(k) in ops

    def target(self, k: int) -> bytes | None:
        """The name that the operator at ``k`` assigns to."""
        k = self.skip(k - 1, -1)
        if self.is_op(k, b"]"):
            k = self.skip(k - 1, -1)
            if not (self.kind(k) == "string" and self.is_op(self.skip(k - 1, -1), b"[")):
                return None
        if self.kind(k) == "name":
            return self.word(k)
        if self.kind(k) == "string":
            at = self.content(k)
            own = self.text[at.start:at.end]
            return own if len(own) <= 80 and re.fullmatch(rb"[\w$@][\w$@ .:-]*", own) else None
        return None

    def value(self, k: int) -> tuple[list, int]:
        """The terms from token ``k`` on, and the token after them."""
        terms: list = []
        while True:
            k = self.skip(k, 1, bool(terms))
            kind = self.kind(k)
            if kind == "string":
                terms.append(self.content(k))
                k += 1
            elif kind in ("name", "other", "op") and (run := _BARE.match(self.text, self.tokens[k][1])) and not (kind == "op" and self.word(k) in _ASSIGNS):
                own, a, b = run[0], run.start(), run.end()
                after = bisect_left(self.starts, b)
                if (ref := _REFERENCE.match(own)) or self.text[a:a + 2] == b"${":
                    ref = ref or re.compile(rb"\$\{([A-Za-z_]\w*)\}").match(self.text, a)
                    if not ref:
                        return terms, after
                    terms.append(ref[1])
                    k = bisect_left(self.starts, ref.end() if ref.string is self.text else b)
                elif self.is_op(after, b"("):
                    inner = self.skip(after + 1, 1)
                    close = self.skip(inner + 1, 1)
                    if own not in _WRAP or self.kind(inner) != "string" or not self.is_op(close, b")", b","):
                        return terms, after
                    terms.append(self.content(inner))
                    while not (self.is_op(close, b")") or self.kind(close) in ("line", "end")):
                        close += 1
                    k = close + 1
                elif _NAME.match(own) and len(own) <= 200:
                    terms.append((own, Literal(a, b, False)))
                    k = after
                else:
                    terms.append(Literal(a, b, False))
                    k = after
            else:
                return terms, k
            here = self.skip(k, 1)
            on = self.skip(k, 1, True)
            if self.is_op(on, b"+") or self.is_op(here, b"."):
                k = (on if self.is_op(on, b"+") else here) + 1
            elif self.kind(here) == "string" and isinstance(terms[-1], Literal) and terms[-1].quoted:
                k = here
            else:
                return terms, k

    def pairs(self) -> list[tuple[int, Pair]]:
        out, k = [], 0
        while k < len(self.tokens):
            kind, start, _ = self.tokens[k]
            if kind != "op":
                k += 1
                continue
            op, to = self.word(k), k + 1
            if op in _ASSIGNS:
                name = self.target(k)
                if op == b":" and name is not None:  # name: type = value
                    typed = self.skip(k + 1, 1)
                    then = self.skip(typed + 1, 1)
                    if self.kind(typed) == "name" and self.is_op(then, b"="):
                        to = then + 1
                if name is not None:
                    terms, after = self.value(to)
                    if terms:
                        out.append((start, Pair(name, terms)))
                    if after > to and all(isinstance(t, Literal) and t.quoted for t in terms):
                        to = after if not self.is_op(self.skip(after, 1), *_ASSIGNS) else to
            elif op == b"," and self.kind(before := self.skip(k - 1, -1)) == "string" and self.is_op(self.skip(before - 1, -1), b"("):
                name = self.target(k)
                if name is not None:
                    terms, _ = self.value(to)
                    if terms:
                        out.append((start, Pair(name, terms)))
            k = to
        return out


def pairs_of(text: bytes) -> list[Pair]:
    """The name-literal pairs of a source or configuration text, in order."""
    out = _Reader(text).pairs()
    out += [(m.start(), Pair(m[1], [Literal(m.start(2), m.end(2), True)])) for m in _ELEMENT.finditer(text) if m[1] == m[3]]
    out += [(m.start(), Pair(m[1], [Literal(m.start(2), m.end(2), False)])) for m in _FLAG.finditer(text)]
    return [p for _, p in sorted(out, key=lambda x: x[0])]


# --- scores ------------------------------------------------------------------------

def name_weight(name: bytes) -> float:
    """How sensitive a target name is, 0 to 1."""
    words = [w.lower() for w in _WORDS.findall(name.decode("ascii", "ignore"))]
    if not words or words[-1] in ABOUT or "public" in words:
        return 0.0
    both = [" ".join(p) for p in zip(words, words[1:], strict=False)]
    return max((WEIGHTS.get(w, 0.0) for w in [*words, *both, "".join(words)]), default=0.0)


def value_strength(value: bytes, quoted: bool) -> float:
    """How much a value looks like a secret, 0 to 1."""
    if len(value) < 6 or PLACEHOLDER.search(value) or any(c in value for c in b"\n\t"):
        return 0.0
    counts = Counter(value)
    bits = -sum(n * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(c, value)) for c in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9]"))
    spaces = value.count(b" ")
    if spaces > 2:  # a sentence
        return 0.0
    strength = min(1.0, bits / STRONG_BITS)
    if quoted:
        return (0.35 + 0.65 * strength) * (0.8 if kinds == 1 else 1.0)
    return strength * (0.5 if kinds == 1 or not re.search(rb"[0-9]", value) else 1.0)


class Found(NamedTuple):
    name: bytes
    spans: list[tuple[int, int]]  # bytes
    score: float
    via: tuple[bytes, ...]


def _simple(name: bytes) -> bytes:
    """The last part of a dotted name: what it is bound to."""
    return re.split(rb"\.|->|::", name)[-1]


class _Constants:
    """What the names on the right sides of a text's pairs stand for."""

    def __init__(self, text: bytes, pairs: list[Pair]) -> None:
        self.text, self.pairs = text, pairs
        self.bound: dict[bytes, list[int]] = {}
        for k, p in enumerate(pairs):
            self.bound.setdefault(_simple(p.name), []).append(k)
        self._parts: dict[int, list] = {}
        self._values: dict[int, tuple[bytes, bool]] = {}

    def meaning(self, name: bytes, at: int) -> int | None:
        """The pair that binds a name used in pair ``at``: the last one before, or the first after."""
        places = self.bound.get(_simple(name))
        if not places:
            return None
        k = bisect_left(places, at)
        return places[k - 1] if k else next((p for p in places[:2] if p != at), None)

    def parts(self, k: int) -> list:
        """The right side of a pair: numbers of other pairs, and literals with
        the bytes they add to its value."""
        if k not in self._parts:
            out: list = []
            for term in self.pairs[k].terms:
                own = term
                if not isinstance(term, Literal):
                    name, own = (term, None) if isinstance(term, bytes) else term
                    to = self.meaning(name, k)
                    if to is not None:
                        out.append(to)
                        continue
                if own is not None:
                    raw = self.text[own.start:own.end]
                    inner = [to for m in _INSIDE.finditer(raw) if (to := self.meaning(m[1] or m[2] or m[3], k)) is not None] if own.quoted else []
                    out += [(own, _INSIDE.sub(b"", raw) if inner else raw), *inner]
            self._parts[k] = out
        return self._parts[k]

    def value(self, k: int) -> tuple[bytes, bool]:
        """The joined value of a pair (its first ``_VALUE`` bytes) and whether
        it has quoted parts. Each pair is joined once; one that needs itself
        adds nothing there."""
        todo, begun = [k], set()
        while todo:
            at = todo[-1]
            if at in self._values:
                todo.pop()
                continue
            missing = [p for p in self.parts(at) if isinstance(p, int) and p not in self._values and p not in begun and p != at]
            if at not in begun and missing:
                begun.add(at)
                todo += missing
                continue
            value, quoted = b"", False
            for p in self.parts(at):
                raw, q = self._values.get(p, (b"", False)) if isinstance(p, int) else (p[1], p[0].quoted)
                value, quoted = (value + raw)[:_VALUE], quoted or q
            self._values[at] = value, quoted
        return self._values[k]


def sensitive_pairs(text: bytes, threshold: float = THRESHOLD) -> list[Found]:
    """The pairs whose target name and value, constants propagated, score
    ``threshold`` or more. A literal that reaches several such names is listed
    under the first."""
    if not _SENSITIVE.search(text):
        return []
    pairs = pairs_of(text)
    constants = _Constants(text, pairs)
    out, told = [], set()
    for k, pair in enumerate(pairs):
        weight = name_weight(pair.name)
        if weight < threshold or k in told:
            continue
        score = weight * value_strength(*constants.value(k))
        if score < threshold:
            continue
        spans, via, todo = [], [], [k]
        told.add(k)
        while todo:
            p = todo.pop()
            if isinstance(p, int):
                if p != k:
                    if p in told:
                        continue
                    told.add(p)
                    via.append(pairs[p].name)
                todo += reversed(constants.parts(p))
            elif p[1]:
                spans.append((p[0].start, p[0].end))
        if spans:
            out.append(Found(pair.name, spans, round(score, 4), tuple(via)))
    return out


# --- texts -------------------------------------------------------------------------

def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in bytes of the patterns' matches, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def added_spans(base: list[tuple[int, int, int]], found: list[Found]) -> list[tuple[int, int, int]]:
    """The literals of ``found`` that lie in no span of ``base``."""
    starts, reach = [b[0] for b in base], np.maximum.accumulate([b[2] for b in base]).tolist() if base else []
    out = set()
    for a, b in {s for f in found for s in f.spans}:
        k = bisect_left(starts, a + 1)
        if not (k and reach[k - 1] >= b):
            out.add((a, 3, b))
    return sorted(out)


def _points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in bytes as spans in code points."""
    if not spans or text.isascii():
        return spans
    more = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    return [(a - int(more[a]), kind, b - int(more[b])) for a, kind, b in spans]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_bytes(column)
    raw, at = data.tobytes(), offsets.tolist()
    return (raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_pair long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    for batch in batches:
        rows = []
        for text in _texts(batch.column(1)):
            base = base_spans(text)
            added = added_spans(base, sensitive_pairs(text))
            kinds = [kind for _, kind, _ in base]
            rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(_listed(_points(text, base)).encode()).hexdigest(),
                         _listed(sorted(_points(text, base + added))), len(added)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds))], names=names)


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id>, n_assign, n_access, n_hex, base_sha256``
    (of the patterns' spans), ``spans`` (these and the lexer's, as
    ``kind:start:end`` in code points) and ``n_pair``, the lexer's.

    Null and empty texts have no span; null ids are ids like others; repeated
    rows give repeated rows; other columns are ignored, whatever their names;
    an empty table gives an empty result. A text is one unit of work.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, _SCHEMA)
    return rows.withColumnRenamed("doc_id", id_col)


_PAIRS = "doc_id long, name string, start long, end long, score double, via string, value string"


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _PAIRS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string()]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
            for f in sensitive_pairs(text):
                spans = [(a, 3, b) for a, b in f.spans]
                for (a, _, b), (s, _, e) in zip(spans, _points(text, spans), strict=True):
                    rows.append((doc_id, f.name.decode(), s, e, f.score, ",".join(v.decode() for v in f.via), text[a:b].decode()))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)], names=names)


def secret_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per literal of a sensitive pair, those inside a pattern's span
    too: ``<id>, name, start, end, score, via`` (the constants it came through)
    and ``value``. Nulls and odd tables as in ``secret_digest``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_list, _PAIRS)
    return rows.withColumnRenamed("doc_id", id_col)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: secrets of all documents."""
    prepare(spark)
    return secret_digest(table(spark, sf_dir, "documents"))
