"""Secret scans by assignment-aware lexing.

Each text is read as source or configuration: names are paired with the literals assigned to them (`name = "x"`,
`name: x`, `"name": "x"`, `name := 'x'`, `name => x`, `export NAME=x`), constants are propagated (`a = "x"` then
`password = a`, and sums of strings), and a literal counts if the score of its target's name and its own look
reach a threshold. The spans so found have the kind `lex` and cover the literal. They come on top of three base patterns
(assign, access, hex), whose matches always stay; a literal inside a base span adds nothing.

Spans are in code points, end exclusive. Defined cases: null or empty text has no spans; a row for each input row, so
repeated rows repeat; other columns are not read. Texts are scanned whole, in linear time: every pattern
runs possessively or over disjoint classes, no unclosed quote is looked for twice, and values share the constants they
are made of (a graph, in which every literal is reported once). No shuffle, and a Python worker holds one small batch.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import bounded_batches, column

# The base patterns and how long a match has to be.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "lex")

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
# A run that is long enough starts where the run starts, so these give the base matches that pass.
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST},}}")
_NAMED = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The matches of the base patterns, leftmost and not overlapping within each kind."""
    out: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(x in low for x in _NAMED):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


_LEX = re.compile(
    r"""(?P<name>[A-Za-z_][A-Za-z0-9_]*+(?:[.-][A-Za-z0-9_]++)*+)|(?P<op>:=|=>|==|!=|<=|>=|[=:])|(?P<plus>\+)|(?P<end>[;,\n{}()\[\]]|\#|//)|(?P<bare>[^\s"'=:;,{}()\[\]\#]++)|(?P<quote>["'])|(?P<gap>[^\S\n]++)"""
)
_INNER = {q: re.compile(rf"(?:[^{q}\\\n]|\\.)*+") for q in "\"'"}
# Parts of names, and how much each says of a secret.
PARTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "private": 0.5, "auth": 0.5, "bearer": 0.8, "signing": 0.5, "encryption": 0.5,
    "api": 0.4, "access": 0.4, "key": 0.5, "salt": 0.5, "webhook": 0.4, "session": 0.3, "cookie": 0.3, "client": 0.2,
}
HARMLESS = {"public", "length", "size", "type", "name", "count", "max", "min", "url", "path", "file", "id", "field", "label", "policy", "hint", "ttl", "expiry", "limit", "tokenizer"}
# Literals that stand for a secret; beginnings, and ends, of such.
PLACEHOLDERS = {"changeme", "change_me", "example", "placeholder", "redacted", "dummy", "none", "null", "true", "false", "undefined", "todo"}
BEFORE, AROUND = ("${", "$(", "{{", "your_", "your-"), {"<>", "%%"}
_HEAD = 16
LEAST = 1.3


def name_score(name: str) -> float:
    """How sensitive a target is by the parts of its name."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]
    if any(p in HARMLESS for p in parts[-1:]):
        return 0.0
    return min(1.0, sum(PARTS.get(p, 0.0) for p in set(parts)))


class Look:
    """What is asked of a literal's text, kept without the text, so that sums of constants need not be written out: its length,
    how often each character comes (as a share; beyond ASCII by its low seven bits), its ends, whether it has white space."""

    __slots__ = ("n", "shares", "head", "last", "space")

    def __init__(self, text: str = ""):
        self.n, self.head, self.last, self.space = float(len(text)), text[:_HEAD], text[-1:], any(c.isspace() for c in text)
        self.shares: dict[int, float] = {}
        for c, k in Counter(text).items():
            c = ord(c) if c.isascii() else 128 + ord(c) % 128
            self.shares[c] = self.shares.get(c, 0.0) + k / self.n

    def __add__(self, other: Look) -> Look:
        out = Look()
        both = self.n + other.n
        out.n, out.space, out.last = min(both, 1e300), self.space or other.space, other.last or self.last
        out.head = self.head if len(self.head) == _HEAD else (self.head + other.head)[:_HEAD]
        if both:
            out.shares = {c: (self.shares.get(c, 0.0) * self.n + other.shares.get(c, 0.0) * other.n) / both for c in self.shares.keys() | other.shares.keys()}
        return out

    def random(self) -> float:
        """0 to 1: how much the text looks random; 0 for placeholders and very short ones."""
        if self.n < 6 or self.space or self._placeholder():
            return 0.0
        entropy = -sum(p * math.log2(p) for p in self.shares.values())
        kinds = {"a" if 97 <= c <= 122 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else "" for c in self.shares}
        return min(1.0, entropy / 5 + 0.1 * len(kinds))

    def _placeholder(self) -> bool:
        head = self.head.lower()
        if self.n < _HEAD and head in PLACEHOLDERS:
            return True
        if len(self.shares) <= 2 and {chr(c).lower() for c in self.shares} in ({"x"}, {"*"}, {"."}):
            return True
        return head.startswith(BEFORE) or (head[:1] + self.last) in AROUND


def look(value: str) -> float:
    return Look(value).random()


class Value:
    """What is assigned: literals (begin, end) and values assigned before, one after another. Shared, not copied: constants that
    double line by line stay as large as their lines."""

    __slots__ = ("parts", "seen", "_look")

    def __init__(self, parts: list):
        self.parts, self.seen, self._look = tuple(parts), False, None

    def look(self, text: str) -> Look:
        todo = [self]
        while todo:  # values name earlier ones only
            v = todo[-1]
            open_ = [x for x in v.parts if isinstance(x, Value) and x._look is None] if v._look is None else []
            if open_:
                todo += open_
                continue
            todo.pop()
            if v._look is None:
                v._look = Look()
                for x in v.parts:
                    v._look = v._look + (x._look if isinstance(x, Value) else Look(text[x[0] : x[1]]))
        return self._look

    def literals(self) -> Iterator[tuple[int, int]]:
        """The literals that no call for another value has given yet."""
        todo = [self]
        while todo:
            v = todo.pop()
            if not v.seen:
                v.seen = True
                for x in v.parts:
                    if isinstance(x, Value):
                        todo.append(x)
                    else:
                        yield x


def assigned(text: str) -> Iterator[tuple[str, Value]]:
    """Each target's name with the value that reaches it, constants propagated."""
    state = _State()
    at = 0
    while at < len(text):
        # lines without an assignment have nothing to lex, but those that one goes on in
        stop = _ASSIGNS.search(text, at)
        if stop is None:
            return
        at = text.rfind("\n", at, stop.start()) + 1 or at
        at = yield from _statement(text, at, state)


class _State:
    """What the lexer knows from line to line."""

    def __init__(self):
        self.known: dict[str, Value] = {}
        self.unclosed: set[str] = set()  # triple quotes that don't come again
        self.dead = {'"': 0, "'": 0}  # up to here no quote of the kind is closed

    def closing(self, text: str, at: int) -> int:
        """The place behind the quoted text that begins at `at`, 0 if it is not closed on its line. No stretch is looked at twice."""
        q = text[at]
        if at < self.dead[q]:
            return 0
        end = _INNER[q].match(text, at + 1).end()
        if text[end : end + 1] == q:
            return end + 1
        self.dead[q] = end
        return 0


_ASSIGNS = re.compile("[=:]")
_BLOCK = re.compile(r"[^\S\n]*+[|>][+\-0-9]{0,2}[^\S\n]*+(?:\#[^\n]*+)?\n")
_INDENT = re.compile(r"[^\S\n]*+")
_WORD_LINE = re.compile(r"^[^\S\n]*+(\S++)[^\S\n]*+$", re.MULTILINE)


def _words(text: str, at: int, end: int) -> list[tuple[int, int]]:
    """The lines that are one word: a key over several lines without its head and foot."""
    return [(m.start(1) + at, m.end(1) + at) for m in _WORD_LINE.finditer(text[at:end])]


def _statement(text: str, at: int, state: _State):
    """As assigned(), to the end of the line, or of what goes on behind it: brackets (to a blank line at most; on further lines
    quoted literals count), continued lines, triple quotes, block scalars. Returns the place behind."""
    before: str | None = None  # the last name, which an operator may make a target
    target: str | None = None
    known, unclosed = state.known, state.unclosed
    got: list = []  # literals and values, as a Value has them
    joined = True
    quoted_key = False
    colon: str | None = None  # the name before a colon, whose type may stand before an equals sign
    alias: str | None = None
    inside: list[str | None] = []  # the targets of open brackets
    further = False

    def done():
        if target is not None and got:
            value = known[target] = Value(got)
            if alias is not None:
                known[alias] = value
                return [(target, value), (alias, value)]
            return [(target, value)]
        return []

    def last() -> int:
        """Where the last literal ends; -1 behind anything else."""
        return got[-1][1] if got and isinstance(got[-1], tuple) else -1

    end = len(text)
    while at < end:
        m = _LEX.search(text, at)
        if m is None:
            break
        kind, s, e = m.lastgroup, *m.span()
        at = e
        if kind == "gap":
            continue
        if kind == "bare" and m[0] == "\\" and text[e : e + 1] == "\n":
            at = e + 1
            continue
        quotes = text[s : s + 3]
        if kind == "quote" and quotes in ('"""', "'''") and quotes not in unclosed:
            close = text.find(quotes, s + 3)
            if close >= 0:
                if target is not None and joined:
                    got += _words(text, s + 3, close)
                    joined = False
                at, before, quoted_key = close + 3, None, False
                continue
            unclosed.add(quotes)
        if kind == "quote" and (close := state.closing(text, s)):
            kind, at = "text", close
        if kind == "op":
            block = _BLOCK.match(text, e) if m[0] == ":" and before is not None else None
            if block:
                yield from done()
                at, indent = block.end(), len(_INDENT.match(text, text.rfind("\n", 0, s) + 1)[0])
                while at < end:
                    k = _INDENT.match(text, at).end()
                    if k < end and text[k] != "\n" and k - at <= indent:
                        break
                    at = text.find("\n", k) + 1 or end
                target, alias, got = before, None, _words(text, block.end(), at)
                yield from done()
                return at
            if m[0] in ("=", "==") and not joined and last() == s and (e == end or text[e].isspace()):
                got[-1] = (got[-1][0], e)  # padding of a bare literal
                before = None
                continue
            typed = colon if m[0] == "=" and not inside else None
            if m[0] in ("=", ":", ":=", "=>") and (before or typed) is not None:
                if target is not None and (not got or quoted_key):
                    del got[len(got) - quoted_key :]
                yield from done()
                target, got, joined = before or typed, [], True
                alias, colon = typed, before if m[0] == ":" else None
            before, quoted_key = None, False
        elif kind == "text":
            inner = (s + 1, at - 1)
            colon = None
            if target is not None and (joined or (inside and target == inside[-1] and got)):
                got.append(inner)
                joined = False
            elif target is not None:
                yield from done()
                target, got = None, []
            key = text[slice(*inner)]
            before, quoted_key = (key, target is not None) if re.fullmatch(r"[A-Za-z_][\w.-]*+", key, re.ASCII) else (None, False)
        elif kind in ("name", "bare"):
            if target is not None and not joined and last() == s:  # a bare literal goes on
                got[-1] = (got[-1][0], e)
                before = None
                continue
            if target is not None and joined and further and m[0] not in known:
                pass
            elif target is not None and joined:
                word = m[0]
                got.append(known[word] if word in known else (s, e))
                joined = False
            elif target is not None:
                yield from done()
                target, got = None, []
            before, quoted_key = (m[0] if kind == "name" else None), False
        elif kind == "plus":
            if target is not None and got and text[s - 1 : s].isspace():
                joined = True
            elif target is not None and last() == s:
                got[-1] = (got[-1][0], e)
            before = None
        elif kind == "end":
            opens, closes = m[0] in ("(", "[", "{"), m[0] in (")", "]", "}")
            if opens and (inside or (target is not None and joined and m[0] != "{")):
                if m[0] == "{":
                    yield from done()
                    target, got = None, []
                inside.append(target)
                before = None
                continue
            if inside and (closes or m[0] in (",", "\n")):
                if m[0] == "\n" and text[e : e + 1] == "\n":
                    inside = []
                else:
                    further = further or m[0] == "\n"
                    if m[0] == "," or target != inside[-1]:
                        yield from done()
                        target, alias, got, joined = inside[-1], alias if target == inside[-1] else None, [], True
                    if closes:
                        inside.pop()
                        joined, further = False, further and bool(inside)
                    before = None
                    continue
            yield from done()
            alias = None
            if m[0] in ",;{\n#" or m[0] == "//":
                colon = None
            if m[0] == "\n":
                return e
            target, got, before, joined = None, [], None, True
    yield from done()
    return end


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and those that the lexer adds."""
    base = sorted(base_spans(text), key=lambda x: (x[1], KINDS.index(x[0])))
    if "=" not in text and ":" not in text:
        return base, []
    more = set()
    for name, value in assigned(text):
        of = name_score(name)
        if of >= 0.5 and not value.seen and of + value.look(text).random() >= LEAST:
            more |= {("lex", s, e) for s, e in value.literals() if e > s}
    # base spans are in order of their starts: one walk finds the literals within them
    out, k, far = [], 0, -1
    for x in sorted(more, key=lambda x: x[1:]):
        while k < len(base) and base[k][1] <= x[1]:
            far = max(far, base[k][2])
            k += 1
        if x[2] > far:
            out.append(x)
    return base, out


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_lex long, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text): counts by kind, a digest of the base spans, all spans."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True):
                base, more = spans(text or "")
                n = Counter(x[0] for x in base)
                rows.append((doc_id, n["assign"], n["access"], n["hex"], len(more), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "n_assign", "n_access", "n_hex", "n_lex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
