"""Secret scans: fixed patterns, and assignments lexed from source and configuration syntax.

The lexer walks a text once. It reads string literals (single, double, triple and back quotes, prefixes, escapes) and, around
them, these forms of a name with a value:
- `name = v`, `name := v`, `name += v`, `name => v`, `name: v`, `Type name = v`, `var name type = v`, `name: type = v`;
- `"name": v`, `'name' => v`, `table["name"] = v`, `$name = v`, `export NAME=v`, `-- name: v` (comments are read like code);
- `<name>v</name>`, `<entry key="name">v</entry>`, `name="v"`, `key="name" value="v"`;
- `call(name="v")`, `set_name("v")`, `put("name", "v")`, and the default of `getenv("X", "v")`;
- `name: |` with an indented block; values in round brackets, on the next line and after a continued one (`= \\`);
- lists `name = ["v", "w"]`, `name: [v, w]`, `name:` with `- v` lines below, and entries of `name = {...}` (also under the names of the entries);
- `a, name = "u", "v"` at the beginning of a line, and the other branches `x or "v"`, `x || "v"`, `x ?? "v"`, `u if c else "v"`, `c ? "u" : "v"`.
A value is a literal, a bare word up to white space or a bracket, or a sum of these and of names (`a + "b"`, `"a" "b"`, `"a" . $b`,
`f"{a}b"`, `"${a}b"`). Names keep the literals that they stand for, in text order; a name that is set to something else is
forgotten (constant propagation). Each literal is scored by its target's name and its own shape. A literal at
or over THRESHOLD is a span of kind `literal`. Positions are code points, end exclusive.

What a name stands for is a summary of constant size (length, characters folded to 256 counts, ends) and a link to its
parts, so sums of any number of parts are scored, each part is reported once, and all passes are linear in the text.

Defined cases: null and empty texts give no spans (zero counts, the digest of nothing). Repeated rows give
equal rows. Literals with white space are no secrets; the lines of a block are one value. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")
THRESHOLD = 0.7

# Parts of target names that point to a secret, with their weight.
SENSITIVE = {
    "password": 0.6, "passwd": 0.6, "passphrase": 0.6, "pwd": 0.5, "secret": 0.6, "token": 0.5, "apikey": 0.6,
    "accesskey": 0.6, "privatekey": 0.6, "signingkey": 0.6, "encryptionkey": 0.6, "authkey": 0.6, "credential": 0.5,
    "bearer": 0.4, "authorization": 0.4, "connectionstring": 0.4,
}
# Literals that only stand for a secret, whole and by their beginning.
STAND_INS = {"none", "null", "true", "false", "changeme", "change_me", "dummy", "test", "todo", "redacted"}
STAND_IN_STARTS = ("example", "your_", "your-")
#: Beginnings and ends of literals that are filled in elsewhere.
TEMPLATES = (("<", ">"), ("${", "}"), ("{{", "}}"), ("%", "%"))

_STRING = (
    r"(?:(?<!\w)[rRbBfFuU]{1,2})?(?:\"\"\"(?:[^\"\\]|\\.|\"(?!\"\"))*+\"\"\"|(?<!\w)'''(?:[^'\\]|\\.|'(?!''))*+'''|\"(?:[^\"\\\n]|\\.)*+\""
    r"|(?:(?<!\w)|(?<=(?<!\w)[rRbBfFuU])|(?<=(?<!\w)[rRbBfFuU]{2}))'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)"
)
_OPERATOR = r"=>|:=|->|\+?=(?![=>])|:(?![:/=])"
#: What the walk stops at: escapes, elements, strings, names with an operator after them, calls.
_EVENT = re.compile(
    rf"(?P<escape>\\.)|<(?P<element>[A-Za-z_][\w.:-]*+)(?P<attributes>[^<>\n]*+)>(?P<content>[^<\n]++)</(?P=element)>|(?P<string>{_STRING})"
    rf"|(?<![\w.$-])(?P<name>[A-Za-z_$][\w.$-]*+)(?:[ \t]*+(?P<operator>{_OPERATOR})|(?P<call>\())|(?P<brace>[{{}}])",
    re.ASCII | re.DOTALL,
)
_AFTER_STRING = re.compile(rf"[ \t]*+\]?[ \t]*+(?:{_OPERATOR})", re.ASCII)
_TYPE = re.compile(r"[ \t]*+[A-Za-z_&*][\w.\[\], |&*<>?]*+=(?![=>])", re.ASCII)
_BLOCK = re.compile(r"[ \t]*+[|>][+-]?[0-9]?[ \t]*+\n")
_OPEN = re.compile(r"[ \t]*+(?:\([ \t]*+)*+")
_NEXT_LINE = re.compile(r"\s*+\(?\s*+(?=[rRbBfFuU]{0,2}[\"'`])")
_TERM = re.compile(rf"(?P<quoted>{_STRING})|[^\s\"'`,;(){{}}\[\]<>]++", re.ASCII | re.DOTALL)
_PLUS = re.compile(r"[ \t]*+(?:\+|\.\.|&|\|\||~|\.(?=[ \t]*+[\"'$]))\s*+")
_BESIDE = re.compile(r"(?:[ \t]|\\\n)*+(?=[rRbBfFuU]{0,2}[\"'`])")
_BESIDE_OPEN = re.compile(r"(?:\s|\\\n)*+(?=[rRbBfFuU]{0,2}[\"'`])")
_ARGUMENT = re.compile(rf"\s*+(?P<quoted>{_STRING})\s*+", re.ASCII | re.DOTALL)
_HOLE = re.compile(r"\$?\{\s*([A-Za-z_][\w.]*)\s*\}|\$([A-Za-z_]\w*)", re.ASCII)
_KEY = re.compile(r"\b(?:key|name)[ \t]*=[ \t]*[\"']([^\"'<>\n]*+)[\"']", re.ASCII)
_GETTER = re.compile(r"(?:getenv|environ\.get|env|get|getProperty|getOrDefault)$", re.ASCII)
_LIST = re.compile(r"(?:[ \t]|\\?\n)*+\[")
_MAP = re.compile(r"(?:[ \t]|\\?\n)*+\{")
_NEXT_ITEM = re.compile(r"\s*+(?:,\s*+)?+")
_DASH = re.compile(r"[ \t]*+\n[ \t]*+-[ \t]++")
_NAMED = re.compile(r"[ \t]*+(?:=|:(?!//))", re.ASCII)
_OTHERWISE = re.compile(r"[^\n\"'`;{}]{0,120}?(?:\b(?:or|else)\b|\|\||\?\?|\?[^\n\"'`;{}]{0,120}?:|(?<=[ \t]):)[ \t]*+(?=[rRbBfFuU]{0,2}[\"'`])", re.ASCII)
_TUPLE = re.compile(r"[ \t]*+,\s*+")
#: Characters behind a `{` in which entries belong to its name, names of a tuple, and branches of a value that are looked at.
SCOPE, NAMES, BRANCHES = 4000, 8, 8
_OWNER = re.compile(r"^(?:\$|self\.|this\.)+")


def base_spans(text: str) -> list[tuple[int, str, int, int]]:
    """(start, kind, end, start of the secret itself) of the fixed patterns."""
    out = [(m.start(), "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end(), m.start()) for m in HEX.finditer(text)]
    return out


@lru_cache(4096)
def name_weight(name: str) -> float:
    flat = re.sub(r"[^a-z]", "", name.lower())
    return max((w for part, w in SENSITIVE.items() if part in flat), default=0.0)


class Value:
    """What a name stands for: a summary of constant size, and the parts as a span or two values."""

    __slots__ = ("length", "counts", "begin", "end", "space", "parts")

    def __init__(self, length: int, counts: Counter, begin: str, end: str, space: bool, parts: tuple):
        self.length, self.counts, self.begin, self.end, self.space, self.parts = length, counts, begin, end, space, parts

    @classmethod
    def of(cls, text: str, start: int) -> Value:
        counts: Counter = Counter()
        for c, n in Counter(text).items():
            counts[ord(c) if ord(c) < 128 else 128 + ord(c) % 128] += n
        return cls(len(text), counts, text[:64], text[-2:], any(map(str.isspace, text)), (start, start + len(text)))

    def __add__(self, other: Value) -> Value:
        return Value(self.length + other.length, self.counts + other.counts, (self.begin + other.begin)[:64], (self.end + other.end)[-2:], self.space or other.space, (self, other))

    def stands_in(self) -> bool:
        low = self.begin.lower()
        return (
            len(self.counts) == 1 or low.startswith(STAND_IN_STARTS) or (self.length <= 64 and low in STAND_INS)
            or any(low.startswith(a) and self.end.endswith(z) for a, z in TEMPLATES)
        )


def literal_score(name: str, value: Value) -> float:
    """0 to 1: what the target's name says, plus up to 0.4 for the literal's length, character mix and entropy."""
    weight = name_weight(name)
    if not weight or value.length < 6 or value.space or value.stands_in():
        return 0.0
    n = value.length
    entropy = -sum(v / n * math.log2(v / n) for v in value.counts.values())
    classes = len({"a" if 97 <= c <= 122 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else "." for c in value.counts})
    return weight + 0.1 * (n >= 12) + 0.1 * (classes >= 2) + 0.1 * (classes >= 3) + 0.1 * (entropy >= 3.0)


def inside(string: str) -> tuple[int, int]:
    """Offsets of a string literal's content: without its prefix and quotes."""
    a = next(i for i, c in enumerate(string) if c in "\"'`")
    q = 3 if string[a : a + 3] in ('"""', "'''") and len(string) >= a + 6 else 1
    return a + q, len(string) - q


class Lexer:
    """One walk over a text; `spans` holds the literals that reached a sensitive name."""

    def __init__(self, text: str):
        self.text = text
        self.known: dict[str, Value] = {}
        self.spans: set[tuple[int, int]] = set()
        self.told: set[int] = set()
        self.kept: list[Value] = []
        self.key: tuple[str, int] | None = None
        self.depth = 0
        #: Open braces that are the value of a telling name: (depth inside, the most telling name up to there, where it ends at the latest).
        self.scopes: list[tuple[int, str, int]] = []

    def pair(self, names: list[str], value: Value | None, strict: bool = False) -> None:
        """Scores value under each of the names (under the most telling one)."""
        if value is None or (strict and not any(48 <= c <= 57 for c in value.counts)):
            return
        if max(literal_score(n, value) for n in names) >= THRESHOLD:
            todo = [value]
            while todo:
                v = todo.pop()
                if id(v) in self.told:
                    continue
                self.told.add(id(v))
                self.kept.append(v)  # so that no other value gets its identity
                if isinstance(v.parts[0], int):
                    if v.parts[1] > v.parts[0]:
                        self.spans.add(v.parts)
                else:
                    todo += v.parts

    def assign(self, name: str, value: Value | None, more: bool = False) -> None:
        name = _OWNER.sub("", name)
        if value is None:
            if not more:
                self.known.pop(name, None)
            return
        self.known[name] = self.known[name] + value if more and name in self.known else value

    def literal(self, start: int, end: int) -> Value:
        """A string literal, with the known names that it interpolates."""
        a, z = inside(self.text[start:end])
        begin, end = start + a, start + z
        content = self.text[begin:end]
        if "$" in content or "{" in content:
            out, at = None, 0
            for m in _HOLE.finditer(content):
                value = self.known.get(m[1] or m[2])
                if value is None:
                    continue
                for v in ([Value.of(content[at : m.start()], begin + at)] if m.start() > at else []) + [value]:
                    out = v if out is None else out + v
                at = m.end()
            if out is not None:
                return out + Value.of(content[at:], begin + at) if at < len(content) else out
        return Value.of(content, begin)

    def word(self, start: int, end: int) -> Value:
        """A bare word: a known name, a sum of words of which one is known, or a literal."""
        word = self.text[start:end]
        known = self.known.get(_OWNER.sub("", word))
        if known is not None:
            return known
        if "+" in word.strip("+"):
            parts, at = [], start
            for w in word.split("+"):
                parts.append((w, at))
                at += len(w) + 1
            if any(_OWNER.sub("", w) in self.known for w, _ in parts):
                values = [self.known.get(_OWNER.sub("", w)) or Value.of(w, at) for w, at in parts if w]
                out = values[0]
                for v in values[1:]:
                    out = out + v
                return out
        return Value.of(word, start)

    def call(self, name: str, at: int) -> tuple[Value | None, int]:
        """(what a call with literal arguments stands for, position after those); at: behind the bracket."""
        first = _ARGUMENT.match(self.text, at)
        if not first:
            return None, at
        one = self.literal(*first.span("quoted"))
        end, two = first.end(), None
        if self.text[end : end + 1] == "," and (second := _ARGUMENT.match(self.text, end + 1)):
            two = self.literal(*second.span("quoted"))
            if one.length <= 64:
                self.pair([one.begin], two, strict=True)
            end = second.end()
        self.pair([name], two or one, strict=two is not None)
        return (two if two is not None else None if _GETTER.search(name) else one), end

    def block(self, at: int, name_at: int) -> tuple[Value | None, int]:
        """The lines below that are indented deeper than the line of the name."""
        text = self.text
        begin = text.rfind("\n", 0, name_at) + 1
        depth = len(text[begin:name_at]) - len(text[begin:name_at].lstrip(" \t-"))
        value = None
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            line = text[at:end]
            body = line.strip()
            if body and len(line) - len(line.lstrip(" \t")) <= depth:
                break
            if body:
                part = Value.of(body, at + line.index(body))
                value = part if value is None else value + part
            at = end + 1
        return value, min(at, len(text))

    def value(self, at: int, operator: str, name_at: int) -> tuple[Value | None, int]:
        """(value that starts at `at`, position after it); None if it is no literal."""
        text = self.text
        if operator == ":" and (m := _BLOCK.match(text, at)):
            return self.block(m.end(), name_at)
        opened = _OPEN.match(text, at)
        bracket = "(" in opened[0]
        at = opened.end()
        if text.startswith("\\\n", at):  # goes on in the next line
            at = _OPEN.match(text, at + 2).end()
        if text[at : at + 1] in ("\n", "\r", "") and (m := _NEXT_LINE.match(text, at)):
            bracket = bracket or "(" in m[0]
            at = m.end()
        out = None
        while m := _TERM.match(text, at):
            if m["quoted"]:
                v, at = self.literal(*m.span()), m.end()
            else:
                word_end = m.end()
                plus = text[word_end - 1] == "+" and text[word_end : word_end + 1] in ("'", '"', "`") and word_end - m.start() > 1
                if text[word_end : word_end + 1] == "(" and not plus:
                    v, at = self.call(m[0], word_end + 1)
                elif text[word_end : word_end + 1] == "[":
                    return None, word_end
                else:
                    v, at = self.word(m.start(), word_end - plus), word_end - plus
            if v is None:
                return None, at
            out = v if out is None else out + v
            if n := _PLUS.match(text, at):
                if not _TERM.match(text, n.end()):
                    break
                at = n.end()
            elif m["quoted"] and (n := (_BESIDE_OPEN if bracket else _BESIDE).match(text, at)) and n.end() > at:
                at = n.end()
            else:
                break
        return out, at

    def declared(self, at: int) -> list[str]:
        """The word before a name, if a declaration keyword stands before that (`var name type = ...`)."""
        words, text = [], self.text
        for _ in range(2):
            end = at
            while end and text[end - 1] in " \t":
                end -= 1
            if end == at:
                return []
            begin = end
            while begin and (text[begin - 1].isalnum() or text[begin - 1] == "_"):
                begin -= 1
            words.append(text[begin:end])
            at = begin
        return [words[0]] if words[1] in ("var", "let", "const", "val") and words[0] else []

    def tuple_names(self, at: int) -> list[str]:
        """The names before one with an operator, if a line is `a, b, name = ...` up to there."""
        text, out = self.text, []
        while len(out) < NAMES:
            end = at
            while end and text[end - 1] in " \t":
                end -= 1
            if not end or text[end - 1] != ",":
                return out[::-1] if out and (not end or text[end - 1] in "\n;") else []
            end -= 1
            while end and text[end - 1] in " \t":
                end -= 1
            begin = end
            while begin and (text[begin - 1].isalnum() or text[begin - 1] in "_.$"):
                begin -= 1
            if begin == end:
                return []
            out.append(text[begin:end])
            at = begin
        return []

    def named(self, term: re.Match) -> bool:
        """Whether a term is a name with a value of its own."""
        return bool(_NAMED.match(self.text, term.end())) or (not term["quoted"] and (term[0].endswith(":") or "=" in term[0].rstrip("=")))

    def items(self, names: list[str], at: int) -> int:
        """Literals and bare words of a list, from behind its bracket; what is neither is left to the walk."""
        text = self.text
        while True:
            at = _NEXT_ITEM.match(text, at).end()
            m = _TERM.match(text, at)
            if not m or self.named(m) or (not m["quoted"] and text[m.end() : m.end() + 1] == "("):
                return at
            self.pair(names, self.literal(*m.span()) if m["quoted"] else self.word(*m.span()))
            at = m.end()

    def dashes(self, names: list[str], at: int) -> int:
        """`- v` lines below a name; an entry that has a name of its own is left to the walk."""
        text = self.text
        while m := _DASH.match(text, at):
            term = _TERM.match(text, m.end())
            if not term or self.named(term):
                return at
            self.pair(names, self.literal(*term.span()) if term["quoted"] else self.word(*term.span()))
            at = term.end()
        return at

    def statement(self, name: str, name_at: int, operator: str, at: int) -> int:
        """A name with an operator; returns where the walk goes on."""
        text = self.text
        if operator == ":" and (m := _TYPE.match(text, at)):
            at, operator = m.end(), "="
        names = [name]
        if operator == "=" and name_at and text[name_at - 1] in " \t":
            names += self.declared(name_at)
        key, self.key = self.key, None
        while self.scopes and name_at >= self.scopes[-1][2]:
            self.scopes.pop()
        if m := _LIST.match(text, at):
            self.assign(name, None)
            return self.items(names, m.end())
        if m := _MAP.match(text, at):
            self.assign(name, None)
            best = max([*names, *[x[1] for x in self.scopes[-1:]]], key=name_weight)
            if name_weight(best):
                self.scopes.append((self.depth + 1, best, m.end() + SCOPE))
            return m.end() - 1
        if operator == ":" and _DASH.match(text, at):
            self.assign(name, None)
            return self.dashes(names, at)
        value, end = self.value(at, operator, name_at)
        if operator == "=" and (before := self.tuple_names(name_at)):
            return self.unpacked([*before, name], value, end, name_at)
        self.pair(names, value)
        if self.scopes:
            self.pair([self.scopes[-1][1]], value, strict=True)
        for _ in range(BRANCHES):
            if not (m := _OTHERWISE.match(text, end)):
                break
            other = _TERM.match(text, m.end())
            if not other or not other["quoted"]:
                break
            branch, end = self.literal(*other.span()), other.end()
            self.pair(names, branch)
            value = branch if value is None else value
        for n in names:
            self.assign(n, value, operator == "+=")
        if operator == "+=" and name in self.known:
            self.pair([name], self.known[name])
        if value is not None and value.length <= 64 and name.lower() in ("key", "name", "id"):
            self.key = (value.begin, end)
        elif key and name.lower() == "value" and not text[key[1] : name_at].strip():
            self.pair([key[0]], value)
        return max(end, at)

    def unpacked(self, names: list[str], value: Value | None, end: int, name_at: int) -> int:
        """`a, b = v, w`: each name with its own value."""
        values = [value]
        while len(values) < len(names) and (m := _TUPLE.match(self.text, end)):
            value, end = self.value(m.end(), "=", name_at)
            values.append(value)
        for n, v in zip(names, values if len(values) == len(names) else [None] * len(names)):
            self.pair([n], v)
            self.assign(n, v)
        return end

    def run(self) -> set[tuple[int, int]]:
        text, at = self.text, 0
        while m := _EVENT.search(text, at):
            at = m.end()
            if m["element"]:
                key = _KEY.search(m["attributes"])
                content = m["content"].strip()
                value = Value.of(content, m.start("content") + m["content"].index(content)) if content else None
                self.pair([m["element"], *([key[1]] if key else [])], value)
                self.assign(m["element"], value)
                at = m.start("attributes") if m["attributes"] else m.end("content")
            elif m["string"]:
                if n := _AFTER_STRING.match(text, at):
                    a, z = inside(m["string"])
                    operator = n[0].strip(" \t]")
                    at = self.statement(m["string"][a:z], m.start(), operator, n.end())
            elif m["brace"]:
                self.depth += 1 if m["brace"] == "{" else -1
                while self.scopes and self.scopes[-1][0] > self.depth:
                    self.scopes.pop()
            elif m["call"]:
                at = self.call(m["name"], at)[1]
            elif m["name"]:
                at = self.statement(m["name"], m.start("name"), m["operator"], at)
        return self.spans


def literal_spans(text: str) -> list[tuple[int, str, int, int]]:
    """Spans of literals that reach a sensitive target, straight or through other names. Without an operator, a call or an element there is none."""
    if not any(map(text.__contains__, ("=", ":", "->", "(", "</"))):
        return []
    return [(s, "literal", e, s) for s, e in Lexer(text).run()]


def scan(text: str | None) -> list[tuple[int, str, int, int]]:
    """All spans, by start, then kind as listed, then end."""
    if not text:
        return []
    return sorted([*base_spans(text), *literal_spans(text)], key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def redacted(text: str | None, mark: str = "<SECRET>") -> str | None:
    """text with the secret part of each span replaced; overlapping parts once."""
    if not text:
        return text
    out, at = [], 0
    for _, _, end, start in sorted(scan(text), key=lambda x: (x[3], -x[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


_FOUND = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_literal bigint"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        digests, spans = [], []
        for text in b.column(1):
            found = scan(text.as_py())
            n = Counter(x[1] for x in found)
            for k in KINDS:
                counts[k].append(n[k])
            joined = [(x[1], f"{x[1]}:{x[0]}:{x[2]}") for x in found]
            digests.append(hashlib.sha256(",".join(x for k, x in joined if k in BASE_KINDS).encode()).hexdigest())
            spans.append(",".join(x for _, x in joined))
        cols = [b.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(counts["literal"], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: counts, digest of the fixed patterns' spans, all spans."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scanned, _FOUND)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """docs with secrets replaced in the text column, and the length column (if there) set to the new length."""
    names = docs.columns
    at = names.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array([redacted(x.as_py()) for x in b.column(at)], b.schema.field(at).type))

    safe = [f"c{i}" for i in range(len(names))]  # names may differ only by case or repeat
    out = docs.toDF(*safe).mapInArrow(clean, docs.toDF(*safe).schema).toDF(*names)
    return out.withColumn(length, F.length(text).cast(docs.schema[length].dataType)) if length in names else out


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
