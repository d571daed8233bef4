"""Secrets in texts: patterns, and literals that are assigned to names that sound secret.

Three base kinds are plain patterns. The fourth, `literal`, reads the text as source code or configuration
and makes pairs of a name and the literals of its value. Pairs are

- assignments and mappings: `name = value`, `name: value`, `name := value`, `"name" => value`, `name: type = value`,
  `name[] = value`, several names with as many values, and `name += value`, which goes on with the value before;
- a name and a literal as first arguments of a call, or as the attributes `name` and `value`;
- elements of markup: `<name>value</name>`.

A value may be a quoted string, also in triple quotes, a bare word, a name that was assigned before
(its literals are propagated, however many; the longest dotted or hyphenated name counts), `$name` or `${name}`, or
several of these put together with `+` or `.`. Names are propagated in strings, too, where these are formatted
(`f"{name}"`) or name them after `$`. A value may begin on the next line, go on after a backslash, be an indented block
(`name: |`), or stand in brackets: there strings without a comma between are one value, and so are single
characters; others are values of their own. Assignments in lines of comment make pairs, but no value for later.

A pair counts as a
secret when the words of its name and the randomness of its value score high enough together; the
span of each literal that the value is made of is reported, also where the literal stands elsewhere.

Null and empty texts have no spans, and equal texts have the same. Texts are read whole, in time that grows
with their length: a bracket or block inside one that was read already is not read as such again.
"""

from __future__ import annotations

import re
from heapq import merge
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.frames import with_column_of

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "literal")

# How much a word of a name says that its value is secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "pass": 0.7, "auth": 0.6,
    "private": 0.5, "signing": 0.5, "encryption": 0.5, "key": 0.5, "access": 0.4, "api": 0.4,
    "cert": 0.3, "salt": 0.4, "dsn": 0.4,
}
PLACEHOLDER = re.compile(r"\$\{|\{\{|%\(|<[a-z_ ]+>|^(?:change_?me|example|your|none|null|true|false|todo)|^(.)\1*$|\*{3}|x{4}", re.I)
LEAST, FULL_BITS, THRESHOLD = 8, 40.0, 0.5

_PAIR = re.compile(
    r"""(?<![\w.$-])(["']?)([A-Za-z_$][\w.$-]*)\1\]?(?:\[\w*\])?\x20*"""
    r"""(:=|=>|:\x20*[A-Za-z_][\w.<>|?]*(?:\[[^\]\n=]*\])?\x20=(?=\x20)|[+.?|]{0,2}=(?!=)|:(?![:/]))[\x20\t]*""",
    re.ASCII,
)
_QUOTE = r"""(?:[rbufRBUF]{1,2}|[$@]{1,2}|[LN])?["'`]"""
_OPENING = re.compile(r"""([rbufRBUF]{1,2}|[$@]{1,2}|[LN])?(\"\"\"|\'\'\'|["'`])""")
_CLOSING = {q: re.compile(rf"(?:[^{q}\\\n]++|\\.)*+{q}", re.S) for q in "\"'"} | {"`": re.compile("[^`]*`")}
# A value goes on after a backslash, and may begin with a string on the next line.
_ONWARD = re.compile(rf"(?:\\\r?\n[\x20\t]*+)++|\r?\n[\x20\t]*+(?={_QUOTE})")
_BLOCK = re.compile(r"[|>][+-]?\d?[\x20\t]*\r?\n")
_BRACKET = re.compile(rf"[(\[{{](?:\s|\\\n)*+(?={_QUOTE})")
_NEXT = re.compile(rf"(?:\s|\\\n)*+([,+]?)(?:\s|\\\n)*+(?:(?={_QUOTE})|([)\]}}]))")
# Names that a string or a bare word holds: `${name}`, with a default or without, `$name`, `#{name}`, `{name}`.
_HOLE = re.compile(r"\$\{([A-Za-z_][\w.]*)(?::?-([^}\n]*))?\}|\$([A-Za-z_]\w*)|#\{([A-Za-z_][\w.]*)\}", re.ASCII)
_FORMATTED = re.compile(r"\$?\{([A-Za-z_][\w.]*)()(?:![rsa])?(?::[^{}\n]*)?\}", re.ASCII)
_CALL = re.compile(
    rf"""(?:\(\x20*|\b(?:name|key)=)(["'])([A-Za-z_][\w.-]*)\1(?:\x20*,|\s+value=)\s*(?={_QUOTE})""", re.ASCII
)
_TAG = re.compile(r"<([A-Za-z_][\w.-]*)(?:\s[^<>]*)?>([^<>]*)</\1\s*>", re.ASCII)
_TARGETS = re.compile(r"[\x20\t(]*(?:(?:let|const|var|my|local)\x20)?[\x20\t(\[]*((?:[A-Za-z_$][\w.$]*\x20*,\x20*)+)", re.ASCII)
_COMMA = re.compile(r"[\x20\t]*,[\x20\t]*")
_LINE_END = re.compile(r"[\x20\t)\]]*(?:[;#]|//|\r?\n|\Z)")
_INDENT = re.compile(r"[\x20\t]*(?:-\x20+)?")
_COMMENT = re.compile(r"[\x20\t]*(?:#|//|/\*|\*\x20|--\x20|<!--|;)")
# A bare word ends at the next operator, but for `=` that pads it.
_BARE = re.compile(r"""[^\s,;"'`()\[\]{}=:&]+(?:={1,2}(?![^\s,;"'`)\]}&]))?""")
_DOTTED = re.compile(r"[A-Za-z_$][\w.$-]*", re.ASCII)
_JOIN = re.compile(
    r"""(?:[\x20\t]|\\\r?\n)*+(?:\+\s*+|\.[\x20\t]*+|\r?\n[\x20\t]*+\+[\x20\t]*+)(?=["'`A-Za-z_$])"""
    r"""|[\x20\t]*+(?:\\\r?\n[\x20\t]*+)++(?=["'])"""
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# `PLACEHOLDER` in parts that can be told from pieces of a value.
_INSIDE = re.compile(r"\$\{|\{\{|%\(|<[a-z_ ]+>|\*{3}|x{4}", re.I)
_AT_START = re.compile(r"^(?:change_?me|example|your|none|null|true|false|todo)", re.I)
_OPEN, _SHUT, _WITHIN = (re.compile(p, re.I) for p in (r"<([a-z_ ]*)\Z", r"([a-z_ ]*)>", r"[a-z_ ]*\Z"))
_TWICE = re.compile(r"(.)\1", re.I)
_HEAD, _TAIL, _MANY = 9, 3, 1 << 50

Span = tuple[str, int, int, float]


def name_score(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    whole = "".join(words)
    found = sum(NAME_WEIGHTS.get(w, 0.0) for w in words)
    return min(1.0, max(found, NAME_WEIGHTS.get(whole, 0.0)))


def literal_score(value: str) -> float:
    """0 for short values, placeholders and plain words; towards 1 for random ones."""
    n = len(value)
    if n < LEAST or PLACEHOLDER.search(value):
        return 0.0
    counts: dict[str, int] = {}
    for c in value:
        counts[c] = counts.get(c, 0) + 1
    bits = -sum(k * log2(k / n) for k in counts.values())
    mixed = not value.isalpha() and " " not in value
    return min(1.0, bits / FULL_BITS) * (1.0 if mixed else 0.5)


class Value:
    """A literal, or values put together: what its score needs, and where its literals are.

    Values share their parts, so that a name takes the same room whatever it is made of. `score` is the
    highest of the secrets that the value is in.
    """

    __slots__ = ("kids", "start", "end", "score", "size", "head", "tail", "counts", "inside", "opened",
                 "shut", "within", "same", "alpha", "space")

    def __init__(self, text: str, start: int, end: int):
        self.kids: tuple[Value, ...] = ()
        self.start, self.end, self.score = start, end, 0.0
        self.size, self.head, self.tail = len(text), text[:_HEAD], text[-_TAIL:]
        self.counts: dict[str, int] | None = {}  # none: enough for a full score
        for c in text:
            self.counts[c] = self.counts.get(c, 0) + 1
        self.inside = bool(_INSIDE.search(text))
        opened, shut = _OPEN.search(text), _SHUT.match(text)
        # Words in angle brackets over a border: none, an empty one and one with characters.
        self.opened = 0 if not opened else 2 if opened.group(1) else 1
        self.shut = 0 if not shut else 2 if shut.group(1) else 1
        self.within = bool(_WITHIN.match(text))
        self.same = all(_TWICE.match(text[0] + c) for c in set(text))
        self.alpha, self.space = not text or text.isalpha(), " " in text
        self._settle()

    def joined(self, other: Value) -> Value:
        out = object.__new__(Value)
        out.kids, out.start, out.end, out.score = (self, other), 0, 0, 0.0
        out.size = min(_MANY, self.size + other.size)
        out.head = self.head if len(self.head) == _HEAD else (self.head + other.head)[:_HEAD]
        out.tail = (self.tail + other.tail)[-_TAIL:]
        out.counts = None
        if self.counts is not None and other.counts is not None:
            out.counts = dict(self.counts)
            for c, k in other.counts.items():
                out.counts[c] = min(_MANY, out.counts.get(c, 0) + k)
        bracket = self.opened and other.shut and max(self.opened, other.shut) > 1
        border = self.tail + other.head[:_TAIL]
        out.inside = bool(self.inside or other.inside or bracket or _INSIDE.search(border))
        out.opened = other.opened
        if self.opened and other.within:
            out.opened = max(self.opened, 2 if other.size else 1)
        out.shut = self.shut
        if self.within and other.shut and not self.shut:
            out.shut = max(other.shut, 2 if self.size else 1)
        out.within = self.within and other.within
        out.same = self.same and other.same
        if out.same and self.size and other.size:
            out.same = bool(_TWICE.match(self.head[0] + other.head[0]))
        out.alpha, out.space = self.alpha and other.alpha, self.space or other.space
        out._settle()
        return out

    def _settle(self) -> None:
        # More characters never make the bits less.
        if self.counts is not None and self._bits() >= FULL_BITS + 1:
            self.counts = None

    def _bits(self) -> float:
        n = sum(self.counts.values())
        return -sum(k * log2(k / n) for k in self.counts.values())

    def randomness(self) -> float:
        """The `literal_score` of the whole value."""
        if self.size < LEAST or self.inside or self.same or _AT_START.match(self.head):
            return 0.0
        full = 1.0 if self.counts is None else min(1.0, self._bits() / FULL_BITS)
        return full * (1.0 if not self.alpha and not self.space else 0.5)


class Values:
    """The values of a text by name, every one in the order of their making."""

    def __init__(self):
        self.known: dict[str, Value] = {}
        self.made: list[Value] = []
        self.longest = 0

    def find(self, line: str, at: int) -> tuple[Value, int] | None:
        """The value of the longest known name at `at`, whole up to a dot or hyphen, and its end."""
        m = _DOTTED.match(line, at, at + self.longest + 1)
        end = m.end() if m else at
        while end > at:
            name = line[at:end]
            if name in self.known and not name.endswith((".", "-")):
                return self.known[name], end
            end = max(line.rfind(".", at, end), line.rfind("-", at, end))
        return None

    def put(self, name: str, value: Value | None) -> None:
        """An older value of the name is gone, also where the new one is not in the text."""
        self.known.pop(name, None)
        if value is not None:
            self.known[name] = value
            self.longest = max(self.longest, len(name))

    def literal(self, text: str, start: int, end: int) -> Value:
        self.made.append(Value(text[start:end], start, end))
        return self.made[-1]

    def add(self, value: Value | None, part: Value) -> Value:
        if value is None:
            return part
        self.made.append(value.joined(part))
        return self.made[-1]

    def filled(self, text: str, start: int, end: int, holes: re.Pattern | None) -> Value:
        """A string, with the values of the names in it that are known."""
        value, at = None, start
        for m in holes.finditer(text, start, end) if holes else ():
            part = self.named(text, m)
            if part is not None:
                if m.start() > at:
                    value = self.add(value, self.literal(text, at, m.start()))
                value, at = self.add(value, part), m.end()
        if at < end or value is None:
            value = self.add(value, self.literal(text, at, end))
        return value

    def named(self, text: str, hole: re.Match) -> Value | None:
        name = next((g for k, g in enumerate(hole.groups()) if g and k != 1), "")
        found = self.known.get(name) or self.known.get(f"${name}")
        if found is None and hole.group(2):  # the default
            found = self.literal(text, hole.start(2), hole.end(2))
        return found

    def string(self, text: str, at: int) -> tuple[Value, int] | None:
        """The quoted string at `at`, and its end."""
        m = _OPENING.match(text, at)
        if not m:
            return None
        prefix, quote = (m.group(1) or "").lower(), m.group(2)
        if len(quote) == 3:
            end = text.find(quote, m.end())
            if end < 0:
                return None
        else:
            closing = _CLOSING[quote].match(text, m.end())
            if not closing:
                return None
            end = closing.end() - 1
        formatted = "f" in prefix or "$" in prefix
        holes = _FORMATTED if formatted else None if quote[0] == "'" or "r" in prefix else _HOLE
        return self.filled(text, m.end(), end, holes), end + len(quote)

    def word(self, text: str, at: int, first: bool) -> tuple[Value, int] | None:
        """The name or, as the `first` part of a value, the bare word at `at`, and its end."""
        m = _BARE.match(text, at)
        if m:
            found = self.find(text, at)
            if found:
                return found
        hole = _HOLE.match(text, at)
        part = self.named(text, hole) if hole else None
        if part is not None:
            return part, hole.end()
        # An unknown name after a literal: its value is not in the text.
        return (self.literal(text, m.start(), m.end()), m.end()) if m and first else None

    def read(self, text: str, at: int) -> tuple[Value | None, int]:
        """The value that begins at `at`, and its end."""
        value, end = None, at
        while True:
            part = self.string(text, at) or self.word(text, at, value is None)
            if not part:
                return value, end
            value, end = self.add(value, part[0]), part[1]
            more = _JOIN.match(text, end)
            if more:
                at = more.end()
            elif text.startswith("$", end):
                at = end
            else:
                return value, end

    def listed(self, text: str, at: int) -> tuple[list[Value], int]:
        """The strings in a bracket that begin at `at`; none if they are keys."""
        out: list[Value] = []
        value = None
        while part := self.string(text, at):
            value, end = self.add(value, part[0]), part[1]
            more = _NEXT.match(text, end)
            if not more or more.group(1) == "," or more.group(2):
                out.append(value)
                value = None
            if not more or more.group(2):
                mapping = not more and text[end : end + 4].lstrip()[:1] in (":", "=")
                if mapping:
                    return [], end
                break
            at = more.end()
        if value is not None:
            out.append(value)
        if len(out) > 1 and all(v.size == 1 for v in out):
            whole = None
            for v in out:
                whole = self.add(whole, v)
            out = [whole]
        return out, at

    def block(self, text: str, at: int, indent: int) -> tuple[Value | None, int]:
        """The lines from `at` on that are further in than `indent`."""
        value = None
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            line = text[at:end]
            inner = line.strip()
            if inner:
                start = at + len(line) - len(line.lstrip())
                if start - at <= indent:
                    break
                value = self.add(value, self.literal(text, start, start + len(inner)))
            at = end + 1
        return value, at


def _pairs(text: str):
    """(place, match, start of the line, whether it is the line's first) of what is assigned."""
    at, size = 0, len(text)
    equals, colon = text.find("="), text.find(":")
    while equals >= 0 or colon >= 0:
        found = min(p for p in (equals, colon) if p >= 0)
        start = text.rfind("\n", at, found) + 1 or at
        end = text.find("\n", found)
        end = size if end < 0 else end
        pos = start
        while pair := _PAIR.search(text, pos, end):
            yield pair.start(), pair, start, pos == start
            pos = max(pair.end(), pair.start() + 1)
        at = end
        equals = text.find("=", end) if 0 <= equals < end else equals
        colon = text.find(":", end) if 0 <= colon < end else colon


def assignments(text: str, values: Values):
    """(name, value) of every pair of a text, in its order."""
    calls = ((m.start(), m, None, False) for m in _CALL.finditer(text))
    tags = ((m.start(), m, None, False) for m in _TAG.finditer(text))
    read_to, line, comment = 0, -1, False
    for _, m, start, first in merge(_pairs(text), calls, tags, key=lambda mark: mark[0]):
        if m.re is _TAG:
            inner = m.group(2).strip()
            if inner:
                at = m.start(2) + m.group(2).index(inner)
                yield m.group(1), values.literal(text, at, at + len(inner))
            continue
        name, at = m.group(2), m.end()
        if m.re is _CALL:
            value, _ = values.read(text, at)
            if value is not None:
                yield name, value
            continue
        if start != line:
            line, comment = start, bool(_COMMENT.match(text, start))
        targets = _TARGETS.fullmatch(text, start, m.start()) if first else None
        if targets and (several := _several(text, m, targets.group(1), values)):
            for target, value in several:
                if not comment:
                    values.put(target, value)
                if value is not None:
                    yield target, value
            continue
        sign = m.group(3)
        onward = _ONWARD.match(text, at) if sign != ":" or m.group(1) else None
        at = onward.end() if onward else at
        found: list[Value] = []
        if at >= read_to and sign == ":" and (block := _BLOCK.match(text, at)):
            indent = _INDENT.match(text, start).end() - start
            value, read_to = values.block(text, block.end(), indent)
            found = [] if value is None else [value]
        elif at >= read_to and (bracket := _BRACKET.match(text, at)):
            found, read_to = values.listed(text, bracket.end())
        else:
            value, _ = values.read(text, at)
            if value is not None:
                before = values.known.get(name) if sign in ("+=", ".=") else None
                found = [value if before is None else values.add(before, value)]
        if not comment:
            values.put(name, found[0] if len(found) == 1 else None)
        for value in found:
            yield name, value


def _several(text: str, m: re.Match, targets: str, values: Values) -> list[tuple[str, Value | None]] | None:
    """Names with a value each, by their order; a value that can't be read is none.

    A name after a comma may also be an argument of a call (`name=value` without blanks), or alone in having
    a value; then this is no assignment of several.
    """
    names = [t.strip() for t in targets.split(",")[:-1]] + [m.group(2)]
    value, at = values.read(text, m.end())
    out: list[tuple[str, Value | None]] = [(names[0], value)]
    for name in names[1:]:
        comma = _COMMA.match(text, at) if value is not None else None
        value, at = values.read(text, comma.end()) if comma else (None, at)
        if not comma and len(out) == 1:
            return None
        out.append((name, value))
    spaced = text[m.start(3) - 1] == " "
    return out if spaced or value is not None and _LINE_END.match(text, at) else None


def spans(text: str | None) -> list[Span]:
    """(kind, start, end, score) by start, then kind in the order of `KINDS`; ends are exclusive."""
    if not text:
        return []
    found: dict[tuple[int, int, int], float] = {}
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= ASSIGN_LEAST:
            found[m.start(), 0, m.end()] = 1.0
    for k, pattern in ((1, ACCESS), (2, HEX)):
        for m in pattern.finditer(text):
            found[m.start(), k, m.end()] = 1.0
    values = Values()
    for name, value in assignments(text, values):
        by_name = name_score(name)
        if by_name:
            score = by_name * value.randomness()
            if score >= THRESHOLD:
                value.score = max(score, value.score)
    for value in reversed(values.made):  # parts were made before what they are in
        for kid in value.kids:
            kid.score = max(kid.score, value.score)
        if value.score and not value.kids:
            key = (value.start, 3, value.end)
            found[key] = max(value.score, found.get(key, 0.0))
    return [(KINDS[k], start, end, score) for (start, k, end), score in sorted(found.items())]


SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
])
_ARROW = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
]))


def find_secrets(df: DataFrame, text: str = "text", target: str = "secrets") -> DataFrame:
    """Adds the spans of `text`, in code points, an array that may be empty but is never null.

    An existing column `target` is replaced.
    """

    def values(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "score")
        return pa.array([[dict(zip(names, s)) for s in spans(t)] for t in texts.to_pylist()], _ARROW)

    return with_column_of(df, text, target, T.ArrayType(SPAN), values)


def of_kinds(secrets: str, kinds: tuple[str, ...]) -> Column:
    return F.filter(F.col(secrets), lambda s: s["kind"].isin(*kinds))


def as_text(found: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
