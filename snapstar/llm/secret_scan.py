"""Secret scan: base patterns plus assignment-aware lexing.

Source and configuration text is lexed into assignments ``name op value``, where a name may be quoted, a subscript, typed or one of
several targets, and a value is a sum of literals, bare tokens and names. Literals have any kind of quotes, prefixes such as b or f,
and stand side by side, in brackets over lines, in indented blocks, or in an element of that name. Names bound to constants
earlier in the text are replaced by them, also through sums, chains and ``+=``. A name in braces, a section or indented lines
under another name is read together with it.
Each assignment is scored by how sensitive its target name is and how much its value looks like a secret; those that
reach ``THRESHOLD`` are reported as ``named``, with the span of the value. If the value came from a constant defined
elsewhere, the span of that definition is reported too. Constants are carried by reference: the spans they come from, how
often each character occurs, and their ends. So literals and sums of any length are scored, and doubling stays cheap. In
a sum with a name that isn't known, every literal and every run of literals is scored by itself.

Null texts are empty, and empty texts have no spans. Very long texts are scanned whole. Spans are in code points, end
exclusive; at equal starts they follow the order of ``KINDS``, then the end. Rows are independent, so repeated rows get
equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "named")
BASE = KINDS[:3]
# The base patterns. ``+`` and a later length test are one ``{n,}`` where a failing match can't hide another.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS = 12

# An assignment: a name, perhaps quoted or a subscript, an operator, perhaps behind a type, and the first term of its value.
WORD = r"[A-Za-z_][\w.\-]*+"
TYPE = r"[A-Za-z_][\w.]*(?:\[[\w., |\[\]]*\])?(?:[ \t]*\|[ \t]*[A-Za-z_][\w.]*)*"
OPERATOR = rf"(\+=|\.=|:=|=>|=(?!=)|:(?![:/])[ \t]*{TYPE}[ \t]+=(?!=)|:(?![:/=]))"
NAME = re.compile(rf"""(?<![\w.\-])["']?({WORD})["']?\]?[ \t]*{OPERATOR}[ \t]*(?=["'`A-Za-z0-9_+/(\[|>])""", re.A)
TARGETS = re.compile(rf"""^[ \t]*({WORD}(?:[ \t]*,[ \t]*{WORD})+)[ \t]*=(?!=)[ \t]*(?=["'`A-Za-z0-9_+/])""", re.A | re.M)
ELEMENT = re.compile(rf"""<(?:[\w\-]+:)?({WORD})(?:[ \t][^<>\n]*)?>[ \t\n]*([^<>\s][^<>]*?)[ \t\n]*</""", re.A)
BLOCK = re.compile(r"[|>][+\-0-9]*[ \t]*\n")
QUOTED = re.compile(r'''[bBrRfFuU]{0,2}(?:"""((?:[^"\\]|\\.|"(?!""))*)"""|\'\'\'((?:[^\'\\]|\\.|\'(?!\'\'))*)\'\'\'|"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`((?:[^`\\]|\\.)*)`)''', re.S)
BARE = re.compile(r"[A-Za-z0-9+/_.=\-]+")
# What joins two terms: a plus, also over a line's end; after a quoted term also a point, or nothing before another one.
PLUS = re.compile(r"[ \t]*\+[ \t]*(?:\n[ \t]*)?(?=[\"'`A-Za-z_])")
NEXT = re.compile(r"""[ \t]*(?:\.[ \t]*|\\\n[ \t]*)?(?=[bBrRfFuU]{0,2}["'`])""")
INSIDE = re.compile(r"""\s*(?:[+.,]\s*)?(?=[bBrRfFuU]{0,2}["'`]|[A-Za-z_])""")
OPENING = re.compile(r"""[(\[]\s*(?=[bBrRfFuU]{0,2}["'`])""")
COMMA = re.compile(r"[ \t]*,[ \t]*")
# What a name stands in: braces or indented lines under another name, or a section of a configuration file.
BRACE = re.compile(rf"""(?:["']?({WORD})["']?[ \t]*(?::|=>?)[ \t\n]*)?\{{|\}}""", re.A)
PARENT = re.compile(rf"""^([ \t]*)(?:-[ \t]+)?["']?({WORD})["']?:[ \t]*$""", re.A | re.M)
INDENT = re.compile(r"[ \t]*")
SECTION = re.compile(r"^\[+([\w.\- ]+)\]+[ \t]*$", re.A | re.M)
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# Words of a target name and how sensitive they make it; pairs count when they follow each other.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "authorization": 0.8, "signature": 0.5,
    "api key": 1.0, "access key": 1.0, "secret key": 1.0, "private key": 1.0, "encryption key": 1.0, "signing key": 1.0,
    "account key": 0.9, "connection string": 0.8, "client secret": 1.0,
}
# Names that say nothing of their own: the name they stand in speaks for them.
GENERIC = {"value", "val", "data", "default", "text", "raw", "content"}
HARMLESS = {"type", "name", "count", "length", "size", "limit", "url", "uri", "path", "file", "field", "format", "expires", "ttl", "id"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|todo|changeme|change[_-]?me|placeholder|redacted|example.*|your[_-].*|<.*>|\$\{?.*|%.*%?|\{\{.*\}\})$")
LEAST_CHARS = 8
# Longer values are carried without their middle, and constants from more literals are referred to instead of copied, so that
# text which doubles a value over and over stays cheap. Neither changes what is reported.
MOST_CHARS, MOST_TERMS = 4096, 64
END_CHARS = 64
COUNT_BITS = 64  # longer values keep the shares of their characters
THRESHOLD = 0.6


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


@dataclass(frozen=True, eq=False)
class Constant:
    """A value by what its score needs, and where its literals stand: spans, or constants that have them."""

    sources: tuple[tuple[int, int] | Constant, ...]
    counts: Counter[str]
    head: str
    tail: str

    @property
    def length(self) -> int:
        return self.counts.total()


def literal(value: str, *span: int) -> Constant:
    return Constant((span,) if span else (), Counter(value), value[:MOST_CHARS], value[-END_CHARS:])


def added(terms: list[Constant]) -> Constant:
    """The sum of terms."""
    if len(terms) == 1:
        return terms[0]
    sources: dict[tuple[int, int] | Constant, None] = {}
    counts: Counter[str] = Counter()
    for term, times in Counter(terms).items():
        sources |= dict.fromkeys(term.sources if len(term.sources) <= MOST_TERMS else (term,))
        for char, n in term.counts.items():
            counts[char] += n * times
    if (excess := counts.total().bit_length() - COUNT_BITS) > 0:
        counts = Counter({char: max(1, n >> excess) for char, n in counts.items()})
    head = tail = ""
    for term in terms:
        if len(head) >= MOST_CHARS:
            break
        head = (head + term.head)[:MOST_CHARS]
    for term in reversed(terms):
        if len(tail) >= END_CHARS:
            break
        tail = (term.tail + tail)[-END_CHARS:]
    return Constant(tuple(sources), counts, head, tail)


@dataclass(frozen=True, eq=False)
class Loose:
    """A sum that isn't constant: the constants in it, and other such sums."""

    pieces: tuple[Constant | Loose, ...]


def constants(value: Constant | Loose | None, seen: set[Constant | Loose]) -> Iterator[Constant]:
    """The constants of a value, without those seen before."""
    left = [value] if value else []
    while left:
        if (at := left.pop()) in seen:
            continue
        seen.add(at)
        if isinstance(at, Loose):
            left += at.pieces
        else:
            yield at


def source_spans(constant: Constant, seen: set[Constant]) -> Iterator[tuple[int, int]]:
    """Spans of the literals of a constant, without those of constants seen before."""
    left = [constant]
    while left:
        if (at := left.pop()) in seen:
            continue
        seen.add(at)
        for source in at.sources:
            if isinstance(source, Constant):
                left.append(source)
            else:
                yield source


@dataclass(frozen=True)
class Assignment:
    """A name, what is known of its value, and the name it stands in."""

    name: str
    known: Constant | Loose | None
    inside: str = ""

    @property
    def value(self) -> str | None:
        """The value, if it is constant and no longer than ``MOST_CHARS``."""
        return self.known.head if isinstance(self.known, Constant) and self.known.length <= MOST_CHARS else None

    @property
    def spans(self) -> tuple[tuple[int, int], ...]:
        """The spans of the literals that make up the value."""
        seen: set[Constant] = set()
        return tuple(dict.fromkeys(s for c in constants(self.known, set()) for s in source_spans(c, seen)))


def base_spans(text: str) -> list[Span]:
    """The three base kinds; each leftmost and without overlap, too short matches dropped after matching."""
    out = [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    out += [Span("access", *m.span()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return out + [Span("hex", *m.span()) for m in HEX.finditer(text)]


class Places:
    """The names that text positions stand in, asked for in order."""

    def __init__(self, text: str) -> None:
        self.text, self.braces, self.lines = text, [], []
        marks = []
        if "{" in text:
            marks += [(m.start(), "{" if m[0][-1] == "{" else "}", m) for m in BRACE.finditer(text)]
        if ":" in text:
            marks += [(m.start(), ":", m) for m in PARENT.finditer(text)]
        if "[" in text:
            marks += [(m.start(), "[", m) for m in SECTION.finditer(text)]
        self.marks, self.next, self.section = sorted(marks, key=lambda m: m[0]), 0, ""
        self.line, self.last = 0, 0  # start of the line last asked for, and the place in it

    def of(self, at: int) -> str:
        """The name around a position, or nothing."""
        while self.next < len(self.marks) and self.marks[self.next][0] < at:
            _, kind, m = self.marks[self.next]
            self.next += 1
            if kind == "{":
                self.braces.append(m[1] or "")
            elif kind == "}":
                self.braces[-1:] = []
            elif kind == "[":
                self.section, self.lines = m[1], []
            else:
                depth = len(m[1].expandtabs())
                self._leave(depth)
                self.lines.append((depth, m[2]))
        self.line, self.last = max(self.line, self.text.rfind("\n", self.last, at) + 1), at
        self._leave(len(INDENT.match(self.text, self.line, at)[0].expandtabs()))
        return (self.braces[-1] if self.braces else "") or (self.lines[-1][1] if self.lines else self.section)

    def _leave(self, depth: int) -> None:
        while self.lines and self.lines[-1][0] >= depth:
            self.lines.pop()


def assignments(text: str) -> Iterator[Assignment]:
    """Assignments in order, with the constants bound so far carried into values."""
    if not any(c in text for c in "=:<"):
        return
    bound: dict[str, Constant | Loose] = {}
    places = Places(text)
    starts: list[tuple[int, str, re.Match]] = [(m.start(1), "name", m) for m in NAME.finditer(text)]
    if "," in text:
        lists = [(m.start(1), "list", m) for m in TARGETS.finditer(text)]
        covered = {m.end() for _, _, m in lists}
        starts = [s for s in starts if s[2].end() not in covered] + lists
    if "</" in text:
        starts += [(m.start(), "element", m) for m in ELEMENT.finditer(text)]
    for at, kind, m in sorted(starts, key=lambda s: s[0]):
        inside = places.of(at)
        if kind == "element":
            yield Assignment(m[1], literal(m[2], *m.span(2)), inside)
            continue
        end = m.end()
        for i, name in enumerate(re.split(r"[ \t]*,[ \t]*", m[1]) if kind == "list" else [m[1]]):
            if i:
                if not (comma := COMMA.match(text, end)):
                    break
                end = comma.end()
            known, end = _value(text, end, bound)
            if kind == "name" and m[2] in ("+=", ".="):
                known = _sum([bound.get(name), known])
            if known is not None:
                bound[name] = known
            else:
                bound.pop(name, None)
            yield Assignment(name, known, inside)


def _value(text: str, at: int, bound: dict[str, Constant | Loose]) -> tuple[Constant | Loose | None, int]:
    """What is known of the value that begins at a place, and where it ends."""
    if block := BLOCK.match(text, at):
        return _indented(text, at, block.end())
    opened = OPENING.match(text, at)
    at, terms, apart = opened.end() if opened else at, [], False
    while True:
        if term := QUOTED.match(text, at):
            inner = term.lastindex
            terms.append(literal(term[inner], *term.span(inner)))
            joined = (INSIDE if opened else PLUS).match(text, term.end()) or NEXT.match(text, term.end())
        elif term := BARE.match(text, at):
            joined = (INSIDE if opened else PLUS).match(text, term.end())
            if known := bound.get(term[0]):
                terms.append(known)
            # An unquoted word next to others is a name that isn't known, not a literal.
            elif terms or joined:
                terms.append(None)
            else:
                terms.append(literal(term[0], *term.span()))
        else:
            break
        at = term.end()
        if not joined:
            break
        if opened and "," in joined[0]:  # a list: its items are values of their own
            apart = True
            terms.append(None)
        at = joined.end()
    known = _sum(terms)
    if apart and isinstance(known, Constant):
        known = Loose((known,))
    return known, at


def _indented(text: str, at: int, begin: int) -> tuple[Constant | Loose | None, int]:
    """Lines indented deeper than the one that holds ``at``, from ``begin``: each a literal."""
    depth, pieces = len(INDENT.match(text, text.rfind("\n", 0, at) + 1)[0]), []
    while begin < len(text):
        end = text.find("\n", begin)
        end = len(text) if end < 0 else end
        own = text[begin:end]
        if own.strip():
            indent = len(own) - len(own.lstrip())
            if indent <= depth:
                break
            pieces.append(literal(own.strip(), begin + indent, begin + indent + len(own.strip())))
        begin = end + 1
    if not pieces:
        return None, begin
    return Loose((added(pieces), *pieces)) if len(pieces) > 1 else pieces[0], begin


def _sum(terms: list[Constant | Loose | None]) -> Constant | Loose | None:
    """What is known of a sum, whose unknown terms are None."""
    runs = [added(list(run)) for constant, run in itertools.groupby(terms, lambda t: isinstance(t, Constant)) if constant]
    if len(runs) == 1 and all(isinstance(t, Constant) for t in terms):
        return runs[0]
    pieces = dict.fromkeys([*runs, *(t for t in terms if t)])
    return Loose(tuple(pieces)) if pieces else None


def name_score(name: str, inside: str = "") -> float:
    """How sensitive a target name is, from its words; a harmless last word takes that away. A name that it stands in counts with the
    word next to it, and by itself if the name is a generic one."""
    words = [w.lower() for w in PARTS.findall(name)]
    around = [w.lower() for w in PARTS.findall(inside)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    if around and set(words) <= GENERIC:
        return name_score(inside)
    pairs = [f"{a} {b}" for a, b in zip([*around[-1:], *words], [*around[-1:], *words][1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + pairs), default=0.0)


def literal_score(value: str) -> float:
    """From 0 to 1: long, varied, mixed values without spaces look like secrets, placeholders and prose don't."""
    return constant_score(literal(value))


def constant_score(value: Constant) -> float:
    """The score of a value from its characters and ends; a placeholder of any length shows in these."""
    n, chars = value.length, "".join(value.counts)
    shown = value.head if n <= MOST_CHARS else value.head + chars + value.tail
    if n < LEAST_CHARS or PLACEHOLDER.match(shown) or re.search(r"\s", chars):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in value.counts.values())
    mixed = sum(bool(re.search(p, chars)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if mixed < 2 and entropy < 3.5:
        return 0.3
    return min(1.0, 0.4 + 0.1 * mixed + 0.1 * min(entropy, 4.0))


def named_spans(text: str) -> list[Span]:
    """Values assigned to sensitive names."""
    found, spanned = set(), set()
    scored: defaultdict[float, set[Constant | Loose]] = defaultdict(set)
    for a in assignments(text):
        if sensitive := name_score(a.name, a.inside):
            for constant in constants(a.known, scored[sensitive]):
                if sensitive * constant_score(constant) >= THRESHOLD:
                    found |= {Span("named", *s) for s in source_spans(constant, spanned) if s[0] < s[1]}
    return list(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def scan(text: str) -> list[Span]:
    """All spans of a text."""
    return ordered(base_spans(text) + named_spans(text))


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with the union of the spans replaced, one mark for each connected stretch."""
    out, done = [], 0
    for start, end in _stretches(spans):
        out += [text[done:start], mark]
        done = end
    return "".join([*out, text[done:]])


def _stretches(spans: list[Span]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s.start):
        if merged and s.start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], s.end))
        else:
            merged.append((s.start, s.end))
    return merged


def scan_column(text: Column) -> Column:
    """Counts of the base kinds, ``base_sha256`` and ``spans`` of each text."""
    @F.arrow_udf("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,n_named:bigint,base_sha256:string,spans:string>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch:
                spans = scan(value.as_py() or "")
                counts = Counter(s.kind for s in spans)
                base = ",".join(str(s) for s in spans if s.kind in BASE)
                row = [*(counts[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), ",".join(map(str, spans))]
                for column, cell in zip(columns, row):
                    column.append(cell)
            yield pa.StructArray.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["n_assign", "n_access", "n_hex", "n_named", "base_sha256", "spans"])

    return scanned(text)


def redact_column(text: Column) -> Column:
    """Each text without its secrets; null stays null, and texts without secrets stay as they are."""
    @F.arrow_udf("string")
    def redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = (v.as_py() for v in batch)
            yield pa.array([t and redact(t, scan(t)) for t in texts], pa.string())

    return redacted(text)
