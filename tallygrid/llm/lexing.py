"""Secret scans by assignment-aware lexing (operator 5).

Three fixed patterns give the base spans. The lexer reads the text as source or
configuration code: it cuts it into names, string literals, numbers and
punctuation, forms name-literal pairs (``name = "literal"``, ``name: literal``,
``"name": "literal"``, ``--name literal``, ``<name>literal</name>``, ``key="name" value="literal"``,
``name("literal")``, ``"name", "literal"``), joins adjacent or added literals, and propagates
constants: a name bound to a literal stands for it wherever it is assigned to another name,
before or after. A literal is scored by its target name (sensitive words in it) and by its own
shape (length, kinds of characters, entropy; a pass phrase by its words); pairs with a score of
``threshold`` or more add a span of kind ``lexed``, unless a base span already covers it.

Bindings form a graph: each holds the literals of its value and points to the bindings of the names in it,
each once. One walk back from sensitive names reaches every literal behind them, so time and memory
follow the length of the text, however often names are used.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import map_batches, ready, whole_text

# The base patterns and the least lengths of what they find.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "lexed")

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is HEX with the short ones dropped
# Words of target names and what they add to the score of a literal.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2, "apikey": 3, "api_key": 3,
    "accesskey": 3, "access_key": 3, "private_key": 3, "privatekey": 3, "credential": 2, "credentials": 2, "auth": 1,
    "bearer": 2, "signature": 1, "client_secret": 3, "encryption_key": 3,
}
THRESHOLD = 4
#: A text that holds none of these once ``_``, ``.`` and ``-`` are taken out has no sensitive name, and is not lexed.
_BARE = {w.replace("_", "") for w in SENSITIVE}
HINTS = tuple(sorted(w for w in _BARE if not any(x != w and x in w for x in _BARE)))

# A backslash takes the next character with it, so an escaped quote opens nothing.
_QUOTED = r'''"""(?:[^\\]|\\.)*?"""|\'\'\'(?:[^\\]|\\.)*?\'\'\'|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`(?:[^`\\]|\\.)*`'''
_LEX = re.compile(
    rf"""(?P<escape>\\.)|(?P<str>{_QUOTED})|(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)|(?P<num>[0-9][A-Za-z0-9+/_=-]*)|(?P<op>:=|=>|[:=+(){{}}\[\],;<>])|(?P<nl>\n)""",
    re.DOTALL,
)


# The forms around a literal. An unquoted one reaches up to white space, comma, semicolon, bracket or quote.
_BLANKS = re.compile(r"[ \t]*")
_STRING = re.compile(_QUOTED, re.DOTALL)
_RUN = re.compile(r"""[^\s,;()\[\]{}<>"'`]+""")
_PLUS = re.compile(r"[ \t]*\+")
# ``name: type = literal``; the type may have arguments, alternatives, a reference or an optional mark
_ARGUMENTS = r"(?:\[[^\[\]\n=]*(?:\[[^\[\]\n=]*\][^\[\]\n=]*)*\]|<[^<>\n=]*(?:<[^<>\n=]*>[^<>\n=]*)*>)*"
_ONE_TYPE = rf"&?(?:'[a-z]+[ ])?[A-Za-z_](?:[\w.]|::)*{_ARGUMENTS}[?!]?"
_TYPED = re.compile(rf"[ \t]*({_ONE_TYPE}(?:[ \t]*\|[ \t]*{_ONE_TYPE})*)[ \t]*=(?![=>])")
_IDENTIFIER = re.compile(r"[A-Za-z_][\w.-]*", re.ASCII)
_TAG = re.compile(r"""<[A-Za-z_][\w:.-]*((?:\s+[\w:.-]+\s*=\s*(?:"[^"<>]*"|'[^'<>]*'))+)\s*[/?]?>""")
_ATTRIBUTE = re.compile(r"""([\w:.-]+)\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)')""")
_NAMING, _VALUED = {"key", "name", "id", "property"}, {"value", "content"}
_ELEMENT = re.compile(r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)(?:\s[^<>]*)?(?<!/)>(?:\s*<!\[CDATA\[)?([^<]*?)(?:\]\]>\s*)?</")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, short ones dropped; by start, then kind as listed."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [Span("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(s: Span) -> tuple[int, int, int]:
    return s.start, KINDS.index(s.kind), s.end


def name_score(name: str) -> int:
    """Sensitive words in a name: whole, or as parts of snake, kebab, dotted or camel case."""
    spread = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
    parts = [p for p in re.split(r"[_.\-]+", spread) if p]
    pairs = {f"{a}_{b}" for a, b in zip(parts, parts[1:])} | {a + b for a, b in zip(parts, parts[1:])}
    return max((SENSITIVE.get(p, 0) for p in [*parts, *pairs]), default=0)


_SHOWN = re.compile(r"your|example|change.?me", re.DOTALL)
#: A pass phrase: four lower-case words or more, none of them a word that sentences are made with.
_PHRASE = re.compile(r"[a-z]{3,}(?:[ _-][a-z]{3,}){3,}")
_PLAIN = set("the and your you please enter for with this that must not are was will can has have from here our their its is of to in".split())


def phrase_score(text: str, start: int, end: int) -> int:
    """2 for a pass phrase of plain words, else 0."""
    return 2 if _PHRASE.fullmatch(text, start, end) and not _PLAIN & set(re.split("[ _-]", text[start:end])) else 0


def _stand_in(text: str, start: int, end: int) -> bool:
    """Whether a literal only shows where a secret goes."""
    head, tail = text[start : min(end, start + 10)].lower(), text[end - 1]
    return bool(_SHOWN.match(head)) or head[0] == "<" and tail == ">" or head.startswith("${") and tail == "}"


class Shape:
    """Characters of a literal, counted so that one to the left can be added: length, kinds, entropy."""

    def __init__(self):
        self.counts: Counter[str] = Counter()
        self.size, self.weight, self.white = 0, 0.0, False
        self.kinds: set[int] = set()

    def add(self, part: str) -> None:
        for c in part:
            n = self.counts[c]
            self.counts[c] = n + 1
            self.weight += (n + 1) * math.log2(n + 1) - (n * math.log2(n) if n else 0.0)
            if not n:
                self.kinds.add(0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3)
                self.white |= c.isspace()
        self.size += len(part)

    def score(self) -> int:
        """0 to 3: long enough, mixed, and of high entropy. Text with white space or of one character scores nothing."""
        if self.size < 8 or self.white or len(self.counts) == 1:
            return 0
        entropy = math.log2(self.size) - self.weight / self.size
        return (self.size >= 12) + (len(self.kinds) >= 2 and 2 in self.kinds) + (entropy >= 3.0)


def literal_score(value: str) -> int:
    """The score of a literal by its shape."""
    shape = Shape()
    shape.add(value)
    return 0 if value and _stand_in(value, 0, len(value)) else max(shape.score(), phrase_score(value, 0, len(value)))


class Binding(NamedTuple):
    """A name with its value: literals as (start, end) of the text, other bindings by number, names that are not bound yet
    (with the place of the word, which is the literal if they never are)."""

    name: str
    literals: list[tuple[int, int]]
    uses: list[int]
    ahead: list[tuple[str, int, int]]


class Lexer:
    """The bindings of a text, in one pass."""

    def __init__(self, text: str):
        self.text, self.end = text, len(text)
        self.bindings: list[Binding] = []
        self.bound: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.run = (0, 0)  # the last unquoted run, so that no character of it is read again for a value inside
        self._read()

    def _bind(self, name: str, literals, uses=(), ahead=(), keep: bool = True) -> None:
        if not (literals or uses or ahead):
            return
        if keep:
            self.bound[name] = len(self.bindings)
            self.first.setdefault(name, len(self.bindings))
        self.bindings.append(Binding(name, list(literals), list(dict.fromkeys(uses)), list(ahead)))

    def _read(self) -> None:
        text = self.text
        tokens = [(m.lastgroup, m.start(), m.end()) for m in _LEX.finditer(text)]
        word = lambda i: text[tokens[i][1] : tokens[i][2]] if i < len(tokens) and tokens[i][0] == "op" else ""
        for i, (kind, start, stop) in enumerate(tokens):
            if kind == "op" and text[start] == "<":
                self._element(start)
            if kind not in ("name", "str"):
                continue
            inner = (start, stop) if kind == "name" else _inside(text, start, stop)
            if kind == "str" and not _IDENTIFIER.fullmatch(text, *inner):
                continue
            # the gap between name, operator and value holds blanks only: a sentence's colon does not reach far
            op = word(i + 1)
            near = op and not text[stop : tokens[i + 1][1]].strip(" \t")
            at = tokens[i + 1][2] if op else stop
            if near and op in ("=", ":", ":=", "=>"):
                if text.startswith("==", at - 1):
                    continue  # a comparison binds nothing
                name, extra = text[slice(*inner)], []
                if op == ":" and (m := _TYPED.match(text, at)):
                    # a type that looks like a secret may be one: then both are bound
                    extra = [x for x in self._value(at)[0] if literal_score(text[slice(*x)]) == 3]
                    at = m.end()
                literals, uses, ahead = self._value(at)
                self._bind(name, extra + literals, uses, ahead)
            elif kind == "name" and text[max(0, start - 2) : start] == "--" and text[stop : stop + 1] in (" ", "\t"):
                self._bind(text[start:stop], *self._value(stop))
            elif near and op in ("(", ",") and (kind == "name") == (op == "("):
                # name("literal") and "name", "literal" bind nothing that is used again
                if quoted := _STRING.match(text, _BLANKS.match(text, at).end()):
                    self._bind(text[slice(*inner)], [_inside(text, *quoted.span())], keep=False)

    def _element(self, start: int) -> None:
        text = self.text
        if (m := _ELEMENT.match(text, start)) and (value := m.group(2).strip()):
            at = m.start(2) + m.group(2).index(value)
            use = self.bound.get(value)
            self._bind(m.group(1), [] if use is not None else [(at, at + len(value))], [] if use is None else [use])
        if m := _TAG.match(text, start):
            found = {a.group(1).lower(): a for a in _ATTRIBUTE.finditer(text, *m.span(1))}
            names = [found[k] for k in found if k in _NAMING]
            for valued in (found[k] for k in found if k in _VALUED):
                for named in names:
                    self._bind(named.group(2) or named.group(3) or "", [valued.span(2) if valued.group(2) is not None else valued.span(3)], keep=False)

    def _value(self, at: int) -> tuple[list[tuple[int, int]], list[int], list[tuple[str, int, int]]]:
        """What a value at ``at`` consists of: adjacent or added strings, names, unquoted literals."""
        text, literals, uses, ahead = self.text, [], [], []
        while True:
            at = _BLANKS.match(text, at).end()
            if quoted := _STRING.match(text, at):
                literals.append(_inside(text, *quoted.span()))
                at = quoted.end()
            elif stop := self._run(at):
                if text.find("=", at, stop) >= 0:
                    literals.append((at, stop))  # no sum of names
                else:
                    word = text[at:stop]
                    if word.endswith("+") and len(word) > 1 and _STRING.match(text, _BLANKS.match(text, stop).end()):
                        word, stop = word[:-1], stop - 1
                    parts = [(m.group(), at + m.start(), at + m.end()) for m in re.finditer(r"[^+]+", word)]
                    if any(p in self.bound for p, _, _ in parts):
                        for p, a, b in parts:
                            if p in self.bound:
                                uses.append(self.bound[p])
                            else:
                                ahead.append((p, a, b))
                    else:
                        ahead.append((word, at, stop))
                at = stop
            else:
                return literals, uses, ahead
            if more := _PLUS.match(text, at):
                at = more.end()
            elif not (quoted and _STRING.match(text, _BLANKS.match(text, at).end())):
                return literals, uses, ahead

    def _run(self, at: int) -> int:
        """The end of the unquoted run at ``at``; 0 if there is none."""
        if not self.run[0] <= at < self.run[1]:
            found = _RUN.match(self.text, at)
            if not found:
                return 0
            self.run = found.span()
        return self.run[1]

    def targets(self) -> dict[tuple[tuple[int, int], ...], int]:
        """The literals behind sensitive names, those of one value together, with the highest score of a name.

        Names of high score come first, so every binding is walked once.
        """
        scores: dict[str, int] = {}
        by_score: dict[int, list[int]] = {}
        for i, b in enumerate(self.bindings):
            if (score := scores[b.name] if b.name in scores else scores.setdefault(b.name, name_score(b.name))) > 0:
                by_score.setdefault(score, []).append(i)
        seen: set[int] = set()
        found: dict[tuple[tuple[int, int], ...], int] = {}
        for score in sorted(by_score, reverse=True):
            stack = by_score[score]
            while stack:
                i = stack.pop()
                if i in seen:
                    continue
                seen.add(i)
                b = self.bindings[i]
                literals = list(b.literals)
                for name, start, stop in b.ahead:
                    if name in self.first:
                        stack.append(self.first[name])
                    else:
                        literals.append((start, stop))
                if literals:
                    found.setdefault(tuple(dict.fromkeys(literals)), score)
                stack += b.uses
        return found


def _inside(text: str, start: int, stop: int) -> tuple[int, int]:
    """What stands between the quotes."""
    width = 3 if stop - start >= 6 and text[start : start + 3] in ('"""', "'''") else 1
    return start + width, stop - width


def _shapes(text: str, literals: set[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """The shape's score of each literal. Those that end together lie in each other and are counted in one go, from the right."""
    out = {}
    shape, end, at = Shape(), -1, -1
    for start, stop in sorted(literals, key=lambda x: (x[1], -x[0])):
        if stop != end:
            shape, end, at = Shape(), stop, stop
        shape.add(text[start:at])
        at = start
        if start >= stop or _stand_in(text, start, stop):
            out[start, stop] = 0
        else:
            out[start, stop] = shape.score() or phrase_score(text, start, stop)
    return out


def lexed_spans(text: str, threshold: int = THRESHOLD) -> list[Span]:
    """Spans of literals whose target name and shape score ``threshold`` or more; the literals of one value are scored joined and alone."""
    low = text.lower().replace("_", "").replace(".", "").replace("-", "")
    if not any(h in low for h in HINTS):
        return []
    targets = Lexer(text).targets()
    shapes = _shapes(text, {x for group in targets for x in group})
    found = {}
    for group, score in targets.items():
        whole = 0
        if len(group) > 1:
            joint = Shape()
            for start, stop in group:
                joint.add(text[start:stop])
            whole = joint.score()
        for start, stop in group:
            shape = max(whole, shapes[start, stop])
            if shape and score + shape >= threshold and start < stop:
                found[start, stop] = Span("lexed", start, stop)
    return list(found.values())


def all_spans(text: str, threshold: int = THRESHOLD) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: base ones stay, lexed ones join where no base span covers them."""
    base = base_spans(text)
    # of the base spans that start no later the one that reaches furthest decides
    starts, reach = [b.start for b in base], list(itertools.accumulate((b.end for b in base), max))
    covered = lambda s: (k := bisect.bisect_right(starts, s.start)) and reach[k - 1] >= s.end
    added = [s for s in lexed_spans(text, threshold) if not covered(s)]
    return base, sorted(base + added, key=_order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with every span, overlaps merged, replaced by a mark."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, s.end)):
        if s.start >= at:
            out += [text[at : s.start], mark]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_lexed.

    Null and empty texts have no spans (base_sha256 is that of the empty text). Rows are
    independent, so repeated rows and null ids stay; an empty table gives an empty result.
    """

    def rows(batches):
        for batch in batches:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_lexed")}
            for text in batch["text"]:
                base, spans = all_spans(text, threshold)
                kinds = Counter(s.kind for s in base)
                out["n_assign"].append(kinds["assign"])
                out["n_access"].append(kinds["access"])
                out["n_hex"].append(kinds["hex"])
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
                out["n_lexed"].append(len(spans) - len(base))
            yield {"doc_id": batch["doc_id"], **out}

    source = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long"
    return map_batches(source, schema, rows)


def redact(docs: DataFrame, threshold: int = THRESHOLD, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, with secrets in ``text`` replaced and ``n_chars`` counted anew where it changed.

    Null texts stay null, texts without a secret stay as they are.
    """
    clean = F.udf(lambda t: redacted(t, all_spans(t, threshold)[1], mark) if t else t, "string", useArrow=True)
    ready(docs.sparkSession)
    out = docs.withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out
