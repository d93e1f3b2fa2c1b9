"""Secret scans by assignment-aware lexing.

Three fixed patterns give the base spans. Then source and configuration syntax is lexed into assignments (a
target name and the terms of its value), literals are propagated through names and concatenations, and a
literal is scored by the words of the names it reaches and by its own look. Literals that score enough and that
no base span covers are added as kind ``literal``.

A value is a term or several joined ones, a list, what stands in parentheses over lines, a triple-quoted text, a
block scalar, or a quoted text on the next line; a name may have a type. A name stands for its last assignment
before, or, if there is none, for all after it. Assignments refer to each other and share what they hold, so the
work grows with the number of terms.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is the whole run that HEX finds
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ["assign", "access", "hex", "literal"]
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: What a word of a target name adds; below zero: names of things about secrets that aren't secret.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.8, "apikey": 1.0, "credential": 1.0, "credentials": 1.0,
    "key": 0.4, "api": 0.3, "private": 0.5, "access": 0.3, "auth": 0.5, "bearer": 0.8, "authorization": 0.8, "signing": 0.4, "encryption": 0.4, "pass": 0.7,
    "count": -1.0, "max": -0.7, "min": -0.7, "limit": -0.7, "length": -0.8, "size": -0.8, "type": -0.7, "name": -0.6, "public": -0.8, "file": -0.6, "path": -0.6, "url": -0.6, "id": -0.2, "hint": -0.8, "policy": -0.8,
}
THRESHOLD = 1.2
#: Characters of a target name and its type at most, and of a joined value that is looked at as a placeholder.
LONGEST_NAME = LONGEST_PLACEHOLDER = 4096
_PLACEHOLDER = re.compile(r"(?i)^(?:x{4,}|\*{3,}|\.{3,}|<.*>|\[\w*\]|\$\{.*\}|%\(?\w+\)?s?|(?:your|my|the)[-_ ].*|change[-_ ]?me.*|example.*|placeholder.*|none|null|true|false|todo|redacted)$")
_NAME_END = re.compile(r"""([A-Za-z_][A-Za-z0-9_.\-]*)["']?\]?[ \t]*$""")
_ARRAY_END = re.compile(r"""([A-Za-z_][A-Za-z0-9_]*)[ \t]*\[[A-Za-z0-9_]{0,64}\][ \t]*$""")
_TYPE = re.compile(r"""[ \t]*[A-Za-z_&*\[(?][A-Za-z0-9_.<>\[\](), \t|?&*'"]*$""")
_TYPE_AFTER = re.compile(r"""\b(?:var|const)[ \t]+([A-Za-z_][A-Za-z0-9_]*)[ \t]+(?:\*?string|\[\](?:string|byte))[ \t]*$""")
_IS_TYPE = re.compile(r"(?:\[[^=\n]{0,200}\])?[ \t]+=(?![=>])")
_OPERATOR = re.compile(r"\+=|\.=|\?\?=|\|\|=|\?=|:=|=>|=|:")
_TERM = re.compile(r"""[ \t]*(?:[bfru]{0,2}"((?:[^"\\\n]|\\.)*)"|[bfru]{0,2}'((?:[^'\\\n]|\\.)*)'|([A-Za-z_][A-Za-z0-9_.]*+)(?![(+/=~!@#$%^&*-]))""")
_BARE = re.compile(r"[A-Za-z0-9+/_=.~!@#$%^&*-]++")
_BLANKS = re.compile(r"[ \t]*+")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|\|\|)[ \t]*|[ \t]*\.[ \t]+")
_TRIPLE = re.compile(r"""[ \t]*[bfruBFRU]{0,2}(\"{3}|'{3})""")
_NEXT_LINE = re.compile(r"""[ \t]*+(?:\\|#[^\n]{0,200}+|//[^\n]{0,200}+)?\r?\n[ \t]*+(?=[bfru]{0,2}["'])""")
_NO_KEY = re.compile(r"[ \t]*(?:class|def|if|elif|else|for|while|try|except|finally|with|case|default|switch)\b")
_BLOCK = re.compile(r"[ \t]*[|>][+\-0-9]{0,2}[ \t]*(?:#[^\n]{0,200})?\r?\n")
_ITEM = re.compile(r"[ \t]*\r?\n[ \t]*- +(?![ \t\n])")
_OPEN = re.compile(r"[ \t]*(?:new[ \t]+[A-Za-z]+|\[\][A-Za-z]+)?(?:\[\])?[ \t]*[\[({]")
_BETWEEN = re.compile(r"(?:[ \t\r\n]|#[^\n]{0,200}+(?=\n)|//[^\n]{0,200}+(?=\n)|\\\n)*+")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def base_spans(text: str, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns that are long enough; offsets in code points. raw: the same text, to pass over what can't match."""
    low = (text.encode("utf-8", "surrogatepass") if raw is None else raw).lower()
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    return sum(WEIGHTS.get(w.lower(), 0.0) for w in _PARTS.findall(name.rsplit(".", 1)[-1]))


def _look(value: str) -> tuple[float, int, dict[str, float], str | None]:
    """Of a value: characters, blanks (3: or more), characters by kind, and itself if it may be a placeholder."""
    return len(value), min(3, value.count(" ")), Counter(value), value if len(value) <= LONGEST_PLACEHOLDER else None


def _joined_look(looks: list[tuple]) -> tuple[float, int, dict[str, float], str | None]:
    if len(looks) == 1:
        return looks[0]
    n, counts = sum(x[0] for x in looks), {}
    for x in looks:
        for ch, k in x[2].items():
            counts[ch] = counts.get(ch, 0) + k
    if n > 1e12:  # a = a + a: the shares alone matter
        counts, n = {ch: k * (1e9 / n) for ch, k in counts.items()}, 1e9
    text = "".join(x[3] for x in looks) if n <= LONGEST_PLACEHOLDER and all(x[3] is not None for x in looks) else None
    return n, min(3, sum(x[1] for x in looks)), counts, text


def _look_score(look: tuple) -> float:
    n, blanks, counts, text = look
    if n < 8 or blanks > 2 or (text is not None and _PLACEHOLDER.match(text)):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values() if k > 0)
    kinds = sum((any(ch.islower() for ch in counts), any(ch.isupper() for ch in counts), any(ch.isdigit() for ch in counts), any(not ch.isalnum() for ch in counts)))
    return min(1.0, 0.15 * kinds + max(0.0, entropy - 2.0) / 3 + 0.1 * (n >= 16))


def literal_score(value: str) -> float:
    """0 for what can't be a secret; up to 1 by length, mixture and entropy."""
    return _look_score(_look(value))


def _targets(text: str, s: int, op: str) -> list[str]:
    """The names that the operator at s gives a value to: the word before it, and the one whose type that is."""
    left, least = s, max(0, s - LONGEST_NAME)
    while left > least and (text[left - 1].isalnum() or text[left - 1] in "_.-\"'] \t"):
        left -= 1
    name = _NAME_END.search(text, left, s)
    found = [name[1]] if name else []
    if op == "=":
        line = max(text.rfind("\n", least, s) + 1, least)
        colon = text.rfind(":", line, s)
        if colon > line and text[colon - 1] != ":" and _TYPE.match(text, colon + 1, s):
            left = colon
            while left > line and (text[left - 1].isalnum() or text[left - 1] in "_.-\"']?! \t"):
                left -= 1
            typed = _NAME_END.search(text[left:colon].rstrip("?! \t"))
        else:
            typed = text[max(line, s - 256) : s].rstrip().endswith(("string", "byte")) and _TYPE_AFTER.search(text, max(line, s - 256), s)
        typed = typed or (text[max(line, s - 256) : s].rstrip().endswith("]") and _ARRAY_END.search(text, max(line, s - 256), s))
        if typed:
            found.insert(0, typed[1])
    return found


def _term(text: str, at: int, run: list[int]) -> tuple[tuple[str, int, int], int] | None:
    """run: where the last bare value was found; a run of its characters has one end, wherever in it one starts."""
    term = _TERM.match(text, at)
    if term:
        k = term.lastindex
        return ("name" if k == 3 else "literal", *term.span(k)), term.end()
    s = _BLANKS.match(text, at).end()
    if not run[0] <= s < run[1]:
        bare = _BARE.match(text, s)
        if not bare:
            return None
        run[:] = bare.span()
    return None if text[run[1] : run[1] + 1] == "(" else (("literal", s, run[1]), run[1])


def _lines(text: str, s: int, e: int) -> list[tuple[str, int, int]]:
    """The lines of a stretch of text as literals, without the blanks round them."""
    out = []
    for m in re.finditer(r"[^\n]+", text[s:e]):
        line = m[0].strip()
        if line:
            at = s + m.start() + m[0].index(line)
            out.append(("literal", at, at + len(line)))
    return out


def _bracketed(text: str, at: int, run: list[int]) -> list[list[tuple[str, int, int]]]:
    """The elements from an open bracket on, as far as they are literals, names and joins of them; brackets inside are flat."""
    depth, elements, element = 0, [], []
    while True:
        at = _BETWEEN.match(text, at).end()
        ch = text[at : at + 1]
        if triple := _TRIPLE.match(text, at):
            end = text.find(triple[1], triple.end())
            if end < 0:
                break
            element += _lines(text, triple.end(), end)
            at = end + 3
        elif ch and ch in "[({":
            depth, at = depth + 1, at + 1
        elif ch and ch in "])}":
            depth, at = depth - 1, at + 1
            if depth == 0:
                break
        elif ch == "," or ch == ";":
            elements.append(element)
            element, at = [], at + 1
        elif ch and ch in "+|." and element:
            at += 2 if text[at : at + 2] in ("||", "..") else 1
        elif found := _term(text, at, run):
            element.append(found[0])
            at = found[1]
        else:
            if ch and ch in ":=":  # what came last is a key
                element = []
            break
    return [x for x in [*elements, element] if x]


def assignments(text: str):
    """(targets, elements, kind) in textual order; an element's terms are ("literal" | "name", start, end), joined.

    kind: "one" value, a "list" of some, a "block" of lines, or "more" of the value that the name had.
    """
    open_triples, run = set(), [0, 0]  # quotes that no later ones close
    for op in _OPERATOR.finditer(text):
        s, e = op.span()
        if text[s - 1 : s] in ("=", "!", "<", ">") or text[e : e + 1] in ("=", "/") and text[e : e + 2] in ("==", "//", "= "):
            continue
        names = _targets(text, s, op[0])
        if not names:
            continue
        at, kind = e, "more" if op[0] in ("+=", ".=") else "one"
        if ahead := _NEXT_LINE.match(text, e):
            if op[0] != ":" or not _NO_KEY.match(text, max(text.rfind("\n", max(0, s - LONGEST_NAME), s) + 1, s - LONGEST_NAME, 0), s):
                at = ahead.end()
        if (triple := _TRIPLE.match(text, at)) and triple[1] not in open_triples:
            end = text.find(triple[1], triple.end())
            if end < 0:
                open_triples.add(triple[1])
            elif found := _lines(text, triple.end(), end):
                yield names, [found], "more" if kind == "more" else "block"
            continue
        if op[0] == ":" and (block := _BLOCK.match(text, e)):
            start = text.rfind("\n", 0, s) + 1
            indent = len(text[start:s]) - len(text[start:s].lstrip(" \t"))
            at = end = block.end()
            while end < len(text):
                stop = text.find("\n", end)
                stop = len(text) if stop < 0 else stop
                line = text[end:stop]
                if line.strip() and len(line) - len(line.lstrip(" \t")) <= indent:
                    break
                end = stop + 1
            if found := _lines(text, at, end):
                yield names, [found], "block"
            continue
        if op[0] == ":" and _ITEM.match(text, e):
            elements = []
            while item := _ITEM.match(text, at):
                found = _term(text, item.end(), run)
                if not found:
                    break
                elements.append([found[0]])
                at = found[1]
            if elements:
                yield names, elements, "list"
            continue
        if opened := _OPEN.match(text, at):
            elements = _bracketed(text, opened.end() - 1, run)
            if elements:
                yield names, elements, kind if len(elements) == 1 and kind == "more" else "list" if len(elements) > 1 else "one"
            continue
        terms = []
        while found := _term(text, at, run):
            terms.append(found[0])
            more = _JOIN.match(text, found[1])
            if not more:
                break
            at = more.end()
        if terms:
            if op[0] == ":" and len(terms) == 1 and terms[0][0] == "name" and _IS_TYPE.match(text, terms[0][2]):
                continue
            yield names, [terms], kind


class _Graph:
    """Assignments as nodes: the literals that each holds itself, and the nodes whose values are part of its own."""

    def __init__(self, text: str):
        found = list(assignments(text))
        self.text = text
        self.parts: list[list] = []  # of a node: a literal (start, end) or a node's number
        self.names: list[float] = []
        self.block: list[bool] = []
        later: dict[str, int] = {}  # for a name without assignment so far: the node of all of them
        defined: dict[str, list[int]] = {}
        total = Counter(n for names, _, _ in found for n in set(names))
        last: dict[str, int] = {}
        for names, elements, kind in found:
            score, nodes = max(map(name_score, names)), []
            for terms in elements:
                parts = []
                if kind == "more" and names[0] in last:
                    parts.append(last[names[0]])
                for what, s, e in terms:
                    if what == "literal":
                        parts.append((s, e))
                        continue
                    value = text[s:e]
                    if value in last:
                        parts.append(last[value])
                    elif total[value] > (value in names):
                        if value not in later:
                            later[value] = self._node([], 0.0)
                        parts.append(later[value])
                    elif len(terms) == 1:
                        parts.append((s, e))
                nodes.append(self._node(parts, score, kind == "block"))
            whole = nodes[0] if len(nodes) == 1 else self._node(nodes, 0.0)
            for n in names:
                last[n] = whole
                defined.setdefault(n, []).append(whole)
        for name, node in later.items():
            self.parts[node] = defined[name]

    def _node(self, parts: list, score: float, block: bool = False) -> int:
        self.parts.append(parts)
        self.names.append(score)
        self.block.append(block)
        return len(self.parts) - 1

    def best(self) -> dict[tuple[int, int], float]:
        """The largest score of the nodes that each literal reaches."""
        looks: dict[int, tuple] = {}
        own: list[tuple[float, int]] = []
        for node, score in enumerate(self.names):
            if score > 0:
                whole = _look_score(self._look_of(node, looks))
                if not whole and self.block[node]:
                    lines = [literal_score(self.text[p[0] : p[1]]) for p in self.parts[node] if isinstance(p, tuple)]
                    whole = max(lines, default=0.0) if 2 * sum(x > 0 for x in lines) >= len(lines) else 0.0
                if whole:
                    own.append((score + whole, node))
        out: dict[tuple[int, int], float] = {}
        seen: set[int] = set()
        for score, start in sorted(own, reverse=True):  # so that the first to come is the largest
            todo = [start]
            while todo:
                node = todo.pop()
                if node in seen:
                    continue
                seen.add(node)
                for p in self.parts[node]:
                    if isinstance(p, tuple):
                        out.setdefault(p, score)
                    else:
                        todo.append(p)
        return out

    def _look_of(self, node: int, looks: dict[int, tuple]) -> tuple:
        """A node within itself adds nothing."""
        todo, inside = [node], set()
        while todo:
            at = todo[-1]
            if at in looks:
                todo.pop()
                continue
            new = [] if at in inside else list({p for p in self.parts[at] if not isinstance(p, tuple) and p not in looks and p not in inside and p != at})
            inside.add(at)
            if new:
                todo += new
                continue
            parts = [_look(self.text[p[0] : p[1]]) if isinstance(p, tuple) else looks.get(p) for p in self.parts[at]]
            looks[at] = _joined_look([x for x in parts if x is not None] or [_look("")])
            todo.pop()
        return looks[node]


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if "=" not in text and ":" not in text:
        return []
    starts, ends = [], []  # base spans, those that meet as one
    for _, s, e in sorted(base, key=lambda x: x[1]):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = []
    for (s, e), score in sorted(_Graph(text).best().items()):
        k = bisect_left(starts, e) - 1
        if score >= THRESHOLD and e > s and not (k >= 0 and ends[k] > s) and not (out and out[-1][2] > s):
            out.append(("literal", s, e))
    return out


def spans(raw: bytes | None) -> tuple[str, list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The text, its base spans and all spans, each by start, then kind as listed."""
    text = (raw or b"").decode("utf-8", "replace")
    base = base_spans(text, raw or b"")
    order = lambda x: (x[1], KINDS.index(x[0]))
    return text, sorted(base, key=order), sorted(base + added_spans(text, base), key=order)


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: a row for each row of docs, no shuffle.

    Null and empty texts hold nothing; very long texts are read whole; repeated rows give repeated rows. Spans that start at one place (ties) come in
    the order of KINDS. No documents: no rows. Columns beside doc_id and text aren't read.
    """

    def row(doc_id: int | None, raw: bytes | None) -> tuple:
        _, base, every = spans(raw)
        n = Counter(k for k, _, _ in base)
        return doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)

    return c.map_rows(c.texts(docs), row, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(raw: bytes | None) -> str | None:
    """The text with every span replaced by ``[kind]``, overlapping spans as one; a null text stays null."""
    if raw is None:
        return None
    text, _, found = spans(raw)
    if not found:
        return text
    out, at = [], 0
    for kind, s, e in found:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with its texts redacted and n_chars, where there is one, counted anew; the other columns stay as they are."""
    from pyspark.sql.types import StringType

    clean = F.udf(redacted, StringType(), useArrow=True)(F.col("text").cast("string").cast("binary"))
    out = docs.withColumn("text", clean)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scan() over all documents: a row for each, null and empty texts (no spans), repeated rows and very long texts included; an empty table gives no rows."""
    return scan(c.documents(spark, sf_dir))
