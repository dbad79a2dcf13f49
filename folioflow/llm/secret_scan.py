"""Secret scanning with one automaton for all rules.

The rules' regular expressions become one nondeterministic automaton, subset construction
makes it deterministic, partition refinement minimal, and the result is a table of
transitions by byte. One pass over a text's bytes runs all rules at once. Where a rule's
end is met, its reversed automaton finds the start and its own one the longest end.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import map_columns

# -- rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if it, or its value after the first : or =, is long enough."""

    kind: str
    pattern: str
    least: int = 1
    any_case: str = ""  # a leading part of the pattern whose letters match in either case
    by_value: bool = False


# The base rules.
BASE = (
    Rule("assign", r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 8, "(password|passwd|secret|token|api_?key)", True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    # Runs shorter than 32 match nothing else and need not be met, so the bound is part of the pattern.
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
#: Formats of well-known credentials, found besides the base rules.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 27),
)

# -- expressions ------------------------------------------------------------------
# A parsed expression is ("set", bytes), ("cat", parts), ("or", parts) or ("rep", part, least, most).


def _class(text: str, i: int) -> tuple[frozenset[int], int]:
    members, i = set(), i + 1
    while text[i] != "]":
        low, i = _char(text, i)
        if text[i] == "-" and text[i + 1] != "]":
            high, i = _char(text, i + 1)
            members.update(range(low, high + 1))
        else:
            members.add(low)
    return frozenset(members), i + 1


def _char(text: str, i: int) -> tuple[int, int]:
    if text[i] != "\\":
        return ord(text[i]), i + 1
    if text[i + 1] == "x":
        return int(text[i + 2 : i + 4], 16), i + 4
    return ord(text[i + 1]), i + 2


def parse(text: str, any_case: bool = False):
    """Parse literals, classes, groups, alternatives and the repetitions ? * + {n,} {n,m}."""

    def either(i):
        parts, part = [], []
        while True:
            if i == len(text) or text[i] in "|)":
                parts.append(("cat", part))
                part = []
                if i == len(text) or text[i] == ")":
                    return (parts[0] if len(parts) == 1 else ("or", parts)), i
                i += 1
                continue
            if text[i] == "(":
                node, i = either(i + 1)
                i += 1
            elif text[i] == "[":
                members, i = _class(text, i)
                node = ("set", members)
            else:
                code, i = _char(text, i)
                node = ("set", frozenset([code]))
            if any_case and node[0] == "set":
                node = ("set", frozenset(x for c in node[1] for x in (ord(chr(c).lower()), ord(chr(c).upper()))))
            while i < len(text) and text[i] in "?*+{":
                if text[i] == "{":
                    end = text.index("}", i)
                    least, _, most = text[i + 1 : end].partition(",")
                    node = ("rep", node, int(least), int(most) if most else None)
                    i = end + 1
                else:
                    node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[text[i]])
                    i += 1
            part.append(node)

    return either(0)[0]


def reversed_expression(node):
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", reversed_expression(node[1]), *node[2:])
    parts = [reversed_expression(x) for x in node[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


def first_ends(node):
    """The expression of a match's first end: an open repetition at the tail stops at its least count."""
    if node[0] == "rep" and node[2] >= 1 and node[3] is None:
        return ("rep", node[1], node[2], node[2])
    if node[0] == "cat" and node[1]:
        return ("cat", [*node[1][:-1], first_ends(node[1][-1])])
    return ("or", [first_ends(x) for x in node[1]]) if node[0] == "or" else node


class Nfa:
    """Thompson automaton of several expressions; ``accepts`` maps an end state to its rule."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.moves) - 1

    def add(self, node, start: int) -> int:
        """Lay the expression from ``start``; its end state."""
        if node[0] == "set":
            end = self.state()
            middle = self.state()
            self.empty[start].append(middle)
            self.moves[middle] = (node[1], end)
            return end
        if node[0] == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if node[0] == "or":
            end = self.state()
            for part in node[1]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, open_ = set(states), list(states)
        while open_:
            for t in self.empty[open_.pop()]:
                if t not in seen:
                    seen.add(t)
                    open_.append(t)
        return frozenset(s for s in seen if self.moves[s] or s in self.accepts)


@dataclass
class Dfa:
    """``step[state][byte]``; states from ``first`` on accept ``rules[state - first]``; ``dead`` may be -1."""

    step: list[list[int]]
    start: int
    first: int
    rules: list[tuple[int, ...]]
    dead: int


def compile_rules(nodes: list, anywhere: bool) -> Dfa:
    """Deterministic, minimal automaton; with ``anywhere`` a match may begin at every byte."""
    nfa = Nfa()
    root = nfa.state()
    for n, node in enumerate(nodes):
        begin = nfa.state()
        nfa.empty[root].append(begin)
        nfa.accepts[nfa.add(node, begin)] = n
    # Bytes that no set tells apart are one letter.
    letter_of: dict[tuple, int] = {}
    sets = sorted({m[0] for m in nfa.moves if m}, key=sorted)
    letters = [letter_of.setdefault(tuple(b in s for s in sets), len(letter_of)) for b in range(256)]
    sample = [letters.index(k) for k in range(len(letter_of))]

    start = nfa.closure([root])
    number, table, open_ = {start: 0}, [], [start]
    for subset in open_:  # grows while it is read
        row = []
        for b in sample:
            to = {nfa.moves[s][1] for s in subset if nfa.moves[s] and b in nfa.moves[s][0]}
            target = nfa.closure(to | ({root} if anywhere else set()))
            if target not in number:
                number[target] = len(number)
                open_.append(target)
            row.append(number[target])
        table.append(row)
    accepted = [tuple(sorted(nfa.accepts[s] for s in subset if s in nfa.accepts)) for subset in open_]

    # States are alike until their rules or the classes they lead to differ.
    names: dict = {}
    kind = [names.setdefault(a, len(names)) for a in accepted]
    while True:
        names = {}
        finer = [names.setdefault((kind[s], *(kind[t] for t in row)), len(names)) for s, row in enumerate(table)]
        if len(names) == len(set(kind)):
            break
        kind = finer
    members = {k: s for s, k in reversed(list(enumerate(kind)))}
    ordered = sorted(members, key=lambda k: (bool(accepted[members[k]]), members[k]))
    place = {k: i for i, k in enumerate(ordered)}
    step = [[place[kind[table[members[k]][letters[b]]]] for b in range(256)] for k in ordered]
    first = sum(not accepted[members[k]] for k in ordered)
    dead = next((i for i, row in enumerate(step) if i < first and set(row) == {i}), -1)
    return Dfa(step, place[kind[0]], first, [accepted[members[k]] for k in ordered[first:]], dead)


class Scanner:
    """All rules as transition arrays.

    A rule's matches are leftmost, longest and do not overlap, as long as its match that
    ends first is the one that starts first; the rules here are of that kind.
    """

    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        nodes = [
            ("cat", [parse(r.any_case, True), parse(r.pattern)]) if r.any_case else parse(r.pattern) for r in rules
        ]
        self.all = compile_rules([first_ends(n) for n in nodes], anywhere=True)
        self.ahead = [compile_rules([n], anywhere=False) for n in nodes]
        self.back = [compile_rules([reversed_expression(n)], anywhere=False) for n in nodes]

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes, before lengths are looked at."""
        step, state, first, rules = self.all.step, self.all.start, self.all.first, self.all.rules
        done, found = [0] * len(self.rules), []
        for i, b in enumerate(data, 1):
            state = step[state][b]
            if state >= first:
                for r in rules[state - first]:
                    if i > done[r]:
                        begin = self._start(r, data, done[r], i)
                        if begin >= 0:
                            done[r] = self._end(r, data, begin)
                            found.append((r, begin, done[r]))
        return found

    def _start(self, r: int, data: bytes, low: int, end: int) -> int:
        dfa, begin = self.back[r], -1
        state = dfa.start
        for i in range(end - 1, low - 1, -1):
            state = dfa.step[state][data[i]]
            if state >= dfa.first:
                begin = i
            elif state == dfa.dead:
                break
        return begin

    def _end(self, r: int, data: bytes, begin: int) -> int:
        dfa, end = self.ahead[r], begin
        state = dfa.start
        for i in range(begin, len(data)):
            state = dfa.step[state][data[i]]
            if state >= dfa.first:
                end = i + 1
            elif state == dfa.dead:
                break
        return end

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of the matches that count, in code points, by start and then rule."""
        if not text:
            return []
        data, out = text.encode(), []
        for r, begin, end in self.matches(data):
            rule, match = self.rules[r], data[begin:end]
            if rule.by_value:
                at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
                value = match[at + 1 :].lstrip(b" ")
                match = value[1:] if value[:1] in (b'"', b"'") else value
            if len(match) >= rule.least:
                out.append((begin, r, end))
        out.sort()
        if len(data) != len(text):
            marks = sorted({x for b, _, e in out for x in (b, e)})
            chars, n = [], 0
            for x, y in zip([0, *marks], marks, strict=False):
                n += len(data[x:y].decode(errors="ignore"))
                chars.append(n)
            at = lambda x: chars[bisect_right(marks, x) - 1]
            out = [(at(b), r, at(e)) for b, r, e in out]
        return [(self.rules[r].kind, b, e) for b, r, e in out]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Add ``secrets``: array of (kind, start, end) found in whole texts, replacing a column of that name.

    Offsets are code points, end exclusive; spans come by start, then in the order of the rules; spans of
    different kinds may overlap. Null and empty texts have none. A map without a shuffle;
    repeated rows are treated alike and an empty table gives an empty table.
    """

    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))

    def start():
        scanner = shared.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        def step(texts):
            found = [[{"kind": k, "start": b, "end": e} for k, b, e in scanner.find(t)] for t in texts]
            return [pa.array(found, kind)]

        return step

    return map_columns(docs, ["text"], "secrets array<struct<kind: string, start: bigint, end: bigint>>", start)
