"""Secret scan: all rules in one byte pass of one deterministic automaton.

``compile_rules`` turns the rules' regular expressions into a non-deterministic automaton over bytes, makes it
deterministic by subset construction and minimal by partition refinement, and gives plain transition arrays. One pass
over the bytes of a text tells where matches of which rule end. The start of a match is found by the reversed
automaton of that rule, its full length by the rule's own automaton from the start on; both
are made the same way. Matches of a rule are leftmost and do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, per_process


@dataclass(frozen=True)
class Rule:
    """``shortest`` bytes at least of a match must come behind what ``head`` matches at its beginning, or it is dropped.

    A match takes in as much of ``tail`` as follows it; the search for matches does not need it. All patterns
    become automata, so no text takes more time than its length.
    """

    kind: str
    pattern: str
    shortest: int = 1
    head: str = ""
    tail: str = ""

    @property
    def whole(self) -> str:
        return f"{self.pattern}(?:{self.tail})?" if self.tail else self.pattern


# Fixed values of the contract: the base rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16}[0-9a-f]*", 16),
)
_BLANK = r"(?:\s|\\[rn])"
_PEM_HEADER = r"(?:Proc-Type|DEK-Info):\x20?[A-Za-z0-9,-]+"
#: The rest of a key in PEM: all of it to the END line, or, where that is missing, the headers and the long lines.
_PEM_BODY = (
    rf"{_BLANK}*(?:{_PEM_HEADER}{_BLANK}+)*(?:[A-Za-z0-9+/=]|{_BLANK})*-----END ([A-Z]+ )*PRIVATE KEY-----"
    rf"|(?:{_BLANK}+(?:{_PEM_HEADER}|[A-Za-z0-9+/=]{{40,}}))+"
)
#: Well-known public forms of keys that the base rules miss.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 32),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", tail=_PEM_BODY),
)
RULES = BASE_RULES + MORE_RULES


# ---- regular expressions as trees: ("set", bytes) | ("seq", trees) | ("any", trees) | ("loop", tree, least, most or None)


def parse(pattern: str):
    """The tree of a pattern made of characters, escapes, classes, groups, ``|`` and ``? * + {n} {n,m}``."""
    at = 0

    def escape() -> frozenset[int]:
        nonlocal at
        if pattern[at] == "x":
            at += 3
            return frozenset([int(pattern[at - 2 : at], 16)])
        at += 1
        named = {"d": range(48, 58), "s": (32, 9, 10, 11, 12, 13), "n": (10,), "t": (9,), "r": (13,)}
        return frozenset(named.get(pattern[at - 1], pattern[at - 1].encode()))

    def one() -> frozenset[int]:
        nonlocal at
        at += 1
        return escape() if pattern[at - 1] == "\\" else frozenset(pattern[at - 1].encode())

    def bracket() -> frozenset[int]:
        nonlocal at
        negated = pattern[at] == "^"
        at += negated
        out: set[int] = set()
        while pattern[at] != "]":
            low = one()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                out.update(range(min(low), min(one()) + 1))
            else:
                out |= low
        at += 1
        return frozenset(range(256)) - out if negated else frozenset(out)

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 3 if pattern.startswith("(?:", at) else 1
            tree = branches()
            at += 1
            return tree
        if pattern[at] == "[":
            at += 1
            return "set", bracket()
        if pattern[at] == ".":
            at += 1
            return "set", frozenset(range(256)) - {10}
        return "set", one()

    def repeated():
        nonlocal at
        tree = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                stop = pattern.index("}", at)
                low, _, high = pattern[at + 1 : stop].partition(",")
                most = (int(high) if high else None) if "," in pattern[at:stop] else int(low)
                tree, at = ("loop", tree, int(low), most), stop + 1
            else:
                tree, at = ("loop", tree, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]), at + 1
        return tree

    def branches():
        nonlocal at
        found = [[]]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                found.append([])
                at += 1
            else:
                found[-1].append(repeated())
        return "any", [("seq", x) for x in found]

    return branches()


def mirrored(tree):
    kind = tree[0]
    if kind == "seq":
        return "seq", [mirrored(x) for x in reversed(tree[1])]
    if kind == "any":
        return "any", [mirrored(x) for x in tree[1]]
    return ("loop", mirrored(tree[1]), *tree[2:]) if kind == "loop" else tree


@dataclass
class Nfa:
    """``moves[state]``: (set of bytes, next state); ``free[state]``: states reached without a byte."""

    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree, begin: int) -> int:
        """Add ``tree`` behind state ``begin``; returns the state after it."""
        if tree[0] == "set":
            end = self.state()
            self.moves[begin].append((tree[1], end))
            return end
        if tree[0] == "seq":
            for part in tree[1]:
                begin = self.add(part, begin)
            return begin
        if tree[0] == "any":
            ends, end = [self.add(x, begin) for x in tree[1]], self.state()
            for x in ends:
                self.free[x].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            begin = self.add(part, begin)
        if most is None:
            hub = self.state()
            self.free[begin].append(hub)
            self.free[self.add(part, hub)].append(hub)
            return hub
        end = self.state()
        self.free[begin].append(end)
        for _ in range(most - least):
            begin = self.add(part, begin)
            self.free[begin].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return frozenset(found)


@dataclass
class Automaton:
    """Transition array: next state = ``table[state + byte]``; states are multiples of 256, accepting ones come last.

    ``accepts[state]`` are the numbers of the rules that end there, ``first`` is the first accepting
    state, ``dead`` the state that leads nowhere, or -1.
    """

    table: list[int]
    start: int
    first: int
    accepts: dict[int, tuple[int, ...]]
    dead: int


def compile_trees(trees: list, anywhere: bool) -> Automaton:
    """Subset construction and minimisation. ``anywhere``: a match may begin at any byte."""
    nfa = Nfa()
    begins = [nfa.state() for _ in trees]
    ends = {nfa.add(tree, b): rule for rule, (tree, b) in enumerate(zip(trees, begins, strict=True))}
    initial = nfa.closure(begins)
    # bytes that no set tells apart are one class
    signs: dict[tuple, list[int]] = {}
    sets = list({s for moves in nfa.moves for s, _ in moves})
    for byte in range(256):
        signs.setdefault(tuple(byte in s for s in sets), []).append(byte)
    classes = list(signs.values())
    number = {initial: 0}
    order, rows = [initial], []
    for states in order:
        row = []
        for members in classes:
            moved = {to for s in states for chars, to in nfa.moves[s] if members[0] in chars}
            target = nfa.closure(moved)
            if anywhere:
                target |= initial
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in states if s in ends)) for states in order]
    steps = np.array(rows)
    # minimisation: split blocks until all states of a block move to the same blocks
    block = np.unique([str(a) for a in accepts], return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[steps]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    sample = {b: i for i, b in reversed(list(enumerate(block.tolist())))}
    rank = {b: 256 * i for i, b in enumerate(sorted(sample, key=lambda b: bool(accepts[sample[b]])))}
    table = [0] * (256 * len(sample))
    for b, i in sample.items():
        for members, to in zip(classes, steps[i], strict=True):
            for byte in members:
                table[rank[b] + byte] = rank[int(block[to])]
    final = {rank[b]: accepts[i] for b, i in sample.items() if accepts[i]}
    dead = [s for s in rank.values() if s not in final and all(t == s for t in table[s : s + 256])]
    return Automaton(table, rank[int(block[0])], min(final, default=len(table)), final, dead[0] if dead else -1)


@dataclass
class Scanner:
    """The combined automaton of all rules, and for each rule the two that find the bounds of a match."""

    rules: tuple[Rule, ...]
    search: Automaton
    forward: list[Automaton]
    backward: list[Automaton]
    heads: list[Automaton | None]

    def ends(self, data: bytes) -> dict[int, list[int]]:
        """The one pass: for each rule the places where a match ends."""
        found: dict[int, list[int]] = {}
        state, table, first, accepts = self.search.start, self.search.table, self.search.first, self.search.accepts
        for at, byte in enumerate(data, 1):
            state = table[state + byte]
            if state >= first:
                for rule in accepts[state]:
                    found.setdefault(rule, []).append(at)
        return found

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, by start and rule, without matches that are too short."""
        out = []
        for rule, ends in self.ends(data).items():
            last = 0  # end of the match before, dropped or not
            for end in ends:
                if end <= last:
                    continue
                start = leftmost(self.backward[rule], data, end, last)
                if start is None:
                    continue
                last = longest(self.forward[rule], data, start)
                head = self.heads[rule]
                secret = last - (longest(head, data, start) if head else start)
                if secret >= self.rules[rule].shortest:
                    out.append((start, last, rule))
        return sorted(out)


def leftmost(backward: Automaton, data: bytes, end: int, least: int) -> int | None:
    state, found = backward.start, None
    for at in range(end - 1, least - 1, -1):
        state = backward.table[state + data[at]]
        if state == backward.dead:
            break
        if state >= backward.first:
            found = at
    return found


def longest(forward: Automaton, data: bytes, start: int) -> int:
    state, found = forward.start, start
    for at in range(start, len(data)):
        state = forward.table[state + data[at]]
        if state == forward.dead:
            break
        if state >= forward.first:
            found = at + 1
    return found


def compile_rules(rules: tuple[Rule, ...]) -> Scanner:
    """Of two overlapping matches of a rule, the one that begins first must be the first that can end (all rules here)."""
    trees = [parse(r.pattern) for r in rules]
    return Scanner(
        rules,
        compile_trees(trees, anywhere=True),
        [compile_trees([parse(r.whole)], anywhere=False) for r in rules],
        [compile_trees([mirrored(t)], anywhere=False) for t in trees],
        [compile_trees([parse(r.head)], anywhere=False) if r.head else None for r in rules],
    )


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return per_process(("scanner", rules), lambda: compile_rules(rules))


def find_spans(scan: Scanner, text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    data = text.encode()
    found = scan.scan(data)
    if not found or len(data) == len(text):
        return [(scan.rules[r].kind, s, e) for s, e, r in found]
    places, before, at = {}, 0, 0
    for place in sorted({p for s, e, _ in found for p in (s, e)}):  # code points between places, each read once
        before += len(data[at:place].decode())
        at = place
        places[place] = before
    return [(scan.rules[r].kind, places[s], places[e]) for s, e, r in found]


def find_secrets(
    df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The id and ``spans`` of every row: array of (kind, start, end), by start, then kind as listed.

    Null and empty texts have no spans. Rows are scanned one by one: repeated and null ids stay, other columns
    are ignored.
    """
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
    schema = T.StructType(
        [T.StructField(id_column, df.schema[id_column].dataType), T.StructField("spans", T.ArrayType(span))]
    )

    def start():
        scan = scanner(rules)

        def call(key, text):
            yield key, [dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(scan, text or "")]

        return call

    return map_rows(df.select(id_column, text_column), schema, start)


def redact_secrets(
    df: DataFrame, *, text_column: str = "text", mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The same rows and columns, with every found secret of the text replaced by ``mark``.

    Overlapping spans are replaced as one. Null and empty texts stay as they are.
    """
    names = df.columns
    place = names.index(text_column)

    def start():
        scan = scanner(rules)

        def call(*row):
            text = row[place]
            spans = find_spans(scan, text) if text else []
            if spans:
                parts, at = [], 0
                for _, begin, end in spans:
                    if begin >= at:
                        parts += [text[at:begin], mark]
                    at = max(at, end)
                text = "".join([*parts, text[at:]])
            yield (*row[:place], text, *row[place + 1 :])

        return call

    return map_rows(df, df.schema, start)


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined in their order."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


__all__ = ["BASE_RULES", "MORE_RULES", "RULES", "Rule", "compile_rules", "digest", "find_secrets", "redact_secrets"]
