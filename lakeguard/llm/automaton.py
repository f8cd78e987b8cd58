"""Rule regexes compiled together into one minimal deterministic automaton over bytes.

Each regex becomes a small non-deterministic automaton; subset construction
over all of them and partition refinement give transition arrays indexed by
(state, byte class).  Supported syntax: literals, ``.``, classes, groups,
``(?:...)``, ``(?i:...)`` (ASCII letters in either case), ``|``, the escapes of
punctuation, ``\\n \\t \\r \\f \\v \\xHH`` and (ASCII only) ``\\d \\w \\s``, and the
quantifiers ``* + ? {m} {m,} {m,n}``.  Anything else, such as anchors, lazy or
possessive quantifiers, look-arounds and back-references, raises ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_DIGITS = frozenset(range(48, 58))
_NAMED = {"d": _DIGITS, "s": frozenset(b" \t\n\r\f\v"),
          "w": _DIGITS | frozenset(range(65, 91)) | frozenset(range(97, 123)) | {95}}
RESET = 0xFF  # never part of UTF-8: stands between texts and leads back to the start state


class Regex:
    """Recursive-descent reader of one pattern into a tree of tuples."""

    def __init__(self, pattern: str):
        self.src, self.at, self.fold = pattern, 0, False
        self.tree = self.alternatives()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} at {self.at}")

    def peek(self) -> str:
        return self.src[self.at] if self.at < len(self.src) else ""

    def take(self) -> str:
        if self.at >= len(self.src):
            raise ValueError(f"{self.src!r} ends too early")
        self.at += 1
        return self.src[self.at - 1]

    def refuse(self, what: str):
        raise ValueError(f"{what} at {self.at} of {self.src!r}")

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated(self.atom()))
        return ("seq", items)

    def repeated(self, item):
        if (c := self.peek()) and c in "*+?{":
            self.take()
            low, high = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(c) or self.bounds()
            if high is not None and high < low:
                self.refuse("bounds that shrink")
            item = ("rep", item, low, high)
            if self.peek() and self.peek() in "*+?{":
                self.refuse("a quantifier behind a quantifier")
        return item

    def bounds(self):
        end = self.src.find("}", self.at)
        low, comma, high = self.src[self.at:end].partition(",")
        if end < 0 or not low.isdigit() or not (high.isdigit() or not high):
            self.refuse("bounds that cannot be read")
        self.at = end + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def atom(self):
        c = self.take()
        if c == "(":
            fold = self.fold
            for mark in ("?:", "?i:"):
                if self.src.startswith(mark, self.at):
                    self.at += len(mark)
                    self.fold = self.fold or "i" in mark
            if self.peek() == "?":
                self.refuse("a group of an unknown kind")
            tree = self.alternatives()
            if self.take() != ")":
                self.refuse("an open group")
            self.fold = fold
            return tree
        if c in "^$*+?{":
            self.refuse(f"an unescaped {c}")
        if c == "[":
            return ("set", self.folded(self.char_class()))
        if c == ".":
            return ("set", frozenset(range(RESET)) - {10})
        if c == "\\" and self.peek() in _NAMED and self.peek():
            return ("set", _NAMED[self.take()])
        char = self.escape() if c == "\\" else c
        if ord(char) < 128:
            return ("set", self.folded({ord(char)}))
        return ("seq", [("set", frozenset([b])) for b in char.encode("utf-8")])

    def escape(self) -> str:
        c = self.take()
        if c == "x":
            return chr(int(self.take() + self.take(), 16))
        if c.isalnum() and c not in "ntrfv":
            self.refuse(f"the escape \\{c}")
        return {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}.get(c, c)

    def char_class(self) -> set[int]:
        negate = self.peek() == "^"
        self.at += negate
        found: set[int] = set()
        while (c := self.take()) != "]":
            if c == "\\" and self.peek() in _NAMED and self.peek():
                found |= _NAMED[self.take()]
                continue
            low = ord(self.escape() if c == "\\" else c)
            high = low
            if self.peek() == "-" and self.src[self.at + 1:self.at + 2] != "]":
                self.take()
                c = self.take()
                high = ord(self.escape() if c == "\\" else c)
            if high > 127:
                raise ValueError("classes hold ASCII only")
            found.update(range(low, high + 1))
        return set(range(RESET)) - found if negate else found

    def folded(self, chars) -> frozenset[int]:
        if not self.fold:
            return frozenset(chars)
        return frozenset(ord(f(chr(b))) for b in chars for f in (str.lower, str.upper) if b < 128) | frozenset(chars)


def reverse(tree):
    kind = tree[0]
    if kind == "seq":
        return ("seq", [reverse(x) for x in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [reverse(x) for x in tree[1]])
    if kind == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    return tree


@dataclass
class Nfa:
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def build(self, tree, start: int) -> int:
        """Add ``tree`` behind ``start``; returns the state that its end leads to."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "seq":
            for item in tree[1]:
                start = self.build(item, start)
            return start
        if kind == "alt":
            end = self.state()
            for option in tree[1]:
                head = self.state()
                self.empty[start].append(head)
                self.empty[self.build(option, head)].append(end)
            return end
        _, item, low, high = tree
        for _ in range(low):
            start = self.build(item, start)
        if high is None:
            head = self.state()
            end = self.state()
            self.empty[start].append(head)
            self.empty[head].append(end)
            self.empty[self.build(item, head)].append(head)
            return end
        end = self.state()
        for _ in range(high - low):
            self.empty[start].append(end)
            start = self.build(item, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        stack, seen = list(states), set(states)
        while stack:
            for to in self.empty[stack.pop()]:
                if to not in seen:
                    seen.add(to)
                    stack.append(to)
        return frozenset(seen)


@dataclass
class Dfa:
    """``next[state * n_classes + classes[byte]]``; ``accepts[state]`` is a bit mask of rules; 0 is the start."""

    classes: np.ndarray
    n_classes: int
    next: np.ndarray
    accepts: np.ndarray


def byte_classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no transition tells apart share a class; one sample byte per class."""
    sets = sorted({s for out in nfa.moves for s, _ in out}, key=sorted)
    signature: dict[tuple, int] = {}
    classes, samples = np.zeros(256, np.uint8), []
    for byte in range(256):
        key = (byte == RESET, *(byte in s for s in sets))
        if key not in signature:
            signature[key] = len(samples)
            samples.append(byte)
        classes[byte] = signature[key]
    return classes, samples


def compile_rules(trees: list, anywhere: bool) -> Dfa:
    """Subset construction over all rules, then minimisation.

    ``anywhere``: a match may begin at every byte, else only at the first.
    """
    nfa = Nfa()
    root = nfa.state()
    ends = {}
    for rule, tree in enumerate(trees):
        head = nfa.state()
        nfa.empty[root].append(head)
        ends[nfa.build(tree, head)] = 1 << rule
    classes, samples = byte_classes(nfa)
    first = nfa.closure([root])
    number, order, rows = {first: 0}, [first], []
    dead = frozenset()
    for subset in order:
        row = []
        for byte in samples:
            if byte == RESET:
                to = first
            else:
                hit = [t for s in subset for chars, t in nfa.moves[s] if byte in chars]
                to = nfa.closure(hit) if hit else dead
                if anywhere:
                    to = to | first
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    accepts = np.array([sum({ends[s] for s in subset if s in ends}) for subset in order], np.int64)
    return minimise(classes, np.array(rows, np.int64), accepts)


def minimise(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Dfa:
    """Partition refinement: states stay together while they accept alike and lead to the same blocks."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number the blocks from the start state's on.
    rename = np.full(block.max() + 1, -1)
    _, firsts = np.unique(block, return_index=True)
    order = [int(block[0])] + [b for b in range(len(firsts)) if b != block[0]]
    rename[order] = np.arange(len(order))
    reps = firsts[order]
    small = rename[block[table[reps]]]
    return Dfa(classes, table.shape[1], small.astype(np.int32).ravel(), accepts[reps])


LANES = 2048


def run(dfa: Dfa, data: np.ndarray) -> np.ndarray:
    """State after every byte, in one pass.

    The bytes are cut into lanes that advance together, each begun in the start
    state; a lane whose predecessor ended in another state is run again from
    there until it meets the states already found.
    """
    n, k = len(data), dfa.n_classes
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    padded = np.full(lanes * steps, RESET, np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(dfa.classes[padded].reshape(lanes, steps).T).astype(np.int32)
    states = np.empty((steps, lanes), np.int32)
    current = np.zeros(lanes, np.int32)
    for t in range(steps):
        current = dfa.next.take(current * k + columns[t])
        states[t] = current
    begun = np.zeros(lanes, np.int32)
    while len(wrong := np.flatnonzero(states[-1, :-1] != begun[1:]) + 1):
        current = states[-1, wrong - 1]
        begun[wrong] = current
        active = wrong
        for t in range(steps):
            current = dfa.next.take(current * k + columns[t, active])
            differs = current != states[t, active]
            if not differs.any():
                break
            states[t, active] = current
            active, current = active[differs], current[differs]
    return states.T.reshape(-1)[:n]
