"""Rules to one deterministic automaton: parse, Thompson construction, subsets, minimisation.

The rule language is the regular part of the usual notation: literals, escapes, classes
with ranges and negation, groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``.
Everything works on bytes, so a rule's characters must be ASCII.
"""

from __future__ import annotations

from collections import deque

import numpy as np

ANY = frozenset(range(256))


class _Parser:
    """Recursive descent to a tree of ('set', bytes), ('cat', parts), ('alt', parts), ('rep', part, low, high)."""

    def __init__(self, rule: str) -> None:
        if not rule.isascii():
            raise ValueError(f"rule {rule!r} is not ASCII")
        self.rule, self.at = rule, 0

    def tree(self) -> tuple:
        node = self._alternatives()
        if self.at < len(self.rule):
            raise ValueError(f"unexpected {self.rule[self.at]!r} at {self.at} of {self.rule!r}")
        return node

    def _peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def _take(self) -> str:
        c = self._peek()
        if not c:
            raise ValueError(f"{self.rule!r} ends too early")
        self.at += 1
        return c

    def _alternatives(self) -> tuple:
        parts = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self) -> tuple:
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated())
        return ("cat", parts)

    def _repeated(self) -> tuple:
        node = self._single()
        while (c := self._peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                end = self.rule.index("}", self.at)
                low, comma, high = self.rule[self.at : end].partition(",")
                self.at = end + 1
                node = ("rep", node, int(low), (int(high) if high else None) if comma else int(low))
            else:
                node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[c])
        return node

    def _single(self) -> tuple:
        c = self._take()
        if c == "(":
            node = self._alternatives()
            if self._take() != ")":
                raise ValueError(f"group not closed in {self.rule!r}")
            return node
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", ANY - {10})
        return ("set", frozenset({self._escape() if c == "\\" else ord(c)}))

    def _escape(self) -> int:
        c = self._take()
        if c == "x":
            return int(self._take() + self._take(), 16)
        if c.isalnum():
            raise ValueError(f"escape \\{c} is not supported in {self.rule!r}")
        return ord(c)

    def _class(self) -> frozenset[int]:
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while (c := self._take()) != "]" or not found:
            low = high = self._escape() if c == "\\" else ord(c)
            if self._peek() == "-" and self.rule[self.at + 1 : self.at + 2] not in ("]", ""):
                self.at += 1
                c = self._take()
                high = self._escape() if c == "\\" else ord(c)
            found |= set(range(low, high + 1))
        return ANY - found if negated else frozenset(found)


def _reversed(node: tuple) -> tuple:
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    parts = [_reversed(p) for p in node[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Nfa:
    """States with free steps and at most one step over a set of bytes each."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def new(self) -> int:
        self.free.append([])
        self.step.append(None)
        return len(self.free) - 1

    def add(self, node: tuple, start: int) -> int:
        """Build ``node`` from ``start``; returns where it ends."""
        kind = node[0]
        if kind == "set":
            end = self.new()
            at = self.new()
            self.free[start].append(at)
            self.step[at] = (node[1], end)
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.new()
            for part in node[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, low, high = node
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop = self.new()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        end = self.new()
        self.free[start].append(end)
        for _ in range(high - low):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        # Only states that read a byte or end a rule tell sets apart.
        return frozenset(s for s in seen if self.step[s] or not self.free[s])


class Automaton:
    """The minimal deterministic automaton of one or more rules, as transition arrays.

    ``classes`` maps bytes to classes that no rule tells apart. ``table[state + class]`` is
    the next state; states are multiples of the number of classes, numbered so that those
    from ``accepting`` on end a match. ``rules[state // width]`` is the set of rules that end
    there, as bits. With ``anywhere`` a match may begin at any byte, not just the first.
    """

    def __init__(self, rules: list[str], *, backwards: bool = False, anywhere: bool = False) -> None:
        nfa = _Nfa()
        starts, ends = [], {}
        for k, rule in enumerate(rules):
            tree = _Parser(rule).tree()
            start = nfa.new()
            starts.append(start)
            # A state of its own: no step and no free step leads out of it.
            last, end = nfa.add(_reversed(tree) if backwards else tree, start), nfa.new()
            nfa.free[last].append(end)
            ends[end] = 1 << k
        members = np.array([[b in s[0] for b in range(256)] for s in nfa.step if s] or [[False] * 256])
        _, first, of_byte = np.unique(members, axis=1, return_index=True, return_inverse=True)
        sample = [int(b) for b in first]
        self.width = len(sample)
        self.classes = bytes(np.asarray(of_byte).ravel().astype(np.uint8))
        begin = nfa.closure(frozenset(starts))
        number, order, todo = {begin: 0}, [begin], deque([begin])
        steps: list[list[int]] = []
        while todo:
            states = todo.popleft()
            row = []
            for byte in sample:
                after = {nfa.step[s][1] for s in states if nfa.step[s] and byte in nfa.step[s][0]}
                target = nfa.closure(frozenset(after | set(starts) if anywhere else after))
                if target not in number:
                    number[target] = len(order)
                    order.append(target)
                    todo.append(target)
                row.append(number[target])
            steps.append(row)
        ended = np.array([sum(ends.get(s, 0) for s in states) for states in order], dtype=np.int64)
        self._minimise(np.array(steps, dtype=np.int64), ended)

    def _minimise(self, steps: np.ndarray, ended: np.ndarray) -> None:
        """Split states by the rules they end, then by the blocks they lead to, until nothing splits."""
        block, count = np.unique(ended, return_inverse=True)[1].ravel(), 0
        while block.max() + 1 > count:
            count = block.max() + 1
            block = np.unique(np.column_stack([block, block[steps]]), axis=0, return_inverse=True)[1].ravel()
        one = np.unique(block, return_index=True)[1]
        # Accepting blocks last.
        rank = np.empty(count, dtype=np.int64)
        rank[np.argsort(ended[one] != 0, kind="stable")] = np.arange(count)
        table = np.empty((count, self.width), dtype=np.int64)
        table[rank] = rank[block[steps[one]]]
        rules = np.zeros(count, dtype=np.int64)
        rules[rank] = ended[one]
        self.start = int(rank[block[0]]) * self.width
        self.table = (table * self.width).ravel().tolist()
        self.rules = rules.tolist()
        self.accepting = int(np.count_nonzero(rules == 0)) * self.width
        stuck = (table == np.arange(count)[:, None]).all(axis=1) & (rules == 0)
        self.dead = int(np.flatnonzero(stuck)[0]) * self.width if stuck.any() else -1

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that begins at ``at``; -1 if there is none."""
        table, state, accepting, dead, classes = self.table, self.start, self.accepting, self.dead, self.classes
        end = at if state >= accepting else -1
        while at < len(data):
            state = table[state + classes[data[at]]]
            at += 1
            if state >= accepting:
                end = at
            elif state == dead:
                break
        return end
