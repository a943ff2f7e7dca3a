"""Levenshtein automata over a lexicon trie."""

from __future__ import annotations

from collections.abc import Iterable

#: Beginnings of words whose states are remembered (memory only).
BEGINNINGS, BEGINNING = 50_000, 3


def edits_allowed(term: str) -> int:
    """None for terms under five characters, one up to eight, two beyond."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def parts(term: str) -> list[tuple[int, str]]:
    """The term in ``edits_allowed + 1`` pieces of about equal length, with their offsets:
    whatever the edits, one piece is left as it is, moved by at most their number."""
    n = edits_allowed(term) + 1
    cuts = [len(term) * i // n for i in range(n + 1)]
    return [(a, term[a:b]) for a, b in zip(cuts, cuts[1:])]


class TrieAutomaton:
    """Finds the term nearest to a word among those within their allowed edits.

    A state of the intersection is a set of (trie node, edits so far): reading a
    character follows the edge of that name, any other edge (substitution) or none
    (insertion) for one edit; edges may be skipped (deletion) for one edit each.
    The states behind the first characters, which are large, are remembered.  Words that hold
    no piece of a term at its place are turned away before (pigeonhole), which
    loses none.
    """

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget = [0]  # edits allowed to the most tolerant term below
        self.pieces: dict[int, dict[tuple[int, int], set[str]]] = {}  # by word length, then (offset, length)
        for term in terms:
            node, allowed = 0, edits_allowed(term)
            self.budget[0] = max(self.budget[0], allowed)
            for c in term:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(allowed)
                self.budget[nxt] = max(self.budget[nxt], allowed)
                node = nxt
            self.term[node] = term
            for at, piece in parts(term):
                for size in range(len(term) - allowed, len(term) + allowed + 1):
                    for offset in range(max(0, at - allowed), at + allowed + 1):
                        self.pieces.setdefault(size, {}).setdefault((offset, len(piece)), set()).add(piece)
        self.tests = {size: [(a, a + n, found) for (a, n), found in by_place.items()]
                      for size, by_place in self.pieces.items()}
        self.start = self._close({0: 0})
        self.beginnings: dict[str, dict[int, int]] = {}

    def _close(self, nodes: dict[int, int]) -> dict[int, int]:
        """The nodes and all that deletions reach."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            if nodes[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.budget[child] and nodes.get(child, 99) > edits + 1:
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        return nodes

    def _move(self, nodes: dict[int, int], c: str) -> dict[int, int]:
        out: dict[int, int] = {}
        for node, edits in nodes.items():
            child = self.children[node].get(c)
            if child is not None and out.get(child, 99) > edits and edits <= self.budget[child]:
                out[child] = edits
            if edits < self.budget[node]:
                if out.get(node, 99) > edits + 1:
                    out[node] = edits + 1
                for other in self.children[node].values():
                    if edits < self.budget[other] and out.get(other, 99) > edits + 1:
                        out[other] = edits + 1
        return self._close(out)

    def may_match(self, word: str) -> bool:
        return any(word[a:b] in found for a, b, found in self.tests.get(len(word), ()))

    def nearest(self, word: str) -> tuple[str, int] | None:
        """(term, edits): least edits, then the smallest term; None if no term is near."""
        if not self.may_match(word):
            return None
        begin = word[:BEGINNING]
        nodes = self.beginnings.get(begin)
        if nodes is None:
            nodes = self.start
            for c in begin:
                nodes = self._move(nodes, c)
            if len(self.beginnings) >= BEGINNINGS:
                self.beginnings.clear()
            self.beginnings[begin] = nodes
        for c in word[BEGINNING:]:
            if not nodes:
                return None
            nodes = self._move(nodes, c)
        ends = [(edits, self.term[node]) for node, edits in nodes.items()
                if self.term[node] is not None and edits <= edits_allowed(self.term[node])]
        best = min(ends, default=None)
        return (best[1], best[0]) if best else None
