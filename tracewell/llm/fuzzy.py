"""Words near a lexicon: Levenshtein automata run over the lexicon's trie, as one lazily built automaton.

A state is the set of trie nodes reachable with the letters read so far, each with the fewest edits. Moves are
kept once made, so most words cost a few dictionary steps: unlike words run out of nodes after two or three letters.
"""

from __future__ import annotations

MOST_MOVES = 400_000


def allowed_edits(length: int, stem: bool) -> int:
    """Short terms have no near misses that mean them; stems are open at the end, so they get less."""
    if stem:
        return 1 if length >= 6 else 0
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """``terms``: (text, stem); a stem stands for all words that begin with it."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]
        for number, (text, stem) in enumerate(terms):
            edits, node = allowed_edits(len(text), stem), 0
            self.most[0] = max(self.most[0], edits)
            for letter in text:
                if letter not in self.child[node]:
                    self.child[node][letter] = len(self.child)
                    self.child.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.child[node][letter]
                self.most[node] = max(self.most[node], edits)
            self.ends[node].append(number)
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.nodes: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.at_end: list[tuple | None] = []
        self.on_way: list[tuple | None] = []
        self.made = 0
        self._number(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> frozenset:
        """With the nodes reached by leaving out letters of a term."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            for child in self.child[node].values():
                if edits + 1 <= self.most[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        return frozenset((n, e) for n, e in nodes.items() if e <= self.most[n])

    def _best(self, nodes: frozenset, stems: bool) -> tuple | None:
        """(edits, -length, term) of the closest term ending here."""
        found = [(edits, -len(self.terms[t][0]), t) for node, edits in nodes for t in self.ends[node]
                 if (self.terms[t][1] if stems else True) and edits <= allowed_edits(len(self.terms[t][0]), self.terms[t][1])]
        return min(found) if found else None

    def _number(self, nodes: frozenset) -> int:
        if nodes not in self.states:
            self.states[nodes] = len(self.nodes)
            self.nodes.append(nodes)
            self.moves.append({})
            self.at_end.append(self._best(nodes, False))
            self.on_way.append(self._best(nodes, True))
        return self.states[nodes]

    def _move(self, state: int, letter: str) -> int:
        following: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < following.get(node, 99):
                following[node] = edits
        for node, edits in self.nodes[state]:
            reach(node, edits + 1)
            for other, child in self.child[node].items():
                reach(child, edits if other == letter else edits + 1)
        self.moves[state][letter] = target = self._number(self._closed(following))
        self.made += 1
        return target

    def closest(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the closest term, or None."""
        if self.made > MOST_MOVES:
            self._reset()
        state, best = 0, None
        for letter in word:
            following = self.moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if not self.nodes[state]:
                break
            here = self.on_way[state]
            if here is not None and (best is None or here < best):
                best = here
        else:
            here = self.at_end[state]
            if here is not None and (best is None or here < best):
                best = here
        return (best[2], best[0]) if best is not None else None
