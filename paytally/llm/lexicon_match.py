"""Levenshtein automata intersected with a trie of lexicon terms.

The intersection is an automaton over pairs (trie node, errors so far). It is made
deterministic as words are read: a state is a set of such pairs, and each transition is
worked out once. Most words end in the dead state after a few letters.
"""

from __future__ import annotations

from dataclasses import dataclass

# States and transitions are forgotten beyond this many.
MOST_STATES = 50_000


@dataclass(frozen=True)
class Term:
    """A lexicon entry; a stem matches words that begin with it. What a hit says is its
    ``evidence``, in log odds."""

    text: str
    is_stem: bool
    evidence: float = 1.0


@dataclass(frozen=True)
class Match:
    term: int
    errors: int


def allowed_errors(term: Term, wide: bool = False) -> int:
    """One edit from six letters on, two from nine on; stems have to be spelled right.

    If ``wide``, one edit from four letters on, and for stems as for whole terms.
    """
    if wide:
        return (len(term.text) >= 4) + (len(term.text) >= 9)
    return 0 if term.is_stem else (len(term.text) >= 6) + (len(term.text) >= 9)


class Lexicon:
    """Terms in a trie; ``match`` runs a word through the automaton.

    If ``wide``, more is allowed (see ``allowed_errors``), and a swap of two adjacent
    letters is one edit. A state then also holds swaps of which the first letter is
    read: pairs (node after both, letter to come).
    """

    def __init__(self, terms: list[Term], wide: bool = False) -> None:
        self.terms, self.wide = terms, wide
        self.allowed = [allowed_errors(t, wide) for t in terms]
        # Nodes of the trie: children, term that ends there, most errors of any below.
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.most: list[int] = [0]
        for index, term in enumerate(terms):
            node, most = 0, self.allowed[index]
            self.most[0] = max(self.most[0], most)
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], most)
            self.ends[node] = index
        self._forget()

    def _forget(self) -> None:
        self.states: list[dict] = []
        self.numbers: dict[frozenset, int] = {}
        self.results: list[Match | None] = []
        self.settled: list[bool] = []
        self.moves: list[dict[str, int]] = []
        self.first = self._number(self._closed({0: 0}))

    def _closed(self, state: dict) -> dict:
        """With letters of terms left out: a node leads to its children for one error."""
        todo = [node for node in state if not isinstance(node, tuple)]
        while todo:
            node = todo.pop()
            errors = state[node] + 1
            for child in self.children[node].values():
                if errors <= self.most[child] and errors < state.get(child, errors + 1):
                    state[child] = errors
                    todo.append(child)
        return state

    def _number(self, state: dict) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            best, open_ways = None, False
            for node, errors in state.items():
                term = None if isinstance(node, tuple) else self.ends[node]
                if term is None or errors > self.allowed[term]:
                    open_ways = True
                    continue
                stem = self.terms[term].is_stem
                open_ways = open_ways or not stem or bool(self.children[node])
                # A stem that is spelled right goes before all.
                found = (errors, not stem, term)
                best = found if best is None else min(best, found)
            self.results.append(best and Match(best[2], best[0]))
            spelled_right = best is not None and best[:2] == (0, False)
            self.settled.append(spelled_right or (best is not None and not open_ways))
        return self.numbers[key]

    def _step(self, number: int, letter: str) -> int:
        after: dict = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.most[node] and errors < after.get(node, errors + 1):
                after[node] = errors

        for node, errors in self.states[number].items():
            if isinstance(node, tuple):
                if node[1] == letter:
                    reach(node[0], errors)
                continue
            term = self.ends[node]
            # After a stem any letters may follow.
            over = term is not None and self.terms[term].is_stem and errors <= self.allowed[term]
            reach(node, errors + (not over))  # a letter too many
            for own, child in self.children[node].items():
                reach(child, errors + (own != letter))
                second = self.children[child].get(letter) if self.wide and own != letter else None
                if second is not None and errors < self.most[second]:
                    swap = (second, own)
                    after[swap] = min(errors + 1, after.get(swap, errors + 1))
        moved = self._number(self._closed(after))
        self.moves[number][letter] = moved
        return moved

    def match(self, word: str) -> Match | None:
        """The term with the fewest errors, if one is near enough; ties to the first."""
        if len(self.states) > MOST_STATES:
            self._forget()
        number, moves, settled = self.first, self.moves, self.settled
        for letter in word:
            after = moves[number].get(letter)
            if after is None:
                after = self._step(number, letter)
            number = after
            if settled[number]:
                break
            if not self.states[number]:
                return None
        return self.results[number]
