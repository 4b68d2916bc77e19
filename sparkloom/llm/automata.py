"""Probabilistic automata inferred from labelled strings by merging prefix-tree states."""

from __future__ import annotations

import math
from collections.abc import Sequence

UNSEEN = math.log(1e-4)


class Automaton:
    """Deterministic stochastic automaton; strings are sequences of symbols."""

    def __init__(self, moves: list[dict[str, tuple[int, float]]], stops: list[float]):
        self.moves, self.stops = moves, stops

    def log_likelihood(self, symbols: Sequence[str]) -> float:
        state, total = 0, 0.0
        for s in symbols:
            state, p = self.moves[state].get(s, (state, UNSEEN))
            total += p
        return total + self.stops[state]


def infer(strings: Sequence[Sequence[str]], alpha: float = 0.05) -> Automaton:
    """Build the prefix tree of the strings and merge states that a Hoeffding bound cannot tell apart.

    A state is compatible with another when their frequencies of ending and of every symbol
    differ by less than the bound at confidence 1 - alpha, and so for all states that follow.
    """
    children: list[dict[str, int]] = [{}]
    seen, ended = [0], [0]
    for string in strings:
        at = 0
        seen[0] += 1
        for s in string:
            if s not in children[at]:
                children[at][s] = len(children)
                children.append({})
                seen.append(0)
                ended.append(0)
            at = children[at][s]
            seen[at] += 1
        ended[at] += 1
    passed = [{s: seen[c] for s, c in kids.items()} for kids in children]
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if differ(ended[x], seen[x], ended[y], seen[y]):
                return False
            for s in passed[x].keys() | passed[y].keys():
                if differ(passed[x].get(s, 0), seen[x], passed[y].get(s, 0), seen[y]):
                    return False
                if s in children[x] and s in children[y]:
                    todo.append((children[x][s], children[y][s]))
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            seen[x] += seen[y]
            ended[x] += ended[y]
            for s, n in passed[y].items():
                passed[x][s] = passed[x].get(s, 0) + n
                if s in children[x]:
                    todo.append((children[x][s], children[y][s]))
                else:
                    children[x][s] = children[y][s]

    kept = [0]
    edge = [(0, s) for s in sorted(children[0])]
    while edge:
        parent, s = edge.pop(0)
        state = children[parent][s]
        if state in kept:
            continue
        home = next((k for k in kept if compatible(k, state)), None)
        if home is None:
            kept.append(state)
            edge.extend((state, c) for c in sorted(children[state]))
        else:
            children[parent][s] = home
            fold(home, state)
            edge.extend((k, c) for k in kept for c in sorted(children[k]) if children[k][c] not in kept and (k, c) not in edge)
    number = {k: i for i, k in enumerate(kept)}
    moves, stops = [], []
    for k in kept:
        n = seen[k] + 1
        moves.append({s: (number[children[k][s]], math.log(f / n)) for s, f in passed[k].items()})
        stops.append(math.log((ended[k] + 0.5) / n))
    return Automaton(moves, stops)
