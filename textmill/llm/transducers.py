"""Weighted finite-state transducers over short alphabets: composition and path sums.

A machine reads one label an arc and writes one; an arc has a weight. Weights multiply along
a path and add up over paths. Labels are any hashable values.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

Label = Hashable
State = Hashable
#: An arc from a state: (label read, label written, weight, next state).
Arc = tuple[Label, Label, float, State]


@dataclass(frozen=True)
class Transducer:
    """Arcs by state, the state to begin in, and the states to end in."""

    arcs: dict[State, list[Arc]]
    begin: State
    ends: frozenset[State]


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` writes to ``second``; only states that can be reached."""
    begin = (first.begin, second.begin)
    arcs: dict[State, list[Arc]] = {}
    open_states = [begin]
    while open_states:
        state = open_states.pop()
        if state in arcs:
            continue
        arcs[state] = [
            (read, written, w * v, (to, on))
            for read, middle, w, to in first.arcs[state[0]]
            for heard, written, v, on in second.arcs[state[1]]
            if heard == middle
        ]
        open_states += [arc[3] for arc in arcs[state]]
    ends = frozenset(s for s in arcs if s[0] in first.ends and s[1] in second.ends)
    return Transducer(arcs, begin, ends)


def paths(machine: Transducer, labels: Sequence[Label]) -> Iterator[tuple[tuple[Label, ...], float]]:
    """Every path that reads ``labels`` to its end: what it writes, and its weight. For tests and short inputs."""

    def go(state: State, at: int, written: tuple[Label, ...], weight: float) -> Iterator[tuple[tuple[Label, ...], float]]:
        if at == len(labels):
            if state in machine.ends:
                yield written, weight
            return
        for read, out, w, to in machine.arcs[state]:
            if read == labels[at]:
                yield from go(to, at + 1, (*written, out), weight * w)

    yield from go(machine.begin, 0, (), 1.0)


class Reader:
    """A machine in matrices, to read long inputs in time that grows with their length."""

    def __init__(self, machine: Transducer) -> None:
        number = {s: k for k, s in enumerate(machine.arcs)}
        size = len(number)
        self.begin = np.zeros(size)
        self.begin[number[machine.begin]] = 1.0
        self.ends = np.array([float(s in machine.ends) for s in machine.arcs])
        self.steps: dict[Label, np.ndarray] = {}
        by_output: dict[Label, dict[Label, np.ndarray]] = {}
        for state, arcs in machine.arcs.items():
            for read, written, w, to in arcs:
                self.steps.setdefault(read, np.zeros((size, size)))[number[state], number[to]] += w
                by_output.setdefault(read, {}).setdefault(written, np.zeros((size, size)))[number[state], number[to]] += w
        self.outputs = {read: (list(m), np.stack(list(m.values()))) for read, m in by_output.items()}

    def total(self, labels: Sequence[Label]) -> float:
        """Sum of the weights of all paths that read ``labels``."""
        at = self.begin
        for label in labels:
            at = at @ self.steps[label]
        return float(at @ self.ends)

    def written(self, labels: Sequence[Label], places: Sequence[int]) -> list[dict[Label, float]]:
        """For each place: by label written there, the sum of the weights of all paths."""
        ahead = [self.begin]
        for label in labels:
            ahead.append(ahead[-1] @ self.steps[label])
        wanted, out, behind = set(places), {}, self.ends
        for k in range(len(labels) - 1, -1, -1):
            if k in wanted:
                names, arcs = self.outputs[labels[k]]
                sums = (arcs @ behind) @ ahead[k]
                out[k] = {n: float(s) for n, s in zip(names, sums) if s}
            behind = self.steps[labels[k]] @ behind
        return [out[k] for k in places]
