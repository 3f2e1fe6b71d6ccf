"""Weighted finite-state transducers over token classes, and their composition."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

# Token classes, one letter each.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "O", "I", "T", "Y", "N", "R", "E"
CLASSES = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END)
# What the composed grammar emits for a match; pairs of (what is said, how it is said).
EVENTS = ("insult", "targeted insult", "threat", "negated insult", "reported insult", "negated threat", "reported threat")
# How much a match counts before labels are seen, as a change of the log-odds.
PRIOR_WEIGHTS = (8.0, 9.0, 8.0, 3.0, 3.0, 2.0, 2.5)


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: ``arcs[state, symbol]`` gives the next state and the symbol written.

    A symbol without an arc is copied, and leads to ``arcs[state, None]`` or else stays in the state.
    """

    start: int
    arcs: dict[tuple[int, str | None], tuple[int, str | None]]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        after, written = self.arcs.get((state, symbol)) or self.arcs.get((state, None)) or (state, None)
        return after, written or symbol


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that passes what ``first`` writes to ``second``, over the states that can be reached."""
    number = {(first.start, second.start): 0}
    arcs, todo = {}, [(first.start, second.start)]
    symbols = {symbol for _, symbol in first.arcs if symbol} | set(CLASSES)
    while todo:
        a, b = pair = todo.pop()
        for symbol in symbols:
            a_next, between = first.step(a, symbol)
            b_next, written = second.step(b, between)
            after = (a_next, b_next)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            arcs[number[pair], symbol] = (number[after], written)
    return Transducer(0, arcs)


def _window(opens: str, length: int, marks: dict[str, str]) -> Transducer:
    """Rewrites ``marks`` for ``length`` tokens after ``opens``, up to the end of the clause."""
    arcs: dict[tuple[int, str | None], tuple[int, str | None]] = {(0, opens): (length, None)}
    for left in range(1, length + 1):
        arcs[left, None] = (left - 1, None)
        arcs[left, opens] = (length, None)
        arcs[left, END] = (0, None)
        for symbol, written in marks.items():
            arcs[left, symbol] = (left - 1, written)
    return Transducer(0, arcs)


def _whole_clause(opens: str, marks: dict[str, str]) -> Transducer:
    """Rewrites ``marks`` from ``opens`` to the end of the clause."""
    arcs = {(0, opens): (1, None), (1, END): (0, None)} | {(1, symbol): (1, written) for symbol, written in marks.items()}
    return Transducer(0, arcs)


def grammar() -> Transducer:
    """Threats need a target soon after; insults count more after a target; negation comes right before.

    Written symbols: I insult, V insult of a target, X threat; i and x negated; J and Z reported.
    """
    # A threat is written at its target; marks of the threat itself travel through the window.
    arcs: dict[tuple[int, str | None], tuple[int, str | None]] = {}
    for base, opens, written in ((0, "T", "X"), (3, "t", "x"), (6, "S", "Z")):
        for left in range(1, 4):
            state = base + left
            arcs[state, None] = (state - 1 if left > 1 else 0, None)
            arcs[state, END] = (0, None)
            arcs[state, TARGET] = (0, written)
        for state in range(10):
            arcs[state, opens] = (base + 3, OTHER)
    return reduce(
        compose,
        (
            _window(NEGATION, 2, {"I": "i", "T": "t"}),
            _whole_clause(REPORT, {"I": "J", "T": "S"}),
            Transducer(0, arcs),
            _window(TARGET, 4, {"I": "V"}),
        ),
    )


WRITTEN = {"I": 0, "V": 1, "X": 2, "i": 3, "J": 4, "x": 5, "Z": 6}


def matches(machine: Transducer, symbols: list[str]) -> list[tuple[int, int]]:
    """(place of the token, event) for each match in a sequence of token classes."""
    state, found = machine.start, []
    arcs = machine.arcs
    for place, symbol in enumerate(symbols):
        state, written = arcs[state, symbol]
        if written in WRITTEN:
            found.append((place, WRITTEN[written]))
    return found
