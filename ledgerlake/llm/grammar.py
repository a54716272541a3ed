"""Probabilistic automata learned from example strings by merging the states of their prefix tree (ALERGIA).

Characters are seen as classes, so that a credential's format counts and not its letters. Two states merge where Hoeffding's bound lets their
ends and steps, and those of all states below, have equal chances. The examples are a bounded sample; the learner works on the driver. A prior
over classes stands in where examples are few: it counts as PRIOR steps of every state, and alone past a step that no example takes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

# Character classes, each with its characters; what is in none is in the last, taken as one of 100 characters.
CLASSES = [
    ("digit", "0123456789"),
    ("low hex", "abcdef"),
    ("low", "ghijklmnopqrstuvwxyz"),
    ("high hex", "ABCDEF"),
    ("high", "GHIJKLMNOPQRSTUVWXYZ"),
    *((c, c) for c in "+/_.=-"),
]
OTHER = len(CLASSES)
END = OTHER + 1
_CLASS = {c: i for i, (_, chars) in enumerate(CLASSES) for c in chars}
_WITHIN = [math.log(len(chars)) for _, chars in CLASSES] + [math.log(100.0)]
PRIOR = 6.5  # steps that the prior counts as in every state
UNKNOWN = 1000  # the same in a state of ordinary text: what only a few runs show does not count as ordinary yet
LENGTH = 32  # the prior's mean length of a string


def classes(text: str) -> list[int]:
    return [_CLASS.get(c, OTHER) for c in text]


def prior(chars: str = "") -> list[float]:
    """Chance of each symbol where all of ``chars`` are equally likely (default: all classes are); others keep a hundredth between them."""
    sizes = [sum(c in members for c in chars) for _, members in CLASSES] + [0]
    even = (1 - 1 / LENGTH) / (OTHER + 1)
    if not any(sizes):
        return [even] * (OTHER + 1) + [1 / LENGTH]
    return [0.99 * (1 - 1 / LENGTH) * n / sum(sizes) + 0.01 * even for n in sizes] + [1 / LENGTH]


@dataclass
class Automaton:
    """steps: per state, symbol to (log chance, next state); rest: per state the log weight of the prior; prior: log chance of each symbol."""

    prior: list[float]
    steps: list[dict[int, tuple[float, int]]] = field(default_factory=list)
    rest: list[float] = field(default_factory=list)

    def likelihood(self, text: str) -> float:
        """Log chance of a string; past an unseen step the prior goes on alone."""
        state, total = 0, 0.0
        for symbol in [*classes(text), END]:
            if state < 0:
                total += self.prior[symbol]
            elif symbol in self.steps[state]:
                chance, state = self.steps[state][symbol]
                total += chance
            else:
                total, state = total + self.rest[state] + self.prior[symbol], -1
            if symbol != END:
                total -= _WITHIN[symbol]
        return total


def chain(counts: dict[tuple[int, int], int]) -> Automaton:
    """The automaton whose state is the symbol before (END: the beginning), from counts of (symbol before, symbol)."""
    even = prior()
    out = Automaton([math.log(p) for p in even])
    number = {symbol: i for i, symbol in enumerate([END, *range(OTHER + 1)])}
    for before in number:
        total = sum(counts.get((before, s), 0) for s in range(END + 1)) + UNKNOWN
        chances = [math.log((counts.get((before, s), 0) + UNKNOWN * even[s]) / total) for s in range(END + 1)]
        out.steps.append({s: (chances[s], number[s] if s != END else -1) for s in range(END + 1)})
        out.rest.append(math.log(UNKNOWN / total))
    return out


def learn(examples: list[str], confidence: float = 0.05, chars: str = "") -> Automaton:
    """Merge compatible states of the examples' prefix tree, breadth first; the prior is over ``chars``."""
    child: list[dict[int, int]] = [{}]
    count: list[dict[int, int]] = [{}]  # by symbol; END counts the strings that end here
    for text in examples:
        at = 0
        for symbol in classes(text):
            count[at][symbol] = count[at].get(symbol, 0) + 1
            if symbol not in child[at]:
                child[at][symbol] = len(child)
                child.append({})
                count.append({})
            at = child[at][symbol]
        count[at][END] = count[at].get(END, 0) + 1

    spread = math.sqrt(0.5 * math.log(2 / confidence))

    def alike(a: int, b: int) -> bool:
        waiting = [(a, b)]
        while waiting:
            x, y = waiting.pop()
            n, m = sum(count[x].values()), sum(count[y].values())
            if not n or not m:
                continue
            bound = spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if any(abs(count[x].get(s, 0) / n - count[y].get(s, 0) / m) > bound for s in {*count[x], *count[y]}):
                return False
            waiting += [(child[x][s], child[y][s]) for s in child[x] if s in child[y]]
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        waiting = [(a, b)]
        while waiting:
            x, y = waiting.pop()
            for s, n in count[y].items():
                count[x][s] = count[x].get(s, 0) + n
            for s, z in child[y].items():
                if s in child[x]:
                    waiting.append((child[x][s], z))
                else:
                    child[x][s] = z

    settled, edge = [0], [(0, s) for s in sorted(child[0])]
    while edge:
        parent, symbol = edge.pop(0)
        new = child[parent][symbol]
        same = next((r for r in settled if alike(r, new)), None)
        if same is None:
            settled.append(new)
            edge += [(new, s) for s in sorted(child[new])]
        else:
            child[parent][symbol] = same
            known = {(r, s) for r in settled for s in child[r]}
            fold(same, new)
            edge += [(r, s) for r in settled for s in sorted(child[r]) if (r, s) not in known]

    number = {state: i for i, state in enumerate(settled)}
    assumed = prior(chars)
    out = Automaton([math.log(p) for p in assumed])
    for state in settled:
        total = sum(count[state].values()) + PRIOR
        steps = {}
        for s, n in count[state].items():
            chance = math.log((n + PRIOR * assumed[s]) / total)
            steps[s] = (chance, number[child[state][s]] if s != END else -1)
        out.steps.append(steps)
        out.rest.append(math.log(PRIOR / total))
    return out
