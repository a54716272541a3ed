"""Secrets: fixed patterns give labelled credentials, automata learned from them score every other candidate by its format.

1. One pass over the whole texts finds the base spans (assignments, access keys, hex strings) and all candidates: maximal runs of
   ``MIN_LENGTH`` or more (as many as an assigned credential has) of the characters credentials are made of, that no base span contains.
   Each task gives its ``max_examples`` distinct base values of a kind with the smallest hashes, and counts how often a class of characters
   follows another in candidates that touch no base span. The counts are of all text and of a fixed size, however much text there is.
2. From the ``max_examples`` values of a kind with the smallest hashes (those of up to LONGEST characters) an automaton of that kind is learned (see
   ``grammar``); the counts are the automaton of ordinary text. Where examples are few, a prior over the kind's characters makes up for them.
3. A second pass scores every candidate: the best kind's log-likelihood less that of ordinary text, per character. It becomes a span of
   kind ``format`` where it reaches MARGIN and is at most DEVIATIONS below what the kind's own examples reach when left out of learning, the
   spread being that of strings as long as the candidate. A candidate that reaches beyond a base span, a long key around 24 hex digits for instance, is scored as a whole.

Base spans stay in any case. Offsets are code points, end exclusive. Null texts count as empty; an empty text has no span. A kind
without a single example is not learned. Repeated rows get a row each; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import discard, stored, text_of
from ledgerlake.llm.grammar import CLASSES, END, Automaton, chain, classes, learn

KINDS = ("assign", "access", "hex")
MIN_LENGTH = 6
MAX_EXAMPLES = 1000
LONGEST = 1024  # characters of an example that an automaton is learned from
MARGIN = 0.5  # natural log units per character
DEVIATIONS = 3.0
FOLDS = 5  # parts of the examples that are left out of learning in turn
REMEMBERED = 1 << 16  # forms of up to SHORT characters whose score a task keeps
SHORT = 128

_RUN = "A-Za-z0-9+/_.=-"
# The characters that values of each kind are made of.
_CHARS = {"assign": "".join(chars for _, chars in CLASSES), "access": CLASSES[0][1] + CLASSES[3][1] + CLASSES[4][1], "hex": CLASSES[0][1] + CLASSES[1][1]}


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(["password", "passwd", "secret", "token"])
_ASSIGN = re.compile(
    rf"""(?:{"|".join(map(_either_case, _NAMES.split("|")))}|{_either_case("api")}_?{_either_case("key")})["']?\x20*[:=]\x20*["']?([{_RUN}]+)"""
)
# A shorter match of these two is dropped, and none is hidden behind it, so the length may stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(rf"[{_RUN}]{{{MIN_LENGTH},}}")

# A score depends on the classes of the characters alone, so the first character of each class stands for all.
_FORM = str.maketrans({c: chars[0] for _, chars in CLASSES for c in chars})


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of kind, end, value) in that order."""
    found = [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= MIN_LENGTH]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str, bool]]:
    """Runs that could be credentials and that no base span contains: start, end, run, and whether it touches none."""
    out, spans, k = [], sorted((s, e) for s, _, e, _ in taken), 0
    # Of the spans that begin up to the run's start, and inside the run: the furthest end.
    before = inside = 0
    for m in _CANDIDATE.finditer(text):
        before = max(before, inside)
        while k < len(spans) and spans[k][0] <= m.start():
            before, k = max(before, spans[k][1]), k + 1
        while k < len(spans) and spans[k][0] < m.end():
            inside, k = max(inside, spans[k][1]), k + 1
        if before < m.end():
            out.append((m.start(), m.end(), m[0], before <= m.start() and inside <= m.start()))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])


_FOUND = pa.schema([("kind", pa.string()), ("value", pa.string()), ("hash", pa.int64()), ("before", pa.int32()), ("symbol", pa.int32()), ("n", pa.int64())])


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode()) >> 1


def _gathered(max_examples: int):
    """Per task: its smallest-hashed base values of each kind, and counts of (class before, class) over ordinary candidates (kind null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {kind: {} for kind in KINDS}
        steps: Counter[tuple[int, int]] = Counter()
        forms: Counter[str] = Counter()

        def count() -> None:
            for form, n in forms.items():
                symbols = [END, *classes(form), END]
                for step, times in Counter(zip(symbols, symbols[1:])).items():
                    steps[step] += n * times
            forms.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = base_spans(text)
                for _, k, _, value in found:
                    if len(value) <= LONGEST:
                        kept[KINDS[k]][value] = _hash(value)
                forms.update(run.translate(_FORM) for _, _, run, ordinary in candidates(text, found) if ordinary)
                if len(forms) > REMEMBERED // 16:
                    count()
            for kind, values in kept.items():
                if len(values) > 2 * max_examples:
                    kept[kind] = dict(heapq.nsmallest(max_examples, values.items(), key=lambda x: (x[1], x[0])))
        count()
        rows = [
            {"kind": kind, "value": v, "hash": h}
            for kind, values in kept.items()
            for v, h in heapq.nsmallest(max_examples, values.items(), key=lambda x: (x[1], x[0]))
        ]
        rows += [{"before": a, "symbol": b, "n": n} for (a, b), n in steps.items()]
        yield pa.RecordBatch.from_pylist(rows, _FOUND)

    return run


@dataclass
class Grammar:
    """An automaton per learned kind with mean and spread (of one character) of its values' scores, and one of ordinary text."""

    kinds: dict[str, tuple[Automaton, float, float]]
    ordinary: Automaton

    def against(self, automaton: Automaton, value: str) -> float:
        """Log-likelihood of a format less that of ordinary text, per character."""
        return (automaton.likelihood(value) - self.ordinary.likelihood(value)) / (len(value) + 1)

    def accepts(self, value: str) -> float | None:
        """The best score among kinds that accept the value, if any does."""
        scores = [
            score
            for automaton, mean, spread in self.kinds.values()
            if (score := self.against(automaton, value)) >= max(MARGIN, mean - DEVIATIONS * spread / math.sqrt(len(value) + 1))
        ]
        return max(scores, default=None)

    def add(self, kind: str, values: list[str]) -> None:
        """Learn a kind from its values; what such values score comes from parts left out of learning in turn."""
        scores = []
        for fold in range(FOLDS):
            rest = learn([v for i, v in enumerate(values) if i % FOLDS != fold], chars=_CHARS[kind])
            scores += [(self.against(rest, v), len(v) + 1) for v in values[fold::FOLDS]]
        mean = sum(s for s, _ in scores) / len(scores)
        # A few values say little about their spread: one unit per character counts as FOLDS of them.
        spread = math.sqrt((FOLDS + sum((s - mean) ** 2 * n for s, n in scores)) / (FOLDS + len(scores)))
        self.kinds[kind] = (learn(values, chars=_CHARS[kind]), mean, spread)


def train(found: DataFrame, max_examples: int = MAX_EXAMPLES) -> Grammar:
    """Learn from what the tasks gave: at most max_examples distinct values of a kind, and a count per pair of classes, reach the driver."""
    steps = found.where("kind IS NULL").groupBy("before", "symbol").agg(F.sum("n").alias("n")).collect()  # a row per pair of classes
    grammar = Grammar({}, chain({(r.before, r.symbol): r.n for r in steps}))
    for kind in KINDS:
        some = found.where(F.col("kind") == kind).select("hash", "value").distinct()
        values = [r.value for r in some.orderBy("hash", "value").limit(max_examples).collect()]
        if values:
            grammar.add(kind, values)
    return grammar


def _scan(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = sent.value

        @lru_cache(REMEMBERED)
        def remembered(form: str) -> bool:
            return grammar.accepts(form) is not None

        def accepted(value: str) -> bool:
            return remembered(value.translate(_FORM)) if len(value) <= SHORT else grammar.accepts(value) is not None

        for batch in batches:
            base, added = [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text)
                base.append([{"kind": KINDS[k], "start": a, "end": b, "value": v} for a, k, b, v in found])
                others = candidates(text, found)
                added.append([{"kind": "format", "start": a, "end": b, "value": v} for a, b, v, _ in others if accepted(v)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(added, pa.list_(_SPAN))], names=["doc_id", "base", "added"]
            )

    return run


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """Per row: doc_id, base spans (by start, then kind) and the spans added by their format."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body"))
    gathered = rows.select("body").mapInArrow(_gathered(max_examples), "kind string, value string, hash bigint, before int, symbol int, n bigint")
    values = stored(gathered, "secret-values")
    sent = docs.sparkSession.sparkContext.broadcast(train(values, max_examples))
    discard(values)
    kind = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<kind:string,start:int,end:int,value:string>>"
    return rows.mapInArrow(_scan(sent), f"doc_id {kind}, base {span}, added {span}")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
