"""Many terms at once: one search of a text finds all of them."""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docloom._ship import ensure_importable

try:
    import ahocorasick
except ImportError:  # the automaton below does the same, more slowly
    ahocorasick = None


class Automaton:
    """Aho–Corasick over terms that aren't empty: matches(text) gives (start, number) of every occurrence of every term.

    Matches come by their ends, of one end the longest first. Equal terms are reported by the
    number of the first. native: use the compiled library where it is installed.
    """

    def __init__(self, terms: Sequence[str], native: bool = True) -> None:
        self.terms = list(terms)
        first: dict[str, int] = {}
        for i, t in enumerate(self.terms):
            if t:
                first.setdefault(t, i)
        self._compiled = None
        if native and ahocorasick is not None and first:
            self._compiled = ahocorasick.Automaton()
            for t, i in first.items():
                self._compiled.add_word(t, (i, len(t)))
            self._compiled.make_automaton()
            return
        self._next: list[dict[str, int]] = [{}]
        self._fail, self._term, self._shorter = [0], [-1], [0]
        for t, i in first.items():
            state = 0
            for c in t:
                if c not in self._next[state]:
                    self._next[state][c] = len(self._next)
                    self._next.append({})
                    self._fail.append(0)
                    self._term.append(-1)
                    self._shorter.append(0)
                state = self._next[state][c]
            self._term[state] = i
        queue = deque(self._next[0].values())
        while queue:
            state = queue.popleft()
            for c, child in self._next[state].items():
                fall = self._fail[state]
                while fall and c not in self._next[fall]:
                    fall = self._fail[fall]
                self._fail[child] = self._next[fall].get(c, 0) if state else 0
                queue.append(child)
            fall = self._fail[state]
            self._shorter[state] = fall if self._term[fall] >= 0 else self._shorter[fall]

    def matches(self, text: str) -> Iterator[tuple[int, int]]:
        if self._compiled is not None:
            for end, (i, n) in self._compiled.iter(text):
                yield end - n + 1, i
            return
        state = 0
        for at, c in enumerate(text):
            while state and c not in self._next[state]:
                state = self._fail[state]
            state = self._next[state].get(c, 0)
            found = state if self._term[state] >= 0 else self._shorter[state]
            while found:
                i = self._term[found]
                yield at + 1 - len(self.terms[i]), i
                found = self._shorter[found]

    def present(self, text: str) -> list[int]:
        """Numbers of the terms that a text has, ascending."""
        return sorted({i for _, i in self.matches(text)})


_BUILT: dict[tuple[str, ...], Automaton] = {}


def _automaton(terms: tuple[str, ...]) -> Automaton:
    """A worker builds an automaton once for all its batches."""
    if terms not in _BUILT:
        _BUILT.clear()
        _BUILT[terms] = Automaton(terms)
    return _BUILT[terms]


#: Texts that are Python strings side by side.
TEXTS = 500


def present_in(automaton: Automaton, texts: pa.Array) -> pa.Array:
    """automaton.present() of each text, as lists of one array of numbers; a null text has none."""
    ends, found = array("i", [0]), array("i")
    for at in range(0, len(texts), TEXTS):
        for t in texts.slice(at, TEXTS).to_pylist():
            if t:
                found.extend(automaton.present(t))
            ends.append(len(found))
    return pa.ListArray.from_arrays(*(pa.array(np.frombuffer(x, dtype=np.int32) if x else np.zeros(0, dtype=np.int32)) for x in (ends, found)))


def present_terms(spark: SparkSession, text: Column, terms: Sequence[str]) -> Column:
    """Which terms a text has, as ascending numbers into terms; a null text has none. Terms must differ and not be empty.

    Text and terms are compared as they are: give both in one case. A worker holds a batch of texts as Arrow has it, a
    few of them as strings, and numbers of 4 bytes for what it finds.
    """
    ensure_importable(spark)
    own = tuple(terms)
    if len(set(own)) < len(own) or not all(own):
        raise ValueError("terms must differ and not be empty")

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(own)
        for texts in batches:
            yield present_in(automaton, texts)
            del texts
            pa.default_memory_pool().release_unused()

    return run(text)
