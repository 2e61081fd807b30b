"""Many keywords sought in one pass over a text, however many there are."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MOST_CHARS = 20_000_000  # of all words together: what is sent to every task stays bounded


class Automaton:
    """The words as a tree whose nodes also lead to the longest end of themselves that begins a word (Aho and Corasick, 1975).

    ``rank`` gives each node the least number of a word that ends there.
    """

    def __init__(self, words: list[str]):
        if sum(map(len, words)) > MOST_CHARS:
            raise ValueError(f"more than {MOST_CHARS} characters of keywords")
        self.next: list[dict[str, int]] = [{}]
        self.rank = [len(words)]
        for number, word in enumerate(words):
            at = 0
            for c in word:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.rank.append(len(words))
                at = to
            if word:
                self.rank[at] = min(self.rank[at], number)
        self.back = [0] * len(self.next)
        waiting = deque(self.next[0].values())
        while waiting:
            at = waiting.popleft()
            for c, to in self.next[at].items():
                self.back[to] = self._step(self.back[at], c)
                waiting.append(to)
            self.rank[at] = min(self.rank[at], self.rank[self.back[at]])

    def _step(self, at: int, c: str) -> int:
        while at and c not in self.next[at]:
            at = self.back[at]
        return self.next[at].get(c, 0)

    def first(self, text: str) -> int | None:
        """The least number of the words in ``text``."""
        at, none = 0, self.rank[0]
        best = none
        for c in text:
            at = self._step(at, c)
            if self.rank[at] < best:
                best = self.rank[at]
                if not best:
                    break
        return best if best < none else None


def first_keyword(text: Column, words: list[tuple[str, str]]) -> Column:
    """The value of the first of ``words`` (word, value) that is in ``text``, in any case; null if none is or the text is null.

    The automaton is sent to the tasks once; a text is read once, whatever the number of words.
    """
    shared = SparkSession.active().sparkContext.broadcast((Automaton([w.lower() for w, _ in words]), [v for _, v in words]))

    @F.pandas_udf("string")
    def found(texts: pd.Series) -> pd.Series:
        automaton, values = shared.value
        numbers = (None if t is None else automaton.first(t) for t in texts)
        return pd.Series([None if n is None else values[n] for n in numbers], dtype=object)

    return found(F.lower(text))
