"""Many patterns in one pass: an automaton finds the words that patterns need, and only those whose word is there are tried."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions.patterns import NEGATIONS, PATTERNS

#: Letters before a match in which a negation counts, and those that may stand between.
WITHIN, BETWEEN = 28, 12
#: A shorter literal is in most texts and tells nothing.
SHORTEST = 3

#: Letters that a pattern's i, s and k match besides their own two, when case does not count.
_FOLDED = str.maketrans({"\u0130": "i", "\u0131": "i", "\u017f": "s", "\u212a": "k"})
_TOKEN = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\{\d*,?\d*\}|.", re.DOTALL)


def needed(pattern: str) -> str | None:
    """The longest literal that each match of a pattern has, in lower case: outside of groups, classes and what may be left
    out. None if the pattern is a choice or has none of SHORTEST letters."""
    best = run = ""
    depth, tokens = 0, _TOKEN.findall(pattern)
    for at, token in enumerate(tokens):
        after = tokens[at + 1] if at + 1 < len(tokens) else ""
        depth += (token == "(") - (token == ")")
        if token == "|" and not depth:
            return None
        literal = token[1:] if len(token) == 2 and token[0] == "\\" and not token[1].isalnum() else token
        plain = not depth and len(literal) == 1 and (len(token) == 2 or token not in "()|.^$*+?")
        if plain and after[:1] not in ("?", "*", "{"):
            run += literal
            best = max(best, run, key=len)
            # what comes once or more ends a run
            run = "" if after == "+" else run
        else:
            run = ""
    best = best.translate(_FOLDED).lower()
    return best if len(best) >= SHORTEST else None


class Patterns:
    """Compiled patterns by feature. table: patterns by language and feature; a feature is shown by any pattern of any
    language that matches where no negation stands right before."""

    def __init__(self, table: dict[str, dict[str, list[str]]], negations: list[str]):
        import ahocorasick

        by_literal: dict[str, list[int]] = {}
        self.patterns, self.always = [], []
        for own in table.values():
            for name, patterns in own.items():
                for pattern in patterns:
                    literal = needed(pattern)
                    (self.always if literal is None else by_literal.setdefault(literal, [])).append(len(self.patterns))
                    self.patterns.append((name, re.compile(pattern, re.IGNORECASE)))
        self.automaton = ahocorasick.Automaton()
        for literal, numbers in by_literal.items():
            self.automaton.add_word(literal, tuple(numbers))
        if by_literal:
            self.automaton.make_automaton()
        self.any = bool(by_literal)
        self.denied = re.compile("(?:" + "|".join(negations) + rf")[\w\s']{{0,{BETWEEN}}}$") if negations else None

    def tried(self, text: str) -> list[int]:
        """Numbers of the patterns whose literal the text has."""
        found = set(self.always)
        if self.any:
            for _, numbers in self.automaton.iter(text.translate(_FOLDED).lower()):
                found.update(numbers)
        return sorted(found)

    def shown(self, text: str) -> list[str]:
        out: set[str] = set()
        for number in self.tried(text):
            name, pattern = self.patterns[number]
            if name not in out and any(not self.negated(text, m.start()) for m in pattern.finditer(text)):
                out.add(name)
        return sorted(out)

    def negated(self, text: str, start: int) -> bool:
        return self.denied is not None and self.denied.search(text[max(0, start - WITHIN) : start].lower()) is not None


def features_shown(text: Column, table: dict[str, dict[str, list[str]]] = PATTERNS, negations: list[str] = NEGATIONS) -> Column:
    """array<string>: the features that a text shows, by name; none of a null or empty text."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns = Patterns(table, negations)
        for texts in batches:
            yield texts.map(lambda x: patterns.shown(x) if x else [])

    return run(text)
