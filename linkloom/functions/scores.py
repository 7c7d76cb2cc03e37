"""Scores of an entity against a directory record: kernels for Arrow UDFs, and rules as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence, Set
from functools import cached_property

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as C
from linkloom.functions.fuzzy import Names, pair_score, ratio

#: Pairs of names bounded at once.
CELLS = 1 << 14

#: A form of a name: (text, cleaned, core); a line of an address: (number, body).
Form = tuple[str, str, str]


def best_name(names: Iterable[Form], others: Iterable[tuple[Form, str]]) -> tuple[float, str, str, str, int]:
    """(score, name, other, via, words of the winning form) of the best pair, the first of equals.

    A pair's score is that of its cleaned forms or, if higher, of its cores. 0 without any pair.
    """
    best = (0.0, "", "", "", 0)
    others = list(others)
    for text, full, core in names:
        for (other, other_full, other_core), via in others:
            if not text or not other:
                continue
            score, won = pair_score(full, other_full), other_full
            if core and other_core:
                by_core = pair_score(core, other_core)
                if by_core > score:
                    score, won = by_core, other_core
            if score > best[0]:
                best = (score, text, other, via, len(won.split()))
                if score >= 100.0:
                    return best
    return best


def best_address(lines: list[tuple[str, str]], others: list[tuple[str, str]]) -> tuple[float | None, float | None, int | None]:
    """(number score, body score, index of the other line) of the first pair of the greatest sum; None if not comparable."""
    best, found = -1.0, (None, None, None)
    for number, body in lines:
        for i, (other_number, other_body) in enumerate(others):
            n = (100.0 if number == other_number else 0.0) if number and other_number else None
            b = ratio(body, other_body) if body and other_body else None
            total = (n or 0.0) + (b or 0.0)
            if total > best:
                best, found = total, (n, b, i)
    return found


def best_city(cities: list[str], others: list[str]) -> float | None:
    return max((ratio(a, b) for a in cities for b in others), default=None)


class Record:
    """One side of many pairs, prepared once: what best_name and best_address would find in it, for each distinct name and line once."""

    def __init__(self, others: Sequence[tuple[Form, str]], lines: Sequence[tuple[str, str]]):
        self.others = [x for x in others if x[0][0]]
        self._by_name: dict[Form, tuple[float, str, str, str, int]] = {}
        self._by_line: dict[tuple[str, str], tuple[float, tuple[float | None, float | None, int | None]]] = {}
        self.lines = lines
        #: The first line of each body, with a number and without, and all lines of each number.
        self._bodies: dict[tuple[str, bool], int] = {}
        self._numbers: dict[str, list[int]] = {}
        for i, (number, body) in enumerate(lines):
            self._bodies.setdefault((body, bool(number)), i)
            if number:
                self._numbers.setdefault(number, []).append(i)

    @cached_property
    def _full(self) -> Names:
        return Names([o[1] for o, _ in self.others])

    @cached_property
    def _core(self) -> Names:
        return Names([o[2] for o, _ in self.others])

    def meet(self, names: Iterable[Form]) -> None:
        """Scores names that are new, many at once."""
        new = [x for x in dict.fromkeys(names) if x not in self._by_name and x[0]]
        if len(self.others) < 8:
            self._by_name |= {x: best_name([x], self.others) for x in new}
            return
        step = max(1, CELLS // len(self.others))
        for i in range(0, len(new), step):
            part = new[i : i + step]
            low, high = self._full.every_bounds([x[1] for x in part])
            by_core = self._core.every_bounds([x[2] for x in part])
            both = np.array([[bool(x[2])] for x in part]) & ~self._core.empty
            low, high = (np.where(both, np.maximum(a, b), a) for a, b in zip((low, high), by_core))
            # Only those that can be the best are scored one by one, in their order.
            may = high >= low.max(axis=1, keepdims=True) - 1e-9
            for x, row in zip(part, may):
                self._by_name[x] = best_name([x], [self.others[j] for j in np.flatnonzero(row)])

    def best_name(self, names: Iterable[Form]) -> tuple[float, str, str, str, int]:
        """best_name(names, others)."""
        names = list(names)
        self.meet(names)
        best = (0.0, "", "", "", 0)
        for x in names:
            if x[0] and self._by_name[x][0] > best[0]:
                best = self._by_name[x]
        return best

    def _line(self, line: tuple[str, str]) -> tuple[float, tuple[float | None, float | None, int | None]]:
        number, body = line
        # Of lines with equal bodies and no equal number, the first of those with and of those without a number stands for all.
        places = sorted({*self._bodies.values(), *(self._numbers.get(number, ()) if number else ())})
        n, b, i = best_address([line], [self.lines[j] for j in places])
        return (-1.0, (None, None, None)) if i is None else ((n or 0.0) + (b or 0.0), (n, b, places[i]))

    def best_address(self, lines: Iterable[tuple[str, str]]) -> tuple[float | None, float | None, int | None]:
        """best_address(lines, others)."""
        best, found = -1.0, (None, None, None)
        for x in lines:
            if x not in self._by_line:
                self._by_line[x] = self._line(x)
            total, one = self._by_line[x]
            if total > best:
                best, found = total, one
        return found


def overlap(a: Sequence[str] | None, b: Set[str]) -> float | None:
    """100 if the two meet, 0 if not, None if either is empty."""
    return None if not a or not b else 0.0 if b.isdisjoint(a) else 100.0


def weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    """The weighted mean of the parts that aren't null; null if all are."""
    total = sum((F.coalesce(p * weights[k], F.lit(0.0)) for k, p in parts.items()), F.lit(0.0))
    weight = sum((F.when(p.isNotNull(), weights[k]).otherwise(0.0) for k, p in parts.items()), F.lit(0.0))
    return F.when(weight > 0, total / weight)


def verdict(name: Column, address: Column) -> Column:
    a = F.coalesce(address, F.lit(0.0))
    return (
        F.when(name.isNull(), C.VERDICTS[0])
        .when((name >= 92) | ((name >= 75) & (a >= 60)), C.VERDICTS[1])
        .when(name >= 75, C.VERDICTS[2])
        .when((a >= 85) & (name >= 45), C.VERDICTS[3])
        .when((name >= 45) | (a >= 50), C.VERDICTS[4])
        .otherwise(C.VERDICTS[5])
    )


def tier(name: Column, address: Column, city: Column, state: Column, zip5: Column, margin: Column, via: Column, words: Column) -> Column:
    """Strong takes two agreements: the street, or the entity's own name of two words or more and the place."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    street = yes(address >= 85)
    place = yes(address >= 60) | yes(zip5 == 100) | (yes(city >= 90) & yes(state == 100))
    own = yes(via.isin("Name", "Alias")) & yes(words >= 2)
    return (
        F.when(F.coalesce(name, F.lit(0.0)) < 75, C.TIERS[4])
        .when(margin < C.LEAST_MARGIN, C.TIERS[2])
        .when((name >= 92) & (street | (own & place)), C.TIERS[0])
        .when((name >= 92) | ((name >= 82) & place), C.TIERS[1])
        .otherwise(C.TIERS[3])
    )


def correction(different: Column, suggested: Column, name: Column, suggested_address: Column, address: Column) -> Column:
    """Whether the suggestion is better by enough to recommend; false where anything is null."""
    return F.coalesce(different & (suggested >= 80) & (suggested > name + 10) & (suggested_address >= 60) & (suggested_address >= address - 10), F.lit(False))
