"""Lookup of a number in configured ranges."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from payscore.functions.numbers import constant, let
from payscore.sources.config import Range

# Code for a number in no range, and for a missing number.
NO_RANGE = "0"
NO_VALUE = "9999"
#: Up to this many ends are compared one after the other, in generated code; more are searched.
FEW_ENDS = 16


def _segments(ranges: Sequence[Range]) -> tuple[list[float], list[str]]:
    """Cut possibly overlapping ranges at all their ends; a code for each piece between two ends.

    One sweep over the ends, with the ranges that have begun in a heap, the highest ``ord`` on top.
    """
    ends = sorted({float(x) for r in ranges for x in (r.start, r.end)})
    waiting = sorted(enumerate(ranges), key=lambda x: x[1].start, reverse=True)
    open_ranges: list[tuple[int, int, Range]] = []
    codes = []
    for low in ends[:-1]:
        while waiting and waiting[-1][1].start <= low:
            i, r = waiting.pop()
            heapq.heappush(open_ranges, (-r.ord, i, r))
        while open_ranges and open_ranges[0][2].end <= low:
            heapq.heappop(open_ranges)
        codes.append(open_ranges[0][2].code if open_ranges else NO_RANGE)
    return ends, codes


def _ends_below(number: Column, ends: Sequence[float]) -> Column:
    """How many of the sorted ends are smaller than a number: a binary search in a constant array."""
    sorted_ends = constant(ends)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ends).bit_length()))])

    def search(value: Column) -> Column:
        def go_on(at: Column, step: Column) -> Column:
            return F.when(F.get(sorted_ends, at + step - 1) < value, at + step).otherwise(at)

        return F.aggregate(steps, F.lit(0), go_on)

    return let(number, search)


def _code_at(number: Column, ends: Sequence[float], codes: Sequence[str]) -> Column:
    """The code of the piece between two ends that holds a number; null for none."""
    if len(ends) > FEW_ENDS:
        place = F.when(number.isNotNull(), _ends_below(number, ends))
        return F.get(F.array(*[F.lit(c) for c in codes]), place)
    out = F.when(number.isNull(), F.lit(None).cast("string"))
    for end, code in zip(ends, codes):
        out = out.when(~(F.lit(float(end)) < number), F.lit(code))
    return out.otherwise(codes[-1])


def bucketize(value: Column, ranges: Sequence[Range], flag: str, strict: bool = False) -> Column:
    """Code of the range of kind ``flag`` that holds ``value`` (a text), ``start < value <= end``.

    Overlaps are resolved once, here. A row is compared with few ends one after the other; among many it looks
    its place up in as many steps as their number has binary digits.
    """
    mine = [r for r in ranges if r.flag == flag]
    if not mine:
        return F.lit(NO_RANGE)
    missing = value.isNull() | value.isin("", "null")
    number = F.when(~missing, value).cast("double") if strict else value.try_cast("double")
    ends, codes = _segments(mine)
    code = _code_at(number, ends, [NO_RANGE, *codes, NO_RANGE])
    return F.coalesce(code, F.when(missing, F.lit(NO_VALUE)).otherwise(NO_RANGE))
