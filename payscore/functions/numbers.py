"""Arithmetic on score arrays, inside the JVM.

Every expression mentions its input once, however large the model: a filter on a prediction is
pushed below the scoring by copying these expressions, which must not multiply there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Up to this many additions are written out as one generated expression.
UNROLL = 100


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(scores: Column) -> Column:
    """Shares that sum to 1, shifted by the maximum so that no exponent overflows."""

    def grow(top: Column) -> Column:
        return F.transform(scores, lambda x: F.exp(x - top))

    def share(grown: Column) -> Column:
        total = F.aggregate(grown, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(grown, lambda x: x / t))

    return let(let(F.array_max(scores), grow), share)


def argmax(scores: Column) -> Column:
    """Position from 0 of the largest value, the first one on ties."""
    return let(scores, lambda s: F.array_position(s, F.array_max(s)) - 1).cast("int")


def chunks(values: Column, n: int, size: int) -> Column:
    """``n`` arrays of ``size`` consecutive values each."""
    places = F.sequence(F.lit(0), F.lit(n - 1))
    return let(values, lambda v: F.transform(places, lambda i: F.slice(v, i * size + 1, F.lit(size))))


def total(arrays: Column, size: int) -> Column:
    """Element-wise sum of an array of arrays of ``size`` doubles."""
    zeros = F.array_repeat(F.lit(0.0), size)
    return F.aggregate(arrays, zeros, lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))


def votes(winners: Column, weights: Column, classes: int) -> Column:
    """Summed weight, per class, of the voters whose winner it is."""
    places = F.sequence(F.lit(0), F.lit(classes - 1))

    def tally(ballots: Column) -> Column:
        return F.transform(
            places,
            lambda c: F.aggregate(
                ballots, F.lit(0.0), lambda acc, b: acc + F.when(b["winner"] == c, b["weight"]).otherwise(0.0)
            ),
        )

    pairs = F.zip_with(winners, weights, lambda w, x: F.struct(w.alias("winner"), x.alias("weight")))
    return let(pairs, tally)


def constant(values: Sequence) -> Column:
    """A possibly nested list of doubles as a literal array."""
    return F.array(*[constant(v) if isinstance(v, (list, tuple)) else F.lit(float(v)) for v in values])


def confidence(probabilities: Column, prediction: Column) -> Column:
    """Probability of the predicted class."""
    return F.get(probabilities, prediction)


def percent_text(share: Column) -> Column:
    """``0.74052`` as ``74.05%``, ties to even."""
    return F.concat(F.call_function("format_number", share * 100, F.lit("######0.00")), F.lit("%"))


def softmax_shares(scores: Column) -> tuple[Column, Column]:
    """Class shares from log scores, and the winner's share as percent text."""
    shares = softmax(scores)
    return shares, percent_text(F.array_max(shares))


def sum_arrays(base: Column, terms: Sequence[Column], size: int) -> Column:
    """Element-wise sum of arrays of ``size`` doubles; a null term counts as zeros."""
    if size * len(terms) <= UNROLL:
        def element(i: int) -> Column:
            out = F.get(base, F.lit(i))
            for term in terms:
                out = out + F.coalesce(F.get(term, F.lit(i)), F.lit(0.0))
            return out

        return F.array(*[element(i) for i in range(size)])
    out, zeros = base, F.array_repeat(F.lit(0.0), size)
    for term in terms:
        out = F.zip_with(out, F.coalesce(term, zeros), lambda a, b: a + b)
    return out
