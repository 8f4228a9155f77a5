"""Array math as Catalyst higher-order expressions (no Python): softmax,
log-softmax with the maximum subtracted first, dot product, L2 norm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it inside ``body`` (a lambda variable
    reference is a lookup; a captured expression would be re-evaluated for
    every element of an enclosing higher-order function)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def arr_max(a) -> Column:
    return F.array_max(_c(a))


def logsumexp(a) -> Column:
    a = _c(a).cast("array<double>")
    return let(F.struct(a.alias("a"), F.array_max(a).alias("m")), lambda s: s["m"] + F.log(
        F.aggregate(s["a"], F.lit(0.0), lambda acc, x: acc + F.exp(x - s["m"]))))


def log_softmax(a) -> Column:
    a = _c(a).cast("array<double>")
    return let(F.struct(a.alias("a"), logsumexp(a).alias("lse")),
               lambda s: F.transform(s["a"], lambda x: x - s["lse"]))


def softmax(a) -> Column:
    return F.transform(log_softmax(a), lambda x: F.exp(x))


def softmax_at(a, i: int) -> Column:
    """softmax(a)[i] (0-based); an error when there are fewer than i+1 logits."""
    a = _c(a).cast("array<double>")
    return F.when(F.size(a) > i, F.exp(F.element_at(a, i + 1) - logsumexp(a))) \
        .otherwise(F.raise_error(F.lit("need at least two logits")))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a).cast("array<double>"), _c(b).cast("array<double>"),
                                  lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2norm(a) -> Column:
    return F.sqrt(dot(a, a))


def mean(a) -> Column:
    a = _c(a).cast("array<double>")
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)
