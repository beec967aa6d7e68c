"""Running values of arrays in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import bind

#: Values whose running results are made together.
STRETCH = 64


def running(values: Column, zero: Column, plus: Callable[[Column, Column], Column]) -> Column:
    """Results of the first 0, 1, 2, ... values under an associative ``plus``.

    A running array is copied for every value, so it is made for stretches of ``STRETCH`` values,
    and once for the stretches: an array of a million values is no quadratic work."""

    def scan(part: Column, start: Column) -> Column:
        return F.aggregate(part, F.array(start), lambda out, x: F.concat(out, F.array(plus(F.element_at(out, -1), x))))

    def stretches(whole: Column) -> Column:
        last = F.greatest(F.ceil(F.size(whole) / STRETCH).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(whole, i * STRETCH + 1, STRETCH))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, zero, plus))
        return bind(
            scan(totals, zero),
            lambda starts: F.flatten(F.transform(parts, lambda part, i: F.slice(scan(part, F.get(starts, i)), 2, STRETCH))),
        )

    return F.concat(F.array(zero), bind(values, lambda whole: bind(stretches(whole), joined)))
