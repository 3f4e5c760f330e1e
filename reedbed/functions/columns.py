"""Column builders used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_array(values: Sequence[str]) -> Column:
    """Array literal; typed even when empty."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def half_even(col: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(col, digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    """``num`` as percent of ``den``, rounded half to even; null for an empty base."""
    base = F.when(den != 0, den.cast("double"))
    return half_even(num.cast("double") / base * 100, digits)


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; null when the base is 0."""
    return num.cast("double") / F.when(den != 0, den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def argmax(probs: Column) -> Column:
    """Position of the largest value, the first one on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def only(names: Column, allowed: Sequence[str]) -> Column:
    """Entries of ``names`` that are in ``allowed``, order and repeats kept."""
    return F.filter(names, lambda n: n.isin(list(allowed)))


def has_any(names: Column, allowed: Sequence[str]) -> Column:
    """True when any entry is in ``allowed``; false, never null, for a null list."""
    return F.coalesce(F.arrays_overlap(names, text_array(allowed)), F.lit(False))


def label_of(name: Column, species: Sequence[str]) -> Column:
    """Class label of a species name, null when it is not mapped."""
    pairs = [part for i, s in enumerate(species) for part in (F.lit(s), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), name)


def species_of(label: Column, species: Sequence[str]) -> Column:
    """Species name of a class label, null when it is not mapped."""
    pairs = [part for i, s in enumerate(species) for part in (F.lit(i), F.lit(s))]
    return F.try_element_at(F.create_map(*pairs), label.cast("int"))
