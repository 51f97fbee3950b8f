"""Turn raw text tables into typed tables by a declared specification."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybeat.functions import columns as fc
from tallybeat.operators.dedupe import keep_first

REASON = "reject_reason"


@dataclass(frozen=True)
class Field:
    """A column: its type, and whether to trim spaces or fold to upper case."""

    name: str
    kind: str = "string"  # string | bigint | date | decimal(p,s)
    trim: bool = False
    upper: bool = False

    def expression(self) -> Column:
        raw = F.col(self.name)
        if self.kind == "bigint":
            return fc.to_long(raw).alias(self.name)
        if self.kind == "date":
            return fc.to_date(raw).alias(self.name)
        if self.kind.startswith("decimal"):
            return fc.to_decimal(raw, self.kind).alias(self.name)
        text = raw.cast("string")
        text = F.trim(text) if self.trim else text
        return (F.upper(text) if self.upper else text).alias(self.name)


@dataclass(frozen=True)
class TableSpec:
    """What a conformed table looks like and which rows may enter it."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()  # null here rejects the row
    not_negative: tuple[str, ...] = ()  # null or below zero here rejects the row
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()  # which of two rows with one key stays
    partition_by: str | None = None
    free_text: bool = False  # text may hold line breaks

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields] + list(self.derived)


def typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast, trim and fold; a value that does not parse becomes null. No row is lost."""
    return raw.select(*[f.expression() for f in spec.fields])


def completed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the derived columns."""
    return rows.withColumns({name: make() for name, make in spec.derived.items()})


def acceptable(spec: TableSpec) -> Column:
    """Whether a typed row may enter; plain comparisons, in which null is a refusal."""
    rules = [F.col(name).isNotNull() for name in spec.required]
    rules += [F.col(name) >= 0 for name in spec.not_negative]
    return reduce(and_, rules, F.lit(True))


def judged(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows with the first rule each one breaks, or null."""
    reason = F.lit(None).cast("string")
    for name in reversed(spec.not_negative):
        broken = F.col(name).isNull() | (F.col(name) < 0)
        reason = F.when(broken, F.lit(f"{name} missing or negative")).otherwise(reason)
    for name in reversed(spec.required):
        reason = F.when(F.col(name).isNull(), F.lit(f"{name} missing")).otherwise(reason)
    return completed(typed(raw, spec), spec).withColumn(REASON, reason)


def conform(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The accepted rows, one per key. What can be derived from them is not shuffled."""
    accepted = typed(raw, spec).filter(acceptable(spec))
    given = (*spec.required, *spec.not_negative)
    return completed(keep_first(accepted, spec.key, spec.order_by, given), spec)


def rejects(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The refused rows with the reason."""
    return judged(raw, spec).filter(F.col(REASON).isNotNull())


def reject_counts(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows per reason; accepted rows, before the duplicates go, count as ``accepted``."""
    return (
        judged(raw, spec)
        .groupBy(F.coalesce(REASON, F.lit("accepted")).alias(REASON))
        .agg(F.count("*").alias("row_count"))
    )


def unparsed_counts(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Per typed column, the values that were given but did not parse; one pass."""
    checked = [f for f in spec.fields if f.kind != "string"]
    given = raw.select(
        *[
            (~fc.blank(F.col(f.name).cast("string")) & f.expression().isNull()).alias(f.name)
            for f in checked
        ]
    )
    totals = given.agg(*[F.count_if(F.col(f.name)).alias(f.name) for f in checked])
    return totals.unpivot([], [f.name for f in checked], "column_name", "unparsed")
