"""Ordered rules: the first that holds names a row's reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    holds: Column


@dataclass(frozen=True)
class RuleSet:
    rules: Sequence[Rule]

    def reason(self) -> Column:
        """The code of the first rule that holds, else null; a condition that is null does not hold."""
        chain = None
        for rule in self.rules:
            chain = F.when(rule.holds, rule.code) if chain is None else chain.when(rule.holds, rule.code)
        return F.lit(None).cast("string") if chain is None else chain


@dataclass(frozen=True)
class Lookup:
    """Fact columns that must be found in a dimension's key; ``sentinel`` is a flag column of rows that mean no place."""

    dimension: DataFrame
    key: str
    columns: Sequence[str]
    unknown: str
    sentinel: str | None = None
    sentinel_code: str | None = None


def flag_unresolved(df: DataFrame, lookups: Sequence[Lookup], reason: str = "reason_code") -> DataFrame:
    """Fills ``reason`` where it is null: unknown keys first, then sentinels, lookup by lookup.

    Each dimension is joined from the left, once for each fact column; its key must be unique.  Whether a dimension is sent
    to every task is left to Spark, which checks its size.
    """
    columns, rules = df.columns, []
    for n, lookup in enumerate(lookups):
        unknown, sentinels = [], []
        for k, column in enumerate(lookup.columns):
            found, flag = f"__found_{n}_{k}", f"__flag_{n}_{k}"
            side = lookup.dimension.select(F.col(lookup.key).alias(found), *([F.col(lookup.sentinel).alias(flag)] if lookup.sentinel else []))
            df = df.join(side, F.col(column) == F.col(found), "left")
            unknown.append(F.col(found).isNull())
            if lookup.sentinel:
                sentinels.append(F.coalesce(F.col(flag), F.lit(False)))
        rules.append(Rule(lookup.unknown, _either(unknown)))
        if lookup.sentinel:
            rules.append(Rule(lookup.sentinel_code, _either(sentinels)))
    found = RuleSet(rules).reason()
    kept = [F.col(c) for c in columns if c != reason]
    return df.select(*kept, F.coalesce(F.col(reason), found).alias(reason) if reason in columns else found.alias(reason))


def _either(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
