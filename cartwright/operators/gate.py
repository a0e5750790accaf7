"""Table contracts as a gate: which rules a row breaks, and what that does to a batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import Contract

BROKEN = "broken_rules"


class ContractError(ValueError):
    """A batch that breaks the contract of its table. ``rows`` are its broken rows with
    the rules that each breaks; ``violations`` counts them by rule."""

    def __init__(self, table: str, rows: DataFrame, violations: dict[str, int]) -> None:
        listed = ", ".join(f"{rule} {n}" for rule, n in sorted(violations.items()))
        super().__init__(f"rows that break the contract of {table}: {listed}")
        self.table, self.rows, self.violations = table, rows, violations


def row_rules(contract: Contract) -> dict[str, Column]:
    """Rule name to a condition that holds where a row breaks it. Null breaks only
    ``not_null``."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in contract.not_null}
    rules |= {f"max_length:{c}": F.length(c) > n for c, n in contract.max_length.items()}
    rules |= {
        f"range:{c}": F.abs(F.col(c)) >= F.lit(10 ** (precision - scale))
        for c, (precision, scale) in contract.decimals.items()
    }
    return {name: F.coalesce(broken, F.lit(False)) for name, broken in rules.items()}


def unique_rule(contract: Contract) -> str:
    return f"unique:{contract.key}"


def broken_rules(contract: Contract) -> Column:
    """The rules that a row breaks by itself, null if none."""
    names = [F.when(broken, F.lit(name)) for name, broken in row_rules(contract).items()]
    found = F.filter(F.array(*names), lambda name: name.isNotNull())
    return F.when(F.size(found) > 0, found)


@dataclass(frozen=True)
class Judged:
    """A stored batch with the column ``broken_rules``: its rows, how many they are, and
    how many of them break a rule."""

    rows: DataFrame
    seen: int
    broken: int

    @property
    def accepted(self) -> DataFrame:
        rows = self.rows if self.broken == 0 else self.rows.where(F.col(BROKEN).isNull())
        return rows.drop(BROKEN)

    @property
    def quarantined(self) -> DataFrame:
        return self.rows.where(F.col(BROKEN).isNotNull())

    def violations(self) -> dict[str, int]:
        rules = self.quarantined.select(F.explode(BROKEN).alias("rule"))
        return {r.rule: r["count"] for r in rules.groupBy("rule").count().collect()}


def repeated_keys(stored: DataFrame, key: str) -> DataFrame:
    """The keys that more than one row carries. Reads the key column alone; null is no key."""
    counted = stored.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1").select(key)


def mark_repeats(stored: DataFrame, contract: Contract, repeated: DataFrame) -> DataFrame:
    """The batch with every row of a repeated key marked, whatever else it breaks.

    Which of the rows is right cannot be told, so none passes.
    """
    key = contract.key
    marked = stored.join(repeated.withColumn("_repeated", F.lit(True)), key, "left")
    with_rule = F.concat(
        F.coalesce(F.col(BROKEN), F.array().cast("array<string>")),
        F.array(F.lit(unique_rule(contract))),
    )
    rules = F.when(F.col("_repeated"), with_rule).otherwise(F.col(BROKEN))
    return marked.withColumn(BROKEN, rules).select(*stored.columns)
