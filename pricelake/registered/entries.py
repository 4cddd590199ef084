"""Registration of a query with its output columns and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.registered.base_sql import BASE

# Doubles are compared at four places. The shift is far below that and keeps values that sit on a
# rounding tie from going different ways in the two engines; adding zero removes a negative zero.
TIE_SHIFT = 3e-7


@dataclass(frozen=True)
class Entry:
    """`columns` lists name:kind with kinds i (integer), d (double), s (text), t (day or time as text)
    and b (boolean)."""

    name: str
    columns: str
    plan: Callable
    sql: str | None

    def kinds(self) -> list[tuple[str, str]]:
        return [tuple(part.split(":")) for part in self.columns.split()]

    def present(self, df: DataFrame) -> DataFrame:
        shown = {
            "i": lambda c: c.cast("bigint"),
            "d": lambda c: F.round(c.cast("double") + TIE_SHIFT, 4) + 0.0,
            "s": lambda c: c.cast("string"),
            "t": lambda c: c.cast("string"),
            "b": lambda c: c.cast("boolean"),
        }
        return df.select([shown[kind](F.col(name)).alias(name) for name, kind in self.kinds()])

    def full_sql(self) -> str:
        shown = {
            "i": "cast({0} as bigint)",
            "d": "round(cast({0} as double) + cast(3e-7 as double), 4) + cast(0 as double)",
            "s": "cast({0} as varchar)",
            "t": "cast({0} as varchar)",
            "b": "cast({0} as boolean)",
        }
        outer = ", ".join(f"{shown[kind].format(name)} as {name}" for name, kind in self.kinds())
        return f"with {BASE}\nselect {outer} from (\n{self.sql.strip()}\n) as q"


ENTRIES: dict[str, Entry] = {}


def register(name: str, columns: str, sql: str | None = None):
    def keep(plan: Callable) -> Callable:
        ENTRIES[name] = Entry(name, columns, plan, sql)
        return plan

    return keep
