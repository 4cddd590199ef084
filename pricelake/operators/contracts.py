"""Row-level data contracts: coerce, check, and split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed

REASON = "_dq_reason"


@dataclass(frozen=True)
class Check:
    """A named predicate. Null passes: absence is the business of `nullable`."""

    code: str
    holds: Callable[[Column], Column]


def above(bound) -> Check:
    return Check(f"gt_{bound}", lambda c: c > bound)


def between(low, high) -> Check:
    return Check(f"between_{low}_{high}", lambda c: c.between(low, high))


def at_least(bound) -> Check:
    return Check(f"ge_{bound}", lambda c: c >= bound)


def one_of(values) -> Check:
    return Check("isin", lambda c: c.isin(list(values)))


def not_blank() -> Check:
    return Check("min_length_1", lambda c: F.length(c) >= 1)


@dataclass(frozen=True)
class Rule:
    column: str
    type: str
    nullable: bool = False
    checks: tuple[Check, ...] = ()
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [r.column for r in self.rules]

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.columns if c not in df.columns]

    def coerced(self, df: DataFrame) -> DataFrame:
        """Declared columns in declared types; unknown columns dropped, uncastable values null."""
        return df.select([F.col(r.column).try_cast(r.type).alias(r.column) for r in self.rules])

    def annotate(self, df: DataFrame, check_unique: bool = True) -> DataFrame:
        """All source columns plus the first failing rule, in contract order, or null.

        `check_unique=False` leaves out the uniqueness rules, and with them the only shuffle, where
        the input is already one row per key.
        """
        missing = self.missing(df)
        if missing:
            return df.withColumn(REASON, F.lit(f"missing_column:{missing[0]}"))
        marks: dict[str, str] = {}
        if check_unique:
            for rule in self.rules:
                if rule.unique:
                    marks[rule.column] = f"_repeated_{rule.column}"
                    df = _mark_repeated(df, rule, marks[rule.column])
        failures = []
        for rule in self.rules:
            source = F.col(rule.column)
            value = source.try_cast(rule.type)
            failures.append(F.when(source.isNotNull() & value.isNull(),
                                   F.lit(f"coerce:{rule.column}")))
            if not rule.nullable:
                failures.append(F.when(source.isNull(), F.lit(f"not_null:{rule.column}")))
            for check in rule.checks:
                failures.append(F.when(~check.holds(value), F.lit(f"{check.code}:{rule.column}")))
            if rule.column in marks:
                failures.append(F.when(F.col(marks[rule.column]), F.lit(f"unique:{rule.column}")))
        return df.withColumn(REASON, F.coalesce(*failures)).drop(*marks.values())

    def split(self, df: DataFrame, check_unique: bool = True) -> tuple[DataFrame, DataFrame]:
        """(valid, rejected): valid rows coerced, rejected rows whole with their reason."""
        return self.parts(self.annotate(df, check_unique))

    def parts(self, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The same from annotated rows, which a caller that uses both parts stores first."""
        rejected = marked.filter(F.col(REASON).isNotNull())
        if self.missing(marked):
            empty = marked.sparkSession.createDataFrame(
                [], ", ".join(f"{r.column} {r.type}" for r in self.rules))
            return empty, rejected
        return self.coerced(marked.filter(F.col(REASON).isNull())), rejected


def _mark_repeated(df: DataFrame, rule: Rule, mark: str) -> DataFrame:
    """Flag rows whose key repeats. Counted with map-side combine and joined back on the few repeated
    keys, so no task holds all rows of one key; adaptive execution splits the row side if it is hot."""
    key = F.col(rule.column).try_cast(rule.type)
    repeated = (
        df.groupBy(key.alias("_key")).agg(F.count("*").alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_key").isNotNull())
        .select("_key", F.lit(True).alias(mark))
    )
    return (
        df.withColumn("_join_key", key)
        .join(repeated, F.col("_join_key") == F.col("_key"), "left")
        .drop("_join_key", "_key")
    )


PRODUCTS = Contract("products", (
    Rule("product_id", "bigint", checks=(above(0),), unique=True),
    Rule("name", "string", checks=(not_blank(),)),
    Rule("category", "string"),
    Rule("subcategory", "string", nullable=True),
    Rule("brand", "string", nullable=True),
    Rule("base_price", "double", checks=(above(0),)),
    Rule("base_rating", "double", checks=(between(0, fixed.MAX_RATING),)),
    Rule("image_url", "string", nullable=True),
))

PRICE_FACTS = Contract("price_facts", (
    Rule("fact_id", "bigint", checks=(above(0),), unique=True),
    Rule("product_id", "bigint", checks=(above(0),)),
    Rule("time_id", "bigint", checks=(above(0),)),
    Rule("price", "double", checks=(above(0),)),
    Rule("original_price", "double", nullable=True, checks=(above(0),)),
    Rule("discount_percentage", "double", checks=(between(0, fixed.MAX_DISCOUNT),)),
    Rule("availability", "string", checks=(one_of(fixed.AVAILABILITY),)),
    Rule("stock_level", "bigint", checks=(at_least(0),)),
    Rule("rating", "double", nullable=True, checks=(between(0, fixed.MAX_RATING),)),
    Rule("review_count", "bigint", checks=(at_least(0),)),
    Rule("sales_velocity", "double", checks=(at_least(0),)),
    Rule("is_trending", "boolean"),
))
