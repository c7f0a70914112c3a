"""Data-quality rules: every check is a table of issues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition that rows must not meet."""

    name: str
    violated: Column
    severity: str = "error"


def issues(df: DataFrame, rules: list[Rule], id_cols: list[str]) -> DataFrame:
    """A row for every violated rule of every row, in one pass: the ids, rule, severity."""
    found = [F.when(F.coalesce(r.violated, F.lit(False)), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"))) for r in rules]
    return df.select(*id_cols, F.explode(F.array_compact(F.array(*found))).alias("__r")).select(*id_cols, "__r.rule", "__r.severity")


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """A row for every rule with the number of rows checked and violating: one aggregation."""
    counts = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.count_if(F.coalesce(r.violated, F.lit(False))).alias("violations")) for r in rules]
    one = df.agg(F.count(F.lit(1)).alias("checked"), *[c.alias(f"__{i}") for i, c in enumerate(counts)])
    return one.select("checked", F.inline(F.array(*[F.col(f"__{i}") for i in range(len(rules))]))).select("rule", "severity", "checked", "violations")


def passed(report_: DataFrame) -> DataFrame:
    """One row: whether no error rule is violated."""
    return report_.agg((F.coalesce(F.sum(F.when(F.col("severity") == "error", F.col("violations"))), F.lit(0)) == 0).alias("passed"))


def truncated(issues_: DataFrame, key: str, order: list[str], most: int = 200) -> DataFrame:
    """The first issues of each rule, and whether there were more."""
    n = issues_.groupBy(F.col(key).alias("__k")).agg((F.count(F.lit(1)) > most).alias("truncated"))
    first = issues_.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("nth") <= most)
    return first.join(n, F.col(key) == F.col("__k")).drop("__k")


def leaked(used: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `used` whose key is not in `allowed`."""
    return used.join(allowed.select(*keys), keys, "left_anti")


def missing_parents(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias("__p")), F.col(child_key) == F.col("__p"), "left_anti")


def difference(expected: DataFrame, actual: DataFrame, key: str, most: int = 50) -> DataFrame:
    """The first missing and extra keys, sorted: rows (side, key)."""
    a, b = expected.select(key).distinct(), actual.select(key).distinct()
    side = lambda x, y, name: x.join(y, key, "left_anti").orderBy(key).limit(most).select(F.lit(name).alias("side"), key)
    return side(a, b, "missing").unionByName(side(b, a, "extra"))


def document_diff(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """A row for each key and field that differ, nulls equal to nulls; a key on one side only has field `row`."""
    old = before.select(*keys, *[F.col(f).cast("string").alias(f"__a_{f}") for f in fields], F.lit(True).alias("__a"))
    new = after.select(*keys, *[F.col(f).cast("string").alias(f"__b_{f}") for f in fields], F.lit(True).alias("__b"))
    both = old.join(new, keys, "full_outer")
    entry = lambda f, a, b: F.struct(F.lit(f).alias("field"), a.alias("before"), b.alias("after"))
    lone = F.col("__a").isNull() | F.col("__b").isNull()
    found = [F.when(~lone & ~F.col(f"__a_{f}").eqNullSafe(F.col(f"__b_{f}")), entry(f, F.col(f"__a_{f}"), F.col(f"__b_{f}"))) for f in fields]
    present = lambda c: F.when(F.col(c), "present").otherwise("absent")
    found.append(F.when(lone, entry("row", present("__a"), present("__b"))))
    return both.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("d")).select(*keys, "d.field", "d.before", "d.after")
