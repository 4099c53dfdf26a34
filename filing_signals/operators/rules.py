"""Constraint violations as rows: good rows and rejected ones, with the rules that each breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filing_signals.operators.pairing import is_small
from filing_signals.operators.upsert import duplicate_keys
from filing_signals.schemas import Relation
from filing_signals.sources.snapshots import staged

BROKEN = "broken"


def _orphaned(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Referencing values without a parent: one row per value."""
    refs = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return refs.join(parent.select(key).distinct(), key, "left_anti")


def with_broken_rules(rows: DataFrame, relation: Relation, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """`rows` with `broken`, the names of the rules that each row breaks, in order, empty where it is good.

    `not_null:<column>` is seen in the row itself. `key:<columns>` holds for all rows of a key that
    comes more than once, nulls equal. `reference:<column>` holds for a value that its parent lacks. Only the
    keys at fault are joined to the rows; they are few in a sound load, and then sent to all tasks.
    """
    nulls = [f.name for f in relation.schema if not f.nullable and f.name in rows.columns]
    checks: list[Column] = []
    key_name = F.lit(f"key:{','.join(relation.keys)}")
    twice = staged(duplicate_keys(rows, relation.keys).select(*relation.keys, F.lit(True).alias("_twice")))
    # null-safe: a key with a missing part can be held twice too
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in relation.keys]
    marked = rows.alias("r").join(twice.alias("t"), on, "left").select("r.*", "_twice")
    checks.append(F.when(F.col("_twice"), key_name))
    checks += [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in nulls]
    for i, (key, parent) in enumerate((parents or {}).items()):
        lost = staged(_orphaned(rows, parent, key))
        few = is_small(lost)
        lost = lost.withColumn(f"_lost{i}", F.lit(True))
        marked = marked.join(F.broadcast(lost) if few else lost.hint("merge"), key, "left")
        checks.append(F.when(F.col(f"_lost{i}"), F.lit(f"reference:{key}")))
    broken = F.array_compact(F.array(*checks)).alias(BROKEN)
    return marked.select(*rows.columns, broken)


def split_by_rules(
    rows: DataFrame, relation: Relation, parents: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with `broken`). The marked rows are written once and read by both."""
    marked = staged(with_broken_rules(rows, relation, parents))
    return marked.where(F.size(BROKEN) == 0).drop(BROKEN), marked.where(F.size(BROKEN) > 0)
