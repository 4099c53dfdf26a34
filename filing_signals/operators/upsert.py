"""Keyed upsert, cascade delete and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filing_signals.schemas import Relation


class ConstraintError(ValueError):
    """Rows break a key, NOT NULL or reference rule."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; counts combine on the map side, so copies do not pile up."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Referencing values without a parent, with their row counts (one row per value)."""
    refs = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return refs.join(parent.select(key), key, "left_anti")


def conform(df: DataFrame, relation: Relation) -> DataFrame:
    """Columns of `relation` bound by name, in its types, missing ones filled from its defaults.

    A null in a NOT NULL column raises when the row is computed, so no extra pass is needed.
    """
    missing = [c for c in relation.columns if c not in df.columns and c not in relation.defaults]
    if missing:
        raise ConstraintError(f"{relation.name} lacks columns: {missing}")

    def column(f: T.StructField) -> Column:
        c = F.col(f.name) if f.name in df.columns else relation.defaults[f.name]()
        c = c.cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{relation.name}.{f.name} is null")).cast(f.dataType))
        return c.alias(f.name)

    return df.select(*[column(f) for f in relation.schema])


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise if a key occurs twice; at most one row reaches the driver."""
    twice = duplicate_keys(df, keys).head(1)
    if twice:
        raise ConstraintError(f"key {keys} occurs more than once: {twice[0].asDict()}")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    replace_by: str | None = None,
) -> DataFrame:
    """Incoming rows plus the existing rows whose key is not incoming; columns bound by name.

    With `replace_by` (a document id, say) every existing row of an incoming value goes, so a
    shorter reload leaves no old tail behind.
    """
    if replace_by is None:
        kept = existing.join(incoming.select(*keys), keys, "left_anti")
    else:
        kept = existing.join(incoming.select(replace_by).distinct(), replace_by, "left_anti")
    return incoming.unionByName(kept)


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that remain once the `deleted` parents are gone."""
    return child.join(deleted.select(key).distinct(), key, "left_anti")


def constraint_report(
    relation: Relation, df: DataFrame, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per rule of a relation with the number of violations.

    Key: keys held more than once. NOT NULL: rows with a null. Reference: rows without a parent.

    Every rule looks at all rows, so keys and whether the other columns are null are staged, and what makes
    the rows runs once.
    """
    from filing_signals.sources.snapshots import staged  # which imports this module

    nulls = [f.name for f in relation.schema if not f.nullable and f.name in df.columns]
    keys = list(dict.fromkeys([*relation.keys, *(parents or {})]))
    df = staged(df.select(*keys, *[F.col(c).isNull().alias(f"null:{c}") for c in nulls]))
    counted = df.agg(*[F.count_if(F.col(f"`null:{c}`")).alias(f"not_null:{c}") for c in nulls])
    per_rule = F.explode(
        F.array(
            *[
                F.struct(F.lit(f"not_null:{c}").alias("rule"), F.col(f"`not_null:{c}`").alias("violations"))
                for c in nulls
            ]
        )
    )
    parts = [
        duplicate_keys(df, relation.keys).agg(
            F.lit(f"key:{','.join(relation.keys)}").alias("rule"),
            F.count(F.lit(1)).alias("violations"),
        ),
        counted.select(per_rule.alias("r")).select("r.rule", "r.violations"),
    ]
    for key, parent in (parents or {}).items():
        parts.append(
            orphans(df, parent, key).agg(
                F.lit(f"reference:{key}").alias("rule"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(relation.name).alias("relation"), "rule", "violations")
