"""UID dictionaries: strict lookups that fail on a gap, and an audit that lists the gaps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import literal_map


def strict_names(
    uids: Column, rows: Column, known_rows: Column, names: Mapping[str, str], what: str
) -> Column:
    """Names of a group's distinct UIDs, or a failed job naming the first unmapped UID.

    ``uids`` is the group's distinct set, ``rows`` / ``known_rows`` its row count and
    non-NULL UID count: a missing UID is as much an error as an unknown one.
    The lookup runs once per group and not once per row.
    """
    table = literal_map(names)
    unmapped = F.filter(uids, lambda u: F.try_element_at(table, u).isNull())
    culprit = F.coalesce(
        F.get(unmapped, F.lit(0)), F.when(known_rows < rows, F.lit("NULL"))
    )
    message = rejection(culprit, what)
    return F.when(
        culprit.isNotNull(), F.raise_error(message).cast("array<string>")
    ).otherwise(F.transform(uids, lambda u: F.try_element_at(table, u)))


def rejection(uid: Column, what: str) -> Column:
    """Message with which ``strict_names`` rejects a UID that its dictionary lacks."""
    return F.concat(F.lit(f"Unmapped {what}: "), F.coalesce(uid, F.lit("NULL")))


def rejected_groups(df: DataFrame, key: str, column: str, names: Mapping[str, str], what: str) -> DataFrame:
    """Groups that ``strict_names`` would fail on, with its message for the first culprit of each.

    Rows are hashed to distinct (group, UID) first.
    """
    counted = df.groupBy(key, F.col(column).alias("uid")).agg(F.count(F.lit(1)).alias("rows"))
    known = F.coalesce(F.col("uid").isin(*names), F.lit(False))
    return (
        counted.where(~known)
        .groupBy(key)
        .agg(rejection(F.min("uid"), what).alias("message"), F.sum("rows").alias("rows"))
    )


def unknown_codes(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Every UID the dictionary lacks, with its row count (NULL counts as missing).

    The rows are counted per UID first, so the anti join sees one row per UID; the
    dictionary becomes a literal list in the plan.
    """
    counted = df.groupBy(F.col(column).alias("uid")).agg(F.count(F.lit(1)).alias("rows"))
    known = F.coalesce(F.col("uid").isin(*names), F.lit(False))
    return counted.where(~known)
