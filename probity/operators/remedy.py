"""Remediation: drop bad rows, then keep the first row of each key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.functions import retention_pct, ticked
from probity.operators import membership
from probity.operators.measure import key_columns, key_counts
from probity.session import scratch_dir


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form one group.

    ``order_by`` should leave no ties between rows that differ. Catalyst cuts
    each map task down to one row per key before the shuffle, so a key that
    holds a third of the rows arrives as one row per map task.
    """
    key, order = (", ".join(ticked(c) for c in names) for names in (keys, order_by))
    place = f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS __place"
    return df.selectExpr("*", place).filter("__place = 1").drop("__place")


def keep_first_late(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """The rows of ``keep_first``, found out of narrow rows: whole rows aren't shuffled.

    ``row_id`` tells all rows apart and is never NULL, such as file and row index.
    Keys with several rows are counted and written first; without any the table is
    returned as it is. Of the rows of those keys, all but the least by order are
    written by their ids, and the table is read without them. Spark makes that a
    broadcast where the ids are few enough for its own threshold; only beyond it do
    whole rows meet the ids in a shuffle. The counting runs when this is called.
    """
    narrow = df.select(*[ticked(c) for c in dict.fromkeys([*keys, *order_by, *row_id])])
    repeated = membership.settle(key_counts(narrow, keys), keys, "n > 1")
    if not repeated.size:
        repeated.drop()
        return df
    rows = membership.rows_in(narrow, key_columns(narrow, keys), repeated)
    order, ids = (", ".join(ticked(c) for c in names) for names in ([*order_by, *row_id], row_id))
    first = rows.groupBy(*[ticked(k) for k in keys]).agg(
        F.expr(f"min(struct(struct({order}) AS place, struct({ids}) AS id)) AS first")
    )
    kept = first.select(F.col("first.id").alias("__kept"))
    own = rows.selectExpr(f"struct({ids}) AS id")
    lost = own.join(kept, F.expr("id = __kept"), "left_anti")
    path = f"{scratch_dir(df.sparkSession)}/lost"
    lost.write.parquet(path)
    gone = df.sparkSession.read.schema(lost.schema).parquet(path).withColumnRenamed("id", "__lost")
    named = df.select("*", F.expr(f"struct({ids}) AS __id"))
    return named.join(gone, F.expr("__id = __lost"), "left_anti").drop("__id")


def remediate(
    df: DataFrame,
    conditions: Sequence[str],
    keys: Sequence[str],
    order_by: Sequence[str],
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Rows meeting every condition, deduplicated afterwards.

    The order matters: a clean copy survives a dirty one that comes before it. With
    ``row_id`` the first rows are found as in ``keep_first_late``.
    """
    good = reduce(DataFrame.filter, conditions, df)
    return keep_first_late(good, keys, order_by, row_id) if row_id else keep_first(good, keys, order_by)


def cleaning_summary(
    df: DataFrame, conditions: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Row counts before and after ``remediate`` without carrying it out.

    One row per key survives if any of its rows meets the conditions, so a
    count per key is enough; no row has to be sorted or shuffled whole.
    """
    passing = " AND ".join(f"({c})" for c in conditions)
    per_key = df.groupBy(*[ticked(k) for k in keys]).agg(
        F.expr("count(1) AS n"), F.expr(f"count_if({passing}) AS good")
    )
    counted = per_key.selectExpr(
        "coalesce(sum(n), 0L) AS rows_before", "count_if(good > 0) AS rows_after"
    )
    return counted.selectExpr(*cleaning_columns("rows_before", "rows_after"))


def cleaning_columns(before: str, after: str) -> list[str]:
    return [
        f"{before} AS rows_before",
        f"{after} AS rows_after",
        f"{before} - {after} AS rows_removed",
        f"{retention_pct(after, before)} AS retention_pct",
    ]
