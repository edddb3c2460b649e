"""Which injected defects which checks catch.

A bit mask of the defects of each row is carried beside the data. The rows become
the entries of their checks, as for measuring, and are counted by check, key and
mask; the checks' results then say of each mask how many of its rows were caught.
Keys of the parents' rows count as usual.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.functions import quoted, ticked
from probity.model import Check, ForeignKey, UniqueKey
from probity.operators import tally

MASK = "__mask"


def detection(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], dataset: str, mask: str, defects: Sequence[str]
) -> DataFrame:
    """One row per defect of ``dataset`` and check of it that applies: injected, caught, missed rows.

    ``defects`` names the bits of the column ``mask``. A row is caught by a check if it
    breaks its rule, shares its key with another, or has a key that its parent lacks.
    Every table is scanned once.
    """
    if not tally.all_plain(checks, tables):
        raise ValueError("keys of nested types have no text")
    names = tally.datasets_of(checks)
    parts = []
    for name in names:
        df = tables[name]
        own = F.expr(f"coalesce({ticked(mask)}, 0L)") if name == dataset else F.lit(0).cast("long")
        parts.append(tally.entries(df.withColumn(MASK, own), name, checks, tables, names, keep=[MASK]))
    counted = reduce(DataFrame.union, parts).groupBy("slot", "key", MASK).agg(
        F.sum("n").alias("n"), F.sum("m").alias("m")
    )
    per_key = counted.groupBy("slot", "key").agg(
        F.sum("n").alias("rows"),
        F.sum("m").alias("parents"),
        F.collect_list(F.struct(F.col(MASK).alias("mask"), "n")).alias("parts"),  # as many as there are masks
    )
    unique = [s for s, c in enumerate(checks, 1) if isinstance(c.rule, UniqueKey)]
    foreign = [s for s, c in enumerate(checks, 1) if isinstance(c.rule, ForeignKey)]

    def among(slots: Sequence[int]) -> str:
        return f"slot IN ({', '.join(map(str, slots))})" if slots else "false"

    caught = f"""CASE WHEN {among(unique)} THEN rows > 1
      WHEN {among(foreign)} THEN key IS NOT NULL AND parents = 0 ELSE true END"""
    by_mask = per_key.filter(caught).selectExpr("slot", "explode(parts) AS part")
    by_mask = by_mask.groupBy("slot", "part.mask").agg(F.sum("part.n").alias("n"))
    bits = ", ".join(f"{place}" for place in range(len(defects)))
    by_defect = (
        by_mask.selectExpr("slot", "mask", "n", f"explode(array({bits})) AS defect")
        .filter("shiftright(mask, defect) & 1 = 1")
        .groupBy("slot", "defect")
        .agg(F.sum("n").alias("n"))
    )
    found = by_defect.agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("slot", "defect"), "n"))).alias("found")
    )
    applies = tally.applying(checks, tables)
    rows = [
        f"struct({place} AS place, {quoted(defect)} AS defect, {slot}L AS check_seq, "
        f"{quoted(check.rule.dimension)} AS dimension, {quoted(check.rule.field)} AS field)"
        for place, defect in enumerate(defects)
        for slot, check in enumerate(checks, 1)
        if check.dataset == dataset and applies[slot - 1]
    ]

    def hits(slot: str) -> str:
        return f"coalesce(try_element_at(found, struct({slot} AS slot, place AS defect)), 0L)"

    listed = found.selectExpr("found", f"inline(array({', '.join(rows)}))").selectExpr(
        "defect",
        "check_seq",
        "dimension",
        "field",
        f"{hits(str(tally.total_slot(names, dataset)))} AS injected",
        f"{hits('CAST(check_seq AS INT)')} AS caught",
    )
    return listed.selectExpr("*", "injected - caught AS missed")
