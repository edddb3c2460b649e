"""All checks of several tables out of one scan of each.

A row becomes a few narrow entries: one that counts it, one for each row rule it
breaks, and one with the key for each unique or foreign key it takes part in. An
entry has the number of its check, and keys of all types are texts. One grouping by
number and key, combined before the shuffle, then has everything: how often each key
stands in child and parent, and the counts of rules as keys that are NULL. Entries
of any parts of the tables add up, so counted parts can be kept and merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import fold_nan, quoted
from probity.functions.missing import folded
from probity.model import Check, ForeignKey, UniqueKey

TALLY_SCHEMA = T.StructType(
    [
        T.StructField("slot", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("m", T.LongType()),
    ]
)
_NO_TEXT = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.NullType)


def is_plain(kind: T.DataType) -> bool:
    """Whether keys of the type have a text of their own for each value."""
    return not isinstance(kind, _NO_TEXT)


def key_text(column: str, kind: T.DataType, digest: bool = False) -> str:
    """A key as text: equal where the keys are, NULL where the key is."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"CAST(({column} + CAST(0 AS {kind.simpleString()})) AS STRING)"  # -0 is 0
    if isinstance(kind, T.TimestampType):
        return f"CAST(unix_micros({column}) AS STRING)"
    if isinstance(kind, (T.BinaryType, T.StringType)):
        if digest:
            return f"sha2(CAST({column} AS BINARY), 256)"
        return f"hex({column})" if isinstance(kind, T.BinaryType) else column
    return f"CAST({column} AS STRING)"


def keys_text(df: DataFrame, keys: Sequence[str], digest: bool = False) -> str:
    """Several columns as one text that tells any two lists of values apart."""
    texts = [key_text(folded(df, k), df.schema[k].dataType, digest) for k in keys]
    if len(texts) == 1:
        return texts[0]
    parts = [f"coalesce(concat(char_length({t}), ':', {t}), '-')" for t in texts]
    return f"concat_ws(',', {', '.join(parts)})"


def total_slot(datasets: Sequence[str], name: str) -> int:
    """The number under which the rows of a dataset are counted."""
    return -1 - datasets.index(name)


def _entry(slot: int, key: Column | None = None, n: int = 1, m: int = 0) -> Column:
    text = F.lit(None).cast("string") if key is None else key
    return F.struct(
        F.lit(slot).alias("slot"),
        text.alias("key"),
        F.lit(n).cast("long").alias("n"),
        F.lit(m).cast("long").alias("m"),
    )


def entries(
    df: DataFrame,
    name: str,
    checks: Sequence[Check],
    tables: Mapping[str, DataFrame],
    datasets: Sequence[str],
    more: Sequence[Column] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """The entries of the rows of ``df``, which are rows of the dataset ``name``.

    ``tables`` has the types that foreign keys are compared by; ``more`` are further
    entries of each row, which may be NULL. Columns of ``keep`` stay beside the entries.
    """
    from probity.operators.measure import comparable

    found = [_entry(total_slot(datasets, name)), *more]

    def text(column: str) -> Column:
        kind = df.selectExpr(f"{column} AS k").schema["k"].dataType
        return F.expr(key_text(column, kind))

    for slot, check in enumerate(checks, 1):
        rule = check.rule
        if isinstance(rule, ForeignKey):
            child = tables[check.dataset].schema[rule.key].dataType
            parent = tables[rule.parent].schema[rule.parent_key].dataType
            if check.dataset == name:
                found.append(_entry(slot, text(comparable(df, rule.key, parent))))
            if rule.parent == name:
                found.append(_entry(slot, text(comparable(df, rule.parent_key, child)), 0, 1))
        elif check.dataset != name:
            continue
        elif isinstance(rule, UniqueKey):
            found.append(_entry(slot, F.expr(keys_text(df, rule.keys, rule.digest))))
        elif set(rule.needs) <= set(df.columns):
            violated = rule.violated if isinstance(rule.violated, Column) else F.expr(rule.violated)
            found.append(F.when(violated, _entry(slot)))
    return fold_nan(df).select(*keep, F.inline(F.filter(F.array(*found), lambda e: e.isNotNull())))


def tally(counted: DataFrame) -> DataFrame:
    """Entries or tallies added up."""
    return counted.groupBy("slot", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def tally_of(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    names = datasets_of(checks)
    parts = [entries(tables[name], name, checks, tables, names) for name in names]
    return tally(reduce(DataFrame.union, parts))


def datasets_of(checks: Sequence[Check]) -> list[str]:
    """The datasets that checks are about, those of foreign keys' parents included."""
    names: dict[str, None] = {}
    for check in checks:
        names[check.dataset] = None
        if isinstance(check.rule, ForeignKey):
            names[check.rule.parent] = None
    return list(names)


def applying(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> list[bool]:
    """Which checks apply: a row rule needs all its columns."""
    return [
        isinstance(c.rule, (UniqueKey, ForeignKey)) or set(c.rule.needs) <= set(tables[c.dataset].columns)
        for c in checks
    ]


def counts(
    added_up: DataFrame,
    checks: Sequence[Check],
    applies: Sequence[bool],
    bound: Callable[[int, Check, str, str], str],
) -> DataFrame:
    """The counted checks out of a tally, one row each.

    ``bound`` writes a check as a struct, given its number, affected and total rows.
    """
    names = datasets_of(checks)
    per_slot = added_up.groupBy("slot").agg(
        F.sum("n").alias("rows"),
        F.expr("sum(CASE WHEN n > 1 THEN n END)").alias("repeated"),
        F.expr("sum(CASE WHEN key IS NOT NULL AND m = 0 THEN n END)").alias("orphaned"),
    )
    whole = per_slot.agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("rows", "repeated", "orphaned")))).alias("found")
    )

    rows = []
    for slot, check in enumerate(checks, 1):
        if applies[slot - 1]:
            kind = {ForeignKey: "orphaned", UniqueKey: "repeated"}.get(type(check.rule), "rows")
            total = total_slot(names, check.dataset)
            rows.append(f"struct({bound(slot, check, '0L', '0L')} AS c, {quoted(kind)} AS kind, {total} AS total)")
    listed = whole.selectExpr("found", f"inline(array({', '.join(rows)}))")
    own = "try_element_at(found, CAST(c.check_seq AS INT))"
    affected = f"CASE kind WHEN 'rows' THEN {own}.rows WHEN 'repeated' THEN {own}.repeated ELSE {own}.orphaned END"
    return listed.selectExpr(
        "c.check_seq",
        "c.dataset",
        "c.dimension",
        "c.field",
        "c.description",
        f"coalesce({affected}, 0L) AS affected_rows",
        "coalesce(try_element_at(found, total).rows, 0L) AS total_rows",
        "c.above_pct",
        "c.level",
        "c.otherwise",
    )


def all_plain(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> bool:
    """Whether every key column is of a type that ``key_text`` takes."""
    kinds = []
    for check in checks:
        rule = check.rule
        if isinstance(rule, UniqueKey):
            kinds += [tables[check.dataset].schema[k].dataType for k in rule.keys]
        elif isinstance(rule, ForeignKey):
            kinds.append(tables[check.dataset].schema[rule.key].dataType)
            kinds.append(tables[rule.parent].schema[rule.parent_key].dataType)
    return all(map(is_plain, kinds))
