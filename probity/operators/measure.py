"""Turn a list of checks into one table of metrics.

All row rules of a dataset share one aggregate and so one scan, whatever their
number. A unique key or a foreign key alone is a grouping that reads its key columns
only. Where a table would be scanned for rules and for keys, all checks become one grouping
instead, for which each table is scanned once; see ``tally``. Every grouping is
combined on the map side, so a key that holds a third of the rows reaches the
shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import fold_nan, pass_rate, quoted, ticked
from probity.functions.missing import folded
from probity.model import Check, ForeignKey, UniqueKey
from probity.operators import tally

LEVEL = """CASE WHEN affected_rows > 0 THEN
  CASE WHEN above_pct IS NULL OR affected_rows * 100 > total_rows * above_pct
  THEN level ELSE otherwise END END AS severity"""


def _bound(seq: int, check: Check, affected: str, total: str) -> str:
    """A check as a struct of its fixed texts and its two counts."""
    rule, severity = check.rule, check.rule.severity
    above = "NULL" if severity.above_pct is None else severity.above_pct
    otherwise = "NULL" if severity.otherwise is None else quoted(severity.otherwise)
    return f"""named_struct(
      'check_seq', {seq}L, 'dataset', {quoted(check.dataset)},
      'dimension', {quoted(rule.dimension)}, 'field', {quoted(rule.field)},
      'description', {quoted(rule.description)},
      'affected_rows', {affected}, 'total_rows', {total},
      'above_pct', CAST({above} AS INT), 'level', {quoted(severity.level)},
      'otherwise', CAST({otherwise} AS STRING))"""


def _count_if(name: str, violated: str | Column) -> Column:
    if isinstance(violated, Column):
        return F.count_if(violated).alias(name)
    return F.expr(f"count_if({violated}) AS {name}")


def _row_rules(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    counts = [_count_if(f"c{seq}", check.rule.violated) for seq, check in checks]
    counted = fold_nan(df).agg(F.expr("count(1) AS total_rows"), *counts)
    rows = ", ".join(_bound(seq, check, f"c{seq}", "total_rows") for seq, check in checks)
    return counted.selectExpr(f"inline(array({rows}))")


def _from_keys(per_key: DataFrame, found: Sequence[tuple[int, Check, str, str]]) -> DataFrame:
    """Metrics out of rows per key: (position, check, failing keys, column of row counts)."""
    sums = []
    for seq, _, failing, rows in found:
        sums += [
            f"coalesce(sum(CASE WHEN {failing} THEN {rows} END), 0L) AS c{seq}",
            f"coalesce(sum({rows}), 0L) AS t{seq}",
        ]
    metrics = ", ".join(_bound(seq, check, f"c{seq}", f"t{seq}") for seq, check, _, _ in found)
    return per_key.selectExpr(*sums).selectExpr(f"inline(array({metrics}))")


def key_columns(df: DataFrame, keys: Sequence[str], digest: bool = False) -> list[str]:
    """The key columns as they are grouped: NaN folded, text and bytes digested if asked."""
    long = [digest and isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType)) for k in keys]
    return [
        f"unhex(sha2(CAST({folded(df, k)} AS BINARY), 256))" if is_long else folded(df, k)
        for k, is_long in zip(keys, long, strict=True)
    ]


def key_counts(df: DataFrame, keys: Sequence[str], digest: bool = False) -> DataFrame:
    """Rows per key, as the key columns and ``n``."""
    named = zip(key_columns(df, keys, digest), keys, strict=True)
    narrow = df.selectExpr(*[f"{column} AS {ticked(k)}" for column, k in named])
    return narrow.groupBy(*[ticked(k) for k in keys]).agg(F.expr("count(1) AS n"))


def _unique_key(df: DataFrame, seq: int, check: Check) -> DataFrame:
    columns = key_columns(df, check.rule.keys, check.rule.digest)
    names = [f"k{i}" for i in range(len(columns))]  # a key column may be called n itself
    narrow = df.selectExpr(*[f"{column} AS {name}" for column, name in zip(columns, names, strict=True)])
    per_key = narrow.groupBy(*names).agg(F.expr("count(1) AS n"))
    return _from_keys(per_key, [(seq, check, "n > 1", "n")])


_MOMENTS = (T.DateType, T.TimestampNTZType, T.TimestampType)
_TRIMMED = "CASE WHEN instr({0}, '.') > 0 THEN rtrim('.', rtrim('0', {0})) ELSE {0} END"


def comparable(df: DataFrame, name: str, other: T.DataType) -> str:
    """The column as it is compared with a key of type ``other``, the same on both sides.

    Numbers meet as whole numbers, decimals wide enough for both (as text, if there
    is none) or doubles; dates and times as the one that has more; and whatever
    meets a text as text.
    """
    own, column = df.schema[name].dataType, folded(df, name)
    kinds = (own, other)
    if all(isinstance(t, T.NumericType) for t in kinds):
        if all(isinstance(t, T.IntegralType) for t in kinds):
            return f"CAST({column} AS BIGINT)"
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in kinds):
            return f"(CAST({column} AS DOUBLE) + 0D)"  # -0 is 0
        exact = [t if isinstance(t, T.DecimalType) else T.DecimalType(20, 0) for t in kinds]
        scale = max(t.scale for t in exact)
        whole = max(t.precision - t.scale for t in exact)
        if whole + scale <= 38:
            return f"CAST({column} AS DECIMAL({whole + scale}, {scale}))"
        return _TRIMMED.format(f"CAST({column} AS STRING)")
    if own != other and all(isinstance(t, _MOMENTS) for t in kinds):
        zoned = any(isinstance(t, T.TimestampType) for t in kinds)
        return f"CAST({column} AS {'TIMESTAMP' if zoned else 'TIMESTAMP_NTZ'})"
    return column if own == other else f"CAST({column} AS STRING)"


def key_presence(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Per key: ``n`` child rows and ``m`` parent rows.

    Child and parent are stacked and grouped once. No side is built into a hash
    table or broadcast, and repeated keys on either side collapse before the
    shuffle. The NULL key is kept, so that the counts add up to the whole tables.
    """
    child_type, parent_type = child.schema[key].dataType, parent.schema[parent_key].dataType
    child_key = comparable(child, key, parent_type)
    parent_key = comparable(parent, parent_key, child_type)
    children = child.selectExpr(f"{child_key} AS key", "1L AS n", "0L AS m")
    parents = parent.selectExpr(f"{parent_key} AS key", "0L AS n", "1L AS m")
    return (
        children.union(parents).groupBy("key").agg(F.expr("sum(n) AS n"), F.expr("sum(m) AS m"))
    )


def is_orphan(key: str) -> str:
    return f"{ticked(key)} IS NOT NULL AND m = 0"


def _foreign_key(
    tables: Mapping[str, DataFrame], seq: int, check: Check, unique: tuple[int, Check] | None
) -> DataFrame:
    """A foreign key, and with it the unique key it points to if that is checked too."""
    rule = check.rule
    child, parent = tables[check.dataset], tables[rule.parent]
    found = [(seq, check, is_orphan("key"), "n")]
    if unique:
        found.append((*unique, "m > 1", "m"))
    return _from_keys(key_presence(child, parent, rule.key, rule.parent_key), found)


def _is_target(tables: Mapping[str, DataFrame], foreign: ForeignKey, check: Check) -> bool:
    """Whether a unique key is what the foreign key points to, and grouping it as text is exact."""
    if check.dataset != foreign.parent or check.rule.keys != (foreign.parent_key,):
        return False
    key_type = tables[foreign.parent].schema[foreign.parent_key].dataType
    return isinstance(key_type, (T.StringType, T.IntegralType))


def _scans_again(checks: Sequence[Check]) -> bool:
    """Whether a dataset that is scanned for row rules would be scanned for keys too.

    Key columns alone are narrow scans, which cost less than keys as text.
    """
    with_rules = {check.dataset for check in checks if not isinstance(check.rule, (UniqueKey, ForeignKey))}
    keys = {check.dataset for check in checks if isinstance(check.rule, (UniqueKey, ForeignKey))}
    keys |= {check.rule.parent for check in checks if isinstance(check.rule, ForeignKey)}
    return bool(with_rules & keys)


def measure(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check that applies, those without a finding included.

    ``check_seq`` is the position in ``checks``. A row rule whose columns are
    not all there is left out; a missing key column raises.
    """
    if _scans_again(checks) and tally.all_plain(checks, tables):
        applies = tally.applying(checks, tables)
        if not any(applies):
            raise ValueError("no check applies to the given tables")
        return graded(tally.counts(tally.tally_of(checks, tables), checks, applies, _bound))
    row_rules: dict[str, list[tuple[int, Check]]] = {}
    unique_keys: list[tuple[int, Check]] = []
    foreign_keys: list[tuple[int, Check]] = []
    for seq, check in enumerate(checks, 1):
        rule = check.rule
        if isinstance(rule, UniqueKey):
            unique_keys.append((seq, check))
        elif isinstance(rule, ForeignKey):
            foreign_keys.append((seq, check))
        elif set(rule.needs) <= set(tables[check.dataset].columns):
            row_rules.setdefault(check.dataset, []).append((seq, check))

    fused = [_row_rules(tables[name], bound) for name, bound in row_rules.items()]
    parts = []
    for seq, check in foreign_keys:
        target = next((u for u in unique_keys if _is_target(tables, check.rule, u[1])), None)
        if target:
            unique_keys.remove(target)
        parts.append(_foreign_key(tables, seq, check, target))
    parts += [_unique_key(tables[check.dataset], seq, check) for seq, check in unique_keys]
    if not fused and not parts:
        raise ValueError("no check applies to the given tables")
    return graded(reduce(DataFrame.union, fused + parts))


def graded(counted: DataFrame) -> DataFrame:
    """Metrics out of counted checks: pass rate, and severity where rows fail."""
    return counted.selectExpr(
        "check_seq",
        "dataset",
        "dimension",
        "field",
        "description",
        "affected_rows",
        "total_rows",
        f"{pass_rate('affected_rows', 'total_rows')} AS pass_rate",
        LEVEL,
    )


def issues(metrics: DataFrame) -> DataFrame:
    """The metrics with at least one failing row."""
    return metrics.filter("affected_rows > 0")
