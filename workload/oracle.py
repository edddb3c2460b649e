"""The same queries as plain SQL for DuckDB, written independently of the library."""

from __future__ import annotations

RUN = "2001-08-01T02:00:00"
STAMP = "TIMESTAMP '2001-08-01 02:00:00'"

FILINGS = """
filings AS (
  SELECT o_orderkey AS src_seq,
    CASE WHEN o_orderkey % 33 = 5 THEN o_orderkey - 1 ELSE o_orderkey END AS return_id,
    CASE WHEN o_orderkey % 20 = 7 THEN NULL
         WHEN o_orderkey % 25 = 3 THEN CASE WHEN o_orderkey % 40 = 9
           THEN '9' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')
           ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END || 'X'
         WHEN o_orderkey % 40 = 9 THEN '9' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')
         ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS tin,
    o_orderpriority AS tax_type,
    CAST(o_orderdate AS DATE) AS period_start,
    CAST(CASE WHEN o_orderkey % 50 = 21 THEN CAST(o_orderdate AS DATE)
              ELSE CAST(o_orderdate AS DATE) + INTERVAL 30 DAY END AS DATE) AS period_end,
    CAST(CASE WHEN o_orderkey % 33 = 8 THEN DATE '2027-01-01'
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 56 - 5 AS INTEGER) END AS DATE)
      AS filing_date,
    CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Filed' WHEN 'O' THEN 'Overdue' END
      AS filing_status,
    CASE WHEN o_orderkey % 25 = 11 THEN NULL
         WHEN o_orderkey % 33 = 14 THEN -o_totalprice ELSE o_totalprice END AS amount_due,
    o_totalprice * (o_orderkey % 13) / 10 AS amount_paid,
    CASE WHEN o_orderkey % 25 = 17 THEN 'USD' ELSE 'UGX' END AS currency
  FROM orders)"""

REGISTER = """
register AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS tin, c_name AS taxpayer_name,
    c_mktsegment AS sector, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

CLEAN = """
clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY src_seq) AS rn
    FROM filings
    WHERE tin IS NOT NULL AND amount_due IS NOT NULL AND regexp_full_match(tin, '[0-9]{10}')
      AND amount_due >= 0 AND currency = 'UGX' AND filing_date <= DATE '2001-08-01')
  WHERE rn = 1)"""


def _points(num: str, den: str) -> str:
    """num / den rounded to a whole number, ties to even."""
    return (
        f"(({num}) // ({den}) + CASE WHEN 2 * (({num}) % ({den})) > ({den}) "
        f"OR (2 * (({num}) % ({den})) = ({den}) AND (({num}) // ({den})) % 2 = 1) THEN 1 ELSE 0 END)"
    )


RATE = f"{_points('10000 * (total_rows - affected_rows)', 'total_rows')}"

# dataset, dimension, field, description, failing rows, table, severity
HIGH, MEDIUM, LOW = "'HIGH'", "'MEDIUM'", "'LOW'"
OVER_5 = "CASE WHEN affected_rows * 100 > total_rows * 5 THEN 'HIGH' ELSE 'MEDIUM' END"
OVER_2 = "CASE WHEN affected_rows * 100 > total_rows * 2 THEN 'HIGH' ELSE 'MEDIUM' END"
RETURNS_SET, REGISTER_SET = "tax_returns", "taxpayer_register"


def _null(dataset: str, table: str, field: str) -> tuple[str, ...]:
    text = f"Missing values found in '{field}'"
    return (dataset, "Completeness", field, text, f"{field} IS NULL", table, OVER_5)


def _unique(dataset: str, table: str, keys: list[str]) -> tuple[str, ...]:
    text = f"Duplicate records found on key fields: {keys}"
    over = ", ".join(keys)
    return (
        dataset,
        "Uniqueness",
        " + ".join(keys),
        text,
        "copies > 1",
        f"(SELECT count(*) OVER (PARTITION BY {over}) AS copies FROM {table})",
        OVER_2,
    )


def _pattern(dataset: str, table: str) -> tuple[str, ...]:
    return (
        dataset,
        "Validity",
        "tin",
        "TIN must be exactly 10 numeric digits",
        "tin IS NOT NULL AND NOT regexp_full_match(tin, '[0-9]{10}')",
        table,
        HIGH,
    )


NULLS = [
    _null(RETURNS_SET, "filings", f)
    for f in ("return_id", "tin", "tax_type", "amount_due", "filing_date")
]
VALIDITY = [
    (
        RETURNS_SET,
        "Validity",
        "amount_due",
        "Negative tax amounts are not permitted",
        "amount_due < 0",
        "filings",
        HIGH,
    ),
    (
        RETURNS_SET,
        "Validity",
        "currency",
        "Non-UGX currency — all domestic filings must use UGX",
        "currency <> 'UGX'",
        "filings",
        HIGH,
    ),
    (
        RETURNS_SET,
        "Validity",
        "filing_status",
        "Filing status must be one of: {'Amended', 'Filed', 'Overdue', 'Pending'}",
        "filing_status NOT IN ('Filed', 'Pending', 'Overdue', 'Amended')",
        "filings",
        MEDIUM,
    ),
]
CONSISTENCY = [
    (
        RETURNS_SET,
        "Consistency",
        "period_start / period_end",
        "Period end date is not after period start date",
        "period_end <= period_start",
        "filings",
        HIGH,
    ),
    (
        RETURNS_SET,
        "Consistency",
        "filing_date / period_start",
        "Filing date precedes the tax period start date",
        "filing_date < period_start",
        "filings",
        HIGH,
    ),
    (
        RETURNS_SET,
        "Consistency",
        "amount_paid / amount_due",
        "Payment exceeds 150% of amount due — possible data error",
        "amount_paid > amount_due * 1.5",
        "filings",
        MEDIUM,
    ),
]
TIMELINESS = [
    (
        RETURNS_SET,
        "Timeliness",
        "filing_date",
        "Filing dates set in the future — likely a data entry error",
        "filing_date > DATE '2001-08-01'",
        "filings",
        MEDIUM,
    ),
    (
        RETURNS_SET,
        "Timeliness",
        "filing_date + filing_status",
        "Returns still Pending for more than 3 years",
        "date_diff('day', filing_date, DATE '2001-08-01') > 1095 AND filing_status = 'Pending'",
        "filings",
        LOW,
    ),
]
REFERENTIAL = [
    (
        RETURNS_SET,
        "Referential Integrity",
        "tin",
        "TINs in tax_returns not found in the taxpayer register",
        "tin IS NOT NULL AND NOT EXISTS (SELECT 1 FROM register r WHERE r.tin = f.tin)",
        "filings f",
        HIGH,
    )
]
ON_REGISTER = [
    *[_null(REGISTER_SET, "register", f) for f in ("tin", "taxpayer_name", "sector", "region")],
    _pattern(REGISTER_SET, "register"),
    _unique(REGISTER_SET, "register", ["tin"]),
]
EVERY_CHECK = [
    *NULLS,
    *VALIDITY,
    *CONSISTENCY,
    _unique(RETURNS_SET, "filings", ["return_id"]),
    *TIMELINESS,
    *REFERENTIAL,
    *ON_REGISTER,
]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _counted(checks: list[tuple[str, ...]]) -> str:
    parts = []
    for seq, (dataset, dimension, field, text, bad, table, severity) in enumerate(checks, 1):
        parts.append(
            f"SELECT CAST({seq} AS BIGINT) AS check_seq, {_text(dataset)} AS dataset, "
            f"{_text(dimension)} AS dimension, {_text(field)} AS field, "
            f"{_text(text)} AS description, affected_rows, total_rows, "
            f"{severity} AS level FROM (SELECT "
            f"CAST(sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS affected_rows, "
            f"count(*) AS total_rows FROM {table})"
        )
    return " UNION ALL ".join(parts)


def _with_metrics(checks: list[tuple[str, ...]], *tables: str) -> str:
    named = ",".join([*tables, f"counted AS ({_counted(checks)})"])
    return f"""WITH {named},
metrics AS (
  SELECT check_seq, dataset, dimension, field, description, affected_rows, total_rows,
    CAST({RATE} AS BIGINT) AS points, CAST({RATE} AS BIGINT) / 100.0 AS pass_rate,
    CASE WHEN affected_rows > 0 THEN level END AS severity
  FROM counted)"""


ISSUE = "dimension, field, description, affected_rows, total_rows, pass_rate, severity"


def _metrics(checks: list[tuple[str, ...]], *tables: str) -> str:
    return f"{_with_metrics(checks, *tables)} SELECT dataset, {ISSUE} FROM metrics"


DIMENSIONS = """
dimensions(dimension_seq, dimension, text) AS (VALUES
  (1, 'Completeness', 'Required fields must not be null or empty.'),
  (2, 'Validity', 'Values must conform to permitted formats and ranges.'),
  (3, 'Consistency', 'Related fields must be logically coherent with each other.'),
  (4, 'Uniqueness', 'No duplicate records on primary key fields.'),
  (5, 'Timeliness', 'Dates must fall within acceptable windows.'),
  (6, 'Referential Integrity', 'Foreign keys must point to existing records.'))"""

SCORED = f"""{_with_metrics(EVERY_CHECK, FILINGS, REGISTER)},
issues AS (SELECT * FROM metrics WHERE affected_rows > 0),{DIMENSIONS},
summed AS (
  SELECT d.dimension_seq, d.dimension, d.text, CAST(sum(i.points) AS BIGINT) AS s,
    count(i.points) AS c
  FROM dimensions d LEFT JOIN issues i ON d.dimension = i.dimension GROUP BY ALL),
scores AS (
  SELECT dimension_seq, dimension, text,
    CASE WHEN c = 0 THEN 10000 ELSE {_points('s', 'greatest(c, 1)')} END AS points FROM summed),
total AS (
  SELECT {_points('t', '6')} AS points FROM (SELECT CAST(sum(points) AS BIGINT) AS t FROM scores)),
sev AS (
  SELECT count(*) AS total_issues,
    count(*) FILTER (WHERE severity = 'HIGH') AS high_issues,
    count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_issues,
    count(*) FILTER (WHERE severity = 'LOW') AS low_issues FROM issues)"""

BAND = "CASE WHEN {0} >= 95 THEN '{1}' WHEN {0} >= 80 THEN '{2}' ELSE '{3}' END"
STATUS = BAND.format("points / 100.0", "PASS", "MONITOR", "FAIL")
VERDICT = BAND.format("points / 100.0", "GOOD", "MODERATE", "POOR")
RANK = "CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END"
CHOSEN = (
    "dimension IN ('Validity', 'Consistency', 'Timeliness') AND severity IN ('HIGH', 'LOW')"
)
TENTHS = _points("1000 * rows_after", "rows_before")
KEPT = """
kept AS (SELECT (SELECT count(*) FROM filings) AS rows_before,
  (SELECT count(*) FROM clean) AS rows_after)"""
COLUMNS = [
    "src_seq",
    "return_id",
    "tin",
    "tax_type",
    "period_start",
    "period_end",
    "filing_date",
    "filing_status",
    "amount_due",
    "amount_paid",
    "currency",
]


def _null_counts(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {table}"
        for c in COLUMNS
    )


def _stats(table: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS dataset, count(*) FILTER (WHERE tin IS NULL) AS null_keys, "
        "count(*) FILTER (WHERE amount_due < 0) AS negative_amounts, "
        "count(*) FILTER (WHERE currency IS DISTINCT FROM 'UGX') AS other_currency "
        f"FROM {table}"
    )


def _id(name: str, path: str) -> str:
    return f"substr(md5('{name}' || '{RUN}' || '{path}'), 1, 16)"


REGISTERED = [
    ("orders", "raw_file", "orders.parquet", "orders", 6, "Orders"),
    ("orders", "derived", "orders_filed", "orders WHERE o_orderstatus = 'F'", 6, "Filed orders"),
    ("customer", "raw_file", "customer.parquet", "customer", 5, "Customers"),
    ("tax_returns", "derived", "filings", "filings", 11, "Filings with defects"),
    ("taxpayer_register", "derived", "register", "register", 4, "Register of taxpayers"),
    ("tax_returns_clean", "transformed", "clean", "clean", 11, "Clean filings"),
]
DATASETS = "datasets AS (" + " UNION ALL ".join(
    f"SELECT {_id(name, path)} AS dataset_id, '{name}' AS name, '{kind}' AS source_type, "
    f"'{path}' AS file_path, (SELECT count(*) FROM {table}) AS row_count, "
    f"CAST({width} AS BIGINT) AS col_count, {STAMP} AS created_at, '{text}' AS description, "
    f"CAST({seq} AS BIGINT) AS seq"
    for seq, (name, kind, path, table, width, text) in enumerate(REGISTERED)
) + ")"
# Places in REGISTERED; None was never registered.
EDGES = [
    (0, 1, "Selection", "filter"),
    (0, 3, "Defect injection", "corrupt"),
    (1, 3, "Defect injection", "corrupt"),
    (2, 4, "Register build", "join"),
    (None, 4, "Register build", "join"),
    (3, 5, "DQ Remediation", "filter + deduplicate"),
    (4, 5, "DQ Remediation", "filter + deduplicate"),
]


def _end(place: int | None) -> str:
    return repr("0" * 16) if place is None else _id(REGISTERED[place][0], REGISTERED[place][2])


EDGE_ROWS = "edges AS (" + " UNION ALL ".join(
    f"SELECT {_end(source)} AS source, {_end(target)} AS target, "
    f"'{label}' AS label, '{operation}' AS operation, 'success' AS status"
    for source, target, label, operation in EDGES
) + ")"
CATALOGUE = f"WITH {FILINGS},{REGISTER},{CLEAN},{DATASETS},{EDGE_ROWS}"


def _digits(text: str, start: int) -> str:
    """The number in four hexadecimal digits of the MD5 of a text."""
    return " + ".join(
        f"{16 ** (3 - i)} * (strpos('0123456789abcdef', substr(md5({text}), {start + i}, 1)) - 1)"
        for i in range(4)
    )


SEED = "CAST(src_seq AS VARCHAR) || '#' || CAST(copy AS VARCHAR)"



def _foreign(child: str, key: str, parent: str, parent_key: str, text: str) -> tuple[str, ...]:
    lost = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = f.{key})"
    bad = f"{key} IS NOT NULL AND {lost}"
    return (child, "Referential Integrity", key, text, bad, f"{child} f", HIGH)


FOREIGN = [
    _foreign("orders", "o_custkey", "customer", "c_custkey", "order of no customer"),
    _foreign("lineitem", "l_orderkey", "orders", "o_orderkey", "line of no order"),
    _foreign("events", "user_id", "customer", "c_custkey", "event of no customer"),
    _foreign("labels", "doc_id", "documents", "doc_id", "label of no document"),
    _unique("orders", "orders", ["o_orderkey"]),
    _unique("customer", "customer", ["c_custkey"]),
    _unique("documents", "documents", ["doc_id"]),
]

def _steps(steps: list[tuple]) -> str:
    """The stored steps of a run: name, table whose rows it wrote, try, status."""

    def row(seq: int, step: str, table: str | None, attempt: int = 1, status: str = "success") -> str:
        rows = f"(SELECT count(*) FROM {table})" if table else "CAST(NULL AS BIGINT)"
        return (
            f"SELECT CAST({seq} AS BIGINT) AS seq, '{step}' AS step, CAST({attempt} AS BIGINT) AS attempt, "
            f"'{status}' AS status, {rows} AS rows, true AS timed, true AS in_turn"
        )

    found = " UNION ALL ".join(row(seq, *step) for seq, step in enumerate(steps))
    return f"WITH {FILINGS},{REGISTER},{CLEAN} {found}"


_HITS = {
    "copied key": "src_seq % 33 = 5", "no customer": "src_seq % 40 = 9", "orphan": "src_seq % 25 = 3",
    "missing key": "src_seq % 20 = 7", "empty period": "src_seq % 50 = 21", "future": "src_seq % 33 = 8",
    "negative": "src_seq % 33 = 14", "missing amount": "src_seq % 25 = 11", "currency": "src_seq % 25 = 17",
    "none": "src_seq % 60 = 13",
}


def _detection() -> str:
    """Rows of each defect that each check on filings finds."""
    checks = [c for c in EVERY_CHECK if c[0] == RETURNS_SET]
    flags = []
    for seq, (_, dimension, _, _, bad, _, _) in enumerate(checks, 1):
        if dimension == "Uniqueness":
            bad = "count(*) OVER (PARTITION BY return_id) > 1"
        flags.append(f"coalesce({bad}, false) AS c{seq}")
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS defect, CAST({seq} AS BIGINT) AS check_seq, {_text(check[1])} AS dimension, "
        f"{_text(check[2])} AS field, count(*) FILTER ({hit}) AS injected, count(*) FILTER ({hit} AND c{seq}) AS caught, "
        f"count(*) FILTER ({hit} AND NOT c{seq}) AS missed FROM flagged"
        for name, hit in _HITS.items()
        for seq, check in enumerate(checks, 1)
    )
    return f"WITH {FILINGS},{REGISTER}, flagged AS (SELECT src_seq, {', '.join(flags)} FROM filings f) {rows}"


ORACLE: dict[str, str] = {
    "first_per_key_late": f"""WITH {FILINGS} SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY src_seq) AS rn FROM filings) WHERE rn = 1""",
    "clean_filings_late": f"WITH {FILINGS},{CLEAN} SELECT * FROM clean",
    "missing_footers": f"""WITH {FILINGS},{CLEAN},
a AS ({_null_counts('filings')}), b AS ({_null_counts('clean')})
SELECT column_name, a.nulls AS raw_nulls, b.nulls AS clean_nulls, a.nulls - b.nulls AS resolved
FROM a FULL JOIN b USING (column_name)""",
    "inject_detection": _detection(),
    "audit_sample_third": """
WITH placed AS (SELECT l_orderkey, row_number() OVER (ORDER BY md5(CAST(l_orderkey AS VARCHAR)),
    md5('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}')) AS place FROM lineitem)
SELECT l_orderkey, count(*) AS lines FROM placed WHERE place <= (SELECT count(*) // 3 FROM lineitem) GROUP BY l_orderkey""",
    "dq_completeness": _metrics(NULLS, FILINGS),
    "dq_validity": _metrics(VALIDITY, FILINGS),
    "dq_key_pattern": _metrics(
        [_pattern(REGISTER_SET, "register"), _pattern(RETURNS_SET, "filings")], FILINGS, REGISTER
    ),
    "dq_consistency": _metrics(CONSISTENCY, FILINGS),
    "dq_uniqueness": _metrics([_unique(RETURNS_SET, "filings", ["return_id"])], FILINGS),
    "dq_uniqueness_composite": _metrics(
        [_unique("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])]
    ),
    "dq_timeliness": _metrics(TIMELINESS, FILINGS),
    "dq_referential": _metrics(REFERENTIAL, FILINGS, REGISTER),
    "dq_orphan_rows": f"""WITH {FILINGS},{REGISTER}
SELECT * FROM filings f
WHERE tin IS NOT NULL AND NOT EXISTS (SELECT 1 FROM register r WHERE r.tin = f.tin)""",
    "dq_duplicate_rows": f"""WITH {FILINGS}
SELECT * EXCLUDE (copies) FROM (
  SELECT *, count(*) OVER (PARTITION BY return_id) AS copies FROM filings) WHERE copies > 1""",
    "dq_metrics_all": f"""{_with_metrics(EVERY_CHECK, FILINGS, REGISTER)}
SELECT check_seq, dataset, {ISSUE} FROM metrics""",
    "dq_issues": f"""{_with_metrics(EVERY_CHECK, FILINGS, REGISTER)}
SELECT check_seq, dataset, {ISSUE} FROM metrics WHERE affected_rows > 0""",
    "dq_dimension_scores": f"""{SCORED}
SELECT CAST(dimension_seq AS BIGINT) AS dimension_seq, dimension, points / 100.0 AS score
FROM scores""",
    "dq_overall": f"""{SCORED}
SELECT points / 100.0 AS overall_dq_score, total_issues, high_issues, medium_issues, low_issues
FROM total, sev""",
    "clean_filings": f"WITH {FILINGS},{CLEAN} SELECT * FROM clean",
    "clean_summary": f"""WITH {FILINGS},{CLEAN},{KEPT}
SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
  {TENTHS} / 10.0 AS retention_pct FROM kept""",
    "first_per_key": """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
    "missing_before_after": f"""WITH {FILINGS},{CLEAN},
a AS ({_null_counts('filings')}), b AS ({_null_counts('clean')})
SELECT column_name, a.nulls AS raw_nulls, b.nulls AS clean_nulls, a.nulls - b.nulls AS resolved
FROM a FULL JOIN b USING (column_name)""",
    "quick_stats": f"""WITH {FILINGS},{CLEAN}
{_stats('filings', 'raw')} UNION ALL {_stats('clean', 'clean')}""",
    "sample_rows": f"WITH {FILINGS} SELECT * FROM filings ORDER BY src_seq LIMIT 100",
    "issue_log": f"""{SCORED}
SELECT row_number() OVER (ORDER BY {RANK}, check_seq) AS issue_no, {ISSUE},
  format('{{:,}}', affected_rows) AS affected_text,
  CAST(CAST(pass_rate AS DOUBLE) AS VARCHAR) || '%' AS pass_text FROM issues""",
    "issue_explorer": f"""{SCORED}
SELECT (SELECT count(*) FROM issues WHERE {CHOSEN}) AS shown,
  (SELECT count(*) FROM issues) AS of_total, {ISSUE} FROM issues WHERE {CHOSEN}""",
    "explorer_count": f"""{SCORED}
SELECT count(*) FILTER (WHERE {CHOSEN}) AS shown, count(*) AS of_total FROM issues""",
    "explorer_dimensions": f"{SCORED} SELECT DISTINCT dimension FROM issues",
    "dimension_bands": f"""{SCORED}
SELECT CAST(dimension_seq AS BIGINT) AS dimension_seq, dimension, points / 100.0 AS score,
  {STATUS} AS status FROM scores""",
    "overall_verdict": f"""{SCORED}
SELECT points / 100.0 AS overall_dq_score, {VERDICT} AS verdict FROM total""",
    "severity_summary": f"""{SCORED}
SELECT 'HIGH' AS severity, high_issues AS issues FROM sev
UNION ALL SELECT 'MEDIUM', medium_issues FROM sev UNION ALL SELECT 'LOW', low_issues FROM sev""",
    "dimension_detail": f"""{SCORED}
SELECT s.dimension, s.text AS description, s.points / 100.0 AS score,
  {STATUS.replace('points', 's.points')} AS status, i.field, i.description AS issue,
  i.affected_rows FROM scores s LEFT JOIN issues i ON s.dimension = i.dimension""",
    "kpi_row": f"""{SCORED},{CLEAN},{KEPT}
SELECT points / 100.0 AS overall_dq_score, total_issues, high_issues, medium_issues, low_issues,
  {TENTHS} / 10.0 AS retention_pct FROM total, sev, kept""",
    "report_metadata": f"""{SCORED}
SELECT 'August 01, 2001' AS report_date, '{RUN}' AS pipeline_run,
  'Tax Returns, Taxpayer Register' AS datasets_assessed, total_issues,
  'INTERNAL' AS classification FROM sev""",
    "lineage_catalogue": f"{CATALOGUE} SELECT * FROM datasets",
    "lineage_catalogue_compacted": f"{CATALOGUE} SELECT * FROM datasets",
    "lineage_reach": """
WITH RECURSIVE edges AS (
  SELECT lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS source, o_orderkey AS target
  FROM orders), walk AS (
  SELECT source, target, 1 AS steps FROM edges WHERE source IS NOT NULL
  UNION ALL SELECT w.source, e.target, w.steps + 1 FROM walk w JOIN edges e ON e.source = w.target)
SELECT source AS "from", target AS "to", CAST(min(steps) AS BIGINT) AS steps FROM walk GROUP BY ALL""",
    "lineage_nodes": f"""{CATALOGUE}
SELECT name AS label, row_count AS rows, source_type AS type, dataset_id AS id FROM datasets""",
    "lineage_flow": f"""{CATALOGUE}
SELECT coalesce(s.name, source) AS source_name, s.row_count AS source_rows, label, operation,
  status, coalesce(t.name, target) AS target_name, t.row_count AS target_rows
FROM edges LEFT JOIN datasets s ON s.dataset_id = source
  LEFT JOIN datasets t ON t.dataset_id = target""",
    "lineage_edges": f"""{CATALOGUE}
SELECT (SELECT count(*) FROM datasets) AS node_count,
  (SELECT CAST(sum(row_count) AS BIGINT) FROM datasets) AS node_rows, source AS "from",
  target AS "to", label, operation, status FROM edges""",
    "dq_run_log": f"""{SCORED}
SELECT substr(md5({_id("tax_returns", "filings")} || '{RUN}'), 1, 16) AS run_id,
  {_id("tax_returns", "filings")} AS dataset_id, points / 100.0 AS overall_score, total_issues,
  high_issues, medium_issues, low_issues, {STAMP} AS run_at FROM total, sev""",
    "inject_defects": """SELECT o_orderkey AS src_seq,
  CASE WHEN o_orderkey % 33 = 5 THEN o_orderkey - 1 ELSE o_orderkey END AS return_id,
  CASE WHEN o_orderkey % 25 = 3 THEN lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || 'X'
       WHEN o_orderkey % 20 = 7 THEN NULL
       ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS tin,
  o_orderpriority AS tax_type, CAST(o_orderdate AS DATE) AS period_start,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS period_end,
  CAST(CASE WHEN o_orderkey % 33 = 8 THEN DATE '2027-01-01'
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 56 - 5 AS INTEGER) END AS DATE)
    AS filing_date,
  CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Filed' WHEN 'O' THEN 'Overdue' END
    AS filing_status,
  CASE WHEN o_orderkey % 25 = 11 THEN NULL
       WHEN o_orderkey % 33 = 14 THEN -o_totalprice ELSE o_totalprice END AS amount_due,
  o_totalprice * (o_orderkey % 13) / 10 AS amount_paid,
  CASE WHEN o_orderkey % 25 <> 17 THEN 'UGX' WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'EUR' END
    AS currency
FROM orders""",
    "audit_sample": """SELECT o_orderkey FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 500""",
    "audit_expand": f"""WITH {FILINGS}, keys AS (
  SELECT return_id, src_seq,
    unnest(range(1, 2 + ({_digits('CAST(src_seq AS VARCHAR)', 1)}) % 3)) AS copy FROM filings)
SELECT substr(md5({SEED}), 1, 12) AS event_id, return_id,
  ['CREATED', 'UPDATED', 'REVIEWED', 'FLAGGED', 'APPROVED'][1 + ({_digits(SEED, 1)}) % 5]
    AS event_type,
  'USR-' || lpad(CAST(10 + ({_digits(SEED, 5)}) % 15 AS VARCHAR), 3, '0') AS user_id,
  CAST(DATE '2024-01-01' + CAST(({_digits(SEED, 9)}) % 366 AS INTEGER) AS TIMESTAMP)
    AS "timestamp" FROM keys""",
    "csv_roundtrip": f"WITH {FILINGS} SELECT * FROM filings",
    "summary_roundtrip": f"""{SCORED},{CLEAN}
SELECT row_number() OVER (ORDER BY check_seq) AS issue_no,
  (SELECT count(*) FROM clean) AS rows_after, {ISSUE} FROM issues""",
    "nat_negative_balance": _metrics(
        [
            (
                "customer",
                "Validity",
                "c_acctbal",
                "Negative account balance",
                "c_acctbal < 0",
                "customer",
                HIGH,
            )
        ]
    ),
    "nat_ship_before_order": _metrics(
        [
            (
                "lineitem",
                "Consistency",
                "l_shipdate / o_orderdate",
                "Line shipped before the date of its order",
                "l_shipdate < o_orderdate",
                "(SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)",
                HIGH,
            )
        ]
    ),
    "nat_foreign_keys": f"""{_with_metrics(FOREIGN)}
SELECT check_seq, dataset, {ISSUE} FROM metrics""",
    "nat_duplicate_text_rows": """SELECT doc_id, lang FROM (
  SELECT doc_id, lang, count(*) OVER (PARTITION BY text) AS copies FROM documents)
WHERE copies > 1""",
    "nat_duplicate_text": _metrics([_unique("documents", "documents", ["text"])]),
    "nat_orphan_rows_typed": " UNION ALL ".join(
        f"""SELECT o_orderkey, '{kind}' AS kind FROM (
  SELECT o_orderkey, CAST(o_custkey AS {kind}) + CASE WHEN o_orderkey % 50 = 0 THEN 0.5 ELSE 0 END AS k
  FROM orders) WHERE NOT EXISTS (SELECT 1 FROM customer WHERE CAST(c_custkey AS {kind}) = k)"""
        for kind in ("DOUBLE", "DECIMAL(20,2)")
    ),
    "csv_roundtrip_text": "SELECT doc_id, ' ' || lang || ' ' AS lang, text FROM documents",
    "csv_roundtrip_types": """
SELECT o_orderkey AS id, CASE o_orderkey % 13 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'None' WHEN 3 THEN 'nan'
    WHEN 4 THEN 'NULL' WHEN 5 THEN chr(92) || 'N' WHEN 6 THEN chr(92) || 'E' WHEN 7 THEN chr(92) WHEN 8 THEN ' x '
    WHEN 9 THEN 'two' || chr(10) || 'lines' WHEN 10 THEN 'say "x", y'
    WHEN 11 THEN 'a' || chr(13) || chr(10) || 'b' END AS told,
  CAST(o_orderkey % 128 AS TINYINT) AS tiny, CAST(o_orderkey % 1000 AS INTEGER) AS small,
  CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS single, o_totalprice / 3 AS price,
  CAST(o_totalprice AS DECIMAL(18, 6)) AS amount, o_orderkey % 2 = 0 AS even, CAST(o_orderdate AS DATE) AS day,
  CAST(o_orderdate AS TIMESTAMP) + to_microseconds(o_orderkey) AS moment, o_orderkey * 1000003 - 1 AS instant_us,
  CASE WHEN o_orderkey % 3 <> 0 THEN hex(o_orderpriority) END AS bytes_hex,
  o_orderstatus || '|-|' || o_orderpriority AS parts, o_custkey AS nested_key,
  CAST(o_orderdate AS TIMESTAMP) + to_microseconds(o_orderkey) AS nested_at
FROM orders""",
    "csv_roundtrip_vectors": """
SELECT vec_id, label, len(embedding) AS n, CAST(embedding[1] AS DOUBLE) AS first,
  CAST(list_sum(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 16777216) AS BIGINT))) AS BIGINT)
    AS total
FROM embeddings""",
    "sample_clean": f"WITH {FILINGS},{CLEAN} SELECT * FROM clean ORDER BY src_seq LIMIT 100",
    "dq_status_hits": _metrics(
        [
            (
                "orders",
                "Validity",
                "o_orderstatus",
                "Order is still open",
                "o_orderstatus NOT IN ('F', 'P')",
                "orders",
                MEDIUM,
            )
        ]
    ),
    "dq_completeness_high": _metrics(
        [_null("orders", "(SELECT nullif(o_orderstatus, 'F') AS status FROM orders)", "status")]
    ),
    "dq_missing_column": _metrics([*VALIDITY[:2], TIMELINESS[0]], FILINGS),
    "clean_summary_moment": f"""WITH {FILINGS}, moments AS (
  SELECT * REPLACE (CAST(filing_date AS TIMESTAMP) + to_hours(CAST(src_seq % 24 AS INTEGER)) AS filing_date)
  FROM filings), clean AS (
  SELECT DISTINCT return_id FROM moments
  WHERE tin IS NOT NULL AND amount_due IS NOT NULL AND regexp_full_match(tin, '[0-9]{{10}}')
    AND amount_due >= 0 AND currency = 'UGX' AND filing_date <= TIMESTAMP '2001-08-01 12:00:00'
), {KEPT}
SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
  {TENTHS} / 10.0 AS retention_pct FROM kept""",
    "missing_one_sided": f"""WITH {FILINGS},{CLEAN}
SELECT 'currency' AS column_name, count(*) - count(currency) AS raw_nulls,
  CAST(NULL AS BIGINT) AS clean_nulls, CAST(NULL AS BIGINT) AS resolved FROM filings
UNION ALL SELECT 'tin', r.n, c.n, r.n - c.n FROM
  (SELECT count(*) - count(tin) AS n FROM filings) r, (SELECT count(*) - count(tin) AS n FROM clean) c
UNION ALL SELECT 'note', NULL, count(*), NULL FROM clean""",
    "company_names": f"""WITH {REGISTER}
SELECT tin, 'Company_' || right(tin, 4) AS taxpayer_name FROM register""",
    "scores_without_issues": f"""WITH {DIMENSIONS}
SELECT CAST(dimension_seq AS BIGINT) AS dimension_seq, dimension, CAST(100 AS DOUBLE) AS score, 'PASS' AS status
FROM dimensions""",
    "detail_without_issues": f"""WITH {DIMENSIONS}
SELECT dimension, text AS description, CAST(100 AS DOUBLE) AS score, 'PASS' AS status,
  CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS issue,
  CAST(NULL AS BIGINT) AS affected_rows FROM dimensions""",
    "report_from_summary": f"""{SCORED},{CLEAN}
SELECT 'flow' AS part, 'tax_returns' AS source_name, (SELECT count(*) FROM filings) AS source_rows,
  'tax_returns_clean' AS target_name, (SELECT count(*) FROM clean) AS target_rows
UNION ALL SELECT 'explorer', NULL, count(*), NULL, count(*) FROM issues""",
    "dq_incremental": """
WITH n AS (SELECT count(*) AS orders, count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) AS open,
    count(*) FILTER (o_totalprice < 0) AS negative,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)) AS lost FROM orders),
twice AS (SELECT coalesce(sum(k) FILTER (k > 1), 0) AS k FROM (SELECT count(*) AS k FROM orders GROUP BY o_orderkey)),
day AS (SELECT coalesce(sum(k) FILTER (k > 1), 0) AS k
  FROM (SELECT count(*) AS k FROM orders GROUP BY o_custkey, o_orderdate)),
people AS (SELECT count(*) AS total, coalesce((SELECT sum(k) FROM (SELECT count(*) AS k FROM customer GROUP BY c_custkey)
  WHERE k > 1), 0) AS k FROM customer),
found(check_seq, field, affected_rows, total_rows, level, above, otherwise) AS (
  SELECT 1, 'o_orderstatus', open, orders, 'MEDIUM', NULL, NULL FROM n
  UNION ALL SELECT 2, 'o_totalprice', negative, orders, 'HIGH', NULL, NULL FROM n
  UNION ALL SELECT 3, 'o_orderkey', k, orders, 'HIGH', 2, 'MEDIUM' FROM n, twice
  UNION ALL SELECT 4, 'o_custkey + o_orderdate', k, orders, 'HIGH', 2, 'MEDIUM' FROM n, day
  UNION ALL SELECT 5, 'o_custkey', lost, orders, 'HIGH', NULL, NULL FROM n
  UNION ALL SELECT 6, 'c_custkey', k, total, 'HIGH', 2, 'MEDIUM' FROM people)
SELECT CAST(check_seq AS BIGINT) AS check_seq, field, CAST(affected_rows AS BIGINT) AS affected_rows, total_rows,
  CASE WHEN affected_rows > 0 THEN CASE WHEN above IS NULL OR affected_rows * 100 > total_rows * above THEN level
    ELSE otherwise END END AS severity, '1+1+2+3' AS files_read
FROM found""",
    "run_steps": _steps([
        ("begin", None), ("taxpayer_register", "register"), ("tax_returns", "filings"), ("register", None), ("check", None),
        ("log", None), ("clean", "clean"), ("register_clean", None), ("summary", None), ("profile", None),
    ]),
    "run_steps_resumed": _steps([
        ("begin", None), ("taxpayer_register", "register"), ("tax_returns", "filings"), ("register", None), ("check", None),
        ("log", None), ("clean", None, 1, "failed"), ("clean", "clean", 2), ("register_clean", None), ("summary", None),
        ("profile", None),
    ]),
}
