"""The registered queries. Each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.functions import last_chars, quoted, surrogate_id
from probity.model import ISSUE_COLUMNS, Check, ForeignKey, UniqueKey
from probity.operators import corrupt, rules
from probity.operators.detect import detection
from probity.operators.measure import issues, measure
from probity.operators.membership import duplicate_rows, orphan_rows
from probity.operators.profile import (
    aligned,
    missing_before_after,
    null_counts_of_files,
    quick_stats,
    sample_rows,
)
from probity.operators.remedy import keep_first, keep_first_late
from probity.operators.sample import sample_at_most
from probity.plans import lineage, report
from probity.plans.filings import (
    HOME_CURRENCY,
    REGISTER,
    RETURNS,
    clean_returns,
    completeness_rules,
    consistency_rules,
    database_checks,
    database_metrics,
    registered_tin,
    summarise_cleaning,
    timeliness_rules,
    validity_rules,
)
from probity.plans.incremental import CheckState
from probity.plans.pipeline import Run, run_pipeline
from probity.plans.scoring import dimension_scores, overall, result_document
from probity.sources import Catalogue, Dataset, read_csv, read_summary, write_table
from probity.sources.catalogue import dataset_rows, dq_run_row, transformation_row
from workload.fixture import (
    AS_OF,
    COLUMNS,
    DEFECT_NAMES,
    DEFECTS,
    FUTURE,
    RUN_TS,
    filings,
    register,
    scratch,
    sound_filings,
    table,
    tin,
)

Query = Callable[[SparkSession, str], DataFrame]

SRC_SEQ = ["src_seq"]
UNREGISTERED = "0000000000000000"
# What the datasets of the lineage queries are called and where they lie.
ORDERS, FILED, CUSTOMER = ("orders", "orders.parquet"), ("orders", "orders_filed"), ("customer", "customer.parquet")
FILINGS, REGISTERED, CLEAN = (RETURNS, "filings"), (REGISTER, "register"), (f"{RETURNS}_clean", "clean")


def _metrics(df: DataFrame, found: Sequence, name: str = RETURNS, **others: DataFrame) -> DataFrame:
    bound = [Check(name, r) for r in found]
    return measure(bound, {name: df, **others}).select("dataset", *ISSUE_COLUMNS)


def _all_metrics(spark: SparkSession, d: str) -> DataFrame:
    return database_metrics(filings(spark, d), register(spark, d), AS_OF, COLUMNS)


def _result(spark: SparkSession, d: str) -> DataFrame:
    return result_document(_all_metrics(spark, d))


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_returns(filings(spark, d), AS_OF, SRC_SEQ, COLUMNS)


# Checks


def dq_completeness(spark: SparkSession, d: str) -> DataFrame:
    fields = ["return_id", "tin", "tax_type", "amount_due", "filing_date"]
    return _metrics(filings(spark, d), completeness_rules(fields))


def dq_validity(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(filings(spark, d), validity_rules(RETURNS, COLUMNS))


def dq_key_pattern(spark: SparkSession, d: str) -> DataFrame:
    on_register = _metrics(register(spark, d), validity_rules(REGISTER, COLUMNS), REGISTER)
    return on_register.unionByName(_metrics(filings(spark, d), validity_rules(REGISTER, COLUMNS)))


def dq_consistency(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(filings(spark, d), consistency_rules(RETURNS, COLUMNS))


def dq_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(filings(spark, d), [UniqueKey(("return_id",))])


def dq_uniqueness_composite(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    return _metrics(lines, [UniqueKey(("l_orderkey", "l_linenumber"))], "lineitem")


def dq_timeliness(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(filings(spark, d), timeliness_rules(RETURNS, AS_OF, COLUMNS))


def dq_referential(spark: SparkSession, d: str) -> DataFrame:
    parent = {REGISTER: register(spark, d)}
    return _metrics(filings(spark, d), [registered_tin(COLUMNS)], RETURNS, **parent)


def dq_orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    scratch(spark)
    return orphan_rows(filings(spark, d), register(spark, d), "tin", "tin")


def dq_duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    scratch(spark)
    return duplicate_rows(filings(spark, d), ["return_id"])


def dq_metrics_all(spark: SparkSession, d: str) -> DataFrame:
    return _all_metrics(spark, d)


def dq_issues(spark: SparkSession, d: str) -> DataFrame:
    return issues(_all_metrics(spark, d))


# Scores


def dq_dimension_scores(spark: SparkSession, d: str) -> DataFrame:
    return dimension_scores(_result(spark, d))


def dq_overall(spark: SparkSession, d: str) -> DataFrame:
    return overall(_result(spark, d))


# Cleaning and profile


def clean_filings(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d)


def clean_summary(spark: SparkSession, d: str) -> DataFrame:
    return summarise_cleaning(filings(spark, d), AS_OF, COLUMNS)


def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    order = ["l_linenumber", *[c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]]
    return keep_first(lines, ["l_orderkey"], order)


def missing_values(spark: SparkSession, d: str) -> DataFrame:
    return missing_before_after(filings(spark, d), _clean(spark, d))


def quick_statistics(spark: SparkSession, d: str) -> DataFrame:
    tables = {"raw": filings(spark, d), "clean": _clean(spark, d)}
    return quick_stats(tables, "tin", "amount_due", "currency", HOME_CURRENCY)


def samples(spark: SparkSession, d: str) -> DataFrame:
    return sample_rows(filings(spark, d), "src_seq")


# Report tables


def issue_log(spark: SparkSession, d: str) -> DataFrame:
    return report.issue_log(_result(spark, d))


def issue_explorer(spark: SparkSession, d: str) -> DataFrame:
    return report.issue_explorer(
        _result(spark, d), ["Validity", "Consistency", "Timeliness"], ["HIGH", "LOW"]
    )


def explorer_count(spark: SparkSession, d: str) -> DataFrame:
    return report.explorer_count(
        _result(spark, d), ["Validity", "Consistency", "Timeliness"], ["HIGH", "LOW"]
    )


def explorer_dimensions(spark: SparkSession, d: str) -> DataFrame:
    return report.explorer_dimensions(_result(spark, d))


def dimension_bands(spark: SparkSession, d: str) -> DataFrame:
    return report.dimension_bands(_result(spark, d))


def overall_verdict(spark: SparkSession, d: str) -> DataFrame:
    return report.overall_verdict(_result(spark, d))


def severity_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.severity_summary(_result(spark, d))


def dimension_detail(spark: SparkSession, d: str) -> DataFrame:
    return report.dimension_detail(_result(spark, d))


def kpi_row(spark: SparkSession, d: str) -> DataFrame:
    return report.kpi_row(
        _result(spark, d), summarise_cleaning(filings(spark, d), AS_OF, COLUMNS)
    )


def report_metadata(spark: SparkSession, d: str) -> DataFrame:
    return report.report_metadata(_result(spark, d), quoted(RUN_TS.isoformat()), AS_OF)


# Lineage


def _registered(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    kept = summarise_cleaning(filings(spark, d), AS_OF, COLUMNS)

    def entry(place: tuple[str, str], df: DataFrame, kind: str, text: str, **known) -> Dataset:
        return Dataset(place[0], df, kind, place[1], text, **known)

    return dataset_rows(
        [
            entry(ORDERS, orders, "raw_file", "Orders"),
            entry(FILED, orders.filter("o_orderstatus = 'F'"), "derived", "Filed orders"),
            entry(CUSTOMER, table(spark, d, "customer"), "raw_file", "Customers"),
            entry(FILINGS, filings(spark, d), "derived", "Filings with defects"),
            entry(REGISTERED, register(spark, d), "derived", "Register of taxpayers"),
            entry(
                CLEAN,
                _clean(spark, d),
                "transformed",
                "Clean filings",
                counted=kept.selectExpr("rows_after AS row_count"),
            ),
        ],
        RUN_TS,
    )


def _dataset_id(place: tuple[str, str] | None) -> str:
    return surrogate_id(place[0], RUN_TS, place[1]) if place else UNREGISTERED


def _transformations(spark: SparkSession) -> DataFrame:
    steps = [
        ("Selection", [ORDERS], FILED, "filter"),
        ("Defect injection", [ORDERS, FILED], FILINGS, "corrupt"),
        ("Register build", [CUSTOMER, None], REGISTERED, "join"),
        ("DQ Remediation", [FILINGS, REGISTERED], CLEAN, "filter + deduplicate"),
    ]
    rows = [
        transformation_row(
            spark, step, [_dataset_id(p) for p in inputs], _dataset_id(output), operation, "", RUN_TS, seq=k
        )
        for k, (step, inputs, output, operation) in enumerate(steps)
    ]
    return reduce(DataFrame.unionByName, rows)


def _catalogue(spark: SparkSession, d: str) -> Catalogue:
    catalogue = Catalogue(spark, f"{scratch(spark)}/catalogue")
    catalogue.append("datasets", _registered(spark, d))
    catalogue.append("transformations", _transformations(spark))
    return catalogue


def lineage_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return _catalogue(spark, d).listing()


def lineage_catalogue_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The same datasets, appended one by one around two compactions, one of them broken off."""
    catalogue = Catalogue(spark, f"{scratch(spark)}/catalogue").init()
    path = f"{scratch(spark)}/datasets"
    _registered(spark, d).write.parquet(path)
    rows = spark.read.parquet(path)
    for seq in range(6):
        catalogue.append("datasets", rows.filter(f"seq = {seq}"))
        if seq == 2:  # written, but its commit never came
            datasets = catalogue.table("datasets")
            datasets.write_batch(datasets.read())
        if seq == 4:
            catalogue.compact("datasets")
    return catalogue.listing()


def lineage_reach(spark: SparkSession, d: str) -> DataFrame:
    """Every order that one of the same customer came after, and how many orders later."""
    scratch(spark)
    orders = table(spark, d, "orders").selectExpr("o_custkey", "o_orderdate", "o_orderkey AS `to`")
    before = "lag(`to`) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, `to`) AS `from`"
    return lineage.reach(orders.selectExpr("`to`", before))


def lineage_nodes(spark: SparkSession, d: str) -> DataFrame:
    return lineage.dataset_listing(lineage.nodes(_registered(spark, d)))


def lineage_flow(spark: SparkSession, d: str) -> DataFrame:
    catalogue = _catalogue(spark, d)
    as_text = lineage.inputs_as_json(catalogue.transformations())
    return lineage.flow(lineage.nodes(catalogue.datasets()), lineage.edges(as_text))


def lineage_graph(spark: SparkSession, d: str) -> DataFrame:
    """The stored graph document opened again: its edges, with the rows of the output."""
    catalogue = _catalogue(spark, d)
    document = lineage.graph_document(catalogue.datasets(), catalogue.transformations())
    return document.selectExpr(
        "CAST(size(nodes) AS BIGINT) AS node_count",
        "aggregate(nodes, 0L, (n, node) -> n + node.rows) AS node_rows",
        "explode(edges) AS edge",
    ).selectExpr("node_count", "node_rows", "edge.*")


def dq_run_log(spark: SparkSession, d: str) -> DataFrame:
    return dq_run_row(_result(spark, d), _dataset_id(FILINGS), RUN_TS)


# Corruption


def inject_defects(spark: SparkSession, d: str) -> DataFrame:
    """Every kind of defect in the usual order: a later one overwrites an earlier one."""
    key = "src_seq"
    return corrupt.inject(
        sound_filings(spark, d),
        [
            corrupt.null_out("tin", corrupt.every(key, 20, 7)),
            corrupt.Defect("tin", corrupt.every(key, 25, 3), f"concat({tin(key)}, 'X')"),
            corrupt.negate("amount_due", corrupt.every(key, 33, 14)),
            corrupt.pick("currency", corrupt.every(key, 25, 17), ["USD", "EUR"], key),
            corrupt.fixed("filing_date", corrupt.every(key, 33, 8), FUTURE),
            corrupt.null_out("amount_due", corrupt.every(key, 25, 11)),
            corrupt.copied_key("return_id", corrupt.every(key, 33, 5), f"{key} - 1"),
        ],
    )


def audit_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample_at_most(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 500)


def audit_sample_third(spark: SparkSession, d: str) -> DataFrame:
    """A third of the lines, chosen by their order, whose lines are told apart by the whole row."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return sample_at_most(lines, "l_orderkey", lines.count() // 3).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines")
    )


def first_per_key_late(spark: SparkSession, d: str) -> DataFrame:
    """The rows of first_per_key, found out of narrow rows."""
    scratch(spark)
    return keep_first_late(filings(spark, d), ["return_id"], SRC_SEQ, SRC_SEQ)


def clean_filings_late(spark: SparkSession, d: str) -> DataFrame:
    """The rows of clean_filings, found out of narrow rows."""
    scratch(spark)
    return clean_returns(filings(spark, d), AS_OF, SRC_SEQ, COLUMNS, row_id=SRC_SEQ)


def missing_footers(spark: SparkSession, d: str) -> DataFrame:
    """NULLs before and after of saved filings, by the footers of their files."""
    out, raw, clean = scratch(spark), filings(spark, d), _clean(spark, d)
    counts = []
    for name, df in (("raw", raw), ("clean", clean)):
        write_table(df, f"{out}/{name}")
        counts.append(null_counts_of_files(spark, f"{out}/{name}", df.schema))
    return aligned(*counts)


def inject_detection(spark: SparkSession, d: str) -> DataFrame:
    """Which of the filings' defects which checks on filings catch."""
    defects = [*DEFECTS, corrupt.Defect("filing_status", corrupt.every("src_seq", 60, 13), "filing_status")]
    raw = corrupt.inject(sound_filings(spark, d), defects, mask="defects")
    tables = {RETURNS: raw, REGISTER: register(spark, d)}
    checks = [c for c in database_checks(AS_OF, COLUMNS) if c.dataset == RETURNS]
    return detection(tables, checks, RETURNS, "defects", [*DEFECT_NAMES, "none"])


def audit_expand(spark: SparkSession, d: str) -> DataFrame:
    """Events of the filings, whose ids repeat; rows are told apart by their number."""
    return corrupt.audit_events(filings(spark, d), "return_id", identity="src_seq")


# Files and the whole job


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The filings after a round through CSV, with the types given back."""
    source = filings(spark, d)
    path = f"{scratch(spark)}/filings"
    write_table(source, path, "csv")
    return read_csv(spark, path, source.schema)


def csv_roundtrip_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts with line breaks and quotes, and codes with blanks around them, through CSV."""
    texts = table(spark, d, "documents").selectExpr("doc_id", "concat(' ', lang, ' ') AS lang", "text")
    path = f"{scratch(spark)}/documents"
    write_table(texts, path, "csv")
    return read_csv(spark, path, texts.schema)


# Texts that a reader of CSV might take for something else, chosen by the order's number.
_ODD_TEXTS = ("", "NA", "None", "nan", "NULL", "\\N", "\\E", "\\", " x ", "two\nlines", 'say "x", y', "a\r\nb")


def csv_roundtrip_types(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a column of each type, and texts that look like something else, through CSV."""
    odd = ", ".join(map(quoted, _ODD_TEXTS))
    source = table(spark, d, "orders").selectExpr(
        "o_orderkey AS id",
        f"try_element_at(array({odd}), CAST(o_orderkey % {len(_ODD_TEXTS) + 1} AS INT) + 1) AS told",
        "CAST(o_orderkey % 128 AS TINYINT) AS tiny",
        "CAST(o_orderkey % 1000 AS INT) AS small",
        "CAST(o_totalprice AS FLOAT) AS single",
        "o_totalprice / 3 AS price",
        "CAST(o_totalprice AS DECIMAL(18, 6)) AS amount",
        "o_orderkey % 2 = 0 AS even",
        "CAST(o_orderdate AS DATE) AS day",
        "timestampadd(MICROSECOND, o_orderkey, CAST(o_orderdate AS TIMESTAMP_NTZ)) AS moment",
        "timestamp_micros(o_orderkey * 1000003 - 1) AS instant",
        "IF(o_orderkey % 3 = 0, NULL, CAST(o_orderpriority AS BINARY)) AS bytes",
        "array(o_orderstatus, NULL, o_orderpriority) AS parts",
        "named_struct('key', o_custkey, 'at', timestampadd(MICROSECOND, o_orderkey, o_orderdate)) AS nested",
    )
    path = f"{scratch(spark)}/types"
    write_table(source, path, "csv")
    return read_csv(spark, path, source.schema).selectExpr(
        "* EXCEPT (single, instant, bytes, parts, nested)",
        "CAST(single AS DOUBLE) AS single",
        "unix_micros(instant) AS instant_us",
        "hex(bytes) AS bytes_hex",
        "array_join(parts, '|', '-') AS parts",
        "nested.key AS nested_key",
        "CAST(nested.at AS TIMESTAMP_NTZ) AS nested_at",
    )


def csv_roundtrip_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of floats through CSV: size, first component, and a sum of whole numbers."""
    source = table(spark, d, "embeddings")
    path = f"{scratch(spark)}/vectors"
    write_table(source, path, "csv")
    return read_csv(spark, path, source.schema).selectExpr(
        "vec_id",
        "label",
        "CAST(size(embedding) AS LONG) AS n",
        "CAST(embedding[0] AS DOUBLE) AS first",
        "aggregate(embedding, 0L, (t, x) -> t + CAST(floor(CAST(x AS DOUBLE) * 16777216) AS LONG)) AS total",
    )


def _run(spark: SparkSession, d: str, out: str | None = None, run_id: str | None = None, order_by=SRC_SEQ) -> Run:
    out = out or scratch(spark)
    return run_pipeline(
        spark,
        filings(spark, d),
        register(spark, d),
        out,
        Catalogue(spark, f"{out}/catalogue"),
        AS_OF,
        order_by=order_by,
        columns=COLUMNS,
        run_ts=RUN_TS,
        run_id=run_id,
    )


def summary_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The issues read back from the summary a whole run has written."""
    summary = read_summary(spark, _run(spark, d).summary)
    found = summary.selectExpr(
        "cleaning_summary.rows_after AS rows_after",
        "posexplode(dq_results.issues) AS (pos, issue)",
    )
    return found.selectExpr("CAST(pos + 1 AS BIGINT) AS issue_no", "rows_after", "issue.*")


def report_from_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flow and issue count of the report made from a saved summary."""
    tables = report.report_tables(read_summary(spark, _run(spark, d).summary), AS_OF)
    flow = tables["flow"].selectExpr(
        "'flow' AS part", "source_name", "source_rows", "target_name", "target_rows"
    )
    return flow.union(
        tables["explorer_count"].selectExpr("'explorer'", "NULL", "shown", "NULL", "of_total")
    )


def sample_clean(spark: SparkSession, d: str) -> DataFrame:
    """The clean sample that a whole run has written."""
    return spark.read.parquet(_run(spark, d).profile["clean_sample"])


def _stored_steps(spark: SparkSession, out: str) -> DataFrame:
    steps = Catalogue(spark, f"{out}/catalogue").steps()
    return steps.selectExpr(
        "seq",
        "step",
        "attempt",
        "status",
        "rows",
        "duration_ms >= 0 AND started_at IS NOT NULL AS timed",
        "coalesce(started_at >= lag(timestampadd(MILLISECOND, duration_ms - 1, started_at)) OVER (ORDER BY seq), true) "
        "AS in_turn",
    )


def run_steps(spark: SparkSession, d: str) -> DataFrame:
    """The stored steps of a whole run, with the rows each wrote."""
    out = scratch(spark)
    _run(spark, d, out)
    return _stored_steps(spark, out)


def run_steps_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The stored steps of a run whose cleaning failed, and that then went on from there."""
    out = scratch(spark)
    try:
        _run(spark, d, out, "resumed", ["no_such_column"])
    except AnalysisException:
        pass
    _run(spark, d, out, "resumed")
    return _stored_steps(spark, out)


def dq_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Checks on orders that come in three deliveries, each file read once, and how many files each took."""
    out, orders, customer = scratch(spark), table(spark, d, "orders"), table(spark, d, "customer")
    checks = [
        Check("orders", rules.allowed("o_orderstatus", ["F", "P"], "Order is still open", rules.MEDIUM)),
        Check("orders", rules.non_negative("o_totalprice", "Price below zero")),
        Check("orders", UniqueKey(("o_orderkey",))),
        Check("orders", UniqueKey(("o_custkey", "o_orderdate"))),
        Check("orders", ForeignKey("o_custkey", "customer", "c_custkey", "order of no customer")),
        Check("customer", UniqueKey(("c_custkey",))),
    ]
    state = CheckState(spark, f"{out}/state", checks, {"orders": orders.schema, "customer": customer.schema})
    took = [len(state.deliver("customer", f"{d}/customer.parquet"))]
    for k in range(3):
        part = orders.filter(f"pmod(o_orderkey, 3) = {k}").repartition(k + 1)
        part.write.mode("append").parquet(f"{out}/orders")
        took.append(len(state.deliver("orders", f"{out}/orders")))
        if k == 1:
            state.compact()
    read = ", ".join(f"{n}L" for n in took)
    return state.metrics().selectExpr(
        "check_seq", "field", "affected_rows", "total_rows", "severity", f"array_join(array({read}), '+') AS files_read"
    )


# Branches that the fixture does not reach


def dq_status_hits(spark: SparkSession, d: str) -> DataFrame:
    rule = rules.allowed("o_orderstatus", ["F", "P"], "Order is still open", rules.MEDIUM)
    return _metrics(table(spark, d, "orders"), [rule], "orders")


def dq_completeness_high(spark: SparkSession, d: str) -> DataFrame:
    statuses = table(spark, d, "orders").selectExpr("nullif(o_orderstatus, 'F') AS status")
    return _metrics(statuses, [rules.not_null("status")], "orders")


def dq_missing_column(spark: SparkSession, d: str) -> DataFrame:
    """Rules on a column that isn't there are left out."""
    found = [*validity_rules(RETURNS, COLUMNS), *timeliness_rules(RETURNS, AS_OF, COLUMNS)]
    return _metrics(filings(spark, d).drop("filing_status"), found)


def clean_summary_moment(spark: SparkSession, d: str) -> DataFrame:
    """Filings with a time of day, cleaned as of a time of day."""
    moment = "CAST(filing_date AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(src_seq % 24 AS INT))"
    timed = filings(spark, d).withColumn("filing_date", F.expr(moment))
    return summarise_cleaning(timed, datetime(2001, 8, 1, 12), COLUMNS)


def missing_one_sided(spark: SparkSession, d: str) -> DataFrame:
    """A column that only the raw or only the clean table has."""
    clean = _clean(spark, d).selectExpr("tin", "CAST(NULL AS STRING) AS note")
    return missing_before_after(filings(spark, d).select("tin", "currency"), clean)


def company_names(spark: SparkSession, d: str) -> DataFrame:
    """Names made of the last four digits of the key."""
    return register(spark, d).selectExpr("tin", f"concat('Company_', {last_chars('tin', 4)}) AS taxpayer_name")


def _sound_result(spark: SparkSession, d: str) -> DataFrame:
    checks = [
        Check("orders", ForeignKey("o_custkey", "customer", "c_custkey", "order of no customer")),
        Check("lineitem", ForeignKey("l_orderkey", "orders", "o_orderkey", "line of no order")),
        Check("customer", UniqueKey(("c_custkey",))),
    ]
    tables = {name: table(spark, d, name) for name in ("orders", "customer", "lineitem")}
    return result_document(measure(checks, tables))


def scores_without_issues(spark: SparkSession, d: str) -> DataFrame:
    return report.dimension_bands(_sound_result(spark, d))


def detail_without_issues(spark: SparkSession, d: str) -> DataFrame:
    return report.dimension_detail(_sound_result(spark, d))


# Defects the test tables have of their own


def nat_negative_balance(spark: SparkSession, d: str) -> DataFrame:
    rule = rules.non_negative("c_acctbal", "Negative account balance")
    return _metrics(table(spark, d, "customer"), [rule], "customer")


def nat_ship_before_order(spark: SparkSession, d: str) -> DataFrame:
    """A rule over two tables: lines joined to their orders, by one exchange of each."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.expr("l_orderkey = o_orderkey"), "left")
    rule = rules.not_before("l_shipdate", "o_orderdate", "Line shipped before the date of its order")
    return _metrics(joined, [rule], "lineitem")


def nat_orphan_rows_typed(spark: SparkSession, d: str) -> DataFrame:
    """Orders of no customer, with keys of other number types than the customers have."""
    scratch(spark)
    customer = table(spark, d, "customer")

    def orphans(kind: str) -> DataFrame:
        key = f"CAST(o_custkey AS {kind}) + CASE WHEN o_orderkey % 50 = 0 THEN 0.5 ELSE 0 END"
        typed = table(spark, d, "orders").selectExpr("o_orderkey", f"CAST({key} AS {kind}) AS k")
        found = orphan_rows(typed, customer, "k", "c_custkey")
        return found.selectExpr("o_orderkey", f"'{kind}' AS kind")

    return orphans("DOUBLE").union(orphans("DECIMAL(20,2)"))


def nat_duplicate_text(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(table(spark, d, "documents"), [UniqueKey(("text",), digest=True)], "documents")


def nat_duplicate_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """The documents whose text another document has too, found by digest."""
    scratch(spark)
    documents = table(spark, d, "documents").select("doc_id", "lang", "text")
    return duplicate_rows(documents, ["text"], digest=True).select("doc_id", "lang")


def nat_foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    """The foreign keys of the test tables, and the unique keys they point to."""
    names = ["orders", "customer", "lineitem", "events", "labels", "documents"]
    checks = [
        Check("orders", ForeignKey("o_custkey", "customer", "c_custkey", "order of no customer")),
        Check("lineitem", ForeignKey("l_orderkey", "orders", "o_orderkey", "line of no order")),
        Check("events", ForeignKey("user_id", "customer", "c_custkey", "event of no customer")),
        Check("labels", ForeignKey("doc_id", "documents", "doc_id", "label of no document")),
        Check("orders", UniqueKey(("o_orderkey",))),
        Check("customer", UniqueKey(("c_custkey",))),
        Check("documents", UniqueKey(("doc_id",))),
    ]
    return measure(checks, {name: table(spark, d, name) for name in names})


QUERIES: dict[str, Query] = {
    "dq_completeness": dq_completeness,
    "dq_validity": dq_validity,
    "dq_key_pattern": dq_key_pattern,
    "dq_consistency": dq_consistency,
    "dq_uniqueness": dq_uniqueness,
    "dq_uniqueness_composite": dq_uniqueness_composite,
    "dq_timeliness": dq_timeliness,
    "dq_referential": dq_referential,
    "dq_orphan_rows": dq_orphan_rows,
    "dq_duplicate_rows": dq_duplicate_rows,
    "dq_metrics_all": dq_metrics_all,
    "dq_issues": dq_issues,
    "dq_dimension_scores": dq_dimension_scores,
    "dq_overall": dq_overall,
    "clean_filings": clean_filings,
    "clean_summary": clean_summary,
    "first_per_key": first_per_key,
    "missing_before_after": missing_values,
    "quick_stats": quick_statistics,
    "sample_rows": samples,
    "issue_log": issue_log,
    "issue_explorer": issue_explorer,
    "explorer_count": explorer_count,
    "explorer_dimensions": explorer_dimensions,
    "dimension_bands": dimension_bands,
    "overall_verdict": overall_verdict,
    "severity_summary": severity_summary,
    "dimension_detail": dimension_detail,
    "kpi_row": kpi_row,
    "report_metadata": report_metadata,
    "lineage_catalogue": lineage_catalogue,
    "lineage_catalogue_compacted": lineage_catalogue_compacted,
    "lineage_reach": lineage_reach,
    "lineage_nodes": lineage_nodes,
    "lineage_flow": lineage_flow,
    "lineage_edges": lineage_graph,
    "dq_run_log": dq_run_log,
    "inject_defects": inject_defects,
    "audit_sample": audit_sample,
    "audit_sample_third": audit_sample_third,
    "inject_detection": inject_detection,
    "first_per_key_late": first_per_key_late,
    "clean_filings_late": clean_filings_late,
    "missing_footers": missing_footers,
    "audit_expand": audit_expand,
    "csv_roundtrip": csv_roundtrip,
    "summary_roundtrip": summary_roundtrip,
    "nat_negative_balance": nat_negative_balance,
    "nat_ship_before_order": nat_ship_before_order,
    "nat_duplicate_text": nat_duplicate_text,
    "nat_duplicate_text_rows": nat_duplicate_text_rows,
    "nat_foreign_keys": nat_foreign_keys,
    "nat_orphan_rows_typed": nat_orphan_rows_typed,
    "csv_roundtrip_text": csv_roundtrip_text,
    "csv_roundtrip_types": csv_roundtrip_types,
    "csv_roundtrip_vectors": csv_roundtrip_vectors,
    "report_from_summary": report_from_summary,
    "sample_clean": sample_clean,
    "dq_incremental": dq_incremental,
    "run_steps": run_steps,
    "run_steps_resumed": run_steps_resumed,
    "dq_status_hits": dq_status_hits,
    "dq_completeness_high": dq_completeness_high,
    "dq_missing_column": dq_missing_column,
    "clean_summary_moment": clean_summary_moment,
    "missing_one_sided": missing_one_sided,
    "company_names": company_names,
    "scores_without_issues": scores_without_issues,
    "detail_without_issues": detail_without_issues,
}
