"""Filings and a register with known defects, derived from the test tables."""

from __future__ import annotations

import tempfile
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from probity.operators import corrupt
from probity.plans.filings import Columns
from probity.session import CHECKPOINT_DIR, scratch_dir, use_scratch

AS_OF = date(2001, 8, 1)
RUN_TS = datetime(2001, 8, 1, 2, 0, 0)
FUTURE = date(2027, 1, 1)
COLUMNS = Columns(amount_due="amount_due", amount_paid="amount_paid")
# A ten-digit number above any customer's.
NO_CUSTOMER = "concat('9', lpad(CAST(src_seq AS STRING), 9, '0'))"


_schemas: dict[str, StructType] = {}


def scratch(spark: SparkSession) -> str:
    """A new scratch folder; a local session that names none gets a temporary one."""
    if not spark.conf.get(CHECKPOINT_DIR, None) and spark.sparkContext.master.startswith("local"):
        use_scratch(tempfile.mkdtemp(prefix="probity-"))
    return scratch_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once and then given."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def tin(key: str) -> str:
    return f"lpad(CAST({key} AS STRING), 10, '0')"


def sound_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per order, before any defect."""
    start = "CAST(o_orderdate AS DATE)"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS src_seq",
        "o_orderkey AS return_id",
        f"{tin('o_custkey')} AS tin",
        "o_orderpriority AS tax_type",
        f"{start} AS period_start",
        f"date_add({start}, 30) AS period_end",
        f"date_add({start}, CAST(pmod(o_orderkey, 56) AS INT) - 5) AS filing_date",
        "CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Filed' "
        "WHEN 'O' THEN 'Overdue' END AS filing_status",
        "o_totalprice AS amount_due",
        "o_totalprice * pmod(o_orderkey, 13) / 10 AS amount_paid",
        "'UGX' AS currency",
    )


_KEY = "src_seq"
DEFECTS = [
    corrupt.copied_key("return_id", corrupt.every(_KEY, 33, 5), f"{_KEY} - 1"),
    corrupt.Defect("tin", corrupt.every(_KEY, 40, 9), NO_CUSTOMER),
    corrupt.orphan("tin", corrupt.every(_KEY, 25, 3)),
    corrupt.null_out("tin", corrupt.every(_KEY, 20, 7)),
    corrupt.Defect("period_end", corrupt.every(_KEY, 50, 21), "period_start"),
    corrupt.fixed("filing_date", corrupt.every(_KEY, 33, 8), FUTURE),
    corrupt.negate("amount_due", corrupt.every(_KEY, 33, 14)),
    corrupt.null_out("amount_due", corrupt.every(_KEY, 25, 11)),
    corrupt.fixed("currency", corrupt.every(_KEY, 25, 17), "USD"),
]
DEFECT_NAMES = (
    "copied key", "no customer", "orphan", "missing key", "empty period", "future", "negative", "missing amount",
    "currency",
)


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filings with their defects; where two meet, the last in the list wins."""
    return corrupt.inject(sound_filings(spark, sf_dir), DEFECTS)


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            f"{tin('c_custkey')} AS tin",
            "c_name AS taxpayer_name",
            "c_mktsegment AS sector",
            "r_name AS region",
        )
    )
