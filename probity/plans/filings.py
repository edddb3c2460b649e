"""The rule set for a taxpayer register and its tax returns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from probity.functions import date_literal, fold_nan, moment_literal, present, quoted, ticked
from probity.model import Check, ForeignKey, RowRule, UniqueKey
from probity.operators import rules
from probity.operators.measure import issues, measure
from probity.operators.remedy import cleaning_summary, remediate
from probity.plans.scoring import result_document
from probity.sources.files import INPUT_POSITION

# Fixed values.
RETURNS = "tax_returns"
REGISTER = "taxpayer_register"
HOME_CURRENCY = "UGX"
STATUSES = ("Amended", "Filed", "Overdue", "Pending")
PENDING = "Pending"
MAX_PAID_RATIO = 1.5
MAX_PENDING_DAYS = 365 * 3


@dataclass(frozen=True)
class Columns:
    """Names of the columns the rules refer to."""

    return_id: str = "return_id"
    tin: str = "tin"
    tax_type: str = "tax_type"
    period_start: str = "period_start"
    period_end: str = "period_end"
    filing_date: str = "filing_date"
    filing_status: str = "filing_status"
    amount_due: str = "amount_due_ugx"
    amount_paid: str = "amount_paid_ugx"
    currency: str = "currency"
    taxpayer_name: str = "taxpayer_name"
    sector: str = "sector"
    region: str = "region"


DEFAULT = Columns()


def completeness_rules(fields: Sequence[str]) -> list[RowRule]:
    return [rules.not_null(f) for f in fields]


def validity_rules(dataset: str, c: Columns = DEFAULT) -> list[RowRule]:
    # The descriptions.
    if dataset == RETURNS:
        listed = ", ".join(f"'{s}'" for s in STATUSES)
        return [
            rules.non_negative(c.amount_due, "Negative tax amounts are not permitted"),
            rules.allowed(
                c.currency,
                [HOME_CURRENCY],
                "Non-UGX currency — all domestic filings must use UGX",
            ),
            rules.allowed(
                c.filing_status,
                STATUSES,
                f"Filing status must be one of: {{{listed}}}",
                rules.MEDIUM,
            ),
        ]
    if dataset == REGISTER:
        return [rules.matches(c.tin, "TIN must be exactly 10 numeric digits")]
    return []


def consistency_rules(dataset: str, c: Columns = DEFAULT) -> list[RowRule]:
    if dataset != RETURNS:
        return []
    # The descriptions.
    return [
        rules.ends_after_start(
            c.period_start, c.period_end, "Period end date is not after period start date"
        ),
        rules.not_before(
            c.filing_date, c.period_start, "Filing date precedes the tax period start date"
        ),
        rules.at_most_ratio(
            c.amount_paid,
            c.amount_due,
            MAX_PAID_RATIO,
            "Payment exceeds 150% of amount due — possible data error",
        ),
    ]


def timeliness_rules(
    dataset: str, as_of: date | datetime, c: Columns = DEFAULT
) -> list[RowRule]:
    if dataset != RETURNS:
        return []
    # The descriptions.
    return [
        rules.not_future(
            c.filing_date, as_of, "Filing dates set in the future — likely a data entry error"
        ),
        rules.not_stale(
            c.filing_date,
            c.filing_status,
            PENDING,
            MAX_PENDING_DAYS,
            as_of,
            "Returns still Pending for more than 3 years",
        ),
    ]


def registered_tin(c: Columns = DEFAULT) -> ForeignKey:
    # Fixed value: the description.
    return ForeignKey(
        c.tin, REGISTER, c.tin, "TINs in tax_returns not found in the taxpayer register"
    )


def database_checks(as_of: date | datetime, c: Columns = DEFAULT) -> list[Check]:
    """All 21 checks, in the order their issues are listed."""
    on_returns = [
        *completeness_rules([c.return_id, c.tin, c.tax_type, c.amount_due, c.filing_date]),
        *validity_rules(RETURNS, c),
        *consistency_rules(RETURNS, c),
        UniqueKey((c.return_id,)),
        *timeliness_rules(RETURNS, as_of, c),
        registered_tin(c),
    ]
    on_register = [
        *completeness_rules([c.tin, c.taxpayer_name, c.sector, c.region]),
        *validity_rules(REGISTER, c),
        UniqueKey((c.tin,)),
    ]
    return [Check(RETURNS, r) for r in on_returns] + [Check(REGISTER, r) for r in on_register]


def database_metrics(
    returns: DataFrame, register: DataFrame, as_of: date | datetime, c: Columns = DEFAULT
) -> DataFrame:
    return measure(database_checks(as_of, c), {RETURNS: returns, REGISTER: register})


def run_all_checks(
    returns: DataFrame,
    register: DataFrame,
    as_of: date | datetime,
    c: Columns = DEFAULT,
) -> DataFrame:
    """The result document for both tables."""
    return result_document(database_metrics(returns, register, as_of, c))


def _issues_of(df: DataFrame, dataset: str, found: Sequence[RowRule | UniqueKey]) -> DataFrame:
    # A rule no row can break keeps the result a table where no other rule applies.
    nothing = RowRule("Completeness", "", "", "false", (), rules.LOW)
    bound = [Check(dataset, rule) for rule in [*found, nothing]]
    return issues(measure(bound, {dataset: df}))


def check_completeness(df: DataFrame, required_fields: Sequence[str]) -> DataFrame:
    return _issues_of(df, RETURNS, completeness_rules(required_fields))


def check_validity(df: DataFrame, dataset: str, c: Columns = DEFAULT) -> DataFrame:
    return _issues_of(df, dataset, validity_rules(dataset, c))


def check_consistency(df: DataFrame, dataset: str, c: Columns = DEFAULT) -> DataFrame:
    return _issues_of(df, dataset, consistency_rules(dataset, c))


def check_uniqueness(df: DataFrame, key_fields: Sequence[str], digest: bool = False) -> DataFrame:
    return _issues_of(df, RETURNS, [UniqueKey(tuple(key_fields), digest=digest)])


def check_timeliness(
    df: DataFrame, dataset: str, as_of: date | datetime, c: Columns = DEFAULT
) -> DataFrame:
    return _issues_of(df, dataset, timeliness_rules(dataset, as_of, c))


def check_referential_integrity(
    returns: DataFrame, register: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    bound = [Check(RETURNS, registered_tin(c))]
    return issues(measure(bound, {RETURNS: returns, REGISTER: register}))


def _filed_by(df: DataFrame, name: str, as_of: date | datetime) -> str:
    """Dated no later than ``as_of``, in a form the scan can use where the type allows."""
    column, kind = ticked(name), df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return f"{column} <= {date_literal(rules.as_day(as_of))}"
    if isinstance(as_of, datetime):
        return f"CAST({column} AS TIMESTAMP_NTZ) <= {moment_literal(as_of)}"
    if isinstance(kind, T.TimestampNTZType):
        midnight = datetime.combine(as_of + timedelta(days=1), time())
        return f"{column} < {moment_literal(midnight)}"
    return f"CAST({column} AS DATE) <= {date_literal(as_of)}"


def cleaning_conditions(
    df: DataFrame, as_of: date | datetime, c: Columns = DEFAULT
) -> list[str]:
    """What a return must meet to be kept, before duplicates are dropped."""
    return [
        f"{ticked(c.tin)} IS NOT NULL",
        present(df, c.amount_due),
        rules.matches_pattern(c.tin),
        f"{ticked(c.amount_due)} >= 0",
        f"{ticked(c.currency)} = {quoted(HOME_CURRENCY)}",
        _filed_by(df, c.filing_date, as_of),
    ]


def clean_returns(
    df: DataFrame,
    as_of: date | datetime,
    order_by: Sequence[str] | None = None,
    c: Columns = DEFAULT,
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """Returns fit for use: good key, amount, currency and date, first row per id.

    ``order_by`` says which row is first. Without it the input position is used
    that the readers add with ``position=True``, and dropped afterwards. With
    ``row_id``, columns that tell all rows apart, no whole row is sorted; see
    ``remedy.keep_first_late``.
    """
    if order_by is None and INPUT_POSITION not in df.columns:
        raise ValueError("name the columns that say which row of an id comes first")
    conditions = cleaning_conditions(df, as_of, c)
    first = order_by or [INPUT_POSITION]
    clean = fold_nan(remediate(df, conditions, [c.return_id], first, row_id))
    return clean if order_by else clean.drop(INPUT_POSITION)


def summarise_cleaning(
    df: DataFrame, as_of: date | datetime, c: Columns = DEFAULT
) -> DataFrame:
    """Rows before, after and removed, and the share kept, without cleaning."""
    conditions = cleaning_conditions(df, as_of, c)
    return cleaning_summary(df, conditions, [c.return_id])
