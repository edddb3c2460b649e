"""The jobs on small CSV files with a plain-Python account of what they must find."""

from __future__ import annotations

import csv
import json
import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest

from probity.jobs import main
from probity.model import RETURNS_SCHEMA
from probity.session import exists, scratch_dir

AS_OF = date(2024, 6, 30)
COLUMNS = RETURNS_SCHEMA.names


def some(rng: random.Random, value, missing: float = 0.08):
    return None if rng.random() < missing else value


def make(seed: int) -> tuple[list[dict], list[dict]]:
    rng = random.Random(seed)
    register = [
        {
            "tin": some(rng, f"{rng.randint(0, 400):010d}", 0.02),
            "taxpayer_name": some(rng, f"Company {i}"),
            "sector": some(rng, "Trade"),
            "region": rng.choice([" Northern", "Eastern"]),
            "registration_date": date(2001, 1, 1) + timedelta(days=i),
            "is_active": rng.random() < 0.8,
        }
        for i in range(300)
    ]
    returns = []
    for i in range(700):
        start = date(2020, 1, 1) + timedelta(days=rng.randint(0, 1600))
        tin = f"{rng.randint(0, 450):010d}" + rng.choice(["", "", "", "X"])
        returns.append(
            {
                "return_id": some(rng, f"RET-{rng.randint(0, 500):05d}", 0.03),
                "tin": some(rng, tin),
                "tax_type": some(rng, "VAT", 0.01),
                "period_start": some(rng, start, 0.02),
                "period_end": some(rng, start + timedelta(days=rng.choice([0, 30, -1])), 0.02),
                "filing_date": some(rng, start + timedelta(days=rng.randint(-5, 700))),
                "filing_status": some(rng, rng.choice(["Filed", "Pending", "Lost"])),
                "amount_due_ugx": some(rng, round(rng.uniform(-100, 500), 2)),
                "amount_paid_ugx": some(rng, round(rng.uniform(0, 600), 2)),
                "currency": some(rng, rng.choice(["UGX", "UGX", "USD"])),
                "assessor_id": "ASR-100",
            }
        )
    return returns, register


def expected(returns: list[dict], register: list[dict]) -> list[tuple]:
    found = []

    def add(dimension, field, bad, total, severity):
        if bad:
            found.append((dimension, field, bad, total, severity))

    def nulls(table, fields):
        for f in fields:
            bad = sum(r[f] is None for r in table)
            add("Completeness", f, bad, len(table), "HIGH" if bad / len(table) > 0.05 else "MEDIUM")

    def unique(table, key):
        seen = Counter(r[key] for r in table)
        bad = sum(n for n in seen.values() if n > 1)
        add("Uniqueness", key, bad, len(table), "HIGH" if bad / len(table) > 0.02 else "MEDIUM")

    def broken(dimension, field, severity, needs, test):
        bad = sum(all(r[c] is not None for c in needs) and test(*[r[c] for c in needs]) for r in returns)
        add(dimension, field, bad, len(returns), severity)

    nulls(returns, ["return_id", "tin", "tax_type", "amount_due_ugx", "filing_date"])
    broken("Validity", "amount_due_ugx", "HIGH", ["amount_due_ugx"], lambda v: v < 0)
    broken("Validity", "currency", "HIGH", ["currency"], lambda v: v != "UGX")
    broken("Validity", "filing_status", "MEDIUM", ["filing_status"], lambda v: v == "Lost")
    broken("Consistency", "period_start / period_end", "HIGH", ["period_start", "period_end"], lambda a, b: b <= a)
    broken("Consistency", "filing_date / period_start", "HIGH", ["filing_date", "period_start"], lambda a, b: a < b)
    broken("Consistency", "amount_paid_ugx / amount_due_ugx", "MEDIUM", ["amount_paid_ugx", "amount_due_ugx"], lambda a, b: a > b * 1.5)
    unique(returns, "return_id")
    broken("Timeliness", "filing_date", "MEDIUM", ["filing_date"], lambda v: v > AS_OF)
    broken("Timeliness", "filing_date + filing_status", "LOW", ["filing_date", "filing_status"], lambda d, s: (AS_OF - d).days > 1095 and s == "Pending")
    known = {r["tin"] for r in register if r["tin"]}
    broken("Referential Integrity", "tin", "HIGH", ["tin"], lambda v: v not in known)
    nulls(register, ["tin", "taxpayer_name", "sector", "region"])
    unique(register, "tin")
    return found


def kept(returns: list[dict]) -> list[dict]:
    seen, out = set(), []
    for r in returns:
        good = (
            r["tin"] is not None
            and r["amount_due_ugx"] is not None
            and re.fullmatch("[0-9]{10}", r["tin"])
            and r["amount_due_ugx"] >= 0
            and r["currency"] == "UGX"
            and r["filing_date"] is not None
            and r["filing_date"] <= AS_OF
        )
        if good and r["return_id"] not in seen:
            seen.add(r["return_id"])
            out.append(r)
    return out


def write(path, table: list[dict]) -> None:
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, fieldnames=list(table[0]))
        out.writeheader()
        out.writerows(table)


@pytest.mark.parametrize("seed", [1, 2])
def test_run_check_and_report(spark, tmp_path, seed):
    returns, register = make(seed)
    write(tmp_path / "r.csv", returns)
    write(tmp_path / "t.csv", register)
    inputs = ["--returns", str(tmp_path / "r.csv"), "--register", str(tmp_path / "t.csv")]
    common = [*inputs, "--format", "csv", "--as-of", str(AS_OF)]
    out = scratch_dir(spark)

    main(["check", *common, "--out", f"{out}/check"], spark)
    alone = json.loads(spark.read.text(f"{out}/check").first()[0])
    want = expected(returns, register)
    assert [(i["dimension"], i["field"], i["affected_rows"], i["total_rows"], i["severity"]) for i in alone["issues"]] == want

    main(["run", *common, "--out", f"{out}/run"], spark)
    summary = json.loads(spark.read.text(f"{out}/run/pipeline_summary").first()[0])
    assert summary["dq_results"] == alone
    good = kept(returns)
    assert summary["cleaning_summary"]["rows_after"] == len(good)
    clean = spark.read.option("header", True).csv(f"{out}/run/processed/tax_returns_clean")
    assert clean.columns == COLUMNS
    datasets = spark.read.parquet(f"{out}/run/catalogue/datasets").filter("name = 'tax_returns'")
    assert (datasets.first().row_count, datasets.first().col_count) == (len(returns), len(COLUMNS))
    assert Counter((r.return_id, r.tin, float(r.amount_due_ugx)) for r in clean.collect()) == Counter(
        (r["return_id"], r["tin"], r["amount_due_ugx"]) for r in good
    )

    # The same from parquet, read where it is.
    raw = f"{out}/run/raw"
    parquet = ["--returns", f"{raw}/tax_returns", "--register", f"{raw}/taxpayer_register"]
    main(["run", *parquet, "--as-of", str(AS_OF), "--out", f"{out}/again"], spark)
    again = json.loads(spark.read.text(f"{out}/again/pipeline_summary").first()[0])
    assert again["dq_results"] == alone
    assert again["cleaning_summary"] == summary["cleaning_summary"]

    main(["report", "--summary", f"{out}/run/pipeline_summary", "--out", f"{out}/report"], spark)
    log = spark.read.parquet(f"{out}/report/issue_log").orderBy("issue_no").collect()
    rank = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}
    assert [(r.dimension, r.field) for r in log] == [w[:2] for w in sorted(want, key=lambda w: rank[w[-1]])]
    assert spark.read.parquet(f"{out}/report/dimensions").count() == 6
    flow = spark.read.parquet(f"{out}/report/flow").first()
    assert (flow.source_rows, flow.target_rows) == (len(returns), len(good))
    assert spark.read.parquet(f"{out}/report/explorer").count() == len(want)
    assert not exists(spark, f"{out}/check_staged")
