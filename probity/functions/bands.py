"""Severity order, score bands and the overall verdict."""

from __future__ import annotations

# Fixed values.
SEVERITIES = ("HIGH", "MEDIUM", "LOW")
ACCEPTABLE = 95
MONITORED = 80


def severity_rank(severity: str) -> str:
    """HIGH 0, MEDIUM 1, LOW 2."""
    cases = " ".join(f"WHEN '{level}' THEN {rank}" for rank, level in enumerate(SEVERITIES))
    return f"CASE {severity} {cases} END"


def _three_way(score: str, high: str, middle: str, low: str) -> str:
    return (
        f"CASE WHEN {score} >= {ACCEPTABLE} THEN '{high}' "
        f"WHEN {score} >= {MONITORED} THEN '{middle}' ELSE '{low}' END"
    )


def score_band(score: str) -> str:
    return _three_way(score, "PASS", "MONITOR", "FAIL")


def verdict(score: str) -> str:
    return _three_way(score, "GOOD", "MODERATE", "POOR")
