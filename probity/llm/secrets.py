"""Secret scans over a ledger of blobs: each text is scanned once per version of a rule.

A version of a file is a row; its text, addressed by its SHA-256, is the blob.
The ledger is a table of the pairs of blob and rule version that were scanned,
with the spans found, and only ever grows. A scan reads the texts of blobs that
lack a pair, for the missing rules alone, and joins the spans back to all rows
that have the blob. Built-in functions only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probity.llm.scratch import free_name

#: Finds whose places are added up at once, and characters of a chunk of text.
BLOCK, CHUNK = 256, 4096


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost first and without overlap, whose ``group`` is long enough.

    A match that is too short counts as read, so ``likely``, which any kept match
    also matches, must only be used to pass texts over.
    """

    kind: str
    pattern: str
    least: int
    likely: str
    group: int = 0

    @property
    def version(self) -> str:
        text = f"{self.pattern}\n{self.least}\n{self.group}"
        return f"{self.kind}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


# Kinds and patterns in the order in which spans at one place are listed.
_ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{n})"
RULES = (
    SecretRule("assign", _ASSIGN.replace("{n}", "+"), 12, _ASSIGN.replace("{n}", "{12}"), 2),
    SecretRule("access", "AKIA[A-Z0-9]+", 18, "AKIA[A-Z0-9]{14}"),
    SecretRule("hex", "[0-9a-f]+", 16, "[0-9a-f]{16}"),
)

LEDGER_SCHEMA = "blob STRING, rule STRING, spans ARRAY<STRUCT<start: INT, end: INT>>"


def blob_of(text: Column) -> Column:
    """The address of a text; NULL is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is taken once."""
    return F.transform(F.array(value), body)[0]


def _in_blocks(items: Column) -> Column:
    """An array as arrays of BLOCK items, one of them at least."""
    places = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(BLOCK))
    return F.transform(places, lambda at: F.slice(items, at + 1, BLOCK))


def _before(totals: Column, first: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What comes before each of the totals, and behind the last."""
    return F.aggregate(
        totals,
        F.array(first),
        lambda done, total: F.concat(done, F.array(add(F.element_at(done, -1), total))),
    )


def spans_of(text: Column, rule: SecretRule) -> Column:
    """The kept matches of a rule in a text, as an array of (start, end), the end exclusive.

    Each find begins where the last one ended and takes the gap before the match
    with it, so lengths alone give the places. They are added up in blocks of finds, as an
    array that grows item by item is copied as often.
    """
    whole = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    gaps = F.regexp_extract_all(text, whole, F.lit(1))
    found = F.regexp_extract_all(text, whole, F.lit(2))
    if rule.group:
        size = lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group))
    else:
        size = F.length
    pairs = F.zip_with(
        gaps,
        found,
        lambda gap, hit: F.struct(
            F.length(gap).alias("gap"),
            F.length(hit).alias("length"),
            (size(hit) >= rule.least).alias("kept"),
        ),
    )
    nothing = F.array().cast("array<struct<start: int, end: int>>")

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        end = begin + pair["length"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(pair["kept"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def of_block(block: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), nothing.alias("spans"))
        return F.aggregate(block, start, step, lambda state: state["spans"])

    def of_blocks(blocks: Column) -> Column:
        sizes = F.transform(
            blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, pair: n + pair["gap"] + pair["length"])
        )
        begins = F.slice(_before(sizes, F.lit(0), lambda n, size: n + size), 1, F.size(blocks))
        return F.flatten(F.zip_with(blocks, begins, of_block))

    scanned = _let(pairs, lambda given: _let(_in_blocks(given), of_blocks))
    return F.when(F.rlike(text, F.lit(rule.likely)), scanned).otherwise(nothing)


class Ledger:
    """The scanned pairs of blob and rule version below one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def pairs(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.folder}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def unseen(self, blobs: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
        """Of ``blobs`` (blob, row), those that lack a rule, with the lacking rule versions."""
        versions = F.array(*[F.lit(r.version) for r in rules])
        known = self.pairs().groupBy("blob").agg(F.collect_set("rule").alias("known"))
        lacking = F.array_except(versions, F.coalesce("known", F.array().cast("array<string>")))
        return (
            blobs.join(known, "blob", "left")
            .withColumn("rules", lacking)
            .filter("size(rules) > 0")
            .select("blob", "row", "rules")
        )

    def scan(self, versions: DataFrame, rules: Sequence[SecretRule], key: str) -> None:
        """Scan what is unseen of ``versions`` (a key column and ``text``) and enter it.

        One row stands for all rows of a blob: the one with the least key. Texts go
        through one shuffle, by that key, so a blob with many rows is no burden.
        """
        rows = versions.select(F.col(key).alias("row"), blob_of(F.col("text")).alias("blob"))
        blobs = rows.groupBy("blob").agg(F.min("row").alias("row"))
        texts = versions.select(
            F.col(key).alias("row"),
            blob_of(F.col("text")).alias("blob"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        same = F.expr("t.row <=> u.row AND t.blob = u.blob")
        missing = texts.alias("t").join(self.unseen(blobs, rules).alias("u"), same)
        found = [
            F.when(
                F.array_contains("u.rules", r.version),
                F.struct(F.lit(r.version).alias("rule"), spans_of(F.col("t.text"), r).alias("spans")),
            )
            for r in rules
        ]
        entries = missing.select("t.blob", F.explode(F.array_compact(F.array(*found))).alias("e"))
        entries.select("blob", "e.rule", "e.spans").write.parquet(
            f"{self.folder}/scan={uuid.uuid4().hex}"
        )

    def findings(self, rules: Sequence[SecretRule]) -> DataFrame:
        """Per blob with a finding: ``found``, an array of (start, place of the rule, kind, end)."""
        place = F.create_map(
            *[F.lit(x) for k, r in enumerate(rules) for x in (r.version, k)]
        )
        kind = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.kind)])
        hits = (
            self.pairs()
            .filter(F.col("rule").isin(*[r.version for r in rules]))
            .filter("size(spans) > 0")
            .dropDuplicates(["blob", "rule"])  # runs at the same time may both have scanned it
            .withColumns({"place": place[F.col("rule")], "kind": kind[F.col("rule")]})
        )
        listed = F.transform(
            "spans", lambda s: F.struct(s["start"], F.col("place"), F.col("kind"), s["end"])
        )
        return hits.groupBy("blob").agg(
            F.array_sort(F.flatten(F.collect_list(listed))).alias("found")
        )


def scan_versions(
    versions: DataFrame, folder: str, key: str, rules: Sequence[SecretRule] = RULES
) -> DataFrame:
    """Every row's ``key`` and ``found``: an array of (start, place, kind, end) of its text.

    Scans what the ledger in ``folder`` lacks and enters it. A NULL text is empty;
    repeated rows are returned each; a text without findings has an empty array;
    other columns are ignored.
    """
    ledger = Ledger(versions.sparkSession, folder)
    ledger.scan(versions, rules, key)
    rows = versions.select(key, blob_of(F.col("text")).alias("blob"))
    nothing = F.array().cast("array<struct<start: int, place: int, kind: string, end: int>>")
    return rows.join(ledger.findings(rules), "blob", "left").select(
        key, F.coalesce("found", nothing).alias("found")
    )


def listed(found: Column) -> Column:
    """kind:start:end, joined by commas."""
    one = F.transform(
        found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def _part(chunks: Column, begin: Column, end: Column) -> Column:
    """Characters ``begin`` to ``end``, exclusive, of a text cut into chunks of CHUNK."""
    first, last = F.floor(begin / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    head = F.coalesce(F.get(chunks, first), F.lit(""))
    tail = F.coalesce(F.get(chunks, last), F.lit(""))
    between = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(first == last, F.substring(head, begin % CHUNK + 1, end - begin)).otherwise(
        F.concat(F.substring(head, begin % CHUNK + 1, F.lit(CHUNK)), between, F.substring(tail, F.lit(1), end % CHUNK))
    )


def replaced(text: Column, found: Column, mask: str) -> Column:
    """The text with ``mask`` for each stretch of spans that touch or overlap.

    Spans come by their start. Stretches are found in blocks of spans, and characters
    are counted in chunks of the text, so the time is that of the text and its spans.
    """
    nothing = F.array().cast("array<struct<from: int, to: int>>")

    def step(state: Column, span: Column) -> Column:
        opened = F.array(F.struct(F.greatest(state["upto"], F.lit(0)).alias("from"), span["start"].alias("to")))
        new = F.concat(state["gaps"], opened)
        return F.struct(
            F.greatest(state["upto"], span["end"]).alias("upto"),
            F.when(span["start"] > state["upto"], new).otherwise(state["gaps"]).alias("gaps"),
        )

    def of_block(block: Column, upto: Column) -> Column:
        start = F.struct(upto.alias("upto"), nothing.alias("gaps"))
        return F.aggregate(block, start, step, lambda state: state["gaps"])

    def of_blocks(blocks: Column) -> Column:
        """The gaps before the stretches, and a last one to the end of the text."""
        furthest = F.transform(blocks, lambda b: F.coalesce(F.array_max(F.transform(b, lambda x: x["end"])), F.lit(-1)))
        bounds = _before(furthest, F.lit(-1), F.greatest)
        gaps = F.flatten(F.zip_with(blocks, F.slice(bounds, 1, F.size(blocks)), of_block))
        behind = F.greatest(F.element_at(bounds, -1), F.lit(0))
        return F.concat(gaps, F.array(F.struct(behind.alias("from"), F.length(text).alias("to"))))

    def written(gaps: Column) -> Column:
        chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
        return _let(
            chunks, lambda c: F.array_join(F.transform(gaps, lambda g: _part(c, g["from"], g["to"])), mask)
        )

    return _let(found, lambda given: _let(_in_blocks(given), lambda blocks: _let(of_blocks(blocks), written)))


def masked(
    docs: DataFrame, folder: str, key: str, mask: str, rules: Sequence[SecretRule] = RULES
) -> DataFrame:
    """``docs`` with ``mask`` in place of every secret, and ``n_chars``, if there, counted anew.

    Scans what the ledger in ``folder`` lacks. Rows without a finding, such as those of
    a NULL or empty text, stay as they are; each of several equal rows is masked; an
    empty table stays empty.
    """
    ledger = Ledger(docs.sparkSession, folder)
    ledger.scan(docs, rules, key)
    blob, found = free_name(docs, "blob"), free_name(docs, "found")
    findings = ledger.findings(rules).selectExpr(f"blob AS {blob}", f"found AS {found}")
    own = docs.withColumn(blob, blob_of(F.col("text"))).join(findings, blob, "left")
    hit = F.col(found).isNotNull()
    clean = F.when(hit, replaced(F.col("text"), F.col(found), mask)).otherwise(F.col("text"))
    out = own.withColumn("text", clean)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(hit, length).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
