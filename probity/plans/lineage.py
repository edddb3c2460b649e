"""The lineage graph of a catalogue, and its edges with both ends looked up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.functions import listed, ticked
from probity.session import scratch_dir

NODE = ["id", "label", "type", "rows"]
EDGE = ["from", "to", "label", "operation", "status"]


def nodes(datasets: DataFrame, *also: str) -> DataFrame:
    """One node per dataset, with the columns ``also`` names."""
    return datasets.selectExpr(
        "dataset_id AS id", "name AS label", "source_type AS type", "row_count AS rows", *also
    )


def edges(transformations: DataFrame, *also: str) -> DataFrame:
    """One edge per input of a transformation, with the columns ``also`` names.

    The inputs may be an array or the JSON text of one.
    """
    inputs = "input_datasets"
    if isinstance(transformations.schema[inputs].dataType, T.StringType):
        inputs = "from_json(input_datasets, 'array<string>')"
    return transformations.selectExpr(
        f"explode({inputs}) AS `from`",
        "output_dataset AS `to`",
        "step_name AS label",
        "operation",
        "status",
        *also,
    )


def inputs_as_json(transformations: DataFrame) -> DataFrame:
    """The transformations with their inputs as JSON text, for exchange."""
    return transformations.selectExpr(
        *[
            "to_json(input_datasets) AS input_datasets" if c == "input_datasets" else c
            for c in transformations.columns
        ]
    )


def flow(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with name and row count at both ends.

    An end that was never registered keeps its id as name and NULL rows.
    """
    source = nodes.selectExpr("id AS `from`", "label AS source_label", "rows AS source_rows")
    target = nodes.selectExpr("id AS `to`", "label AS target_label", "rows AS target_rows")
    return (
        edges.join(source, "from", "left")
        .join(target, "to", "left")
        .selectExpr(
            "coalesce(source_label, `from`) AS source_name",
            "source_rows",
            "label",
            "operation",
            "status",
            "coalesce(target_label, `to`) AS target_name",
            "target_rows",
        )
    )


def dataset_listing(nodes: DataFrame) -> DataFrame:
    return nodes.select("label", "rows", "type", "id")


def of_ids(table: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The rows of a catalogue table that have one of these ids."""
    return table.filter(f"{ticked(table.columns[0])} IN ({listed(ids)})")


def graph_document(datasets: DataFrame, transformations: DataFrame) -> DataFrame:
    """Nodes and edges as one row of two arrays, in the order of registration.

    One row holds them all, so this is for what one run or one flow is made of:
    see ``of_ids``. The whole catalogue is two tables, ``nodes`` and ``edges``.
    """

    def entry(columns: list[str], at: str) -> str:
        fields = ", ".join(ticked(c) for c in columns)
        return f"struct({at} AS at, seq, struct({fields}) AS entry)"

    def in_order(name: str) -> str:
        return f"transform(sort_array(collect_list({name})), e -> e.entry) AS {name}s"

    all_nodes = nodes(datasets, "created_at", "seq").selectExpr(
        f"{entry(NODE, 'created_at')} AS node", "NULL AS edge"
    )
    all_edges = edges(transformations, "executed_at", "seq").selectExpr(
        "NULL AS node", f"{entry(EDGE, 'executed_at')} AS edge"
    )
    return all_nodes.union(all_edges).selectExpr(in_order("node"), in_order("edge"))


#: Rounds of ``reach``, and so paths of two to this power.
ROUNDS = 62


def _shortest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("from", "to").agg(F.min("steps").alias("steps"))


def _through(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs by a pair of each side that meet in the middle. Paths back to their start are left out."""
    first = left.selectExpr("`from` AS start", "`to` AS middle", "steps AS before")
    second = right.selectExpr("`from` AS middle", "`to` AS finish", "steps AS behind")
    return (
        first.join(second, "middle")
        .filter("start <> finish")
        .selectExpr("start AS `from`", "finish AS `to`", "before + behind AS steps")
    )


def reach(edges: DataFrame) -> DataFrame:
    """from, to, steps: every dataset that comes of another, and over how few steps.

    The rounds are the logarithm of the longest shortest path: a round goes from paths of
    up to n steps to those of up to 2n. Each of these has a first part of exactly n steps, so
    only pairs of n steps are joined with all found, which meets a longer pair once for each
    place it can have after n steps. What a round adds is written to the shared folder, once,
    which ends its lineage. An edge or path from a dataset to itself is no pair, and pairs that
    were found before aren't added, so graphs with cycles end too. NULL ends are left out.
    """
    spark, folder = edges.sparkSession, scratch_dir(edges.sparkSession)
    added = edges.select("from", "to").filter("`from` <> `to`").distinct().withColumn("steps", F.lit(1).cast("long"))
    found = None
    for number in range(ROUNDS):
        path, far = f"{folder}/reach-{number}", 1 << number
        added.write.parquet(path)
        added = spark.read.schema(added.schema).parquet(path)
        found = added if found is None else found.union(added)
        farthest = added.filter(F.col("steps") == far)
        if farthest.isEmpty():  # a longer pair would begin with one of these
            break
        added = _shortest(found.union(_through(farthest, found))).filter(F.col("steps") > far)
    return found


def related(edges: DataFrame, dataset_id: str) -> DataFrame:
    """What a dataset comes of (direction up) and what comes of it (down): direction, id, steps."""
    pairs, own = reach(edges), F.lit(dataset_id)
    up = pairs.filter(F.col("to") == own).selectExpr("'up' AS direction", "`from` AS id", "steps")
    down = pairs.filter(F.col("from") == own).selectExpr("'down' AS direction", "`to` AS id", "steps")
    return up.union(down)
