"""One path graph per record: consecutive levels are neighbours, in both directions.

Edges are generated from the record's own arrays, so building graphs moves no rows between tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.arrays import zip_equal
from gridframe.operators.batches import batches
from gridframe.schema import HALF_LEVELS


def both_ways(edges: DataFrame) -> DataFrame:
    """A directed edge list and its reverse."""
    others = [c for c in edges.columns if c not in ("src", "dst")]
    back = edges.select(*others, F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(*others, "src", "dst").unionByName(back)


def _links(levels) -> Column:
    """i + 1 -> i for each layer i, as an array of one record; a record of one level has none."""
    size = levels if not isinstance(levels, int) else F.lit(levels)
    layers = F.when(size > 1, F.sequence(F.lit(0), size - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(layers, lambda i: F.struct((i + 1).cast("bigint").alias("src"), i.cast("bigint").alias("dst")))


def path_edges(records: DataFrame, keep: Sequence[str], levels=HALF_LEVELS) -> DataFrame:
    """2 * (levels - 1) directed edges of each record's path; ``levels`` is a number or a column of the record."""
    return both_ways(records.select(*keep, F.inline(_links(levels))))


def attach_edges(records: DataFrame, keep: Sequence[str], levels=HALF_LEVELS) -> DataFrame:
    """The same edge list on every record, with the layer an edge runs through, in one pass over the records."""
    ways = F.transform(
        _links(levels),
        lambda e: F.array(
            F.struct(e["src"].alias("src"), e["dst"].alias("dst"), e["dst"].alias("layer")),
            F.struct(e["dst"].alias("src"), e["src"].alias("dst"), e["dst"].alias("layer")),
        ),
    )
    return records.select(*keep, F.inline(F.flatten(ways)))


def graph_nodes(features: DataFrame, keep: Sequence[str] = ("column_id",)) -> DataFrame:
    """One row per node: its features and targets, which must be as many."""
    zipped = zip_equal(x="x", y="y")
    return features.select(*keep, F.posexplode(zipped).alias("node", "z")).select(
        *keep, F.col("node").cast("bigint").alias("node"), "z.x", "z.y"
    )


def graph_edges(features: DataFrame, keep: Sequence[str] = ("column_id",)) -> DataFrame:
    """One row per directed edge: both directions of layer k carry the attributes of layer k."""
    layer = F.col("layer").cast("bigint")
    ways = F.array(
        F.struct((layer + 1).alias("src"), layer.alias("dst")), F.struct(layer.alias("src"), (layer + 1).alias("dst"))
    )
    layers = features.select(*keep, F.posexplode("edge").alias("layer", "attr"))
    return layers.select(*keep, "attr", F.inline(ways)).select(*keep, "src", "dst", "attr")


def build_graphs(features: DataFrame, keep: Sequence[str] = ("column_id",)) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables of every record."""
    return graph_nodes(features, keep), graph_edges(features, keep)


def graph_batch(
    nodes: DataFrame, edges: DataFrame, size: int, levels: int = HALF_LEVELS, row_id: str = "column_id"
) -> tuple[DataFrame, DataFrame]:
    """Graphs merged batch by batch: node numbers are moved by the graph's place in its batch."""
    shift = (F.col(row_id) % size) * levels
    n = batches(nodes, row_id, size).withColumn("node", F.col("node") + shift)
    e = batches(edges, row_id, size).withColumn("src", F.col("src") + shift).withColumn("dst", F.col("dst") + shift)
    return n, e


def graph_get(nodes: DataFrame, edges: DataFrame, index: int, shard_size: int, row_id: str = "column_id") -> tuple[DataFrame, DataFrame]:
    """One graph by its position, read from the directory of its shard."""
    here = (F.col("shard") == index // shard_size) & (F.col(row_id) == index)
    return nodes.where(here), edges.where(here)
