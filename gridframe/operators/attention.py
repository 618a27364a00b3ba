"""Graph attention (forward pass), over node and edge tables or over records that hold a whole path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrow import matrix, nested, ragged

SLOPE = 0.2


@dataclass
class AttentionWeights:
    """``w[h][o][i]`` projects features; ``src[h][o]`` and ``dst[h][o]`` score the ends of an edge, and ``edge[h][f]``,
    where given, its attributes."""

    w: Sequence[Sequence[Sequence[float]]]
    src: Sequence[Sequence[float]]
    dst: Sequence[Sequence[float]]
    bias: Sequence[float] | None = None
    edge: Sequence[Sequence[float]] | None = None


def _dot(vector: Column, weights: Sequence[float]) -> Column:
    return sum((vector[i].cast("double") * float(w) for i, w in enumerate(weights)), F.lit(0.0))


def _leaky(score: Column) -> Column:
    return F.when(score > 0, score).otherwise(score * SLOPE)


def attention_layer(
    nodes: DataFrame,
    edges: DataFrame,
    weights: AttentionWeights,
    graph: str = "column_id",
    x: str = "x",
    concat: bool = True,
    name: str = "out",
    attr: str = "attr",
) -> DataFrame:
    """New features of every node from itself and the nodes that point to it.

    Per head: h = W x, score leaky(a_src . h_s + a_dst . h_d), softmax over a node's incoming edges and its self-loop,
    weighted sum of h. With edge weights the score of an edge also has the term a_edge . attr; a self-loop has none.
    Heads are joined end to end, or averaged. A graph is one record, so the edges into a node are at
    most as many as the record has levels; the greatest score of a node is taken off before exp.
    """
    heads, width = len(weights.w), len(weights.w[0])
    h = F.array(*[_dot(F.col(x), row) for head in weights.w for row in head])
    projected = nodes.select(graph, "node", h.alias("h"))
    part = [[F.col("h")[k * width + o] for o in range(width)] for k in range(heads)]

    def scores(of: Sequence[Sequence[float]]) -> Column:
        return F.array(*[sum((p * float(a) for p, a in zip(part[k], of[k])), F.lit(0.0)) for k in range(heads)])

    scored = projected.select(graph, "node", "h", scores(weights.src).alias("from"), scores(weights.dst).alias("to"))
    along = [F.array(*[_dot(F.col(attr), head) for head in weights.edge]).alias("along")] if weights.edge is not None else []
    sent = edges.select(graph, F.col("src").alias("node"), "dst", *along).join(scored.drop("to"), [graph, "node"])
    leaving = F.zip_with("from", "along", lambda a, b: a + b).alias("from") if along else F.col("from")
    sent = sent.select(graph, F.col("dst").alias("node"), "h", leaving, F.lit(None).cast("array<double>").alias("to"))
    # A node's self-loop carries its own term, so the receiving side needs no join of its own.
    into = W.partitionBy(graph, "node")
    own = F.max("to").over(into)
    heard = sent.unionByName(scored).select(graph, "node", "h", "from", own.alias("to"))
    score = [_leaky(F.col("from")[k] + F.col("to")[k]) for k in range(heads)]
    weighed = heard.select(
        graph, "node", "h", *[F.exp(s - F.max(s).over(into)).alias(f"a{k}") for k, s in enumerate(score)]
    )
    sums = []
    for k in range(heads):
        sums.append(F.sum(f"a{k}").alias(f"z{k}"))
        sums += [F.sum(F.col(f"a{k}") * F.col("h")[k * width + o]).alias(f"s{k}_{o}") for o in range(width)]
    summed = weighed.groupBy(graph, "node").agg(*sums)
    share = [[F.col(f"s{k}_{o}") / F.col(f"z{k}") for o in range(width)] for k in range(heads)]
    if concat:
        values = [v for head in share for v in head]
    else:
        values = [sum((share[k][o] for k in range(heads)), F.lit(0.0)) / float(heads) for o in range(width)]
    if weights.bias is not None:
        values = [v + float(b) for v, b in zip(values, weights.bias)]
    return summed.select(graph, "node", F.array(*values).alias(name))


def attention_network(
    nodes: DataFrame, edges: DataFrame, layers: Sequence[AttentionWeights], graph: str = "column_id", x: str = "x"
) -> DataFrame:
    """A stack of layers with relu between them; heads are averaged in the last one."""
    for i, weights in enumerate(layers):
        last = i == len(layers) - 1
        nodes = attention_layer(nodes, edges, weights, graph, x, concat=not last, name=x)
        if not last:
            nodes = nodes.withColumn(x, F.transform(x, lambda v: F.greatest(v, F.lit(0.0))))
    return nodes


def _path_layer(x: np.ndarray, weights: AttentionWeights, concat: bool) -> np.ndarray:
    """One layer over records x levels x features, where a level hears itself and its two neighbours."""
    w, src, dst = (np.asarray(a, dtype="f8") for a in (weights.w, weights.src, weights.dst))
    heads, width = src.shape
    h = (x @ w.reshape(heads * width, -1).T).reshape(*x.shape[:2], heads, width)
    sent, heard = (h * src).sum(-1), (h * dst).sum(-1)
    edge = np.pad(sent, ((0, 0), (1, 1), (0, 0)), constant_values=-np.inf)
    score = np.stack([edge[:, :-2], sent, edge[:, 2:]]) + heard
    score = np.where(score > 0, score, score * SLOPE)
    share = np.exp(score - score.max(axis=0))
    share = (share / share.sum(axis=0))[..., None]
    out = share[1] * h
    out[:, 1:] += share[0][:, 1:] * h[:, :-1]
    out[:, :-1] += share[2][:, :-1] * h[:, 1:]
    out = out.reshape(*x.shape[:2], -1) if concat else out.mean(axis=2)
    return out if weights.bias is None else out + np.asarray(weights.bias)


def path_attention(
    records: DataFrame, layers: Sequence[AttentionWeights], x: str = "x", concat_last: bool = False, name: str = "out"
) -> DataFrame:
    """The same stack on records that hold their whole path graph in one levels x features array.

    A graph never leaves its row, so no layer shuffles: this is the form for many records. ``record_attention`` does the
    same for any edges inside a record, with attributes, which have no place here.
    """
    if any(layer.edge is not None for layer in layers):
        raise ValueError("edge weights need edges: see record_attention")
    weights = records.sparkSession.sparkContext.broadcast([vars(layer) for layer in layers])
    schema = T.StructType([*records.schema.fields, T.StructField(name, T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(batches):
        stack = [AttentionWeights(**layer) for layer in weights.value]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = batch.column(x)
            levels = len(column[0])
            out = matrix(column).reshape(batch.num_rows, levels, -1)
            for i, layer in enumerate(stack):
                last = i == len(stack) - 1
                out = _path_layer(out, layer, concat_last or not last)
                if not last:
                    out = np.maximum(out, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, nested(out)], names=[*batch.schema.names, name])

    return records.mapInArrow(run, schema)


def with_edges(
    records: DataFrame, edges: DataFrame, graph: str = "column_id", x: str = "x", attr: str | None = None
) -> DataFrame:
    """``records`` with their incoming edges: ``starts`` (one more than nodes) and ``sources`` from each start on, sorted
    by the node they lead to, and ``attrs`` of the same length where ``attr`` names the edges' attributes.

    One shuffle of the edges, so that no layer needs any; edges of one graph come to one row, as its nodes did. Records
    without an edge get empty lists, edges without a record go. An edge to or from a node that is not there fails.
    """
    fields = ["dst", "src", *([attr] if attr else [])]
    listed = edges.groupBy(graph).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_e"))
    joined = records.join(listed, graph, "left").withColumn("_n", F.size(x))
    for field in fields:
        joined = joined.withColumn(f"_{field}", F.coalesce(F.col(f"_e.{field}"), F.array().cast(f"array<{edges.schema[field].dataType.simpleString()}>")))
    inside = F.forall("_e", lambda e: (e["src"] >= 0) & (e["src"] < F.col("_n")) & (e["dst"] >= 0) & (e["dst"] < F.col("_n")))
    wrong = F.raise_error(F.concat(F.lit("an edge leaves graph "), F.col(graph).cast("string"))).cast("array<int>")
    # Sorted by destination: the start of a node is the number of edges into the nodes before it, a running sum of counts.
    counts = F.map_from_entries(F.transform(F.array_distinct("_dst"), lambda d: F.struct(d.cast("int"), F.array_position("_dst", d).cast("int") - 1)))
    first = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.try_element_at(counts, i))
    filled = F.reverse(F.aggregate(F.reverse(first), F.array(F.size("_dst")), lambda s, v: F.concat(s, F.array(F.coalesce(v, F.element_at(s, -1))))))
    starts = F.when(F.coalesce(inside, F.lit(True)), F.when(F.col("_n") > 0, filled).otherwise(F.array(F.lit(0)))).otherwise(wrong)
    extra = [F.col(f"_{attr}").alias("attrs")] if attr else []
    return joined.select(*records.columns, starts.alias("starts"), F.transform("_src", lambda s: s.cast("int")).alias("sources"), *extra)


def _segments(values: np.ndarray, starts: np.ndarray, combine: np.ufunc, empty: np.ndarray) -> np.ndarray:
    """``combine`` of each run of values and of a value of its own that every run has."""
    some = np.flatnonzero(np.diff(starts))
    out = empty.copy()
    if len(some):
        out[some] = combine(out[some], combine.reduceat(values, starts[some], axis=0))
    return out


def _record_layer(x: np.ndarray, starts: np.ndarray, sources: np.ndarray, attrs: np.ndarray | None, weights: AttentionWeights, concat: bool) -> np.ndarray:
    """One layer over the nodes of many graphs laid end to end, with the edges into each node next to each other."""
    w, src, dst = (np.asarray(a, dtype="f8") for a in (weights.w, weights.src, weights.dst))
    heads, width = src.shape
    h = (x @ w.reshape(heads * width, -1).T).reshape(len(x), heads, width)
    sent, heard = (h * src).sum(-1), (h * dst).sum(-1)
    into = np.repeat(np.arange(len(x)), np.diff(starts))
    score, own = sent[sources] + heard[into], sent + heard
    if weights.edge is not None:
        score = score + attrs @ np.asarray(weights.edge, dtype="f8").T
    score, own = (np.where(s > 0, s, s * SLOPE) for s in (score, own))
    top = _segments(score, starts, np.maximum, own)
    share, mine = np.exp(score - top[into]), np.exp(own - top)
    total = _segments(share, starts, np.add, mine)
    out = _segments(share[..., None] * h[sources], starts, np.add, mine[..., None] * h) / total[..., None]
    out = out.reshape(len(x), -1) if concat else out.mean(axis=1)
    return out if weights.bias is None else out + np.asarray(weights.bias)


def record_attention(
    records: DataFrame,
    layers: Sequence[AttentionWeights],
    x: str = "x",
    starts: str = "starts",
    sources: str = "sources",
    attrs: str | None = None,
    concat_last: bool = False,
    name: str = "out",
) -> DataFrame:
    """The stack of layers on records that hold any graph: nodes x features, and the edges as ``with_edges`` lays them.

    A node hears itself and the sources of its edges, with a softmax over them; scores have an edge term where a layer
    has edge weights, from ``attrs``. Graphs may differ in nodes and edges. Nothing is shuffled.
    """
    if attrs is None and any(layer.edge is not None for layer in layers):
        raise ValueError("edge weights need the edges' attributes")
    weights = records.sparkSession.sparkContext.broadcast([vars(layer) for layer in layers])
    schema = T.StructType([*records.schema.fields, T.StructField(name, T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(batches):
        stack = [AttentionWeights(**layer) for layer in weights.value]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            nodes, ends = ragged(batch.column(x))
            lists = batch.column(starts)
            first = lists.flatten().to_numpy(zero_copy_only=False).astype("int64")
            near = batch.column(sources).flatten().to_numpy(zero_copy_only=False).astype("int64")
            size, degree = np.diff(ends), np.diff(np.append(0, np.cumsum(batch.column(sources).value_lengths().to_numpy())))
            if not np.array_equal(lists.value_lengths().to_numpy(), size + 1):
                raise ValueError("a record has not one start more than nodes")
            # Starts and sources of the graphs laid end to end; the end of a graph is the start of the next.
            graph = np.repeat(np.arange(len(size)), size)
            inner = np.ones(len(first), dtype=bool)
            inner[np.cumsum(size + 1) - 1] = False
            at = np.append(first[inner] + (np.cumsum(degree) - degree)[graph], degree.sum())
            near = near + np.repeat(ends[:-1], degree)
            given = ragged(batch.column(attrs))[0] if attrs is not None else None
            out = nodes
            for i, layer in enumerate(stack):
                last = i == len(stack) - 1
                out = _record_layer(out, at, near, given, layer, concat_last or not last)
                if not last:
                    out = np.maximum(out, 0.0)
            inside = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inside)], names=[*batch.schema.names, name])

    return records.mapInArrow(run, schema)
