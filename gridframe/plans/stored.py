"""Networks as tables: weights in blocks, read again by any session that has the path."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.plans.learn import BLOCK, Adam, Network, predict

NETWORK = "part string, layer int, at bigint, shape array<bigint>, numbers array<double>, settings string"
_PLAIN = ("dropout", "l1", "l2", "levels", "loss_weights", "reports", "epochs", "activation")


def _arrays(net: Network) -> dict[str, list[np.ndarray]]:
    """All arrays of a network by part: weights, statistics, history, and the optimiser's moments."""
    found = {"weights": net.weights, "mean": [net.mean], "std": [net.std], "history": [np.array(net.history, dtype="f8").reshape(-1, 4)]}
    if net.optimiser is not None and net.optimiser.m is not None:
        found |= {"m": net.optimiser.m, "v": net.optimiser.v}
    return {part: [np.asarray(a, dtype="f8") for a in arrays if a is not None] for part, arrays in found.items()}


def save_network(spark: SparkSession, net: Network, path: str, mode: str = "errorifexists") -> None:
    """Store a network with its statistics, history and optimiser: one row per block of an array, with the layer it
    belongs to, its offset and the array's shape, and one row of settings."""
    rows = []
    for part, arrays in _arrays(net).items():
        for layer, array in enumerate(arrays):
            flat, shape = array.ravel(), [int(n) for n in array.shape]
            for at in range(0, max(len(flat), 1), BLOCK):
                rows.append((part, layer, at, shape, flat[at : at + BLOCK].tolist(), None))
    settings = {name: getattr(net, name) for name in _PLAIN}
    if net.optimiser is not None:
        settings["optimiser"] = {"lr": net.optimiser.lr, "t": net.optimiser.t}
    rows.append(("settings", 0, 0, [], [], json.dumps(settings)))
    spark.createDataFrame(rows, NETWORK).write.mode(mode).parquet(path)


def load_network(spark: SparkSession, path: str) -> Network:
    """The network stored at a path; missing or double blocks fail."""
    rows = spark.read.schema(NETWORK).parquet(path).orderBy("part", "layer", "at").collect()
    arrays: dict[str, list[np.ndarray]] = {}
    for row in rows:
        layers = arrays.setdefault(row["part"], [])
        if row["layer"] == len(layers):
            layers.append(np.full(int(np.prod(row["shape"])), np.nan).reshape(row["shape"]))
        flat = layers[row["layer"]].reshape(-1)
        block = np.array(row["numbers"])
        if not np.isnan(flat[row["at"] : row["at"] + len(block)]).all():
            raise ValueError(f"{path} holds a block of {row['part']} twice")
        flat[row["at"] : row["at"] + len(block)] = block
    settings = [json.loads(r["settings"]) for r in rows if r["part"] == "settings"]
    if len(settings) != 1 or any(np.isnan(a).any() for part in ("weights", "mean", "std", "m", "v") for a in arrays.get(part, [])):
        raise ValueError(f"{path} holds no whole network")
    given = settings[0]
    learned = given.pop("optimiser", None)
    net = Network(arrays["weights"], **{k: v for k, v in given.items() if k != "reports"})
    net.mean, net.std = (arrays.get(part, [None])[0] for part in ("mean", "std"))
    net.history = [(int(e), int(s), float(loss), int(n)) for e, s, loss, n in arrays["history"][0]]
    net.reports = [tuple(r) for r in given["reports"]]
    if learned is not None:
        net.optimiser = Adam(learned["lr"])
        net.optimiser.t, net.optimiser.m, net.optimiser.v = learned["t"], arrays.get("m"), arrays.get("v")
    return net


def predict_stored(df: DataFrame, path: str, x: str, pressure: str | None = None) -> DataFrame:
    """``predict`` with the network at a path."""
    return predict(df, load_network(df.sparkSession, path), x, pressure)


def network_layers(spark: SparkSession, path: str) -> DataFrame:
    """What a stored network holds: (part, layer, shape, blocks, norm), without bringing a weight to the driver."""
    rows = spark.read.schema(NETWORK).parquet(path).where("part <> 'settings'")
    squares = F.aggregate("numbers", F.lit(0.0), lambda s, v: s + v * v)
    return rows.groupBy("part", "layer", "shape").agg(F.count("*").alias("blocks"), F.sqrt(F.sum(squares)).alias("norm"))
