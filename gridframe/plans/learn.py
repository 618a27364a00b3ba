"""Regression training and scoring as Spark jobs.

Rows are shuffled once and stored by rank in the shared folder. An epoch is one job, however many batches it has: a
barrier stage in which every task walks the batches of its ranks in order, sums the gradient of its rows a part at a
time, adds the sums of all tasks, and moves its own copy of the weights as the others do. The driver holds nothing but the weights.
``step_gradient`` is a single step as a job of its own, for batches that no stage walks.
"""

from __future__ import annotations

import base64
import copy
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import int_div
from gridframe.functions.arrow import matrix, nested
from gridframe.functions.permute import permuted
from gridframe.functions.physics import DAY, GRAVITY, SPECIFIC_HEAT
from gridframe.operators import evaluate as errors
from gridframe.operators.batches import rank_batches
from gridframe.operators.index import shuffle_rows
from gridframe.operators.normalize import EPSILON
from gridframe.schema import HALF_LEVELS
from gridframe.session import delete_path, scratch_path

# Values of one block of summed gradients: what one reducing task holds at a time.
BLOCK = 8192

# Rows of a batch that a task takes through the network at a time.
SLICE = 4096

# Values that the tasks of a step exchange at a time, all together: some tens of MB as text.
EXCHANGE = 1 << 22

# Moment decay and floor of the Adam update.
BETA_1, BETA_2, ADAM_FLOOR = 0.9, 0.999, 1e-8


@dataclass
class Network:
    """Dense layers with an activation between them. ``levels`` set: two flux heads of levels x 2 with heating rates."""

    weights: list[np.ndarray]
    mean: np.ndarray | None = None
    std: np.ndarray | None = None
    dropout: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    levels: int | None = None
    loss_weights: dict[str, float] = field(default_factory=dict)
    history: list[tuple[int, int, float, int]] = field(default_factory=list)
    reports: list[tuple[int, str, float]] = field(default_factory=list)
    optimiser: Adam | None = None
    epochs: int = 0
    activation: str = "silu"


def _plain(net: Network) -> dict:
    """What tasks need of a network, in types that every executor knows."""
    return {k: v for k, v in vars(net).items() if k not in ("history", "reports", "optimiser", "epochs")}


def initial_weights(sizes: Sequence[int], seed: int, he: bool = False) -> list[np.ndarray]:
    """Matrix and bias of each layer, drawn uniformly; ``he`` widens the range and starts from zero biases."""
    rng = np.random.default_rng(seed)
    weights = []
    for n_in, n_out in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt(6.0 / n_in) if he else 1.0 / np.sqrt(n_in)
        weights.append(rng.uniform(-bound, bound, (n_in, n_out)))
        weights.append(np.zeros(n_out) if he else rng.uniform(-bound, bound, n_out))
    return weights


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class RowDraws:
    """Numbers in [0, 1) that depend on the seed, the step, a row's id, the layer and the unit, and on no partition."""

    def __init__(self, seed: int, step: int, row_ids: np.ndarray) -> None:
        start = _mixed(np.array([seed], dtype="int64").view("uint64") + np.uint64(0x9E3779B97F4A7C15))
        self.rows = _mixed(_mixed(start + np.uint64(step)) ^ np.asarray(row_ids, dtype="int64").view("uint64"))
        self.layer = 0

    def random(self, shape: tuple[int, int]) -> np.ndarray:
        self.layer += 1
        units = np.arange(shape[1], dtype="uint64") + np.uint64(self.layer << 32)
        return (_mixed(self.rows[:, None] + _mixed(units)[None]) >> np.uint64(11)) / 2.0**53


def activated(kind: str, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and slopes of an activation: ``silu`` (also called ``swish``), ``relu``, ``tanh`` or ``sigmoid``."""
    if kind == "relu":
        return np.maximum(z, 0.0), (z > 0).astype("f8")
    if kind == "tanh":
        value = np.tanh(z)
        return value, 1.0 - value * value
    gate = 1.0 / (1.0 + np.exp(-z))
    if kind == "sigmoid":
        return gate, gate * (1.0 - gate)
    if kind in ("silu", "swish"):
        return z * gate, gate + z * gate * (1.0 - gate)
    raise ValueError(f"unknown activation {kind}")


def forward(net: Network, x: np.ndarray, rng: np.random.Generator | RowDraws | None = None):
    """Output of a batch, and per layer its input, the slope of its activation and the mask of kept units."""
    a = x if net.mean is None else (x - net.mean) / (net.std + EPSILON)
    trace = []
    for k in range(0, len(net.weights), 2):
        z = a @ net.weights[k] + net.weights[k + 1]
        if k + 2 == len(net.weights):
            trace.append((a, None, None))
            return z, trace
        value, bend = activated(net.activation, z)
        keep = None
        if rng is not None and net.dropout:
            keep = (rng.random(z.shape) >= net.dropout) / (1.0 - net.dropout)
        trace.append((a, bend, keep))
        a = value if keep is None else value * keep
    raise ValueError("a network needs at least one layer")


def heating(flux: np.ndarray, pressure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heating rates of rows x levels x 2 fluxes, and the factor between net flux step and rate; zero without a
    pressure step."""
    step = np.diff(pressure, axis=1)
    factor = np.divide(-GRAVITY / SPECIFIC_HEAT * DAY, step, out=np.zeros_like(step), where=step != 0)
    return factor * np.diff(flux[:, :, 0] - flux[:, :, 1], axis=1), factor


def loss_and_slope(net: Network, out: np.ndarray, truth: dict[str, np.ndarray]) -> tuple[float, np.ndarray]:
    """Loss summed over rows and its slope in the outputs. A row's loss is the mean over its elements."""
    if net.levels is None:
        gap = out - truth["y"]
        return float((gap * gap).sum() / out.shape[1]), 2.0 * gap / out.shape[1]
    half, total, slope = out.shape[1] // 2, 0.0, np.zeros_like(out)
    for band, at in (("sw", 0), ("lw", half)):
        flux = out[:, at : at + half].reshape(len(out), net.levels, 2)
        gap = flux - truth[band].reshape(flux.shape)
        w = net.loss_weights.get(band, 1.0)
        total += w * float((gap * gap).sum()) / half
        back = 2.0 * w * gap / half
        rate, factor = heating(flux, truth["pressure"])
        gap = rate - truth[f"hr_{band}"]
        w = net.loss_weights.get(f"hr_{band}", 1.0) / rate.shape[1]
        total += w * float((gap * gap).sum())
        net_back = np.diff(np.pad(-2.0 * w * gap * factor, ((0, 0), (1, 1))), axis=1)
        back[:, :, 0] += net_back
        back[:, :, 1] -= net_back
        slope[:, at : at + half] = back.reshape(len(out), half)
    return total, slope


def gradient(net: Network, x: np.ndarray, truth: dict[str, np.ndarray], rng=None) -> tuple[float, list[np.ndarray]]:
    """Loss and gradient summed over the rows of a batch."""
    out, trace = forward(net, x, rng)
    loss, back = loss_and_slope(net, out, truth)
    found: list[np.ndarray] = []
    for k in range(len(trace) - 1, -1, -1):
        found[:0] = [trace[k][0].T @ back, back.sum(axis=0)]
        if k:
            _, bend, keep = trace[k - 1]
            back = (back @ net.weights[2 * k].T) * bend
            back = back if keep is None else back * keep
    return loss, found


def _sum_gradients(net_b, columns: dict[str, str], seed: int, step: int, row_id: str | None) -> Callable:
    """Task side of one step: one row per block of the summed gradient."""

    def run(batches):
        net, total, loss, rows = Network(**net_b.value), None, 0.0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            data = {key: matrix(batch.column(name)) for key, name in columns.items()}
            rng = RowDraws(seed, step, batch.column(row_id).to_numpy()) if net.dropout else None
            part, found = gradient(net, data.pop("x"), data, rng)
            flat = np.concatenate([g.ravel() for g in found])
            total = flat if total is None else total + flat
            loss, rows = loss + part, rows + batch.num_rows
        if rows:
            starts = range(0, len(total), BLOCK)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([s // BLOCK for s in starts], pa.int32()),
                    "slope": pa.array([total[s : s + BLOCK] for s in starts], pa.list_(pa.float64())),
                    "loss": pa.array([loss for _ in starts], pa.float64()),
                    "n_rows": pa.array([rows for _ in starts], pa.int64()),
                }
            )

    return run


def _add_blocks(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of one block over all tasks of a step."""
    total, loss, rows = None, 0.0, 0
    for batch in batches:
        part = matrix(batch.column("slope")).sum(axis=0)
        total = part if total is None else total + part
        loss += float(np.sum(batch.column("loss").to_numpy(zero_copy_only=False)))
        rows += int(np.sum(batch.column("n_rows").to_numpy(zero_copy_only=False)))
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "slope": pa.array([total], pa.list_(pa.float64())),
            "loss": pa.array([loss], pa.float64()),
            "n_rows": pa.array([rows], pa.int64()),
        }
    )


_BLOCKS = "block int, slope array<double>, loss double, n_rows bigint"


def step_gradient(
    rows: DataFrame, net: Network, columns: dict[str, str], seed: int = 0, step: int = 0, row_id: str | None = None
):
    """Mean loss and mean gradient over the rows of one batch, penalties included. Dropout needs the rows' unique id."""
    if net.dropout and row_id is None:
        raise ValueError("dropout is drawn by row: name the row id")
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(_plain(net))
    try:
        names = dict.fromkeys([*([row_id] if row_id else []), *columns.values()])
        parts = rows.select(*names).mapInArrow(_sum_gradients(shared, columns, seed, step, row_id), _BLOCKS)
        blocks = sorted(parts.groupBy("block").applyInArrow(_add_blocks, _BLOCKS).collect(), key=lambda b: b["block"])
    finally:
        shared.destroy()
    n = blocks[0]["n_rows"]
    loss, found = _mean_slopes(net, np.concatenate([np.asarray(b["slope"]) for b in blocks]), blocks[0]["loss"], n)
    return loss, found, n


def _mean_slopes(net: Network, total: np.ndarray, loss: float, n: int) -> tuple[float, list[np.ndarray]]:
    """Mean loss and gradient from the sums over ``n`` rows, penalties included."""
    flat, loss, found, at = total / n, loss / n, [], 0
    for k, w in enumerate(net.weights):
        g = flat[at : at + w.size].reshape(w.shape)
        at += w.size
        # The penalty is on the matrices of the hidden layers.
        if k % 2 == 0 and k + 2 < len(net.weights) and (net.l1 or net.l2):
            loss += net.l1 * np.abs(w).sum() + net.l2 * (w * w).sum()
            g = g + net.l1 * np.sign(w) + 2.0 * net.l2 * w
        found.append(g)
    return loss, found


class Adam:
    """Moment estimates of every weight and the update they give."""

    def __init__(self, lr: float) -> None:
        self.lr, self.t, self.m, self.v = lr, 0, None, None

    def move(self, weights: list[np.ndarray], slopes: list[np.ndarray]) -> list[np.ndarray]:
        self.t += 1
        self.m = [(1 - BETA_1) * g + (BETA_1 * m if self.m else 0) for g, m in zip(slopes, self.m or slopes)]
        self.v = [(1 - BETA_2) * g * g + (BETA_2 * v if self.v else 0) for g, v in zip(slopes, self.v or slopes)]
        first, second = 1 - BETA_1**self.t, 1 - BETA_2**self.t
        return [
            w - self.lr * (m / first) / (np.sqrt(v / second) + ADAM_FLOOR) for w, m, v in zip(weights, self.m, self.v)
        ]


@dataclass(frozen=True)
class StoredBatches:
    """Rows dealt into batches and stored by rank: ``world`` directories, each sorted by batch."""

    path: str
    n_batches: int
    schema: T.StructType
    n_rows: int
    world: int
    batch: int

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def rows(self, spark: SparkSession, batch: int) -> DataFrame:
        """One batch: a task for each rank at least, which skips the pages of other batches by their statistics."""
        return self.table(spark).where(F.col("batch_id") == batch)

    def remove(self, spark: SparkSession) -> None:
        delete_path(spark, self.path)


def store_batches(
    df: DataFrame, row_id: str, batch: int, seed: int, world: int = 1, files_per_rank: int = 1
) -> StoredBatches:
    """Rows in shuffled order, dealt to ``world`` ranks and into batches, and stored by rank.

    There is one directory per rank however many batches there are; a rank's rows lie in ``files_per_rank`` files of
    consecutive batches (raise it where a rank holds more than a task should write).
    """
    spark = df.sparkSession
    path = scratch_path(spark, "batches")
    dealt = rank_batches(shuffle_rows(df, row_id, seed, "position"), "position", batch, world)
    # The last position tells the number of batches, from ids alone.
    n_rows = df.select(row_id).count()
    n_batches = -(-(-(-n_rows // world)) // (batch // world))
    part = int_div(F.col("batch_id") * files_per_rank, max(n_batches, 1)).cast("int")
    file = F.col("rank").cast("int") * files_per_rank + part
    laid_out = dealt.withColumn("_file", file).repartitionById(world * files_per_rank, F.col("_file")).drop("_file")
    laid_out.sortWithinPartitions("rank", "batch_id", row_id).write.partitionBy("rank").parquet(path)
    fields = [f for f in dealt.schema.fields if f.name != "rank"]
    return StoredBatches(path, n_batches, T.StructType([*fields, T.StructField("rank", T.LongType())]), n_rows, world, batch)


_STATE = "kind string, block int, numbers array<double>"


def _sum_over_tasks(context: BarrierTaskContext, own: np.ndarray, tasks: int) -> np.ndarray:
    """The sum of the tasks' vectors, added in the order of the tasks in each of them; sent in parts of a bounded size."""
    if tasks == 1:
        return own
    total, part = np.zeros(len(own)), max(EXCHANGE // tasks, 1)
    for start in range(0, len(own), part):
        for text in context.allGather(base64.b64encode(own[start : start + part].tobytes()).decode()):
            total[start : start + part] += np.frombuffer(base64.b64decode(text))
    return total


def _walk_batches(net_b, columns: dict[str, str], seed: int, first_step: int, n_batches: int, tasks: int, row_id: str) -> Callable:
    """Task side of an epoch: rows come sorted by the batch's place in the epoch; the first task gives the result."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        """The task's rows of each batch that it has any of, as they come: a batch may take many parts."""
        for batch in batches:
            place = batch.column("_place").to_numpy()
            for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place)) + 1):
                for at in range(0, len(part), SLICE):
                    yield int(place[part[0]]), batch.slice(part[at], min(SLICE, len(part) - at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        given = dict(net_b.value)
        optimiser = Adam(0.0)
        vars(optimiser).update(given.pop("optimiser"))
        net, size = Network(**given), sum(w.size for w in given["weights"])
        mine, losses = shares(batches), []
        ahead = next(mine, None)
        for place in range(n_batches):
            own, widths = np.zeros(size + 2), None
            while ahead is not None and ahead[0] == place:
                rows = ahead[1]
                data = {key: matrix(rows.column(name)) for key, name in columns.items()}
                lengths = [block.shape[1] for block in data.values()]
                if widths not in (None, lengths):
                    raise ValueError("arrays of a batch differ in length")
                widths = lengths
                rng = RowDraws(seed, first_step + place, rows.column(row_id).to_numpy(zero_copy_only=False)) if net.dropout else None
                loss, found = gradient(net, data.pop("x"), data, rng)
                own += np.concatenate([*[g.ravel() for g in found], [loss, rows.num_rows]])
                ahead = next(mine, None)
            total = _sum_over_tasks(context, own, tasks)
            loss, slopes = _mean_slopes(net, total[:-2], total[-2], int(total[-1]))
            net.weights = optimiser.move(net.weights, slopes)
            losses += [float(loss), total[-1]]
        if context.partitionId() == 0:
            state = {"losses": np.array(losses)}
            for kind, arrays in (("weights", net.weights), ("m", optimiser.m), ("v", optimiser.v)):
                state[kind] = np.concatenate([a.ravel() for a in arrays])
            for kind, numbers in state.items():
                starts = range(0, len(numbers), BLOCK)
                yield pa.RecordBatch.from_pydict(
                    {
                        "kind": pa.array([kind for _ in starts], pa.string()),
                        "block": pa.array([s // BLOCK for s in starts], pa.int32()),
                        "numbers": pa.array([numbers[s : s + BLOCK] for s in starts], pa.list_(pa.float64())),
                    }
                )

    return run


def train_epoch(rows: DataFrame, net: Network, optimiser: Adam, columns: dict[str, str], row_id: str, n_batches: int, seed: int = 0, first_step: int = 0):
    """The network and the optimiser after all batches of an epoch, and the mean loss and number of rows of each batch.

    ``rows`` have ``rank`` (from 0) and ``_place``, the place of their batch in the epoch; every place up to
    ``n_batches`` holds a row. One stage of as many tasks as ranks, or as run at a time if those are fewer: each task
    must have its place at once, and a lost one repeats the stage. In a step all tasks exchange a vector as long as the
    weights through the driver. Sums are added by task, so weights follow the number of tasks by rounding alone.
    """
    sc = rows.sparkSession.sparkContext
    ranks = (rows.agg(F.max("rank")).first()[0] or 0) + 1
    tasks = max(1, min(int(ranks), sc.defaultParallelism))
    names = list(dict.fromkeys([row_id, *columns.values()]))
    dealt = rows.select("_place", (F.col("rank") % tasks).cast("int").alias("_task"), *names).repartitionById(tasks, F.col("_task"))
    sorted_ = dealt.drop("_task").sortWithinPartitions("_place", row_id)
    shared = sc.broadcast({**_plain(net), "optimiser": vars(optimiser)})
    try:
        walk = _walk_batches(shared, columns, seed, first_step, n_batches, tasks, row_id)
        found = sorted_.mapInArrow(walk, _STATE, barrier=True).collect()
    finally:
        shared.destroy()
    state = {k: np.concatenate([r["numbers"] for r in sorted(found, key=lambda r: r["block"]) if r["kind"] == k]) for k in ("losses", "weights", "m", "v")}
    at = np.cumsum([0, *[w.size for w in net.weights]])
    weights, m, v = ([state[k][a:b].reshape(w.shape) for a, b, w in zip(at, at[1:], net.weights)] for k in ("weights", "m", "v"))
    moved = Adam(optimiser.lr)
    moved.t, moved.m, moved.v = optimiser.t + n_batches, m, v
    return replace(net, weights=weights), moved, [(float(a), int(b)) for a, b in state["losses"].reshape(-1, 2)]


def _fit(df, net, columns, row_id, epochs, batch, lr, seed, world, files_per_rank, stored, validation, reshuffle=False, steps_as_jobs=False) -> Network:
    if reshuffle and steps_as_jobs:
        raise ValueError("a batch of reshuffled rows lies in all files: a job would read them all for each step")
    spark = df.sparkSession
    kept = df.select(row_id, *dict.fromkeys(columns.values()))
    own = store_batches(kept, row_id, batch, seed, world, files_per_rank) if stored is None else stored
    optimiser, rng = copy.copy(net.optimiser) or Adam(lr), np.random.default_rng(seed)
    history, reports = list(net.history), list(net.reports)
    try:
        for epoch in range(net.epochs + epochs):
            # A network trained before goes on after its epochs.
            order = range(own.n_batches) if epoch == 0 else rng.permutation(own.n_batches)
            if epoch < net.epochs or not own.n_batches:
                continue
            rows = own.table(spark)
            if reshuffle and epoch:
                rows = rank_batches(rows.withColumn("_new", permuted("position", own.n_rows, seed, epoch)), "_new", own.batch, own.world)
                rows = rows.withColumn("_place", F.col("batch_id"))
            elif epoch:
                place = F.lit([int(k) for k in np.argsort(order)])
                rows = rows.withColumn("_place", F.get(place, F.col("batch_id").cast("int")).cast("long"))
            else:
                rows = rows.withColumn("_place", F.col("batch_id"))
            step = len(history)
            if steps_as_jobs:
                losses = []
                for k, batch_id in enumerate(order):
                    loss, slopes, n = step_gradient(own.rows(spark, int(batch_id)), net, columns, seed, step + k, row_id)
                    net = replace(net, weights=optimiser.move(net.weights, slopes))
                    losses.append((float(loss), n))
            else:
                net, optimiser, losses = train_epoch(rows, net, optimiser, columns, row_id, own.n_batches, seed, step)
            history += [(epoch, step + k, loss, n) for k, (loss, n) in enumerate(losses)]
            reports.append((epoch, "train_loss", sum(loss * n for loss, n in losses) / max(sum(n for _, n in losses), 1)))
            for name, held_out in (validation or {}).items():
                reports += [(epoch, f"{name}_{measure}", value) for measure, value in held_out_losses(held_out, net, columns).items()]
    finally:
        if stored is None:
            own.remove(spark)
    return replace(net, history=history, reports=reports, optimiser=optimiser, epochs=net.epochs + epochs)


def held_out_losses(df: DataFrame, net: Network, columns: dict[str, str]) -> dict[str, float]:
    """The loss of training without penalties and dropout, over all rows, and the mean absolute error of flux heads' short-
    and long-wave heating rates (``hr_sw_mae``, ``hr_lw_mae``): one row per task reaches the driver's sum."""
    shared = df.sparkSession.sparkContext.broadcast(_plain(net))
    bands = ("sw", "lw") if net.levels is not None else ()

    def run(batches):
        net, totals, rows = Network(**shared.value), np.zeros(1 + len(bands)), 0
        for batch in batches:
            if batch.num_rows:
                data = {key: matrix(batch.column(name)) for key, name in columns.items()}
                out = forward(net, data.pop("x"))[0]
                totals[0] += loss_and_slope(net, out, data)[0]
                half = out.shape[1] // 2
                for i, band in enumerate(bands):
                    rate, _ = heating(out[:, i * half : (i + 1) * half].reshape(len(out), net.levels, 2), data["pressure"])
                    totals[i + 1] += np.abs(rate - data[f"hr_{band}"]).mean(axis=1).sum()
                rows += batch.num_rows
        yield pa.RecordBatch.from_pydict({"totals": pa.array([totals], pa.list_(pa.float64())), "n_rows": pa.array([rows], pa.int64())})

    sums = df.select(*dict.fromkeys(columns.values())).mapInArrow(run, "totals array<double>, n_rows bigint")
    names = ["loss", *[f"hr_{band}_mae" for band in bands]]
    total = sums.agg(F.sum("n_rows").alias("n"), *[F.sum(F.get("totals", F.lit(i))).alias(name) for i, name in enumerate(names)]).first()
    return {name: total[name] / total["n"] if total["n"] else float("nan") for name in names}


def mean_loss(df: DataFrame, net: Network, columns: dict[str, str]) -> float:
    """The loss over held-out rows."""
    return held_out_losses(df, net, columns)["loss"]


def _record_stats(stats: DataFrame | None, array: str):
    """Mean and deviation vectors of an array: as long as one record."""
    if stats is None:
        return None, None
    rows = stats.where(F.col("array") == array).orderBy("pos").select("mean", "std").collect()
    return np.array([r["mean"] for r in rows]), np.array([r["std"] for r in rows])


def fit_mlp(
    df: DataFrame,
    x: str,
    y: str,
    row_id: str,
    stats: DataFrame | None = None,
    hidden: Sequence[int] = (100, 100, 100),
    epochs: int = 1,
    batch: int = 512,
    lr: float = 1e-4,
    seed: int = 42,
    world: int = 1,
    weights: list[np.ndarray] | None = None,
    files_per_rank: int = 1,
    stored: StoredBatches | None = None,
    validation: dict[str, DataFrame] | None = None,
    resume: Network | None = None,
    reshuffle: bool = False,
    steps_as_jobs: bool = False,
) -> Network:
    """Normalise, dense layers with SiLU, a linear layer; mean squared error, one update per batch over all tasks.

    A batch is dealt to ``world`` ranks, and an epoch is one stage of as many tasks (:func:`train_epoch`); so the batch
    should grow with ``world``. Later epochs take the stored batches in another order or, with ``reshuffle``, all rows,
    by a new permutation of their positions each epoch. The update is Adam's. An exchange inside a stage takes a second,
    as barriers are polled; with ``world`` 1 there is none, and ``steps_as_jobs`` runs a job per batch instead, which is
    faster while a job takes less than that. The stored rows go when training ends; ``stored`` (from ``store_batches``) is used instead and stays, for
    several fits over the same rows. After each epoch the training loss and the loss on each frame of ``validation``
    are added to ``reports`` as (epoch, ``train_loss`` or ``{name}_loss``, value). ``resume`` is a network to train for
    ``epochs`` more, as if it had not stopped.
    """
    if resume is not None:
        return _fit(df, resume, {"x": x, "y": y}, row_id, epochs, batch, lr, seed, world, files_per_rank, stored, validation, reshuffle, steps_as_jobs)
    mean, std = _record_stats(stats, x)
    if weights is None:
        lengths = df.select(F.size(x), F.size(y)).first()
        weights = initial_weights([lengths[0], *hidden, lengths[1]], seed)
    net = Network(weights, mean, std)
    return _fit(df, net, {"x": x, "y": y}, row_id, epochs, batch, lr, seed, world, files_per_rank, stored, validation, reshuffle, steps_as_jobs)


def fit_flux_heads(
    df: DataFrame,
    x: str,
    targets: dict[str, str],
    row_id: str,
    levels: int = HALF_LEVELS,
    stats: DataFrame | None = None,
    width: int = 128,
    depth: int = 4,
    l1: float = 1e-3,
    l2: float = 1e-3,
    dropout: float = 0.5,
    lr: float = 1e-4,
    epochs: int = 1,
    batch: int = 256,
    seed: int = 42,
    world: int = 1,
    loss_weights: dict[str, float] | None = None,
    weights: list[np.ndarray] | None = None,
    files_per_rank: int = 1,
    stored: StoredBatches | None = None,
    validation: dict[str, DataFrame] | None = None,
    reshuffle: bool = False,
    steps_as_jobs: bool = False,
    activation: str = "silu",
    resume: Network | None = None,
) -> Network:
    """Dense layers with penalties and dropout, two heads of levels x 2 fluxes, and the heating rates they imply.

    ``targets`` names the columns of sw, lw (levels x 2), hr_sw, hr_lw (levels - 1) and pressure (levels). Frames of
    ``validation`` also report the heating rates' absolute errors; ``resume`` is a network to train on.
    """
    if resume is not None:
        return _fit(df, resume, {"x": x, **targets}, row_id, epochs, batch, lr, seed, world, files_per_rank, stored, validation, reshuffle, steps_as_jobs)
    mean, std = _record_stats(stats, x)
    if weights is None:
        n_in = df.select(F.size(x)).first()[0]
        weights = initial_weights([n_in, *[width] * depth, 4 * levels], seed, he=True)
    net = Network(weights, mean, std, dropout, l1, l2, levels, loss_weights or {}, activation=activation)
    return _fit(df, net, {"x": x, **targets}, row_id, epochs, batch, lr, seed, world, files_per_rank, stored, validation, reshuffle, steps_as_jobs)


def _score(net_b, x: str, pressure: str | None) -> Callable:
    def run(batches):
        net = Network(**net_b.value)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            out, _ = forward(net, matrix(batch.column(x)))
            found = [out] if net.levels is None else []
            if net.levels is not None:
                half = out.shape[1] // 2
                for at in (0, half):
                    flux = out[:, at : at + half]
                    cube = flux.reshape(len(out), net.levels, 2)
                    rate, _ = heating(cube, matrix(batch.column(pressure)))
                    found += [flux, rate]
            labels = ["y_hat"] if net.levels is None else ["sw_hat", "hr_sw_hat", "lw_hat", "hr_lw_hat"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(nested, found)], names=[*names, *labels])

    return run


def predict(df: DataFrame, net: Network, x: str, pressure: str | None = None) -> DataFrame:
    """``y_hat`` of every row; from flux heads the fluxes and heating rates of both bands."""
    shared = df.sparkSession.sparkContext.broadcast(_plain(net))
    labels = ["y_hat"] if net.levels is None else ["sw_hat", "hr_sw_hat", "lw_hat", "hr_lw_hat"]
    added = [T.StructField(label, T.ArrayType(T.DoubleType())) for label in labels]
    schema = T.StructType([*df.schema.fields, *added])
    return df.mapInArrow(_score(shared, x, pressure), schema)


def evaluate(df: DataFrame, net: Network, x: str, y: str, stage: str) -> DataFrame:
    """Mean squared error of a pass over held-out rows."""
    scored = predict(df, net, x)
    return errors.mse(scored, "y_hat", y).select(F.lit(stage).alias("stage"), "n", "mse")


def evaluate_flux_heads(df: DataFrame, net: Network, x: str, targets: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The four losses with their weighted sum, and the mean absolute errors."""
    scored = predict(df, net, x, targets["pressure"])
    pairs = {k: (f"{k}_hat", targets[k]) for k in ("sw", "hr_sw", "lw", "hr_lw")}
    return errors.weighted_mse(scored, pairs, net.loss_weights), errors.mae(scored, pairs)
