"""A task takes a batch through the network part by part, however many rows its share has."""

import numpy as np
import pyarrow as pa
import pytest

from gridframe.plans import learn


class _Context:
    @staticmethod
    def get():
        return _Context()

    def partitionId(self):
        return 0


class _Shared:
    def __init__(self, net, optimiser):
        self.value = {**learn._plain(net), "optimiser": vars(optimiser)}


def _batches(x: np.ndarray, y: np.ndarray, place: np.ndarray, rows: int):
    for at in range(0, len(x), rows):
        part = slice(at, at + rows)
        yield pa.RecordBatch.from_pydict(
            {"_place": pa.array(place[part]), "id": pa.array(np.arange(len(x))[part]), "x": pa.array(x[part].tolist()), "y": pa.array(y[part].tolist())}
        )


@pytest.mark.parametrize("dropout", [0.0, 0.5])
def test_a_share_is_never_held_whole(monkeypatch, dropout):
    rng = np.random.default_rng(1)
    x, y, place = rng.normal(size=(30_000, 2)), rng.normal(size=(30_000, 1)), np.repeat([0, 1, 2], [20_000, 1, 9_999])
    net, seen, whole = learn.Network(learn.initial_weights([2, 3, 1], 1), dropout=dropout), [], learn.gradient
    monkeypatch.setattr(learn, "BarrierTaskContext", _Context)
    monkeypatch.setattr(learn, "gradient", lambda net, x, *more: (seen.append(len(x)), whole(net, x, *more))[1])
    walk = learn._walk_batches(_Shared(net, learn.Adam(0.1)), {"x": "x", "y": "y"}, 5, 0, 3, 1, "id")
    state = {row["kind"]: row["numbers"] for part in walk(_batches(x, y, place, 7_000)) for row in part.to_pylist()}
    assert max(seen) <= learn.SLICE and sum(seen) == 30_000

    weights, optimiser, losses = net.weights, learn.Adam(0.1), []
    for step in range(3):
        rows = place == step
        now = learn.Network(weights, dropout=dropout)
        draws = learn.RowDraws(5, step, np.flatnonzero(rows)) if dropout else None
        loss, found = whole(now, x[rows], {"y": y[rows]}, draws)
        loss, slopes = learn._mean_slopes(now, np.concatenate([g.ravel() for g in found]), loss, rows.sum())
        weights, losses = optimiser.move(weights, slopes), [*losses, loss, rows.sum()]
    assert state["weights"] == pytest.approx(np.concatenate([w.ravel() for w in weights]))
    assert state["losses"] == pytest.approx(losses)


@pytest.mark.parametrize("name", ["x", "y"])
def test_ragged_parts_of_a_batch_are_refused(monkeypatch, name):
    monkeypatch.setattr(learn, "BarrierTaskContext", _Context)
    given = [{"_place": [0], "id": [i], "x": [[1.0]], "y": [[1.0]], name: [[1.0] * (i + 1)]} for i in range(2)]
    net = learn.Network([np.ones((1, 1)), np.zeros(1)])
    walk = learn._walk_batches(_Shared(net, learn.Adam(0.1)), {"x": "x", "y": "y"}, 5, 0, 1, 1, "id")
    with pytest.raises(ValueError, match="differ in length"):
        list(walk(iter([pa.RecordBatch.from_pydict(rows) for rows in given])))
