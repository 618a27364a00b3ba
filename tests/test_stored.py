"""Networks as tables, and a catalogue with several writers."""

import os
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.plans import learn, stored
from gridframe.session import create_once
from gridframe.sources import catalog


@pytest.fixture(scope="module")
def records(spark):
    x = np.random.default_rng(0).normal(size=(60, 3))
    rows = [(i, x[i].tolist(), [float(x[i].sum())]) for i in range(60)]
    return spark.createDataFrame(rows, "column_id bigint, x array<double>, y array<double>").persist()


def test_a_network_comes_back_whole(spark, records, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "BLOCK", 5)
    stats = spark.createDataFrame([("x", i, float(i), 1.0 + i) for i in range(3)], "array string, pos int, mean double, std double")
    more = {"hidden": (4,), "batch": 30, "world": 1, "lr": 0.05}
    net = learn.fit_mlp(records, "x", "y", "column_id", stats, epochs=1, validation={"val": records}, **more)
    stored.save_network(spark, net, str(tmp_path / "net"))
    back = stored.load_network(spark, str(tmp_path / "net"))
    for a, b in zip([*net.weights, net.mean, net.std, *net.optimiser.m], [*back.weights, back.mean, back.std, *back.optimiser.m]):
        assert a.shape == b.shape and (a == b).all()
    assert (back.history, back.reports, back.epochs, back.optimiser.t) == (net.history, net.reports, 1, 2)
    # Training goes on from the stored network as from the one at hand.
    one, other = (learn.fit_mlp(records, "x", "y", "column_id", resume=n, epochs=1, **more) for n in (net, back))
    assert all((a == b).all() for a, b in zip(one.weights, other.weights))
    layers = {(r["part"], r["layer"]): r for r in stored.network_layers(spark, str(tmp_path / "net")).collect()}
    assert layers["weights", 0]["shape"] == [3, 4] and layers["weights", 0]["blocks"] == 3
    assert layers["weights", 0]["norm"] == pytest.approx(np.linalg.norm(net.weights[0]))
    with pytest.raises(Exception, match="exists"):
        stored.save_network(spark, net, str(tmp_path / "net"))


def test_flux_heads_come_back(spark, tmp_path):
    net = learn.Network(learn.initial_weights([3, 4, 16], 1), dropout=0.5, l1=0.1, l2=0.2, levels=4, loss_weights={"sw": 2.0})
    stored.save_network(spark, net, str(tmp_path / "net"))
    back = stored.load_network(spark, str(tmp_path / "net"))
    assert (back.dropout, back.l1, back.l2, back.levels, back.loss_weights, back.mean, back.optimiser) == (0.5, 0.1, 0.2, 4, {"sw": 2.0}, None, None)


def test_a_broken_table_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "BLOCK", 4)
    path = str(tmp_path / "net")
    stored.save_network(spark, learn.Network(learn.initial_weights([3, 4, 1], 1)), path)
    rows = spark.read.parquet(path)
    rows.where("NOT (part = 'weights' AND layer = 0 AND at = 4)").write.parquet(path + "-less")
    rows.unionByName(rows.where("part = 'weights'")).write.parquet(path + "-more")
    for broken in ("-less", "-more"):
        with pytest.raises(ValueError):
            stored.load_network(spark, path + broken)


def test_another_session_scores_with_the_path_alone(spark, records, tmp_path):
    net = learn.Network(learn.initial_weights([3, 2, 1], 4))
    stored.save_network(spark, net, str(tmp_path / "net"))
    records.write.parquet(str(tmp_path / "rows"))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from gridframe.session import build_session\n"
        "from gridframe.plans.stored import predict_stored\n"
        "spark = build_session('local[1]', 'other', **{'spark.ui.enabled': 'false'})\n"
        "predict_stored(spark.read.parquet(sys.argv[2] + '/rows'), sys.argv[2] + '/net', 'x').write.parquet(sys.argv[2] + '/scored')\n"
    )
    subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], check=True, timeout=300, capture_output=True)
    got = {r["column_id"]: r["y_hat"] for r in spark.read.parquet(str(tmp_path / "scored")).collect()}
    here = {r["column_id"]: r["y_hat"] for r in learn.predict(records, net, "x").collect()}
    assert got == here


def entry(spark, step, rows):
    df = spark.range(rows).select(F.lit(0).alias("shard"), F.array(F.lit(1.0).cast("float")).alias("x"))
    return catalog.describe_table(df, step, "flattened")


def test_only_one_of_many_makes_a_file(spark, tmp_path):
    done, start = [], threading.Barrier(8)

    def writer(number):
        start.wait()
        done.append(create_once(spark, f"{tmp_path}/a b/log", str(number)))

    threads = [threading.Thread(target=writer, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == [False] * 7 + [True]
    assert os.listdir(f"{tmp_path}/a b") == ["log"]


def test_two_writers_lose_nothing(spark, tmp_path):
    """Both look, then both write, again and again: every entry is there, also across whole states."""
    path, start, numbers = str(tmp_path / "catalog"), threading.Barrier(2), []

    def writer(first):
        for i in range(6):
            start.wait()
            numbers.append(catalog.catalog_upsert(spark, path, entry(spark, first + i, 1 + i)))

    threads = [threading.Thread(target=writer, args=(first,)) for first in (100, 200)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = {r["step"]: r["dataset_len"] for r in catalog.read_catalog(spark, path).collect()}
    assert found == {first + i: 1 + i for first in (100, 200) for i in range(6)}
    # Twelve commits of their own and one whole state at the ninth number.
    assert sorted(numbers) == [n for n in range(1, 14) if n != 9]
    assert [n for n, _ in catalog._commits(spark, path)] == [9, 10, 11, 12, 13]
    catalog.catalog_upsert(spark, path, entry(spark, 100, 50))
    assert catalog.entry_of(spark, path, 100, "flattened")["dataset_len"] == 50
    with pytest.raises(FileNotFoundError):
        catalog.read_catalog(spark, str(tmp_path / "none"))
