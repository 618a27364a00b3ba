"""Queries over records that no number of equal shards holds."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from gridframe.sources import shards

NAMES = ["s8_read_shards", "s10_read_shard", "k7_write_graphs", "g5_graph_get"]


@pytest.fixture(scope="module")
def uneven(spark, sf, tmp_path_factory):
    """The given tables with 206 embeddings in a file of their own: 10 shards of 20 rows leave 6, 20 of 10 leave 6."""
    folder = tmp_path_factory.mktemp("uneven")
    for table in ("region nation customer supplier part orders lineitem events documents pages benchmark labels conversations").split():
        (folder / f"{table}.parquet").symlink_to(f"{sf}/{table}.parquet")
    values = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.sin(F.col("vec_id") * 64 + i).cast("float"))
    rows = spark.range(206, numPartitions=1).select(F.col("id").alias("vec_id"), (F.col("id") % 10).cast("int").alias("label"))
    rows.select("vec_id", values.alias("embedding"), "label").write.parquet(str(folder / "embeddings"))
    (file,) = (folder / "embeddings").glob("part-*.parquet")
    (folder / "embeddings.parquet").symlink_to(file)
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_over_uneven_records(spark, uneven, name):
    assert differences(queries()[name](spark, uneven), connect(uneven), oracle_sql()[name]) == []


def test_rows_left_over_fill_further_shards(spark, tmp_path):
    df = spark.range(39).select(F.col("id").alias("column_id"), F.array("id").alias("x"))
    for n, files, sizes in ((10, 1, [3] * 13), (7, 2, [5] * 7 + [4]), (20, 1, [1] * 39)):
        path = str(tmp_path / f"s{n}")
        shards.write_shards(df, path, n, files_per_shard=files, uneven=True)
        stored = spark.read.parquet(path)
        counts = stored.groupBy("shard").count().orderBy("shard").collect()
        assert [tuple(r) for r in counts] == list(enumerate(sizes))
        assert sorted((r.column_id, r.shard) for r in stored.collect()) == [(i, i // (39 // n)) for i in range(39)]
    with pytest.raises(ValueError, match="equal shards"):
        shards.write_shards(df, str(tmp_path / "few"), 40, uneven=True)
