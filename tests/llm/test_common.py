import random

import pytest

from fernweave.llm.common import BATCH_BYTES, bounded_batches, cleared, components, held, shared_dir, written


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(2000, 2100)] + [(7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root if i not in alone}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_worker_holds_one_operator():
    assert held(("one", 1), list) is held(("one", 1), list)
    first = held(("one", 2), list)
    held(("two",), list)
    assert held(("one", 2), list) is not first


def test_left_tables_are_removed(spark, tmp_path):
    at = str(tmp_path / "t")
    assert written(spark.range(3), at).count() == 3
    assert cleared(spark) >= 1 and not (tmp_path / "t").exists()


def test_written_files_have_no_checksum_files(spark, tmp_path):
    """Hadoop's usual class for local files starts ``chmod`` for each checksum file too; without these there are fewer."""
    assert written(spark.range(100).repartition(5), f"file://{tmp_path}/t").count() == 100
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 5 and not list((tmp_path / "t").glob(".*.crc"))


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "a"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        shared_dir(Cluster)


def test_batches_are_bounded_and_smaller_bounds_stay(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    for given, then in (("1m", "1m"), ("64m", f"{BATCH_BYTES}b")):
        spark.conf.set(key, given)
        bounded_batches(spark)
        assert spark.conf.get(key) == then
    spark.conf.set(key, before)
