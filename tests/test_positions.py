import glob

import pytest

from quotelens.operators import positions


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, NULL, 'same') AS text")
    ordered = rows.repartitionByRange(5, "id").sortWithinPartitions("id")
    # Small row groups: the index of a row counts over all groups and splits of its file.
    ordered.write.option("parquet.block.size", 1024).parquet(path)
    spark.range(0).selectExpr("id", "'x' AS text").write.mode("append").parquet(path)
    return path


def test_positions_batches_and_slices(spark, stored):
    df = spark.read.parquet(stored)
    files = positions.index(df)
    assert files.count() == 5
    assert all(r.id == r.position for r in positions.numbered(df, files).collect())
    assert positions.numbered(df.select("text"), files).columns == ["text", "position"]
    got = positions.batches(df.select("id"), files, 7).collect()
    assert len(got) == 1000 and all(r.batch == r.id // 7 + 1 for r in got)
    for first, n in ((0, 1), (0, 1000), (150, 300), (999, 5), (1000, 5), (10, 0)):
        ids = sorted(r.id for r in positions.between(df, files, first, n).collect())
        assert ids == list(range(first, min(first + n, 1000)))
    slices = {tuple(sorted(r.id for r in positions.sample(df, files, 6, seed).collect())) for seed in range(4)}
    assert len(slices) > 1 and all(s == tuple(range(s[0], s[0] + 6)) for s in slices)


def test_nothing_is_shuffled(spark, stored):
    df = spark.read.parquet(stored)
    plan = positions.batches(df, positions.index(df), 8)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Sort" not in plan


def test_a_slice_opens_only_its_files(spark, stored):
    df = spark.read.parquet(stored)
    files = positions.index(df)
    parts = sorted(glob.glob(f"{stored}/part-*"), key=lambda p: p.rsplit("/", 1)[1])
    kept = next(p for p in parts if "part-00002" in p)
    for part in set(parts) - {kept}:
        with open(part, "wb") as broken:
            broken.write(b"not parquet")
    start = [r for r in files.collect() if "part-00002" in r[0]][0][2]
    again = spark.read.schema(df.schema).parquet(stored)
    got = sorted(r.id for r in positions.between(again, files, start + 3, 20).collect())
    assert got == list(range(start + 3, start + 23))
    with pytest.raises(Exception):
        again.agg({"id": "sum"}).collect()


def test_many_files_are_joined(spark, stored, monkeypatch):
    monkeypatch.setattr(positions, "_FEW", 1)
    df = spark.read.parquet(stored)
    assert positions.between(df, positions.index(df), 100, 700).count() == 700


def test_edges(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    df = spark.read.parquet(path)
    files = positions.index(df)
    assert positions.numbered(df, files).count() == 0 == positions.between(df, files, 0, 5).count()
    with pytest.raises(ValueError):
        positions.sample(df, files, 1, 0)
    with pytest.raises(ValueError):
        positions.numbered(df, files, "id")
