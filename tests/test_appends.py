import glob
import os

import pytest
from pyspark.sql import functions as F

from quotelens.sources import appends, readers, writers


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_retry_after_a_crash_between_splits(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(10)
    path, _ = writers.new_attempt(root, "docs", "v9")
    rows.write.parquet(f"{path}/split=train")  # breaks off here
    with pytest.raises(ValueError, match="no such published version"):
        readers.read_version(spark, root, "docs")
    writers.write_version(rows.filter("id < 4"), root, "docs", "v9", split="train")
    assert ids(readers.read_version(spark, root, "docs", "v9")) == [0, 1, 2, 3]
    with pytest.raises(writers.AlreadyPublished):
        writers.write_version(rows, root, "docs", "v9", split="train")
    writers.write_version(rows.filter("id < 2"), root, "docs", "v10", split="train")
    assert readers.read_version(spark, root, "docs").first()["version"] == "v10"  # not the largest tag
    assert writers.vacuum(spark, root, older_than_hours=1) == []
    assert [p.split("/")[:2] for p in writers.vacuum(spark, root, older_than_hours=-1)] == [["key=docs", "version=v9"]]
    assert not os.path.exists(path)
    assert ids(readers.read_version(spark, root, "docs", "v9")) == [0, 1, 2, 3]


def test_of_two_writers_one_publishes(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    attempts = []
    for n in (3, 5):
        path, attempt = writers.new_attempt(root, "docs", "v1")
        spark.range(n).withColumn("split", F.lit("train")).write.partitionBy("split").parquet(path)
        attempts.append(attempt)
    writers.publish(spark, root, "docs", "v1", attempts[0])
    # the second one has looked before the first one published
    monkeypatch.setattr(writers, "refuse_published", lambda *_: None)
    with pytest.raises(writers.AlreadyPublished):
        writers.publish(spark, root, "docs", "v1", attempts[1])
    assert readers.read_version(spark, root, "docs").count() == 3
    assert readers.list_versions(spark, root).count() == 1


def test_versions_without_attempts_are_still_read(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{root}/key=docs/version=1")
    old = spark.range(1).select(F.lit("docs").alias("key"), F.lit("1").alias("version"), F.current_timestamp().alias("published"))
    old.write.parquet(f"{root}/manifest")
    assert ids(readers.read_version(spark, root, "docs")) == [0, 1, 2]


def test_append_adds_new_keys_only(spark, tmp_path):
    root, schema = str(tmp_path), "id bigint, part string, v int"
    first = [(i, "a", i) for i in range(300)] + [(None, None, 1), (1, None, 7), (5, "a", -5)]
    second = [(i, "a", 1_000 + i) for i in range(200, 400)] + [(None, None, 0), (1, None, 0), (1, "b", 0), (1, "b", -1)]
    assert appends.append_new(spark.createDataFrame(first, schema), root, "t", ["id", "part"], "v9", 8) == 0
    opened = appends.append_new(spark.createDataFrame(second, schema), root, "t", ["id", "part"], "v10", 8)
    assert 0 < opened <= 8
    assert appends.append_new(spark.createDataFrame(second, schema), root, "t", ["id", "part"], "v11", 8) > 0
    found = {(r["id"], r["part"]): (r["v"], r["version"]) for r in appends.read_appended(spark, root, "t").collect()}
    assert appends.read_appended(spark, root, "t").count() == len(found) == 300 + 2 + 100 + 1
    assert found[5, "a"] == (-5, "v9") and found[1, "b"] == (-1, "v10") and found[None, None] == (1, "v9")
    assert found[250, "a"] == (250, "v9") and found[350, "a"] == (1_350, "v10")
    assert appends.read_appended(spark, root, "t", upto="v9").count() == 302
    assert appends.repeated_keys(spark, root, "t").count() == 0
    with pytest.raises(writers.AlreadyPublished):
        appends.append_new(spark.createDataFrame(second, schema), root, "t", ["id", "part"], "v9", 8)


def test_only_ranges_with_hits_are_opened(spark, tmp_path):
    root = str(tmp_path)
    appends.append_new(spark.range(2_000), root, "t", "id", "base", 16)
    new = spark.createDataFrame([(7,), (10_000_007,)], "id bigint")
    where = new.select(appends._range(appends._digest(["id"]), 16).alias("r"), "id").collect()
    mine = {r["r"] for r in where}
    for path in glob.glob(f"{root}/key=t/version=base/*/rows/key_range=*/*.parquet"):
        if int(path.split("key_range=")[1].split("/")[0]) not in mine:
            with open(path, "wb") as broken:  # a reader that opened it would fail
                broken.write(b"not a table")
    assert appends.append_new(new, root, "t", "id", "more", 16) <= len(mine)
    stored = spark.read.parquet(*glob.glob(f"{root}/key=t/version=more/*/rows"))
    assert ids(stored) == [10_000_007]


def test_filters_never_miss_and_seldom_err(spark):
    def keyed(low, high):
        digest = appends._digest(["id"])
        return spark.range(low, high).select(appends._range(digest, 4).alias("key_range"), digest.alias("key_hash"))

    filters = appends.bloom_filters(keyed(0, 5_000)).withColumn("path", F.lit("x"))
    assert appends.candidates(keyed(0, 5_000), filters).count() == 5_000
    assert appends.candidates(keyed(5_000, 25_000), filters).count() < 0.02 * 20_000
    assert appends.bloom_filters(keyed(0, 0)).count() == 0


def test_csv_without_line_ends_is_split(spark, tmp_path):
    from quotelens.schemas import RAW_NLI

    with open(tmp_path / "raw.csv", "w") as file:
        file.write(",".join(RAW_NLI.names) + "\n")
        file.writelines(f"{i},text {i},h,q,entailment,\"[\"\"e{i}\"\"]\"\n" for i in range(2_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        one = readers.read_raw(spark, str(tmp_path / "raw.csv"), "csv")
        many = readers.read_raw(spark, str(tmp_path / "raw.csv"), "csv", multi_line=False)
        assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 3
        assert sorted(one.collect()) == sorted(many.collect()) and many.count() == 2_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
