import json

import pytest
from pyspark.sql import functions as F

from quotelens.operators import answers as ans
from quotelens.plans import jobs
from quotelens.schemas import ANSWER_FIELDS, LONG_FORM, RAW_NLI
from quotelens.sources import readers, writers


def test_versions_and_splits(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(10).withColumn(
        "split", F.when(F.col("id") < 6, "train").when(F.col("id") < 8, "validation").otherwise("test")
    )
    writers.write_version(rows, root, "docs", "0009")
    writers.write_version(rows.filter("id < 3"), root, "docs", "0010")
    writers.write_version(rows.drop("split"), root, "other", "7", split="train")
    assert readers.read_version(spark, root, "docs").count() == 3
    assert readers.read_version(spark, root, "docs", "0009").count() == 10
    splits = readers.read_splits(spark, root, "docs", "0009")
    assert {s: d.count() for s, d in splits.items()} == {"train": 6, "validation": 2, "test": 2}
    assert sorted(map(tuple, readers.list_versions(spark, root).collect())) == [
        ("docs", "0009"), ("docs", "0010"), ("other", "7"),
    ]
    plan = splits["test"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "version=0010" not in plan
    own = {"b": ("0011", rows.withColumn("b", F.lit(1))), "c": ("0012", rows.withColumn("c", F.lit("x")))}
    for tag, df in own.values():
        writers.write_version(df, root, "docs", tag)
    for column, (tag, _) in own.items():
        columns = readers.read_version(spark, root, "docs", tag).columns
        assert set(columns) == {"id", "split", "key", "version", column}
    assert "c" in readers.read_version(spark, root, "docs").columns
    rows.filter("split = 'train'").write.partitionBy("split").parquet(f"{root}/key=docs/version=0013")
    assert "c" in readers.read_version(spark, root, "docs").columns  # 0013 is not published
    for key, tag in (("docs", "0013"), ("docs", "none"), ("none", "latest")):
        with pytest.raises(ValueError, match="no such published version"):
            readers.read_version(spark, root, key, tag)
    with pytest.raises(Exception, match="already exists"):
        writers.write_version(rows, root, "docs", "0009")


def test_version_tag(spark):
    stamp = F.lit("2024-01-31 09:30:59").cast("timestamp")
    assert spark.range(1).select(writers.version_tag(stamp)).first()[0] == "20240131_0930"


def test_required_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).withColumn("text", F.lit("x")).write.parquet(path)
    with pytest.raises(ValueError, match="inference"):
        readers.read_checked(spark, path)
    assert readers.read_checked(spark, path, ["text"]).count() == 2


def test_long_form_lines(spark, tmp_path):
    row = {"subset": "train", "premise": "p", "hypothesises/labels": [{"hypothesis": "h", "label": "e"}] * 2}
    (tmp_path / "l.jsonl").write_text("\n".join(json.dumps({**row, "premise": str(i)}) for i in range(3)))
    df = readers.read_jsonl(spark, str(tmp_path), LONG_FORM)
    from quotelens.operators.curate import explode_hypotheses

    flat = explode_hypotheses(df)
    assert flat.count() == 6 and flat.columns == ["subset", "premise", "hypothesis", "label"]


def test_metrics_keep_nulls(spark, tmp_path):
    writers.write_metrics(spark.sql("select 2L as count, cast(null as double) as x"), str(tmp_path / "m"))
    lines = [line for p in (tmp_path / "m").glob("*.json") for line in p.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"count": 2, "x": None}]


def test_prompts_and_tokens(spark, tmp_path):
    payload = {"inputs": "é\n\"q\"", "parameters": {"temperature": 0.2, "top_p": 0.95, "max_new_tokens": 5, "response_format": {"type": "x"}}}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p1.txt").write_text(json.dumps(payload, ensure_ascii=False))
    prompts = readers.read_prompts(spark, str(tmp_path / "in"))
    row = prompts.first()
    assert row.inputs == payload["inputs"] and row.parameters.max_new_tokens == 5
    assert json.loads(row.parameters.response_format) == {"type": "x"}
    writers.write_prompts(prompts, str(tmp_path / "out"))
    assert readers.read_prompts(spark, str(tmp_path / "out")).first().inputs == payload["inputs"]
    arrays = spark.sql("select array(1,2) input_ids, array(1,1) attention_mask, array(-100,2) labels, 1 as other")
    writers.write_tokens(arrays, str(tmp_path / "tokens"))
    assert spark.read.parquet(str(tmp_path / "tokens")).columns == ["input_ids", "attention_mask", "labels"]


def log_block(ts, contract, output):
    prompt = f"<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n{contract}<|im_end|>\n<|im_start|>assistant\n"
    return f"timestamp: {ts}\ninput: {json.dumps({'inputs': prompt, 'parameters': {}})}\noutput: {output}\n"


def test_request_log_to_scores(spark, tmp_path):
    contract = "first line of it\n\nthe receiving party shall not copy"
    fields = ("q1", "entailment", "h", "the receiving party shall pay")
    inner = json.dumps({"Hypotheses": [dict(zip(ANSWER_FIELDS, fields))]})
    good = json.dumps({"generated_text": inner})
    (tmp_path / "out.txt.0").write_text("\n" + "\n".join([log_block(10, contract, good), log_block(30, "c", "")]))
    (tmp_path / "out.txt.12").write_text("\n" + log_block(20, "c", good[:-5]))
    log = readers.read_request_log(spark, str(tmp_path))
    assert sorted((r.client, r.ts_ms, r.output == "") for r in log.collect()) == [
        ("0", 10, False), ("0", 30, True), ("12", 20, False),
    ]
    assert sorted(r.status for r in ans.parse_response(log).collect()) == ["bad_outer", "bad_outer", "ok"]
    scored = jobs.score_log(log).collect()
    assert len(scored) == 1 and scored[0].contract == contract
    assert abs(scored[0].carp - 2 / 3) < 1e-12


def test_summary_files_with_noise(spark, tmp_path):
    body = json.dumps({"tokenizer": "t", "totalRequests": 4, "tps": 0.5}, indent=1)
    (tmp_path / "a.json").write_text("Loading: prompts\n" + body)
    (tmp_path / "b.json").write_text(body)
    rows = readers.read_bench_summary(spark, str(tmp_path)).collect()
    assert [(r.tokenizer, r.totalRequests, r.tps) for r in rows] == [("t", 4, 0.5)] * 2


def test_training_log_files(spark, tmp_path):
    (tmp_path / "r1.json").write_text(json.dumps([{"loss": 1.5, "step": 1, "epoch": 0.1}, {"eval_loss": 2, "step": 2}], indent=1))
    rows = readers.read_training_log(spark, str(tmp_path)).orderBy("step").collect()
    assert [tuple(r) for r in rows] == [("r1.json", 1, 1.5, None), ("r1.json", 2, None, 2.0)]


def test_csv_lists(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(1, 'a "quoted"\nline', "h", "q1", "entailment", '["x, y", "z"]')]
    names = RAW_NLI.names
    spark.createDataFrame(rows, names).write.options(header="true", escape='"').csv(path)
    row = readers.read_raw(spark, path, "csv").first()
    assert row.text == rows[0][1] and row.evidence_texts == ["x, y", "z"]
    with pytest.raises(ValueError):
        readers.read_raw(spark, path, "orc")


def test_curation_job_from_files(spark, tmp_path):
    rows = [(d, f"text {d}", "h", f"q{i}", "notmentioned", [f"e{i}"]) for d in (3, 1, 2) for i in (2, 0, 1)]
    inputs = {}
    for split in ("train", "validation", "test"):
        inputs[split] = str(tmp_path / f"{split}.parquet")
        spark.createDataFrame(rows, RAW_NLI).coalesce(1).write.parquet(inputs[split])
    version = jobs.curate_splits(spark, inputs, str(tmp_path / "store"), "docs", "20240101_0000")
    got = version.filter("split = 'test'").collect()
    assert {r.document_id for r in got} == {1, 2, 3} and version.count() == 9
    for r in got:  # file order is list order
        assert [a.hypothesis_id for a in r.inference] == ["q2", "q0", "q1"]
        assert {a.label for a in r.inference} == {"not_mentioned"}
