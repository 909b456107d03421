import pytest
from pyspark.sql import functions as F

from quotelens.functions import chat
from quotelens.operators import curate as cur
from quotelens.schemas import CURATED, RAW_NLI

ORDERED = "document_id long, pos long, text string, hypothesis string, hypothesis_id string, label string, evidence_texts array<string>"


def raw(spark, rows):
    return spark.createDataFrame(rows, ORDERED).repartition(5)


ROWS = [
    (2, 3, "two", "H1", "nda-1", "notmentioned", []),
    (1, 2, "later text", "H2", "nda-2", "entailment", ["b", "c"]),
    (1, 1, "one", "H1", "nda-1", "contradiction", ["a"]),
    (None, 4, "lost", "H1", "nda-1", "entailment", ["z"]),
    (1, 0, None, "H3", "nda-3", "notmentioned", []),
]


def test_curated_rows(spark):
    got = {r.document_id: r for r in cur.curate(raw(spark, ROWS), ["pos"]).collect()}
    assert set(got) == {1, 2}  # a null document id is in no group
    assert got[1].text is None  # the first row by position, null or not
    assert [tuple(a) for a in got[1].inference] == [
        ("nda-3", "not_mentioned", "H3", ""),
        ("nda-1", "contradiction", "H1", "a"),
        ("nda-2", "entailment", "H2", "b. c"),
    ]
    assert got[2].inference[0].label == "not_mentioned"
    assert (got[1].model_repo, got[1].model_repo_version, got[1].origin) == ("", "", "in_house")


def test_shape_of_the_result(spark):
    documents = cur.with_row_id(cur.curate(raw(spark, ROWS), ["pos"]).drop("part"))
    plain = [(f.name, f.dataType.simpleString()) for f in documents.schema]
    assert plain == [(f.name, f.dataType.simpleString()) for f in CURATED]
    assert len({r.id for r in documents.collect()}) == 2
    digests = cur.with_row_id(documents.drop("id"), ["document_id"])
    assert digests.select("id").exceptAll(digests.repartition(3).select("id")).count() == 0


@pytest.mark.parametrize("spoil", [{"evidence_texts": ["a", None]}, {"label": None}, {"hypothesis": None}])
def test_null_fields_fail(spark, spoil):
    names = [c.split()[0] for c in ORDERED.split(", ")]
    row = {**dict(zip(names, ROWS[1])), **spoil}
    with pytest.raises(Exception, match="null field in document 1"):
        cur.curate(raw(spark, [tuple(row[n] for n in names)]), ["pos"]).collect()


def test_older_variant_drops_silent_documents(spark):
    kept = cur.drop_unmentioned(raw(spark, ROWS))
    assert {r.document_id for r in cur.curate(kept, ["pos"]).collect()} == {1}


def test_long_lists_come_in_parts(spark):
    rows = [(7, i, f"t{i}", "H", f"q{i}", "entailment", ["e"]) for i in range(25)]
    rows += [(8, i, "u", "H", f"q{i}", "entailment", ["e"]) for i in range(3)]
    parts = cur.curate(raw(spark, rows), ["pos"], limit=10).orderBy("document_id", "part").collect()
    assert [(p.document_id, p.part, len(p.inference), p.text) for p in parts] == [
        (7, 0, 10, "t0"),
        (7, 1, 10, "t0"),
        (7, 2, 5, "t0"),
        (8, 0, 3, "u"),
    ]
    assert [a.hypothesis_id for p in parts[:3] for a in p.inference] == [f"q{i}" for i in range(25)]
    by_bytes = cur.curate(raw(spark, rows), ["pos"], limit_bytes=500).orderBy("document_id", "part")
    parts = [p for p in by_bytes.collect() if p.document_id == 7]
    assert len(parts) > 3 and {p.text for p in parts} == {"t0"}
    assert [a.hypothesis_id for p in parts for a in p.inference] == [f"q{i}" for i in range(25)]


def test_parts_follow_all_order_columns(spark):
    rows = [(7, i % 12, f"t{i // 12}", "H", f"q{i:02d}", "entailment", ["e"]) for i in range(36)]
    df = raw(spark, rows).withColumnRenamed("text", "file").withColumn("text", F.lit("x"))
    parts = cur.curate(df, ["file", "pos"], limit=10).orderBy("part").collect()
    assert [len(p.inference) for p in parts] == [10, 10, 10, 6]
    assert [a.hypothesis_id for p in parts for a in p.inference] == [f"q{i:02d}" for i in range(36)]
    assert [p.text for p in parts] == ["x"] * 4


def test_group_then_explode_is_the_input(spark):
    df = raw(spark, ROWS).filter("document_id is not null")
    item = F.struct("hypothesis", "label")
    nested = cur.group_answers(df, ["pos"], item, name="hypothesises/labels").drop("part")
    flat = cur.explode_hypotheses(nested)
    assert sorted(map(tuple, flat.collect())) == sorted(
        (r[0], r[3], r[5]) for r in ROWS if r[0] is not None
    )


def test_label_name_variant_and_first_rows(spark):
    df = raw(spark, ROWS)
    answer = df.select(chat.answer_struct(label_name="hypothesis_label").alias("a"))
    assert answer.schema["a"].dataType.names == [
        "hypothesis_id", "hypothesis_label", "hypothesis", "source_clause",
    ]
    first = {r.document_id: r.pos for r in cur.first_per_doc(df, ["pos"]).collect()}
    assert first == {1: 0, 2: 3}


def test_append_skips_known_ids(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "x"), (3, "z"), (3, "y"), (3, "y")], "id long, v string")
    assert sorted(map(tuple, cur.append_training(base, new, "id").collect())) == [
        (1, "a"), (2, "b"), (3, "y"),
    ]


def test_raw_schema_is_declared():
    assert RAW_NLI.names[0] == "document_id"
