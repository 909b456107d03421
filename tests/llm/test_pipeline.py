import os

import numpy as np
import pytest
from test_line_runs import brute as lines_left
from test_packing import check
from test_quality import bad, good
from test_simhash import brute_components, slow_fingerprint

import corpus_pipeline
from quotelens.llm import decontaminate, quality, queries

ITEM = "seldom heard sentences about copper kettles and brass lanterns hanging beside old doors"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = np.random.default_rng(0), []
    for i in range(120):
        text = bad(rng, 150) if i % 4 == 1 else good(rng, int(rng.integers(40, 150)))
        if i % 6 == 0:
            text += "\nAll rights reserved"
        if i % 10 == 4:
            text = f"{text} {ITEM.upper()}, {text}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(200 + i, rows[2][1], "en", None, len(rows[2][1])) for i in range(5)]
    rows += [(2, rows[2][1], "en", "s2", len(rows[2][1]))] * 2
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (None, good(rng, 60), "en", "s", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, f string"
    labels = [(i, int(i % 4 != 1), 0) for i in range(0, 120)]
    made = {
        "documents": spark.createDataFrame([(*r, 7, "f") for r in rows], docs).repartition(3),
        "labels": spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string"),
    }
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def keys(rows):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in rows)


def test_every_stage_equals_brute_force(spark, folder, tmp_path):
    docs = queries.table(spark, folder, "documents")
    columns, rows = docs.columns, docs.collect()
    tables = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        tables.append(docs)
    assert all(t.columns == columns for t in tables[:4])

    model = quality.train(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"))

    def score(text):
        x = quality.encode_passages(text or "", 64).astype(float)
        return quality._forward(model, x, np.array([0]))[5][0]

    rows = [r for r in rows if score(r["text"]) >= 0.3]
    assert keys(tables[0].collect()) == keys(rows)
    assert {r["doc_id"] for r in rows} >= {i for i in range(120) if i % 4 != 1}
    assert not any("***" in (r["text"] or "") for r in rows)

    left = lines_left([(r["doc_id"], r["text"]) for r in rows], 10)
    rows = tables[1].collect()
    assert keys(rows) == sorted((str(k[0]), k[1]) for k in left.elements())
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert not any("All rights reserved" in r["text"].split("\n") for r in rows)

    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    groups = brute_components([slow_fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if groups[i] == i]
    assert keys(tables[2].collect()) == keys(rows)

    item = " ".join(decontaminate.plain_words(ITEM))
    rows = [r for r in rows if item not in " ".join(decontaminate.plain_words(r["text"]))]
    assert keys(tables[3].collect()) == keys(rows)

    texts = {r["doc_id"]: r["text"] for r in rows}
    assert len(texts) == len(rows)
    pieces = [r.asDict() | {"ids": ids} for r, ids in _with_ids(tables[4].collect(), texts)]
    check(pieces, texts)


def _with_ids(pieces, texts):
    """The ids that a piece must have, checked against its checksum."""
    import zlib

    from test_packing import SLOW

    for r in pieces:
        whole = np.append(SLOW(texts[r["doc_id"]]), 0).astype("<u4")
        ids = whole[r["start"] : r["start"] + r["length"]].tobytes()
        assert zlib.crc32(ids) == r["ids_crc32"]
        yield r, ids


def test_run_goes_through_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.filter("doc_id % 4 = 1 AND doc_id < 120").count() == 0
    assert out.agg({"length": "sum"}).first()[0] > 0


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        queries.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_sql(spark, name):
    from compare import connect, difference

    sf = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.SQL[name]) is None


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_every_operator_has_its_query():
    import __spark_entry__ as driver

    names = driver.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11))
    assert names["pipeline"] is corpus_pipeline.run
