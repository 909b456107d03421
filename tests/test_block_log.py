import io
import re

import pytest
from hypothesis import given, settings, strategies as st

from quotelens.sources import block_log, readers
from quotelens.streaming import live


def plain(data):
    """Blocks and places by a slow look at the whole file."""
    out = []
    for m in re.finditer(rb"(?:(?!\n\n).)+", data, re.S):
        block = m.group().strip(b"\n")
        if block:
            lead = len(m.group()) - len(m.group().lstrip(b"\n"))
            out.append((m.start() + lead, block))
    return out


def by_ranges(data, size):
    out = []
    for at in range(0, len(data), size):
        for start, block in block_log.blocks(io.BytesIO(data), at, min(at + size, len(data)), len(data)):
            lead = len(block) - len(block.lstrip(b"\n"))
            if block.strip(b"\n"):
                out.append((start + lead, block.strip(b"\n")))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("ab\n", max_size=60), st.integers(1, 9), st.integers(1, 5))
def test_ranges_give_each_block_once(text, size, step):
    kept, block_log._STEP = block_log._STEP, step
    try:
        assert by_ranges(text.encode(), size) == plain(text.encode())
    finally:
        block_log._STEP = kept


@settings(max_examples=200, deadline=None)
@given(st.text("a\n", max_size=40), st.integers(0, 10), st.integers(1, 5))
def test_closed_end(text, begin, step):
    data, begin = text.encode(), min(begin, len(text))
    kept, block_log._STEP = block_log._STEP, step
    try:
        at = data.rfind(b"\n\n", begin)
        assert block_log.closed(io.BytesIO(data), begin, len(data)) == (at + 2 if at >= 0 else begin)
    finally:
        block_log._STEP = kept


def block(i, note="x"):
    return f"timestamp: {i}\ninput: {note * (i % 50)}\noutput: é{i}\n\n"


def test_one_file_in_many_tasks_equals_the_plain_reader(spark, tmp_path):
    (tmp_path / "out.txt.3").write_text("\n" + "".join(map(block, range(500)))[:-2])
    (tmp_path / "out.txt.4").write_text("")
    (tmp_path / "_notes").write_text(block(1))
    got = readers.read_request_blocks(spark, str(tmp_path), range_bytes=1_000)
    assert got.rdd.getNumPartitions() > 20
    want = readers.read_request_log(spark, str(tmp_path))
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    (tmp_path / "none").mkdir()
    assert readers.read_request_blocks(spark, str(tmp_path / "none")).count() == 0
    assert readers.read_request_blocks(spark, f"file:{tmp_path}/out.txt.3").count() == 500


def test_stream_follows_growing_files_and_resumes(spark, tmp_path):
    logs, out, state = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "state")
    logs.mkdir()
    log = readers.stream_request_blocks(spark, str(logs), range_bytes=200)

    def rows():
        return sorted((r.client, r.ts_ms, r.output) for r in live.run_to_table(log, out, state).collect())

    def want(client, n):
        return [(client, i, f"é{i}") for i in range(n)]

    assert rows() == []
    text = "".join(map(block, range(40)))
    half = text.index("timestamp: 25") + 20
    (logs / "l.1").write_text(text[:half])
    assert rows() == want("1", 25)
    assert rows() == want("1", 25)
    with open(logs / "l.1", "a") as more:
        more.write(text[half:] + "\n\n")
    (logs / "l.2").write_text(text)
    assert rows() == want("1", 40) + want("2", 40)
    (logs / "l.2").write_text("")
    with pytest.raises(Exception, match="became shorter"):
        rows()


def test_final_takes_the_last_block(spark, tmp_path):
    (tmp_path / "l.1").write_text(block(1) + block(2)[:-2])
    for final, n in ((False, 1), (True, 2)):
        log = readers.stream_request_blocks(spark, str(tmp_path), final=final)
        out = tmp_path.parent / f"{tmp_path.name}-{n}"
        assert live.run_to_table(log, f"{out}/out", f"{out}/state").count() == n
