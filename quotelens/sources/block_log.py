"""Log files of text blocks as a data source of their own, in batch and as a stream.

Blocks are parted by one blank line or more. A file is cut into byte ranges; a block belongs to the
range that holds its first byte, so one large file is read by many tasks and no block is cut. As a
stream the source follows files that grow: its offset is, for each file, the end of the last
blank line seen, so a block half written waits until it is closed.

Columns: file (name without folders), start (byte of the block in its file), value (text without
the blank lines around it).

Options: ``path``; ``range_bytes``, the length of a range (64 MB); ``final``, "true" if files no
longer grow, so that a stream also takes a last block without a blank line after it (a batch always
does).

Edge cases: an empty folder, empty files and files of blank lines give no rows; bytes that are not
UTF-8 become replacement characters; names that begin with a dot or an underscore are left out. A
file that became shorter, or went, is an error in a stream, as what was read would be unclear.
Memory of a task: one block and ``_STEP`` bytes.
"""

import re

from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, InputPartition,
)

SCHEMA = "file string, start bigint, value string"
_OTHER = re.compile(rb"[^\n]")
_STEP = 1 << 20
_ROWS = 1_000


class Range(InputPartition):
    """The blocks of a file that begin in ``[begin, end)``, read up to byte ``limit`` at most."""

    def __init__(self, file, begin, end, limit):
        super().__init__((file, begin, end, limit))


def _open(path):
    """File system and folder of a path; ``s3a`` and paths without a scheme are understood."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", path):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def sizes(path):
    """Size of each log file under ``path``, by its place in the file system."""
    from pyarrow import fs

    system, root = _open(path)
    found = system.get_file_info(root)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return {root: found.size}
    inside = system.get_file_info(fs.FileSelector(root, recursive=True))
    return {
        f.path: f.size
        for f in inside
        if f.type == fs.FileType.File
        and not any(p[:1] in "._" for p in f.path[len(root) :].strip("/").split("/"))
    }


def closed(handle, begin, size):
    """End of the last run of blank lines in ``[begin, size)``, or ``begin``."""
    end = size
    while end > begin:
        low = max(begin, end - _STEP)
        handle.seek(low)
        at = handle.read(min(end + 1, size) - low).rfind(b"\n\n")  # one byte of the last step again
        if at >= 0:
            return low + at + 2
        end = low
    return begin


def blocks(handle, begin, end, limit):
    """Place and bytes of each block that begins in ``[begin, end)``."""
    place = max(begin - 2, 0)  # two bytes tell whether a block begins at ``begin``
    handle.seek(place)
    data, started, more, look = bytearray(), begin == 0, True, 0
    while more:
        step = handle.read(min(_STEP, limit - place - len(data)))
        more = bool(step)
        data += step
        cut = 0
        while True:
            run = data.find(b"\n\n", look)
            after = _OTHER.search(data, run) if run >= 0 else None
            if run < 0 or (more and after is None):  # a run at the end may go on
                break
            if started and run > cut:
                yield place + cut, bytes(data[cut:run])
            cut = look = len(data) if after is None else after.start()
            started, after = True, None  # a match would keep the buffer from changing
            if place + cut >= end:
                return
        look = run if run >= 0 else max(len(data) - 1, cut)
        if not started:  # what lies before a possible run is another range's
            cut = look
        if place + cut >= end:
            return
        del data[:cut]
        place, look = place + cut, look - cut
    if started and data.strip(b"\n"):
        yield place, bytes(data)


def _grown(before, now):
    short = [f for f, end in before.items() if now.get(f, -1) < end]
    if short:
        raise ValueError(f"log files became shorter or went: {sorted(short)[:3]}")


class _Ranges:
    def __init__(self, options):
        self.path = options["path"]
        self.range_bytes = int(options.get("range_bytes", 64 << 20))
        self.final = options.get("final", "false").lower() == "true"
        if self.range_bytes < 1:
            raise ValueError("range_bytes must be at least 1")

    def cut(self, spans):
        """Ranges over ``(file, begin, end)``."""
        return [
            Range(file, at, min(at + self.range_bytes, end), end)
            for file, begin, end in spans
            for at in range(begin, end, self.range_bytes)
        ]

    def read(self, partition):
        import pyarrow as pa

        file, begin, end, limit = partition.value
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("value", pa.string())])
        name, rows, held = file.rsplit("/", 1)[-1], [], 0
        with _open(self.path)[0].open_input_file(file) as handle:
            for start, block in blocks(handle, begin, end, limit):
                text = block.strip(b"\n").decode(errors="replace")
                start += len(block) - len(block.lstrip(b"\n"))
                rows.append({"file": name, "start": start, "value": text})
                held += len(block)
                if len(rows) == _ROWS or held >= 16 * _STEP:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class BlockReader(_Ranges, DataSourceReader):
    def partitions(self):
        # An empty list would make Spark plan one task without a range.
        return self.cut((f, 0, n) for f, n in sorted(sizes(self.path).items())) or [Range("", 0, 0, 0)]

    def read(self, partition):
        return super().read(partition) if partition.value[0] else iter(())


class BlockStreamReader(_Ranges, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.known = {}

    def initialOffset(self):
        return {}

    def latestOffset(self):
        system, found = _open(self.path)[0], sizes(self.path)
        for file, size in found.items():
            begin = self.known.get(file, 0)
            if self.final:
                self.known[file] = size
            elif size > begin:
                with system.open_input_file(file) as handle:
                    self.known[file] = closed(handle, begin, size)
        _grown(self.known, found)
        return dict(self.known)

    def partitions(self, start, end):
        _grown(start, end)
        self.known = {**end, **self.known}
        return self.cut((f, start.get(f, 0), n) for f, n in sorted(end.items()))

    def commit(self, end):
        pass


class BlockLog(DataSource):
    """``spark.read.format("block_log")`` and ``spark.readStream.format("block_log")``."""

    @classmethod
    def name(cls):
        return "block_log"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BlockReader(self.options)

    def streamReader(self, schema):
        return BlockStreamReader(self.options)


def register(spark):
    spark.dataSource.register(BlockLog)
