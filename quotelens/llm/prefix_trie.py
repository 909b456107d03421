"""Prefix trie of conversations: who shares which first turns, and what sharing them saves.

A conversation is a row of turn ids (128-bit hashes), so a node of depth d is a distinct row of d
ids. Rows are put in order by range partitioning, which makes each node a run of neighbours:

1. A shard is read in blocks of bounded size. A block is a padded matrix of turn ids, put in
   order by ``numpy.lexsort``; columns that differ from the row above are marked, and marks are
   accumulated along the row with OR, so a mark says that a node starts here. ``reduceat`` over
   those starts gives every sum of a depth at once. All sums are sums over rows: a row adds its
   turns that are not the first of their node to the saved tokens of all nodes on its way, and a
   leaf is counted by its last row.
2. Nodes at the edge of a block may go on in the next one. They are handed out as partial sums
   under a hash of their turns, with corrections for each pair of neighbouring shards (turns that
   started earlier, rows that are no leaf), and recombined by Spark. These are at most two rows a
   depth for each block, however many conversations there are.
3. Member ids of a recombined node come in chunks in ascending order and are hashed one chunk
   after the other, so equal conversations are never gathered, however many they are.

Conversations with equal turns are put in order by id, so they spread over shards like others.

Edge cases: null roles and texts count as empty ones. Null turns come first; rows of one turn
number are put in order by a hash of role and text. Rows without conversation id are left out, as
they belong to none. A conversation without turns is a member of the root only. Repeated rows are
turns of their own. An empty table gives an empty result. A conversation has to fit in a row, with
28 bytes a turn whatever the texts, and the largest sets the width of the blocks it lies in, which
then have fewer rows. Further columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from ..session import settle
from .graph import join_unique
from .text import whole

WIDTH = 16
CELLS = 1 << 17
CHUNK = 1_024
NOTHING = hashlib.sha256(b"").hexdigest()

PARTIAL = pa.schema(
    [("kind", pa.string()), ("node", pa.binary()), ("parent", pa.binary()), ("parent_id", pa.int64()),
     ("id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends_sha256", pa.string()),
     ("place", pa.int64()), ("block", pa.int64()), ("first", pa.binary()), ("first_sizes", pa.binary()),
     ("last", pa.binary())]
)
PARTIAL_SQL = (
    "kind string, node binary, parent binary, parent_id bigint, id bigint, depth bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends_sha256 string, place bigint, block bigint, "
    "first binary, first_sizes binary, last binary"
)
SUMS = ["n_convs", "n_children", "n_leaves", "saved"]


def turn_lists(conversations, conv_id="conv_id", turn="turn", role="role", text="text"):
    """One row a conversation: ``id`` and ``turns``, in order, as (hash, code points)."""
    role, text = whole(F.col(role)), whole(F.col(text))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    item = F.struct(
        F.col(turn).alias("turn"), F.unhex(F.md5(said)).alias("hash"), F.length(text).alias("size")
    )
    rows = conversations.filter(F.col(conv_id).isNotNull())
    lists = rows.groupBy(F.col(conv_id).cast("long").alias("id")).agg(F.collect_list(item).alias("t"))
    bare = F.transform(F.sort_array("t"), lambda t: F.struct(t["hash"], t["size"]))
    return lists.select("id", bare.alias("turns"))


def _common(a, b):
    """Turns that two rows of ids have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(x != y)) // WIDTH


def _names(row):
    """Hash of each of a row's prefixes, the empty one first."""
    running = hashlib.md5()
    names = [running.digest()]
    for i in range(0, len(row), WIDTH):
        running.update(row[i : i + WIDTH])
        names.append(running.digest())
    return names


def _matrix(keys, sizes):
    """Padded turn ids (two numbers each), code points, and lengths of a block's rows."""
    lengths = np.array([len(k) // WIDTH for k in keys], np.int64)
    n, deep = len(keys), int(lengths.max(initial=0))
    there = np.arange(deep) < lengths[:, None]
    ids = np.zeros((n, deep, 2), np.uint64)
    ids[there] = np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)
    chars = np.zeros((n, deep), np.int64)
    chars[there] = np.frombuffer(b"".join(sizes), ">i4")
    return ids, chars, lengths, there


def block_nodes(keys, sizes, convs, before=None, after=None):
    """All nodes of a block of conversations, as arrays by depth.

    ``before`` and ``after`` are the rows of ids next to the block, if known. Yields for each depth
    the first row of its nodes, the place of their parents among the nodes a depth above, the
    smallest id, the four sums, the number of rows that end here; and at last the ids in order.
    """
    ids, chars, lengths, there = _matrix(keys, sizes)
    n, deep = there.shape
    columns = [convs, lengths]
    for j in range(deep - 1, -1, -1):
        columns += [ids[:, j, 1], ids[:, j, 0]]
    order = np.lexsort(columns)
    ids, chars, lengths, there, convs = ids[order], chars[order], lengths[order], there[order], convs[order]
    changed = np.ones((n, deep), bool)
    changed[1:] = (ids[1:] != ids[:-1]).any(axis=2) | (there[1:] != there[:-1])
    runs = np.logical_or.accumulate(changed, axis=1)
    starts = runs & there
    same = np.ones(n, np.int64)  # the last row of a sequence that no later row goes on with
    goes_on = lengths[1:] >= lengths[:-1]
    if deep:
        apart = runs[np.arange(1, n), np.maximum(lengths[:-1], 1) - 1]
        goes_on &= (lengths[:-1] == 0) | ~apart
    same[:-1] = ~goes_on
    if before is not None:  # turns that the row before the block has as well start earlier
        starts[0, : _common(before, keys[order[0]])] = False
    if after is not None and after.startswith(keys[order[-1]]):
        same[-1] = 0
    saves = np.where(starts, 0, chars)
    saves = np.cumsum(saves[:, ::-1], axis=1)[:, ::-1]
    above = None
    for d in range(deep + 1):
        at = np.flatnonzero(runs[:, d - 1]) if d else np.array([0])
        ends = np.add.reduceat((lengths == d).astype(np.int64), at)
        rows = np.diff(np.append(at, n))
        least = np.minimum.reduceat(convs, at)
        children = np.add.reduceat(starts[:, d].astype(np.int64), at) if d < deep else np.zeros_like(at)
        leaves = np.add.reduceat(same, at)
        saved = np.add.reduceat(saves[:, max(d, 1) - 1], at) if deep else np.zeros_like(at)
        kept = lengths[at] >= d
        at, ends, rows, least = at[kept], ends[kept], rows[kept], least[kept]
        parents = np.searchsorted(above, at, "right") - 1 if d else None
        yield at, parents, least, (rows, children[kept], leaves[kept], saved[kept]), ends
        above = at
    yield convs, order


def _block_rows(block, number, before, after):
    """A block's nodes as columns of ``PARTIAL``; the open ones by name, their ids in chunks."""
    keys, sizes, convs = block
    *depths, (convs, order) = block_nodes(keys, sizes, convs, before, after)
    first, last = keys[order[0]], keys[order[-1]]
    open_first = len(first) // WIDTH if before is None else _common(before, first)
    open_last = len(last) // WIDTH if after is None else _common(last, after)
    first_names, last_names = _names(first), _names(last)
    out = {name: [] for name in PARTIAL.names}

    def put(**values):
        for name, column in out.items():
            column.append(values.get(name))

    names_above, least_above = [None], [None]
    for d, (at, parents, least, sums, ends) in enumerate(depths):
        names = [None] * len(at)
        if len(at) and d <= open_last and d * WIDTH <= len(last):
            names[-1] = last_names[d]
        if len(at) and d <= open_first and d * WIDTH <= len(first):
            names[0] = first_names[d]
        ids = least.tolist()
        rows, children, leaves, saved = (s.tolist() for s in sums)
        for i, (start, n_ends) in enumerate(zip(at.tolist(), ends.tolist())):
            up = int(parents[i]) if d else 0
            common = {
                "node": names[i], "parent": names_above[up], "id": ids[i], "depth": d, "n_convs": rows[i],
                "n_children": children[i], "n_leaves": leaves[i], "saved": saved[i],
                "parent_id": least_above[up] if names_above[up] is None else None,
            }
            mine = convs[start : start + n_ends]
            if names[i] is None:
                text = ",".join(map(str, mine.tolist()))
                put(kind="node", ends_sha256=hashlib.sha256(text.encode()).hexdigest(), **common)
                continue
            put(kind="open", **common)
            for c in range(0, n_ends, CHUNK):
                chunk = mine[c : c + CHUNK].astype("<i8").tobytes()
                put(kind="ends", node=names[i], id=int(mine[c]), place=number, block=c, first=chunk)
        names_above, least_above = names, ids
    return out


def _blocks(batches):
    """Rows of a shard in blocks of at most ``CELLS`` cells, each with at least one row."""
    keys, sizes, convs, deep = [], [], [], 0
    for batch in batches:
        for conv, key, size in zip(*(c.to_pylist() for c in batch.columns)):
            depth = max(deep, len(key) // WIDTH, 1)
            if keys and depth * (len(keys) + 1) > CELLS:
                yield keys, sizes, np.array(convs, np.int64)
                keys, sizes, convs, depth = [], [], [], max(len(key) // WIDTH, 1)
            keys.append(key)
            sizes.append(size)
            convs.append(conv)
            deep = depth
    if keys:
        yield keys, sizes, np.array(convs, np.int64)


def _shard(batches):
    """Nodes of a shard block by block, and the shard's first and last row."""
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId()
    blocks, before, number = _blocks(batches), None, 0
    block, first = next(blocks, None), None
    while block is not None:
        following = next(blocks, None)
        after = following[0][0] if following else None
        # The input is in order, so rows next to each other here are so in all shards together.
        out = _block_rows(block, (shard << 32) + number, before, after)
        first = first or (block[0][0], block[1][0])
        if following is None:
            edge = {"kind": "edge", "place": shard, "first": first[0], "first_sizes": first[1], "last": block[0][-1]}
            for name, column in out.items():
                column.append(edge.get(name))
        for low in range(0, len(out["kind"]), 10_000):
            columns = [pa.array(out[f.name][low : low + 10_000], f.type) for f in PARTIAL]
            yield pa.record_batch(columns, schema=PARTIAL)
        before, block, number = block[0][-1], following, number + 1


def _corrections(batches):
    """What neighbouring shards have counted twice, for each node that both have."""
    for batch in batches:
        out = {name: [] for name in ("node", "parent", "depth", *SUMS)}
        for last, first, sizes in zip(*(c.to_pylist() for c in batch.columns)):
            common, names = _common(last, first), _names(first)
            chars = np.frombuffer(sizes, ">i4")[:common].astype(np.int64)
            saved = np.append(np.cumsum(chars[::-1])[::-1], 0)
            leaf = -1 if common * WIDTH == len(last) else 0
            for d in range(common + 1):
                values = (names[d], names[d - 1] if d else None, d, 0, -1 if d < common else 0, leaf,
                          int(saved[max(d, 1) - 1]))
                for column, value in zip(out.values(), values):
                    column.append(value)
        types = [pa.binary(), pa.binary(), *[pa.int64()] * 5]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(out.values(), types)], names=list(out))


def _hashed(batches):
    """Hash of the ids of each node, whose chunks come one after the other."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def row(node, running):
        return pa.record_batch([[node], [running.hexdigest()]], schema=schema)

    node, running = None, None
    for batch in batches:
        for key, chunk in zip(*(c.to_pylist() for c in batch.columns)):
            ids = ",".join(map(str, np.frombuffer(chunk, "<i8").tolist())).encode()
            if key == node:
                running.update(b"," + ids)
                continue
            if running:
                yield row(node, running)
            node, running = key, hashlib.sha256(ids)
    if running:
        yield row(node, running)


def prefix_trie(lists, turns="turns"):
    """One row a node of the trie over ``id`` and ``turns`` of :func:`turn_lists`.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    def packed(values):
        return F.unhex(F.array_join(F.transform(turns, values), ""))

    rows = lists.select(
        "id",
        packed(lambda t: F.hex(t["hash"])).alias("key"),
        packed(lambda t: F.lpad(F.hex(t["size"]), 8, "0")).alias("sizes"),
    )
    shards = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = settle(shards.mapInArrow(_shard, PARTIAL_SQL))

    in_order = Window.orderBy("place")  # one row for each shard
    edges = found.filter("kind = 'edge'").select(
        "last",
        F.lead("first").over(in_order).alias("first"),
        F.lead("first_sizes").over(in_order).alias("sizes"),
    )
    edges = edges.filter("first is not null")
    sums = "node binary, parent binary, depth bigint, " + ", ".join(f"{s} bigint" for s in SUMS)
    corrections = edges.mapInArrow(_corrections, sums).withColumn("id", F.lit(None).cast("long"))
    partial = found.filter("kind = 'open'").select(*corrections.columns).unionByName(corrections)
    whole_nodes = partial.groupBy("node", "parent", "depth").agg(
        F.min("id").alias("id"), *[F.sum(s).alias(s) for s in SUMS]
    )
    chunks = found.filter("kind = 'ends'").select("node", "first", "place", "block")
    ends = (
        chunks.repartition("node")
        .sortWithinPartitions("node", "place", "block")
        .select("node", "first")
        .mapInArrow(_hashed, "node binary, ends_sha256 string")
    )
    opened = settle(whole_nodes.join(ends, "node", "left").fillna(NOTHING, ["ends_sha256"]))

    done = ["id", "depth", *SUMS, "ends_sha256"]
    closed = found.filter("kind = 'node'")
    pending = (
        closed.filter("parent is not null").select("parent", *done).unionByName(opened.select("parent", *done))
    )
    parents = opened.select(
        F.col("node").alias("parent"), F.col("id").alias("parent_id"), F.col("n_children").alias("rows")
    )
    total = parents.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    done.append("parent_id")
    nodes = join_unique(pending, parents, "parent", "rows", total).select(*done)
    return nodes.unionByName(closed.filter("parent is null").select(*done)).select(
        F.col("id").alias("conv_id"),
        "depth",
        F.col("parent_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def share_heads(lists, every=100, most=6):
    """Each conversation with its first turns taken from the first of its hundred.

    How many it takes (less than ``most``) follows from a hash of its id; without that other
    conversation it only loses its own.
    """
    heads = lists.filter(F.col("id") % every == 0).select(
        F.col("id").alias("__base"), F.slice("turns", 1, most - 1).alias("__head")
    )
    h = (F.crc32(F.col("id").cast("string")) % most).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice(F.coalesce("__head", F.slice("turns", 1, 0)), F.lit(1), h)
    joined = lists.withColumn("__base", F.col("id") - F.col("id") % every).join(heads, "__base", "left")
    return joined.select("id", F.concat(head, own).alias("turns"))
