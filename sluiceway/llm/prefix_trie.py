"""Prefix trie of conversations by truncation peeling, with subtree figures for every node.

A conversation is a path of turns. Every prefix of it gets a 128-bit key, chained from turn to turn over role
and text, so equal prefixes have equal keys; texts themselves are never shuffled. Peeling goes from the
greatest depth to 0. At a depth the conversations that end there meet the nodes that survive from below;
equal keys are merged into one node, which sums up its members, children, leaves and tokens; then the
last turn is stripped and what remains is regrouped one depth higher. Nodes are discovered and aggregated in
that one pass.

A depth with many rows is one combined aggregation, so a prefix shared by a third of all conversations is a row for
each task. Consecutive depths that together hold at most `BLOCK_TURNS` turns are peeled by one job:
rows meet by their prefix at the block's lowest depth and each group, bounded by that number, is peeled in
its task. Long tails of few long conversations so take few jobs. Peeled depths are cut into the shared folder.

The decimal ids of conversations that end in a node are joined in bounded ranges of ids first; the digest
then reads these pieces in order with one running hash, which holds no list.

Conversations are ordered by turn (null first), ties by role, then by the digest of the text; null roles and
texts are empty ones. Rows without a conv_id belong to no conversation. Repeated rows are turns of their own. An empty table has
no node. A conversation's turns, 24 bytes each, must fit into one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import cut, map_arrow

#: Turns of consecutive depths that are peeled in one job.
BLOCK_TURNS = 1 << 14
#: Conversation ids in a piece of a node's list.
PIECE_IDS = 4096

#: Turns that replace a conversation's first ones come from the first conversation of its group.
GROUP, HEADS = 100, 6

_KEY_BYTES = 16
_NO_IDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: for each conversation its turns in order, as (mark, size): digest of role and text, code points."""
    said, by = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary")))
    rows = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn}`").alias("turn"), by.alias("role"), digest.alias("mark"), F.length(said).cast("long").alias("size")).alias("t")
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return lists.select("conv_id", F.transform("ts", lambda t: F.struct(t["mark"].alias("mark"), t["size"].alias("size"))).alias("turns"))


def rebuild(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the first h turns of the group's first conversation, then one's own after the first h; h is a hash of the id."""
    with_head = conversations.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % HEADS).withColumn("of", F.expr(f"conv_id - conv_id % {GROUP}"))
    heads = conversations.where(f"conv_id % {GROUP} = 0").select(F.col("conv_id").alias("of"), F.slice("turns", 1, HEADS - 1).alias("head"))
    joined = with_head.join(heads, "of", "left")
    none = F.expr("cast(array() as array<struct<mark:binary,size:bigint>>)")
    head = F.coalesce(F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.col("h").cast("int"))), none)
    own = F.expr("if(size(turns) > h, slice(turns, cast(h as int) + 1, size(turns)), cast(array() as array<struct<mark:binary,size:bigint>>))")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of turns to keys of prefixes: each key hashes the one before and the turn's mark; the root's is empty."""
    for batch in batches:
        paths, keys = [], []
        for marks in batch.column("marks").to_pylist():
            key, path = b"", []
            for mark in marks:
                key = hashlib.md5(key + mark).digest()
                path.append(key)
            paths.append(b"".join(path))
            keys.append(key)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("sizes"), pa.array(keys, pa.binary()), pa.array(paths, pa.binary())], names=["conv_id", "sizes", "key", "path"])


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, key (of the whole sequence), depth, path (keys of all its prefixes one after another), sizes."""
    marked = conversations.select("conv_id", F.col("turns.mark").alias("marks"), F.col("turns.size").alias("sizes"))
    chained = map_arrow(marked, _chain, "conv_id long, sizes array<long>, key binary, path binary")
    return chained.select("conv_id", "key", F.size("sizes").alias("depth"), "path", "sizes")


_STATE = ["depth", "key", "path", "sizes", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = "depth int, key binary, path binary, sizes array<long>, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _merged(rows: DataFrame) -> DataFrame:
    """One node for each key of one depth, from conversations that end there and from children."""
    sums = [F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    node = rows.groupBy("depth", "key", "path", "sizes").agg(F.min("conv_id").alias("conv_id"), *sums)
    size = F.when(F.col("depth") > 0, F.element_at("sizes", -1)).otherwise(F.lit(0))
    return node.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * size,
    }).select(_STATE)


def _stripped(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn, each one child of what they become."""
    shorter = F.substring("path", F.lit(1), (F.col("depth") - 1) * _KEY_BYTES)
    return nodes.where("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.expr(f"substring(path, (depth - 2) * {_KEY_BYTES} + 1, if(depth > 1, {_KEY_BYTES}, 0))").alias("key"), shorter.alias("path"),
        F.expr("slice(sizes, 1, depth - 1)").alias("sizes"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
    )


class _Group:
    """Rows that share a prefix at a block's lowest depth, peeled down to it."""

    def __init__(self) -> None:
        self._at: dict[int, dict[bytes, list]] = {}

    def add(self, depth: int, key: bytes, path: bytes, sizes: list[int], conv_id: int, n_convs: int, n_children: int, n_leaves: int, saved: int) -> None:
        """Merge one row into the node of its key."""
        level = self._at.setdefault(depth, {})
        node = level.get(key)
        if node is None:
            level[key] = [path, sizes, conv_id, n_convs, n_children, n_leaves, saved]
        else:
            node[2] = min(node[2], conv_id)
            for k, more in zip(range(3, 7), (n_convs, n_children, n_leaves, saved), strict=True):
                node[k] += more

    def peel(self, low: int) -> Iterator[tuple]:
        for depth in range(max(self._at), low - 1, -1):
            for key, (path, sizes, conv_id, n_convs, n_children, n_leaves, saved) in self._at.pop(depth, {}).items():
                n_leaves = n_leaves if n_children else 1
                saved += (n_convs - 1) * sizes[depth - 1]
                yield (depth, key, path, sizes[:depth], conv_id, n_convs, n_children, n_leaves, saved)
                if depth > low:
                    up = path[: (depth - 1) * _KEY_BYTES]
                    self.add(depth - 1, up[-_KEY_BYTES:], up, sizes, conv_id, n_convs, 1, n_leaves, saved)


_FIELDS = [("depth", pa.int32()), ("key", pa.binary()), ("path", pa.binary()), ("sizes", pa.list_(pa.int64())), *((n, pa.int64()) for n in _STATE[4:])]


def _peel_block(rows: DataFrame, low: int) -> DataFrame:
    """All nodes from depth `low` on that the rows, of depth `low` or more, give."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: _Group) -> pa.RecordBatch:
            columns = list(zip(*group.peel(low), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])

        now, group = None, _Group()
        for batch in batches:
            for stem, *row in zip(*(batch.column(n).to_pylist() for n in ("stem", *_STATE)), strict=True):
                if stem != now and now is not None:
                    yield out(group)
                    group = _Group()
                now = stem
                group.add(*row)
        if now is not None:
            yield out(group)

    stem = F.expr(f"substring(path, {(low - 1) * _KEY_BYTES + 1}, {_KEY_BYTES})")
    dealt = rows.withColumn("stem", stem).repartition("stem").sortWithinPartitions("stem")
    return map_arrow(dealt, run, _NODE)


def _blocks(lengths: dict[int, int]) -> list[tuple[int, int]]:
    """(high, low) depths that are peeled together, from the greatest on: one depth, or several with BLOCK_TURNS turns at most."""
    out, alive, high, held, depth = [], 0, None, 0, max(lengths, default=0)
    while depth > 0:
        alive += lengths.get(depth, 0)
        if high is not None and held + alive > BLOCK_TURNS:
            out.append((high, depth + 1))
            high, held = None, 0
        if high is None:
            high = depth
        held += alive
        depth -= 1
    return [*out, *([(high, 1)] if high is not None else [])]


def peel(ended: DataFrame) -> DataFrame:
    """depth, key, path, conv_id and the figures of all nodes, from `paths`."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = ended.withColumns({"n_convs": one, "n_children": zero, "n_leaves": zero, "saved_tokens": zero}).select(_STATE)
    lengths = {r[0]: r[1] for r in ended.groupBy("depth").count().collect()}  # one row for each length that occurs
    alive, nodes = None, []
    for high, low in [*_blocks(lengths), (0, 0)]:
        here = rows.where(F.col("depth").between(low, high))
        here = here.unionByName(alive) if alive is not None else here
        found = cut(_merged(here) if high == low else _peel_block(here, low))
        nodes.append(found.drop("sizes"))
        alive = _stripped(found.where(f"depth = {low}"))
    out = nodes[0]
    for more in nodes[1:]:
        out = out.unionByName(more)
    return out


def _running_digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over pieces sorted by node and range: one hash runs over each node's pieces."""

    def out(key: bytes, digest: "hashlib._Hash") -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    now, digest = None, None
    for batch in batches:
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != now:
                if digest is not None:
                    yield out(now, digest)
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if digest is not None:
        yield out(now, digest)


def end_digests(ended: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the ascending ids of the conversations that end in a node."""
    pieces = ended.groupBy("key", F.expr(f"floor(conv_id / {PIECE_IDS})").alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = pieces.select("key", "piece", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    dealt = joined.repartition("key").sortWithinPartitions("key", "piece")
    return map_arrow(dealt.select("key", "ids"), _running_digest, "key binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie over (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ended = cut(paths(conversations))
    nodes = peel(ended).withColumn("parent", F.expr(f"if(depth = 0, null, substring(path, (depth - 2) * {_KEY_BYTES} + 1, if(depth > 1, {_KEY_BYTES}, 0)))"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(above, "parent", "left").join(end_digests(ended), "key", "left")
    return full.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_IDS)).alias("ends_sha256")
    )


def rebuilt_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of all conversations after `rebuild`."""
    return trie(rebuild(ordered_turns(df, conv, turn, role, text)))
