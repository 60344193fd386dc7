"""Operator 13: the prefix trie of rebuilt conversations, by shards of
balanced parentheses.

Distinct conversations are dealt out by range in the order of their turns'
hashes, so that a shard holds whole subtrees but for the paths at its two
edges. A task encodes blocks of its shard as balanced parentheses in preorder.
Range min-max blocks of the excess find the closing parenthesis of every node
and so its subtree; the rank of leaf pairs ``()`` counts the leaves below it,
and cumulative arrays over the preorder give its members and savings.

A node of two blocks lies on the first or last path of each. These spines are
the only rows that meet again: their partial counts are added by node, and the
nodes' own leaves and savings reach the nodes above them by running sums along
one path each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.store import col, stage

#: Turns of a block, about; a longer conversation is a block of its own.
BLOCK_TURNS = 1 << 18
#: Parentheses of a range min-max block, and nodes looked for at once.
EXCESS_BLOCK, QUERIES = 256, 4096
#: Ids of members are joined in chunks of so many ids' range (a power of two).
ID_BITS = 12


class ExcessBlocks:
    """Balanced parentheses (1 opens) with a tree of the least excess of blocks."""

    def __init__(self, bits: np.ndarray, block: int = EXCESS_BLOCK):
        self.block = block
        far = np.iinfo(np.int32).max
        count = max(1, -(-len(bits) // block))
        excess = np.full(count * block, far, dtype=np.int32)
        np.cumsum(bits.astype(np.int32) * 2 - 1, out=excess[: len(bits)])
        self.excess = excess.reshape(count, block)
        self.levels = [self.excess.min(axis=1)]
        while len(self.levels[-1]) > 1:
            level = self.levels[-1]
            if len(level) % 2:
                level = self.levels[-1] = np.append(level, far)
            self.levels.append(level.reshape(-1, 2).min(axis=1))

    def _scan(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place behind ``after`` in a block with excess ``target``, or -1."""
        out = np.empty(len(block), dtype=np.int64)
        columns = np.arange(self.block)
        for at in range(0, len(block), QUERIES):
            part = slice(at, at + QUERIES)
            hit = (self.excess[block[part]] <= target[part, None]) & (columns > after[part, None])
            place = hit.argmax(axis=1)
            out[part] = np.where(hit[np.arange(len(place)), place], block[part] * self.block + place, -1)
        return out

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        block, after = opens // self.block, opens % self.block
        target = self.excess[block, after] - 1
        close = self._scan(block, after, target)
        left = np.flatnonzero(close < 0)
        node = block[left]
        for height, least in enumerate(self.levels):
            if not len(left):
                break
            right = np.minimum(node + 1, len(least) - 1)
            found = (node % 2 == 0) & (least[right] <= target[left]) & (right > node)
            which, at = left[found], right[found]
            for lower in reversed(self.levels[:height]):
                at = 2 * at + (lower[2 * at] > target[which])
            close[which] = self._scan(at, np.full(len(at), -1), target[which])
            left, node = left[~found], node[~found] // 2
        return close


def subtree_minima(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Minimum of ``values[i : i + size[i]]`` for every i, by doubling."""
    out = values.copy()
    level = np.frexp(size)[1] - 1
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[at], table[at + size[at] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def _shared_prefixes(offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Turns that each path has in common with the one before it."""
    length = np.diff(offsets)
    shared = np.zeros(len(length), dtype=np.int64)
    short = np.minimum(length[1:], length[:-1])
    start = np.cumsum(short) - short
    place = np.arange(short.sum()) - np.repeat(start, short)
    one, two = np.repeat(offsets[:-2], short) + place, np.repeat(offsets[1:-1], short) + place
    differs = np.where((a[one] == a[two]) & (b[one] == b[two]), np.iinfo(np.int64).max, place)
    some = short > 0
    if some.any():
        shared[1:][some] = np.minimum(np.minimum.reduceat(differs, start[some]), short[some])
    return shared


def _prefix_ids(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """128-bit names of all prefixes of a path, the empty one first."""
    hasher, out = xxhash.xxh3_128(), []
    for turn in [b"", *np.stack([a, b], axis=1).astype("<i8")]:
        hasher.update(bytes(turn))
        digest = hasher.intdigest()
        out.append(((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
    return out


_INTERIOR = [("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
             ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]
_NODE = [*_INTERIOR, ("parent_conv_id", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
         ("s1", pa.int64()), ("s2", pa.int64()), ("chars", pa.int64()), ("path1", pa.int64()), ("path2", pa.int64())]
NODE_SCHEMA = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _NODE)


def encode_block(
    offsets: np.ndarray, a: np.ndarray, b: np.ndarray, chars: np.ndarray,
    members: np.ndarray, smallest: np.ndarray, ends: np.ndarray,
) -> pa.Table:
    """Node rows of a block of sorted distinct paths: whole ones of its inner
    nodes, and one per path and node of its first and last path, whose counts
    leave out what other spine nodes add."""
    length, shared = np.diff(offsets), _shared_prefixes(offsets, a, b)
    new = length - shared
    total = int(new.sum()) + 1
    path = np.repeat(np.arange(len(length)), new)
    depth = np.zeros(total, dtype=np.int64)
    depth[1:] = np.arange(total - 1) - np.repeat(np.cumsum(new) - new, new) + shared[path] + 1
    weight = np.zeros(total, dtype=np.int64)
    weight[1:] = chars[offsets[path] + depth[1:] - 1]

    node = np.arange(total)
    opens = 2 * node - depth
    bits = np.zeros(2 * total, dtype=np.int8)
    bits[opens] = 1
    closes = ExcessBlocks(bits).find_close(opens)
    size = (closes - opens + 1) // 2

    by_depth = np.lexsort((node, depth))
    place = np.searchsorted(depth[by_depth] * total + by_depth, (depth - 1) * total + node) - 1
    parent = by_depth[place]
    parent[0] = -1

    last = np.cumsum(new)  # the node that a path ends at
    ending = np.zeros(total, dtype=np.int64)
    ending[last] = members
    least = np.full(total, np.iinfo(np.int64).max)
    least[last] = smallest
    least = subtree_minima(least, size)
    digest = np.full(total, None, dtype=object)
    digest[last] = ends

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(values))
        return sums[node + size] - sums[node]

    n_convs = below(ending)
    spines = [np.arange(length[0] + 1)]
    if len(length) > 1:
        up = [int(last[-1])]
        while up[-1]:
            up.append(int(parent[up[-1]]))
        spines.append(np.array(up[::-1]))
    inner = np.ones(total, dtype=bool)
    inner[np.concatenate(spines)] = False

    pair = np.zeros(2 * total + 1, dtype=np.int64)
    pair[opens + 1] = (bits[opens] == 1) & (bits[opens + 1] == 0) & inner
    rank = np.cumsum(pair)
    n_leaves = rank[closes] - rank[opens]
    saved = below(np.where(inner, (n_convs - 1) * weight, 0))
    children = np.bincount(parent[1:][inner[1:]], minlength=total)

    ids: dict[int, tuple[int, int]] = {}
    paths = []
    for row, spine in zip((0, -1), spines):
        names = _prefix_ids(*(x[offsets[:-1][row] : offsets[1:][row]] for x in (a, b)))
        paths.append(names)
        ids.update(zip(spine.tolist(), names))
    at = np.flatnonzero(inner)
    above = parent[at]
    on_spine = ~inner[above]
    columns = {
        "conv_id": least[at], "depth": depth[at], "n_convs": n_convs[at], "n_children": children[at],
        "n_leaves": n_leaves[at], "saved": saved[at], "ends": digest[at],
        "parent_conv_id": [None if s else int(v) for s, v in zip(on_spine, least[above])],
        "p1": [ids[int(v)][0] if s else None for s, v in zip(on_spine, above)],
        "p2": [ids[int(v)][1] if s else None for s, v in zip(on_spine, above)],
    }
    tables = [columns | {name: [None] * len(at) for name, _ in _NODE[10:]}]
    counted: set[int] = set()
    for spine, names in zip(spines, paths):
        once = np.array([int(v) not in counted for v in spine])
        counted.update(spine.tolist())
        tables.append({
            "conv_id": least[spine], "depth": depth[spine], "n_convs": n_convs[spine] * once,
            "n_children": children[spine] * once, "n_leaves": n_leaves[spine] * once, "saved": saved[spine] * once,
            "ends": digest[spine], "parent_conv_id": [None] * len(spine),
            "p1": [None, *[n[0] for n in names[:-1]]], "p2": [None, *[n[1] for n in names[:-1]]],
            "s1": [n[0] for n in names], "s2": [n[1] for n in names], "chars": weight[spine],
            "path1": [names[-1][0]] * len(spine), "path2": [names[-1][1]] * len(spine),
        })
    return pa.concat_tables(
        [pa.table({name: pa.array(t[name], kind) for name, kind in _NODE}) for t in tables]
    )


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        a, b, chars = (table[c].combine_chunks() for c in ("a", "b", "n"))
        offsets = np.append(0, np.cumsum(a.value_lengths().to_numpy()))
        nodes = encode_block(
            offsets, *(x.flatten().to_numpy(zero_copy_only=False) for x in (a, b, chars)),
            table["members"].to_numpy(), table["smallest"].to_numpy(), table["ends"].to_numpy(),
        )
        yield from nodes.combine_chunks().to_batches(max_chunksize=1 << 14)

    held, turns = [], 0
    for batch in batches:
        lengths = batch.column(0).value_lengths().to_numpy()
        start = 0
        for i, length in enumerate(lengths.tolist()):
            turns += length
            if turns >= BLOCK_TURNS:
                held.append(batch.slice(start, i + 1 - start))
                yield from block(held)
                held, turns, start = [], 0, i + 1
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield from block(held)


def rebuilt_conversations(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", group: int = 100, turns: int = 6,
) -> DataFrame:
    """(conv_id, a, b, n) for every id c: the first h turns of conversation
    c - c % ``group`` and then c's own turns after its first h, with
    h = crc32(decimal c) % ``turns``; a and b hash the turns, n are the code
    points of their texts."""
    role, text = F.coalesce(col(role_col), F.lit("")), F.coalesce(col(text_col), F.lit(""))
    own = (
        conversations.where(col(id_col).isNotNull())
        .select(
            col(id_col).cast("long").alias("conv_id"),
            F.struct(
                col(turn_col).alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("a"),
                F.xxhash64(F.lit(7), role, text).alias("b"), F.char_length(text).cast("long").alias("n"),
            ).alias("t"),
        )
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
        .withColumn("h", F.expr(f"int(crc32(cast(cast(conv_id AS string) AS binary)) % {turns})"))
    )
    first = (
        own.where(f"conv_id % {group} = 0")
        .select(F.col("conv_id").alias("base"), F.expr(f"slice(t, 1, {turns - 1})").alias("before"))
    )
    joined = own.withColumn("base", F.expr(f"conv_id - conv_id % {group}")).join(first, "base", "left")
    path = F.expr("concat(coalesce(slice(before, 1, h), array()), slice(t, h + 1, greatest(size(t) - h, 0)))")
    return joined.select("conv_id", path.alias("t")).select(
        "conv_id", *[F.col(f"t.{c}").alias(c) for c in ("a", "b", "n")]
    )


def _member_digests(rebuilt: DataFrame) -> DataFrame:
    """(k1, k2, ends): SHA-256 of the ascending ids of each path's conversations.

    Ids are joined in chunks of bounded size; a path of several has them
    streamed through the hash in order, since the hash can't be put together.
    """
    chunks = stage(
        rebuilt.groupBy("k1", "k2", F.shiftright("conv_id", ID_BITS).alias("chunk"))
        .agg(F.array_join(F.expr("transform(sort_array(collect_list(conv_id)), c -> string(c))"), ",").alias("ids")),
        "trie-ids",
    )
    number = chunks.groupBy("k1", "k2").agg(F.count("*").alias("chunks"), F.first("ids").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, hasher):
            return pa.RecordBatch.from_pydict(
                {"k1": [key[0]], "k2": [key[1]], "ends": [hasher.hexdigest()]},
                schema=pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends", pa.string())]),
            )

        key, hasher = None, None
        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (k1, k2) != key:
                    if key is not None:
                        yield row(key, hasher)
                    key, hasher = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    hasher.update(b"," + ids.encode())
        if key is not None:
            yield row(key, hasher)

    many = chunks.join(number.where("chunks > 1").select("k1", "k2"), ["k1", "k2"], "left_semi")
    streamed = (
        many.select("k1", "k2", "chunk", "ids").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "chunk")
        .mapInArrow(digest, "k1 long, k2 long, ends string")
    )
    return number.where("chunks = 1").select("k1", "k2", F.sha2("ids", 256).alias("ends")).union(streamed)


def conversation_trie(conversations: DataFrame, **columns) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by number, null first; equal numbers by role and then by
    a hash of role and text. Rows that repeat are turns of their own. Null role or text is
    empty; a row of a null id belongs to no conversation. A conversation without turns
    ends at the root. An empty table has no nodes, not even a root. Turns are
    told apart by 128-bit hashes; a conversation's hashes are one row, its
    texts never are. ``columns`` are those of ``rebuilt_conversations``.
    """
    rebuilt = stage(
        rebuilt_conversations(conversations, **columns)
        .withColumn("k1", F.xxhash64("a", "b")).withColumn("k2", F.xxhash64(F.lit(7), "a", "b")),
        "trie-rebuilt",
    )
    paths = (
        rebuilt.groupBy("k1", "k2")
        .agg(F.first("a").alias("a"), F.first("b").alias("b"), F.first("n").alias("n"),
             F.count("*").alias("members"), F.min("conv_id").alias("smallest"))
        .join(_member_digests(rebuilt.select("k1", "k2", "conv_id")), ["k1", "k2"])
        .select("a", "b", "n", "members", "smallest", "ends")
    )
    paths = stage(paths, "trie-paths")
    nodes = stage(
        paths.repartitionByRange("a", "b").sortWithinPartitions("a", "b").mapInArrow(_encode, NODE_SCHEMA), "trie-nodes"
    )

    spine = nodes.where("s1 IS NOT NULL")
    node, above = ["s1", "s2"], ["p1", "p2"]
    merged = spine.groupBy(*node).agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.min(c).alias(c) for c in ("conv_id", "depth", "chars", "p1", "p2", "ends")],
        F.min(F.struct("path1", "path2")).alias("owner"),
    )
    merged = stage(merged, "trie-spine")
    spine_children = merged.where("p1 IS NOT NULL").groupBy(*above).agg(F.count("*").alias("more")).toDF(*node, "more")
    merged = stage(
        merged.join(spine_children, node, "left")
        .withColumn("n_children", F.expr("n_children + coalesce(more, 0)"))
        .withColumn("own_leaf", F.expr("int(n_children = 0)"))
        .withColumn("own_saved", F.expr("(n_convs - 1) * chars")),
        "trie-spine",
    )
    # Every spine node counts for the nodes above it along one of its paths.
    owned = spine.select(*node, "depth", "path1", "path2").join(merged.select(*node, "owner", "own_leaf", "own_saved"), node)
    up = Window.partitionBy("path1", "path2").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    mine = F.expr("int(owner.path1 = path1 AND owner.path2 = path2)")
    rising = owned.select(*node, F.sum(mine * F.col("own_leaf")).over(up).alias("l"), F.sum(mine * F.col("own_saved")).over(up).alias("t"))
    totals = rising.groupBy(*node).agg(F.sum("l").alias("l"), F.sum("t").alias("t"))
    spine_nodes = stage(
        merged.join(totals, node)
        .withColumn("n_leaves", F.expr("n_leaves + l")).withColumn("saved", F.expr("saved + t")),
        "trie-spine",
    )

    parents = spine_nodes.select(F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("conv_id").alias("above"))
    columns_out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    inner = nodes.where("s1 IS NULL")
    out = (
        inner.where("p1 IS NULL").select(*columns_out)
        .union(inner.where("p1 IS NOT NULL").join(parents, above).withColumn("parent_conv_id", F.col("above")).select(*columns_out))
        .union(spine_nodes.join(parents, above, "left").withColumn("parent_conv_id", F.col("above")).select(*columns_out))
    )
    return out.select(
        *columns_out[:6], F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
