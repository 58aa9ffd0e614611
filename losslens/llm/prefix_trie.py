"""Prefix tries of conversations as double arrays.

A turn is known by the SHA-256 of its role and text, so no text is shuffled.
Conversations are ranged over partitions in the order of their turns, then of
their ids: shards are runs of neighbours in that order, equally large however
common a first turn or a whole conversation is.  Each shard of at most
``SHARD_TURNS`` turns (or one longer conversation) is a trie packed into two
arrays over dense turn ids: the child of slot s by turn t is slot BASE[s] + t
if CHECK there is s.  All conversations of a shard walk the arrays side by
side and leave their numbers at the slots they pass.

A node can lie in several shards only if it is on the path of the first or the
last conversation of each of them.  Only these nodes, at most two paths a
shard, leave their shard unfinished: their counts are merged over all shards
by the hash of their path, their children among themselves counted, and sums
over subtrees added up by doubling the distance to the ancestor that receives
them, one round for each bit of the depth.  The ids that end at such a node
come as pieces of text in the order of shards and pass through one running
hash.  All other nodes are final in their shard; the children of merged nodes
take the parent's smallest member by a join on (shard, node), which no node
can make uneven.

Defined cases: null role and text are empty; a null turn comes first; rows of
one conversation with the same turn are ordered by the hash of role and text,
and repeated rows are repeated turns.  Rows without a conversation id belong
to no conversation and are left out.  An empty table has no nodes, not even a
root.  A conversation is one row of 40 bytes a turn: its rows are gathered in
each map task before they are shuffled.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import arrow_rows, checkpoint

SHARD_TURNS = 1 << 17
PROBES = 4096  # places that a node's children try before they go to the end of the arrays
PIECE = 1 << 16  # letters of the ids that one row carries
BLOCK, HEADS = 20, 4  # conversations that share a head; a head has under HEADS turns
NO_ID = np.iinfo(np.int64).max
WORD = r"[^\x20\x09-\x0D]+"


class DoubleArray:
    """Trie over dense turn ids.  ``edges`` come in breadth-first order, those
    of one node together: parent and turn id of nodes 1, 2, ...; node 0 is the
    root."""

    def __init__(self, parent: np.ndarray, turn: np.ndarray):
        nodes = len(parent) + 1
        count = np.bincount(parent, minlength=nodes)
        first = np.concatenate(([0], np.cumsum(count)))
        self.base = np.zeros(0, np.int64)
        self.check = np.zeros(0, np.int64)  # slot of the parent; -1 where the slot is free
        self._grow(2 * nodes)
        slot = np.zeros(nodes, np.int64)
        base_of = np.zeros(nodes, np.int64)
        taken = np.zeros(len(self.check), bool)
        taken[0] = True  # the root's own
        front = end = 1  # first place to try; places from end on are free
        many = np.flatnonzero(count > 1)
        for node in many[np.argsort(-count[many], kind="stable")].tolist():
            kids = turn[first[node]:first[node + 1]]
            apart = kids - kids.min()
            span = int(apart.max()) + 1
            while len(taken) < max(front + PROBES, end) + span:
                taken = np.append(taken, np.zeros(len(taken) + span, bool))
            at, step = -1, max(1, PROBES // len(kids))
            for low in range(front, min(front + PROBES, end), step):
                tried = np.arange(low, min(low + step, front + PROBES, end))
                fits = np.flatnonzero(~taken[tried[:, None] + apart].any(1))
                if len(fits):
                    at = int(tried[fits[0]])
                    break
            if at < 0:
                at = front = end
            taken[at + apart] = True
            end = max(end, at + span)
            free = np.flatnonzero(~taken[front:end])
            front = front + int(free[0]) if len(free) else end
            slot[1 + first[node]:1 + first[node + 1]] = at + apart
            base_of[node] = at - int(kids.min())
        # an only child goes to any free place
        one = np.flatnonzero(count == 1)
        free = np.flatnonzero(~taken)
        if len(free) < len(one):
            free = np.append(free, np.arange(len(taken), len(taken) + len(one)))
        slot[1 + first[one]] = free[:len(one)]
        base_of[one] = free[:len(one)] - turn[first[one]]
        self._grow(int(slot.max()) + 1)
        self.slot = slot
        self.base[slot] = base_of
        self.check[slot[1:]] = slot[parent]

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1))

    def step(self, state: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """The child of each slot by each turn id; -1 if there is none."""
        to = self.base[state] + turn
        inside = (state >= 0) & (turn >= 0) & (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == state), to, -1)


def _sorted_edges(turn: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, turn) of all nodes but the root, breadth first, of sequences in
    ascending order, those of row r from ``start[r]`` on."""
    size = np.diff(start)
    rows = np.flatnonzero(size > 0)
    node, parents, turns, made, depth = np.zeros(len(rows), np.int64), [], [], 1, 0
    while len(rows):
        t = turn[start[rows] + depth]
        new = np.append(True, (np.diff(node) != 0) | (np.diff(t) != 0))
        parents.append(node[new])
        turns.append(t[new])
        node = made + np.cumsum(new) - 1
        made += int(new.sum())
        depth += 1
        on = size[rows] > depth
        rows, node = rows[on], node[on]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *parents]), np.concatenate([empty, *turns])


FIELDS = [("shard", pa.int64()), ("key", pa.binary()), ("up", pa.binary()), ("conv_id", pa.int64()),
          ("parent_conv_id", pa.int64()), ("depth", pa.int64()), ("words", pa.int64()), ("n_convs", pa.int64()),
          ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
          ("ends_sha256", pa.string()), ("piece", pa.int64()), ("ends", pa.string())]
SCHEMA = ", ".join(f"{n} {'long' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}" for n, t in FIELDS)


def shard_nodes(shard: int, ids: np.ndarray, start: np.ndarray, keys: pa.Array, words: np.ndarray) -> Iterator[pa.Table]:
    """Nodes of one shard's trie; conversations are in ascending order of turns
    and ids, the turns of row r from ``start[r]`` on.

    A row with a key is a node that other shards may have too (its path's
    hash; ``up`` is its parent's).  Its sums hold what lies below its final
    children only, and the ids that end there follow in rows with ``piece``.
    A row without a key is final; if its parent is not, ``up`` names it.
    """
    seen = keys.dictionary_encode()
    turn = seen.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    parent, by = _sorted_edges(turn, start)
    # dense ids in the order in which nodes need them: most siblings are then neighbours
    first = np.full(len(seen.dictionary), len(by))
    np.minimum.at(first, by, np.arange(len(by)))
    dense = np.empty(len(first), np.int64)
    dense[np.argsort(first, kind="stable")] = np.arange(len(first))
    turn = dense[turn]
    of_turn = np.zeros(len(first) + 1, np.int64)
    of_turn[turn] = words
    trie = DoubleArray(parent, dense[by])
    slots = len(trie.check)
    n_convs, least = np.zeros(slots, np.int64), np.full(slots, NO_ID)
    depth, last = np.zeros(slots, np.int64), np.full(slots, len(first))
    size = np.diff(start)
    state, rows, level = np.zeros(len(ids), np.int64), np.arange(len(ids)), 0
    levels, ended = [np.zeros(1, np.int64)], np.zeros(len(ids), np.int64)
    while True:  # every conversation one turn on
        np.add.at(n_convs, state, 1)
        np.minimum.at(least, state, ids[rows])
        ended[rows] = state
        on = size[rows] > level
        rows, state = rows[on], state[on]
        if not len(rows):
            break
        by = turn[start[rows] + level]
        state = trie.step(state, by)
        level += 1
        depth[state], last[state] = level, by
        levels.append(np.unique(state))
    used = np.concatenate(levels)
    up = trie.check
    n_children = np.bincount(up[used[1:]], minlength=slots)
    shared, paths = np.zeros(slots, bool), {}
    for row in {0, len(ids) - 1}:
        at, path = 0, hashlib.sha256()
        shared[0], paths[0] = True, path.digest()
        for p in range(start[row], start[row + 1]):
            at = int(trie.step(np.array([at]), turn[p:p + 1])[0])
            path.update(keys[p].as_py())
            shared[at], paths[at] = True, path.copy().digest()
    leaves = (~shared & (n_children == 0)).astype(np.int64)
    leaves[trie.check < 0] = 0
    saved = np.where(shared, 0, (n_convs - 1) * of_turn[last])
    inner = n_children.copy()  # final children
    for nodes in reversed(levels[1:]):  # deepest first
        final = nodes[~shared[nodes]]
        np.add.at(leaves, up[final], leaves[final])
        np.add.at(saved, up[final], saved[final])
        np.subtract.at(inner, up[nodes[shared[nodes]]], 1)
    order = np.argsort(ended, kind="stable")
    cut = np.concatenate(([0], np.flatnonzero(np.diff(ended[order])) + 1, [len(order)]))
    empty = hashlib.sha256(b"").hexdigest()
    digests, pieces = {}, []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        node, text = int(ended[order[a]]), ",".join(map(str, ids[order[a:b]].tolist()))
        if shared[node]:
            pieces += [(paths[node], k // PIECE, text[k:k + PIECE] + ("," if k + PIECE >= len(text) else ""))
                       for k in range(0, len(text), PIECE)]
        else:
            digests[node] = hashlib.sha256(text.encode()).hexdigest()
    is_shared = shared[used]
    parent_slot = np.where(used > 0, up[used], 0)
    open_parent = shared[parent_slot]
    yield _table({
        "shard": np.full(len(used), shard), "key": [paths.get(s) for s in used.tolist()],
        "up": [paths[p] if o and s else None for s, p, o in zip(used.tolist(), parent_slot.tolist(), open_parent.tolist())],
        "conv_id": least[used], "parent_conv_id": pa.array(least[parent_slot], mask=open_parent), "depth": depth[used],
        "words": of_turn[last[used]], "n_convs": n_convs[used], "n_children": np.where(is_shared, inner[used], n_children[used]),
        "n_leaves": leaves[used], "saved_tokens": saved[used],
        "ends_sha256": [None if s in paths else digests.get(s, empty) for s in used.tolist()]}, len(used))
    if pieces:
        yield _table({"shard": np.full(len(pieces), shard), "key": [p[0] for p in pieces],
                      "piece": [p[1] for p in pieces], "ends": [p[2] for p in pieces]}, len(pieces))


def _table(columns: dict, rows: int) -> pa.Table:
    return pa.table([columns[n] if isinstance(columns.get(n), pa.Array) else pa.array(columns[n], t) if n in columns
                     else pa.nulls(rows, t) for n, t in FIELDS], pa.schema(FIELDS))


def _build(batches: Iterator[pa.RecordBatch], limit: int = SHARD_TURNS) -> Iterator[pa.RecordBatch]:
    """Shards of one partition's sorted conversations, each built when it is full."""
    number, held, turns = TaskContext.get().partitionId() << 32, [], 0

    def close() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys, words = table.column("keys").combine_chunks(), table.column("words").combine_chunks()
        start = keys.offsets.to_numpy().astype(np.int64)
        for out in shard_nodes(number, table.column("conv_id").to_numpy(), start - start[0], keys.flatten(),
                               words.flatten().to_numpy(zero_copy_only=False)):
            yield from out.combine_chunks().to_batches()

    for batch in batches:
        ends = np.cumsum(batch.column("keys").value_lengths().to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = int(np.searchsorted(ends, before + limit - turns, "right"))
            if stop == at and held:  # full
                yield from close()
                number, held, turns = number + 1, [], 0
                continue
            stop = max(stop, at + 1)
            held.append(batch.slice(at, stop - at))
            turns += int(ends[stop - 1]) - before
            at = stop
    if held:
        yield from close()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each key, whose pieces come sorted; only one running hash is held."""
    key, running, tail, keys, digests = None, None, "", [], []

    def close():
        running.update(tail[:-1].encode())  # without the last comma
        keys.append(key)
        digests.append(running.hexdigest())

    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if running is not None:
                    close()
                key, running, tail = k, hashlib.sha256(), ""
            running.update(tail.encode())
            tail = text
    if running is not None:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (key, words)) in the order of turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"),
                    F.regexp_count(text, F.lit(WORD)).alias("words"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "words"))).alias("turns"))
            .selectExpr("conv_id", "transform(turns, t -> struct(t.key AS key, t.words AS words)) AS turns"))


def rebuilt(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """Sequences whose first h turns are those of conversation c - c % block
    (as many as it has), h = crc32(c) % heads."""
    shared = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    own = checkpoint(sequences(conversations).withColumn("h", shared))
    head = own.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("of"),
                                                            F.slice("turns", 1, max(heads - 1, 1)).alias("head"))
    return (own.join(head, F.col("conv_id") - F.col("conv_id") % block == F.col("of"), "left")
            .selectExpr("conv_id", """if(head IS NULL, slice(turns, h + 1, size(turns)),
                concat(slice(head, 1, h), slice(turns, h + 1, size(turns)))) AS turns"""))


def prefix_nodes(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of (conv_id, turns)."""
    spark = seqs.sparkSession
    flat = checkpoint(seqs.selectExpr("conv_id", "turns.key AS keys", "turns.words AS words"))
    turns = flat.agg(F.sum(F.size("keys"))).first()[0] or 0
    shards = max(1, -(-turns // shard_turns), min(turns >> 12, 2 * spark.sparkContext.defaultParallelism))
    made = checkpoint(flat.repartitionByRange(int(shards), "keys", "conv_id").sortWithinPartitions("keys", "conv_id")
                      .mapInArrow(partial(_build, limit=shard_turns), SCHEMA))
    parts = made.where("key IS NOT NULL AND piece IS NULL")
    merged = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("up").alias("up"), F.max("depth").alias("depth"),
        F.max("words").alias("words"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    kids = merged.where("up IS NOT NULL").groupBy("up").agg(F.count("*").alias("more")).withColumnRenamed("up", "key")
    merged = checkpoint(
        merged.join(kids, "key", "left").withColumn("n_children", F.expr("n_children + coalesce(more, 0)")).drop("more")
        .withColumn("n_leaves", F.expr("n_leaves + if(n_children = 0, 1, 0)"))
        .withColumn("saved_tokens", F.expr("saved_tokens + (n_convs - 1) * words")))
    sums = _subtree_sums(merged)
    with arrow_rows(spark, 64):
        ended = checkpoint(made.where("piece IS NOT NULL").select("key", "shard", "piece", "ends")
                           .repartition("key").sortWithinPartitions("key", "shard", "piece")
                           .select("key", "ends").mapInArrow(_hash_pieces, "key binary, ends_sha256 string"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("above"))
    upper = (merged.drop("n_leaves", "saved_tokens").join(sums, "key").join(ended, "key", "left").join(above, "up", "left")
             .withColumn("parent_conv_id", F.col("above"))
             .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))
    final = made.where("key IS NULL")
    of_shard = parts.select("shard", "key").join(above.withColumnRenamed("up", "key"), "key")
    below = (final.where("up IS NOT NULL").join(of_shard.withColumnRenamed("key", "up"), ["shard", "up"])
             .withColumn("parent_conv_id", F.col("above")))
    return final.where("up IS NULL").select(*columns).union(below.select(*columns)).union(upper.select(*columns))


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) summed over each node and all nodes below
    it.  In round r every node's sums go to its ancestor at distance 2^r."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    now = nodes.select("key", "up", "n_leaves", "saved_tokens")
    for _ in range(int(deepest).bit_length()):
        add = (now.where("up IS NOT NULL").groupBy("up")
               .agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).withColumnRenamed("up", "key"))
        higher = now.select(F.col("key").alias("up"), F.col("up").alias("higher"))
        now = checkpoint(now.join(add, "key", "left").join(higher, "up", "left").select(
            "key", F.col("higher").alias("up"), F.expr("n_leaves + coalesce(l, 0)").alias("n_leaves"),
            F.expr("saved_tokens + coalesce(s, 0)").alias("saved_tokens")))
    return now.drop("up")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_nodes(rebuilt(conversations))
