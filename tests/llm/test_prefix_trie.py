"""Prefix tries of conversations against a dictionary of all prefixes and the SQL twin."""
import collections
import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

pytest.importorskip("public_tokenizers")

from losslens.llm import prefix_trie, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
CHAT = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_key(role or "", text or ""), role or "", text or ""))
    own = {c: [(x[3], x[4]) for x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - c % 20, [])[:h] + t[h:]
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c, t in sorted(full.items()):
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
            if d:
                children[tuple(t[:d - 1])].add(tuple(t[:d]))
        ends[tuple(t)].append(c)
    below = collections.defaultdict(lambda: [0, 0])
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += p not in children
            below[p[:d]][1] += (len(m) - 1) * words
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]) if p in children else 0,
                    *below[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


def nodes(df, **limit):
    seqs = prefix_trie.rebuilt(df)
    return sorted((tuple(r) for r in prefix_trie.prefix_nodes(seqs, **limit).collect()), key=repr)


def chats(seed, convs, turns, texts):
    """Few texts, so that prefixes, whole conversations and ends inside others repeat."""
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "assistant"]), " ".join(["w"] * rnd.randint(0, texts)))
            for c in range(convs) for t in range(rnd.randint(1, turns))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [5, 40, 1 << 17])
def test_repeated_prefixes(spark, limit):
    rows = chats(limit, 300, 5, 2)
    assert nodes(spark.createDataFrame(rows, CHAT).repartition(3), shard_turns=limit) == brute(rows)


def test_one_common_conversation(spark):
    """A third of all conversations are one; another third share a first turn."""
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 200) for t in range(3)]
    rows += [(c, t, "user", "turn 0" if t == 0 else f"{c} {t}") for c in range(200, 300) for t in range(3)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(300, 400) for t in range(3)]
    df = spark.createDataFrame(rows, CHAT)
    assert nodes(df, shard_turns=20) == brute(rows) == nodes(df)


def test_long_conversations(spark):
    rows = [(c, t, "user", "x" if t < 700 or c != 41 else f"{t}") for c, n in ((40, 900), (41, 1000), (5, 3)) for t in range(n)]
    assert nodes(spark.createDataFrame(rows, CHAT), shard_turns=100) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "", ""), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"),
            (None, 0, "user", "lost"), (61, 0, "user", "base is absent"), (7, 5, "r", "é \x0b w"), (20, 1, "r", "z" * 100_000),
            (25, 0, "r", None)]
    df = spark.createDataFrame(rows, CHAT)
    more = df.selectExpr("*", "text AS key", "conv_id AS up", "1 AS h", "turn AS turns")
    assert nodes(more) == brute(rows)
    assert nodes(df.limit(0)) == []
    turnless = [(c, 0, "user", "a") for c in range(61, 79)]  # without a base, one turn is often all replaced
    out = nodes(spark.createDataFrame(turnless, CHAT))
    assert out == brute(turnless) and any(x[1] == 0 and x[7] != hashlib.sha256(b"").hexdigest() for x in out)


def test_ids_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    ids = np.array([*range(5, 40), 1000])
    out = list(prefix_trie.shard_nodes(0, ids, np.zeros(37, np.int64), prefix_trie.pa.array([], prefix_trie.pa.binary()),
                                       np.zeros(0, np.int64)))
    assert "".join(out[1].column("ends").to_pylist()) == ",".join(map(str, ids)) + ","
    pieces = out[1].select(["key", "ends"]).to_batches()
    got = list(prefix_trie._hash_pieces(iter(pieces)))[0].column("ends_sha256").to_pylist()
    assert got == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]


def test_double_array_walks(spark):
    """Every edge is found, no other pair is; equal and irregular sets of children."""
    rng = np.random.default_rng(3)
    for seed in range(20):
        turns = int(rng.integers(1, 60))
        parent, turn = [], []
        frontier, made = [0], 1
        while frontier and made < 400:
            node = frontier.pop(0)
            for t in rng.choice(turns, int(rng.integers(0, min(turns, 9) + 1)), replace=False):
                parent.append(node)
                turn.append(int(t))
                frontier.append(made)
                made += 1
        trie = prefix_trie.DoubleArray(np.array(parent, np.int64), np.array(turn, np.int64))
        edges = {(p, t): i + 1 for i, (p, t) in enumerate(zip(parent, turn))}
        assert len(set(trie.slot.tolist())) == len(trie.slot) == made
        for node in range(made):
            for t in range(-1, turns + 2):
                to = int(trie.step(trie.slot[node:node + 1], np.array([t]))[0])
                assert to == (trie.slot[edges[node, t]] if (node, t) in edges else -1)


def test_query_is_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(queries.ORACLE_SQL["op11_prefix_trie"])
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    out = queries.QUERIES["op11_prefix_trie"](spark, SF).select(*want.columns)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted(want.fetchall(), key=repr) == brute([tuple(r) for r in rows])
