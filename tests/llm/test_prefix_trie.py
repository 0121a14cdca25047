"""The prefix trie against a plain one that holds every prefix."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from candor.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos int, id string, depth int, block string"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = convs.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0)
    out = set()
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k))))
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes(spark, rows, batch=10_000):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = T.trie(spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def talk(c, texts):
    return [(c, k, "user" if k % 2 == 0 else "assistant", x) for k, x in enumerate(texts)]


ODD = [
    (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", ""), (1, None, "user", "null turn"), (2, 0, "", "é"), (2, 0, "", "é"),
    (5, 3, "user", "a"), (6, 1, "user", "a"), (6, 1, "user", "a"), (7, 2, None, "b"), (-7, 0, "user", "minus"), (-5, 0, "user", "minus base"), (-5, 1, "user", "x"),
    (10**17, 0, "user", "far"), (2**62 + 1, 0, "user", "further"), *talk(30, ["long " * 50_000, "é" * 1000]), *talk(31, []),
]


@pytest.mark.parametrize("rows", [ODD, [], [(None, None, None, None)], [(3, 0, "user", "one")]], ids=["odd", "empty", "nulls", "one"])
def test_odd_rows(spark, rows):
    assert nodes(spark, rows) == brute(rows)


def test_copies_over_many_batches(spark):
    # a third of all conversations are the same; prefixes of them; small batches, so most nodes have parts in several
    rows = [r for c in range(400) for r in talk(c, ["hello", "how", "are", "you", "today", "and", "then", "so", "on", "end"][:10 if c % 3 else 1 + c % 10])]
    assert nodes(spark, rows, batch=7) == brute(rows)


def test_conversations_longer_than_a_block(spark):
    same = [f"turn {k}" for k in range(150)]
    rows = [*talk(0, same), *talk(1, same), *talk(2, same[:32]), *talk(3, same[:64]), *talk(5, same[:100] + ["else"] * 60), *talk(10, same[:33])]
    for batch in (1, 3, 10_000):
        assert nodes(spark, rows, batch) == brute(rows)


def test_conversations_longer_than_a_run_of_blocks(spark):
    same = [f"t{k}" for k in range(2100)]
    rows = [*talk(0, same), *talk(5, same[:2090] + ["x"] * 30), *talk(10, ["y"])]
    assert nodes(spark, rows, 4) == brute(rows)


def test_table(spark):
    from candor.sources.tables import table
    from llm_data import SF001

    t = table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text")
    assert {tuple(r) for r in T.op13_prefix_trie(spark, SF001).collect()} == brute([tuple(r) for r in t.collect()])
