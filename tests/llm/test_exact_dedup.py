"""Exact dedup: against brute force, the index over batches, odd rows."""

import hashlib
import string
import uuid
from collections import defaultdict

from candor.llm import exact_dedup as E
from llm_data import ODD, docs_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[digest(t)].append(i)
    return {d: (max((i for i in ids if i is not None), default=None), len(ids)) for d, ids in groups.items()}


def test_odd_rows(spark, odd):
    want = brute(ODD)
    got = E.dedup(odd).collect()
    assert len(got) == len(ODD)
    kept = defaultdict(int)
    for r in got:
        d = bytes(r["digest"]).hex()
        assert (r["keep_id"], r["group_size"]) == want[d]
        kept[d] += r["kept"]
    assert set(kept.values()) == {1} and set(kept) == set(want)


def test_documents_keep_their_columns(spark, odd, empty):
    out = E.distinct_documents(odd)
    assert out.columns == odd.columns
    texts = [(r["text"] or "").translate(LOWER) for r in out.collect()]
    assert len(texts) == len(set(texts)) == len(brute(ODD))
    assert E.distinct_documents(empty).count() == 0
    assert E.dedup(empty).count() == 0


def test_index_over_batches(spark):
    name = f"t_{uuid.uuid4().hex}"
    index = E.DigestIndex(spark, name, buckets=3)
    first = E.digests(docs_of(spark, [(9, "A b", "x"), (8, "c", "x")]))
    index.ingest(first)
    again = E.DigestIndex(spark, name)
    assert again.buckets == 3
    later = E.digests(docs_of(spark, [(10, "a B", "x"), (11, "new", "x"), (12, "NEW", "x")]))
    again.ingest(later)
    again.ingest(later)  # bringing a batch twice changes nothing
    assert sorted(r["keep_id"] for r in again.read().collect()) == [8, 9, 12]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in again.resolve(later).collect()}
    assert got == {10: (9, 1), 11: (12, 2), 12: (12, 2)}
    again.drop()


def test_anti_join_reads_the_index_in_its_layout(spark):
    name = f"t_{uuid.uuid4().hex}"
    index = E.DigestIndex(spark, name, buckets=4)
    rows = E.digests(docs_of(spark, [(i, f"t{i}", "x") for i in range(50)]))
    index.ingest(rows)
    own = rows.select("digest").distinct().repartition(4, "digest")
    joined = own.hint("merge").join(index.read(), "digest", "left_anti")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    executed = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "Bucketed: true" in executed
    index.drop()


def test_ids_far_apart_are_all_in_some_batch(spark):
    for ids in ((0, 10**17), (-2**63, 2**63 - 1), (2**63 - 1,), (0, 1, 10**17 - 1, 10**17), (-2**63, -1, 0, 2**63 - 1)):
        for batches in (1, 2, 3):
            rows = [(i, "same", "a") for i in ids] + [(i, f"own {i}", "a") for i in ids]
            got = E.dedup(docs_of(spark, rows), batches).collect()
            assert len(got) == len(rows)
            assert {r["keep_id"] for r in got if r["group_size"] > 1} <= {max(ids)}
            assert sum(r["kept"] for r in got) == len(ids) + 1
