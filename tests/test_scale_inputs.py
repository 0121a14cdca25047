"""What the ladder and the counters read, and how often."""

from pyspark.sql import functions as F

from core_data import SF001
from candor.operators import boot as B
from candor.plans import q_boot, q_stream
from candor.sources import fixtures as X


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def read_by_the_rounds(monkeypatch, run):
    seen, candidates, transition = [], B.boot_candidates, B.boot_transition
    monkeypatch.setattr(B, "boot_candidates", lambda docs, *a, **k: seen.append(docs) or candidates(docs, *a, **k))
    monkeypatch.setattr(B, "boot_transition", lambda c, n, s, docs, *a, **k: seen.extend([c, n, docs]) or transition(c, n, s, docs, *a, **k))
    return run(), seen


def test_a_round_reads_documents_that_are_set_down(spark, monkeypatch):
    t, seen = read_by_the_rounds(monkeypatch, lambda: q_boot.q_boot_transition(spark, SF001))
    assert seen and not any("l_orderkey" in plan(d) for d in seen) and t.count() >= 0


def test_rounds_over_the_stream_read_documents_that_are_set_down(spark, monkeypatch):
    t, seen = read_by_the_rounds(monkeypatch, lambda: q_stream.q_stream_boot(spark, SF001))
    assert len(seen) == 4 * len(q_stream.ROUND_ENDS) and not any("l_orderkey" in plan(d) for d in seen)


def test_counters_join_genders_to_orders_not_to_lines(spark):
    p = plan(X.counters(spark, SF001))
    assert "l_partkey" not in p[p.index("Join LeftOuter"):]


def test_counters_of_repeated_and_unknown_keys(spark, tmp_path):
    rows = {
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_tax double, l_discount double, l_returnflag string, "
                     "l_linestatus string, l_extendedprice double, l_shipdate date",
                     [(1, 24, 1, 20.0, 0.05, 0.06, "R", "O", 1.0, None), (1, 24, 4, 8.0, None, 0.0, "N", "O", 1.0, None),
                      (2, 24, 2, 30.0, 0.05, 0.06, None, "O", 1.0, None), (3, 24, 3, 1.0, 0.0, 0.06, "R", "O", 1.0, None), (9, 24, 1, 1.0, 0.0, 0.0, "N", "O", 1.0, None)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (2, 2), (3, None)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 1), (1, 2), (2, 3)]),  # customer 1 twice, 2 of unknown gender
        "part": ("p_partkey long", [(24,), (25,)]),
    }
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = X.counters(spark, str(tmp_path)).collect()
    assert len(got) == 1
    r = got[0].asDict()
    # lines as joined: order 1 twice (genders 1 and 2), orders 2 and 3 as gender 0; m = 1 + 24 div 12 = 3
    assert (r["rec"], r["s0_rec"], r["s1_rec"], r["s2_rec"]) == (18, 6, 6, 6)
    assert (r["share"], r["s0_share"], r["s1_share"]) == (2, 0, 1) and (r["like"], r["s0_like"], r["s2_like"]) == (4, 2, 1)
    assert r["play_dur"] == (2 * 28 + 31) * 8 * 1000 // 8 and r["s1_play_dur"] == 28 * 1000
