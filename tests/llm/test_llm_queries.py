"""The registered queries against their DuckDB SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from candor.llm.queries import ORACLES, QUERIES
from candor.sources.tables import table
from llm_data import ODD, SF001, SF01, docs_of
from oracle_check import duck, frame_hash
from test_near_duplicates import brute_classes
from test_packing import check


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("sf", [SF001, SF01])
def test_matches_oracle(spark, name, sf):
    got, want = QUERIES[name](spark, sf).toPandas(), duck(sf).execute(ORACLES[name]).df()
    assert frame_hash(got) == frame_hash(want)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "packing"]


def test_stages(spark):
    docs = table(spark, SF01, "documents")
    columns, held = docs.columns, docs
    for name, stage in C.STAGES[:-1]:
        out = C.materialise(stage(spark, held, SF01), "test-stage")
        assert out.columns == columns
        before = [tuple(r) for r in held.select("doc_id", "text", "source").collect()]
        after = [tuple(r) for r in out.select("doc_id", "text", "source").collect()]
        if name == "toxicity":
            marks = dict(duckdb.sql(f"select doc_id, toxic from read_parquet('{SF01}/labels.parquet')").fetchall())
            clean = [r for r in before if marks.get(r[0]) == 0]
            assert set(after) <= set(before) and len(set(clean) & set(after)) >= 0.95 * len(clean)
        elif name == "exact_dedup":
            best = {}
            for i, t, s in before:
                best[t.lower()] = max(best.get(t.lower(), (-1,)), (i, t, s))
            assert sorted(after) == sorted(best.values())
        elif name == "near_dedup":
            assert sorted(i for i, _, _ in after) == sorted(i for i, _ in brute_classes(before))
        else:
            assert abs(sum(len(t.split()) for _, t, _ in after) - sum(len(t.split()) for _, t, _ in before)) <= 30
        held = out
    rows = [(r["doc_id"], r["text"]) for r in held.collect()]
    check(rows, C.STAGES[-1][1](spark, held, SF01).collect(), 4096, most_padding=0.01)


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_stages_take_odd_rows(spark, rows):
    docs = docs_of(spark, rows)
    for _, stage in C.STAGES:
        docs = C.materialise(stage(spark, docs, SF001), "test-stage")
    assert (docs.count() > 0) == bool(rows)
