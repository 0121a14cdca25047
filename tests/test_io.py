"""Round trips through the readers and sinks (scratch folder under /tmp)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candor.operators.review import taxonomy_flat
from candor.sinks import writers as W
from candor.sources import readers as R


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="candor-io-", dir="/tmp")


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_ptype_tid_csv_skips_bad_rows(spark, tmp):
    p = _write(os.path.join(tmp, "pt.csv"), "1,5,7\n2,3\nx,2,3\n4,2,9,1\n5,2,8\n")
    got = sorted(tuple(r) for r in R.read_ptype_tid_csv(spark, p).collect())
    assert got == [(1, 5, 7), (5, 2, 8)]


def test_ranked_csv_positions(spark, tmp):
    p = _write(os.path.join(tmp, "r.csv"), "0,1,72,11,0.5\n1,2,73,12,0.25\n")
    got = sorted(tuple(r) for r in R.read_ranked_csv(spark, p, key_index_list=[2, 1, 0], pid_index=3, score_index=4).collect())
    assert got == [("72_1_0", 11, 0.5), ("73_2_1", 12, 0.25)]


def test_sequence_lines_and_rules(spark, tmp):
    p = _write(os.path.join(tmp, "seq.txt"), "1 2  3\n\n4\t5\n")
    assert [r["items"] for r in R.read_sequence_lines(spark, p).collect()] == [["1", "2", "3"], ["4", "5"]]
    from candor.constants import STEP_RULES_YAML

    rules = R.read_rules(spark, _write(os.path.join(tmp, "rules.yaml"), STEP_RULES_YAML))
    assert [s["expose_to"] for s in rules["video"]] == [200, 500, 1000]
    assert [s["expose_to"] for s in rules["img"]] == [100, 200, 500]


def test_taxonomy_json_filters_and_flattens(spark, tmp):
    tree = {"ret": 1, "data": {"list": [
        {"_id": 13, "name": "a", "ct": 1, "child_list": [{"_id": 70, "name": "x", "ct": 5}, {"_id": 71, "status": -1}]},
        {"_id": -1, "name": "neg", "child_list": [{"_id": 72}]},
        {"_id": 14, "name": "b", "status": -5, "child_list": [{"_id": 73}]},
        {"_id": 15, "name": "c", "ct": 2, "child_list": [{"_id": 70, "ct": 9}]},
    ]}}
    tids = {"ret": 1, "data": [{"70": [1, 2]}, {"71": [3]}, {"72": [4]}, {"73": [5]}]}
    t = R.read_taxonomy_json(spark, _write(os.path.join(tmp, "tree.json"), json.dumps(tree)))
    pt = R.read_part_tids_json(spark, _write(os.path.join(tmp, "tids.json"), json.dumps(tids)))
    got = sorted(tuple(r) for r in taxonomy_flat(t, pt).select("tid", "part2_id", "part1_id").collect())
    assert got == [(1, 70, 15), (2, 70, 15)]      # newest ct wins for part2 70; 71-73 are filtered out


def test_publish_versions_and_upsert(spark, tmp):
    base = os.path.join(tmp, "pool")
    W.publish_version(spark.range(3).withColumnRenamed("id", "pid"), base, "20011104")
    W.publish_version(spark.range(5).withColumnRenamed("id", "pid"), base, "20011105")
    assert W.read_latest(spark, base).count() == 5
    # a version that was being written when its job died is not listed, and nobody reads it
    spark.range(9).withColumnRenamed("id", "pid").write.parquet(f"{base}/data/v=20011106-lost")
    assert W.read_latest(spark, base).count() == 5
    held = W.read_latest(spark, base)
    W.publish_version(spark.range(7).withColumnRenamed("id", "pid"), base, "20011105")  # again: a folder of its own
    assert held.count() == 5 and W.read_latest(spark, base).count() == 7
    with pytest.raises(FileNotFoundError):
        W.read_latest(spark, os.path.join(tmp, "nothing"))
    cur = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "pid long, remaining long")
    upd = spark.createDataFrame([(2, 25, False), (3, 0, True), (4, 40, False)], "pid long, remaining long, gone boolean")
    got = sorted(tuple(r) for r in W.upsert(cur, upd, "pid", delete_col="gone").collect())
    assert got == [(1, 10), (2, 25), (4, 40)]


def test_index_push_batches_per_partition(spark, tmp):
    df = spark.createDataFrame([(f"k{i}", str(i), 100) for i in range(7)], "index_key string, value string, expires_at long")
    out = os.path.join(tmp, "kv")
    os.makedirs(out)

    class Pipe:
        def __init__(self):
            self.buf = []

        def setex(self, k, s, v):
            self.buf.append(f"{k}\t{s}\t{v}\n")

        def execute(self):
            with open(os.path.join(out, f"{os.getpid()}-{id(self)}"), "a") as f:
                f.writelines(self.buf)
            self.buf = []

    class Client:
        def pipeline(self):
            return Pipe()

    W.push_index(df.repartition(3), Client, batch_size=2, as_of=40)
    lines = sorted(l for fn in os.listdir(out) for l in open(os.path.join(out, fn)))
    assert len(lines) == 7 and all(l.split("\t")[1] == "60" for l in lines)


def test_index_pieces_have_keys_of_their_own(spark, tmp):
    from candor.operators.index import topn_index

    df = spark.range(11).selectExpr("id % 2 AS g", "id AS pid", "cast(id AS double) AS score")
    idx = topn_index(df, keys=["g"], score_col="score", top=0, chunk=2, prefix="k_", as_of=0, fmt="%d:%.0f")
    rows = {r["index_key"]: r["value"] for r in idx.collect()}
    assert rows["k_0"] == "3" and rows["k_1"] == "3" and len(rows) == idx.count() == 8
    assert ",".join(rows[f"k_0#{i}"] for i in range(3)) == "10:10,8:8,6:6,4:4,2:2,0:0"
    out = os.path.join(tmp, "kv")
    os.makedirs(out)

    class Client:
        def pipeline(self):
            return self

        def setex(self, k, s, v):
            with open(os.path.join(out, k), "x") as f:  # fails if a key is written twice
                f.write(v)

        def execute(self):
            pass

    W.push_index(idx, Client, as_of=0)
    assert len(os.listdir(out)) == 8
    with pytest.raises(ValueError, match="2 rows"):
        W.push_index(idx.unionByName(idx.limit(1)), Client, as_of=0)


def test_neighbour_text_round_trip(spark, tmp):
    from candor.operators.neighbours import neighbour_lines

    n = spark.createDataFrame([(1, 2, 0.5, 0.51, "img", "2:0.5"), (1, 3, 0.5, 0.52, "img", "3:0.5"),
                               (4, 5, 0.9, 0.9, "video", "5:0.9")],
                              "pid long, near_pid long, score double, sim double, kind string, item string")
    path = os.path.join(tmp, "nb")
    W.write_neighbour_text(neighbour_lines(n), path)
    back = R.read_neighbour_text(spark, os.path.join(path, "kind=img"))
    assert [(r["pid"], r["near_pid"]) for r in back.orderBy("pos").collect()] == [(1, 3), (1, 2)]
    assert F is not None


def test_cluster_profile_sizes_partitions():
    from candor.session import cluster_profile

    p = cluster_profile(100e12, executors=1000, cores_per_executor=8)
    assert int(p["spark.sql.shuffle.partitions"]) == int(100e12 // (256 << 20)) + 1
    small = cluster_profile(1e9, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120          # at least three waves of 40 cores
    assert p["spark.sql.adaptive.enabled"] == "true" and p["spark.sql.session.timeZone"] == "UTC"
