"""Trained item vectors: against a plain trainer, held-out next items, warm start, partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.operators import sgns
from candor.operators.embed import cooccurrence, cooccurrence_vectors

SEQ = "items array<string>"


def walks(spark, n, seed, items=200, length=12, first=0):
    """Sentences that walk on a ring of items in small steps: what comes next is near."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        at, s = int(rng.integers(items)), []
        for _ in range(length):
            s.append(str(first + at))
            at = (at + int(rng.integers(1, 4))) % items
        out.append((s,))
    return spark.createDataFrame(out, SEQ)


def test_one_block_equals_the_plain_trainer(spark):
    counts = cooccurrence(walks(spark, 60, 1, items=20), min_count=1)
    got, losses = sgns.train(counts, size=8, epochs=2, seed=5, rate=0.05)
    rows = sorted((r["item"], r["ctx"], r["n"]) for r in counts.collect())
    items = sorted({a for a, *_ in rows})
    total = {a: sum(n for b, _, n in rows if b == a) for a in items}
    kept = {a: min(1.0, (1e-3 / (t / sum(total.values()))) ** 0.5 + 1e-3 / (t / sum(total.values()))) for a, t in total.items()}
    from candor.operators.embed import signs_of

    a = np.array([[s * 0.5 / 8 for s in signs_of(x, 8)] for x in items])
    c = np.zeros((len(items), 8))
    at = {x: k for k, x in enumerate(items)}
    want = []
    for epoch in range(2):
        w = np.array([n * kept[x] * kept[y] for x, y, n in rows])
        loss = sgns.trained_block(a, c, np.array([at[x] for x, *_ in rows]), np.array([at[y] for _, y, _ in rows]), w, np.array([total[x] ** 0.75 for x in items]),
                                  rate=0.05 * max(0.05, 1 - epoch / 2), negative=5, rng=np.random.default_rng([5, epoch, 0, 0]))
        want.append(loss / w.sum())
    assert np.allclose(losses, want, rtol=1e-9)
    mine = {r["item"]: (r["vin"], r["vctx"]) for r in got.collect()}
    assert all(np.allclose(mine[x][0], a[at[x]], atol=1e-9) and np.allclose(mine[x][1], c[at[x]], atol=1e-9) for x in items)


def test_steps_follow_the_gradient():
    """A pass over one pair with one negative, by hand."""
    a, c = np.array([[0.3, -0.2]]), np.array([[0.1, 0.4], [0.5, 0.2]])
    u, v, no = a[0].copy(), c[0].copy(), c[1].copy()
    loss = sgns.trained_block(a, c, np.array([0]), np.array([0]), np.array([1.0]), np.array([0.0, 1.0]), rate=0.1, negative=1, rng=np.random.default_rng(1))
    s = lambda x: 1 / (1 + np.exp(-x))
    p, q = s(u @ v), s(u @ no)
    assert np.allclose(a[0], u + 0.1 * ((1 - p) * v - q * no)) and np.allclose(c[0], v + 0.1 * (1 - p) * u) and np.allclose(c[1], no - 0.1 * q * u)
    assert abs(loss + np.log(p) + np.log(1 - q)) < 1e-9


def plain_pass(a, c, i, j, w, often, *, rate, negative, rng):
    """A pass batch by batch, with indexed adds of whole rows."""
    at = np.repeat(np.arange(len(w)), np.floor(w + rng.random(len(w))).astype(np.int64))
    rng.shuffle(at)
    p, loss = np.cumsum(often / often.sum()), 0.0
    for k in range(0, len(at), sgns.BATCH):
        x, y = i[at[k:k + sgns.BATCH]], j[at[k:k + sgns.BATCH]]
        no = np.minimum(np.searchsorted(p, rng.random((len(x), negative))), len(c) - 1)
        target, sign = np.column_stack([y, no]), np.eye(1, negative + 1).repeat(len(x), axis=0)
        u, v = a[x], c[target]
        got = 1 / (1 + np.exp(-np.clip(np.einsum("bd,bkd->bk", u, v), -30, 30)))
        g, own = rate * (sign - got), no == y[:, None]
        g[:, 1:][own] = 0
        loss -= np.log(got[:, 0] + 1e-12).sum() + (np.log(1 - got[:, 1:] + 1e-12) * ~own).sum()
        np.add.at(a, x, np.einsum("bk,bkd->bd", g, v))
        np.add.at(c, target.ravel(), (g[:, :, None] * u[:, None, :]).reshape(-1, a.shape[1]))
    return loss


def test_a_pass_gives_the_plain_steps_in_a_fraction_of_their_time():
    """One task trains a small vocabulary whatever the number of events, so its steps must be cheap."""
    from time import process_time

    for items, repeats, k in ((100, 3.3, 5), (3000, 0.7, 3), (7, 1.5, 5)):  # several draws of negatives, and a last batch that is not full
        rng = np.random.default_rng(items)
        n = min(items * items, 24_000)
        i, j, w = rng.integers(0, items, n), rng.integers(0, items, n), rng.random(n) * 2 * repeats
        a, c, often = rng.normal(size=(items, 100)) / 9, rng.normal(size=(items, 100)) / 9, rng.random(items)
        took, made = [], []
        for run in (plain_pass, sgns.trained_block):
            mine, ctx, begun = a.copy(), c.copy(), process_time()
            loss = run(mine, ctx, i, j, w, often, rate=0.05, negative=k, rng=np.random.default_rng(3))
            took.append(process_time() - begun)
            made.append((mine, ctx, loss))
        assert np.allclose(made[0][0], made[1][0], rtol=0, atol=1e-12) and np.allclose(made[0][1], made[1][1], rtol=0, atol=1e-12)
        assert made[1][2] == pytest.approx(made[0][2], rel=1e-12)
        if items > 7:
            assert took[1] < 0.65 * took[0], took
    with pytest.raises(ValueError):
        sgns.trained_block(np.asfortranarray(a), c, i, j, w, often, rate=0.05, negative=5, rng=rng)


def test_next_items_beat_projection_and_popularity(spark):
    train, held = walks(spark, 1500, 1), walks(spark, 300, 2)
    counts = cooccurrence(train, min_count=1)
    trained, losses = sgns.train(counts, size=24, epochs=8, rate=0.1, sample=1.0)
    assert losses[-1] < 0.9 * losses[0]
    rate = lambda v: sgns.next_item_hits(held, v, k=5).first()["rate"]
    mine, projected = rate(sgns.item_vectors(trained)), rate(cooccurrence_vectors(counts, size=24))
    top = [r["item"] for r in train.select(F.explode("items").alias("item")).groupBy("item").count().orderBy(F.desc("count"), "item").limit(5).collect()]
    popular = held.where(F.element_at("items", -1).isin(top)).count() / held.count()
    print("next item:", mine, projected, popular)
    assert mine > projected and mine > 5 * popular


def test_blocks_rotate_over_all_pairs_and_partitions_do_not_matter(spark):
    seq = walks(spark, 300, 3, items=60)
    counts = cooccurrence(seq, min_count=1)
    got, losses = sgns.train(counts, size=8, epochs=3, block=15, rate=0.1, sample=1.0)  # four blocks
    again, same = sgns.train(counts.repartition(5), size=8, epochs=3, block=15, rate=0.1, sample=1.0)
    assert got.count() == 60 and losses[-1] < losses[0] and losses == pytest.approx(same, rel=1e-12)
    a, b = ({r["item"]: r["vin"] for r in x.collect()} for x in (got, again))
    assert all(np.allclose(a[k], b[k], atol=1e-12) for k in a)


def test_warm_start_needs_fewer_passes_and_keeps_old_items(spark):
    one = cooccurrence(walks(spark, 800, 4), min_count=1)
    grown = walks(spark, 800, 5).unionByName(walks(spark, 60, 6, items=20, first=190))  # items 200 to 209 are new
    two = cooccurrence(grown, min_count=1).where("item not in ('0', '1') and ctx not in ('0', '1')")  # two old ones aren't seen today
    start, _ = sgns.train(one, size=16, epochs=8, rate=0.1, sample=1.0)
    warm, w = sgns.train(two, size=16, epochs=2, rate=0.1, sample=1.0, start=start)
    cold, c = sgns.train(two, size=16, epochs=8, rate=0.1, sample=1.0)
    assert w[1] < c[3]  # two passes from yesterday's are better than four from nothing
    old, new = ({r["item"]: np.array(r["vin"]) for r in x.collect()} for x in (start, warm))
    assert set(old) <= set(new) and {str(k) for k in range(200, 210)} <= set(new) and len(new) == 210
    assert np.allclose(old["0"], new["0"]) and np.allclose(old["1"], new["1"])
    cos = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    assert np.mean([cos(old[k], new[k]) for k in old]) > 0.9
    begun = {r["item"]: np.array(r["vin"]) for r in sgns.started(two, 16, 1, start).collect()}
    assert cos(begun["205"], np.mean([old[str(k)] for k in range(195, 200)], axis=0)) > 0.3  # a new item begins near its contexts


def test_empty_and_odd_counts(spark):
    none = spark.createDataFrame([], "item string, ctx string, n double")
    got, losses = sgns.train(none)
    assert got.count() == 0 and losses == []
    one = spark.createDataFrame([("a", "b", 3.0), ("b", "a", 3.0)], "item string, ctx string, n double")
    got, losses = sgns.train(one, size=4, epochs=2)
    assert got.count() == 2 and len(losses) == 2 and sgns.item_vectors(got).count() == 0
    kept, losses = sgns.train(none, start=got)
    assert kept.count() == 2 and losses == []
