"""Near duplicates: BagMinHash signatures over word shingles, bands, exact multiset overlap.

A text is the multiset of its five-word shingles (a shorter text is one shingle), and two texts are
near when the sum of the smaller counts is at least ``threshold`` times the sum of the larger.

Signature. Every shingle carries a Poisson process over (time, level): the levels below its count are
its own. The levels are discretised to whole counts and laid out in doubling intervals, each with a
process of its own whose rate is its length, so a shingle of count w needs about log2(w) of them, and
points of an interval above w are dropped. Each point falls to one of the signature's components,
which keeps its earliest point. Points come in order of time, so a shingle stops as soon as its next
point is later than all components' earliest: most shingles of a long text end after one point.
Two texts agree in a component with probability equal to their weighted Jaccard similarity.

Candidates. ``BANDS`` bands of ``ROWS`` components; texts that agree in a whole band share a bucket. At
similarity 0.8 a pair shares none with probability (1 - 0.8^5)^30 = 7e-6.

Links, without all pairs of a group. A text weighs as much as its buckets hold (the sum of the
logarithms), so among many copies those weigh most that differ least from the others. Each text is
first compared with the heaviest text in its buckets, and linked texts are joined to components.
Buckets whose texts are all in one component have nothing more to tell. A passage that very many
texts hold can still fill the others with texts that are alike, but not near. So their texts are dealt
anew by rare elements (an element is a shingle and its number among equal ones, so a text is a set of
them): near texts of n elements share n * ``threshold`` at least, hence one of the n - that + 1 which
are rarest by their number of such texts. What many texts hold is among the rarest of none of them, so
their groups are small, and no near pair is lost. While groups hold more than ``PAIRS`` pairs an entry
between components, every text is compared with the representatives of up to ``LEADERS`` other
components of its group, heaviest first, which joins what is left of large groups of copies. When few
pairs are left, or such a round doesn't halve them, all pairs between components of a group are compared. In
either case a pair is passed over if its sizes and the places of the group's element in the two orders
don't allow the threshold: what comes before a pair's first common element is in one text alone. So
every pair that shares a bucket is linked, known to be apart, or joined by others, and no count of
partners is limited.

Exact copies (equal words) are one text throughout, known by 64 bits of its MD5.

Defined results: null, empty and blank texts have no shingles; they are copies of each other and near
to nothing else; a null doc_id is smaller than any other; of a class, the row with the largest
doc_id stays (one of them, if rows repeat); an empty table gives no rows. doc_id and text are read by
name, so further columns can have any name. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import top_per_group
from .common import decided, materialise, require, stored, table, with_row_id

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 5
LEADERS, PAIRS = 32, 4
CACHE = 500_000  # words whose hashes a task keeps; then it starts afresh
PART_WORDS = 400_000  # words whose signatures are worked out together

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= CACHE:
            self.clear()
        self[word] = h
        return h


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingle_hashes(h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts laid end to end -> 64-bit shingle hashes, text after text, and their number
    in each text. A text shorter than a shingle is one shingle of its own width."""
    width = np.minimum(lengths, SHINGLE)
    number = np.where(lengths > 0, lengths - width + 1, 0)
    starts = np.cumsum(lengths) - lengths
    first = np.repeat(starts - (np.cumsum(number) - number), number) + np.arange(number.sum())
    wide = np.repeat(width, number)
    x = wide.astype(U)
    for k in range(SHINGLE):
        on = wide > k
        x[on] = _mix(x[on] ^ h[first[on] + k]) + U(k + 1)
    return x, number


def shingled(texts: list[list[str]], hashes: dict[str, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each text (its words), as sorted 64-bit hashes, and their counts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    h = np.fromiter((hashes[w] for t in texts for w in t), U, int(lengths.sum()))
    x, number = shingle_hashes(h, lengths)
    ends = np.cumsum(number)
    return [np.unique(x[e - n:e], return_counts=True) for e, n in zip(ends, number, strict=True)]


def shingles(words: list[str], hashes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    return shingled([words], hashes)[0]


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' shingles (0 if either has none)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], components: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, a row for each bag: the identity of each component's earliest point.

    Rows of bags without elements are 0.
    """
    n_docs, m = len(bags), components
    doc = np.repeat(np.arange(n_docs), [len(b[0]) for b in bags])
    if not len(doc):
        return np.zeros((n_docs, m), U)
    element = np.concatenate([b[0] for b in bags])
    count = np.concatenate([b[1] for b in bags]).astype(np.int64)
    # a row for each interval of levels that begins below the count: [0, 1), [1, 2), [2, 4), [4, 8), ...
    rows = [(doc, element, count, 0, 1)]
    begin = 1
    while (more := count > begin).any():
        rows.append((doc[more], element[more], count[more], begin, begin))
        begin *= 2
    begins = np.concatenate([np.full(len(r[0]), r[3], np.int64) for r in rows])
    length = np.concatenate([np.full(len(r[0]), r[4], np.int64) for r in rows])
    doc, element, count = (np.concatenate([r[k] for r in rows]) for k in range(3))
    key = _mix(element ^ _mix(begins.astype(U) + U(0x9E3779B97F4A7C15)))
    time, step = np.zeros(len(doc)), np.zeros(len(doc), np.int64)
    first = np.full(n_docs * m, np.inf)
    who = np.zeros(n_docs * m, U)
    while len(doc):
        g = max(1, min(64, 30_000 // len(doc)))  # points made at once: more when few rows are left
        k = step[:, None] + np.arange(g)
        point = _mix(key[:, None] + k.astype(U) * U(0xD1342543DE82EF95))
        wait = -np.log(((_mix(point ^ U(1)) >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / length[:, None]
        wait[:, 0] += time
        at = np.cumsum(wait, axis=1)
        level = begins[:, None] + ((_mix(point ^ U(2)) >> U(11)).astype(np.float64) * 2.0**-53 * length[:, None]).astype(np.int64)
        cell = doc[:, None] * m + (_mix(point ^ U(3)) % U(m)).astype(np.int64)
        own = (level < count[:, None]) & (at < first[cell])
        cells, times, points = cell[own], at[own], point[own]
        np.minimum.at(first, cells, times)
        won = times == first[cells]
        who[cells[won]] = points[won]
        time, step = at[:, -1], step + g
        on = time < first.reshape(n_docs, m).max(axis=1)[doc]
        doc, key, count, begins, length, time, step = (x[on] for x in (doc, key, count, begins, length, time, step))
    return who.reshape(n_docs, m)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """A bucket id (signed 64 bit, the band's number mixed in) for each band of each signature."""
    x = np.arange(1, BANDS + 1, dtype=U)[None, :] * U(0x9E3779B97F4A7C15) + np.zeros((len(signature), 1), U)
    for r in range(ROWS):
        x = _mix(x ^ signature[:, r::ROWS][:, :BANDS])
    return x.view(np.int64)


def text_id(words: list[str]) -> int:
    h = hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()
    return int.from_bytes(h[:8], "little", signed=True)


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHash()
    for batch in batches:
        words, held, done = [], 0, 0
        for k, text in enumerate(batch["text"]):
            words.append(words_of(text))
            held += len(words[-1])
            if held >= PART_WORDS or k == len(batch) - 1:
                buckets = band_hashes(signatures(shingled(words, hashes)))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[done:k + 1], "rid": batch["rid"].iloc[done:k + 1],
                    "tid": [text_id(w) for w in words],
                    "buckets": [b if w else None for b, w in zip(buckets, words, strict=True)]})
                words, held, done = [], 0, k + 1


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, rid, tid (text id) and buckets of every document; set down, as several steps read it."""
    rows = with_row_id(require(docs, ["doc_id", "text"])).select("row.doc_id", "rid", "row.text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialise(rows.mapInPandas(_signed, f"doc_id {kind}, rid bigint, tid bigint, buckets array<bigint>"), "signed")


def _similarity(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, kept = _WordHash(), OrderedDict()

    def of(tid: int, text: str) -> tuple[np.ndarray, np.ndarray]:
        if tid in kept:
            kept.move_to_end(tid)
        else:
            kept[tid] = shingles(words_of(text), hashes)
            if len(kept) > 256:
                kept.popitem(last=False)
        return kept[tid]

    for batch in batches:
        got = [overlap(of(a, x), of(b, y)) for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True)]
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": got})


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of text ids (a, b) with their exact similarity; set down.

    Both joins are between plain shuffles, so adaptive execution splits a leader with many texts.
    """
    a = texts.select(F.col("tid").alias("ta"), F.col("text").alias("text_a"))
    b = texts.select(F.col("tid").alias("tb"), F.col("text").alias("text_b"))
    rows = pairs.join(a, F.col("a") == F.col("ta")).join(b, F.col("b") == F.col("tb"))
    return materialise(rows.select("a", "b", "text_a", "text_b").mapInPandas(
        _similarity, "a bigint, b bigint, similarity double"), "compared")


def components(links: DataFrame) -> DataFrame:
    """Connected components: tid and comp, the least text id, for every text with a link.

    Each round a text takes the least label among its neighbours' and then its label's own label,
    so labels cross long chains in a number of rounds that grows with the logarithm of their length.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialise(edges, "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("tid"), F.least("a", "b").alias("comp"))
    labels = materialise(labels, "labels")
    while True:
        seen = edges.join(labels, edges["b"] == labels["tid"]).groupBy("a").agg(F.min("comp").alias("seen"))
        next_ = labels.join(seen, labels["tid"] == seen["a"]).select(
            "tid", F.least("comp", "seen").alias("comp"), F.col("comp").alias("was"))
        next_ = materialise(next_, "labels")
        up = next_.select(F.col("tid").alias("at"), F.col("comp").alias("up"))
        next_ = materialise(next_.join(up, F.col("comp") == F.col("at"), "left").select(
            "tid", F.coalesce("up", "comp").alias("comp"), "was"), "labels")
        labels = next_.select("tid", "comp")
        if not next_.where("comp <> was").limit(1).count():
            return labels


def _pairs_left(members: DataFrame) -> tuple[int, int]:
    """Texts in buckets, and pairs of them in different components, from the sizes of each."""
    sizes = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return tuple(x or 0 for x in sizes.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first())


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHash()
    for batch in batches:
        for tid, text in zip(batch["tid"], batch["text"], strict=True):
            x, n = shingles(words_of(text), hashes)
            number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = _mix(np.repeat(x, n) ^ _mix(number.astype(U))).view(np.int64)
            yield pd.DataFrame({"tid": tid, "size": len(own), "bucket": own})


def rare_elements(texts: DataFrame, threshold: float) -> DataFrame:
    """(bucket, tid, size, rn): of every text's elements, ``size`` in number, the rarest among ``texts``, as
    many as hold one of each near text's, without those that no other text holds; ``rn`` is an element's
    place in the text's order. Set down."""
    elements = materialise(texts.mapInPandas(_elements, "tid bigint, size bigint, bucket bigint"), "elements")
    held = elements.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).withColumnRenamed("bucket", "of")
    elements = elements.join(held, F.col("bucket") == F.col("of")).drop("of")
    order = Window.partitionBy("tid").orderBy("held", "bucket")
    rarest = F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-6)) + 1
    elements = elements.withColumn("rn", F.row_number().over(order)).where((F.col("rn") <= rarest) & (F.col("held") > 1))
    return materialise(elements.select("bucket", "tid", "size", "rn"), "rare")


def link(docs: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame | None:
    """tid and comp of all texts of ``rows`` (``signed(docs)``) that have a near text, else None."""
    exploded = rows.select(F.explode("buckets").alias("bucket"), "tid")
    shared = exploded.groupBy("bucket").agg(F.min("tid").alias("first"), F.max("tid").alias("last"))
    shared = materialise(shared.where("first <> last").select(F.col("bucket").alias("of")), "shared")
    members = materialise(exploded.join(shared, F.col("bucket") == F.col("of"), "left_semi").distinct(), "members")
    if not members.limit(1).count():
        return None
    held = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"))
    weights = members.join(held, "bucket").groupBy("tid").agg(F.sum(F.floor(F.log2("held") * 1024)).alias("weight"))
    weights = materialise(weights, "weights")
    ids = weights.select(F.col("tid").alias("of"))
    one = rows.join(ids, F.col("tid") == F.col("of"), "left_semi").groupBy("tid").agg(F.min(F.struct("doc_id", "rid")).alias("at"))
    one = one.select("tid", F.col("at.doc_id").alias("at_id"), F.col("at.rid").alias("at_rid"))
    texts = with_row_id(require(docs, ["doc_id", "text"]))
    texts = texts.join(one, (F.col("rid") == F.col("at_rid")) & F.col("row.doc_id").eqNullSafe(F.col("at_id")))
    texts = materialise(texts.select("tid", "row.text"), "texts")

    def spanning(members: DataFrame, comps: DataFrame) -> DataFrame:
        """``members`` of the buckets that hold more than one component, with their comp."""
        c = comps.withColumnRenamed("tid", "c_tid")
        own = [x for x in members.columns if x != "comp"]
        m = members.select(*own).join(c, F.col("tid") == F.col("c_tid"), "left").select(*own, F.coalesce("comp", "tid").alias("comp"))
        mixed = m.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
        return materialise(m.join(mixed.select("bucket"), "bucket", "left_semi"), "members")

    # each text against the heaviest in its buckets
    led = members.join(weights, "tid").groupBy("bucket").agg(F.max(F.struct("weight", "tid")).alias("led"))
    led = members.join(led, "bucket").groupBy("tid").agg(F.max("led").alias("led"))
    known = compared(led.select(F.col("tid").alias("a"), F.col("led.tid").alias("b")).where("a <> b"), texts)
    comps = components(known.where(F.col("similarity") >= threshold))
    ids = spanning(members.select("bucket", "tid"), comps).select("tid").distinct().withColumnRenamed("tid", "of")
    rare = rare_elements(texts.join(ids, F.col("tid") == F.col("of"), "left_semi"), threshold)
    members, before = spanning(rare.join(weights, "tid"), comps), None
    while True:
        n, left = _pairs_left(members)
        if not left:
            return comps
        last = left <= PAIRS * n or before is not None and 2 * left > before
        if last:
            others = members
        else:
            reps = members.groupBy("bucket", "comp").agg(F.max(F.struct("weight", "tid", "size", "rn")).alias("at")).select("bucket", "comp", "at.*")
            others = top_per_group(reps, ["bucket"], [F.desc("weight"), F.asc("comp")], LEADERS, name="nth")
        a = members.select("bucket", *[F.col(x).alias(f"{x}_a") for x in ("tid", "comp", "size", "rn")])
        b = others.select(F.col("bucket").alias("of"), *[F.col(x).alias(f"{x}_b") for x in ("tid", "comp", "size", "rn")])
        common = F.least(F.expr("size_a - rn_a + 1"), F.expr("size_b - rn_b + 1"))  # at most, if this is the first
        near = common >= (F.col("size_a") + F.col("size_b")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6)
        pairs = a.join(b, (F.col("bucket") == F.col("of")) & (F.col("comp_a") != F.col("comp_b")) & near)
        pairs = pairs.select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        new = compared(pairs.join(known.select("a", "b"), ["a", "b"], "left_anti"), texts)
        joined = new.where(F.col("similarity") >= threshold).limit(1).count() > 0
        known = materialise(known.unionByName(new), "known")
        if joined:
            comps = components(known.where(F.col("similarity") >= threshold))
        if last:
            return comps
        members, before = spanning(members, comps), left


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document: doc_id, rid, class_id (doc_id of the row of its class that stays), class_rid,
    class_size, kept."""
    docs = stored(docs)
    rows = signed(docs)
    comps = link(docs, rows, threshold)
    classed = rows.select("doc_id", "rid", "tid")
    if comps is None:
        classed = classed.withColumnRenamed("tid", "class")
    else:
        comps = comps.withColumnRenamed("tid", "c_tid")
        classed = classed.join(comps, F.col("tid") == F.col("c_tid"), "left").select(
            "doc_id", "rid", F.coalesce("comp", "tid").alias("class"))
    classed = materialise(classed, "classed")
    reps = classed.groupBy("class").agg(F.max(F.struct("doc_id", "rid")).alias("last"), F.count(F.lit(1)).alias("class_size"))
    reps = materialise(reps.select(F.col("class").alias("of"), F.col("last.doc_id").alias("class_id"),
                                   F.col("last.rid").alias("class_rid"), "class_size"), "classes")
    same = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("rid") == F.col("class_rid"))
    return classed.join(reps, F.col("class") == F.col("of")).drop("of", "class").withColumn("kept", same)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns kept, without the rows whose class another row stands for."""
    docs = stored(docs)
    return decided(with_row_id(docs), near_duplicates(docs, threshold).where("kept"), "doc_id")


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, class_id, class_size, kept."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")
