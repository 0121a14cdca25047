"""The best of several lists for each user, without a row for every user and list entry.

A user's sources each bring a list of neighbours, so the join of users with lists is many times as large as either, and so is
what is left of it by user and item. Here it is made inside a task and never travels: users are dealt to blocks, a list goes once to
every block where somebody has its source, and a block's task holds its lists while its users stream through.

* What is shuffled is the users with their sources, the lists once a block that needs them (a list a source at most, not an
  entry a user), and the ``k`` rows found for each user.
* A list is cut to ``k + most`` entries first, ``most`` being the most sources a user has: those before a later one are at least as
  good for the user, and at most ``most`` of them are sources themselves, so a later one can't be among the user's best ``k``.
* A block holds ``HELD`` entries at most: all lists while they are no more, else those of as many sources as its own users have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import set_down

HELD = 2_000_000                                  # entries of the lists that a block holds
BLOCKS, BLOCK_SOURCES, FEW = 24, 2_000_000, 2048  # sources of a block's users; up to ``BLOCKS`` blocks hold ``FEW`` at least
AT_ONCE = 1_000_000                               # entries that meet users at a time


def block_count(sources: int, entries: int, longest: int) -> int:
    """Blocks for users with ``sources`` in all, beside lists of ``entries`` in all, the longest list having ``longest``."""
    most = BLOCK_SOURCES if entries <= HELD else min(BLOCK_SOURCES, max(1, HELD // longest))
    return max(1, min(BLOCKS, -(-sources // FEW)), -(-sources // most))


class _Lists:
    """The lists of a block: every entry has a place, its rank among the block's different (score, pid)."""

    def __init__(self) -> None:
        self.rows: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch) -> None:
        self.rows.append(rows)

    def ready(self) -> _Lists:
        rows, self.rows = pa.Table.from_batches(self.rows).combine_chunks(), []
        flat = lambda c: pc.list_flatten(rows.column(c)).combine_chunks()
        src, pid, score = flat("srcs").to_numpy(zero_copy_only=False), flat("pids"), flat("scores")
        sizes = pc.list_value_length(rows.column("pids")).to_numpy()
        by = np.argsort(src, kind="stable")
        self.src, self.size, self.start = src[by], sizes[by].astype(np.int64), (np.cumsum(sizes) - sizes)[by]
        # higher scores first (NaN is the highest), null last; ties by pid, null first
        no_pid, no_score = (x.is_null().to_numpy(zero_copy_only=False) for x in (pid, score))
        p, s = pid.fill_null(0).to_numpy(zero_copy_only=False), score.fill_null(0.0).to_numpy(zero_copy_only=False)
        nan = np.isnan(s)
        turn, less = np.where(no_score, 2, np.where(nan, 0, 1)), np.where(nan, 0.0, -s)
        order = np.lexsort((p, ~no_pid, less, turn))
        columns = [x[order] for x in (turn, less, no_pid, p)]
        new = np.r_[True, np.any([x[1:] != x[:-1] for x in columns], axis=0)]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        first = order[new]
        self.pid, self.score, self.places = pid.take(pa.array(first)), score.take(pa.array(first)), len(first)
        self.items = np.unique(p[~no_pid])
        self.item = np.where(no_pid[first], len(self.items), np.searchsorted(self.items, p[first]))
        return self

    def _best(self, user: np.ndarray, at: np.ndarray, seen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(user, place) of the best ``k`` of each user over its lists ``at``, without what it has ``seen`` (user, item)."""
        size = self.size[at]
        nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        met = np.sort(np.repeat(user, size) * self.places + self.place[np.repeat(self.start[at], size) + nth])
        met = met[np.r_[True, met[1:] != met[:-1]]]
        user, place = np.divmod(met, self.places)
        item = user * (len(self.items) + 1) + self.item[place]
        by = np.argsort(item, kind="stable")  # an item's best place comes first
        one = np.r_[True, item[by][1:] != item[by][:-1]]
        by = by[one][~np.isin(item[by][one], seen)]
        by.sort()
        user, place = user[by], place[by]
        begin = np.flatnonzero(np.r_[True, user[1:] != user[:-1]]) if len(user) else by
        nth = np.arange(len(user)) - np.repeat(begin, np.diff(np.r_[begin, len(user)]))
        return user[nth < k], place[nth < k]

    def best(self, rows: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        """(mid, pid, score): the best ``k`` of every user of ``rows``."""
        mid, n = rows.column("mid"), pc.list_value_length(rows.column("srcs")).to_numpy(zero_copy_only=False)
        src = rows.column("srcs").flatten().to_numpy(zero_copy_only=False)
        user = np.repeat(np.arange(len(n)), n)
        item = np.minimum(np.searchsorted(self.items, src), max(0, len(self.items) - 1))
        known = mid.is_valid().to_numpy(zero_copy_only=False)[user]  # a user without an id has seen nothing
        known &= self.items[item] == src if len(self.items) else False
        seen = (user * (len(self.items) + 1) + item)[known]
        at = np.minimum(np.searchsorted(self.src, src), len(self.src) - 1)
        has = self.src[at] == src
        user, at = user[has], at[has]
        total = np.cumsum(self.size[at])
        low = 0
        while low < len(user):  # whole users, ``AT_ONCE`` entries or one user
            high = int(np.searchsorted(total, (total[low - 1] if low else 0) + AT_ONCE, side="right"))
            high = int(np.searchsorted(user, user[high], side="left")) if high < len(user) else len(user)
            if high <= low:
                high = int(np.searchsorted(user, user[low], side="right"))
            who, place = self._best(user[low:high], at[low:high], seen, k)
            yield pa.RecordBatch.from_arrays([mid.take(pa.array(who)), self.pid.take(pa.array(place)), self.score.take(pa.array(place))],
                                             ["mid", "pid", "score"])
            low = high


def best_of_lists(users: DataFrame, lists: DataFrame, *, k: int, most: int) -> DataFrame:
    """The ``k`` best entries of each user's lists: (mid, pid, score), ties by smaller pid.

    ``users``: (mid, srcs), set down, a row a user with at most ``most`` different sources, none of them null; ``lists``: (src, pid,
    score). An item counts with its best score; a user's own sources are left out.
    """
    order = Window.partitionBy("src").orderBy(F.col("score").desc(), F.col("pid").asc())
    wanted = users.select(F.explode("srcs").alias("src"))
    n = lists.join(wanted.distinct(), "src", "left_semi").groupBy("src", "pid").agg(F.max("score").alias("score"))
    n = n.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + most)
    n = set_down(n.groupBy("src").agg(F.collect_list(F.struct("pid", "score")).alias("near")))
    sources = users.agg(F.sum(F.size("srcs"))).first()[0] or 0
    entries, longest = n.agg(F.sum(F.size("near")), F.max(F.size("near"))).first()
    blocks = block_count(sources, entries or 0, longest or 1)
    block = F.pmod(F.xxhash64("mid"), F.lit(blocks)).cast("int").alias("block")
    mid = users.schema["mid"].dataType.simpleString()
    there = users.select(block, F.explode("srcs").alias("src")).distinct().join(n, "src")
    there = there.select("block", F.lit(0).alias("side"), F.lit(None).cast(mid).alias("mid"), F.array("src").alias("srcs"),
                         F.col("near.pid").cast("array<bigint>").alias("pids"), F.col("near.score").cast("array<double>").alias("scores"))
    here = users.select(block, F.lit(1).alias("side"), "mid", "srcs", F.lit(None).cast("array<bigint>").alias("pids"),
                        F.lit(None).cast("array<double>").alias("scores"))
    both = there.unionByName(here).repartitionById(blocks, "block").sortWithinPartitions("block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, None
        for batch in batches:
            turn = batch.column("block").to_numpy().astype(np.int64) * 2 + batch.column("side").to_numpy()
            cuts = np.flatnonzero(np.r_[True, turn[1:] != turn[:-1]]) if len(turn) else []
            for a, b in zip(cuts, [*cuts[1:], len(turn)]):
                rows = batch.slice(a, b - a)
                if turn[a] // 2 != of:
                    of, held = turn[a] // 2, None
                if turn[a] % 2 == 0:
                    held = held or _Lists()
                    held.add(rows)
                elif held:  # else none of the block's users has a source with a list
                    if held.rows:
                        held.ready()
                    yield from held.best(rows, k)

    return both.mapInArrow(run, f"mid {mid}, pid long, score double")
