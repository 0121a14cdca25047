"""Packing token ids into fixed windows: bounded-space online best fit.

Each task streams over its documents' ids and keeps ``open_windows`` windows open. A document that is
longer than a window gives whole windows and a rest. A piece goes to the open window that it fills
best; if it fits none, the fullest window is emitted: its gap is filled with the head of the piece
if the gap is at least ``min_cut`` ids, else it stays as padding. What is open when a task ends is
merged over all tasks: the leftover windows are laid end to end (running totals of their lengths, a
row a window, not a row a document) and cut every ``window`` ids. The last, shorter stretch is cut at
powers of two, which need no padding.

A task holds ``open_windows`` windows, one batch of documents and a bounded number of words' ids, whatever the table's size; there is
no shuffle of documents, so one source or many copies make no hot task.

Defined results: a null text is an empty document, which is its end id alone; a null doc_id stays
null; repeated rows are separate documents; an empty table gives no pieces. doc_id and text are
read by name, so further columns can have any name.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, require, table

CACHE = 500_000  # pieces whose ids a worker keeps; then it starts afresh
BLOCK = 1 << 23  # bytes of text that are split and looked up at a time (one document at least)
TURN = 1 << 19  # words whose ids are laid out at a time (one document at least)


def byte_letters() -> dict[int, str]:
    """The byte-level BPE alphabet: printable Latin-1 bytes stand for themselves, the others for the
    characters from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: chr(b if b in own else next(others)) for b in range(256)}


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, laid end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes make up about ``most``, at least one each."""
    turns = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1), len(sizes)]
    return ((i, k) for i, k in itertools.pairwise(cuts) if k > i)


class _Numbers(dict):
    """Piece -> its number, given when first met; ``new`` has those whose ids are not known yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        n = self[piece] = len(self)
        return n


class WordIds:
    """Texts -> their ids, a block of texts at a time.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in a
    row, and each different word of a block is looked up once. A word of the plain letters below, with
    ASCII marks after it, is two pieces for the tokenizer's model, letters and marks; a piece's ids
    are kept for later blocks. Any other word goes through the whole tokenizer as it is.
    """

    PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<marks>[!-/:-@\[-`{-~]*)$"

    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {b: c for b, c in byte_letters().items() if b != 0x20}
        last = self.model.get_vocab(with_added_tokens=False)
        self.is_last = np.zeros(max(last.values(), default=0) + 1, bool)  # ids that only a piece's end can have
        self.is_last[[n for token, n in last.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.starts, self.lengths = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Put down the ids of the new pieces."""
        ids, lengths = [self.ids], [self.lengths]
        for pieces in itertools.batched(self.numbers.new, 1000):
            mapped = " ".join(pieces).encode().decode("latin-1").translate(self.letters)
            found = np.array(self.model.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_last[found]) + 1
            some = np.array([piece != "" for piece in pieces])
            if len(ends) == some.sum():  # each piece has one such id, its last
                n = np.zeros(len(pieces), np.int64)
                n[some] = np.diff(ends, prepend=0)
            else:
                each = [e.ids for e in self.model.encode_batch_fast(mapped.split(" "), add_special_tokens=False)]
                n, found = np.array([len(e) for e in each], np.int64), np.array([*itertools.chain(*each)], "<u4")
            ids.append(found)
            lengths.append(n)
        self.numbers.new.clear()
        self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _numbered(self, pieces: pa.Array) -> np.ndarray:
        pieces = pieces.dictionary_encode()
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces.dictionary.to_pylist()), np.int64, len(pieces.dictionary))
        return numbers[pieces.indices.to_numpy()]

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each word where its own start and how many they are."""
        if len(self.numbers) > CACHE:
            self._forget()
        parts = pc.extract_regex(words, self.PLAIN)
        plain = pc.and_(parts.is_valid(), pc.less_equal(pc.utf8_length(words), 64))  # longer: rare, not kept
        parts, others = parts.filter(plain), words.filter(pc.invert(plain)).to_pylist()
        pieces = np.column_stack([self._numbered(pc.utf8_lower(pc.struct_field(parts, "letters"))),
                                  self._numbered(pc.struct_field(parts, "marks"))])
        self._learn()
        whole = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        n = self.lengths[pieces]
        ids = np.concatenate([self.ids[_spans(self.starts[pieces.ravel()], n.ravel())], *whole])
        lengths, plain = np.empty(len(words), np.int64), plain.to_numpy(zero_copy_only=False)
        lengths[plain], lengths[~plain] = n.sum(axis=1), [len(w) for w in whole]
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])  # as the ids lie
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return ids, starts, lengths

    def documents(self, texts: pa.Array, end_id: int) -> Iterator[bytes]:
        """Each text's ids and ``end_id`` after them, as little-endian 32-bit integers."""
        texts = pc.fill_null(texts, "")
        for i, k in _groups(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), BLOCK):
            words = pc.ascii_split_whitespace(texts.slice(i, k - i))  # at WORD's white space
            n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            words = words.flatten().dictionary_encode()
            ids, starts, lengths = self._of_words(words.dictionary)
            codes, at = words.indices.to_numpy(), np.cumsum(n_words)
            # the end id is one more word, the last
            ids, starts, lengths = np.append(ids, np.uint32(end_id)), np.append(starts, len(ids)), np.append(lengths, 1)
            for a, b in _groups(n_words, TURN):
                first = at[a] - n_words[a]
                some = np.insert(codes[first:at[b - 1]], at[a:b] - first, len(lengths) - 1)
                n = lengths[some]
                laid = ids[_spans(starts[some], n)].astype("<u4", copy=False)
                ends = np.cumsum(n)[at[a:b] - first + np.arange(b - a)]
                for lo, hi in itertools.pairwise([0, *ends.tolist()]):
                    yield laid[lo:hi].tobytes()

    def of(self, text: str | None) -> bytes:
        return next(self.documents(pa.array([text], pa.string()), 0))[:-4]


_KEPT: list[tuple[str, WordIds]] = []


def kept_words(tokenizer: str) -> WordIds:
    """The worker's words, kept from task to task as long as the tokenizer is the same."""
    if not _KEPT or _KEPT[0][0] != tokenizer:
        _KEPT[:] = [(tokenizer, WordIds(tokenizer))]
    return _KEPT[0][1]


class _Windows:
    """Open windows of one task; pieces are (document, start, bytes of ids)."""

    def __init__(self, size: int, keep: int, min_cut: int):
        self.size, self.keep, self.min_cut = size, keep, min_cut
        self.room: list[int] = []
        self.pieces: list[list[tuple]] = []

    def add(self, doc, start: int, ids: bytes) -> Iterator[list[tuple]]:
        """Place a piece that fits a window; yields the windows that this closes."""
        n = len(ids) // 4
        if n == self.size:
            yield [(doc, start, ids)]
            return
        best = min((r, k) for k, r in enumerate(self.room) if r >= n) if any(r >= n for r in self.room) else None
        if best is None and len(self.room) < self.keep:
            self.room.append(self.size)
            self.pieces.append([])
            best = (self.size, len(self.room) - 1)
        if best is None:
            gap, k = min((r, k) for k, r in enumerate(self.room))
            full, self.pieces[k], self.room[k] = self.pieces[k], [], self.size
            if gap >= self.min_cut:
                full.append((doc, start, ids[:4 * gap]))
                start, ids, n = start + gap, ids[4 * gap:], n - gap
            yield full
            if any(n <= r < self.size for r in self.room):  # the rest may fit elsewhere now
                best = min((r, k) for k, r in enumerate(self.room) if r >= n)
            else:
                best = (self.size, k)
        k = best[1]
        self.pieces[k].append((doc, start, ids))
        self.room[k] -= n
        if not self.room[k]:
            yield self.pieces[k]
            self.pieces[k], self.room[k] = [], self.size

    def rest(self) -> Iterator[list[tuple]]:
        yield from (p for p in self.pieces if p)


def _windows(docs: DataFrame, tokenizer: str, end_id: int, size: int, keep: int, min_cut: int) -> DataFrame:
    """Pieces in windows of one task: part, window, open (left over when the task ended), offset, doc_id,
    start, length, ids (binary), doc_tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary: it does not grow with the data

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        here, words, windows, number = TaskContext.get().partitionId(), kept_words(sent.value), _Windows(size, keep, min_cut), 0
        out: list[tuple] = []
        id_type = None

        def close(pieces: list[tuple], is_open: bool) -> None:
            nonlocal number
            at = 0
            for (doc, n), start, ids in pieces:
                out.append((here, number, is_open, at, doc, start, len(ids) // 4, ids, n))
                at += len(ids) // 4
            number += 1

        def rows() -> pa.RecordBatch:
            types = {"part": pa.int32(), "window": pa.int32(), "open": pa.bool_(), "offset": pa.int64(), "doc_id": id_type,
                     "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64()}
            made = [pa.array(column, t) for column, t in zip(zip(*out, strict=True), types.values(), strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=[*types])

        for batch in batches:
            held, id_type = 0, batch.column("doc_id").type
            docs_of = zip(batch.column("doc_id").to_pylist(), words.documents(batch.column("text"), end_id), strict=True)
            for doc, ids in docs_of:
                n = len(ids) // 4
                for start in range(0, n, size):
                    for pieces in windows.add((doc, n), start, ids[4 * start:4 * (start + size)]):
                        close(pieces, False)
                held += n
                if out and held > 4_000_000:  # 16 MB of ids
                    yield rows()
                    held = 0
            if out:
                yield rows()
        for pieces in windows.rest():
            close(pieces, True)
        if out:
            yield rows()

    return docs.mapInArrow(
        part, f"part int, window int, open boolean, offset bigint, doc_id {kind}, start bigint, length bigint, ids binary, "
              "doc_tokens bigint")


def _laid_end_to_end(rows: DataFrame, size: int) -> DataFrame:
    """Leftover windows as one stretch, cut every ``size`` ids and, in the last stretch, at powers of two."""
    lengths = rows.groupBy("part", "window").agg(F.sum("length").alias("window_length"))
    # windows of a task, then tasks: the one running total over all rows has a row for each task
    tasks = lengths.groupBy("part").agg(F.sum("window_length").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tasks = tasks.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("task_at"),
                         F.sum("n").over(all_of).alias("total"))
    before = Window.partitionBy("part").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.withColumn("window_at", F.coalesce(F.sum("window_length").over(before), F.lit(0)))
    at = lengths.join(tasks, "part").select("part", "window", (F.col("task_at") + F.col("window_at")).alias("at"), "total")
    rows = rows.join(at, ["part", "window"])
    first, last = F.col("at") + F.col("offset"), F.col("at") + F.col("offset") + F.col("length")
    whole = F.col("total") - F.col("total") % size
    # where sequences begin, as far as they touch this piece: each multiple of size, then the powers
    # of two that make up the rest, largest first
    multiples = F.transform(F.sequence(F.floor(first / size), F.floor((last - 1) / size)), lambda k: k * size)
    powers = [1 << b for b in reversed(range(size.bit_length()))]
    rest = F.col("total") % size
    starts, lengths_of = [], []
    at_rest = whole
    for p in powers:
        has = rest.bitwiseAND(F.lit(p)) > 0
        starts.append(F.when(has, at_rest))
        lengths_of.append(p)
        at_rest = at_rest + F.when(has, F.lit(p)).otherwise(F.lit(0))
    cuts = F.concat(
        F.transform(F.filter(multiples, lambda k: k < whole), lambda k: F.struct(k.alias("begin"), F.lit(size).cast("long").alias("n"))),
        F.filter(F.array(*[F.struct(s.alias("begin"), F.lit(n).cast("long").alias("n")) for s, n in zip(starts, lengths_of, strict=True)]),
                 lambda c: c["begin"].isNotNull() & (c["begin"] < last) & (c["begin"] + c["n"] > first)))
    rows = rows.withColumn("cut", F.explode(cuts)).withColumn("first", first).withColumn("last", last)
    lo, hi = F.greatest("first", F.col("cut.begin")), F.least("last", F.col("cut.begin") + F.col("cut.n"))
    rows = rows.withColumn("lo", lo).withColumn("n", hi - lo)
    skip = F.col("lo") - F.col("first")
    return rows.select(
        "doc_id", (F.col("start") + skip).alias("start"), F.col("n").alias("length"),
        F.substring("ids", (4 * skip + 1).cast("int"), (4 * F.col("n")).cast("int")).alias("ids"), "doc_tokens",
        (-1 - F.col("cut.begin")).alias("sequence_id"), (F.col("lo") - F.col("cut.begin")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, open_windows: int = 32,
         min_cut: int = 16) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (binary, little-endian unsigned 32 bit),
    doc_tokens, sequence_id, offset.

    ``sequence_id`` is unique, not consecutive; leftovers have negative ones. ``tokenizer`` is a
    vocabulary file that the driver reads and sends to the tasks; it must drop white space and
    never join across it. ``end_id`` is put after every document.
    """
    with open(tokenizer, encoding="utf-8") as f:
        rows = _windows(require(docs, ["doc_id", "text"]), f.read(), end_id, window, open_windows, min_cut)
    rows = materialise(rows, "packed")
    closed = rows.where(~F.col("open")).select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.shiftleft(F.col("part").cast("long"), 32) + F.col("window")).alias("sequence_id"), "offset")
    return closed.unionByName(_laid_end_to_end(rows.where("open"), window))


def packed_documents(docs: DataFrame) -> DataFrame:
    """``pack`` with the production parameters, and for each piece the checksum of its ids instead of them."""
    import public_tokenizers

    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed_documents(table(spark, sf_dir, "documents"))
