"""Token counts by a linear longest-match automaton.

Greedy longest match over a vocabulary, counted without building the pieces: the vocabulary is a trie, and
each node carries a failure link and the number of tokens that following it gives away. Reading a
character either moves down the trie or follows failure links, so a word costs time in proportion to
its length, however often the plain method would have gone back.

A word (text between white space) is read with the vocabulary's word-start mark before it. A character that
no piece can start with counts as its UTF-8 bytes (byte fallback) and matching goes on behind it.

Defined results: null, empty and blank texts have 0 words and 0 tokens; repeated rows are counted
one by one; an empty table gives no rows. doc_id and text are read by name, so further columns can
have any name. Texts are read whole; no shuffle.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import require, spaced, table, with_row_id

START = "▁"  # the vocabulary's mark of a word's start
CACHE = 500_000  # words whose counts a task keeps; then it starts afresh


class Automaton:
    """Trie of a vocabulary; nodes are numbers, 0 the root.

    ``step[node]`` maps a character to the child; ``fail[node]`` is where matching goes on when no
    child fits, and ``pops[node]`` the tokens counted on the way: for a node that is a piece, the
    root and 1; for others, what reading the same characters greedily would have given.
    """

    def __init__(self, pieces: Iterable[str]):
        self.step: list[dict[str, int]] = [{}]
        ends: list[int] = [0]  # tokens that the node's string is, if it is a piece (else 0)
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.step[node]:
                    self.step[node][c] = len(self.step)
                    self.step.append({})
                    ends.append(0)
                node = self.step[node][c]
            ends[node] = 1
        self.fail, self.pops = [0] * len(self.step), [0] * len(self.step)
        todo = deque()
        for c, node in self.step[0].items():  # byte fallback makes every first character a match
            self.pops[node] = ends[node] or len(c.encode("utf-8", "surrogatepass"))
            todo.append(node)
        while todo:  # by depth: the links of shorter strings are ready
            node = todo.popleft()
            for c, child in self.step[node].items():
                todo.append(child)
                if ends[child]:
                    self.pops[child] = 1
                else:
                    self.fail[child], more = self._read(self.fail[node], c)
                    self.pops[child] = self.pops[node] + more

    def _read(self, node: int, c: str) -> tuple[int, int]:
        """The node after reading ``c`` at ``node`` and the tokens given away meanwhile."""
        given = 0
        while c not in self.step[node]:
            if not node:
                return 0, given + len(c.encode("utf-8", "surrogatepass"))
            given += self.pops[node]
            node = self.fail[node]
        return self.step[node][c], given

    def count(self, word: str) -> int:
        node = total = 0
        for c in word:
            node, given = self._read(node, c)
            total += given
        while node:  # the word has ended: give away what is held
            total += self.pops[node]
            node = self.fail[node]
        return total


class _Counts(dict):
    """Word -> its tokens, counted by the automaton when first met."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(START + word) if word else 0
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = n
        return n


def vocabulary(path: str) -> list[str]:
    """The pieces of a vocabulary file that stand for text (no control, unknown or byte pieces)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]


def count_tokens(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """doc_id, rid, n_words and n_tokens of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(pieces))  # grows with the vocabulary alone

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = _Counts(sent.value)
        for batch in batches:
            words = [[w for w in spaced(t).split(" ") if w] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "rid": batch["rid"], "n_words": [len(w) for w in words],
                                "n_tokens": [sum(map(counts.__getitem__, w)) for w in words]})

    rows = with_row_id(require(docs, ["doc_id", "text"])).select("row.doc_id", "rid", "row.text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(part, f"doc_id {kind}, rid bigint, n_words bigint, n_tokens bigint")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, n_words, n_tokens."""
    import public_tokenizers

    pieces = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(table(spark, sf_dir, "documents"), pieces).drop("rid")
