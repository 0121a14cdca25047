"""Packing: every id once, by the tokenizer itself; windows; padding; odd rows."""

import json
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
from candor.llm import packing as P
from candor.sources.tables import table
from llm_data import ODD, SF01, docs_of
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, pieces, window, most_padding=None):
    """Pieces tile every document and every sequence; their ids are the tokenizer's."""
    want = sorted((i if i is not None else -1, tuple(ids_of(t))) for i, t, *_ in rows)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert 0 < r["length"] <= window
        by_doc[r["doc_id"] if r["doc_id"] is not None else -1, r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= window
        total += at if at & (at - 1) == 0 else window
    n = sum(len(i) for _, i in want)
    assert sum(r["length"] for r in pieces) == n
    if most_padding is not None:
        assert total - n <= most_padding * n
    return by_doc, want


def test_ids_of_words():
    words = P.WordIds(open(PATH, encoding="utf-8").read())
    for text in ["Hello, world. It's 3.14... x", "é ß İ ǅ ﬁ Σας ÀÉ.,", "a b c\x1cd", "<|endoftext|> x<|endoftext|>y.",
                 "don't WON'T 'll", "日本語 テキスト", "é ́x", "$$$ a$$$ ,,, ..", "", "\n\t x " * 3, "y" * 500]:
        assert words.of(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1]), text


def test_words_of_the_documents(spark):
    words = P.WordIds(open(PATH, encoding="utf-8").read())
    for r in table(spark, SF01, "documents").limit(300).collect():
        assert words.of(r["text"]) == struct.pack(f"<{len(ids_of(r['text'])) - 1}I", *ids_of(r["text"])[:-1])


class Counted:
    """Passes on what is asked of ``inner`` and counts it."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        self.calls += 1
        return getattr(self.inner, name)


def test_new_pieces_are_looked_up_many_at_a_time():
    words = P.WordIds(open(PATH, encoding="utf-8").read())
    words.tokenizer, words.model = whole, model = Counted(words.tokenizer), Counted(words.model)
    plain = [f"{a}{b}{c}à" for a in "bcdfghklmn" for b in "aeiou" for c in "prstvwxyz"]
    text = " ".join(w + mark for w in plain for mark in ("", ".", "$$$", "'", "<|"))
    assert words.of(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])
    assert whole.calls + model.calls <= 3
    model.calls = 0
    text = " ".join(w.title() + "$$$" for w in plain)
    assert words.of(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])
    assert model.calls == 0


def test_blocks_change_no_ids(monkeypatch):
    texts = ["one two, three", None, "", " \t\v", "\u212belvin \u212aey \u0130 e\u0301t\u00e9 \u1e9e", "x" * 70 + " " + "y" * 64 + "...", "it's 'so' l'eau <|endoftext|>",
             "100 000 a1b2", "日本 — “q”", "a\x1cb\xa0c\x85d", "ROCK'n'roll, O'Neil's!!", *[f"w{chr(97 + i)}x" * (1 + i % 5) + " the" * i for i in range(26)]]
    want = [struct.pack(f"<{len(ids_of(t))}I", *ids_of(t)) for t in texts]
    vocabulary = open(PATH, encoding="utf-8").read()
    for block, turn, cache in ((P.BLOCK, P.TURN, P.CACHE), (1, 1, 1), (40, 7, 10)):
        for name, value in (("BLOCK", block), ("TURN", turn), ("CACHE", cache)):
            monkeypatch.setattr(P, name, value)
        words = P.WordIds(vocabulary)
        for kind in (pa.string(), pa.large_string()):
            assert [*words.documents(pa.array(texts, kind), 2)] == want
            assert [*words.documents(pa.array(["gone", *texts, "too"], kind).slice(1, len(texts)), 2)] == want
            assert [*words.documents(pa.array([], kind), 2)] == []


def test_model_without_mark_of_a_words_end():
    changed = json.load(open(PATH, encoding="utf-8"))
    changed["model"]["end_of_word_suffix"] = None
    changed = json.dumps(changed)
    text = "Hello, world... straße ÉTÉ $$$ a"
    ids = Tokenizer.from_str(changed).encode(text, add_special_tokens=False).ids
    assert P.WordIds(changed).of(text) == struct.pack(f"<{len(ids)}I", *ids) and ids != ids_of(text)[:-1]


def test_odd_rows(spark, odd, empty):
    for window, keep in ((4096, 32), (64, 3), (7, 2), (4, 1)):
        pieces = P.pack(odd, PATH, 2, window=window, open_windows=keep, min_cut=1).collect()
        by_doc, want = check(ODD, pieces, window)
        for doc, ids in want:
            own = sorted(by_doc[doc, len(ids)], key=lambda r: r["start"])
            copies = [r for r in own if r["start"] == 0]
            assert len(copies) == sum(w == (doc, ids) or (w[0] == doc and len(w[1]) == len(ids)) for w in want)
            if len(copies) == 1:
                assert b"".join(bytes(r["ids"]) for r in own) == struct.pack(f"<{len(ids)}I", *ids)
                at = 0
                for r in own:
                    assert r["start"] == at
                    at += r["length"]
    assert P.pack(empty, PATH, 2).count() == 0


def test_whole_table(spark):
    docs = table(spark, SF01, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    pieces = P.packed_documents(docs.repartition(8)).collect()
    by_doc, want = check(rows, pieces, 4096, most_padding=0.005)
    for doc, ids in want:
        own = sorted(by_doc[doc, len(ids)], key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_leftovers_need_no_padding(spark):
    # all windows stay open: everything is laid end to end and the last stretch cut at powers of two
    rows = [(i, "a " * (i % 40), "x") for i in range(100)]
    pieces = P.pack(docs_of(spark, rows), PATH, 2, window=64, open_windows=1000).collect()
    check(rows, pieces, 64, most_padding=0)


def test_open_windows_are_bounded():
    w, closed = P._Windows(100, keep=4, min_cut=8), 0
    for k in range(500):
        n = 1 + (k * 37) % 60
        for pieces in w.add("d", 0, b"\0" * 4 * n):
            closed += 1
            assert sum(len(ids) // 4 for *_, ids in pieces) >= 100 - 7
        assert len(w.room) <= 4
    assert closed > 100
