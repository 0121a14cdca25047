"""Token counts: the automaton against plain greedy longest match."""

import public_tokenizers
from candor.llm import token_counts as T
from candor.sources.tables import table
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import ODD, SF01


def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        for k in range(min(longest, len(word) - at), 0, -1):
            if word[at:at + k] in pieces:
                n, at = n + 1, at + k
                break
        else:
            n, at = n + len(word[at].encode("utf-8", "surrogatepass")), at + 1
    return n


def brute(text, pieces):
    longest = max(map(len, pieces), default=0)
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    return len(words), sum(greedy(T.START + w, pieces, longest) for w in words)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc▁é", min_size=1, max_size=6), max_size=12), st.lists(st.text("abcdé", min_size=1, max_size=14), max_size=6))
def test_any_vocabulary(pieces, words):
    a = T.Automaton(pieces)
    longest = max(map(len, pieces), default=0)
    for w in words:
        assert a.count(T.START + w) == greedy(T.START + w, pieces, longest)


def test_work_is_linear():
    # greedy goes back over and over here; following failure links must not
    a = T.Automaton(["a", "a" * 50 + "b"])
    reads = 0
    read = a._read

    def counted(node, c):
        nonlocal reads
        reads += 1
        return read(node, c)

    a._read = counted
    assert a.count("a" * 2000) == 2000 and reads == 2000


PIECES = T.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def test_odd_rows(spark, odd, empty):
    got = T.count_tokens(odd, PIECES).collect()
    want = sorted((-1 if i is None else i, *brute(t, set(PIECES))) for i, t, _ in ODD)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_tokens"]) for r in got) == want
    assert T.count_tokens(empty, PIECES).count() == 0


def test_whole_table(spark):
    pieces, seen = set(PIECES), {}
    longest = max(map(len, PIECES))

    def count(w):
        if w not in seen:
            seen[w] = greedy(T.START + w, pieces, longest)
        return seen[w]

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF01, "documents").select("doc_id", "text").collect()}
    got = T.op10_token_counts(spark, SF01).collect()
    assert len(got) == len(texts)
    for r in got:
        words = texts[r["doc_id"]].split()
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(map(count, words)))
