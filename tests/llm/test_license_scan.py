"""Licence scans: plain Dice over all templates, pruning, odd rows, no Python in the plan."""

import re

from candor.llm import license_scan as L
from llm_data import LONG, docs_of


def brute(text, threshold=0.8):
    found, seen = [], set()
    for lines in ((text or "").replace("\r", "\n").split("\n"), re.sub(r"([.!?])[ \t]+", r"\1\n", text or "").replace("\r", "\n").split("\n")):
        seen |= {L.normal(x) for x in lines}
    for p in seen:
        own = set(L.bigrams(p))
        for name, t in L.TEMPLATES:
            other = set(L.bigrams(t))
            if own and 2.0 * len(own & other) / (len(own) + len(other)) >= threshold:
                found.append((-2.0 * len(own & other) / (len(own) + len(other)), name))
    best = min(found, default=(None, None))
    return (best[1], -best[0] if found else None, sorted({n for _, n in found}), len(found))


def test_against_plain_comparison(spark, odd, empty):
    mit = dict(L.TEMPLATES)["MIT"]
    texts = [None, "", " ", "MIT", LONG, "Prose. Licensed under CC BY-NC 4.0. More prose.", "x\nReleased under the MIT  License!\ny",
             "licensed under the apache license, version 2.0", "Licensed under the Apache License, Version 2",
             "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.",
             mit, mit.replace("Software", "Program"), mit + " " + mit, "Licensed under CC BY 4.0.", "Licensed to kill. The software.",
             "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy"]
    texts += [t.upper() for _, t in L.TEMPLATES] + [" ".join(t.split()[2:]) for _, t in L.TEMPLATES]
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["license_id"], r["dice"], r["licenses"], r["n_matches"]) for r in L.scan(docs_of(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t, _ in rows}
    assert got[5][0] == "CC-BY-NC-4.0" and got[5][1] == 1.0
    assert L.scan(odd).count() == odd.count() and L.scan(empty).count() == 0


def test_other_threshold(spark):
    rows = [(i, " ".join(t.split()[k:]), "a") for i, (_, t) in enumerate(L.TEMPLATES) for k in (0, 3)]
    got = [(r["license_id"], r["n_matches"]) for r in L.scan(docs_of(spark, rows), threshold=0.6).orderBy("doc_id").collect()]
    want = [(brute(t, 0.6)[0], brute(t, 0.6)[3]) for _, t, _ in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_every_template_is_within_reach_of_the_key_words():
    for grams in L.GRAMS:
        need = len(grams) - L.least_common(len(grams), 0.8) + 1
        assert sum(bool(set(g.split()) & set(L.KEYS)) for g in grams) >= need


def test_only_texts_that_reach_a_template_are_cut_into_passages(spark):
    prose = "The program was published by the public library, under conditions that nobody noticed. License or not, it is free.\n"
    texts = [None, "", prose, prose * 40, prose + L.TEMPLATES[0][1], "released under the\nMIT license", "released under the rose"]
    got = {r["doc_id"]: r for r in L.reaching(docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert any(k in prose.lower() for k in L.KEYS)
    assert [got[i]["low"] is not None for i in range(len(texts))] == [False, False, False, False, True, True, False]
    for i, t in enumerate(texts):  # exactly those that have enough bigrams of some template
        own = set(L.bigrams(t or ""))
        want = [name for (name, _), g in zip(L.TEMPLATES, L.GRAMS) if len(own & set(g)) >= L.least_common(len(g), 0.8)]
        assert [r["license"] for r in got[i]["reach"] or []] == want


def test_no_python_and_no_shuffle(spark, odd):
    plan = L.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def any_window(text, threshold=0.8):
    """The largest dice of each licence over all windows of the text's words, without any segmentation."""
    words, best = L.normal(text).split(), {}
    grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
    for name, t in L.TEMPLATES:
        own = set(L.bigrams(t))
        for i in range(len(grams)):
            for n in range(1, min(len(grams) - i, int(1.5 * len(own) + 1e-9)) + 1):
                part = set(grams[i:i + n])
                dice = 2.0 * len(own & part) / (len(own) + len(part))
                if dice >= threshold:
                    best[name] = max(best.get(name, 0), dice)
    return best


def test_wrapped_and_inline_notices(spark):
    import textwrap

    by = [(name, t) for name, t in L.TEMPLATES if len(t) > 120]
    assert {"MIT", "Apache-2.0", "GPL-3.0", "BSD-3-Clause"} <= {name for name, _ in by}
    texts = [f"Some words before\n{textwrap.fill(t, 72)}\nand words after." for _, t in by]
    texts += ["# " + textwrap.fill(by[0][1], 70).replace("\n", "\r\n# "),
              "the data that we publish here is licensed under CC BY-NC 4.0 since the last of the years",
              "we say that this text is released under the MIT License but, as to the pictures, licensed under CC BY 4.0 they are",
              "licensed\nunder\nthe\nMIT\nlicense", "licensed under the\n\nold MIT and other license", "under the licence of the software"]
    got = {r["doc_id"]: r for r in L.scan(docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert got[i]["licenses"] == sorted(any_window(t)), t
        whole = brute(t)[3] == 0
        if whole and got[i]["licenses"]:  # nothing found by lines and sentences
            best = min((-d, name) for name, d in any_window(t).items())
            assert (got[i]["license_id"], got[i]["dice"]) == (best[1], -best[0]) and got[i]["n_matches"] >= 1
    assert all(name in got[i]["licenses"] for i, (name, _) in enumerate(by))
    assert got[len(by) + 1]["license_id"] == "CC-BY-NC-4.0" and got[len(by) + 2]["licenses"] == ["CC-BY-4.0", "MIT"]
    assert got[len(texts) - 1]["n_matches"] == 0


def test_windows_beside_near_passages(spark):
    texts = ["This work is licensed under the GNU General Public License,\nversion 3.",  # its first line alone is as near to GPL-2.0
             "Released under the MIT License.\nand, unlike it, the pictures are licensed under\nCC BY 4.0 only, if at all",
             "This work is licensed under the GNU Affero General Public License, version 3."]
    got = {r["doc_id"]: r for r in L.scan(docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert (got[0]["license_id"], got[0]["dice"]) == ("GPL-3.0", 1.0)
    assert got[1]["licenses"] == ["CC-BY-4.0", "MIT"] and got[1]["n_matches"] == brute(texts[1])[3] + 1
    assert got[2]["n_matches"] == brute(texts[2])[3]  # parts of a near line aren't notices of their own
