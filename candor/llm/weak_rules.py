"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule looks at one measure of a text and votes good (1), bad (-1) or abstains (0): a defect votes
bad and its absence says nothing; only what speaks for prose (letters, sentences, word lengths) votes good. How
accurate a rule is, is unknown: how often it votes each way, and abstains, on good and on bad documents.
Expectation-maximisation finds these accuracies and the share of good documents that make the votes of
the whole corpus likeliest: the E step is each vote pattern's posterior, the M step the share of each class's
documents on which a rule votes so. A document is kept if its posterior probability of being good is
``MIN_POSTERIOR`` or more and the hard limits of ``base_failed`` hold, so no rule alone throws a document out.

Votes are all that EM needs, and there are at most 3 ** 9 patterns of them: one group-by with partial
sums over all documents makes the table of pattern counts, over which ``ROUNDS`` rounds of EM run. Measures are whole numbers and
votes compare whole numbers, so nothing depends on the order of rows. All is done with DataFrame
functions: measures within the row, no shuffle of texts, no Python on the executors.

Repeated words: the text's three-word windows are hashed, (hash, place) pairs sorted, and neighbours
with equal hashes mark their places; every marked place covers three words, counted once. A text
without an equal pair of windows skips the sort.

Defined results: null, empty and blank texts have no words: measures 0, no votes, ``base_failed``; repeated
rows are judged one by one and count as often; a null doc_id is kept as it is; an empty table gives no rows. Whole texts are
read. doc_id and text are read by name, so further columns can have any name.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, require, table

MIN_WORDS, MAX_REPEATED = 50, 50  # base rules: words, per cent of words in repeated windows
MIN_POSTERIOR = 0.5
ROUNDS, PRIOR = 20, 0.8  # rounds of EM, and the share of good documents at its start
START = {1: (0.7, 0.3), -1: (0.05, 0.4), 0: (0.25, 0.3)}  # vote: its share on good and on bad documents at the start

SPACE = r"\x20\x09-\x0D"
ENDS = rf"[.!?]+([{SPACE}]|\z)"  # ends of sentences
RUNS = r"[!?#*$%&|<>~=_][!?#*$%&|<>~=_]+"  # marks in a row
BARE = rf"(^|[{SPACE}])[^\p{{L}}\p{{N}}{SPACE}]+([{SPACE}]|\z)"  # words without a letter or digit

# (rule, bad, good) as SQL over the measures that Spark and DuckDB both read; neither: the rule abstains.
RULES = [
    ("symbols", "10 * n_symbols > n_words", "false"),
    ("repeats", "5 * n_repeat_words > n_words", "false"),
    ("lines", "10 * n_dup_lines > 3 * n_lines", "false"),
    ("letters", "100 * n_letters < 85 * word_chars", "100 * n_letters >= 92 * word_chars"),
    ("sentences", "100 * n_ends < n_words OR 3 * n_ends > n_words", "40 * n_ends >= n_words AND 5 * n_ends <= n_words"),
    ("capitals", "3 * n_capitals > word_chars", "false"),
    ("lengths", "2 * word_chars < 7 * n_words OR 2 * word_chars > 15 * n_words", "word_chars >= 4 * n_words AND word_chars <= 7 * n_words"),
    ("runs", "10 * n_runs > n_words", "false"),
    ("bare", "10 * n_bare > n_words", "false"),
]
VOTES = [f"vote_{name}" for name, _, _ in RULES]


def _vote(bad: str, good: str) -> str:
    return f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


def _without(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that ``pattern`` matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeated(sorted_windows: str) -> Column:
    """Words covered by windows that occur twice, from sorted (hash, place) pairs (null: none)."""
    w = F.col(sorted_windows)
    twins = F.filter(F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.when(
        a["hash"] == b["hash"], F.struct(a["place"].alias("a"), b["place"].alias("b")))), lambda x: x.isNotNull())
    return F.sort_array(F.array_distinct(F.concat(twins["a"], twins["b"])))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_letters, n_ends, n_capitals, n_runs and n_bare (all long)."""
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    # steps of their own: arrays that several readers share must be made once
    docs = require(docs, ["doc_id", "text"]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select(
        "doc_id", F.array_remove(F.split(text, f"[{SPACE}]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\f\r", ""))) > 0).alias("lines"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).alias("word_chars"),
        _without(text, r"[#*$%&|<>]+").alias("n_symbols"),
        _without(text, r"\p{L}+").alias("n_letters"),
        _without(text, r"\p{Lu}+").alias("n_capitals"),
        F.regexp_count(text, F.lit(ENDS)).alias("n_ends"), F.regexp_count(text, F.lit(BARE)).alias("n_bare"),
        F.regexp_count(text, F.lit(RUNS)).alias("n_runs"))
    hashes = F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    docs = docs.select("*", hashes.alias("hashes"))
    pairs = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    docs = docs.select("*", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), pairs).alias("windows"))
    docs = docs.select("*", _repeated("windows").alias("places"))
    places = F.col("places")
    covered = F.aggregate(F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(b - a, F.lit(3))),
                          F.lit(0), lambda acc, x: acc + x)
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return docs.select(
        "doc_id", whole(F.size(words)).alias("n_words"), whole(F.col("word_chars")).alias("word_chars"),
        whole(F.col("n_symbols")).alias("n_symbols"), whole(F.size(lines)).alias("n_lines"),
        whole(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        whole(covered).alias("n_repeat_words"), whole(F.col("n_letters")).alias("n_letters"),
        whole(F.col("n_ends")).alias("n_ends"), whole(F.col("n_capitals")).alias("n_capitals"), whole(F.col("n_runs")).alias("n_runs"), whole(F.col("n_bare")).alias("n_bare"))


Model = tuple[float, dict[str, dict[int, tuple[float, float]]]]  # share of good documents; vote column -> vote -> shares


def _log_odds(model: Model) -> tuple[float, list[float]]:
    """Of the prior, and of every rule's votes in turn (1, 0, -1)."""
    prior, shares = model
    return log(prior / (1 - prior)), [log(s[vote][0] / s[vote][1]) for s in shares.values() for vote in (1, 0, -1)]


def _posterior(model: Model) -> Column:
    """Probability of a good document by its votes."""
    prior, logs = _log_odds(model)
    table, odds = F.array(*map(F.lit, logs)), F.lit(prior)
    for r, v in enumerate(VOTES):
        odds = odds + F.get(table, F.lit(3 * r + 1) - F.col(v))
    return 1 / (1 + F.exp(-odds))


def fitted(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """EM over pattern counts (the votes, n): the share of good documents and each rule's votes by class.

    The counts of all documents are at most 3 ** 9 rows, whatever their number, and these the driver holds.
    Shares are smoothed by one document of each kind, so none reaches 0.
    """
    model: Model = (PRIOR, {v: START for v in VOTES})
    rows = sorted(([r[v] for v in VOTES], r["n"]) for r in patterns.select(*VOTES, "n").collect())
    total = sum(n for _, n in rows)
    for _ in range(rounds if total else 0):
        prior, logs = _log_odds(model)
        sums = {v: {vote: [0.0, 0.0] for vote in START} for v in VOTES}
        good = 0.0
        for votes, n in rows:
            p = n / (1 + exp(-prior - sum(logs[3 * r + 1 - vote] for r, vote in enumerate(votes))))
            good += p
            for v, vote in zip(VOTES, votes, strict=True):
                sums[v][vote][0] += p
                sums[v][vote][1] += n - p
        model = ((good + 1) / (total + 2), {v: {
            vote: ((g + 1) / (good + 3), (b + 1) / (total - good + 3)) for vote, (g, b) in s.items()} for v, s in sums.items()})
    return model


def judged(docs: DataFrame, rounds: int = ROUNDS, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Every document with its measures, votes, ``base_failed``, ``posterior`` and ``kept``.

    The measures are set down once: the pattern counts and the verdicts both read them.
    """
    rows = materialise(measured(docs).select("*", *[F.expr(_vote(bad, good)).alias(v) for v, (_, bad, good) in zip(VOTES, RULES, strict=True)]), "measures")
    model = fitted(rows.groupBy(*VOTES).agg(F.count(F.lit(1)).alias("n")), rounds)
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words")
    return rows.select("*", failed.alias("base_failed"), _posterior(model).alias("posterior")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))


RETURNED = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, the base measures, base_failed, kept."""
    return judged(table(spark, sf_dir, "documents")).select(*RETURNED)


def _oracle() -> str:
    odds = " + ".join(["ln(m.prior / (1 - m.prior))", *(
        f"CASE p.{v} WHEN 1 THEN ln(m.g_{v}_0 / m.b_{v}_0) WHEN -1 THEN ln(m.g_{v}_1 / m.b_{v}_1) ELSE ln(m.g_{v}_2 / m.b_{v}_2) END" for v in VOTES)])
    start = [f"{x}::DOUBLE AS {c}_{v}_{k}" for v in VOTES for k, s in enumerate(START.values()) for c, x in zip("gb", s, strict=True)]
    rounds = [f"m0 AS (SELECT {PRIOR}::DOUBLE AS prior, {', '.join(start)})"]
    new = [f"(sum(CASE WHEN {v} = {vote} THEN n * {of} ELSE 0 END) + 1) / (sum(n * {of}) + 3) AS {c}_{v}_{k}"
           for v in VOTES for k, vote in enumerate(START) for c, of in (("g", "good"), ("b", "(1 - good)"))]
    for k in range(ROUNDS):
        rounds.append(f"m{k + 1} AS MATERIALIZED (SELECT (sum(n * good) + 1) / (sum(n) + 2) AS prior, {', '.join(new)} "
                      f"FROM (SELECT p.*, 1 / (1 + exp(-({odds}))) AS good FROM p, m{k} m) z)")
    votes = ", ".join(f"{_vote(bad, good)} AS {v}" for v, (_, bad, good) in zip(VOTES, RULES, strict=True))
    gone = lambda pattern: f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^{SPACE}]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines FROM d),
g AS (SELECT k, unnest(range(1, len(words) - 1)) AS i, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) AS gram
      FROM w WHERE len(words) >= 3),
h AS (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n FROM g),
r AS (SELECT k, count(DISTINCT i) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS i FROM h WHERE n > 1) z GROUP BY k),
b AS (SELECT w.k, doc_id, len(words) AS n_words, length(regexp_replace(t, '[{SPACE}]+', '', 'g')) AS word_chars, {gone('[#*$%&|<>]+')} AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             {gone(r'\p{L}+')} AS n_letters, {gone(r'\p{Lu}+')} AS n_capitals, len(regexp_extract_all(t, '{ENDS}')) AS n_ends,
             len(regexp_extract_all(t, '{RUNS}')) AS n_runs, len(regexp_extract_all(t, '{BARE}')) AS n_bare
      FROM w LEFT JOIN r ON r.k = w.k),
v AS MATERIALIZED (SELECT *, {votes} FROM b),
p AS MATERIALIZED (SELECT {', '.join(VOTES)}, count(*) AS n FROM v GROUP BY ALL),
{', '.join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND posterior >= {MIN_POSTERIOR} AS kept
FROM (SELECT p.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed, 1 / (1 + exp(-({odds}))) AS posterior
      FROM v p, m{ROUNDS} m) z
"""


ORACLE = _oracle()
