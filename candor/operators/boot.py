"""Cold start: a rule-driven guaranteed-exposure ladder for new posts.

A post's ``step_boot`` encodes its ladder state: ``10k`` = waiting at step k, ``10k+5`` =
in flight at step k (it has a serving budget). Each round:

* candidates (recent, published, not suppressed) waiting at step k are checked against the
  step-k rule of their type; a pass (or a mover rescue) computes the exposure still needed
  to reach the step's threshold. If the post already exceeded later thresholds it skips
  ahead (``jump_to``) instead; otherwise it goes in flight with that budget.
* in-flight posts whose threshold is reached, whose budget ran out, or that are no longer
  candidates finish (+5, time stamped).

Everything is computed from one snapshot of (pool docs, counters, serving state, step
overrides) as pid-keyed joins; ``boot_transition`` returns the next serving state and the
document updates, composed in the order the upstream job applies them.
"""

from __future__ import annotations

from collections.abc import Mapping

import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.pyfmt import fixed4

Rules = Mapping[str, list[dict]]


# ----------------------------------------------------------------- rules (config)
def load_rules(text: str = C.STEP_RULES_YAML) -> dict[str, list[dict]]:
    """Ladder YAML -> {type: [{step, expose_to, rule}, ...]} in step order.

    Each type needs steps 0..n-1 with strictly increasing thresholds (the skip-ahead level
    counts the leading thresholds reached).
    """
    conf = yaml.safe_load(text)
    rules = {t: sorted(({"step": int(s["step"]), "expose_to": int(s["expose_to"]), "rule": s.get("rule") or ""}
                        for s in steps), key=lambda s: s["step"]) for t, steps in conf.items()}
    for t, steps in rules.items():
        if [s["step"] for s in steps] != list(range(len(steps))):
            raise ValueError(f"ladder {t!r}: steps must be 0..{len(steps) - 1}")
        thr = [s["expose_to"] for s in steps]
        if any(b <= a for a, b in zip(thr, thr[1:])):
            raise ValueError(f"ladder {t!r}: thresholds must increase, got {thr}")
    for t in ("video", "img"):
        if t not in rules:
            raise ValueError(f"ladder for {t!r} missing")
    return rules


def _kind(ptype: Column) -> Column:
    return F.when(ptype == C.VIDEO_PTYPE, F.lit("video")).otherwise(F.lit("img"))


def _thresholds(rules: Rules, ptype: Column) -> Column:
    v = F.array(*[F.lit(s["expose_to"]).cast("bigint") for s in rules["video"]])
    i = F.array(*[F.lit(s["expose_to"]).cast("bigint") for s in rules["img"]])
    return F.when(ptype == C.VIDEO_PTYPE, v).otherwise(i)


# ----------------------------------------------------------------- candidates
def step_documents(docs: DataFrame) -> DataFrame:
    """The fields of pool documents that a round reads: what to set down where rounds read them several times."""
    flat = ("pid", "ptype", "status", "ct", "rec_t", "tid", "gid", "vdur", "source", "step_boot", "step_boot_t", "mid",
            "mover_support", "resource_status", "subarea_status", "subarea_types")
    inner = lambda s, *fields: F.struct(*[F.col(f"{s}.{f}").alias(f) for f in fields]).alias(s)
    return docs.select(*flat, inner("author", "mover_level", "mover_part_id"), inner("score_values", "rec"))


def boot_candidates(
    docs: DataFrame,
    step_override: DataFrame,
    taxonomy: DataFrame,
    *,
    as_of: int,
    days: int = 3,
    override_min_gap: int = C.BOOT_OVERRIDE_MIN_GAP,
    sibling_max_rec: int = C.BOOT_SIBLING_MAX_REC,
    sibling_min_step: int = C.BOOT_SIBLING_MIN_STEP,
    excluded_mover_parts: tuple[int, ...] = C.MOVER_EXCLUDED_PARTS,
) -> DataFrame:
    """Recent published posts that may be cold-started this round.

    Window: ``ct`` and ``rec_t`` after ``as_of - days``, ``status >= 2``. Posts whose first
    recommendation came over an hour after creation take step state from the override
    table. Drops: resource partition 80; resource_status -20; subarea posts at a step
    boundary; no gid; and posts at step >= 1 whose gid has *another* post (anywhere in the
    pool) with rec >= 10000. The sibling maximum comes from the two most exposed posts of each gid,
    limited before the shuffle, never a self join: a huge gid costs two rows a task.
    """
    since = as_of - days * C.DAY
    rec = F.coalesce(F.col("score_values.rec"), F.lit(0)).cast("bigint")
    d = docs.filter((F.col("ct") > since) & (F.col("rec_t") > since) & (F.col("status") >= 2)).select(
        "pid", "ptype", "ct", "rec_t", "tid", F.coalesce(F.col("gid"), F.lit(0)).alias("gid"), "vdur",
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.coalesce(F.col("step_boot"), F.lit(0)).alias("d_step"), F.coalesce(F.col("step_boot_t"), F.lit(0)).alias("d_t"),
        F.coalesce(F.col("mid"), F.lit(0)).alias("mid"), F.coalesce(F.col("mover_support"), F.lit(0)).alias("d_ms"),
        F.coalesce(F.col("author.mover_level"), F.lit(0)).alias("mover_level"),
        F.coalesce(F.col("author.mover_part_id"), F.lit(0)).alias("mover_part_id"),
        F.coalesce(F.col("resource_status"), F.lit(0)).alias("resource_status"),
        F.coalesce(F.col("subarea_status"), F.lit(0)).alias("subarea_status"),
        F.coalesce(F.size(F.col("subarea_types")), F.lit(0)).alias("n_subarea"),
        rec.alias("rec"),
    )
    tax = taxonomy.select("tid", "part1_id", "part2_id")
    d = d.join(tax, "tid", "left")
    ov = step_override.select(
        "pid", F.col("step_boot").alias("o_step"), F.col("step_boot_t").alias("o_t"),
        F.col("mover_support").alias("o_ms"), F.lit(True).alias("o_hit"),
    )
    d = d.join(ov, "pid", "left")
    use = ((F.col("rec_t") - F.col("ct")) > override_min_gap) & F.col("o_hit").isNotNull()
    d = d.select(
        "*",
        F.when(use, F.coalesce(F.col("o_step"), F.lit(0))).otherwise(F.col("d_step")).cast("bigint").alias("step_boot"),
        F.when(use, F.coalesce(F.col("o_t"), F.lit(0))).otherwise(F.col("d_t")).cast("bigint").alias("step_boot_t"),
        F.when(use, F.coalesce(F.col("o_ms"), F.lit(0))).otherwise(F.col("d_ms")).cast("bigint").alias("mover_support"),
        F.coalesce(F.col("part1_id"), F.lit(0)).cast("bigint").alias("p1"),
        F.coalesce(F.col("part2_id"), F.lit(0)).cast("bigint").alias("p2"),
    )
    d = d.filter(
        (F.col("p2") != C.RESOURCE_PART2)
        & (F.col("resource_status") != -20)
        & ~((F.col("subarea_status") > 0) & (F.col("n_subarea") > 0) & (F.col("step_boot") % 10 == 0))
        & (F.col("gid") != 0)
    )
    # The two most exposed posts per gid over the whole pool: the largest "other" rec of any post.
    all_g = docs.select(F.col("gid"), F.col("pid"), rec.alias("rec")).filter(F.col("gid") != 0)
    most = Window.partitionBy("gid").orderBy(F.col("rec").desc(), F.col("pid").desc())
    two = all_g.withColumn("rn", F.row_number().over(most)).filter("rn <= 2")
    sib = two.groupBy("gid").agg(
        F.max(F.when(F.col("rn") == 1, F.col("pid"))).alias("t1_pid"), F.max(F.when(F.col("rn") == 1, F.col("rec"))).alias("t1_rec"),
        F.max(F.when(F.col("rn") == 2, F.col("rec"))).alias("t2"))
    d = d.join(sib, "gid", "left")
    other_max = F.when(F.col("pid") == F.col("t1_pid"), F.col("t2")).otherwise(F.col("t1_rec"))
    d = d.filter(~(F.coalesce(other_max >= sibling_max_rec, F.lit(False)) & (F.col("step_boot") >= sibling_min_step)))
    is_mover = (F.col("mover_level") > 0) & ~F.col("mover_part_id").isin(*excluded_mover_parts)
    return d.select(
        "pid", "ptype", "ct", "rec_t", "tid", "gid", "vdur", "source", "step_boot", "step_boot_t", "rec", "mid",
        is_mover.cast("bigint").alias("is_mover"), "mover_support",
        F.col("p1").alias("part1_id"), F.col("p2").alias("part2_id"),
    )


# ----------------------------------------------------------------- rule inputs
def boot_features(candidates: DataFrame, counters: DataFrame, *, as_of: int) -> DataFrame:
    """Candidates + live counters -> the rule inputs (missing counters read as 0)."""
    fields = ("rec", "sume", "gsume", "download", "like", "share", "review", "detail", "play_video", "play_dur")
    c = counters.select("pid", *[F.col(f).alias(f"c_{f}") for f in fields])
    j = candidates.withColumnRenamed("rec", "pool_rec").join(c, "pid", "left")
    z = {f: F.coalesce(F.col(f"c_{f}"), F.lit(0)).cast("bigint") for f in fields}
    rec = z["rec"]
    video = F.col("ptype") == C.VIDEO_PTYPE
    pv = z["play_video"]
    play_dur = z["play_dur"] / 1000.0
    avg = F.when(video & (pv > 0), play_dur / pv).otherwise(F.lit(0.0))
    vdur = F.coalesce(F.col("vdur"), F.lit(0))
    rate = F.when(video & (pv > 0) & (vdur > 0), avg / vdur).otherwise(F.lit(0.0))
    vps = (
        F.when(video & (avg >= C.VIDEO_PLAY_MIN_AVG) & (rate >= C.VIDEO_PLAY_MIN_RATE), F.lit(1))
        .when(video & (avg < C.VIDEO_PLAY_MIN_AVG) & (rate < C.VIDEO_PLAY_MIN_RATE), F.lit(-1))
        .otherwise(F.lit(0))
    ).cast("bigint")
    per_rec = lambda x: F.when(rec != 0, x / rec).otherwise(F.lit(0.0))
    return j.select(
        "pid", "ptype", "pool_rec",
        rec.alias("rec"), vdur.cast("bigint").alias("vdur"), z["sume"].alias("sume"), z["gsume"].alias("gsume"),
        z["download"].alias("download"), z["like"].alias("like"), z["share"].alias("share"),
        z["review"].alias("review"), z["detail"].alias("detail"),
        per_rec(z["sume"]).alias("ctr"), rate.alias("play_rate"), avg.alias("avg_play_dur"),
        vps.alias("video_play_score"), per_rec(z["download"]).alias("download_rate"),
        per_rec(z["like"]).alias("like_rate"),
        F.lit(as_of).cast("bigint").alias("t"), "ct", "step_boot_t", "step_boot", "mid", "is_mover",
        "mover_support", "part1_id", "part2_id",
    )


# ----------------------------------------------------------------- rules
def safe_division(rule: str) -> str:
    """Rule text with every divisor ``x`` as ``nullif(x, 0)``: a division by zero is null, which matches nothing."""
    out, at = [], 0
    while (slash := rule.find("/", at)) >= 0:
        begin = slash + 1
        while begin < len(rule) and rule[begin].isspace():
            begin += 1
        end = begin
        while end < len(rule) and (rule[end].isalnum() or rule[end] in "_."):
            end += 1
        if end < len(rule) and rule[end] == "(":  # a parenthesis, or a function's arguments
            depth = 0
            while end < len(rule):
                depth += {"(": 1, ")": -1}.get(rule[end], 0)
                end += 1
                if not depth:
                    break
        if end == begin:
            raise ValueError(f"rule {rule!r}: nothing to divide by")
        out += [rule[at:slash], "/ nullif(", safe_division(rule[begin:end]), ", 0)"]
        at = end
    return "".join(out) + rule[at:]


def rule_column(rules: Rules, kind: Column, step: Column) -> Column:
    """CASE over (type, step) of the step's rule text as a Spark SQL predicate.

    An empty rule passes; a step past the end of the ladder fails; a NULL result fails. Divisions
    by zero are NULL, whether or not the rule guards them.
    """
    out = None
    for t, steps in rules.items():
        for s in steps:
            cond = (kind == t) & (step == s["step"])
            val = F.expr(safe_division(s["rule"])) if s["rule"].strip() else F.lit(True)
            out = F.when(cond, val) if out is None else out.when(cond, val)
    out = F.lit(False) if out is None else out.otherwise(F.lit(False))
    return F.coalesce(out, F.lit(False))


def boot_rule_match(
    features: DataFrame,
    rules: Rules,
    *,
    rescue_step1: tuple[int, int] = C.MOVER_RESCUE_STEP1,
    rescue_step2_after: int = C.MOVER_RESCUE_STEP2_AFTER,
) -> DataFrame:
    """Posts waiting at a step boundary -> + step, matched, rescued.

    Rescue (only when the rule fails, for movers): step 1 with 7800 < t-step_boot_t <= 8100,
    or step 2 with t-step_boot_t > 43200 and no mover support yet.
    """
    w = features.filter(F.col("step_boot") % 10 == 0).withColumn("step", F.expr("step_boot div 10"))
    matched = rule_column(rules, _kind(F.col("ptype")), F.col("step"))
    age = F.col("t") - F.col("step_boot_t")
    rescue = (F.col("is_mover") == 1) & (
        ((F.col("step") == 1) & (age > rescue_step1[0]) & (age <= rescue_step1[1]))
        | ((F.col("step") == 2) & (age > rescue_step2_after) & (F.col("mover_support") == 0))
    )
    w = w.withColumn("matched", matched)
    return w.withColumn("rescued", ~F.col("matched") & F.coalesce(rescue, F.lit(False)))


def _leading_level(thr: Column, rec: Column) -> Column:
    """Number of leading ladder thresholds reached by ``rec``."""
    init = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("go"))
    acc = F.aggregate(
        thr, init,
        lambda a, x: F.when(a["go"] & (rec >= x), F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("go")))
        .otherwise(F.struct(a["n"].alias("n"), F.lit(False).alias("go"))),
    )
    return acc["n"]


def boot_left_expose(matched: DataFrame, rules: Rules) -> DataFrame:
    """Matched or rescued posts -> + level, left_expose, jump_to.

    ``level`` counts the leading thresholds reached by max(live rec, pool rec). At or above
    the reached level the post needs ``exp[step] - max(rec, exp[step-1])`` more exposure
    (``exp[0] - rec`` at step 0); below it, it skips ahead to ``level*10`` with nothing left.
    """
    m = matched.filter(F.col("matched") | F.col("rescued"))
    thr = _thresholds(rules, F.col("ptype"))
    cur = F.greatest(F.col("rec"), F.coalesce(F.col("pool_rec"), F.lit(0)))
    level = _leading_level(thr, cur)
    step = F.col("step")
    at = lambda i: F.try_element_at(thr, (i + 1).cast("int"))
    left = F.when(step > 0, at(step) - F.greatest(cur, at(step - 1))).otherwise(at(step) - cur)
    m = m.withColumn("level", level)
    return m.select(
        "*",
        F.when(step >= F.col("level"), left).otherwise(F.lit(0)).cast("bigint").alias("left_expose"),
        F.when(step < F.col("level"), F.col("level") * 10).cast("bigint").alias("jump_to"),
    )


# ----------------------------------------------------------------- gender weight
def boot_gender_weight(counters: DataFrame, ptypes: DataFrame) -> DataFrame:
    """(pid, 'w1:w2') serving weights for the two gender groups.

    Base score per group: (download+like)/rec. Video posts, or any post with plays in a
    group, use play_dur/play_video when both groups played; other image posts use sume/rec
    when both groups were exposed. Both non-zero: the two ratios at 4 decimals; only group
    1: 1.2:1.0; only group 2: 1.5 for group 2 and 0.8 for group 1 if it had >= 20
    exposures (else 1.0); neither: 1.0:1.0. Missing counters read as 0.
    """
    j = ptypes.select("pid", "ptype").join(counters, "pid", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    s = {}
    for g in (1, 2):
        rec, pv = z(f"s{g}_rec"), z(f"s{g}_play_video")
        s[g] = dict(rec=rec, pv=pv, base=F.when(rec != 0, (z(f"s{g}_download") + z(f"s{g}_like")) / rec).otherwise(F.lit(0.0)),
                    play=z(f"s{g}_play_dur") / F.when(pv != 0, pv), sume=z(f"s{g}_sume") / F.when(rec != 0, rec))
    ptype = F.coalesce(F.col("ptype"), F.lit(0))
    play_branch = (ptype == C.VIDEO_PTYPE) | (s[1]["pv"] > 0) | (s[2]["pv"] > 0)
    use_play = play_branch & (s[1]["pv"] > 0) & (s[2]["pv"] > 0)
    use_sume = ~play_branch & (ptype > 0) & (ptype < 5) & (s[1]["rec"] > 0) & (s[2]["rec"] > 0)
    sc = {g: F.when(use_play, s[g]["play"]).when(use_sume, s[g]["sume"]).otherwise(s[g]["base"]) for g in (1, 2)}
    j = j.select("pid", sc[1].alias("__s1"), sc[2].alias("__s2"), s[1]["rec"].alias("__r1"))
    s1, s2 = F.col("__s1"), F.col("__s2")
    w = (
        F.when((s1 != 0) & (s2 != 0), F.concat(fixed4(F.try_divide(s1, s2)), F.lit(":"), fixed4(F.try_divide(s2, s1))))
        .when((s1 > 0) & (s2 == 0), F.lit(f"{C.WEIGHT_ONLY_S1[0]}:{C.WEIGHT_ONLY_S1[1]}"))
        .when((s1 == 0) & (s2 > 0), F.when(F.col("__r1") >= C.WEIGHT_S1_MIN_REC, F.lit(f"{C.WEIGHT_S1_DAMPED}:{C.WEIGHT_ONLY_S2[0]}"))
              .otherwise(F.lit(f"1.0:{C.WEIGHT_ONLY_S2[0]}")))
        .otherwise(F.lit("1.0:1.0"))
    )
    return j.select("pid", w.alias("weight"))


# ----------------------------------------------------------------- one round
def boot_transition(
    candidates: DataFrame,
    counters: DataFrame,
    serving: DataFrame,
    docs: DataFrame,
    step_override: DataFrame,
    rules: Rules,
    *,
    as_of: int,
) -> DataFrame:
    """One cold-start round -> rows of three outputs, told apart by ``output``:

    * ``serving``  next serving state (pid, remaining, weight);
    * ``pool``     resulting pool-document step fields for every post that changed;
    * ``override`` resulting step-override document (upserted) for the same posts.

    Update order follows the upstream job: skip-ahead first; the in-flight check reads the
    post-skip state; finishing adds 5 and stamps ``as_of``; starting adds 5 last (movers
    rescued at step k also record ``mover_support = k``). A post past the end of its ladder
    while in flight counts as finished. Refreshed weights of in-flight candidates are
    always written.
    """
    feats = boot_features(candidates, counters, as_of=as_of)
    ev = boot_left_expose(boot_rule_match(feats, rules), rules).select(
        "pid", F.col("step").alias("e_step"), "rescued", "left_expose", "jump_to",
    )
    weights = boot_gender_weight(counters, candidates.select("pid", "ptype"))
    cand = candidates.select("pid", F.lit(True).alias("is_cand")).join(weights, "pid", "left")
    srv = serving.select("pid", F.col("remaining").alias("s_rem"),
                         (F.col("weight") if "weight" in serving.columns else F.lit(None).cast("string")).alias("s_w"),
                         F.lit(True).alias("in_s"))
    keys = srv.select("pid").unionByName(ev.select("pid")).distinct()
    p = docs.select(
        "pid", F.coalesce(F.col("step_boot"), F.lit(0)).alias("p_step"), F.col("step_boot_t").alias("p_t"),
        F.col("mover_support").alias("p_ms"), F.coalesce(F.col("ptype"), F.lit(2)).alias("p_ptype"),
        F.coalesce(F.col("score_values.rec"), F.lit(0)).alias("p_rec"), F.lit(True).alias("p_has"),
    )
    o = step_override.select(
        "pid", F.col("step_boot").alias("o_step"), F.col("step_boot_t").alias("o_t"),
        F.col("mover_support").alias("o_ms"), F.col("real_step").alias("o_real"), F.lit(True).alias("o_has"),
    )
    c = counters.select("pid", F.col("rec").alias("c_rec"))
    x = (keys.join(srv, "pid", "left").join(ev, "pid", "left").join(cand, "pid", "left")
         .join(p, "pid", "left").join(o, "pid", "left").join(c, "pid", "left"))
    b = lambda col: F.coalesce(F.col(col), F.lit(False))
    jumped = F.col("jump_to").isNotNull()
    x = x.select(
        "*",
        jumped.alias("jumped"),
        F.when(jumped, F.col("jump_to")).otherwise(F.col("p_step")).alias("s1"),
        F.when(jumped, F.lit(as_of)).otherwise(F.col("p_t")).alias("t1"),
        F.when(jumped, F.col("jump_to")).otherwise(F.col("o_step")).alias("o1"),
        F.when(jumped, F.lit(as_of)).otherwise(F.col("o_t")).alias("ot1"),
        F.when(jumped, F.col("e_step") * 10).otherwise(F.col("o_real")).alias("oreal1"),
        (b("o_has") | jumped).alias("ohas1"),
    )
    # In-flight check on the post-skip pool state.
    thr = _thresholds(rules, F.col("p_ptype"))
    step1 = F.expr("s1 div 10")
    past_end = step1 >= F.size(thr)
    left1 = F.try_element_at(thr, (step1 + 1).cast("int")) - F.greatest(F.coalesce(F.col("c_rec"), F.lit(0)), F.col("p_rec"))
    unfinish1 = b("in_s") & (F.col("s_rem") > 0)
    reached = b("p_has") & (past_end | (F.when(~past_end, left1) <= 0))
    finish = (b("in_s") & (F.col("s_rem") <= 0)) | (unfinish1 & F.coalesce(reached, F.lit(False))) | (unfinish1 & ~b("is_cand"))
    x = x.select("*", finish.alias("finish"), (unfinish1 & b("p_has") & ~F.coalesce(reached, F.lit(False)) & b("is_cand")).alias("refresh"))
    fin_eff = F.col("finish") & b("p_has") & (F.col("s1") % 10 == 5)
    start = F.coalesce(F.col("left_expose") > 0, F.lit(False))
    x = x.select(
        "*", fin_eff.alias("fin_eff"), start.alias("start"),
        F.when(fin_eff, F.col("s1") + 5).otherwise(F.col("s1")).alias("s2"),
        F.when(fin_eff, F.lit(as_of)).otherwise(F.col("t1")).alias("t2"),
        F.when(fin_eff, F.coalesce(F.col("o1"), F.lit(0)) + 5).otherwise(F.col("o1")).alias("o2"),
        F.when(fin_eff, F.lit(as_of)).otherwise(F.col("ot1")).alias("ot2"),
        (F.col("ohas1") | fin_eff).alias("ohas2"),
    )
    resc = b("rescued")
    x = x.select(
        "*",
        F.when(F.col("start"), F.col("s2") + 5).otherwise(F.col("s2")).alias("s3"),
        F.when(F.col("start") & resc, F.col("e_step")).otherwise(F.col("p_ms")).alias("ms3"),
        F.when(F.col("start"), F.coalesce(F.col("o2"), F.lit(0)) + 5).otherwise(F.col("o2")).alias("o3"),
        F.when(F.col("start") & resc, F.col("e_step")).otherwise(F.col("o_ms")).alias("oms3"),
        (F.col("jumped") | F.col("fin_eff") | F.col("start")).alias("changed"),
        F.concat_ws("+", F.when(F.col("jumped"), F.lit("jump")), F.when(F.col("fin_eff"), F.lit("finish")),
                    F.when(F.col("start"), F.lit("start"))).alias("reason"),
    )
    nul = lambda t: F.lit(None).cast(t)
    keep = F.col("start") | (b("in_s") & ~F.col("finish"))

    def row(output: str, remaining: Column, weight: Column, step: Column, t: Column, ms: Column, real: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(output).alias("output"), "pid", remaining.cast("bigint").alias("remaining"), weight.alias("weight"),
            step.cast("bigint").alias("step_boot"), t.cast("bigint").alias("step_boot_t"),
            ms.cast("bigint").alias("mover_support"), real.cast("bigint").alias("real_step"), reason.alias("reason"))

    n, none = nul("bigint"), nul("string")
    serving_row = row("serving", F.when(F.col("start"), F.col("left_expose")).otherwise(F.col("s_rem")),
                      F.when(F.col("start") | F.col("refresh"), F.col("weight")).otherwise(F.col("s_w")), n, n, n, n, F.lit(""))
    pool_row = row("pool", n, none, F.col("s3"), F.col("t2"), F.col("ms3"), n, F.col("reason"))
    override_row = row("override", n, none, F.col("o3"), F.col("ot2"), F.col("oms3"), F.col("oreal1"), F.col("reason"))
    outputs = F.array(F.when(keep, serving_row), F.when(F.col("changed"), pool_row), F.when(F.col("changed"), override_row))
    return x.select(F.explode(outputs).alias("o")).filter(F.col("o").isNotNull()).select("o.*")


def next_documents(docs: DataFrame, transition: DataFrame) -> DataFrame:
    """Pool documents after a round: the changed posts' step fields set, all else as it was."""
    u = transition.filter("output = 'pool'").select(
        F.col("pid").alias("u_pid"), F.col("step_boot").alias("u_step"), F.col("step_boot_t").alias("u_t"),
        F.col("mover_support").alias("u_ms"))
    j = docs.join(u, F.col("pid") == F.col("u_pid"), "left")
    new = {"step_boot": "u_step", "step_boot_t": "u_t", "mover_support": "u_ms"}
    hit = F.col("u_pid").isNotNull()
    return j.select(*[F.when(hit, F.col(new[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in docs.columns])


def next_overrides(step_override: DataFrame, transition: DataFrame) -> DataFrame:
    """Step overrides after a round: changed posts' rows replaced or added."""
    cols = ["step_boot", "step_boot_t", "mover_support", "real_step"]
    u = transition.filter("output = 'override'").select(F.col("pid").alias("u_pid"), *[F.col(c).alias(f"u_{c}") for c in cols])
    j = step_override.select("pid", *cols).join(u, F.col("pid") == F.col("u_pid"), "full_outer")
    hit = F.col("u_pid").isNotNull()
    return j.select(F.coalesce("pid", "u_pid").alias("pid"), *[F.when(hit, F.col(f"u_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def next_serving(transition: DataFrame) -> DataFrame:
    """The next serving state (pid, remaining, weight)."""
    return transition.filter("output = 'serving'").select("pid", "remaining", "weight")
