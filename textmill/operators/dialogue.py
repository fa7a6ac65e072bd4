"""Conversation operators: turn checks over a whole dialogue, scores, stratified selection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import artifacts as A
from ..functions import dialogue as D
from ..functions import parse as Q
from ..functions import text as T


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, messages) with messages in turn order; a conversation's turns are few by nature."""
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))


def alternation(convs: DataFrame) -> DataFrame:
    """Whether roles alternate from user to assistant, even and at least four; a system turn may open."""
    body = F.filter("messages", lambda m: m.role != "system")
    ok = F.forall(F.transform(body, lambda m, i: m.role == F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x)
    n = F.size(body)
    return convs.select("conv_id", n.cast("long").alias("n_turns"), (ok & (n >= 4) & (n % 2 == 0)).alias("alternates"))


def quoted_references(turns: DataFrame, least: int = 4) -> DataFrame:
    """(conv_id, turn, grounded): whether what a user turn quotes stands in an earlier turn."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    seen = turns.withColumn("earlier", F.lower(F.concat_ws("\n", F.collect_list("text").over(before))))
    quotes = F.filter(F.regexp_extract_all("text", F.lit(r'"([^"\n]+)"'), F.lit(1)), lambda q: F.length(F.trim(q)) >= least)
    ok = F.forall(quotes, lambda q: F.col("earlier").contains(F.lower(F.trim(q))))
    return seen.where("role = 'user'").select("conv_id", "turn", ok.alias("grounded"))


def well_formed(messages: Column) -> Column:
    """At least four turns, an even number, from user to assistant in turn, none blank."""
    n = F.size(messages)
    fits = F.transform(messages, lambda m, i: (m.role == F.when(i % 2 == 0, "user").otherwise("assistant")) & (F.trim(m.text) != ""))
    return (n >= 4) & (n % 2 == 0) & F.forall(fits, lambda x: x)


def skeleton_fits(messages: Column, skeleton: Column) -> Column:
    """As many steps as messages, each of its message's role and with a named act."""
    steps = F.transform(skeleton, lambda s, i: (s.role == F.get(messages, i).role) & (F.trim(s.dialogue_act) != ""))
    return (F.size(messages) == F.size(skeleton)) & F.forall(steps, lambda x: F.coalesce(x, F.lit(False)))


def references_visible(messages: Column, least: int = 4) -> Column:
    """Whether all that user turns quote stands in an earlier turn."""

    def visible(m: Column, i: Column) -> Column:
        earlier = F.lower(F.array_join(F.transform(F.slice(messages, 1, i), lambda x: x.text), "\n"))
        quotes = F.filter(F.regexp_extract_all(m.text, F.lit(r'"([^"\n]+)"'), F.lit(1)), lambda q: F.length(F.trim(q)) >= least)
        return T.let(earlier, lambda e: F.forall(quotes, lambda q: e.contains(F.lower(F.trim(q)))))

    return F.forall(F.transform(messages, lambda m, i: F.when(m.role == "user", visible(m, i)).otherwise(True)), lambda x: x)


SCORED = ("entity_grounding", "information_progress", "form_consistency", "evidence_boundary", "artifact_grounding", "task_completion", "first_turn_substance")
BIN = ("family", "domain", "intent_trajectory", "subtask_trajectory", "work_session_type")


def mds_scores(convs: DataFrame) -> DataFrame:
    """Eight scores of each conversation, the mean of the seven of SCORED, and its bin.

    ``convs`` has conv_id, messages (role, text), skeleton (role, dialogue_act), the columns of
    BIN, plan_steps and plan (how the user means to ask), review_score, accepted, and
    reviewers (name, passed). The bin joins the five columns of BIN (null: empty), the shape
    of the query plan, and the user's acts. ``eligible`` tells who may be selected.
    """
    texts = lambda role: F.transform(F.filter("messages", lambda m: m.role == role), lambda m: m.text)
    acts = F.transform(F.filter("skeleton", lambda s: s.role == "user"), lambda s: s.dialogue_act)
    rows = convs.withColumns({"users": texts("user"), "answers": texts("assistant"), "acts": acts})
    answered = F.size(F.filter("answers", lambda t: F.trim(t) != "")) / F.greatest(F.size("answers"), F.lit(1))
    form = F.when(F.size("users") == F.size("answers"), F.least(answered + 0.1, F.lit(1.0))).otherwise(answered)
    outcome = F.coalesce(F.get(F.filter("reviewers", lambda r: r["name"] == "outcome"), F.lit(0)).passed.cast("double"), F.lit(0.0))
    review = F.least(F.greatest(F.coalesce("review_score", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    own = lambda t: ~A.claims_artifact(t) | A.has_payload(t)
    scores = {
        "entity_grounding": D.entity_grounding(F.array_join("users", "\n"), F.array_join("answers", "\n")),
        "information_progress": D.information_progress(F.col("acts")),
        "form_consistency": form,
        "evidence_boundary": F.forall("messages", lambda m: m.role.isin("user", "assistant")).cast("double"),
        "artifact_grounding": F.forall("users", own).cast("double"),
        "reaction_grounding": references_visible(F.col("messages")).cast("double"),
        "task_completion": F.round((review + outcome) / 2, 4),
        "first_turn_substance": F.coalesce(D.first_turn_substance(F.get("users", F.lit(0))), F.lit(0.0)),
    }
    split = Q.query_plan(F.coalesce("plan", F.lit("")))
    plan = F.when(F.size("plan_steps") > 0, F.col("plan_steps")).when(F.size(split) > 0, split).otherwise(F.col("acts"))
    sound = (
        well_formed(F.col("messages")) & skeleton_fits(F.col("messages"), F.col("skeleton")) & ~F.exists("messages", lambda m: D.role_leaked(m.text))
        & F.forall("answers", D.restrained_format)
    )
    scored = rows.withColumns(scores | {"query_shape": F.array_join(F.transform(plan, D.shape_part), ">"), "trajectory_shape": F.array_join("acts", ">"), "sound": sound})
    mean = sum((F.col(c) for c in SCORED), F.lit(0.0)) / len(SCORED)
    bin_name = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in BIN], "query_shape", "trajectory_shape")
    allowed = F.coalesce("accepted", F.lit(False)) & (F.col("evidence_boundary") >= 1) & (F.col("artifact_grounding") >= 1) & F.col("sound")
    rounded = [F.round(c, 4).alias(c) for c in scores]
    return scored.select("conv_id", "family", "review_score", *rounded, bin_name.alias("global_bin"), F.round(mean, 4).alias("local_score"), allowed.alias("eligible"))


def rotate_bins(scored: DataFrame, most: int) -> DataFrame:
    """(family, conv_id, place, rows): up to ``most`` rows of each family, a rotating cursor taking turns over its bins.

    ``scored`` has family, global_bin, local_score, review_score and conv_id. Inside a bin
    the best come first (local score, review score, then conv_id). The cursor moves to the
    place after the bin taken, counted among the bins that had rows. ``rows`` is the family's
    size. Each bin is cut to its best ``most`` rows first, so that a task holds that many a bin.
    """
    rank = F.row_number().over(Window.partitionBy("family", "global_bin").orderBy(F.desc("local_score"), F.desc("review_score"), "conv_id"))
    cut = scored.withColumn("bin_rank", rank).where(F.col("bin_rank") <= most).select("family", "global_bin", "conv_id", "bin_rank")

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        bins = {b: g.sort_values("bin_rank").conv_id.tolist()[::-1] for b, g in frame.groupby("global_bin")}
        names, chosen, cursor = sorted(bins), [], 0
        while names and len(chosen) < most:
            at = cursor % len(names)
            chosen.append(bins[names[at]].pop())
            cursor = (at + 1) % len(names)
            if not bins[names[at]]:
                del names[at]
        return pd.DataFrame({"family": frame.family.iloc[0], "conv_id": chosen, "place": range(len(chosen))})

    sizes = scored.groupBy(F.col("family").alias("of")).agg(F.count(F.lit(1)).alias("rows"))
    picked = cut.groupBy("family").applyInPandas(pick, "family string, conv_id long, place long")
    return picked.join(sizes, F.col("family") == F.col("of")).drop("of")


def mds_select(scored: DataFrame, target: int) -> DataFrame:
    """(conv_id, family, place): ``target`` eligible rows, one of each family a round, the smallest family first.

    What a family gives next does not depend on the others, so the rounds are its places. The
    family with the fewest rows left goes first: all have given the same number.
    """
    return rotate_bins(scored.where("eligible"), target).orderBy("place", "rows", "family").limit(target).select("conv_id", "family", "place")


def mds_report(scored: DataFrame, selected: DataFrame, target: int) -> DataFrame:
    """One row: candidates, eligible, selected and rejected rows, shortfall, bins and mean score."""
    chosen = selected.select(F.col("conv_id").alias("chosen"))
    marked = scored.join(chosen, F.col("conv_id") == F.col("chosen"), "left").withColumn("taken", F.col("chosen").isNotNull())
    taken = F.count_if("taken")
    return marked.agg(
        F.count(F.lit(1)).alias("candidate_rows"), F.count_if("eligible").alias("eligible_rows"), taken.alias("accepted_rows"), F.count_if(~F.col("taken")).alias("rejected_rows"),
        F.greatest(F.lit(target) - taken, F.lit(0)).alias("shortfall"), F.when(taken < target, "partial").otherwise("completed").alias("status"),
        F.countDistinct("global_bin").alias("candidate_bins"), F.countDistinct(F.when(F.col("taken"), F.col("global_bin"))).alias("selected_bins"),
        F.coalesce(F.round(F.avg(F.when(F.col("taken"), F.col("local_score"))), 4), F.lit(0.0)).alias("mean_selected_score"),
    )


def ordered_map(rows: DataFrame, f, schema: str, order: str) -> DataFrame:
    """Parallel map over Arrow batches with the results in input order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield f(frame)

    return rows.mapInPandas(run, schema).orderBy(order)
