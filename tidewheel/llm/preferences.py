"""Preference formatting of chosen and rejected conversations. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans.ordering import positions
from tidewheel.plans.skew import dealt_join
from tidewheel.plans.storage import materialize

from .arrays import running

STRETCH = 64  # turn numbers that are rendered together before a pair's row is put together


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def _body(turns: Column) -> Column:
    """(body, size, spans) of rendered turns; spans are the places of assistant texts, in code points."""
    blocks = F.transform(turns, lambda x: render(x["role"], x["text"]))
    at = running(F.transform(blocks, lambda x: F.length(x).cast("long")), lambda s, x: s + x)
    placed = F.filter(F.arrays_zip(turns.alias("turn"), at.alias("at")), lambda x: x["turn"]["role"] == "assistant")
    start = lambda x: x["at"] + F.length(x["turn"]["role"]) + 5
    spans = F.transform(placed, lambda x: F.struct(start(x).alias("start"), (start(x) + F.length(x["turn"]["text"])).alias("end")))
    body = F.array_join(blocks, "")
    return F.struct(body.alias("body"), F.length(body).cast("long").alias("size"), spans.alias("spans"))


def preference_format(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected, chosen_loss, rejected_loss), one row a pair, from two tables (pair_id, turn, role, text).

    ``prompt`` is the longest common prefix of turns, rendered once; ``chosen`` and ``rejected``
    are what follows it on either side. The loss columns are the completions' masks: start:end,
    in code points of the completion, of the assistant texts in it, which alone are trained on.

    Turns equal if number, roles and texts do, null like empty. Repeated rows count once; different
    rows of one turn number are one turn, ordered by role and text. A pair that one side lacks has
    an empty prompt and an empty completion there. Null pair ids or turns are left out. Empty
    tables give an empty result. Turns are rendered in stretches of turn numbers, so that a
    conversation with a large share of all turns is worked on by many tasks; only rendered
    stretches meet in the row of a pair.
    """
    side = lambda df, name: df.where("pair_id IS NOT NULL AND turn IS NOT NULL").select(
        "pair_id", F.col("turn").cast("long").alias("turn"), F.lit(name).alias("side"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = side(chosen, "c").unionByName(side(rejected, "r"))
    of = lambda name: F.array_sort(F.collect_set(F.when(F.col("side") == name, F.struct("turn", "role", "text")))).alias(name)
    stretches = rows.groupBy("pair_id", F.floor(F.col("turn") / STRETCH).alias("no")).agg(of("c"), of("r"))
    differ = F.filter(F.arrays_zip("c", "r"), lambda x: ~x["c"].eqNullSafe(x["r"]))
    star = F.when(F.size(differ) > 0, F.least(differ[0]["c"]["turn"], differ[0]["r"]["turn"]))
    stretches = stretches.withColumn("star", star)
    before = F.filter("c", lambda x: F.col("star").isNull() | (x["turn"] < F.col("star")))
    after = lambda name: F.filter(name, lambda x: x["turn"] >= F.col("star"))
    parts = stretches.select("pair_id", F.struct("no", F.col("star").isNotNull().alias("split"), _body(before).alias("same"), _body(after("c")).alias("c"), _body(after("r")).alias("r")).alias("part"))
    pairs = parts.groupBy("pair_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    pairs = pairs.withColumn("at", F.array_position(F.transform("parts", lambda x: x["split"]), True).cast("int"))
    prompt = F.array_join(F.transform(F.slice("parts", F.lit(1), F.when(F.col("at") == 0, F.size("parts")).otherwise(F.col("at"))), lambda x: x["same"]["body"]), "")
    tail = F.when(F.col("at") == 0, F.slice("parts", 1, 0)).otherwise(F.slice("parts", F.greatest("at", F.lit(1)), F.size("parts")))
    pairs = pairs.withColumns({"prompt": prompt, "tail": tail})

    def completion(name: str) -> list[Column]:
        pieces = F.flatten(F.transform("tail", lambda x, i: F.when(i == 0, F.array(x[name])).otherwise(F.array(x["same"], x[name]))))
        starts = running(F.transform(pieces, lambda x: x["size"]), lambda s, x: s + x)
        spans = F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), starts.alias("at")), lambda z: F.transform(z["piece"]["spans"], lambda s: F.concat_ws(":", (s["start"] + z["at"]).cast("string"), (s["end"] + z["at"]).cast("string")))))
        return [F.array_join(F.transform(pieces, lambda x: x["body"]), ""), F.array_join(spans, ",")]

    (good, good_loss), (bad, bad_loss) = completion("c"), completion("r")
    return pairs.select("pair_id", "prompt", good.alias("chosen"), bad.alias("rejected"), good_loss.alias("chosen_loss"), bad_loss.alias("rejected_loss"))


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected tables from plain conversations: the rejected side ends with the last reply of the next conversation.

    Conversations that have an assistant turn follow each other by conv_id; after the last comes
    the first; a lone one makes no pair. Both sides end with the last assistant turn. Of several
    assistant rows in that turn, the greatest text is the reply that others get.
    """
    c = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    last = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("role") == "assistant", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("last"))
    last = positions(last.where("last IS NOT NULL"), "conv_id")
    many = last.count()
    after = last.select((F.pmod(F.col("pos") - 1, F.lit(max(many, 1)))).alias("pos"), F.col("last.text").alias("reply"))
    pairs = last.join(after, "pos").select(F.col("conv_id").alias("paired"), F.col("last.turn").alias("last_turn"), "reply") if many > 1 else last.limit(0).select(F.col("conv_id").alias("paired"), F.col("last.turn").alias("last_turn"), F.col("last.text").alias("reply"))
    rows = dealt_join(c, pairs, "conv_id", "paired", counts=last.select(F.col("conv_id").alias("key"), "n"))
    rows = materialize(rows.where("turn <= last_turn"), "paired-turns")
    swap = (F.col("turn") == F.col("last_turn")) & (F.col("role") == "assistant")
    chosen = rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return chosen, rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.when(swap, F.col("reply")).otherwise(F.col("text")).alias("text"))
