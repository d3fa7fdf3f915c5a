"""Preference formatting of chat turns (operator 6).

A pair of conversations, one chosen and one rejected, is rendered as the longest common prefix of their turns, once,
as prompt, and the two remainders as completions. A loss mask marks what is learned: the assistant's text of a
completion, not the markers, the other roles or the prompt.

Pairs come as a table (chosen_id, rejected_id), or are made from conversations that open with the same turn: they are
ranked by their assistant words, and the more worded half is chosen over the less worded, rank by rank (an arbitrary
choice: the tables hold no verdicts). Ranking is done within hash buckets, as many as give ``BUCKET`` conversations each,
so a common opening does not meet in one task; what is left over in its bucket meets in buckets of ``BUCKET`` buckets,
and so on, so that no group is large and at most one conversation of an opening is left. It is paired with itself: its last assistant turn is chosen over the last assistant turn of another such conversation (rejected_id), the
next of different text in a hash bucket. Without an assistant turn, or another text, it is reported without a partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, stored, table

MARK = ("<|", "|>\n", "<|end|>\n")
BUCKET = 64  # conversations in a bucket, about


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: turns as an ordered array of (role, text).

    Order is by turn number, null first, then role and text; a null role or text counts as empty. Repeated rows of a
    turn stay repeated. Rows without conv_id belong to no conversation and are left out.
    """
    t = columns(turns, conv_id="long", turn="long", role="string", text="string").where("conv_id is not null")
    t = t.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    t = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return t.select("conv_id", F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("turns"))


def paired(convs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(chosen_id, rejected_id) of conversations with the same first turn; rejected_id is null where none is left."""
    c = convs.select("conv_id", F.xxhash64(F.col("turns")[0]).alias("opening"), F.expr("aggregate(filter(turns, x -> x.role = 'assistant'), 0L, (n, x) -> n + size(split(trim(x.text), '[ \\\\t\\\\r\\\\n]+')))").alias("words"))
    rounds = 0  # of nested buckets: bucket ** rounds at first, one in the last round
    while bucket**rounds * bucket < convs.count():
        rounds += 1
    c = c.withColumns({"round": F.lit(0), "part": F.pmod(F.xxhash64("conv_id"), F.lit(bucket**rounds))})
    w = Window.partitionBy("opening", "round", "part")
    for k in range(rounds + 1):
        c = c.withColumns({"rank": F.row_number().over(w.orderBy(F.desc("words"), "conv_id")) - 1, "n": F.count("*").over(w)})
        half = F.floor(F.col("n") / 2)
        left = F.col("rank") >= 2 * half
        if k < rounds:
            again = left & (F.col("round") == k)
            c = c.withColumns({"part": F.when(again, F.pmod("part", F.lit(bucket ** (rounds - 1 - k)))).otherwise(F.col("part")), "round": F.when(again, F.lit(k + 1)).otherwise(F.col("round"))})
    c = c.withColumns({"slot": F.when(left, half).otherwise(F.col("rank") % F.greatest(half, F.lit(1))), "role": F.when(left | (F.col("rank") < half), F.lit("c")).otherwise(F.lit("r"))})
    return c.groupBy("opening", "round", "part", "slot").agg(F.min(F.when(F.col("role") == "c", F.col("conv_id"))).alias("chosen_id"), F.min(F.when(F.col("role") == "r", F.col("conv_id"))).alias("rejected_id")).select("chosen_id", "rejected_id")


_LAST = "array_max(filter(sequence(1, size({0})), i -> {0}[i - 1].role = 'assistant'))"


def alternatives(alone: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(chosen_id, donor_id, b) of rows (chosen_id, a) by hash buckets: ``b`` is ``a`` up to its last assistant turn, with
    that turn's text taken from the next conversation with another, in order of text."""
    own = alone.select("chosen_id", "a", F.expr(_LAST.format("a")).alias("at")).where("at is not null").withColumn("text", F.expr("a[at - 1].text"))
    narrow = own.select("chosen_id", "text")
    narrow = narrow.crossJoin(F.broadcast(narrow.agg(F.count("*").alias("all")))).withColumn("part", F.pmod(F.xxhash64("chosen_id", F.lit(7)), F.ceil(F.col("all") / bucket)))
    texts = narrow.groupBy("part", "text").agg(F.min("chosen_id").alias("donor_id"))
    w = Window.partitionBy("part").orderBy("text")
    first = Window.partitionBy("part").orderBy("text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = lambda x: F.coalesce(F.lead(x).over(w), F.first(x).over(first))
    texts = texts.select("part", "text", following("donor_id").alias("donor_id"), following("text").alias("other")).where("text <> other")
    found = narrow.select("chosen_id", "part", "text").join(texts, ["part", "text"]).select("chosen_id", "donor_id", "other")
    return own.join(found, "chosen_id").select("chosen_id", "donor_id", F.expr("concat(slice(a, 1, at - 1), array(named_struct('role', 'assistant', 'text', other)))").alias("b"))


def render(turns: str) -> str:
    """SQL text of an array of turns."""
    a, b, c = (x.replace("\n", "\\n") for x in MARK)
    return f"array_join(transform({turns}, x -> concat('{a}', x.role, '{b}', x.text, '{c}')), '')"


def _learned(turns: str, at: str) -> str:
    """SQL array of (start, end) of assistant text, in code points of the rendered turns."""
    a, b, c = map(len, MARK)
    step = f"{a + b + c} + length(x.role) + length(x.text)"
    head = f"s.p + {a + b} + length(x.role)"
    return (
        f"aggregate({turns}, named_struct('p', {at}, 'm', cast(array() as array<struct<start:int,end:int>>)), (s, x) -> named_struct('p', s.p + {step}, "
        f"'m', if(x.role = 'assistant' and x.text <> '', concat(s.m, array(named_struct('start', {head}, 'end', {head} + length(x.text)))), s.m)), s -> s.m)"
    )


def preferences(turns: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Per pair: chosen_id, rejected_id, shared_turns, prompt, chosen, rejected, and the masks chosen_mask and
    rejected_mask, arrays of (start, end) within each completion.

    Equal conversations share all turns and have empty completions. Where pairs are made, a conversation without a
    partner is set against an alternative of its last assistant turn, taken from rejected_id. Without that too, rejected
    is null and the whole conversation but its first turn is the completion. Ids of ``pairs`` that have no turns give no row;
    a null rejected_id there stands for no partner. Turns that repeat stay; extra columns are ignored; an empty table gives no
    rows. Long texts are rendered whole.
    """
    convs = stored(conversations(turns), "conversations")
    made = pairs is None
    pairs = paired(convs) if made else columns(pairs, chosen_id="long", rejected_id="long")
    a = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a"))
    b = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    rows = pairs.where("rejected_id is not null").join(a, "chosen_id").join(b, "rejected_id").select("chosen_id", "rejected_id", "a", "b")
    alone = pairs.where("rejected_id is null").select("chosen_id").join(a, "chosen_id")
    other = alternatives(alone).withColumnRenamed("donor_id", "rejected_id") if made else alone.selectExpr("chosen_id", "cast(null as bigint) as rejected_id", "a as b").where("false")
    rows = rows.union(alone.join(other, "chosen_id", "left").select("chosen_id", "rejected_id", "a", "b"))
    equal = "filter(sequence(1, least(size(a), size(b))), i -> a[i - 1] <> b[i - 1])"
    rows = rows.withColumn("shared_turns", F.expr(f"if(b is null, 1, coalesce(array_min({equal}) - 1, least(size(a), size(b))))"))
    rest = lambda t: f"slice({t}, shared_turns + 1, size({t}))"
    return rows.select(
        "chosen_id",
        "rejected_id",
        F.col("shared_turns").cast("long").alias("shared_turns"),
        F.expr(render("slice(a, 1, shared_turns)")).alias("prompt"),
        F.expr(render(rest("a"))).alias("chosen"),
        F.expr(f"if(b is null, null, {render(rest('b'))})").alias("rejected"),
        F.expr(_learned(rest("a"), "0")).alias("chosen_mask"),
        F.expr(f"if(b is null, null, {_learned(rest('b'), '0')})").alias("rejected_mask"),
    )


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all conversations by their opening turn, with masks as text start-end, comma-joined."""
    rows = preferences(table(spark, sf_dir, "conversations"))
    spans = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws("-", m.start.cast("string"), m.end.cast("string"))), ",")
    return rows.withColumns({"chosen_mask": spans(F.col("chosen_mask")), "rejected_mask": spans(F.col("rejected_mask"))})
