"""Preference formatting of chosen and rejected conversations, in built-in functions.

The longest common prefix of the turns of both, compared by role and text, is rendered once as the prompt. What is left
of either is its completion, as segments that are learnt from or masked: text and end mark of an
assistant's turn are learnt from, role headers and all turns of others are not.

A conversation may hold any share of all turns, so it is never one row on the way. Turns are numbered by a range partitioning
over (conversation, turn, role), places behind the first partition of a conversation by the counts of those before. Both sides are joined on
(pair, place), the first difference is a minimum per pair, and the result of ``pair_segments`` is a row per segment. ``format_pairs``
gathers those of pairs that fit into a row.

Defined results. Turns stand in the order of their number (nulls first), equal numbers by role and text, so
repeated rows are turns of their own. A null role or text is rendered as empty and equals only another null.
Pairs that have only one side are left out. If one conversation is a prefix of the other, its completion is empty; equal conversations
have empty completions. ``usable`` tells pairs in which both completions have something to learn from. A null pair key
pairs nothing. Columns beyond those named are ignored. Empty tables give an empty result. Turns alike in conversation, number and
role meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import as_struct, attach, stored

# The mark-up of turns.
HEADER = ("<|", "|>\n")
END = "<|end|>\n"
LEARNT_ROLE = "assistant"
# Characters up to which both sides of a pair are gathered into one row.
ROW_CHARS = 64 << 20


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(turns: DataFrame, pair: str, turn: str, role: str, text: str) -> DataFrame:
    """(pair_id, place, role, text): the turns of each conversation numbered from 0."""
    named = turns.select(*[F.col(f"`{c}`").alias(n) for n, c in (("pair_id", pair), ("turn", turn), ("role", role), ("text", text))])
    order = [F.asc_nulls_first(c) for c in ("pair_id", "turn", "role", "text")]
    ranged = named.filter("pair_id IS NOT NULL").repartitionByRange(_parts(turns), *order[:3]).sortWithinPartitions(*order)
    placed = stored(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    # one row per conversation and range partition that it reaches into
    spans = placed.groupBy("pair_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("pair_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = spans.select("pair_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(shift, ["pair_id", "part"]).select("pair_id", (F.col("at") + F.col("shift")).alias("place"), "role", "text")


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _header(role: Column) -> Column:
    return F.concat(F.lit(HEADER[0]), _blank(role), F.lit(HEADER[1]))


def pair_segments(
    chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per turn of a pair: pair_id, prompt_turns, side ('prompt', 'chosen', 'rejected'), place, header (masked), text, learnt.

    The text carries its end mark; ``learnt`` is false for all of a prompt.
    """
    a, b = (
        numbered(side, pair, turn, role, text).select("pair_id", "place", F.struct("role", "text").alias(name)) for side, name in ((chosen, "c"), (rejected, "r"))
    )
    both = stored(a.join(b, ["pair_id", "place"], "full"))
    same = F.col("c").isNotNull() & F.col("r").isNotNull() & F.col("c.role").eqNullSafe(F.col("r.role")) & F.col("c.text").eqNullSafe(F.col("r.text"))
    facts = both.groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("weight"), F.count("c").alias("nc"), F.count("r").alias("nr"), F.min(F.when(~same, F.col("place"))).alias("cut")
    )
    facts = stored(facts.filter("nc > 0 AND nr > 0").select("pair_id", "weight", F.coalesce("cut", "weight").cast("int").alias("prompt_turns")))
    rows = attach(both, facts, "pair_id", "weight", both.count())
    shared = F.col("place") < F.col("prompt_turns")

    def side(name: str, turn_: Column, learns: Column) -> Column:
        return F.when(
            turn_.isNotNull(),
            F.struct(
                F.lit(name).alias("side"), _header(turn_["role"]).alias("header"), F.concat(_blank(turn_["text"]), F.lit(END)).alias("text"),
                (learns & turn_["role"].eqNullSafe(F.lit(LEARNT_ROLE))).alias("learnt"),
            ),
        )

    none, learnt = F.lit(False), F.lit(True)
    sides = F.when(shared, F.array(side("prompt", F.col("c"), none))).otherwise(F.array(side("chosen", F.col("c"), learnt), side("rejected", F.col("r"), learnt)))
    made = rows.select("pair_id", "prompt_turns", "place", F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("s"))
    return made.select("pair_id", "prompt_turns", "s.side", "place", "s.header", "s.text", "s.learnt")


def format_pairs(
    chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text", row_chars: int = ROW_CHARS
) -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen and rejected (array<struct<text, learnt>>), usable, prompt_parts (as chosen).

    Pairs of over ``row_chars`` characters have null for prompt, its parts, chosen and rejected: their segments stay rows of ``pair_segments``.
    """
    rows = stored(pair_segments(chosen, rejected, pair, turn, role, text))
    facts = measured(rows)
    return facts.join(gathered(rows, facts, row_chars), "pair_id", "left").select("pair_id", "prompt_turns", "prompt", "chosen", "rejected", "usable", "prompt_parts")


def measured(rows: DataFrame) -> DataFrame:
    """(pair_id, prompt_turns, chars, usable) of the pairs of segments."""
    facts = rows.groupBy("pair_id", "prompt_turns").agg(
        F.sum(F.length("header") + F.length("text")).alias("chars"), *[F.coalesce(F.max(F.when(F.col("side") == s, F.col("learnt"))), F.lit(False)).alias(s) for s in ("chosen", "rejected")]
    )
    return stored(facts.select("pair_id", "prompt_turns", "chars", (F.col("chosen") & F.col("rejected")).alias("usable")))


def long_pairs(facts: DataFrame, row_chars: int = ROW_CHARS) -> DataFrame:
    """Ids of the pairs that do not fit into a row; far fewer than one per row_chars characters of all text."""
    return F.broadcast(facts.filter(F.col("chars") > row_chars).select("pair_id"))


def gathered(rows: DataFrame, facts: DataFrame, row_chars: int = ROW_CHARS) -> DataFrame:
    """(pair_id, prompt, prompt_parts, chosen, rejected) of the pairs that fit into a row, from their segments."""
    fitting = rows.join(long_pairs(facts, row_chars), "pair_id", "left_anti")

    def listed(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == name, F.struct("place", "header", "text", "learnt"))))

    lists = fitting.groupBy("pair_id").agg(*[listed(s).alias(s) for s in ("prompt", "chosen", "rejected")])
    prompt = F.array_join(F.transform("prompt", lambda t: F.concat(t["header"], t["text"])), "")

    def parts(name: str) -> Column:
        header = lambda t: F.struct(t["header"].alias("text"), F.lit(False).alias("learnt"))
        return F.flatten(F.transform(name, lambda t: F.array(header(t), F.struct(t["text"].alias("text"), t["learnt"].alias("learnt")))))

    return lists.select("pair_id", prompt.alias("prompt"), parts("prompt").alias("prompt_parts"), parts("chosen").alias("chosen"), parts("rejected").alias("rejected"))


def next_replies(replies: DataFrame) -> DataFrame:
    """(conversation, other): for each (conversation, reply) the reply of the next conversation by id, round at the end."""
    ranged = replies.repartitionByRange(_parts(replies), "conversation").sortWithinPartitions("conversation")
    placed = stored(ranged.withColumn("at", F.monotonically_increasing_id()))
    spans = sorted(tuple(r) for r in placed.groupBy(F.shiftright("at", 33)).agg(F.min("at").alias("first"), F.max("at").alias("last")).select("first", "last").collect())
    # one row per range partition: what follows its last conversation
    follows = [(last, spans[(n + 1) % len(spans)][0]) for n, (_, last) in enumerate(spans)]
    jumps = replies.sparkSession.createDataFrame(follows, "at long, jump long")
    led = placed.join(F.broadcast(jumps), "at", "left").select("conversation", F.coalesce("jump", F.col("at") + 1).alias("at"))
    return led.join(placed.select("at", F.col("reply").alias("other")), "at").select("conversation", "other")


def swapped_replies(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rejected sides for conversations that have none: each with its last reply taken from the next conversation by id that has one.

    Every row with a conversation comes back, with all its columns. A conversation without reply, or the only one with a reply, stays as it is.
    Of several last replies with the same number the text that is largest goes to the other conversation.
    """
    cells = turns.select(
        as_struct(turns).alias("_row"), *[F.col(f"`{c}`").alias(n) for n, c in (("conversation", conversation), ("turn", turn), ("role", role), ("text", text))]
    ).filter("conversation IS NOT NULL")
    said = F.when((F.col("role") == LEARNT_ROLE) & F.col("turn").isNotNull(), F.struct("turn", _blank(F.col("text")).alias("t"), "text"))
    known = stored(cells.groupBy("conversation").agg(F.count(F.lit(1)).alias("weight"), F.max(said).alias("said")))
    others = next_replies(known.filter("said IS NOT NULL").select("conversation", F.col("said.text").alias("reply")))
    facts = known.join(others.withColumn("known", F.lit(True)), "conversation", "left").select("conversation", "weight", F.col("said.turn").alias("last"), "other", "known")
    given = attach(cells, stored(facts), "conversation", "weight", cells.count())
    replaced = F.coalesce((F.col("turn") == F.col("last")) & (F.col("role") == LEARNT_ROLE) & F.col("known"), F.lit(False))
    kept = [F.col("_row").getField(c).alias(c) for c in turns.columns]
    return given.select(*[F.when(replaced, F.col("other")).otherwise(k).alias(c) if c == text else k for c, k in zip(turns.columns, kept, strict=True)])
