"""Question and answer quality."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify
from ..functions.binding import let
from ..functions.text import base_name, word_count
from ..functions.text import words as split_words
from .vectors import tokens

# Fixed value: the most words of a concise answer.
CONCISE_WORDS = 80
# Phrases of an answer that evades, in lower case.
EVASIVE = (
    "i cannot", "i can't", "i am unable", "i'm unable", "i am not able", "as an ai", "i don't know",
    "i do not know", "no comment", "cannot help", "can't help", "unable to assist", "not at liberty",
)

Scorer = Callable[[], Column]


def pairs(qa: DataFrame) -> DataFrame:
    """Evaluation rows shaped as ``inputs`` and ``expectations``."""
    message = F.struct(F.lit("user").alias("role"), F.col("question").alias("content"))
    return qa.select(
        *[c for c in qa.columns if c not in ("question", "answer")],
        F.struct(F.array(message).alias("input")).alias("inputs"),
        F.struct(F.col("answer").alias("expected_response")).alias("expectations"),
    )


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    An equi-join on (conversation, turn) rather than a window over the conversation, so a
    conversation with most of all turns is spread over all tasks.
    """
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    given = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(given, ["conv_id", "turn"])


def with_answers(qa: DataFrame, answers: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """Expected answers joined with given ones (``question, outputs``) and with retrieved context.

    Every different answer to a question is a row of its own, told apart by ``answer_id``; the
    same answer given again is not. All contexts of a question are one text, in the order of
    their ``rank`` if there is one, so that they do not multiply the rows.
    """
    told = answers.withColumn("_told", F.to_json(F.struct("outputs")))
    if "answer_id" not in answers.columns:
        told = told.withColumn("answer_id", F.xxhash64("_told"))
    joined = qa.join(told.dropDuplicates(["question", "answer_id", "_told"]).drop("_told"), "question", "left")
    return joined if context is None else joined.join(joined_context(context), "question", "left")


def joined_context(context: DataFrame) -> DataFrame:
    """(question, context): all retrieved texts of a question, the best first.

    Retrieval gives k texts per question, so a group is bounded by k.
    """
    rank = F.col("rank").cast("long") if "rank" in context.columns else F.lit(0).cast("long")
    listed = context.filter("context IS NOT NULL").groupBy("question").agg(F.sort_array(F.collect_set(F.struct(rank.alias("rank"), "context"))).alias("c"))
    return listed.select("question", F.array_join("c.context", "\n").alias("context"))


def same_document(left: Column, right: Column) -> Column:
    """'a.pdf' and 'folder/a.enc' name one document."""
    return base_name(left) == base_name(right)


def answer_text(outputs: Column, kind: str) -> Column:
    """The text of a given answer: a struct's or map's ``response``, else ``output``, else ''."""
    if kind == "string":
        return F.coalesce(outputs, F.lit(""))
    fields = [F.when(F.length(outputs[f]) > 0, outputs[f]) for f in ("response", "output") if f in kind or kind.startswith("map")]
    return F.coalesce(*fields, F.lit(""))


def json_answer_text(outputs: Column) -> Column:
    """The same for an answer held as text: JSON objects are looked into, other text is taken whole."""
    fields = F.from_json(outputs, "response string, output string")
    inside = F.coalesce(
        F.when(F.length(fields["response"]) > 0, fields["response"]),
        F.when(F.length(fields["output"]) > 0, fields["output"]),
        F.lit(""),
    )
    return F.when(outputs.rlike(r"^\s*\{"), inside).otherwise(F.coalesce(outputs, F.lit("")))


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("yes")).otherwise(F.lit("no"))


def concise(answer: Column) -> Column:
    return yes_no(word_count(answer) <= CONCISE_WORDS)


def _vocabulary(text: Column) -> Column:
    return F.array_distinct(tokens(F.coalesce(text, F.lit(""))))


def coverage(part: Column, whole: Column) -> Column:
    """Share of the distinct words of ``part`` that ``whole`` has too; 0 without words."""
    return let(
        F.struct(_vocabulary(part).alias("p"), _vocabulary(whole).alias("w")),
        lambda v: F.when(
            F.size(v["p"]) > 0, F.size(F.array_intersect(v["p"], v["w"])) / F.size(v["p"])
        ).otherwise(F.lit(0.0)),
    )


def in_english(answer: Column) -> Column:
    return yes_no(F.coalesce(classify.language(answer) == "en", F.lit(False)))


def not_evasive(answer: Column) -> Column:
    folded = F.lower(F.array_join(split_words(F.replace(answer, F.lit("’"), F.lit("'"))), " "))
    evades = F.lit(False)
    for phrase in EVASIVE:
        evades = evades | folded.contains(phrase)
    return yes_no(~evades)


def scorers(threshold: float = 0.5) -> dict[str, Column]:
    """Name -> yes/no column over (question, answer, expected, context).

    The four judged measures are lexical stand-ins and say so in their names; a model can
    take their place through ``modelhook.map_batches``.
    """
    question, answer, expected, context = (F.col(c) for c in ("question", "answer", "expected", "context"))
    enough = F.lit(threshold)
    return {
        "correctness_proxy": yes_no(coverage(expected, answer) >= enough),
        "retrieval_sufficiency_proxy": yes_no(coverage(expected, context) >= enough),
        "retrieval_groundedness_proxy": yes_no(coverage(answer, context) >= enough),
        "relevance_to_query_proxy": yes_no(coverage(question, answer) >= enough),
        "global_style_english": in_english(answer),
        "global_style_not_evasive": not_evasive(answer),
        "concise_response": concise(answer),
    }


def scored(rows: DataFrame, keys: list[str], chosen: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per answer with one column per scorer."""
    chosen = chosen if chosen is not None else scorers()
    return rows.select(*keys, *[score.alias(name) for name, score in chosen.items()])


def long_form(table: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, scorer, value): the per-row result table."""
    return table.unpivot(keys, [c for c in table.columns if c not in keys], "scorer", "value")


def metrics(table: DataFrame, keys: list[str]) -> DataFrame:
    """Share of yes per scorer. One aggregate over all columns; only its one row is turned."""
    names = [c for c in table.columns if c not in keys]
    sums = table.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c) == "yes").alias(f"yes_{i}") for i, c in enumerate(names)],
    )
    turned = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("scorer"), F.col("n").alias("n_answers"), F.col(f"yes_{i}").alias("n_yes"))
                for i, c in enumerate(names)
            ]
        )
    )
    share = F.when(F.col("m.n_answers") > 0, F.col("m.n_yes") / F.col("m.n_answers"))
    return sums.select(turned.alias("m")).select("m.*", share.alias("share_yes"))
