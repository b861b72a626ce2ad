"""Entities on the words of their page: match, split the mask, redact, look for leaks.

A page is one row with its words and entities as arrays. Matching works on the row alone:
no join, no shuffle, and no list of all candidate pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.binding import items, let, only
from ..functions.text import token_key, words

_OWNERS = "array<struct<ent: int, offset: int>>"


def _owners(page: list[str], entities: list[list[str]], repeat: bool) -> dict[int, tuple[int, int]]:
    """Entity and offset of every taken word of a page by its place, from the compared forms of words and entities.

    Runs are looked up where a word begins some entity, so an entity costs its own hits and not
    the page. With ``repeat`` an entity takes every free run, else the m-th listing of equal
    entities the m-th one; entities are served in list order.
    """
    owner: dict[int, tuple[int, int]] = {}
    wanted: dict[str, dict[int, set[tuple[str, ...]]]] = {}
    for tokens in entities:
        if tokens:
            wanted.setdefault(tokens[0], {}).setdefault(len(tokens), set()).add(tuple(tokens))
    places: dict[tuple[str, ...], list[int]] = {}
    for at, word in enumerate(page):
        if word in wanted:
            for length, asked in wanted[word].items():
                run = tuple(page[at : at + length])
                if run in asked:
                    places.setdefault(run, []).append(at)
    served: dict[tuple[str, ...], int] = {}
    for ent, tokens in enumerate(entities):
        run = tuple(tokens)
        hits = places.get(run, ())
        at = served.get(run, 0)
        while at < len(hits):
            first = hits[at]
            at += 1
            if not any(p in owner for p in range(first, first + len(run))):
                for offset in range(len(run)):
                    owner[first + offset] = (ent, offset)
                if not repeat:
                    break
        served[run] = at
    return owner


def _matcher(repeat: bool):
    @F.arrow_udf(_OWNERS)
    def matched(pages: pa.Array, entities: pa.Array) -> pa.Array:
        # words and owners of all pages as flat arrays: most words have no owner
        words_ = pages.flatten().to_numpy(zero_copy_only=False).tolist()
        sizes = [n or 0 for n in pa.compute.list_value_length(pages).to_pylist()]
        ends, told = [0], []
        ent, offset = np.full(len(words_), -1, np.int32), np.zeros(len(words_), np.int32)
        for size, listed in zip(sizes, entities.to_pylist(), strict=True):
            start = ends[-1]
            ends.append(start + size)
            told.append(bool(size and listed))
            for place, owner in _owners(words_[start : start + size], listed, repeat).items() if told[-1] else ():
                ent[start + place], offset[start + place] = owner
        owners = pa.StructArray.from_arrays([pa.array(ent), pa.array(offset)], ["ent", "offset"], mask=pa.array(ent < 0))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), owners, mask=pa.array([not t for t in told], pa.bool_()))

    return matched


def matches(page_words: Column, entities: Column, repeat: bool = False, loose: bool = False) -> Column:
    """What each word belongs to: array of (ent, offset) beside the words, NULL for a free word.

    NULL as a whole for a page without entities or words. Words and entities are made comparable
    in the JVM; runs are then looked up page by page on Arrow batches, in time that grows with
    words and hits and not with their product.

    Tokens are compared without most punctuation, but dots and hyphens count, so the last
    word of a sentence is not found. ``loose`` leaves them out at the ends of a token.
    """

    def compared(token: Column) -> Column:
        bare = token_key(token)
        return F.btrim(bare, F.lit(".-")) if loose else bare

    some = (F.size(entities) > 0) & (F.size(page_words) > 0)
    page = F.when(some, F.transform(page_words, compared))
    listed = F.when(some, F.transform(entities, lambda e: F.transform(words(e["original"]), compared)))
    return _matcher(repeat)(page, listed)


def mask_piece(masked: Column, run: Column, offset: Column) -> Column:
    """The part of a mask for one word of its run: the token at its place if there are as many, else by length."""
    word = F.length(F.get(run, offset))
    before = F.aggregate(F.slice(run, F.lit(1), offset), F.lit(0), lambda acc, w: acc + F.length(w))
    chars = F.replace(masked, F.lit(" "), F.lit(""))
    by_length = F.when(word > 0, F.rpad(F.substr(chars, before + 1, word), word, F.lit("*"))).otherwise(F.lit(""))
    return let(
        words(masked), lambda tokens: F.when(F.size(tokens) == F.size(run), F.get(tokens, offset)).otherwise(by_length)
    )


def split_mask(masked: Column, run: Column) -> Column:
    """The mask cut for a run of words."""
    return F.transform(run, lambda word, offset: mask_piece(masked, run, offset))


def with_words(pages: DataFrame, text: str = "page_content") -> DataFrame:
    """Pages with ``words`` where there is an entity to look for; the others need none."""
    return pages.withColumn("words", F.when(F.size("entities") > 0, words(F.col(text))))


def with_redactions(
    pages: DataFrame,
    page_words: str = "words",
    repeat: bool = False,
    loose: bool = False,
    keep_punctuation: bool = False,
) -> DataFrame:
    """Pages with ``redactions`` beside the words: (ent, masked, category), NULL for a free word.

    NULL as a whole where the page has no entity. ``repeat=False`` masks the first run of
    an entity only; ``keep_punctuation`` leaves what is attached to the ends of a word
    ("Miller," -> "******,").
    """
    matched = pages.withColumn("matched", matches(F.col(page_words), F.col("entities"), repeat, loose))

    def kept(word: Column, mask: Column) -> Column:
        # the end of a word is read as the start of its reverse: a pattern tied to the end
        # would be tried from every place of a long run
        edge, star_edge = r"^[^\p{L}\p{N}_@.\-]*", r"^[^\p{L}\p{N}_@.*\-]+"
        lead = F.regexp_extract(word, edge, 0)
        tail = F.reverse(F.regexp_extract(F.reverse(word), edge, 0))
        core = F.reverse(F.regexp_replace(F.reverse(F.regexp_replace(mask, star_edge, "")), star_edge, ""))
        return F.when(lead == word, word).otherwise(F.concat(lead, core, tail))

    def redaction(match: Column, pos: Column) -> Column:
        entity = F.get(F.col("entities"), match["ent"])
        # bound once: the pieces of a mask refer to the run in several places
        run = F.slice(F.col(page_words), pos - match["offset"] + 1, F.size(words(entity["original"])))
        mask = let(run, lambda r: mask_piece(entity["masked"], r, match["offset"]))
        if keep_punctuation:
            mask = let(mask, lambda m: kept(F.get(F.col(page_words), pos), m))
        return F.when(
            match.isNotNull(),
            F.struct(match["ent"].alias("ent"), mask.alias("masked"), entity["category"].alias("category")),
        )

    return matched.withColumn("redactions", F.transform("matched", redaction)).drop("matched")


def redaction_rows(pages: DataFrame, keys: Sequence[str], page_words: str = "words") -> DataFrame:
    """One row per masked word."""
    hits = items(pages, [*keys, page_words], "redactions", "r")
    return hits.select(
        *keys, "r.ent", "pos", F.get(F.col(page_words), F.col("pos")).alias("original_word"), "r.masked", "r.category"
    )


def redaction_boxes(pages: DataFrame, keys: Sequence[str], boxes: str = "boxes", page_words: str = "words") -> DataFrame:
    """``redaction_rows`` with the box of each word, where the page has boxes; empty boxes are skipped."""
    hits = items(pages, [*keys, page_words, boxes], "redactions", "r")
    box = F.get(F.col(boxes), F.col("pos"))
    return hits.select(
        *keys, "r.ent", "pos",
        *[box[f].alias(f) for f in ("x0", "y0", "x1", "y1", "fontname", "fontsize")],
        "r.category", "r.masked", F.get(F.col(page_words), F.col("pos")).alias("original_word"),
    ).filter((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))


def boxes_of(pages: DataFrame, boxes: str = "boxes") -> Column:
    """``redactions`` with the box of their word, as an array without the words themselves."""
    placed = F.transform(
        F.coalesce(F.col("redactions"), F.array().cast(pages.schema["redactions"].dataType)),
        lambda r, i: F.when(
            r.isNotNull(),
            F.struct(
                r["ent"].alias("ent"), i.alias("pos"), *[F.get(F.col(boxes), i)[f].alias(f) for f in ("x0", "y0", "x1", "y1", "fontname", "fontsize")],
                r["category"].alias("category"), r["masked"].alias("masked"),
            ),
        ),
    )
    return F.array_compact(placed)


def redaction_count(pages: DataFrame) -> DataFrame:
    """Masked words over all pages: one row."""
    per_page = F.size(F.filter(F.coalesce("redactions", F.array()), lambda r: r.isNotNull()))
    return pages.agg(F.coalesce(F.sum(per_page), F.lit(0)).alias("n_redactions"))


def redacted_text(pages: DataFrame, text: str = "page_content", page_words: str = "words") -> DataFrame:
    """``redacted``: page text of the masked words; a page without redactions keeps its text as it is."""
    masked = F.zip_with(F.col(page_words), F.col("redactions"), lambda w, r: F.coalesce(r["masked"], w))
    hit = F.exists("redactions", lambda r: r.isNotNull())
    return pages.withColumn("redacted", F.when(hit, F.array_join(masked, " ")).otherwise(F.col(text)))


def redact(
    pages: DataFrame,
    text: str = "page_content",
    repeat: bool = True,
    loose: bool = True,
    keep_punctuation: bool = True,
) -> DataFrame:
    """Text in, redacted text out, for pages that carry ``entities``; the safe choices by default."""
    cut = with_words(pages, text)
    return redacted_text(with_redactions(cut, "words", repeat, loose, keep_punctuation), text)


def _folded(text: str) -> str:
    """One blank between words, which ``text.words`` parts as ``str.split`` does."""
    return " ".join(text.split())


# Up to as many different entities a page is searched for one after the other.
_FEW = 8


def _contained(text: str, entities: list[str]) -> list[bool]:
    """Which of the entities stand in the text, all of them in one pass over it."""
    text, entities = _folded(text), [_folded(e) for e in entities]
    wanted = {e for e in entities if len(e) > 2}
    if len(wanted) <= _FEW:
        found = {e for e in wanted if e in text}
    else:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entity in wanted:
            machine.add_word(entity, entity)
        machine.make_automaton()
        found = {entity for _, entity in machine.iter(text)}
    return [e in found for e in entities]


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _shown(texts: pa.Array, entities: pa.Array) -> pa.Array:
    found = [
        _contained(text, listed) if text is not None and listed is not None else None
        for text, listed in zip(texts.to_pylist(), entities.to_pylist(), strict=True)
    ]
    return pa.array(found, pa.list_(pa.bool_()))


def leaked(output: Column, entities: Column) -> Column:
    """Entities still readable in the output: case and line breaks do not hide one.

    All entities of a page are searched at once, in time that grows with its text, their lengths and the hits.
    Only pages with entities are handed to Python. An output that is NULL shows nothing. Where the output comes
    from ``redact`` in the same select, use ``with_leaked``.
    """
    some = F.size(entities) > 0
    originals = F.when(some, F.transform(entities, lambda e: F.coalesce(F.lower(e["original"]), F.lit(""))))
    shown = _shown(F.when(some, F.lower(output)), originals)
    return F.when(some, let(shown, lambda s: F.filter(entities, lambda e, i: F.coalesce(F.get(s, i), F.lit(False))))).otherwise(
        F.filter(entities, lambda e: F.lit(False))
    )


def leaks(pages: DataFrame, keys: Sequence[str], output: str = "redacted") -> DataFrame:
    """One row per entity of a page that its output still shows."""
    return items(pages, keys, leaked(F.col(output), F.col("entities")), "leak").select(
        *keys, "leak.original", "leak.category"
    )


def with_leaked(pages: DataFrame, output: str = "redacted", name: str = "leaked") -> DataFrame:
    """Pages with what their output still shows.

    The rows pass a generator first: in one projection Spark would compute the output twice, and it does not
    plan two Python steps there of which one needs the other inside a lambda.
    """
    rows = pages.select(F.explode(F.array(F.struct(*pages.columns))).alias("_page")).select("_page.*")
    return rows.withColumn(name, leaked(F.col(output), F.col("entities")))


def without_leaks(pages: DataFrame, output: str = "redacted") -> DataFrame:
    """Gate: only the pages whose output shows none of their entities."""
    told = F.struct(F.struct(*pages.columns).alias("row"), F.size(leaked(F.col(output), F.col("entities"))).alias("n"))
    return pages.select(only(told, lambda t: t["n"] == 0).alias("page")).select("page.row.*")
