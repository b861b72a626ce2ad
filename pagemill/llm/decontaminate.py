"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash containment.

Both sides are sets of five-word shingles, known by a hash. An item counts as contained if the
document has at least 80 % of its shingles. Items are partitioned by size (powers of two), and each
partition has its own sketch length: the K smallest hashes of an item, where K is one more than
the largest number of shingles that an item of the partition may miss, and ``SPARE`` more. An item
with n shingles of which m may miss has then at least K - m of its minima in any document that
contains it: that many hits make a candidate, and no contained item is ever missed. Documents
are far larger than items, so they need no sketch of their own: the shingles above the largest
minimum are left out, the rest is looked up. Candidates are verified on the shingles' words.

Defined results. Words are runs of letters and digits, lower-cased. A text of one to four words is one
shingle of its own length; a text without words (null, empty) contains nothing and is contained
in nothing. Repeated items are reported each; an item without id is reported with a null id.
Repeated documents with one id and text are one. Null ids of documents are told apart by text.
Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import as_struct, small, stored, unnest, whole_text

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Minima beyond those that a contained item may miss: more of them leave fewer chance candidates.
SPARE = 2


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(whole_text(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _starts(word_list: Column) -> Column:
    """Positions at which a shingle starts."""
    last = F.greatest(F.size(word_list) - SHINGLE_WORDS, F.lit(0))
    return F.when(F.size(word_list) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(word_list: Column) -> Column:
    """Distinct hashes of a text's shingles. Positions past the end are null and leave the hash as it is."""
    return F.array_distinct(F.transform(_starts(word_list), lambda i: F.xxhash64(*[F.get(word_list, i + k) for k in range(SHINGLE_WORDS)])))


def shingle_texts(word_list: Column) -> Column:
    """The same shingles in words."""
    return F.array_distinct(F.transform(_starts(word_list), lambda i: F.concat_ws(" ", F.slice(word_list, i + 1, SHINGLE_WORDS))))


def _needed(n: Column) -> Column:
    """Shingles that a document must share with an item of n; integers, as 0.8 has no exact double."""
    return F.ceil(n * F.lit(int(CONTAINMENT * 100)) / F.lit(100)).cast("int")


def sketches(items: DataFrame, item_id: str, text_col: str) -> DataFrame:
    """Per item: _item (a number of its own), item_id, shingles, n, needed, minima, hits (minima that a containing document has)."""
    base = items.select(F.col(item_id).alias("item_id"), words(F.col(text_col)).alias("w"))
    sized = base.select("item_id", shingle_texts(F.col("w")).alias("shingles"), F.array_sort(shingle_hashes(F.col("w"))).alias("sorted"))
    sized = sized.filter(F.size("sorted") > 0).withColumn("n", F.size("sorted")).withColumn("needed", _needed(F.col("n")))
    largest = (F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1).cast("int")
    length = F.least(F.col("n"), largest - _needed(largest) + SPARE)
    sized = sized.withColumn("minima", F.slice("sorted", F.lit(1), length)).withColumn("hits", F.size("minima") - (F.col("n") - F.col("needed")))
    return sized.select(F.monotonically_increasing_id().alias("_item"), "item_id", "shingles", "n", "needed", "minima", "hits")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("_id"), F.xxhash64(whole_text(F.col(text_col))).alias("_hash")]


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["_id"].eqNullSafe(b["_id"]) & (a["_hash"] == b["_hash"])


def candidates(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _hash, _item) with enough minima of the item in the document."""
    minima = stored(known.select("_item", "hits", F.explode("minima").alias("h")))
    facts = minima.agg(F.max("h"), F.count(F.lit(1))).first()
    cut, count = (facts[0] if facts[0] is not None else -(2**63)), facts[1]
    listed = docs.select(*_keyed(docs, id_col, text_col), words(F.col(text_col)).alias("w"))
    low = F.filter(shingle_hashes(F.col("w")), lambda h: h <= F.lit(cut))
    probes = listed.select("_id", "_hash", F.explode(low).alias("h"))
    found = probes.join(small(minima, count, 64), "h")
    return found.groupBy("_id", "_hash", "_item").agg(F.count(F.lit(1)).alias("c"), F.first("hits").alias("hits")).filter("c >= hits").select("_id", "_hash", "_item")


def _contained(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str) -> DataFrame:
    known = stored(sketches(items, item_id, item_text))
    pairs = stored(candidates(docs, known, id_col, text_col))
    total = pairs.count()
    wanted = small(pairs.select("_id", "_hash").distinct(), total, 48)
    texts = docs.select(*_keyed(docs, id_col, text_col), F.col(text_col).alias("_text"))
    texts = texts.join(wanted, _same(texts, wanted), "left_semi").dropDuplicates(["_id", "_hash"])
    sets = texts.select("_id", "_hash", words(F.col("_text")).alias("w")).select("_id", "_hash", shingle_texts(F.col("w")).alias("has"))
    asked = small(pairs, total, 48)
    both = sets.join(asked, _same(sets, asked)).select(sets["_id"], sets["_hash"], "has", "_item")
    size = known.agg(F.sum(F.size("shingles"))).first()[0] or 0
    both = both.join(small(known.select("_item", "item_id", "shingles", "n", "needed"), size, 96), "_item")
    shared = F.size(F.array_intersect("has", "shingles"))
    judged = both.select("_id", "_hash", "item_id", F.col("n").alias("item_shingles"), shared.alias("shared"), "needed")
    return judged.filter("shared >= needed").drop("needed")


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, containment) for every item that a document contains."""
    found = _contained(docs, items, id_col, text_col, item_id, item_text)
    return found.select(
        F.col("_id").alias("doc_id"), "item_id", F.col("item_shingles").cast("long"), F.col("shared").cast("long"),
        (F.col("shared") / F.col("item_shingles")).alias("containment"),
    )


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, with all their columns."""
    hit = stored(_contained(docs, items, id_col, text_col, item_id, item_text).select("_id", "_hash").distinct())
    listed = small(hit, hit.count(), 48)
    rows = docs.select(as_struct(docs).alias("_row"), *_keyed(docs, id_col, text_col))
    return unnest(rows.join(listed, _same(rows, listed), "left_anti"), "_row", docs.columns)
