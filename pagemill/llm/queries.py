"""One registered query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.binding import let
from ..sources.tables import table, text_table
from . import decontaminate, exact_dedup, extraction, importance, licences, packing, preference, quality, sharding, simhash, substring, toxicity, vectorcodes
from .common import stored

SHARDS = 24

# Part of the ids that no label is learnt from.
HELD_OUT = "pmod(crc32(cast(cast({0} AS string) AS binary)), 4) = 2"


def tokenizer_file(name: str) -> str:
    """Path of an installed public tokenizer, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_dedup.groups(text_table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    found = extraction.extract(text_table(spark, sf, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op3_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contained_items(text_table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark"))


def quality_model(spark: SparkSession, docs: DataFrame, sf: str) -> quality.Model:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return quality.train(docs, labels, learn_from=~F.expr(HELD_OUT.format("_id")))


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = text_table(spark, sf, "documents", "doc_id", "text")
    held_out = F.coalesce(F.expr(HELD_OUT.format("doc_id")), F.lit(False))
    return quality.scores(docs, quality_model(spark, docs, sf)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def _hashed(place: Column, segment: Column) -> Column:
    """A segment hashed with its place: the xor of a side's segments is a digest that keeps their order, whatever order they come in."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", place.cast("string"), segment)), 1, 15), 16, 10).cast("long")


def _digest(segment: Column, wanted: Column) -> Column:
    return F.coalesce(F.bit_xor(F.when(wanted, _hashed(F.col("place"), segment))), F.lit(0).cast("long"))


def _parts_digest(parts: Column, first: Column) -> Column:
    """The same from a gathered side: header and text of a turn after each other."""

    def turn(all_: Column) -> Column:
        hashed = F.transform(all_, lambda p, i: F.when(i % 2 == 0, _hashed(first + (i / 2).cast("int"), F.concat(p["text"], F.get(all_, i + 1)["text"]))))
        return F.aggregate(hashed, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(F.coalesce(h, F.lit(0).cast("long"))))

    return let(parts, turn)


def _learnt_chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc + F.when(p["learnt"], F.length(p["text"]).cast("long")).otherwise(F.lit(0)))


def op5_preference_formatting(spark: SparkSession, sf: str, row_chars: int = preference.ROW_CHARS) -> DataFrame:
    """Digests of the formatted rows; of pairs that do not fit into a row, of their segments."""
    turns = text_table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    rows = stored(preference.pair_segments(turns, preference.swapped_replies(turns), pair="conv_id"))
    facts = preference.measured(rows)
    pairs = preference.gathered(rows, facts, row_chars).join(facts.select("pair_id", "prompt_turns"), "pair_id")
    whole_rows = pairs.select(
        "pair_id", "prompt_turns",
        _parts_digest(F.col("prompt_parts"), F.lit(0)).alias("prompt_digest"), F.length("prompt").cast("long").alias("prompt_chars"),
        _parts_digest(F.col("chosen"), F.col("prompt_turns")).alias("chosen_digest"), _learnt_chars(F.col("chosen")).alias("chosen_learnt"),
        _parts_digest(F.col("rejected"), F.col("prompt_turns")).alias("rejected_digest"), _learnt_chars(F.col("rejected")).alias("rejected_learnt"),
    )
    side, whole = F.col("side"), F.concat("header", "text")

    def learnt(name: str) -> Column:
        return F.coalesce(F.sum(F.when((side == name) & F.col("learnt"), F.length("text").cast("long"))), F.lit(0).cast("long"))

    long = rows.join(preference.long_pairs(facts, row_chars), "pair_id", "left_semi").groupBy(F.col("pair_id"), "prompt_turns").agg(
        _digest(whole, side == "prompt").alias("prompt_digest"), F.coalesce(F.sum(F.when(side == "prompt", F.length(whole).cast("long"))), F.lit(0).cast("long")).alias("prompt_chars"),
        _digest(whole, side == "chosen").alias("chosen_digest"), learnt("chosen").alias("chosen_learnt"),
        _digest(whole, side == "rejected").alias("rejected_digest"), learnt("rejected").alias("rejected_learnt"),
    )
    return whole_rows.unionByName(long).withColumn("usable", (F.col("chosen_learnt") > 0) & (F.col("rejected_learnt") > 0))


def op6_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = licences.scan(text_table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), F.array_join("unmatched", ",").alias("unmatched"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(text_table(spark, sf, "documents", "doc_id", "text"), tokenizer_file("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(text_table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeats(text_table(spark, sf, "documents", "doc_id", "text"))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    dealt = sharding.shards_of(text_table(spark, sf, "documents", "doc_id", "text"), SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = vectorcodes.compress(text_table(spark, sf, "embeddings", "vec_id", "embedding", "label"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Model:
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return toxicity.train(docs, labels, learn_from=~F.expr(HELD_OUT.format("_id")))


def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = text_table(spark, sf, "documents", "doc_id", "text")
    held_out = F.coalesce(F.expr(HELD_OUT.format("doc_id")), F.lit(False))
    return toxicity.scores(docs, toxicity_model(spark, docs, sf)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance.resample(text_table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_preference_formatting": op5_preference_formatting,
    "op6_licence_scan": op6_licence_scan,
    "op7_packing": op7_packing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_toxicity": op12_toxicity,
    "op13_importance_resampling": op13_importance_resampling,
}

def _codes_sql() -> str:
    """The codebooks' rounds one after the other, distances by plain sums of squares."""

    def round_of(n: int) -> str:
        return f"""
        a{n} AS (
            SELECT vec_id, part, x, arg_min(e, d * 64 + e) AS e, min(d) AS d
            FROM (SELECT vec_id, p.part, x, e, list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)]) AS d FROM p JOIN c{n} USING (part))
            GROUP BY vec_id, part, x
        ),"""

    def means_of(n: int) -> str:
        return f"""
        m{n} AS (
            SELECT part, e, i, sum(x[i]) AS s, count(*) AS k FROM a{n}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS i) GROUP BY part, e, i
        ),
        l{n} AS (SELECT part, e, list((s - ((s % k) + k) % k) // k ORDER BY i) AS c FROM m{n} GROUP BY part, e),
        c{n + 1} AS (SELECT part, e, coalesce(l{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN l{n} USING (part, e)),"""

    return f"""
        WITH k AS (
            SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
        ),
        p AS (
            SELECT vec_id, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x FROM k, (SELECT unnest(range(16)) AS part)
        ),
        c0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c
            FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)
        ),{round_of(0)}{means_of(0)}{round_of(1)}{means_of(1)}{round_of(2)}
        books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2),
        coded AS (
            SELECT vec_id, string_agg(lower(format('{{:02x}}', e)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN k USING (vec_id), books
    """


def _licence_sql() -> str:
    """The scan in SQL: known sentences and rules as tables, the rules tried one after the other by recursion."""
    names, rules = licences.knowledge()
    keys, values = (", ".join(f"'{x}'" for x in part) for part in (names.keys(), names.values()))
    listed = ", ".join(f"({n}, '{name}', '{ids}')" for n, (name, ids) in enumerate(rules, 1))
    plain = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
    told = f"array_to_string([coalesce(m[{plain}], '') FOR s IN {{0}}], '')"
    stops = "regexp_split_to_array(regexp_replace(t, '[.;:!?]+(\\s|$)', chr(1) || '\\1', 'g'), chr(1) || '|\\n[^\\S\\n]*\\n')"
    return f"""
        WITH RECURSIVE k AS (SELECT map([{keys}], [{values}]) AS m),
        rules(n, licence, ids) AS (VALUES {listed}),
        d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        read AS (
            SELECT doc_id, 1 AS way, {told.format(stops)} AS seq FROM d, k
            UNION ALL
            SELECT doc_id, 2 AS way, {told.format("string_split(t, chr(10))")} AS seq FROM d, k
        ),
        steps AS (
            SELECT doc_id, way, 0 AS n, seq, []::VARCHAR[] AS found FROM read WHERE seq <> ''
            UNION ALL
            SELECT doc_id, way, rules.n, CASE WHEN contains(seq, ids) THEN replace(seq, ids, '|') ELSE seq END,
                   CASE WHEN contains(seq, ids) THEN list_append(found, licence) ELSE found END
            FROM steps JOIN rules ON rules.n = steps.n + 1
        ),
        ended AS (
            SELECT doc_id, list_sort(list_distinct(flatten(list(found)))) AS f,
                   list_sort(list_distinct(regexp_extract_all(string_agg(replace(seq, '|', ''), ''), '<([^>]*)>', 1))) AS u
            FROM steps WHERE n = {len(rules)} GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(array_to_string(f, ','), '') AS licences,
               coalesce(array_to_string([x FOR x IN u IF NOT list_contains(f, split_part(x, '#', 1))], ','), '') AS unmatched
        FROM d LEFT JOIN ended USING (doc_id)
    """


ORACLES = {
    "op1_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM t
    """,
    "op3_benchmark_decontamination": r"""
        WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
        b AS (SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
        ds AS (
            SELECT DISTINCT id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
            FROM d WHERE len(w) > 0
        ),
        bs AS (
            SELECT DISTINCT id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
            FROM b WHERE len(w) > 0
        ),
        sizes AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
        SELECT ds.id AS doc_id, bs.id AS item_id, n AS item_shingles, count(*) AS shared, count(*)::DOUBLE / n AS containment
        FROM ds JOIN bs USING (s) JOIN sizes ON sizes.id = bs.id
        GROUP BY ds.id, bs.id, n HAVING 5 * count(*) >= 4 * n
    """,
    "op5_preference_formatting": """
        WITH replies AS (
            SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS reply FROM conversations WHERE role = 'assistant' GROUP BY conv_id
        ),
        others AS (
            SELECT conv_id, last, coalesce(lead(reply) OVER (ORDER BY conv_id), first_value(reply) OVER (ORDER BY conv_id)) AS other FROM replies
        ),
        sides AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place, role, text AS a,
                   CASE WHEN turn = last AND role = 'assistant' THEN other ELSE text END AS b
            FROM conversations LEFT JOIN others USING (conv_id)
        ),
        cut AS (SELECT conv_id, coalesce(min(place) FILTER (WHERE a <> b), count(*))::INTEGER AS m FROM sides GROUP BY conv_id),
        shown AS (
            SELECT *, '<|' || role || '|>' || chr(10) || a || '<|end|>' || chr(10) AS x, '<|' || role || '|>' || chr(10) || b || '<|end|>' || chr(10) AS y
            FROM sides JOIN cut USING (conv_id)
        ),
        hashed AS (
            SELECT *, ('0x' || left(md5(place || ':' || x), 15))::BIGINT AS hx, ('0x' || left(md5(place || ':' || y), 15))::BIGINT AS hy FROM shown
        ),
        made AS (
            SELECT conv_id AS pair_id, m AS prompt_turns, coalesce(bit_xor(hx) FILTER (WHERE place < m), 0) AS prompt_digest,
                   coalesce(sum(length(x)) FILTER (WHERE place < m), 0)::BIGINT AS prompt_chars,
                   coalesce(bit_xor(hx) FILTER (WHERE place >= m), 0) AS chosen_digest,
                   coalesce(sum(length(a) + 8) FILTER (WHERE place >= m AND role = 'assistant'), 0)::BIGINT AS chosen_learnt,
                   coalesce(bit_xor(hy) FILTER (WHERE place >= m), 0) AS rejected_digest,
                   coalesce(sum(length(b) + 8) FILTER (WHERE place >= m AND role = 'assistant'), 0)::BIGINT AS rejected_learnt
            FROM hashed GROUP BY conv_id, m
        )
        SELECT *, chosen_learnt > 0 AND rejected_learnt > 0 AS usable FROM made
    """,
    "op6_licence_scan": _licence_sql(),
    "op11_vector_codes": _codes_sql(),
    "op13_importance_resampling": r"""
        WITH steps AS (
            SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS k
        ),
        d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ),
        b AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark
        ),
        df AS (SELECT doc_id, unnest(w) AS f FROM d),
        bytes AS (
            SELECT f, [('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen(f))] AS l
            FROM (SELECT f FROM df UNION SELECT f FROM b)
        ),
        buckets AS (
            SELECT f, xor(list_reduce(list_prepend(4294967295, l), lambda c, x: xor(c >> 8, k[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM bytes, steps
        ),
        s AS (SELECT bucket, count(*) AS s FROM df JOIN buckets USING (f) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (f) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE
                                           / ((s + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)
        ),
        weights AS (SELECT doc_id, sum(gain) AS weight FROM df JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, len(w) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN r <= (SELECT 10 * count(*) // 100 FROM ranked) THEN r END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
}
