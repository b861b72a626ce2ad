import random

from pyspark.sql import functions as F

from pagemill.llm import preference

from .helpers import clashing

SCHEMA = "pair_id long, turn long, role string, text string"


def brute(chosen, rejected):
    out = {}
    for pair in {r[0] for r in chosen} & {r[0] for r in rejected} - {None}:
        key = lambda t: tuple((x is not None, x or ("" if isinstance(x, str) else 0)) for x in (t[0],)) + tuple((x is not None, x or "") for x in t[1:])
        a, b = (sorted((r[1:] for r in side if r[0] == pair), key=key) for side in (chosen, rejected))
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1
        show = lambda t: [(f"<|{t[1] or ''}|>\n", False), (f"{t[2] or ''}<|end|>\n", t[1] == "assistant")]
        parts = [[s for t in side[n:] for s in show(t)] for side in (a, b)]
        out[pair] = (n, "".join(s for t in a[:n] for s, _ in show(t)), *parts, all(any(m for _, m in p) for p in parts))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    chosen, rejected = [], []
    for pair in range(120):
        turns = [(n, rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "b", "", None, "é" * 50])) for n in range(rng.randint(1, 7))]
        other = list(turns)
        change = rng.random()
        if change < 0.5:
            at = rng.randrange(len(other))
            other[at] = (other[at][0], other[at][1], "changed")
        elif change < 0.7:
            other = other[: rng.randint(0, len(other))]
        elif change < 0.8:
            other += [(99, "assistant", "more")]
        chosen += [(pair, *t) for t in turns]
        rejected += [(pair, *t) for t in other]
    chosen += [(500, 0, "user", "only one side"), (501, 0, "user", "x"), (501, 0, "user", "x"), (501, None, "user", "first"), (None, 0, "user", "none"), (502, 0, "assistant", "long " * 50_000)]
    rejected += [(501, 0, "user", "x"), (501, None, "user", "first"), (501, 0, "user", "x"), (None, 0, "user", "none"), (502, 0, "assistant", "short")]
    a, b = (clashing(spark.createDataFrame(x, SCHEMA).repartition(4)) for x in (chosen, rejected))
    got = {
        r.pair_id: (r.prompt_turns, r.prompt, [tuple(s) for s in r.chosen], [tuple(s) for s in r.rejected], r.usable)
        for r in preference.format_pairs(a, b).collect()
    }
    assert got == brute(chosen, rejected)


TURNS = "conv_id long, turn long, role string, text string"


def by_hand(turns):
    """Last replies passed on to the conversation before, in plain Python."""
    last = {}
    for conv, turn, role, text in turns:
        if conv is not None and role == "assistant" and turn is not None:
            last[conv] = max(last.get(conv, (turn, "", None)), (turn, text or "", text), key=lambda x: (x[0], x[1], x[2] is not None))
    ids = sorted(last)
    other = {c: last[ids[(n + 1) % len(ids)]][2] for n, c in enumerate(ids)}
    return [(c, t, r, other[c] if c in last and r == "assistant" and t == last[c][0] else x) for c, t, r, x in turns if c is not None]


def counted(rows_):
    return sorted(rows_, key=lambda t: [(x is not None, str(x)) for x in t])


def test_swapped_replies(spark):
    turns = [(2, 0, "user", "q"), (2, 1, "assistant", "own 2"), (2, 2, "user", "bye"), (3, 0, "user", "r"), (3, 1, "assistant", "first"), (3, 2, "assistant", "own 3"), (4, 0, "user", "alone"), (5, 0, "assistant", "x")]
    df = spark.createDataFrame(turns, TURNS)
    assert counted(tuple(r) for r in preference.swapped_replies(df).collect()) == counted(
        [(2, 0, "user", "q"), (2, 1, "assistant", "own 3"), (2, 2, "user", "bye"), (3, 0, "user", "r"), (3, 1, "assistant", "first"), (3, 2, "assistant", "x"), (4, 0, "user", "alone"), (5, 0, "assistant", "own 2")]
    )


def test_swapped_replies_with_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(6)
    turns = [(rng.choice([None, *range(0, 60, 3)]), rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, ""])) for _ in range(300)]
    turns += turns[:40]
    df = clashing(spark.createDataFrame(turns, TURNS)).withColumns({c: F.lit("x") for c in ("conversation", "_last", "_other", "_reply", "other", "last", "weight", "at", "said", "known")})
    got = preference.swapped_replies(df.repartition(5))
    assert got.columns == df.columns
    assert counted(tuple(r)[:4] for r in got.collect()) == counted(by_hand(turns))


def test_one_conversation_with_most_turns(spark, monkeypatch):
    """Its turns are dealt over several range partitions and numbered through."""
    rng = random.Random(7)
    turns = [(1, n, rng.choice(["user", "assistant"]), f"turn {n}") for n in range(3000)] + [(c, n, "assistant", f"{c} {n}") for c in range(2, 200) for n in range(3)]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, TURNS)
    places = preference.numbered(df, "conv_id", "turn", "role", "text")
    assert all(r.text == f"turn {r.place}" for r in places.filter("pair_id = 1").collect())
    assert places.groupBy("pair_id").agg(F.max("place").alias("m"), F.countDistinct("place").alias("n")).filter("m + 1 <> n").count() == 0
    other = df.withColumn("text", F.when((F.col("conv_id") == 1) & (F.col("turn") == 2500), "changed").otherwise(F.col("text")))
    got = {r.pair_id: r for r in preference.format_pairs(df, other, pair="conv_id", row_chars=10_000).collect()}
    assert got[1].prompt_turns == 2500 and got[1].prompt is None and got[1].chosen is None and got[5].prompt.count("<|end|>") == 3
    rows_ = preference.pair_segments(df, other, pair="conv_id").filter("pair_id = 1").groupBy("side").count().collect()
    assert {r.side: r["count"] for r in rows_} == {"prompt": 2500, "chosen": 500, "rejected": 500}


def test_query_returns_every_conversation(spark):
    from pagemill.llm.queries import op5_preference_formatting

    sf = "/root/testdata/sf0.01"
    ids = {r.conv_id for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().collect()}
    got = op5_preference_formatting(spark, sf).collect()
    assert len(got) == len(ids) and {r.pair_id for r in got} == ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    assert preference.format_pairs(none, some).count() == preference.format_pairs(none, none).count() == 0
    assert preference.swapped_replies(none, conversation="pair_id").count() == 0


def test_query_formats_every_pair_that_fits(spark, tmp_path, monkeypatch):
    """The digests come from the gathered rows; pairs too long for a row give the same from their segments."""
    from pagemill.llm.queries import op5_preference_formatting

    turns = [(c, n, "assistant" if n % 2 else "user", f"{c} says {n}" * (c % 5)) for c in range(40) for n in range(c % 7 + 1)]
    spark.createDataFrame(turns, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    given, gathered = [], preference.gathered
    monkeypatch.setattr(preference, "gathered", lambda *a: given.append(a) or gathered(*a))
    got = [sorted(tuple(r) for r in op5_preference_formatting(spark, str(tmp_path), n).collect()) for n in (preference.ROW_CHARS, 60, 0)]
    assert len(given) == 3 and len(got[0]) == 40 and got[0] == got[1] == got[2]
