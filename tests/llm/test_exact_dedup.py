import hashlib

from pagemill.llm import exact_dedup

from .helpers import UPPER_TO_LOWER, clashing, docs, rows

TEXTS = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "abc"), (9, "x" * 200_000), (9, "x" * 200_000)]


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault((t or "").translate(UPPER_TO_LOWER), []).append(i)
    out = []
    for i, t in pairs:
        norm = (t or "").translate(UPPER_TO_LOWER)
        ids = groups[norm]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_equal_brute_force(spark):
    got = exact_dedup.groups(clashing(docs(spark, TEXTS))).drop("suspected")
    assert sorted(rows(got), key=str) == brute(TEXTS)


def test_shuffled_filter_gives_the_same(spark):
    got = exact_dedup.groups(docs(spark, TEXTS), limit=0).drop("suspected")
    assert sorted(rows(got), key=str) == brute(TEXTS)


def test_unique_rows_pass_straight(spark):
    pairs = [(i, f"text number {i}") for i in range(3000)] + [(5000 + i, "copy") for i in range(1500)]
    got = exact_dedup.groups(docs(spark, pairs))
    assert sorted(rows(got.drop("suspected")), key=str) == brute(pairs)
    unique = got.filter("group_size = 1")
    assert unique.filter("suspected").count() < 0.1 * unique.count()
    assert got.filter("group_size > 1 AND NOT suspected").count() == 0


def test_dedup_keeps_one_row_with_all_columns(spark):
    df = clashing(docs(spark, TEXTS))
    got = exact_dedup.dedup(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id for r in got.collect())) == [2, 3, 5, 6, 7, 9]


def test_empty_table(spark):
    assert exact_dedup.groups(docs(spark, [])).count() == 0
    assert exact_dedup.dedup(docs(spark, [])).count() == 0
