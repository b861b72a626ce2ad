import random
import re

from pagemill.llm import decontaminate

from .helpers import clashing, docs, rows


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(documents, items):
    out = []
    for d, text in documents:
        has = shingles(text)
        for i, item in items:
            want = shingles(item)
            if want and 5 * len(want & has) >= 4 * len(want):
                out.append((d, i, len(want), len(want & has), len(want & has) / len(want)))
    return sorted(out)


def fixture():
    rng = random.Random(11)
    vocabulary = ["w%d" % i for i in range(400)] + ["été", "naïve", "Straße"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate((5, 6, 9, 12, 17, 30, 31, 33, 60, 64, 120))]
    items += [(50, None), (51, ""), (52, "..."), (53, "three words only"), (54, items[4][1]), (55, "same same same same same same same")]
    documents = [(1, None), (2, ""), (3, "Three, words only"), (4, "three words only more"), (5, "same " * 20)]
    for n in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 500))
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items[:11])[1].split()
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in part]
        documents.append((100 + n, " \n".join(words)))
    documents.append((99, " ".join(rng.choices(vocabulary, k=60_000)) + " " + items[5][1]))
    return documents, items


def test_equals_brute_force(spark):
    documents, items = fixture()
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute(documents, items)
    assert len(want) > 30
    got = decontaminate.contained_items(clashing(docs(spark, documents)).drop("item_id"), table)
    assert sorted(rows(got)) == want


def test_clean_drops_whole_documents_and_no_other(spark):
    documents, items = fixture()
    documents.append((None, "nothing to see"))
    documents.append((None, items[6][1]))
    documents.append((4, items[6][1]))
    table = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(docs(spark, documents))
    bad = {(d, t) for d, t in documents if brute([(d or 0, t)], items)}
    got = decontaminate.clean(df, table)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted((p for p in documents if p not in bad), key=str)


def test_sketch_guarantees_a_hit(spark):
    _, items = fixture()
    for r in decontaminate.sketches(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect():
        assert 1 <= r.hits <= len(r.minima) <= r.n and r.needed == -(-r.n * 8 // 10)


def test_empty_tables(spark):
    documents, items = fixture()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contained_items(docs(spark, []), table).count() == 0
    assert decontaminate.contained_items(docs(spark, documents[:9]), table.limit(0)).count() == 0
    assert decontaminate.clean(docs(spark, documents[:9]), table.limit(0)).count() == 9
