"""Fixtures that the operator tests share."""

import string

UPPER_TO_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=DOC_SCHEMA, parts=3):
    """A documents table from texts or (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
    return spark.createDataFrame(rows, schema).repartition(parts)


def clashing(df):
    """The table with more columns, named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["keep_id", "kept", "fp", "root", "word", "bits", "_row", "_id", "_hash", "row", "score", "size", "shard", "key", "n", "item_id", "hashes"]
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


def rows(df):
    return [tuple(r) for r in df.collect()]


def unions(pairs, ids):
    """Smallest member of each id's component."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
