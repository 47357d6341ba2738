"""Small document tables for the tests of the document operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names the operators use inside.
CLASHING = ["fp", "digest", "key", "size", "row", "n", "first", "pos", "component_id", "quality", "copies"]

WORDS = [f"{a}{b}" for a in ("ta", "re", "mo", "li", "su", "ne") for b in ("n", "rk", "ve", "st", "lo", "de")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def prose(seed, n_docs, words=80):
    """Texts with exact copies, near copies and a shared passage."""
    rng = random.Random(seed)
    shared = sentence(rng, 40)
    texts = []
    for i in range(n_docs):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.4:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 2)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append(" ".join(own))
        else:
            parts = [sentence(rng, rng.randint(3, words)) for _ in range(3)]
            if kind > 0.8:
                parts.insert(rng.randrange(4), shared)
            texts.append("\n".join(parts))
    return texts


def table(spark, texts, ids=None, extra=False):
    rows = [
        (i, t, "en", f"src{k % 3}" if k % 7 else None, len(t or ""))
        for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))
    ]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"other {c}") for c in CLASHING})
    return df


def odd_rows():
    """(ids, texts): nulls, blanks, repeated rows, one long text, repeated ids."""
    long_text = "\n".join(sentence(random.Random(5), 400) for _ in range(60))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (None, "a row without an id that has seven words and more"),
        (None, None),
        (4, long_text),
        (5, "short"),
        (6, "the same row is there two times in this table, word for word"),
        (6, "the same row is there two times in this table, word for word"),
        (7, "the same row is there two times in this table, word for word"),
        (8, "Ünïcödé wörds and 数字 and emoji 🙂 " * 5),
        (8, "another text under an id that is there already"),
        (9, "x" * 5_000),
    ]
    return [r[0] for r in rows], [r[1] for r in rows]
