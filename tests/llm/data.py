"""Small documents with the cases every operator must survive."""

import random

ODD = [
    (1, "plain words here", "en", "a"), (2, None, "en", "a"), (3, "", "en", None), (4, " \t\n ", None, "b"),
    (5, "one", "en", "b"), (6, "one", "en", "b"), (6, "one", "en", "b"), (None, "no id at all", "en", "c"),
    (7, "Ünïcode wörds – ß\nzweite Zeile\x0bdrei", "de", "c"), (8, "x " * 30_000, "en", "a"),
    (9, "<|endoftext|> and  two   spaces \n\n here ", "en", "Z"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def odd_documents(spark):
    """With further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    for name in ("size", "position", "n_words", "score", "n", "length", "host", "words"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return [w for w in split_words(text or "") if w]


def split_words(text):
    import re

    return re.split("[\x20\x09-\x0d]+", text)


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def near_copies(seed=4, groups=6, members=12, n=120, edits=6):
    """Groups of near copies, exact copies, unrelated texts and a passage that
    many of these share."""
    rnd = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = prose(rnd, n).split()
        for _ in range(members):
            own = list(base)
            for _ in range(rnd.randrange(edits)):
                own[rnd.randrange(n)] = f"x{rnd.randrange(10_000)}"
            docs.append(" ".join(own))
    docs += docs[:5]
    passage = prose(rnd, 60)
    docs += [prose(rnd, 80) + " " + passage for _ in range(20)]
    docs += [prose(rnd, rnd.randrange(1, 12)) for _ in range(20)]
    rnd.shuffle(docs)
    return list(enumerate(docs))
