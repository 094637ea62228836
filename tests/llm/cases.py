"""Small tables with every awkward row, shared by the operators' tests."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside or return.
    T.StructField("row", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("kept", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("number", T.LongType()), T.StructField("copy", T.LongType()),
])


def sentence(rng, words):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()) + str(rng.randint(0, 99))
                    for _ in range(words))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        texts.append(". ".join(sentence(rng, rng.randint(3, 25)) for _ in range(rng.randint(1, 8))) + ".")
    base = texts[0]
    texts += [base] * 7 + [base.replace(" ", "  \n")] + [base.replace("alpha", "ALPHA", 1), base + " end"]
    texts += [None, "", " \t\n", "x", "short one", "a b c d\x1ce", "é" * 50, "word " * 4000, "q" * 30000, "line one here\nline one here\n\nline one here"]
    out = [(i, t, "en", f"src{i % 4}" if i % 7 else ("src0" if i % 2 else None), 0, "r", 1, "k", "d", 5, 6) for i, t in enumerate(texts)]
    out.append((None, "no id at all in this row", None, None, None, None, None, None, None, None, None))
    out.append(out[3])  # a repeated row
    out.append((5, "another text under an id that is taken", "en", "é", 0, "r", 1, "k", "d", 5, 6))
    rng.shuffle(out)
    return out


def docs(spark, n=60, parts=3):
    return spark.createDataFrame(rows(n=n), DOCS).coalesce(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)
