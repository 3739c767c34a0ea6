"""Fixtures of awkward documents, the same for every operator."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = {"size": "lit(1)", "kept": "'x'", "shard": "lit(2)", "h": "lit(3)", "row": "lit(4)", "ids": "'y'", "spans": "lit(5)", "n_lines": "lit(6)", "copies": "lit(7)", "score": "lit(8)", "base": "'b'", "node": "lit(1)"}
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards boil strange green soup in copper kettles near old harbour walls".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randrange(1000)) if r.random() < 0.2 else "") for _ in range(n))


def awkward():
    """Nulls in every column, empty and very long texts, repeated rows and texts, odd white space, wide characters."""
    shared = "This very line is shared by many documents of the table, word for word."
    rows = [
        (0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n\x0b ", "en", None, 5), (None, "a text without an id", "en", "a", 20), (3, "123 456 !!", None, "b", 10),
        (4, "Straße Ñandú 中文字符 🎉   x", "de", "b", 20), (5, "a\n\nb\n", "en", "", 5), (6, prose(20_000, 1), "en", "a", None),
    ]
    rows += [(10 + i, f"{prose(40, i)}\n  {shared.upper() if i % 2 else shared}\t\n{prose(5, 100 + i)}", "en", "a" if i % 3 else "c", 1) for i in range(7)]
    rows += [(20 + i, prose(60, 77), "en", "a", 1) for i in range(6)]  # copies
    rows += [(30 + i, prose(60, 77).replace(" ", "  ", i).replace("the", "THE", 1), "en", "a", 1) for i in range(3)]
    near = prose(120, 5).split()
    rows += [(40 + i, " ".join([*near[: 20 * i], "changed", *near[20 * i + 1 :]]), "en", "b", 1) for i in range(5)]
    rows += [(None, " ".join([*near[:30], "other", *near[31:]]), None, None, None), (None, " ".join([*near[:50], "words", *near[51:]]), None, None, None)]
    rows += [(50, "repeated row", "en", "a", 1)] * 3
    return rows


def frame(spark, rows=None, clash=True):
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    for name, value in CLASH.items() if clash else ():
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(eval(value, {"lit": lambda x: x})))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)
