"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Extra columns whose names clash with what operators make.
    T.StructField("size", T.StringType()), T.StructField("fingerprint", T.IntegerType()), T.StructField("score", T.StringType()),
    T.StructField("component_id", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("target", T.ArrayType(T.LongType())),
])

WORDS = {
    "en": "the of and to in that is was for it with as his on be at by had not are but from or have".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
}


def sentence(lang: str, n: int, rng: random.Random) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", "ung" if lang == "de" else "ing"]) for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(4)
    rows = []

    def add(doc_id, text, lang="en", source="a"):
        rows.append((doc_id, text, lang, source, None if text is None else len(text), "x", 1, None, 7, None, [1]))

    for i in range(12):
        lang = "de" if i % 3 == 0 else "en"
        add(i, sentence(lang, 20 + 9 * i, rng) + ".\n" + sentence(lang, 12, rng), lang, "ab"[i % 2])
    add(12, None)
    add(13, "")
    add(14, " \t\n ")
    add(15, "Word")
    add(16, "two words")
    add(17, rows[5][1], "en", "b")                          # an exact copy
    add(18, rows[5][1], "en", None)                         # another, of no source
    add(19, rows[6][1].replace("the", "The"), None, "b")    # lower case alike
    add(None, "a row without an id " * 5, "en", "a")
    add(None, None, None, None)
    rows.append(rows[3])                                    # a repeated row
    rows.append(rows[3])
    add(20, sentence("en", 30_000, rng), "en", "b")         # very long
    add(21, "é漢字🙂 \x00 \x85 mixed  spaces\n\n and <|endoftext|> marks, 12.5% ...", "en", "c")
    add(-5, "a negative id", "en", "é")
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
