"""Small tables with the cases every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import types as T

WORDS = [f"{a}{b}" for a in ("ba", "ke", "mi", "no", "ru") for b in ("ra", "te", "li", "so", "du", "é")]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = rng.choice(WORDS) + rng.choice(WORDS)
        out.append(w + rng.choice(["", "", "", "", ".", ",", ".\n"]))
    return " ".join(out)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose, copies, near copies, a common passage, junk, empty, null, short and repeated rows, a null id, a long text."""
    rng = random.Random(seed)
    common = prose(rng, 55)
    texts: list[str | None] = []
    for k in range(n):
        kind = k % 6
        if kind == 1 and texts:
            texts.append(rng.choice(texts))
        elif kind == 2 and texts:
            words = (rng.choice(texts) or "x").split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind == 3:
            texts.append(prose(rng, 20) + " " + common + " " + prose(rng, rng.randint(1, 30)))
        else:
            texts.append(prose(rng, rng.randint(1, 120)))
    texts += ["", None, "   \n ", "one", "two words", "one", "the the the the the the the the the the the the", "\0 odd <|endoftext|> \x7f", prose(rng, 3000)]
    rows = [(k, t, rng.choice(["en", "de", None]), f"src{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    rows.append((None, texts[0], None, None, None))
    rows.append(rows[3])
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def clashing(df, *names: str):
    """With columns more, of names that the operators use themselves."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("other"))
    return df
