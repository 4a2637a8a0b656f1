"""Awkward documents, and the rows of a DataFrame as plain values."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = DOCS + ", at int, content string, shard string, tie double, body int"


def frame(spark, texts, ids=None, extra=False):
    """Documents of the given texts; ``extra`` adds columns with names the operators use inside."""
    rows = [(i, t, "en", "s0", None if t is None else len(t)) + ((1, "x", "y", 2.0, 3) if extra else ())
            for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, EXTRA if extra else DOCS)


def awkward_texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta", "epsilon", "zeta", "eta", "theta", "naïve", "straße"]
    prose = [" ".join(rng.choices(words, k=n)) for n in (1, 4, 5, 30, 300)]
    return [None, "", " ", "\n\n  \n", "a", "don't  stop\n\n it's", "x\ty\r\nz\x1c q\x85w  é",
            "<|endoftext|> in the <|startoftext|>middle<|endoftext|>", "日本語 テキスト 🙂🙂",
            "word" * 3000, *prose, prose[3], prose[3], " ".join(rng.choices(words, k=9000))]


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]
