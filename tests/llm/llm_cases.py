"""Rows that the operators' tests share."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside: they must not clash.
        *(T.StructField(c, T.StringType()) for c in ("n_words", "score", "block", "h", "node", "row", "kept_text", "shard", "bits")),
    ]
)


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ru", "té", "sol"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edge_rows():
    """Nulls, empty and very long texts, ties, copies, repeated rows and shared passages."""
    rng = random.Random(5)
    base = [sentence(rng, n) for n in (3, 25, 60, 200, 400)]
    passage = sentence(rng, 50)
    near = base[3].split()
    near[100] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \n\t \r\x0b\x0c "), (None, base[2]), (None, None),
        (10, base[0]), (11, base[1]), (12, base[2]), (13, base[3]), (14, base[4]),
        (15, base[3]), (16, base[3]), (16, base[3]), (17, " ".join(near)),
        (18, sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 30)),
        (19, sentence(rng, 10) + " " + passage), (20, passage + " " + passage),
        (21, "a " * 300), (22, "same line\n" * 40), (23, sentence(rng, 30_000)), (24, "x" * 50_000),
        (25, " odd space\x1cand <|endoftext|> in 'it's' text \U0001f469‍\U0001f469"),
    ]
    return [(d, t, rng.choice(["en", "de", None]), rng.choice(["src0", None]), len(t) if t else None, *["z"] * 9) for d, t in rows]


def plain(df):
    """(doc_id, text) pairs of a table."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
