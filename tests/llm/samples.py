"""Small awkward tables: nulls, empty and long texts, repeated rows, clashing columns."""

import random

SYLLABLES = "ka lo mi ren tas vel dor sim pa ne ru th on er an it".split()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words)
    )


def awkward(spark, clashing, extra=()):
    """Documents of every awkward kind, with further columns of the given names."""
    rows = [
        (1, prose(1, 40)),
        (2, prose(2, 300)),
        (3, ""),
        (4, None),
        (5, "  \n\t "),
        (6, "Ünïcödé ß 'S don't 12,5 <|endoftext|> İ ΣΣ \x1c x"),
        (7, "12345 678 !!"),
        (8, "word " * 30_000),
        (9, "x" * 60_000),
        (None, prose(3, 30)),
        (None, None),
        (2, prose(2, 300)),
        (2, prose(4, 50)),
        (10, prose(2, 300)),
        *extra,
    ]
    schema = "doc_id long, text string" + "".join(f", `{c}` string" for c in clashing)
    rows = [(*row, *["clash"] * len(clashing)) for row in rows]
    return spark.createDataFrame(rows, schema).repartition(3)


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)


def values(frame, *columns):
    """Rows in an order that bears nulls and nested values."""
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
