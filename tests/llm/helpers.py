"""Small tables with the hard cases, shared by the operators' tests."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, t bigint, _utf8 string, _h string"
WORDS = "the of and thea reing onth erst ouned ndble tion shat hein wher anly".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", rnd.choice(WORDS)]) for _ in range(n))


HARD = [
    (1, None), (2, ""), (3, "\n\n"), (4, "   \t "), (5, "one"), (6, "One!"), (7, prose(1, 60)), (8, prose(1, 60)),
    (8, prose(1, 60)), (9, prose(1, 59) + " end"), (None, prose(2, 80)), (None, None), (10, "x" * 70_000),
    (11, ("same line here\n" * 50) + prose(3, 30)), (12, "é ü ß 日本語 \U0001f600 text İΣ"), (13, "!!! ??? ..."),
    (14, "\\### Assistant: </turn> <|end|> ok"), (15, prose(4, 6000)), (15, "another text of an equal id"),
]


def table(spark, rows=HARD):
    """Rows of (doc_id, text) with further columns whose names clash."""
    return spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t), 0.5, 7, "u", "h") for i, t in rows], SCHEMA)


def collected(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
