"""A small table with the awkward rows that every operator must take."""

WORDS = [f"w{i % 97}x{i * i % 89}" for i in range(400)]
BASE = " ".join(WORDS)
ROWS = [
    (1, BASE, "en"),
    (2, BASE.replace("w5x25", "changed", 1), "en"),
    (3, BASE, "en"),
    (3, BASE, "en"),
    (4, None, "en"),
    (5, "", None),
    (6, " \t\n \x0b\x0c\r ", "de"),
    (7, "one", "de"),
    (8, "ONE", "fr"),
    (9, "one two three four", "fr"),
    (10, "Ünïcödé 日本語 — ¿qué? 　\x85 \x1c ß İ 🙂🙂 it's we'LL", "es"),
    (11, "<|endoftext|> and <|endoftext|>", "en"),
    (None, "a row without an id " * 3, "en"),
    (None, None, None),
    (12, "x" * 5000, "en"),
    (13, "  " * 3000 + "end", "en"),
    (14, "the same line again\n" * 2500, "en"),
    (15, " ".join(f"u{i}" for i in range(30000)), "en"),
    (16, "123 456 !!! ???", None),
    (-7, "negative id", "en"),
    (1 << 40, "large id", "en"),
]
SCHEMA = "doc_id long, text string, lang string, score double, n string, rep string, sketch string, word int"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, lang, 0.5, "n", "r", "s", 1) for i, t, lang in rows], SCHEMA)


def sorted_rows(df, *columns):
    key = lambda row: tuple((v is not None, v) for v in row)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
