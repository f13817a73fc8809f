"""Rows that operators must not stumble over, as tables a query can read."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, `row` string, digest string, cls int, h int, id string, k long, score string"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(words))


def documents() -> list[tuple]:
    base, other, common = prose(1, 150), prose(2, 90), prose(3, 80)
    words = base.split()
    near = " ".join([*words[:70], "changed", *words[71:]])
    far = " ".join(w if k % 4 else "x" + w for k, w in enumerate(words))
    texts = [
        (5, base), (3, base), (3, base), (None, base), (9, base.replace(" ", "\n\t ")), (11, near), (12, far),
        (20, None), (21, ""), (22, " \n"), (23, "one"), (24, "one"), (25, "one two three four"), (26, "one two three four five"),
        (None, None), (None, "nothing but a null id"), (None, "nothing but a null id"), (7, "same id"), (7, "another text"),
        (30, other + " " + common), (31, prose(4, 60) + " " + common + " " + prose(5, 60)), (32, common),
        (33, "Ä" * 300 + " é𝄞 日本語 " + "ß" * 200), (34, "Ä" * 300 + " é𝄞 日本語 " + "ß" * 200 + "!"), (35, "ab" * 3000),
        (36, prose(6, 30_000)), (37, "x" * 200_000), (38, "<|endoftext|> it's 12 o'clock  \n\n\tnow <|endoftext|>"), (-4, "negative id"),
        (39, "  ​ \x1c\x85 1٣Ⅷ²"), (40, "12345 !!"), (41, other), (42, other + "."),
    ]
    rows = []
    for k, (i, text) in enumerate(texts):
        lang, source = (None, "en", "de")[k % 3], (None, "", "src1", "Äb", "src10", "src2")[k % 6]
        rows.append((i, text, lang, source, None if k % 5 else k, "r", "d", 1, 2, "i", 3, "s"))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
