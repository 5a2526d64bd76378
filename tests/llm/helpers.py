"""Small tables with the awkward rows every operator has to take."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

PROSE = (
    "The quick brown fox jumps over the lazy dog while seven wizards quietly mix a potion of "
    "bright green herbs near the old stone bridge and nobody in the village minds the smoke "
    "because the harvest was good, the cellar is full, the children sing, and the long winter "
    "that everyone feared has turned into a mild and friendly season after all these years."
)


def awkward(spark, rows=None, clash=()):
    """doc_id, text and further columns, some named like results of an operator."""
    rows = rows or [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, PROSE),
        (4, PROSE),
        (None, PROSE),
        (None, None),
        (7, "one two"),
        (8, (PROSE + "\n") * 40),
        (9, "x" * 30_000),
        (10, "日本語 текст   é́ 😀 " * 30),
    ]
    fields = "doc_id bigint, text string" + "".join(f", `{c}` string" for c in clash)
    data = [(*r, *[f"own {c}" for c in clash]) for r in rows]
    return spark.createDataFrame(data, fields)


def nothing(spark, fields="doc_id bigint, text string"):
    return spark.createDataFrame([], fields)
