"""Small tables with the awkward cases, and plain versions of the operators' rules."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANKS = "\t\n\x0b\x0c\r "


def words_of(text: str | None) -> list[str]:
    for c in BLANKS:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def lower_ascii(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(60)) for _ in range(n))


def awkward_texts() -> list[str | None]:
    """Copies, near copies, repeated passages, NULL, blank, short, very long, control bytes and letters beyond ASCII."""
    base = prose(1, 120).split()
    near = base[:60] + ["changed"] + base[61:]
    passage = " ".join(prose(2, 45).split())
    return [
        " ".join(base),
        " ".join(near),
        " ".join(base),
        "LINE one of the Text here\n" + prose(3, 50) + "\nline ONE of the text here",
        prose(4, 20) + " " + passage + " " + prose(5, 30),
        prose(6, 33) + "\n" + passage + "\t" + prose(7, 10),
        None,
        "",
        " \n\t ",
        "one",
        "one two",
        "été à la plage " * 40,
        "x" * 400 + "\x00" + "x" * 300,
        "a b \U0001f600 c",
        prose(8, 9000),
        passage + "\r\n" + passage,
        "\n".join([prose(9, 12)] * 3 + [prose(9, 12) + " more"]),
    ]


def awkward_rows() -> list[tuple]:
    texts = awkward_texts()
    rows = [(i, t, ["en", "fr", None][i % 3], ["h1", "h2", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[4], (None, texts[0], None, None, None), (None, None, None, None, None), (-5, texts[4], "en", "h1", 1)]


def awkward(spark, more: bool = False):
    """The rows as a table; with ``more`` also columns that carry names the operators use."""
    df = spark.createDataFrame(awkward_rows(), DOC_SCHEMA)
    if more:
        for name in ("h", "key", "gone", "host", "body", "digest", "piece", "anchor", "kept", "n_words", "lines", "base_failed"):
            df = df.selectExpr("*", f"'extra' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
