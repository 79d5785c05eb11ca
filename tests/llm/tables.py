"""Small documents with every oddity that the operators have a defined result for."""

from __future__ import annotations

import random
import re

LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(9000))
NEAR = " ".join(f"term{i}" for i in range(60))


def odd_texts() -> list[str | None]:
    draw = random.Random(5)
    words = ["the", "The", "of", "café", "naïve", "don't", "'s", "3", "42nd", "€", "中文", "🎉", "x" * 40]
    gaps = [" ", "  ", "\n", "\t ", " ", "　", ", ", ". ", "-", ""]
    mixed = [
        "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(1, 60)))
        for _ in range(60)
    ]
    return [
        None,
        "",
        " ",
        "\n\t \r\n",
        "a",
        "a b",
        "a  b",
        "A b",
        "<|endoftext|>",
        "x <|endoftext|> y  <|startoftext|>z",
        LONG,
        LONG,
        NEAR,
        NEAR + " more",
        NEAR.replace("term30", "other"),
        NEAR.upper(),
        *mixed,
        *mixed[:9],
    ]


FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def rows() -> list[tuple]:
    """Texts under ascending ids, a null id, and a row that is there twice."""
    found = [
        (
            i * 3,
            text,
            None if i % 7 == 0 else ["en", "de"][i % 2],
            None if i % 11 == 0 else f"src{i % 4 and 1}",
            None if i % 5 == 0 else len(text or ""),
        )
        for i, text in enumerate(odd_texts())
    ]
    return [*found, (None, "no id here", "en", "src0", 10), found[4], found[-1]]


def frame(spark, values=None, extra: bool = False):
    """The rows as a table in some partitions; ``extra`` adds columns whose names operators
    use inside."""
    values = rows() if values is None else values
    made = spark.createDataFrame(values, FIELDS).repartition(3)
    if extra:
        for name in ("row", "block", "name", "node", "score", "_text", "curve", "position", "shard"):
            made = made.selectExpr("*", f"'other' AS {name}")
        made = made.selectExpr("*", "1 AS slot", "'t' AS TEXT_KEY", "array(1) AS ids")
    return made


def lower_ascii(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))
