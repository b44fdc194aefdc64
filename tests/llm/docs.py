"""Documents for the tests: plain ones, and a table of all awkward cases."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASHES = (
    "row kept size shard slot id node key count score ids posterior digest chunk number bucket u v component "
    "license path own lines text_key _row _id _key _text _own _words _lines target taken spans"
).split()


def prose(seed: int, n: int, syllables: str = "an be ca do el fi go hu is jo ka le mi no or pa") -> str:
    rnd = random.Random(seed)
    parts = syllables.split()
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n)]
    return " ".join(w + (".\n" if i % 17 == 16 else "") for i, w in enumerate(words))


def edited(text: str, seed: int, share: float) -> str:
    rnd = random.Random(seed)
    return " ".join(f"x{rnd.randint(0, 10**6)}" if rnd.random() < share else w for w in text.split(" "))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, copies and rows that repeat."""
    base, passage = prose(1, 120), prose(2, 60)
    long = prose(3, 30_000)
    rows = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base.replace(" ", "  "), "en", "b", 1),
        (3, edited(base, 1, 0.02), None, "b", None), (4, edited(base, 2, 0.02), "de", None, 4), (5, "", "en", "a", 0),
        (6, None, "en", "a", None), (7, " \t\n ", None, None, None), (8, "two words", "en", "c", 9), (9, "two words", "en", "c", 9),
        (10, long, "en", "a", 5), (11, long[:200_000] + " tail", "en", "a", 5), (None, prose(4, 80), "en", "a", 1),
        (None, prose(4, 80), "en", "a", 1), (12, prose(5, 90) + " " + passage, "en", "c", 1), (13, passage + " " + prose(6, 70), "en", "c", 1),
        (14, "the cat sat on the mat. " * 40, "en", "d", 1), (15, "éà ß 日本 🙂 " * 30, "fr", "d", 1), (16, "x" * 3000, "en", "d", 1),
        (17, "A B C D E", "en", "d", 1), (18, "a b c d e", "en", "d", 1), (19, "### $$$ %%% " * 50, "en", "", 1),
    ]
    return rows + [(100 + i, prose(100 + i, 70), "en", f"s{i % 3}", 1) for i in range(12)]


def frame(spark, rows, clashes: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.withColumns({c: F.lit(f"old {c}") for c in CLASHES}) if clashes else df


def shingles(text: str | None) -> set:
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()
