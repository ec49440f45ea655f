"""Small tables for the corpus operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those that operators add.
CLASHES = "fp long, component_id string, n_lines string, n_dropped string, hits string, lang_pred int, score string, rejected string, base string, spans string"


def prose(rnd: random.Random, n: int) -> str:
    common = ["the", "of", "And", "to", "IN", "a", "is", "that"]
    return " ".join(rnd.choice(common) if rnd.random() < 0.3 else "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6))) for _ in range(n))


def texts(seed: int = 0, n: int = 40) -> list[str | None]:
    """Prose, copies, near copies, repeated passages and lines, blank, empty, missing and long texts."""
    rnd = random.Random(seed)
    passage, line = prose(rnd, 70), "This line is licensed to all that read it."
    made: list[str | None] = [prose(rnd, rnd.randint(1, 120)) for _ in range(n)]
    for i in range(0, n, 4):
        made[i] = f"{made[i]}\n {line.upper()} \n{passage}"
    for i in range(1, n, 7):
        made[i] = f"{passage} {prose(rnd, 3)}\n{line}\t\n{line}"
    for i in range(2, n, 9):
        words = made[0].split(" ")
        words[rnd.randrange(len(words))] = "zz"
        made[i] = " ".join(words)
    return [*made, made[3], made[3], made[0], None, "", " \t\n\r\x0b\x0c ", "word", "\n\n", "é", " ".join([passage] * 40), "x" * 3000, "ab" * 700]


def rows(seed: int = 0, n: int = 40) -> list[tuple]:
    made = [(i * 3 - 6, t, ("en", "de", None)[i % 3], f"s{i % 4}", len(t or "")) for i, t in enumerate(texts(seed, n))]
    return [*made, made[5], (None, made[4][1], "en", None, None), (None, None, None, None, None)]


def documents(spark, given=None, partitions: int = 3):
    return spark.createDataFrame(rows() if given is None else given, DOCS).repartition(partitions)


def clashing(docs):
    """The table with columns that an operator might add itself."""
    return docs.selectExpr("*", *(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in CLASHES.split(", ")))
