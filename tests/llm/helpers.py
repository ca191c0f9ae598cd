"""Small tables for the tests of the operators, with every awkward case in them."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = "doc_id long, text string, score double, blk int, doc long, _order int, n_removed int, root long, held_out int, source string, n_chars long"


def prose(rnd: random.Random, words: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(words)]


def lines(words: list[str], rnd: random.Random) -> str:
    out, at = [], 0
    while at < len(words):
        step = rnd.randint(4, 14)
        out.append(" ".join(words[at : at + step]))
        at += step
    return "\n".join(out)


def corpus(seed: int = 1, size: int = 40) -> list[tuple]:
    """Texts with copies, near copies, shared passages, one very long text, and odd ones."""
    rnd = random.Random(seed)
    passage = prose(rnd, 60, 5000)
    rows = []
    for i in range(size):
        words = prose(rnd, rnd.randint(5, 220), 3000)
        if i % 4 == 1:
            at = rnd.randrange(len(words))
            words[at:at] = passage[: rnd.randint(20, 60)]
        rows.append(lines(words, rnd))
    base = prose(rnd, 160, 3000)
    for _ in range(12):
        near = list(base)
        for _ in range(rnd.randint(0, 4)):
            near[rnd.randrange(len(near))] = f"edit{rnd.randrange(10**6)}"
        rows.append(lines(near, random.Random(7)))
    rows += [rows[0]] * 6 + [rows[3]]
    rows.append(lines(prose(rnd, 6000, 6000) + base + prose(rnd, 500, 6000), rnd))
    rows += ["", None, "one", "One", "two words", "é ü   ß", "a\n\n\nb", " \t\n", "x" * 450, "ab" * 300, "same same " * 80]
    out = [(i, text, "en", f"src{i % 3}" if i % 7 else None, len(text or "")) for i, text in enumerate(rows)]
    out.append(out[5])
    out.append((None, rows[4], None, None, None))
    out.append((None, None, None, None, None))
    out.append((2, "another text under an id that is taken " * 8, "en", "src1", 0))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark, rows):
    """The same rows in a table with columns that clash with the operators' own names."""
    return spark.createDataFrame(
        [(r[0], r[1], 1.5, 7, 8, 9, 10, 11, 12, r[3], r[4]) for r in rows], AWKWARD
    )
