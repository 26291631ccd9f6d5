"""Small awkward tables, and brute-force versions of what SQL cannot express."""

from __future__ import annotations

import random

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"token{i}" for i in range(60))
NEAR = BASE.replace("token30", "other")
CLASHING = "score string, row string, id string, hash long, shard string, n_words string, first string, key string"


def documents(spark):
    """Nulls in every column, empty and very long texts, copies, near copies, repeated rows, and columns of clashing names."""
    rows = [
        (1, BASE, "en", "src0"), (2, NEAR, "en", "src1"), (3, BASE, None, "src1"), (4, None, "en", None), (5, "", "en", "src2"), (6, " \n\t ", "de", "src0"),
        (7, LONG, "fr", "src3"), (8, LONG + " tail", "fr", "src3"), (None, "no id at all", "en", "src0"), (9, "Short one.", "es", "src0"), (9, "Short one.", "es", "src0"),
        (10, "short ONE.", "es", "src4"), (11, "\x00\x01 control \x1f characters", "en", "src0"), (12, "日本語 テキスト です", None, None),
    ]
    base = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return base.selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in CLASHING.split(", ")])


def root_of(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(text: str, times: int, rng: random.Random) -> str:
    letters = list(text)
    for _ in range(times):
        at, kind = rng.randrange(len(letters)), rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("abc")
        elif kind == 1:
            letters.insert(at, rng.choice("abc"))
        elif len(letters) > 3:
            del letters[at]
    return "".join(letters)
