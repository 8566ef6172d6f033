"""A small table with every awkward case: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

DDL = "doc_id long, text string, lang string, source string, n_chars long, extra string, q string"


def prose(rng, n, vocab=400):
    words = [f"w{k}x" for k in range(vocab)]
    out = []
    for k in range(n):
        out.append(rng.choice(("the", "of", "and", "to")) if rng.random() < 0.25 else rng.choice(words))
        if k % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


def awkward(seed=3):
    rng = random.Random(seed)
    rows = []

    def add(i, text, lang="en", source="a", extra=None):
        rows.append((i, text, lang, source, len(text) if text is not None else None, extra, "q"))

    base = [prose(rng, rng.randint(60, 300)) for _ in range(30)]
    for i, t in enumerate(base):
        add(i, t, rng.choice(("en", "de")), rng.choice("abc"))
    add(100, None)
    add(101, "")
    add(102, " \t\n ")
    add(103, "one two three")
    add(104, "one two three")
    add(105, "ONE two Three", None, None)
    add(106, base[0])  # exact copy
    add(107, base[0].replace("the", "a", 1))  # near copy
    add(108, prose(rng, 9000), "en", "b")  # long
    add(109, "x" * 5000)
    add(110, "é ü ß ñ   x y", "de", "c")
    add(5, base[5])  # repeated row
    add(None, base[6], "en", None)
    return rows
