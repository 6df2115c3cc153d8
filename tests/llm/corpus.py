"""A small corpus with every awkward case: nulls, empty and long texts, ties, copies, clashing columns."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, shard string"
VOCAB = ["".join(random.Random(i).choices("abcdefghijklmnop", k=3)) + str(i % 7) for i in range(4000)]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(rng.choice(VOCAB))
        if rng.random() < 0.08:
            out[-1] += rng.choice([".\n", ",", "!", "\n", ".\t "])
    return " ".join(out)


def corpus(seed=3, n=60):
    """Rows of SCHEMA; the passage of 70 words and the two lines stand in several documents."""
    rng = random.Random(seed)
    passage, lines = prose(rng, 70).replace("\n", " "), [prose(rng, 6).replace("\n", " ") for _ in range(4)]
    texts = []
    for i in range(n):
        t = prose(rng, rng.choice([3, 8, 30, 60, 120, 300]))
        if i % 5 == 1:
            t = t + " " + passage + " " + prose(rng, 20)
        if i % 6 == 2:
            t = t + "\n" + "\n".join(lines[:3]) + "\n" + prose(rng, 5)
        if i % 4 == 3 and texts:
            w = (rng.choice(texts) or "x").split(" ")
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            t = " ".join(w)
        texts.append(t)
    texts += [None, "", " \t\n ", "one", "Two words", "a b c", "Über Straße été", lines[0], texts[0], texts[0].upper(),
              prose(rng, 9000), "same " * 400, "\n\n\n" + "\n".join(lines * 2), "é" * 300 + " ü", " ".join(["x"] * 60)]
    rows = [(i * 3 % 997, t, "en", rng.choice(["b", "a", "a", "a", "é", None]), len(t or ""), "r", "k", "s")
            for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], rows[3], (None, texts[5], "en", "a", 0, None, None, None), (None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows
