"""Small corpora with the cases that the operators must survive."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)``."""
    full = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def word(rng):
    return "".join(rng.choice(("ka", "lo", "mi", "tu", "ren", "sol")) for _ in range(rng.randint(1, 4)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


def corpus(seed=3, n=60):
    """Texts with copies, near copies, shared passages, odd white space, empty and null ones, and repeated rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    rows = []
    for i in range(n):
        kind = rng.randrange(8)
        text = "\n".join(sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 5)))
        if rows and kind == 0:
            text = rng.choice(rows)[1]
        elif rows and kind == 1 and (old := rng.choice(rows)[1]):
            words = old.split(" ")
            words[rng.randrange(len(words))] = "Xö"
            text = " ".join(words)
        elif kind == 2:
            text = f"{text} {passage}\n{sentence(rng, 5)}"
        elif kind == 3:
            text = rng.choice(("", " \t\n", "É ß ÀB", "a", None, "tab\tand  two\r\nspaces ", "x" * 300))
        rows.append((i * 3 + 1, text, rng.choice(("en", "de", None)), rng.choice(("a", "a", "a", "b", "ç", None))))
    rows.append(rows[5])  # a repeated row
    rows.append((None, sentence(rng, 12), "en", "a"))
    return rows


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
