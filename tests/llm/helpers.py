"""Small inputs that every operator must take: nulls, empty, long, repeated, clashing columns."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n long, id string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def documents(spark, texts, sources=None, ids=None):
    """A documents table with extra columns whose names clash with those the operators use."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None if sources is None else sources[k], None, "x", 7, "y")
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def prose(n, seed=0, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_texts():
    base = prose(120, 1)
    return [None, "", "   \n\t", "one", "two words", base, base, base + " tail", "É é 　 x y", "a" * 5000,
            prose(6000, 2), "same " * 300, base.upper(), "tab\tand\x0bvt\x0cff\rcr"]
