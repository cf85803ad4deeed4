import random
from collections import Counter

import numpy as np
import pyarrow as pa
from labelsieve.llm import recompression
from labelsieve.llm.common import tokenize

from .helpers import WORD, documents, odd_texts, prose, sha


def expected(ids, texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for i, w in zip(ids, words, strict=True):
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            if seen[tuple(w[at:at + window])] > 1:
                gone[at:at + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()], key=str)


def test_odd_texts(spark):
    texts = odd_texts()
    assert got(recompression.strip_repeats(documents(spark, texts))) == expected(range(len(texts)), texts, 35)


def test_passages_overlaps_runs_and_periods(spark):
    rng = random.Random(8)
    passages = [prose(rng.randrange(30, 90), 50 + i, 50) for i in range(6)]
    texts = []
    for i in range(120):
        parts = [prose(rng.randrange(0, 60), 1000 + i, 30)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(rng.randrange(0, 20), 2000 + rng.randrange(10**6), 30)]
        texts.append(" ".join(parts))
    texts += ["a b " * 60, "a b c " * 20 + "d", "z " * 34, "z " * 35, "z " * 36, passages[0], passages[0]]
    docs = documents(spark, texts).repartition(6)
    assert got(recompression.strip_repeats(docs)) == expected(range(len(texts)), texts, 35)


def test_settling_in_small_flushes_changes_nothing(spark, monkeypatch):
    """Keys then repeat within tasks, across flushes and across tasks."""
    texts = [prose(80, i % 3, 40) + f" end{i}" for i in range(20)]
    docs = documents(spark, texts).repartition(4)
    assert got(recompression.strip_repeats(docs)) == expected(range(20), texts, 35)


def test_same_id_with_other_text_and_empty_table(spark):
    a, b = prose(50, 1), prose(50, 2)
    ids, texts = [1, 1, 2, None, 3, 3], [a, b, a + " x", b + " y", "q", "q"]
    assert got(recompression.strip_repeats(documents(spark, texts, ids=ids))) == expected(ids, texts, 35)
    assert recompression.strip_repeats(documents(spark, [])).collect() == []


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    shared = prose(60, 9, 25)
    texts = [prose(rng.randrange(0, 40), i, 25) + " " + shared + " " + prose(rng.randrange(0, 40), 500 + i, 25)
             for i in range(60)]
    t = tokenize(pa.array(texts), lower=False)
    begin, name, place = recompression.anchors(t, 35)
    by = {}
    for i, n, p in zip(begin, name, place, strict=True):
        by.setdefault(t.hash[i:i + 35].tobytes(), set()).add((int(n), int(p - i)))
    assert all(len(x) == 1 for x in by.values())
    assert len(by) < len(begin)


def test_window_hash_depends_on_the_words_only():
    words = np.arange(200, dtype=np.uint64) % np.uint64(50)
    h = recompression.window_hashes(words, np.array([3, 53, 4]), 35)
    assert h[0] == h[1] != h[2]
