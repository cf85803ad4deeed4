import random
import re
from itertools import combinations

import numpy as np
from labelsieve.llm import components, superminhash

from .helpers import LOWER, WORD, documents, odd_texts, prose


def sets_of(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def expected(ids, texts, k, percent):
    s = {i: sets_of(t, k) for i, t in zip(ids, texts, strict=True)}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(s), 2):
        both = len(s[a] & s[b])
        if s[a] and s[b] and both * 100 >= percent * (len(s[a]) + len(s[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((i, len(s[i]), find(i), find(i) == i) for i in s)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def edited(text, rate, rng):
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split())


def test_odd_texts(spark):
    texts = odd_texts()
    for k, percent in ((3, 85), (5, 80)):
        assert got(superminhash.near_duplicates(documents(spark, texts), k, percent)) == \
            expected(range(len(texts)), texts, k, percent)


def test_chains_and_large_families_against_all_pairs(spark):
    rng = random.Random(5)
    texts = []
    for family in range(4):
        base = prose(150, 100 + family, 10**6)
        texts += [edited(base, rng.choice([0, 0.01, 0.02, 0.04]), rng) for _ in range(45)]
    chain = prose(200, 999, 10**6)
    for _ in range(25):  # neighbours are alike, the ends are not
        texts.append(chain)
        words = chain.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        chain = " ".join(words)
    rng.shuffle(texts)
    docs = documents(spark, texts).repartition(7)
    assert got(superminhash.near_duplicates(docs, 3, 85)) == expected(range(len(texts)), texts, 3, 85)


def template_pages(n, seed=8):
    """Pages that share most of their text and not enough to be linked; each other sentence is on a few of them."""
    rng = random.Random(seed)
    frame = prose(330, 31, 10**6)
    pool = [prose(12, 5000 + i, 10**6) for i in range(2 * n)]
    pages = [f"{frame} " + " ".join(rng.sample(pool, 5)) for _ in range(n)]
    return pages + [pages[0] + " end", edited(pages[1], 0.01, rng)]  # and two links


def test_template_pages_make_few_candidates(spark, monkeypatch):
    seen, real = [], superminhash.rare_pairs

    def noted(*args):
        pairs, crowded = real(*args)
        seen.append((pairs.count(), crowded.count()))
        return pairs, crowded
    monkeypatch.setattr(superminhash, "rare_pairs", noted)
    for n in (90, 180):
        texts = template_pages(n)
        out = got(superminhash.near_duplicates(documents(spark, texts).repartition(5), 3, 85))
        assert out == expected(range(len(texts)), texts, 3, 85)
    assert all(pairs <= 30 * n and crowded == 0 for (pairs, crowded), n in zip(seen, (90, 180), strict=True)), seen


def test_crowded_rare_shingles_go_through_blocks(spark, monkeypatch):
    """With groups of two at most, everything else is settled in the blocks of the buckets."""
    real = superminhash._rest
    monkeypatch.setattr(superminhash, "_rest", lambda *a: real(*a, rare_group=2))
    rng = random.Random(11)
    texts = template_pages(60)
    base = prose(120, 41, 10**6)
    texts += [edited(base, rng.choice([0.01, 0.03, 0.05]), rng) for _ in range(50)]
    assert got(superminhash.near_duplicates(documents(spark, texts).repartition(3), 3, 85)) == \
        expected(range(len(texts)), texts, 3, 85)


def test_repeated_ids_with_different_texts(spark):
    a, b, c, d = (prose(n, 71 + i, 10**6) for i, n in enumerate((150, 200, 150, 150)))
    rows = [(5, a), (5, b), (9, a), (12, a + " tail"), (20, b + " end"), (7, d), (7, c), (7, c), (30, c), (31, ""), (31, c)]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(5)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in superminhash.near_duplicates(docs, 3, 85).collect()}
    assert out[5] == (198, 5, True) and out[20] == (199, 5, False)  # the larger text of 5
    assert out[9] == (148, 9, True) and out[12] == (149, 9, False)
    # Sets of one size: either text of 7.
    assert out[31][1] == out[30][1] and out[7][1:] == (7, True)
    assert out[30][1] in (7, 30) and len(out) == 7


def test_signature_estimates_similarity_better_than_independent_hashes():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(150):
        a = rng.integers(0, 1 << 63, 80).astype(np.uint64)
        b = np.concatenate([a[:60], rng.integers(0, 1 << 63, 20).astype(np.uint64)])
        s = superminhash.signatures(np.concatenate([a, b]), np.array([80, 80]), 96)
        errors.append((s[0] == s[1]).mean() - 60 / 100)
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < np.sqrt(0.6 * 0.4 / 96)


def test_signature_is_a_minimum_over_permutations():
    """Against the plain algorithm: a shuffled array of components per element, no early stop."""
    h = np.array([5, 17, 99], dtype=np.uint64)
    m = 8
    want = np.full(m, ~np.uint64(0))
    with np.errstate(over="ignore"):
        for x in h:
            p = list(range(m))
            for j in range(m):
                draw = superminhash.mix(np.array([x + np.uint64(j + 1) * superminhash.GOLDEN]))[0]
                k = j + (int(draw >> np.uint64(32)) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                want[p[j]] = min(want[p[j]], np.uint64((j << 32) | (int(draw) & 0xFFFFFFFF)))
    assert (superminhash.signatures(h, np.array([3]), m)[0] == want).all()


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1)]
    random.Random(1).shuffle(links)
    out = components.components(spark.createDataFrame(links, "u long, v long").repartition(9))
    found = {r.id: r.component for r in out.collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 260)}}


def test_repeated_and_missing_ids_and_empty_table(spark):
    text = prose(30, 4)
    docs = documents(spark, [text, text, text, None, "b c"], ids=[3, 3, 9, None, None])
    out = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in superminhash.near_duplicates(docs, 3, 85).collect()], key=str)
    assert out == sorted([(3, 28, 3, True), (9, 28, 3, False), (None, 0, None, True), (None, 1, None, True)], key=str)
    assert superminhash.near_duplicates(documents(spark, []), 3, 85).collect() == []
    kept = superminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "3", "None", "None"]


def test_words_are_cut_at_the_stated_characters():
    assert re.findall(WORD, "a\x0bb\x85c d") == ["a", "b\x85c", "d"]
