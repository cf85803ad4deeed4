import math
import os
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from labelsieve.llm import kneser_ney as kn

from .helpers import LOWER, WORD, documents, odd_texts, prose


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "</end>"]


class Plain:
    """The model in plain Python."""

    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.uni.update(w)
            self.bi.update(zip(["<begin>", *w[:-1]], w, strict=True))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.total, self.seen, self.before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (h, w), c in self.bi.items():
            self.total[h] += c
            self.seen[h][min(c, 3) - 1] += 1
            self.before[w] += 1
        self.high, self.low = ([sum(v == k for v in x.values()) for k in (1, 2, 3, 4)] for x in (self.bi, self.before))
        self.high, self.low = kn.discounts(*self.high), kn.discounts(*self.low)
        self.mass = sum(self.cut(c, self.low) for c in self.before.values()) / max(len(self.bi), 1)

    @staticmethod
    def cut(c, d):
        return d[min(c, 3) - 1] if c else 0

    def p(self, h, w):
        b = self.before.get(w, 0)
        low = (b - self.cut(b, self.low)) / max(len(self.bi), 1) + self.mass / (self.v + 1)
        if not self.total.get(h):
            return low
        c = self.bi.get((h, w), 0)
        g = sum(d * n for d, n in zip(self.high, self.seen[h], strict=True)) / self.total[h]
        return (c - self.cut(c, self.high)) / self.total[h] + g * low

    def score(self, text):
        w = tokens(text)
        base = sum(math.log10((self.uni.get(x, 0) + 1) / (self.n + self.v + 1)) for x in w)
        return sum(math.log10(self.p(h, x)) for h, x in zip(["<begin>", *w[:-1]], w, strict=True)), base, len(w), \
            sum(x in self.uni for x in w)


def test_scores_against_the_plain_model(spark):
    train = [prose(80, i, 60) for i in range(40)] + ["", "The the THE"]
    texts = [*odd_texts(), prose(90, 777, 80), "unknown words only", train[0]]
    plain = Plain(train)
    assert math.isclose(sum(plain.p("w1", w) for w in plain.uni) + plain.p("w1", "?"), 1, rel_tol=1e-9)
    model = kn.train(documents(spark, train).repartition(5).select("text"))
    assert (model.tokens, model.vocabulary, model.pairs) == (plain.n, plain.v, len(plain.bi))
    got = {r.doc_id: r for r in kn.score(documents(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        score, base, n, known = plain.score(t)
        r = got[i]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert math.isclose(r.score, score, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9)


def test_small_flushes_and_many_shards(spark):
    train = [prose(60, i, 40) for i in range(30)]
    plain = Plain(train)
    model = kn.train(documents(spark, train).repartition(20).select("text"))
    got = {r.doc_id: r.score for r in kn.score(documents(spark, train), model).collect()}
    assert all(math.isclose(got[i], plain.score(t)[0], rel_tol=1e-9) for i, t in enumerate(train))


def test_no_training_text_and_empty_table(spark):
    model = kn.train(documents(spark, []).select("text"))
    rows = kn.score(documents(spark, ["a b", None]), model).collect()
    assert sorted((r.n_tokens, r.n_known, r.score, r.base_score) for r in rows) == [(1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert kn.score(documents(spark, []), model).collect() == []


def test_a_missing_or_cut_array_raises_by_name(spark):
    train = [prose(60, i, 40) for i in range(10)]
    model = kn.train(documents(spark, train).select("text"))
    for kind, size in (("pairs", max(model.pair_sizes)), ("words", max(map(model.word_size, range(len(model.bases)))))):
        sizes = model.pair_sizes if kind == "pairs" else [model.word_size(i) for i in range(len(model.bases))]
        name = f"{kind}-{list(sizes).index(size)}"
        path = os.path.join(model.folder, f"{name}.npy")
        array = np.load(path)
        np.save(path, array[:-1])
        kn._FILES.clear()
        with pytest.raises(Exception, match="entries, not"):
            kn.mapped(model.folder, name, size)
        os.rename(path, path + ".away")
        with pytest.raises(FileNotFoundError, match=name):
            kn.mapped(model.folder, name, size)
        with pytest.raises(Exception, match=f"(?s)lacks.*{kind}-"):
            kn.score(documents(spark, train).repartition(11), kn.replace(model, bases=model.bases)).collect()
        np.save(path, array)
        assert len(kn.mapped(model.folder, name, size)) == size
    assert len(kn.mapped(model.folder, "never", 0)) == 0


def test_more_arrays_than_descriptors(tmp_path):
    """1,100 shards under a limit of 200 open files."""
    for i in range(1100):
        np.save(tmp_path / f"pairs-{i}.npy", np.full(100, i, np.uint64))
    script = f"""
import resource, sys
resource.setrlimit(resource.RLIMIT_NOFILE, (200, 200))
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
from labelsieve.llm import kneser_ney as kn
kn.MAX_MAPPED = 100
assert all(int(kn.mapped({str(tmp_path)!r}, f"pairs-{{i}}", 100)[7]) == i for _ in range(2) for i in range(1100))
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=120)
    assert kn.MAX_MAPPED < 1024 // 2


def test_packed_blocks_round_trip():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (kn.unpack(kn.pack(keys, True), np.uint64, True) == keys).all()
    values = rng.integers(0, 1 << 40, 77)
    assert (kn.unpack(kn.pack(values), np.int64) == values).all()


def test_the_folder_must_be_mounted():
    assert kn.mounted("file:/a/b") == "/a/b"
    with pytest.raises(ValueError):
        kn.mounted("hdfs://x/y")
