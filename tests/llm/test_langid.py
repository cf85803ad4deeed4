import math
import random

import numpy as np
import pyarrow as pa
import pytest
from labelsieve.llm import langid, queries
from labelsieve.llm.common import F

SF = "/root/testdata/sf0.001"
EN = "the of and to in that was for is with as it on he be at by this had not are but from or have an they which"
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat"


def training(spark):
    rows = [(i, (EN, DE)[i % 2], ("en", "de")[i % 2]) for i in range(20)]
    rows += [(100, None, "en"), (None, EN, "en"), (101, EN, None), (102, "", "de")]
    return spark.createDataFrame(rows, "id long, text string, lang string")


def fused(spark, rows, markup=True):
    model = langid.fit_text(training(spark))
    assert model.languages == ("de", "en")
    frame = spark.createDataFrame(rows, "page_id long, host string, text string")
    out = langid.fuse(langid.text_evidence(frame, model, markup), model.languages)
    return {r.page_id: r for r in out.select("page_id", "lang", "confidence", "declared").collect()}


def test_text_decides_and_short_texts_follow_the_other_evidence(spark):
    rows = [(i, "a.example.de", f"<html lang='de'><p>{DE}</p>") for i in range(30)]
    rows += [(100 + i, "b.example.com", f"<html lang='en'><p>{EN}</p>") for i in range(30)]
    rows += [(200, "a.example.de", "<html lang=en><script>der die das</script>" + EN),  # text beats host
             (201, "a.example.de", "<p>12</p>"), (202, "b.example.com", ""), (203, "c.example.de", None),
             (204, None, "<html lang=de>"), (205, None, None), (206, "", "x" * 200_000)]
    got = fused(spark, rows)
    assert len(got) == len(rows)
    assert [got[i].lang for i in (0, 100, 200, 201, 202, 203, 204)] == ["de", "en", "en", "de", "en", "de", "de"]
    assert got[204].declared == "de" and got[205].declared is None and got[205].lang in ("de", "en")
    assert all(0 < r.confidence <= 1 for r in got.values())


def test_host_prior_against_a_plain_computation(spark):
    rows = [(i, "h.x.org", DE) for i in range(6)] + [(10 + i, "k.x.org", EN) for i in range(3)] + [(50, "h.x.org", "")]
    got = fused(spark, rows, markup=False)
    n, unit = 10, langid.UNIT
    total = {"de": 6 * unit + unit / 2, "en": 3 * unit + unit / 2}
    base = {x: (c + unit / 2) / (n * unit + unit) for x, c in total.items()}
    domain = {x: (total[x] + langid.ALPHA * unit * base[x]) / (n * unit + langid.ALPHA * unit) for x in total}
    host = {x: ((6 * unit if x == "de" else 0) + langid.ALPHA * unit * domain[x]) for x in total}
    suffix = {x: math.log((total[x] + unit) / (total[x] + 2 * unit)) for x in total}
    score = {x: math.log(host[x] / sum(host.values())) + suffix[x] for x in total}
    want = 1 / (1 + math.exp(score["en"] - score["de"]))
    assert got[50].lang == "de" and got[50].confidence == pytest.approx(want, rel=1e-6)


def test_markup_and_hosts(spark):
    assert "track" not in langid.page_text("<script>var t='</p>';track(1)</script><!-- ad --><p>a&eacute;b</p>")
    assert langid.page_text("<p>a&eacute;b</p>").strip() == "aéb"
    urls = ["http://u:p@WWW.X.de:80/a", "https://y.org?q", "no address", None, "http://"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string").select(langid.host_of(F.col("u")).alias("h"))
    assert [r.h for r in frame.collect()] == ["www.x.de", "y.org", None, None, None]


def test_every_language_is_fitted_and_found(spark):
    rng = random.Random(6)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)] for _ in range(270)]
    # The last language has long texts only, the first one far more rows than the sample.
    text = [" ".join(rng.choices(words[i], k=5_000 if i == 269 else 40)) for i in range(270)]
    rows = [(i, t, f"l{i:03d}") for i, t in enumerate(text)] + [(1000 + k, text[0], "l000") for k in range(1500)]
    model = langid.fit_text(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert model.languages == tuple(f"l{i:03d}" for i in range(270))
    found = [" ".join(rng.choices(w, k=20)).encode() for w in words]
    raw = np.frombuffer(b"".join(found), np.uint8)
    weights = langid.text_weights(raw, np.cumsum([0, *map(len, found)]), model)
    assert weights.argmax(axis=1).tolist() == list(range(270))


def test_text_model_against_a_plain_count(spark):
    rows = [(1, "abcd", "x"), (None, "bcda", "x"), (2, "ABC" * 9_000, "y"), (3, "same", "z"), (4, "ab", "w")]
    rows += [(5, "same", "z")] * 600
    model = langid.fit_text(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert model.languages == ("w", "x", "y", "z")
    for i, lang in enumerate(model.languages):
        counts = np.full(langid.BUCKETS, 0.1)
        for _, text, of in rows[:3] if lang != "z" else rows[3:4]:
            if of == lang:
                raw = np.frombuffer(text.encode(), np.uint8)
                bucket, inside = langid.trigram_buckets(raw, np.array([0, len(raw)]))
                counts += np.bincount(bucket[inside], minlength=langid.BUCKETS)
        if lang == "z":  # equal texts: some of them, at least one
            assert set(np.flatnonzero(model.row(i) > model.other[i])) == set(np.flatnonzero(counts > 1))
        else:
            assert np.allclose(model.row(i), np.log(counts / counts.sum()), rtol=1e-12)


def test_a_long_text_is_counted_in_pieces(monkeypatch):
    text = "the quick brown fox " * 50
    batch = pa.record_batch({"lang": ["a"], "text": [text]})

    def total():
        out = {}
        for b in langid._count(iter([batch])):
            for bucket, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                out[bucket] = out.get(bucket, 0) + n
        return out
    want = total()
    monkeypatch.setattr(langid, "SLICE_BYTES", 7)
    assert total() == want and sum(want.values()) == len(text) - 2


def test_whole_suffixes_and_regions_are_evidence(spark):
    """Values of any length and form: a short text goes by the rows that share its suffix or declared language."""
    rows = [(i, f"h{i}.de.xn--p1ai", DE) for i in range(20)] + [(100 + i, f"k{i}.en.info", EN) for i in range(20)]
    rows += [(200 + i, None, f"<html lang='zz-Latn-DE'>{DE}") for i in range(20)]
    rows += [(300 + i, None, f'<html lang="zz-Latn_US">{EN}') for i in range(20)]
    rows += [(500, "q.other.xn--p1ai", "1"), (501, "q.other.info", "1"), (502, None, "<html lang='zz-latn-de'>1"),
             (503, None, "<html lang=ZZ-Latn-us>1"), (504, None, "<html lang='zz-Latn-AT'>1"), (505, None, "<html lang='toolong'>1")]
    got = fused(spark, rows)
    assert [got[i].lang for i in (500, 501, 502, 503)] == ["de", "en", "de", "en"]
    assert all(got[i].confidence > 0.8 for i in (500, 501, 502, 503))
    assert [got[i].declared for i in (502, 503, 504, 505)] == ["zz-latn-de", "zz-latn-us", "zz-latn-at", None]


def test_large_value_tables_go_through_a_shuffle(spark, monkeypatch):
    rows = [(i, f"h{i}.x{i % 30}.t{i % 11}", f"<html lang='{('de', 'en')[i % 2]}-r{i % 7}'>" + (DE, EN, "", " ")[i % 4])
            for i in range(120)] + [(900, None, None), (901, "h", "<p>")]
    small = fused(spark, rows)
    monkeypatch.setattr(langid, "checked_broadcast", lambda df: (df, False))
    assert fused(spark, rows) == small and len(small) == 122


def test_repeated_rows_are_rows(spark):
    rows = [(1, "a.b.de", DE)] * 5 + [(2, "a.b.de", "")] * 3 + [(None, None, None)] * 2
    model = langid.fit_text(training(spark))
    frame = spark.createDataFrame(rows, "page_id long, host string, text string")
    out = langid.fuse(langid.text_evidence(frame, model, False), model.languages).collect()
    assert len(out) == 10 and {(r.page_id, r.lang) for r in out} == {(1, "de"), (2, "de"), (None, "de")}


def test_no_labels_and_empty_table(spark):
    model = langid.fit_text(training(spark).limit(0))
    frame = spark.createDataFrame([(1, "h", "text")], "page_id long, host string, text string")
    out = langid.fuse(langid.text_evidence(frame, model, False), model.languages).collect()
    assert [r.lang for r in out] == [None]
    assert fused(spark, []) == {}


def test_held_out_accuracy(spark):
    rows = queries.op6_evidence_langid(spark, SF).collect()
    docs = [r for r in rows if r.doc_id is not None]
    pages = {r.page_id: r.lang for r in rows if r.page_id is not None}
    held = [r for r in docs if r.held_out]
    assert held and sum(r.lang == r.lang_label for r in held) >= 0.97 * len(held)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    right = [f"/{pages[i]}/" in u for i, u in urls.items()]
    assert sum(right) >= 0.97 * len(right)
