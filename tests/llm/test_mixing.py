import hashlib

import duckdb
from labelsieve.llm import mixing, queries
from labelsieve.llm.oracle import ORACLE

from .helpers import WORD, documents, odd_texts, prose

SF = "/root/testdata/sf0.001"


def expected(ids, texts, sources, weights=(5, 2, 1), epochs=3, seed=42):
    size = [len(WORD.findall(t or "")) for t in texts]
    names = sorted({s for s in sources if s is not None}) + ([None] if None in sources else [])
    have = {s: sum(n for n, x in zip(size, sources, strict=True) if x == s) for s in names}
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(size)
    while True:
        free = sum(w[s] for s in names if s not in capped)
        rate = (total - sum(epochs * have[s] for s in capped)) / free if free else 0
        more = {s for s in names if s not in capped and rate * w[s] > epochs * have[s]}
        if not more:
            break
        capped |= more
    target = {s: float(epochs * have[s]) if s in capped else rate * w[s] for s in names}
    out = []
    for s in names:
        budget = int(target[s] + 0.5)
        rows = [(hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i, n) for i, n, x in
                zip(ids, size, sources, strict=True) if x == s]
        full, start = budget // have[s] if have[s] else 0, 0
        for _, i, n in sorted(rows):
            part = min(max(budget - full * have[s] - start, 0), n)
            out.append((i, n, have[s], round(target[s], 6), full * n + part))
            start += n
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def case(n=150):
    texts = odd_texts() + [prose(5 + (i * 7) % 90, i) for i in range(n)]
    sources = [None if i % 11 == 0 else "hot" if i % 2 else f"s{i % 7}é"[: 2 + i % 2] for i in range(len(texts))]
    sources[3] = ""
    return texts, sources


def test_against_the_plain_mix(spark):
    texts, sources = case()
    docs = documents(spark, texts, sources).repartition(6)
    want = expected(range(len(texts)), texts, sources)
    assert got(mixing.mix(docs)) == want
    assert got(mixing.mix(docs, rows_per_range=3)) == want  # many ranges per source
    assert all(t <= 3 * n for _, n, _, _, t in want)


def test_budgets_are_met_to_the_word(spark):
    texts, sources = case()
    rows = mixing.mix(documents(spark, texts, sources)).collect()
    for s in set(sources):
        mine = [r for r in rows if r.source == s]
        assert sum(r.taken for r in mine) == mine[0].budget


def test_rows_are_repeated_whole(spark):
    texts, sources = case()
    docs = documents(spark, texts, sources)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    want = {i: (n, t) for i, n, _, _, t in expected(range(len(texts)), texts, sources)}
    for i, (n, t) in want.items():
        times = sum(r.doc_id == i for r in rows)
        if n:
            assert abs(times * n - t) <= n / 2, (i, n, t, times)
    assert sum(r.doc_id == 5 for r in rows) == round(want[5][1] / want[5][0])


def test_no_words_and_empty_table(spark):
    assert got(mixing.mix(documents(spark, [None, ""], ["a", None]))) == [(0, 0, 0, 0.0, 0), (1, 0, 0, 0.0, 0)]
    assert mixing.mix(documents(spark, [], [])).collect() == []
    assert mixing.mixed_rows(documents(spark, [], [])).collect() == []


def test_repeated_rows(spark):
    docs = documents(spark, ["a b c", "a b c", "d", "e f"], ["x", "x", "x", "y"], ids=[1, 1, None, 2])
    rows = mixing.mix(docs).collect()
    assert len(rows) == 4 and sum(r.taken for r in rows) == 9


def test_main_path_is_native(spark):
    plan = mixing.mix(documents(spark, ["a b"], ["x"]))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted((a, b, c, round(d, 6), e) for a, b, c, d, e in con.sql(ORACLE["op7_source_mix"]).fetchall())
    assert got(queries.op7_source_mix(spark, SF)) == want
