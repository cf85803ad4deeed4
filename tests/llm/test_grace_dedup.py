from collections import defaultdict

from labelsieve.llm import grace_dedup
from labelsieve.llm.common import F

from .helpers import documents, odd_texts, sha


def expected(ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[t or ""].append(i)
    out = []
    for i, t in zip(ids, texts, strict=True):
        have = [x for x in groups[t or ""] if x is not None]
        keep = max(have) if have else None
        out.append((i, keep, len(groups[t or ""]), i == keep, sha(t or "")))
    return sorted(out, key=str)


def rows(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=str)


def test_odd_rows_and_repeated_ids(spark):
    texts = odd_texts() + ["dup", "dup", "dup", "only"]
    ids = list(range(len(odd_texts()))) + [50, 50, None, None]
    assert rows(grace_dedup.exact_groups(documents(spark, texts, ids=ids))) == expected(ids, texts)


def test_recursion_and_weak_hashes_change_nothing(spark):
    texts = [f"text {i % 37} " * 40 for i in range(200)] + ["hot"] * 300
    docs = documents(spark, texts).repartition(5)
    tight = grace_dedup.exact_groups(docs, combine_bytes=500, bucket_bytes=3000, max_fan=3,
                                     content_hash=lambda c: F.pmod(F.xxhash64(c), F.lit(11)))
    assert rows(tight) == expected(list(range(500)), texts)


def test_every_bucket_gets_under_the_bound(spark):
    """A level divides inside its parents: 2,000 texts of 1.1 KB, at most 4 children a bucket, 20 KB a bucket."""
    texts = [f"{i:05d} " + "x" * 1100 for i in range(2000)] + ["hot " * 20_000] * 3
    rows_ = documents(spark, texts).select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("hash"),
                                           (F.octet_length("text") + 64).cast("long").alias("weight"), "text")
    seen, levels = [], 0
    for level, tasks in grace_dedup.buckets(rows_, bucket_bytes=20_000, max_fan=4):
        assert tasks <= 4
        levels += 1
        seen += level.groupBy("bucket").agg(F.sum("weight").alias("b"), F.countDistinct("hash").alias("texts"),
                                            F.collect_list("rep").alias("reps")).collect()
    assert levels > 3
    assert max(r.b for r in seen if r.texts > 1) <= 20_000
    assert sorted(x for r in seen for x in r.reps) == list(range(len(texts)))  # each row in one bucket
    assert [r.b for r in seen if set(r.reps) & {2000, 2001, 2002}] == [3 * 80_064]  # copies of one text: one entry
    got = grace_dedup.exact_groups(documents(spark, texts), bucket_bytes=20_000, max_fan=4)
    assert rows(got) == expected(list(range(len(texts))), texts)


def test_equal_hashes_are_told_apart_by_content(spark):
    texts = ["a", "b", "a", "c", ""]
    same = grace_dedup.exact_groups(documents(spark, texts), content_hash=lambda c: F.lit(1).cast("long"))
    assert rows(same) == expected(list(range(5)), texts)


def test_empty_table(spark):
    assert grace_dedup.exact_groups(documents(spark, [])).collect() == []


def test_keep_one_keeps_all_columns(spark):
    docs = documents(spark, ["x", "x", "y", None, ""], ids=[1, 2, 3, 4, 5])
    again = docs.unionByName(docs.filter("doc_id = 3"))  # a row twice goes down to one
    out = grace_dedup.keep_one(again)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 5]
