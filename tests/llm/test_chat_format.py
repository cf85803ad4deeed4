import random

import duckdb
from labelsieve.llm import chat_format, queries
from labelsieve.llm.oracle import ORACLE
from pyspark.sql import functions as F

from .helpers import sha

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, turns string, pieces long, formatted string"
HOSTILE = ["", None, "###", "####", "### user: ", "</turn>", "</turn></turn>", "\\", "\\\\", "\\h", "\\t###", "<\\/turn>", "\\\\h\\",
           "</tur", "n>", "#", "##", "a\nb", ": ", "é###ü</turn>\U0001F600", "\\### Assistant: </turn> ok", "x" * 50_000]


def plain(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in chats.items()}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def test_every_hostile_text_comes_back(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "assistant", "system", "", None, "a:b", "### x: ", "</turn>", "\\c", "\\", "Assistant"]
    rows = [(c, rng.choice([None, *range(30)]), rng.choice(roles), rng.choice(HOSTILE) if rng.random() < 0.6 else
             "".join(rng.choice(["#", "\\", "</turn>", "h", "t", " ", ":"]) for _ in range(rng.randrange(12))))
            for c in [None, -7, 1, 2, 3, 4] for _ in range(40)]
    rows += rows[:30]
    want = plain(rows)
    chats = chat_format.format_chats(table(spark, rows)).cache()
    got = {r.conv_id: r for r in chat_format.read_back(chats).collect()}
    spans = {r.conv_id: r for r in chats.collect()}
    digests = {r.conv_id: r for r in chat_format.digest_columns(chats).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [tuple(t) for t in got[conv].turns] == turns
        learnt = [t for r, t in turns if r == "assistant"]
        assert got[conv].learnt == learnt
        text, raw = spans[conv].formatted, spans[conv].formatted.encode()
        for s in spans[conv].loss_spans:  # both kinds of positions name the same characters
            assert text[s.start:s.start + s.length].encode() == raw[s.start_byte:s.start_byte + s.length_bytes]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:], strict=False))
        assert text.count("### ") == blocks and text.count("</turn>") == len(turns)
        d = digests[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(turns), len("".join(learnt)), len(text))
        assert d.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns)) and d.loss_sha256 == sha("".join(learnt))


def test_running_sums_over_several_chunks(spark):
    for n in (0, 1, chat_format.CHUNK, chat_format.CHUNK + 1, 3 * chat_format.CHUNK + 5):
        sizes = spark.range(1).select(F.when(F.lit(n) == 0, F.array().cast("array<bigint>")).otherwise(
            F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(n), F.lit(1)).cast("bigint"))).alias("s"))
        got = sizes.select(chat_format.running_sums(F.col("s")).alias("o")).first()["o"]
        assert got == [i * (i + 1) // 2 for i in range(n)]


def test_long_conversation(spark):
    rows = [(1, t, ("user", "assistant", "assistant")[t % 3], f"Turn {t} ###") for t in range(2_500)]
    got = chat_format.digest_columns(chat_format.format_chats(table(spark, rows))).first()
    assert got.n_turns == 2_500
    assert got.loss_sha256 == sha("".join(r[3] for r in rows if r[2] == "assistant"))


def test_no_python_in_the_plan_and_empty_table(spark):
    none = chat_format.digest_columns(chat_format.format_chats(table(spark, [])))
    assert none.count() == 0
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_against_sql(spark):
    got = queries.op12_chat_format(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE['op12_chat_format']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
