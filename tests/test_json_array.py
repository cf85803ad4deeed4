import json
import random

import pytest
from pyspark.sql import types as T

from labelsieve.operators import ingest
from labelsieve.params import CATEGORY_IDS
from labelsieve.sources import files, json_array

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("inner", T.ArrayType(T.StringType())),
                       T.StructField("n", T.LongType())])
TRICKY = ['plain', 'a "quoted" }', "[{", "\\", "\\\\", '\\"', '"', "é\U0001F600 ", "}, {", "]" * 30, "", "\n\t", "\\u0022"]


def write(path, rows, **style):
    path.write_text(json.dumps(rows, **style))
    return str(path)


@pytest.mark.parametrize("style", [{"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_same_rows_and_order_from_any_number_of_tasks(spark, tmp_path, style):
    rng = random.Random(1)
    rows = [{"name": rng.choice(TRICKY) * rng.randrange(1, 4), "inner": [rng.choice(TRICKY) for _ in range(rng.randrange(4))], "n": i}
            for i in range(160)]
    rows[50]["name"] = "\\" * 5001 + '"' * 40  # longer than a range
    path = write(tmp_path / "a.json", rows, **style)
    size = len(open(path, "rb").read())
    seen = None
    for ranges in (1, 20):
        df = json_array.read_json_array(spark, path, SCHEMA, -(-size // ranges))
        assert df.rdd.getNumPartitions() >= ranges - 1
        got = sorted((r.position, r["name"], r.inner, r.n) for r in df.collect())
        assert [g[1:] for g in got] == [(r["name"], r["inner"], r["n"]) for r in rows]
        seen = seen or got
        assert got == seen
    raw = open(path, "rb").read()
    assert all(raw[p:p + 1] == b"{" for p, *_ in seen)


def test_every_cut_of_a_small_file(tmp_path):
    rows = [{"name": t, "inner": ["}", "{"], "n": {"x": [1, {"y": "\\"}]}} for t in TRICKY[:8]]
    path = write(tmp_path / "a.json", rows)
    raw = open(path, "rb").read()
    whole = list(json_array.records(path, 0, len(raw), False, 0))
    assert [json.loads(r) for _, r in whole] == rows
    for cut in range(1, len(raw)):
        odd, outside, _ = json_array.borders(path, 0, cut)
        parts = [*json_array.records(path, 0, cut, False, 0), *json_array.records(path, cut, len(raw), bool(odd), outside)]
        assert parts == whole, cut


def test_blocks_inside_a_range(tmp_path, monkeypatch):
    rows = [{"name": t * 3, "inner": [t], "n": i} for i, t in enumerate(TRICKY)]
    path = write(tmp_path / "a.json", rows, indent=1)
    size = len(open(path, "rb").read())
    whole = list(json_array.records(path, 0, size, False, 0))
    for block in (1, 2, 7, 64):
        monkeypatch.setattr(json_array, "BLOCK_BYTES", block)
        assert list(json_array.records(path, 0, size, False, 0)) == whole
        assert json_array.borders(path, 0, size)[:2] == (0, 0)


@pytest.mark.parametrize("text", ['{"name": "x"}', '[{"name": "x"}, 5]', '[{"name": "x"}, [1]]', '[{"name": "x"}', '[{"name": "x}]',
                                  '["x"]', '[{"name": "x"}]]', "nothing"])
def test_what_is_no_array_of_objects_raises(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    for n in (1000, 7):
        with pytest.raises(Exception, match="array|record|objects"):
            json_array.read_json_array(spark, str(tmp_path / "a.json"), SCHEMA, n).collect()


def test_empty_array_and_missing_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(" [ ] \n")
    assert json_array.read_json_array(spark, str(tmp_path / "a.json"), SCHEMA, 2).collect() == []
    with pytest.raises(Exception, match="no file"):
        json_array.read_json_array(spark, str(tmp_path / "b.json"), SCHEMA).collect()


def test_a_later_source_wins_whatever_its_positions(spark, tmp_path):
    """Positions like epoch milliseconds, and large files, stay inside their source."""
    def entry(category, at=None):
        e = {"videoName": "v-1", "name": "v-1.jpg", "labels": [{"category": category, "box2d": {"x1": 0, "y1": 0, "x2": 8, "y2": 8}}]}
        return e if at is None else {**e, "at": at}
    first = tmp_path / "first.jsonl"
    first.write_text("\n".join(json.dumps(entry("car", 1_700_000_000_000 + i)) for i in range(3)))
    second = tmp_path / "second.jsonl"
    second.write_text(json.dumps(entry("bus", 5)))
    cats = spark.createDataFrame([(i, n) for n, i in CATEGORY_IDS.items()], "class_id int, class_name string")
    ann = files.read_annotations(spark, [str(first), str(second)], multiline=False, sequence="at")
    assert [r.class_id for r in ingest.label_boxes(ann, cats).collect()] == [CATEGORY_IDS["bus"]]
    big = write(tmp_path / "big.json", [entry("car")] * 400)
    small = write(tmp_path / "small.json", [entry("truck"), entry("bus"), {"videoName": "v-1", "name": "x", "labels": None}])
    ann = files.read_annotations(spark, [big, small], range_bytes=500)
    ann.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert [r.class_id for r in ingest.label_boxes(stored, cats).collect()] == [CATEGORY_IDS["bus"]]
