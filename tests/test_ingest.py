import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from labelsieve.operators import ingest
from labelsieve.params import CATEGORY_IDS, Params
from labelsieve.sources import files


def _box(x1, y1, x2, y2):
    return {"x1": x1, "y1": y1, "x2": x2, "y2": y2}


def _record(frame, *labels, none=False):
    return {"videoName": frame, "name": frame + ".png",
            "labels": None if none else [{"category": c, "box2d": b} for c, b in labels]}


# Two boxes (one without a rectangle), an empty list, no list, a box that covers all.
RECORDS = [
    _record("k7-a", ("rider", _box(64, 36, 192, 180)), ("train", None), ("traffic sign", _box(1200, 0, 1280, 90))),
    _record("k7-b"),
    _record("k7-c", none=True),
    _record("k7-d", ("trailer", _box(0, 0, 1280, 720))),
]


def _write(tmp_path, records, name="a.json", lines=False):
    p = tmp_path / name
    p.write_text("\n".join(map(json.dumps, records)) if lines else json.dumps(records))
    return str(p)


@pytest.fixture
def categories(spark, tmp_path):
    p = tmp_path / "names.json"
    p.write_text(json.dumps(CATEGORY_IDS))
    return files.read_categories(spark, str(p))


def _read(spark, *paths):
    return files.read_annotations(spark, list(paths))


def test_boxes_files_and_counters(spark, tmp_path, categories):
    ann = _read(spark, _write(tmp_path, RECORDS))
    got = [(r.frame_id, r.box_pos, r.class_id) for r in
           ingest.label_boxes(ann, categories).orderBy("frame_id", "box_pos").collect()]
    assert got == [("k7-a", 0, 1), ("k7-a", 2, 9), ("k7-d", 0, 12)]
    assert {r.frame_id: r.n_boxes for r in ingest.labeled_frames(ann).collect()} == {"k7-a": 2, "k7-b": 0, "k7-d": 1}
    assert tuple(ingest.convert_counters(ann).first()) == (3, 1)


def test_boxes_are_normalised_by_the_image(spark, tmp_path, categories):
    rows = {(r.frame_id, r.box_pos): r for r in
            ingest.label_boxes(_read(spark, _write(tmp_path, RECORDS)), categories).collect()}
    a, d = rows["k7-a", 0], rows["k7-d", 0]
    assert (a.x_center, a.y_center, a.width, a.height) == pytest.approx((0.1, 0.15, 0.1, 0.2))
    assert (d.x_center, d.y_center, d.width, d.height) == (0.5, 0.5, 1.0, 1.0)


def test_label_texts(spark, tmp_path, categories):
    ann = _read(spark, _write(tmp_path, RECORDS))
    lines = ingest.yolo_lines(ingest.label_boxes(ann, categories))
    path = str(tmp_path / "lines")
    files.write_label_lines(lines, path)
    texts = ingest.yolo_text(spark.read.parquet(path), ingest.labeled_frames(ann))
    files.write_label_texts(texts, str(tmp_path / "text"))
    got = {r.frame_id: r.text for r in spark.read.parquet(str(tmp_path / "text")).collect()}
    assert got == {"k7-a": "1 0.100000 0.150000 0.100000 0.200000\n9 0.968750 0.062500 0.062500 0.125000", "k7-b": "",
                   "k7-d": "12 0.500000 0.500000 1.000000 1.000000"}


def test_the_later_source_wins_whatever_its_size(spark, tmp_path, categories):
    small = _write(tmp_path, [_record("dup", ("car", _box(0, 0, 8, 8))), _record("only", ("bus", _box(0, 0, 8, 8)))],
                   "first.json")
    big = _write(tmp_path, [_record(f"fill{i}", ("car", _box(0, 0, 9, 9))) for i in range(3000)]
                 + [_record("dup", ("train", _box(0, 0, 8, 8)))], "second.json")

    def classes(*paths):
        rows = ingest.label_boxes(_read(spark, *paths), categories).filter("frame_id in ('dup', 'only')").collect()
        return {r.frame_id: r.class_id for r in rows}
    assert classes(small, big) == {"dup": CATEGORY_IDS["train"], "only": CATEGORY_IDS["bus"]}
    assert classes(big, small)["dup"] == CATEGORY_IDS["car"]


def test_in_one_source_the_last_labelled_record_wins(spark, tmp_path, categories):
    recs = [_record("x", ("truck", _box(2, 2, 4, 4))), _record("x", ("rider", _box(2, 2, 6, 6)), ("rider", None)),
            _record("x", none=True)]
    rows = ingest.label_boxes(_read(spark, _write(tmp_path, recs)), categories).collect()
    assert [(r.box_pos, r.class_id) for r in rows] == [(0, CATEGORY_IDS["rider"])]


def test_json_lines_bring_their_own_order(spark, tmp_path, categories):
    recs = [{**_record("x", ("car", _box(0, 0, 2, 2))), "at": 5}, {**_record("x", ("bus", _box(0, 0, 2, 2))), "at": 3}]
    path = _write(tmp_path, recs, "a.jsonl", lines=True)
    with pytest.raises(ValueError):
        files.read_annotations(spark, path, multiline=False)
    ann = files.read_annotations(spark, path, multiline=False, sequence="at")
    assert [r.class_id for r in ingest.label_boxes(ann, categories).collect()] == [CATEGORY_IDS["car"]]


def test_unknown_category(spark, tmp_path, categories):
    ann = _read(spark, _write(tmp_path, [_record("x", ("kite", _box(0, 0, 2, 2)), ("car", _box(0, 0, 2, 2)))]))
    with pytest.raises(Exception, match="unknown category: kite"):
        ingest.label_boxes(ann, categories).collect()
    assert [(r.box_pos, r.category) for r in ingest.label_rejects(ann, categories).collect()] == [(0, "kite")]
    kept = ingest.label_boxes(ann, categories, strict=False).orderBy("box_pos").collect()
    assert [r.class_id for r in kept] == [None, CATEGORY_IDS["car"]]


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        _read(spark, str(tmp_path / "absent.json")).collect()


def _inventory(spark, n, prefix="cam"):
    return spark.createDataFrame([(f"{prefix}{i % 4}-{i:05d}",) for i in range(n)], "frame_id string")


FRACTIONS = Params(seed_fraction=0.11, unlabeled_fraction=0.64, val_fraction=0.25)


def test_splits_are_exact_disjoint_and_numbered(spark):
    m = ingest.split_frames(_inventory(spark, 137), FRACTIONS, _inventory(spark, 23, "held"))
    sizes = {r.split: r.n_frames for r in ingest.split_sizes(m).collect()}
    assert sizes == {"seed": int(137 * 0.11), "unlabeled": int(137 * 0.64),
                     "val": 137 - int(137 * 0.11) - int(137 * 0.64), "test": 23}
    assert tuple(ingest.split_invariants(m, _inventory(spark, 137)).first()) == (137, 0, 0)
    for r in m.groupBy("split").agg(F.sort_array(F.collect_list("pos")).alias("at")).collect():
        assert r["at"] == list(range(sizes[r.split]))


def test_splits_do_not_depend_on_partitions_and_do_on_the_seed(spark):
    def rows(inv, params):
        return sorted(ingest.split_frames(inv, params).collect())
    one = rows(_inventory(spark, 90), FRACTIONS)
    assert one == rows(_inventory(spark, 90).repartition(5), FRACTIONS)
    other = Params(seed_fraction=0.11, unlabeled_fraction=0.64, val_fraction=0.25, seed=9)
    assert one != rows(_inventory(spark, 90), other)


def test_an_earlier_runs_partitions_go(spark, tmp_path):
    path = str(tmp_path / "splits")
    files.write_manifest(ingest.split_frames(_inventory(spark, 40), FRACTIONS, _inventory(spark, 6, "held")), path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # whatever the session says
    try:
        files.write_manifest(ingest.split_frames(_inventory(spark, 40), FRACTIONS), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert files.read_manifest(spark, path, "test").count() == 0
    picks = spark.createDataFrame([("mined", 1, "a-1", "a", 0.5), ("random", 1, "b-1", "b", 0.5)],
                                  "arm string, pick long, frame_id string, video_id string, score double")
    files.write_selections(picks, str(tmp_path / "sel"))
    files.write_selections(picks.filter("arm = 'mined'"), str(tmp_path / "sel"))
    assert [r.arm for r in files.read_selections(spark, str(tmp_path / "sel")).collect()] == ["mined"]


@pytest.mark.parametrize("fractions", [(0.2, 0.2, 0.2), (0.9, 0.9, 0.1)])
def test_fractions_must_add_up(spark, fractions):
    s, u, v = fractions
    with pytest.raises(ValueError, match="fractions"):
        ingest.split_frames(_inventory(spark, 8), Params(seed_fraction=s, unlabeled_fraction=u, val_fraction=v))


def test_listing_reads_paths_only(spark, tmp_path, capsys):
    folder = tmp_path / "pics"
    folder.mkdir()
    for name in ("m.1.png", "n.png", "n.pngx", "o.jpg"):
        (folder / name).write_bytes(b"\0")
    inv = ingest.image_inventory(spark, str(folder), "train", "png")
    assert sorted(r.frame_id for r in inv.collect()) == ["m.1", "n"]
    inv.explain("formatted")
    plan = capsys.readouterr().out
    assert "BatchScan file_names" in plan and "Output [1]: [name#" in plan  # names, no contents
