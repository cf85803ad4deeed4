import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from labelsieve.operators import ingest
from labelsieve.sources import label_files, listing
from labelsieve.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _texts(spark, n=60):
    return spark.createDataFrame([(f"v{i % 7}-{i:04d}", "" if i % 9 == 0 else "\n".join(f"{j} 0.5 é" for j in range(i % 4)))
                                  for i in range(n)], "frame_id string, text string")


def _on_disk(folder):
    return {f[:-4]: open(os.path.join(folder, f), "rb").read() for f in os.listdir(folder) if f.endswith(".txt")}


def test_files_are_the_label_texts(spark, tmp_path):
    ann = td.annotations_v(spark, SF)
    lines = ingest.yolo_lines(ingest.label_boxes(ann, td.categories_df(spark)))
    texts = ingest.yolo_text(lines, ingest.labeled_frames(ann))
    folder = str(tmp_path / "labels")
    record = label_files.write_label_files(texts, folder)
    want = {r.frame_id: r.text for r in texts.collect()}
    assert {f: t.decode() for f, t in _on_disk(folder).items()} == want
    assert record["n_files"] == len(want) and record["n_bytes"] == sum(len(t.encode()) for t in want.values())
    assert {r.frame_id: r.text for r in label_files.read_label_files(spark, folder).collect()} == want


def test_a_retried_task_and_a_second_run_change_nothing(spark, tmp_path):
    folder, want = str(tmp_path / "labels"), {r.frame_id: r.text for r in _texts(spark).collect()}
    writer = label_files.LabelFileWriter(folder)
    batches = _texts(spark).coalesce(1).toArrow().to_batches(max_chunksize=20)

    def dies():
        yield batches[0]
        raise RuntimeError("executor lost")
    with pytest.raises(RuntimeError):
        writer.write(dies())
    assert not os.path.exists(os.path.join(folder, label_files.COMMIT))  # half of the files, and no commit
    first = writer.write(iter(batches))
    second = writer.write(iter(batches))  # a speculative copy of the same task
    writer.commit([second, None])
    assert {f: t.decode() for f, t in _on_disk(folder).items()} == want
    assert {r.frame_id for r in label_files.committed(spark, folder).collect()} == set(want)
    assert first.listings != second.listings and label_files.committed(spark, folder).count() == len(want)
    writer.abort([first])
    # A later run with fewer frames: files of the earlier one do not count any more.
    few = _texts(spark).limit(10)
    label_files.write_label_files(few.repartition(4), folder)
    assert {r.frame_id: r.text for r in label_files.read_label_files(spark, folder).collect()} == \
        {r.frame_id: r.text for r in few.collect()}
    assert not [f for f in os.listdir(folder) if f.startswith(label_files.PARTIAL)]


def test_names_and_changed_files(spark, tmp_path):
    folder = str(tmp_path / "labels")
    for bad in ("a/b", "", None, "_x"):
        with pytest.raises(Exception, match="frame id"):
            label_files.write_label_files(spark.createDataFrame([(bad, "t")], "frame_id string, text string"), folder)
    assert label_files.write_label_files(_texts(spark).limit(0), folder)["n_files"] == 0
    assert label_files.read_label_files(spark, folder).collect() == []
    label_files.write_label_files(_texts(spark, 5), folder)
    with open(os.path.join(folder, "v1-0001.txt"), "w") as f:
        f.write("other")
    with pytest.raises(Exception, match="was changed"):
        label_files.read_label_files(spark, folder).collect()


def test_listing_by_prefixes_has_every_file_once(spark, tmp_path):
    names = [f"{hashlib.md5(str(i).encode()).hexdigest()[:6]}-{i}" for i in range(700)]
    for n in names:
        (tmp_path / f"{n}.jpg").touch()
    (tmp_path / "notes.txt").touch()
    (tmp_path / ".hidden.jpg").touch()
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.jpg").touch()
    for prefixes in ((), tuple("0123456789abcdef"), ("0", "01", "a", "zz"), ("",)):
        got = listing.image_files(spark, str(tmp_path), "train", prefixes=prefixes)
        assert sorted(r.frame_id for r in got.collect()) == sorted(names)
        assert got.rdd.getNumPartitions() == 1 + len(listing.distinct_prefixes(prefixes))
    one = got.orderBy("frame_id").first()
    assert one.path == f"{tmp_path}/{sorted(names)[0]}.jpg" and one.source_set == "train"
    with pytest.raises(Exception, match="(?i)no such file"):
        listing.image_files(spark, str(tmp_path / "none"), "train").collect()


def test_a_million_names_stream_through_a_task(spark, monkeypatch):
    """The reader holds a batch of names, not the list."""
    monkeypatch.setattr(listing, "names_in", lambda folder: (f"{i:07d}.jpg" for i in range(1_000_000)))
    reader = listing.FileNameReader({"path": "/x", "prefixes": json.dumps([str(d) for d in range(10)]), "extension": "jpg"})
    parts = reader.partitions()
    sizes = [b.num_rows for b in reader.read(parts[0])]
    assert sum(sizes) == 1_000_000 and max(sizes) <= listing.BATCH_ROWS
    assert sum(b.num_rows for p in parts[1:] for b in reader.read(p)) == 0
