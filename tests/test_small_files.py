from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest

from millrace.operators import small_files as sf

SCHEMA = "path string, source_dataset string, size_bytes bigint, content string, modified_at timestamp_ntz"
AT = dt.datetime(2025, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(p, "s", len(c.encode()) if n is None and c is not None else n, c, t) for p, c, n, t in rows], SCHEMA)


def ids(rows, complete=True):
    return [r[0] for r in rows if r[-1] is complete]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("delimiter", [",", ";", "\t"])
@pytest.mark.parametrize("header", [True, False])
def test_delimited_text(end, delimiter, header):
    lines = (["label_id,filename,split,task,disease".replace(",", delimiter)] if header else []) + [delimiter.join(["1", '"a ""b"", c; d.png"', "", "detection", "x"]), delimiter.join('"%s"' % v for v in (2, "b.png", "train", "detection", "ñ"))]
    got = sf.parse_fragment(end.join(lines) + end)
    assert [(1, 'a "b", c; d.png', None, "detection", "x", True), (2, "b.png", "train", "detection", "ñ", True)] == got


def test_json_lines_in_any_order_of_keys():
    text = '﻿{"disease": "a", "task": "t", "split": null, "filename": "f", "label_id": 7}\n{"label_id": "8", "filename": "g"}\nnonsense\n{"label_id": 9'
    got = sf.parse_fragment(text)
    assert ids(got) == [7] and ids(got, False) == [8]


def test_a_cut_off_file_ends_in_no_record():
    text = "1,a,train,detection,roya\n2,b,train,detection,ro"
    assert ids(sf.parse_fragment(text, len(text) + 2)) == [1]
    assert ids(sf.parse_fragment(text, len(text))) == [1, 2]
    assert ids(sf.parse_fragment('1,a,train,detection,x\n2,"b', 99)) == [1]
    assert ids(sf.parse_fragment("1,a,train\n")) == []


@pytest.mark.parametrize("content", [None, "", "\n", "label_id,filename,split,task,disease\n", "﻿"])
def test_files_without_records(content):
    assert sf.parse_fragment(content) == []


def test_every_record_once_with_the_latest_delivery(spark):
    one = "1,a,train,detection,old\n2,b,train,detection,x\n"
    files = frame(spark, [("p/1", one, None, AT), ("p/1 (1)", one, None, AT), ("p/retry", "1,a,train,detection,new\n", None, AT + dt.timedelta(1)), ("p/cut", "3,c,tra", 90, AT), ("p/null", None, None, None), (None, "4,d,train,detection,y", None, None)])
    got = {r.label_id: r.disease for r in sf.unique_records(files).collect()}
    assert got == {1: "new", 2: "x"}  # what has no path has no place
    assert {r.label_id for r in sf.consolidate(files).collect()} == {1, 2}


def test_schedule_is_balanced_and_whole(spark):
    sizes = [1000 - 7 * (i % 90) for i in range(400)]
    files = spark.createDataFrame([(f"f{i}", "s", n, "", AT) for i, n in enumerate(sizes)], SCHEMA)
    rows = sf.schedule(files, target_bytes=20_000).collect()
    assert sorted(r.path for r in rows) == sorted(f"f{i}" for i in range(400))
    loads = {}
    for r in rows:
        loads[r.out_group] = loads.get(r.out_group, 0) + r.size_bytes
    assert len(loads) == round(sum(sizes) / 20_000) and max(loads.values()) - min(loads.values()) <= max(sizes)
    sharded = sf.schedule(files, target_bytes=20_000, shard_bytes=100_000)
    assert sharded.count() == 400 and sharded.select("shard").distinct().count() > 1


def test_empty_listing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sf.schedule(empty).count() == 0 and sf.consolidate(empty).count() == 0


def test_publish_verifies_and_refuses_a_second_time(spark, tmp_path):
    files = frame(spark, [(f"p/{i}", f"{i},a,train,detection,x\n{i + 1000},b,val,detection,y\n", None, AT) for i in range(50)])
    out = str(tmp_path / "out")
    manifest = sf.publish(files, out, target_bytes=400)
    assert manifest["records"] == 100 and len(manifest["files"]) > 1
    got = [v for f in manifest["files"] for v in pq.read_table(f"{out}/{f['file']}")["label_id"].to_pylist()]
    assert sorted(got) == sorted([*range(50), *range(1000, 1050)])
    with pytest.raises(FileExistsError):
        sf.publish(files, out)
    assert sorted(r.label_id for r in sf.published(spark, out).collect()) == sorted(got)


def test_publish_leaves_out_files_without_a_path_and_publishes_an_empty_listing(spark, tmp_path):
    files = frame(spark, [("p/1", "1,a,train,detection,x\n", None, AT), (None, "4,d,train,detection,y", None, None), ("p/null", None, None, None)])
    assert sf.publish(files, str(tmp_path / "a"))["records"] == 1
    assert sf.publish(spark.createDataFrame([], SCHEMA), str(tmp_path / "b")) == {"records": 0, "files": []}
    assert sf.published(spark, str(tmp_path / "b")).count() == 0


def test_files_of_failed_attempts_do_not_count(spark, tmp_path):
    files = frame(spark, [("p/1", "1,a,train,detection,x\n", None, AT)])
    manifest = sf.publish(files, str(tmp_path))
    pq.write_table(pq.read_table(tmp_path / manifest["files"][0]["file"]), tmp_path / "group-00000-00000-other.parquet")
    assert sf.published(spark, str(tmp_path)).count() == 1


def test_ids_of_all_of_bigint():
    most = (1 << 63) - 1
    text = f"{most},a,train,detection,x\n{most + 1},a,train,detection,x\n00012,a,train,detection,x\n"
    assert ids(sf.parse_fragment(text)) == [most, 12]


def test_line_breaks_in_quoted_fields():
    text = '1,"a\nb ""c"", d",train,detection,x\r\n2,b,val,detection,"y\n\nz"\n3,"open,val,detection,w\n4,d,test,detection,v\n5,"e'
    got = sf.parse_fragment(text)
    assert ids(got) == [1, 2, 4] and ids(got, False) == [3, 5]
    assert got[0][1] == 'a\nb "c", d' and got[1][4] == "y\n\nz"
