"""Data sources: layered files and one text in ordered parts, against plain reads of the folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import ordered_text, sinks, stores, trees
from corpusmill.sources.ordered_text import OrderedText, TextReader
from corpusmill.sources.trees import TreeReader


def _tree(tmp_path, files):
    for name, text in files.items():
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(tmp_path)


def _joined(folder):
    index = json.load(open(f"{folder}/_parts.json"))
    data = b""
    for p in index["parts"]:
        assert p["start"] == len(data) and p["line"] == data.count(b"\n")
        data += open(f"{folder}/{p['file']}", "rb").read()
    assert index["bytes"] == len(data) and index["lines"] == data.count(b"\n")
    return data.decode()


def test_tree_reads_layers_and_leaves_out_what_is_not_inside(spark, tmp_path):
    out = tmp_path / "secret.md"
    out.write_text("not yours")
    root = _tree(tmp_path / "root", {"L1/b.md": "two", "L1/a.md": "# één", "L2/a.md": "", "L2/x.txt": "no", "L2/.hidden.md": "no", "_tmp/a.md": "no", "top.md": "no", "L3/bad.md": b"a\xffb", "L1/deep/c.md": "no"})
    os.symlink(out, f"{root}/L1/link.md")
    rows = [tuple(r) for r in trees.read_tree(spark, root).orderBy("layer", "name").collect()]
    assert rows == [("L1", "a", 7, "# één"), ("L1", "b", 3, "two"), ("L2", "a", 0, ""), ("L3", "bad", 3, "a�b")]
    assert [r.name for r in trees.chapters(trees.read_tree(spark, root)).orderBy("layer", "name").collect()] == ["a", "b", "bad"]


def test_tree_deals_runs_of_bytes_and_lists_what_is_asked_for(spark, tmp_path):
    root = _tree(tmp_path, {f"L{i % 3}/{'ab'[i % 2]}{i:03d}.md": "x" * 100 for i in range(60)})
    tree = trees.read_tree(spark, root, partition_bytes=1000)
    assert tree.rdd.getNumPartitions() == 6
    some = trees.read_tree(spark, root, ["L1", "L9", "L1"], "a", partition_bytes=1000)
    assert some.rdd.getNumPartitions() == 1
    assert {r.name for r in some.collect()} == {f"a{i:03d}" for i in range(60) if i % 3 == 1 and i % 2 == 0}
    assert trees.read_tree(spark, root, ["../L1", "..", "", "L1/."]).count() == 0 and trees.read_tree(spark, root, []).count() == 0
    assert tree.where("layer = 'L1' AND layer = 'L2'").count() == 0 and tree.where("layer = 'L0' OR name = 'b001'").count() == 21 and tree.count() == 60


def test_partitions_of_a_huge_file_and_of_nothing(tmp_path):
    root = _tree(tmp_path, {"L/a.md": "1", "L/b.md": "2" * 5000, "L/c.md": "3"})
    runs = TreeReader(root, 1000).partitions()
    assert [[name for _, name, _ in r.files] for r in runs] == [["a"], ["b"], ["c"]]
    (tmp_path / "none").mkdir()
    assert [r.files for r in TreeReader(str(tmp_path / "none"), 1000).partitions()] == [[]]


def test_tree_round_trip(spark, tmp_path):
    rows = [("L1", "A/b: c?", "t" * 5, 1, "clash"), ("L1", "A/b: c?", "other", 2, "clash"), ("L2", "???", None, 3, None), ("L2", None, "ünï\n", 4, None)]
    df = spark.createDataFrame(rows, "layer string, title string, text string, id long, name string")
    folder = str(tmp_path / "t")
    trees.write_tree(df, folder, "id")
    got = {(r.layer, r.name): r.text for r in trees.read_tree(spark, folder).collect()}
    assert got == {("L1", "A_b_c-1"): "ttttt", ("L1", "A_b_c-2"): "other", ("L2", "untitled-3"): "", ("L2", "untitled-4"): "ünï\n"}
    assert open(f"{folder}/_SUCCESS").read() == "4 16\n"
    trees.write_tree(df, folder, "id")  # the same rows again: the same files
    assert trees.read_tree(spark, folder).count() == 4
    trees.write_tree(df.limit(0), str(tmp_path / "empty"), "id")
    assert trees.read_tree(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("layer", ["..", ".", "", "a/b", "/etc", None])
def test_tree_refuses_places_outside(spark, tmp_path, layer):
    df = spark.createDataFrame([(layer, "x", "t")], "layer string, title string, text string")
    with pytest.raises(Exception, match="not a place inside"):
        trees.write_tree(df, str(tmp_path / "t"))
    assert not list(tmp_path.rglob("*.md")) and not (tmp_path / "t" / "_SUCCESS").exists()


def test_text_in_parts_equals_one_sorted_text(spark, tmp_path):
    n = 5000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 5 == 0, F.concat(F.lit("é\n"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string")).alias("value")).repartition(6, F.rand(1))
    folder = str(tmp_path / "t")
    ordered_text.write_text(df, folder, F.col("id").desc())
    want = "".join(("" if i % 7 == 0 else f"é\n{i}" if i % 5 == 0 else str(i)) + "\n" for i in reversed(range(n)))
    assert _joined(folder) == want
    lines = want.split("\n")[:-1]
    got = sorted(ordered_text.read_text(spark, folder).collect())
    starts, at = [], 0
    for line in lines:
        starts.append(at)
        at += len(line.encode()) + 1
    assert [tuple(r) for r in got] == list(zip(range(len(lines)), starts, lines))


def test_a_range_of_lines_reads_its_parts_only(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.range(4000).select("id", F.repeat(F.lit("x"), 10).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered_text.write_text(df, folder, "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ordered_text.read_text(spark, folder).rdd.getNumPartitions() == 4
    head, tail = ordered_text.read_text(spark, folder, until=10), ordered_text.read_text(spark, folder, 3999)
    assert head.rdd.getNumPartitions() == 1 and sorted(r.line for r in head.collect()) == list(range(10))
    assert tail.rdd.getNumPartitions() == 1 and [(r.line, r.start) for r in tail.collect()] == [(3999, 3999 * 11)]
    assert ordered_text.read_text(spark, folder, 99999).count() == 0 and ordered_text.read_text(spark, folder, 17, 18).first().start == 17 * 11


def test_lines_longer_than_a_read(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    values = ["a" * 50, "", "ü" * 33, "b"]
    ordered_text.write_text(spark.createDataFrame(list(enumerate(values)), "id long, value string").coalesce(1), folder, "id")
    monkeypatch.setattr(ordered_text, "BATCH_BYTES", 8)
    reader = TextReader(folder)
    got = [v for p in reader.partitions() for b in reader.read(p) for v in b.column(2).to_pylist()]
    assert got == values


def test_failed_and_empty_writes(spark, tmp_path):
    folder = str(tmp_path / "t")
    bad = spark.range(100).select("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise("x").alias("value"))
    with pytest.raises(Exception, match="lost"):
        ordered_text.write_text(bad, folder, "id")
    assert not os.path.exists(f"{folder}/_parts.json")
    ordered_text.write_text(spark.range(3).select("id", F.lit("y").alias("value")), folder, "id")  # leftovers are in no index
    assert _joined(folder) == "y\ny\ny\n"
    ordered_text.write_text(spark.range(0).select("id", F.lit("y").alias("value")), str(tmp_path / "e"), "id")
    assert _joined(str(tmp_path / "e")) == "" and ordered_text.read_text(spark, str(tmp_path / "e")).count() == 0
    with pytest.raises(Exception, match="written once"):
        spark.range(1).select(F.lit("x").alias("value")).write.format(stores.register(spark, OrderedText)).mode("overwrite").option("path", folder).save()


PROBLEM = "ord long, id string, text string, original string, perspective string, sub_dimension string, status string, total_frequency long, source_count long, duplicates array<string>, sources array<struct<url:string,type:string,frequency:long>>"


def test_outputs_of_a_run(spark, tmp_path):
    rows = [
        (5, "P002", "q2", "o2", "B", "s", "confirmed", 3, 2, [], [("u", "primary", 3)]),
        (2, "P001", "q1", "o1", "A", "s", "confirmed", 4, 2, ["d1", "d2"], [("u", "primary", 1), ("v", "tertiary", 3)]),
        (9, "PV001", "q3", "o3", "A", "t", "single_source", 1, 1, [], []),
    ]
    problems = spark.createDataFrame(rows, PROBLEM)
    matrix = spark.createDataFrame([(1, "A", "s", 1), (2, "A", "z", 0)], "cell int, perspective string, sub_dimension string, n long")
    audit = spark.createDataFrame([(3,)], "candidates_total long")
    folder = str(tmp_path / "out")
    sinks.write_outputs(folder, "减脂", problems, audit, matrix, "2026-01-01")
    want = (
        "# 减脂 — 真问题清单\n\n> 生成时间：2026-01-01\n\n"
        "## A视角\n\n| ID | 问题 | 子维度 | 来源数 | 状态 |\n|---|---|---|---|---|\n| P001 | q1 | s | 2 | confirmed |\n| PV001 | q3 | t | 1 | single_source |\n\n"
        "## B视角\n\n| ID | 问题 | 子维度 | 来源数 | 状态 |\n|---|---|---|---|---|\n| P002 | q2 | s | 2 | confirmed |\n\n"
        "## 16 格覆盖度\n\n- A / s: ✅ (1)\n- A / z: ❌ (0)\n\n## 详细问题\n\n"
        "### P001 q1\n- **原始文本**：o1\n- **视角 / 子维度**：A / s\n- **状态**：confirmed\n- **总频次 / 来源数**：4 / 2\n- **合并的近似问题**：d1, d2\n- **来源**：\n  - [primary] u (频次 1)\n  - [tertiary] v (频次 3)\n\n"
        "### P002 q2\n- **原始文本**：o2\n- **视角 / 子维度**：B / s\n- **状态**：confirmed\n- **总频次 / 来源数**：3 / 2\n- **来源**：\n  - [primary] u (频次 3)\n\n"
        "### PV001 q3\n- **原始文本**：o3\n- **视角 / 子维度**：A / t\n- **状态**：single_source\n- **总频次 / 来源数**：1 / 1\n"
    )
    assert _joined(f"{folder}/problem_list_md") == want
    one = json.loads(_joined(f"{folder}/problem_list"))
    assert [p["id"] for p in one["problems"]] == ["P001", "P002"] and [p["id"] for p in one["pending_validation"]] == ["PV001"]
    assert one["topic"] == "减脂" and one["exit_reason"] == "saturated" and one["problems"][0]["sources"][1] == {"url": "v", "type": "tertiary", "frequency": 3}
    assert spark.read.json(f"{folder}/audit_report").first().candidates_total == 3
    sinks.write_outputs(str(tmp_path / "none"), "x", problems.limit(0), audit, matrix, "2026-01-01")
    none = json.loads(_joined(str(tmp_path / "none" / "problem_list")))
    assert none["problems"] == [] and none["pending_validation"] == []
