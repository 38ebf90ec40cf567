"""Readers of benchmark files, archives, repositories and configurations."""

import gzip
import io
import json
import tarfile

import pytest

from sparkloom.sources import readers


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else "\n".join(json.dumps(x) for x in text) + "\n\n")


def test_benchmarks_come_in_one_form(spark, tmp_path):
    gz = tmp_path / "human-eval" / "data" / "HumanEval.jsonl.gz"
    gz.parent.mkdir(parents=True)
    gz.write_bytes(gzip.compress(json.dumps({"task_id": "HumanEval/0", "prompt": "def f(x: int) -> bool:\n  ...", "test": "x = 1\n  assert f(1)\nassert f(2)", "canonical_solution": "pass"}).encode()))
    put(tmp_path / "mbpp" / "mbpp.jsonl", json.dumps([{"task_id": 7, "text": "Add.", "code": "def add(a, b):\n return a", "test_list": ["assert add(1, 2)"]}, {"task_id": 8, "text": "None.", "code": ""}], indent=1))
    put(tmp_path / "apps" / "train" / "0001" / "question.txt", " Sum it. \n")
    put(tmp_path / "apps" / "train" / "0001" / "metadata.json", '{"difficulty": "interview"}')
    put(tmp_path / "apps" / "train" / "0001" / "input_output.json", '{"inputs": ["1", "2"], "outputs": ["3"]}')
    put(tmp_path / "apps" / "train" / "0001" / "solutions.json", '["a", "b"]')
    put(tmp_path / "apps" / "train" / "0002" / "question.txt", "Bare")
    put(tmp_path / "code_contests" / "data.jsonl", [{"name": "C1", "description": "d", "public_tests": {"input": ["i"], "output": ["o"]}, "difficulty": {"label": "B"}}, {"task_id": "C2", "difficulty": "A"}])
    put(tmp_path / "leetcode" / "data.jsonl", [{"id": 3, "content": "c", "difficulty": "Medium", "test_cases": [{"input": "x", "output": "y"}], "function_signature": "f()"}])
    got = {r["task_id"]: r for r in readers.task_union(spark, str(tmp_path)).collect()}
    assert set(got) == {"HumanEval/0", "7", "8", "APPS/0001", "APPS/0002", "C1", "C2", "3"}
    h = got["HumanEval/0"]
    assert h["function_signature"] == "def f(x: int) -> bool" and [c["input"] for c in h["test_cases"]] == ["assert f(1)", "assert f(2)"] and h["solution"] == "pass"
    assert got["7"]["function_signature"] == "def add(a, b)" and got["8"]["solution"] is None and got["8"]["test_cases"] == []
    a = got["APPS/0001"]
    assert (a["description"].strip(), a["difficulty"], a["solution"], [tuple(c) for c in a["test_cases"]]) == ("Sum it.", "medium", "a", [("1", "3")]) and got["APPS/0002"]["difficulty"] is None
    assert (got["C1"]["difficulty"], got["C2"]["difficulty"], [tuple(c) for c in got["C1"]["test_cases"]]) == ("B", "A", [("i", "o")])
    assert (got["3"]["difficulty"], got["3"]["description"], got["3"]["function_signature"]) == ("medium", "c", "f()")
    assert readers.cached(spark, str(tmp_path), "mbpp").endswith("mbpp.jsonl")
    with pytest.raises(FileNotFoundError):
        readers.cached(spark, str(tmp_path), "taco")


def test_configurations():
    text = "# head\na: 1\nb:\n  c: [x, 2]\n  d: \"q # r\" # note\nitems:\n  - name: n1\n    w: 0.5\n  - name: n2\nflat:\n- 1\n- two\nempty:\nyes: true\n"
    assert readers.parse_yaml(text) == {"a": 1, "b": {"c": ["x", 2], "d": "q # r"}, "items": [{"name": "n1", "w": 0.5}, {"name": "n2"}], "flat": [1, "two"], "empty": None, "yes": True}
    assert readers.parse_yaml("") == {}


def test_archives_repositories_and_pages(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name, text in (("x/1.tk", "one"), ("x/2.tk", "two")):
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    wanted = spark.createDataFrame([("x/2.tk",), ("x/3.tk",)], "path string")
    assert [tuple(r) for r in readers.archived(spark, str(tmp_path / "a.tar.gz"), wanted).collect()] == [("x/2.tk", "two")]
    put(tmp_path / "repos" / "r1" / "LICENSE", "MIT License ...")
    put(tmp_path / "repos" / "r1" / "src" / "a.c", "int a;")
    put(tmp_path / "repos" / "r1" / "tests" / "b.c", "int b;")
    put(tmp_path / "repos" / "r2" / "c.py", "c = 1")
    put(tmp_path / "repos" / "r2" / "d.bin", "?")
    got = {(r["repo"], r["language"], r["license"], r["text"]) for r in readers.repository(spark, str(tmp_path / "repos"), {".c": "c", ".py": "python"}).collect()}
    assert got == {("r1", "c", "MIT", "int a;"), ("r2", "python", "unknown", "c = 1")}
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(10)], "id long, f boolean")
    assert [r["id"] for r in readers.flagged_scan(df, "f", 2, "id", 2).collect()] == [4, 6]
    (tmp_path / "c.json").write_text('{"k": 2}')
    assert readers.config(spark, str(tmp_path / "c.json")) == {"k": 2}
