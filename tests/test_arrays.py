"""JSON array files cut at the borders of their elements, however they are split."""

import json
import random

import pytest

from tunewright.session import setting
from tunewright.sources import arrays, records

ODD = ["}", "{", "[", "]", ",", '"', "\\", "\\\\", "é", "漢", "\n", "\t", " ", "a", "0", "},{", '\\"', "}}", "🙂", " "]


def _value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 4 else 4)
    if kind < 2:
        return "".join(rnd.choices(ODD, k=rnd.randrange(12)))
    if kind == 2:
        return rnd.choice([None, True, 1.5, -7, 10**18])
    if kind < 5:
        return rnd.choice([0, "x"])
    if kind == 5:
        return [_value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {"".join(rnd.choices(ODD, k=3)): _value(rnd, depth + 1) for _ in range(rnd.randrange(4))}


def _write(folder, name, values, rnd):
    text = json.dumps(values, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]), separators=rnd.choice([None, (" ,", ": ")]))
    (folder / name).write_text(rnd.choice(["", " \n"]) + text + rnd.choice(["", "\n", "  "]), encoding="utf-8")


def _read(spark, path, split=None):
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(split or 1 << 27)), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        rows = arrays.read_array(spark, str(path)).collect()
    return sorted((r.number, r.file.rsplit("/", 1)[-1], r.entry, r.raw) for r in rows)


@pytest.mark.parametrize("seed, split", [(0, 64), (1, 300), (2, 1000), (3, None)])
def test_elements_are_those_of_the_whole_array(spark, tmp_path, seed, split):
    rnd = random.Random(seed)
    want = []
    for i, n in enumerate([60, 0, 1, 25, 2]):
        values = [{"n": j, "v": _value(rnd)} for j in range(n)]
        if i == 3:
            values = [_value(rnd) for _ in range(n)]
        _write(tmp_path, f"{i}.json", values, rnd)
        want += [(f"{i}.json", j + 1, value) for j, value in enumerate(values)]
    got = _read(spark, tmp_path, split)
    assert [(file, entry, json.loads(raw)) for _, file, entry, raw in got] == want
    assert [number for number, *_ in got] == list(range(1, len(want) + 1))


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(5)
    values = [{"n": i, "v": "}{,\"" * rnd.randrange(60)} for i in range(20_000)] + [{"long": "x},{" * 200_000}, {"n": 1}]
    (tmp_path / "big.json").write_text(json.dumps(values))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "65536"):
        assert arrays._fragments(spark, str(tmp_path)).rdd.getNumPartitions() > 40
        rows = arrays.read_array(spark, str(tmp_path)).selectExpr("entry", "length(raw) AS n", "crc32(raw) AS c").collect()
    assert sorted(r.entry for r in rows) == list(range(1, len(values) + 1))
    assert {r.entry: r.n for r in rows} == {i + 1: len(json.dumps(v)) for i, v in enumerate(values)}


@pytest.mark.parametrize("split", [20, None])
def test_torn_files_and_files_of_other_things(spark, tmp_path, split):
    texts = {
        "a": '[{"a": 1}, {"a": 2', "b": '[{"a": 1}, {"a": 2}', "c": "", "d": '{"a": 1}', "e": "[]", "f": " [ ] ", "g": '[{"a": "]"}] , [{"b": 1}]',
        "h": "[1, 2, [3, 4], \"x}y\"]", "i": '{"a": 1}\n{"a": 2}\n', "j": '[{"a": {"b": [1, {}]}}', "k": "[", "l": '[{"a": "b',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = {}
    for _, file, entry, raw in _read(spark, tmp_path, split):
        got.setdefault(file[0], []).append((entry, raw))
    assert got == {
        "a": [(1, '{"a": 1}'), (2, '{"a": 2')], "b": [(1, '{"a": 1}'), (2, '{"a": 2}')], "g": [(1, '{"a": "]"}')],
        "h": [(1, "1"), (2, "2"), (3, "[3, 4]"), (4, '"x}y"')], "j": [(1, '{"a": {"b": [1, {}]}}')], "l": [(1, '{"a": "b')],
    }
    read = records.read_with_rejects(spark, str(tmp_path / "a.json"), "a INT", array=True).collect()
    assert sorted((r.a, r.corrupt) for r in read if r.a) == [(1, None)] and [r.corrupt for r in read if r.corrupt] == ['{"a": 2']


def test_states_may_come_by_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "BROADCAST_SPLITS", 2)
    values = [{"n": i, "v": "{" * (i % 7)} for i in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(values))
    assert [(entry, json.loads(raw)) for _, _, entry, raw in _read(spark, tmp_path, 200)] == list(enumerate(values, 1))


def test_arrays_that_are_written_are_read(spark, tmp_path):
    df = spark.range(0, 500, 1, 7).selectExpr("id", "CASE WHEN id % 3 > 0 THEN '},{\"' END AS s")
    arrays.write_array(df, str(tmp_path / "out"))
    arrays.write_array(df.where("id = 4"), str(tmp_path / "one"))
    for name, want in (("out", df), ("one", df.where("id = 4"))):
        files = [f for f in (tmp_path / name).iterdir() if f.suffix == ".txt"]
        assert sum(len(json.loads(f.read_text())) for f in files) == want.count()
        got = records.read_records(spark, str(tmp_path / name), "id LONG, s STRING", array=True)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()), key=lambda r: r[0])


def test_a_reader_sees_the_same_quotes_from_either_side():
    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choices(ODD, k=rnd.randrange(40))) + "}"
        assert arrays.walk(text, False)[1] != arrays.walk(text, True)[1]
