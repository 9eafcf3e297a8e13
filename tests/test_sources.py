import json

import pytest

from skein.sources import files, json_pieces


def test_delimited_with_bom_and_quotes(spark, tmp_path):
    path = tmp_path / "names.item"
    path.write_bytes("﻿1|Misérables, Les\n2|Plain\n".encode())
    rows = files.read_delimited(spark, str(path), "id int, name string", "|").collect()
    assert [tuple(r) for r in rows] == [(1, "Misérables, Les"), (2, "Plain")]
    quoted = tmp_path / "names.txt"
    quoted.write_text('1 "ABC MAN/X Y"\n2 "Z"\n')
    rows = files.read_delimited(spark, str(quoted), "id int, name string", " ").collect()
    assert [tuple(r) for r in rows] == [(1, "ABC MAN/X Y"), (2, "Z")]


def test_csv_with_crlf_header_and_names(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_bytes(b"userID,name,age\r\n0,Will,33\r\n1,Jean,26\r\n")
    people = files.read_csv(spark, str(path))
    assert people.dtypes == [("userID", "int"), ("name", "string"), ("age", "int")]
    assert [r.age for r in people.orderBy("userID").collect()] == [33, 26]
    bare = tmp_path / "orders.csv"
    bare.write_text("44,8602,37.19\n35,5368,65.89\n")
    orders = files.read_csv(spark, str(bare), header=False, names=["customer_id", "product_id", "amount"])
    assert orders.dtypes == [("customer_id", "int"), ("product_id", "int"), ("amount", "double")]


def test_parse_lines_gives_null_for_bad_and_missing_fields(spark):
    lines = files.from_lines(spark, ["a,1,TMAX,-75", "b,x,TMIN", "c,3,TMAX,NA"])
    parsed = files.parse_lines(lines, ",", {"station": (0, "string"), "n": (1, "int"), "t": (3, "double")})
    assert [tuple(r) for r in parsed.collect()] == [("a", 1, -75.0), ("b", None, None), ("c", 3, None)]


def test_json_array_and_default_line(spark, tmp_path):
    path = tmp_path / "articles.json"
    path.write_text(json.dumps([{"url": "u1", "text": ["a", "b"]}, {"url": "u2", "text": []}], indent=2))
    rows = files.read_json_array(spark, str(path), "url string, text array<string>").collect()
    assert [(r.url, r.text) for r in rows] == [("u1", ["a", "b"]), ("u2", [])]
    assert files.lines_or_default(spark).first().value.startswith("To be")


AWKWARD = ["", "}", "{", '"', "\\", '\\"', '"}', "},{", "]}", "a\nb", '{"x": 1}', "ěš}", "\\}", " {", "x" * 700 + "}{" * 90]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_read_by_many_tasks(spark, tmp_path, indent):
    def record(n):
        return {"n": n, "text": AWKWARD[n % len(AWKWARD)], "deep": {"list": [{"k": AWKWARD[(n * 7) % len(AWKWARD)]}, {}], "none": {}}}

    wanted = {}
    for name, size in (("a", 400), ("b", 57), ("empty", 0)):
        records = [record(n + len(wanted)) for n in range(size)]
        (tmp_path / f"{name}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
        wanted |= {r["n"]: r for r in records}
    (tmp_path / "nothing.json").write_text("")
    settings = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        rows = json_pieces.read_json_array_split(
            spark, str(tmp_path), "n int, text string, deep struct<list: array<struct<k: string>>>").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == len(wanted)
    assert {r.n: (r.text, r.deep.list[0].k) for r in rows} == {
        n: (r["text"], r["deep"]["list"][0]["k"]) for n, r in wanted.items()}


def test_json_array_split_of_odd_files(spark, tmp_path):
    for name, text in (("one", '{"n": 1}'), ("bad", '[{"n": "x"}, null, {}]'), ("none", "[]")):
        (tmp_path / f"{name}.json").write_text(text)
    rows = json_pieces.read_json_array_split(spark, str(tmp_path), "n int").collect()
    assert sorted(r.n or 0 for r in rows) == [0, 0, 1]


def test_union(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    other = spark.createDataFrame([(3, 4)], "b int, a int")
    assert sorted(map(tuple, files.union_all([one, other]).collect())) == [(1, 2), (3, 4)]
    assert sorted(map(tuple, files.union_all([one, other], by_name=True).collect())) == [(1, 2), (4, 3)]


def test_text_with_nulls_and_suffix(spark, tmp_path):
    from skein.streaming import sinks
    rows = spark.createDataFrame([("a", None), (None, 2), (' "b\\" , ', 3)], "x string, n int")
    wanted = ["( \"b\\\" , ,3)", "(a,null)", "(null,2)"]
    assert sorted(r.value for r in sinks.as_text(rows).collect()) == wanted
    sinks.write_text(rows, str(tmp_path / "out"), "log")
    files = list((tmp_path / "out").glob("part*"))
    assert files and all(f.name.endswith(".log") for f in files)
    assert sorted(line for f in files for line in f.read_text().splitlines()) == wanted
