import csv

import pytest

from eclusa.errors import ControlError
from eclusa.sources.control import CONTROL_FIELDS, first_rows, load_control, lookup


def write_csv(path, rows, fields=CONTROL_FIELDS):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, fields, restval="")
        out.writeheader()
        out.writerows(rows)
    return str(path)


def test_cells_survive(spark, tmp_path):
    query = 'select "a", \'b\\n\'\n\nfrom tabela_temp, "x" -- ção\r\nwhere 1 = 1  '
    rows = [
        {"dataset_id": "a", "query": query, "colunas_esperadas": " x , y "},
        {"dataset_id": "b", "prefixo": "/p/", "chaves": "k1, k2"},
    ]
    loaded = load_control(spark, write_csv(tmp_path / "c.csv", rows)).orderBy("ordem").collect()
    found = [{f: r[f] for f in CONTROL_FIELDS} for r in loaded]
    with open(tmp_path / "c.csv", newline="", encoding="utf-8") as f:
        expected = list(csv.DictReader(f))
    assert expected[0]["query"] == query
    expected[0]["query"] = query.replace("\r\n", "\n")
    assert found == expected


def test_first_row_wins(spark, tmp_path):
    rows = [{"dataset_id": str(i % 7), "query": f"line\n{i}"} for i in range(3000)]
    control = load_control(spark, write_csv(tmp_path / "c.csv", rows))
    assert lookup(control, "3")["query"] == "line\n3"
    firsts = {r["dataset_id"]: r["query"] for r in first_rows(control).collect()}
    assert firsts == {str(i): f"line\n{i}" for i in range(7)}


def test_files_of_a_folder_in_name_order(spark, tmp_path):
    big = [{"dataset_id": "x", "query": "second " * 1000}] * 50
    write_csv(tmp_path / "b.csv", big)
    write_csv(tmp_path / "a.csv", [{"dataset_id": "x", "query": "first"}])
    assert lookup(load_control(spark, str(tmp_path)), "x")["query"] == "first"


def test_lookup_is_exact(spark, tmp_path):
    control = load_control(spark, write_csv(tmp_path / "c.csv", [{"dataset_id": "Abc"}]))
    assert lookup(control, "Abc")["dataset_id"] == "Abc"
    for other in ("abc", "Ab", "Abc "):
        with pytest.raises(ControlError, match=other):
            lookup(control, other)


def test_files_of_one_use_alone(spark, tmp_path):
    job = [f for f in CONTROL_FIELDS if f not in ("prefixo", "nome_job")]
    router = [f for f in CONTROL_FIELDS if f != "dataset_id"]
    for name, fields in (("job", job), ("router", router), ("both", CONTROL_FIELDS)):
        path = write_csv(tmp_path / f"{name}.csv", [dict.fromkeys(fields, "x")], fields)
        (row,) = load_control(spark, path).collect()
        assert {f: row[f] for f in CONTROL_FIELDS} == {
            f: "x" if f in fields or f == "dataset_id" else "" for f in CONTROL_FIELDS
        }


def test_missing_columns(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", [{"query": "na"}], ["query"])
    with pytest.raises(ControlError, match="dataset_id"):
        load_control(spark, path)
    path = write_csv(tmp_path / "d.csv", [{"dataset_id": "a"}], ["dataset_id"])
    with pytest.raises(ControlError, match="chaves"):
        load_control(spark, path, ["dataset_id", "chaves"])
    with pytest.raises(ControlError, match="cannot read"):
        load_control(spark, str(tmp_path / "missing"))


def test_files_of_a_folder_unite_by_name(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [{"dataset_id": "a", "query": "q"}])
    write_csv(tmp_path / "b c.csv", [{"dataset_id": "b", "query": "r"}], CONTROL_FIELDS[::-1])
    control = load_control(spark, str(tmp_path))
    assert lookup(control, "a")["query"] == "q" and lookup(control, "b")["query"] == "r"


def test_columns_in_any_order(spark, tmp_path):
    fields = ["extra", *reversed(CONTROL_FIELDS)]
    path = write_csv(tmp_path / "c.csv", [{"dataset_id": "a", "chaves": "k"}], fields)
    assert lookup(load_control(spark, path), "a")["chaves"] == "k"
