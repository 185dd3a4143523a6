"""Files with line breaks in quoted cells, cut into many splits."""

import csv
import io
import os
import random

import pytest

from sheetloom.sources.files import read_delim
from sheetloom.sources.quoted import read_quoted, records


@pytest.fixture
def splits(spark):
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(n, None) for n in names]

    def about(number):
        spark.conf.set(names[0], "1")
        spark.conf.set(names[1], str(number))

    yield about
    for name, value in zip(names, before, strict=True):
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def cell(rng):
    return rng.choice(["a", "b c", 'say "x"', "one\ntwo", '"\n"', "\n\n\n", ",", "é\n€,", "r\r\nn", "long " * 30, 'x\n"y"\n' * 9])


def table(seed, n):
    rng = random.Random(seed)
    return [(str(seed * 1000 + i), cell(rng), cell(rng)) for i in range(n)]


def save(folder, name, rows, end="\n"):
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows([("id", "p", "q"), *rows])
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text.getvalue())


@pytest.mark.parametrize("number", [3, 24])
def test_rows_equal_those_written_whatever_the_splits(spark, rows, splits, tmp_path, number):
    one, two = table(1, 60), table(2, 25)
    save(tmp_path, "one.csv", one)
    save(tmp_path, "two.csv", two)
    splits(number)
    assert rows(read_quoted(spark, str(tmp_path))) == sorted(one + two)
    assert rows(read_quoted(spark, str(tmp_path))) == rows(read_delim(spark, str(tmp_path), ","))


def test_one_cell_over_many_splits_and_order(spark, splits, tmp_path):
    given = [("1", "a", "b"), ("2", "line\n" * 400, "end"), ("3", "c", 'd "e"\n')]
    save(tmp_path, "long.csv", given)
    splits(24)
    found = read_quoted(spark, str(tmp_path), order="_at")
    assert [tuple(r)[:3] for r in found.orderBy("_at").collect()] == given
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 12


def test_edges(spark, rows, splits, tmp_path):
    save(tmp_path, "crlf.csv", [("1", "x\r\ny", "z")], "\r\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,p,q\n")
    (tmp_path / "odd.csv").write_text('id,p,q\n\n2\n3,,""\n4,"open\n5,f,g')
    splits(12)
    assert rows(read_quoted(spark, str(tmp_path), schema="id int, p string, q string")) == [
        (1, "x\r\ny", "z"), (2, None, None), (3, None, None), (4, "open\n5,f,g", None)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    assert records(spark, str(tmp_path / "none")).count() == 0
