"""Quoted line breaks in files that are read in splits."""

from __future__ import annotations

import csv
import io
import random

import pytest

from hexrarity.schemas import RAW_COLUMNS
from hexrarity.sources.occurrences import read_occurrences
from hexrarity.sources import records as records_module
from hexrarity.sources.records import find_breaks, read_lines, records, stays_open
from tests.test_sources import line, write

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=[97, 3000])
def split(spark, request):
    """Bytes of a split; the packing cost is as small, so that tasks take a split or few."""
    spark.conf.set(SPLIT, str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset(SPLIT)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path, charset="UTF-8"):
    lines = read_lines(spark, str(path), charset)
    maps = find_breaks(lines, "\t")
    return None if maps is None else sorted(r[0] for r in records(lines, maps, "\t").collect())


def by_hand(text):
    """Character by character."""
    found, current, inside, begins, closing = [], "", False, True, False
    for k, c in enumerate(text):
        if inside:
            if closing:
                closing = False
                if c == '"':
                    current += c
                    continue
                inside = False
            elif c == '"':
                closing = True
                current += c
                continue
            else:
                current += c
                continue
        elif c == '"' and begins:
            inside, begins = True, False
            current += c
            continue
        if c == "\n":
            found.append(current)
            current, begins = "", True
        else:
            current += c
            begins = c == "\t"
    return found + [current] if current else found


@pytest.mark.parametrize("text,inside,after", [
    ("a\tb", False, False), ('"a', False, True), ('a"b', False, False), ('a\t"b', False, True), ('a"\tb', True, False),
    ('a""', True, True), ('a"""', True, False), ("", True, True), ('""\t"', False, True), ('"a"x\t"', False, True),
    ('"a"x"\tb', False, False), ('x"\t"', True, True), ('"' * 6, False, False), ('"' * 7, False, True),
])
def test_lines(text, inside, after):
    assert stays_open(text, inside, "\t") is after


@pytest.mark.parametrize("seed", range(2))
def test_records_of_random_files(spark, tmp_path, split, seed):
    draw = random.Random(seed)
    pieces = ["a", "bc", '"', '""', "\t", "\n", '\t"', '"\t', "\n\n", '"x\ny"', "Ω", "d e"]
    text = "head\n" + "".join(draw.choices(pieces, k=1500))
    text += '"' if by_hand(text + '\t"\n')[-1].endswith('\t"\n') else ""  # ends outside quotes
    while stays_open_at_end(text):
        text += '"\t'
    (tmp_path / "raw.txt").write_text(text + "\n", newline="")
    assert read(spark, tmp_path / "raw.txt") == sorted(by_hand(text + "\n")[1:])


def stays_open_at_end(text):
    inside = False
    for part in text.split("\n"):
        inside = stays_open(part, inside, "\t")
    return inside


def test_field_over_many_splits(spark, tmp_path, split):
    long = 'x\t"' + "\n".join(f"line {k}" for k in range(3000)) + '"\ty'
    rows = [f"{k}\t" for k in range(50)]
    (tmp_path / "raw.txt").write_text("\n".join(["head", *rows, long, *rows]) + "\n", newline="")
    assert read(spark, tmp_path / "raw.txt") == sorted([*rows, long, *rows])


def test_quote_never_closed(spark, tmp_path, split):
    """It opens nothing; what was open and closed before it counts."""
    rows = ['a\t"b', 'c"', *(f"n{k}" for k in range(300)), 'x\t"open', *(f"m{k}" for k in range(300))]
    (tmp_path / "raw.txt").write_text("\n".join(["head", *rows]) + "\n", newline="")
    assert read(spark, tmp_path / "raw.txt") == sorted(['a\t"b\nc"', *rows[2:]])


def test_files_of_their_own(spark, tmp_path, split):
    for name in "abc":
        text = "".join(f'{name}{k}\t"1\n2"\n' for k in range(40))
        (tmp_path / f"{name}.txt").write_text("head\n" + text + '"' * (name == "b"), newline="")
    expected = [f'{n}{k}\t"1\n2"' for n in "abc" for k in range(40)]
    assert read(spark, tmp_path) == sorted([*expected, '"'])
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "plain.txt").write_text("head\n" + 'q"\t""\n' * 99)
    assert read(spark, tmp_path / "one") is None  # no break lies within quotes


@pytest.mark.parametrize("encoding,end", [("utf-8", "\n"), ("utf-8", "\r\n"), ("utf-16-le", "\n"), ("latin-1", "\n")])
def test_occurrences(spark, tmp_path, split, encoding, end):
    """No option is needed, as many tasks as splits read the file, and fields are as a
    reader of the whole file gives them."""
    lines = [line(gbifID=str(k), recordedBy="Zoë", locality=f'"a{end}{"b" * (k % 60)}""{end}\tc {k}"' if k % 3 else "q\"")
             for k in range(200)]
    path = write(tmp_path / "raw.tsv", lines, encoding, end)
    name = {"utf-16-le": "UTF-16LE", "latin-1": "ISO-8859-1"}.get(encoding, "auto")
    df = read_occurrences(spark, path, name)
    found = sorted((r["gbifID"], r["locality"], r["recordedBy"]) for r in df.collect())
    text = end.join(["\t".join(RAW_COLUMNS), *lines]) + end
    expected = list(csv.DictReader(io.StringIO(text, newline=""), delimiter="\t"))
    assert found == sorted((int(r["gbifID"]), r["locality"], r["recordedBy"]) for r in expected)
    assert len(read_lines(spark, path, "UTF-8").select("start").distinct().collect()) >= 10_000 // split
    assert read_occurrences(spark, path, name, multi_line=False).count() < 200


def test_records_are_parsed_once(spark, tmp_path):
    """Conditions on fields are not answered by parsing the record again for each."""
    path = write(tmp_path / "raw.tsv", [line(locality='"a\nb"')])
    table = read_occurrences(spark, str(path))
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert [r["locality"] for r in table.collect()] == ["a\nb"]


def test_files_without_quotes_are_not_looked_at(spark, tmp_path, monkeypatch):
    def none(separator):
        raise AssertionError("no quotes, no states")

    monkeypatch.setattr(records_module, "_maps", none)
    path = write(tmp_path / "raw.tsv", [line(), line(gbifID="2")])
    assert find_breaks(read_lines(spark, path, "UTF-8"), "\t") is None
    assert read_occurrences(spark, path).count() == 2
