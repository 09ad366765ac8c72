"""Removal of repeated lines against brute force."""

import hashlib
from collections import defaultdict

import pytest

from tagloom.llm import lines, queries

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(BLANKS).translate(LOWER)


def brute(rows, min_length=10, min_docs=2):
    holders = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            if key is not None and len(key_of(line)) >= min_length:
                holders[key_of(line)].add(key)
    out = []
    for key, text in rows:
        parts = (text or "").split("\n")
        lost = [key is not None and len(holders[key_of(x)]) >= min_docs and key != min(holders[key_of(x)]) for x in parts]
        out.append((key, "\n".join(x for x, gone in zip(parts, lost) if not gone), len(parts), sum(lost)))
    return sorted(out, key=str)


SHARED, OTHER = "A line that is shared", "another shared line é"
ROWS = [
    (4, f"{SHARED}\nown of four\n{SHARED}"), (2, f"  {SHARED.lower()}\t\n\nown line of two"), (3, f"{SHARED}\r\n{SHARED}\n{OTHER}"),
    (5, OTHER), (6, OTHER.replace("é", "É")), (7, None), (8, ""), (9, "\n"), (10, "short\nshort"), (11, "short"), (None, SHARED),
    (None, None), (3, f"{SHARED}\r\n{SHARED}\n{OTHER}"), (3, f"x\n{SHARED}"), (12, " em space line "), (13, "em space line"),
    (14, "\n".join(f"line number {n}" for n in range(20_000))), (15, "\n".join(f"line number {n}" for n in range(0, 20_000, 2))),
    (16, "ten chars!"), (17, "ten chars!"), (18, "nine char"), (19, "nine char"),
]


def table(spark, rows):
    rows = [(key, text, 1, "p", 2) for key, text in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, h1 int, parts string, n_lines int")


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_against_brute_force(spark, min_docs):
    found = lines.drop_repeated_lines(table(spark, ROWS), min_docs=min_docs).collect()
    assert sorted([tuple(row) for row in found], key=str) == brute(ROWS, min_docs=min_docs)


def test_other_columns_can_stay(spark):
    kept = lines.drop_repeated_lines(table(spark, ROWS), keep=("parts", "h1"))
    assert kept.columns == ["doc_id", "text", "n_lines", "n_dropped", "parts", "h1"]
    assert {(row.parts, row.h1) for row in kept.collect()} == {("p", 1)}


def test_query_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = {row.doc_id: (row.n_lines, row.n_dropped, row.kept_sha256) for row in queries.op4_line_dedup(spark, FOLDER).collect()}
    expected = {key: (n, lost, hashlib.sha256(text.encode()).hexdigest()) for key, text, n, lost in brute(rows)}
    assert found == expected


def test_no_rows(spark):
    assert lines.drop_repeated_lines(table(spark, [])).collect() == []


def test_plan_has_no_python(spark):
    plan = lines.drop_repeated_lines(table(spark, ROWS))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))


def test_any_column_names(spark):
    rows = [(1, "a repeated line\nown", "x", 1), (2, "a repeated line", "y", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _none string, version int")
    kept = lines.drop_repeated_lines(frame, keep=("_none", "version"))
    assert sorted((row.doc_id, row.text, row._none, row.version) for row in kept.collect()) == [(1, rows[0][1], "x", 1), (2, "", "y", 2)]
    for name in ("n_lines", "Text"):
        with pytest.raises(ValueError):
            lines.drop_repeated_lines(frame.withColumnRenamed("_none", name) if name == "n_lines" else frame, keep=(name,))
