"""Containment of benchmark items against brute force."""

import gc
import random

import pytest

from tagloom.llm import decontamination, queries

FOLDER = "/root/testdata/sf0.01"


def brute(documents, items, shingle=5, threshold=0.8):
    out = []
    for name, item in sorted(set(items), key=str):
        words = decontamination.words_of(item or "")
        k = min(shingle, len(words))
        wanted = {tuple(words[at : at + k]) for at in range(len(words) - k + 1)} if words else set()
        for key, text in documents:
            own = decontamination.words_of(text or "")
            there = {tuple(own[at : at + k]) for at in range(len(own) - k + 1)}
            shared = len(wanted & there)
            if wanted and shared >= threshold * len(wanted) - 1e-9:
                out.append((key, name, len(wanted), shared))
    return sorted(out, key=str)


def found(rows):
    assert all(row.containment == row.n_shared / row.n_shingles for row in rows)
    return sorted([(row.doc_id, row.item_id, row.n_shingles, row.n_shared) for row in rows], key=str)


def documents(spark, rows):
    rows = [(key, text, 9, "x") for key, text in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, item_id int, items string")


def benchmark(spark, rows):
    return spark.createDataFrame([(key, text, 7) for key, text in rows], "item_id long, text string, doc_id int")


def words(n, seed):
    picked = random.Random(seed)
    return [f"w{picked.randrange(5000)}" for _ in range(n)]


ITEM = words(44, 1)
ITEMS = [(1, " ".join(ITEM)), (2, " ".join(words(6, 2))), (3, "only three words"), (4, ""), (5, None), (6, "one"), (None, " ".join(words(9, 3))),
         (7, " ".join(words(300, 4))), (1, " ".join(ITEM)), (1, " ".join(words(20, 5))), (8, "a b a b a b a b a b a b")]
FILL = words(150_000, 9)


def inside(item, at=70_000):
    return " ".join(FILL[:at] + item + FILL[at:])


DOCS = [
    (1, inside(ITEM)), (2, " ".join(ITEM).upper().replace(" ", "! ")), (3, " ".join(ITEM[:36])), (4, " ".join(ITEM[:35])),
    (5, " ".join(ITEM[:22] + words(50, 7) + ITEM[22:])), (6, " ".join(ITEM[:12] + ["x"] + ITEM[13:])), (7, None), (8, ""),
    (9, "here are only three words"), (10, "only three"), (11, "one"), (None, " ".join(ITEM)), (3, " ".join(ITEM[:36])),
    (12, " ".join(words(9, 3))), (13, inside(words(300, 4), 149_990)), (14, " ".join(words(20, 5))), (15, "a b a b a b a"),
]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_against_brute_force(spark, threshold):
    rows = decontamination.contained_items(documents(spark, DOCS), benchmark(spark, ITEMS), threshold=threshold)
    assert found(rows.collect()) == brute(DOCS, ITEMS, threshold=threshold)


def test_pieces_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 30)
    small = [(key, text) for key, text in DOCS if len(text or "") < 10_000]
    rows = decontamination.contained_items(documents(spark, small), benchmark(spark, ITEMS))
    assert found(rows.collect()) == brute(small, ITEMS)
    index = decontamination.ItemIndex([(1, ITEMS[0][1]), (3, "only three words")], 5, 0.8)
    text = " ".join(FILL[:300] + ITEM + ["only", "three", "words"])
    whole = index.contained(text, decontamination._Hashes())
    cut = decontamination.text_runs
    monkeypatch.setattr(decontamination, "text_runs", lambda value: cut(value, 13))
    assert index.contained(text, decontamination._Hashes()) == whole == [(1, 40, 40), (3, 1, 1)]


def test_query_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    expected = brute(docs, items)
    assert expected and found(queries.op10_decontamination(spark, FOLDER).collect()) == expected


def test_documents_with_items_go(spark):
    left = decontamination.without_contaminated(documents(spark, DOCS), benchmark(spark, ITEMS))
    assert left.columns == ["doc_id", "text", "item_id", "items"]
    bad = {row[:1] for row in brute(DOCS, ITEMS)}
    texts = {" ".join(ITEM)}
    kept = [(key, text) for key, text in DOCS if (key,) not in bad and text not in texts]
    assert sorted([(row.doc_id, row.text) for row in left.collect()], key=str) == sorted(kept, key=str)


def test_no_rows(spark):
    docs, items = documents(spark, DOCS[1:4]), benchmark(spark, ITEMS)
    assert decontamination.contained_items(documents(spark, []), items).collect() == []
    assert decontamination.contained_items(docs, benchmark(spark, [])).collect() == []
    assert decontamination.without_contaminated(docs, benchmark(spark, [])).count() == 3


def test_classes_need_more_hashes_the_larger_they_are():
    index = decontamination.ItemIndex([(n, " ".join(words(4 + 2**n, n))) for n in range(1, 9)], 5, 0.8)
    needs = {size: held.needs.min() for (_, size), held in index.classes.items()}
    assert [needs[size] for size in sorted(needs)] == sorted(needs.values()) and max(needs.values()) >= 20
    # Far fewer than contained: a shared phrase is no candidate.
    item = index.texts[-1].split()
    assert index.candidates(" ".join(words(500, 77) + item[:20] + words(500, 78)), decontamination._Hashes()) == []
    assert index.candidates(" ".join(item), decontamination._Hashes()) == [len(index.texts) - 1]


def test_driver_holds_one_block_of_many(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 1)
    alive, blocks = [], decontamination._blocks

    def counted(*args):
        for block in blocks(*args):
            gc.collect()
            alive.append(sum(isinstance(held, decontamination.ItemIndex) for held in gc.get_objects()))
            yield block

    monkeypatch.setattr(decontamination, "_blocks", counted)
    items = [(n, " ".join(words(12, n))) for n in range(100)]
    rows = [(n, " ".join(words(12, 3 * n))) for n in range(40)]
    result = decontamination.contained_items(documents(spark, rows), benchmark(spark, items))
    assert found(result.collect()) == brute(rows, items)
    assert len(alive) == 100 and max(alive) <= 3
    left = decontamination.without_contaminated(documents(spark, rows), benchmark(spark, items)).collect()
    assert {row.doc_id for row in left} == {key for key, _ in rows} - {key for key, *_ in brute(rows, items)}
    assert len(alive) == 200 and max(alive) <= 3


def test_any_column_names(spark):
    frame = spark.createDataFrame([(1, " ".join(ITEM), "a", 1), (2, "other", "b", 2)], "doc_id long, text string, _clean string, items int")
    kept = decontamination.without_contaminated(frame, benchmark(spark, ITEMS))
    assert kept.columns == frame.columns and [tuple(row) for row in kept.collect()] == [(2, "other", "b", 2)]
