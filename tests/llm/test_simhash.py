"""SimHash components against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tagloom.llm import components, queries, simhash

FOLDER = "/root/testdata/sf0.001"


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[at : at + k]) for at in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, distance):
    """prints: (key, bits). Root by flooding."""
    values = sorted({bits for _, bits in prints})
    root = {value: value for value in values}

    def find(value):
        while root[value] != value:
            value = root[value]
        return value

    for n, a in enumerate(values):
        for b in values[n + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for key, bits in prints:
        if key is not None:
            least[find(bits)] = min(key, least.get(find(bits), key))
    return {(key, bits): least.get(find(bits)) for key, bits in prints}


def unsigned(bits):
    return bits & (1 << 64) - 1


def docs(spark, rows):
    rows = [(key, text, "x", 1) for key, text in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, bits string, component_id int")


LONG = " ".join(f"w{n * 7919 % 1000}" for n in range(400_000))
TEXTS = [
    (5, "One two three four five six"), (3, "one TWO\tthree\nfour five six"), (9, None), (8, ""), (7, " \n"), (1, "a"),
    (2, "A"), (4, "a b"), (None, "a b"), (None, "nobody else"), (6, "a b"), (6, "a b"), (10, LONG), (11, LONG + " tail"), (12, "É é É"),
]


def test_fingerprints_are_exact(spark):
    found = simhash.fingerprints(docs(spark, TEXTS)).collect()
    expected = sorted((key or 0, brute_print(text)) for key, text in TEXTS)
    assert sorted((row.doc_id or 0, unsigned(row.bits)) for row in found) == expected


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    whole = simhash.fingerprint(LONG.encode()[:5000], 3)
    monkeypatch.setattr(simhash, "word_runs", lambda data: __import__("tagloom.llm.common").llm.common.word_runs(data, 11))
    assert simhash.fingerprint(LONG.encode()[:5000], 3) == whole == brute_print(LONG[:5000])


def test_near_duplicates(spark):
    found = simhash.near_duplicates(docs(spark, TEXTS)).collect()
    expected = brute_components([(key, brute_print(text)) for key, text in TEXTS], 2)
    assert len(found) == len(TEXTS)
    for row in found:
        assert row.component_id == expected[row.doc_id, unsigned(row.bits)]


def test_query_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_components([(row.doc_id, brute_print(row.text)) for row in rows], 2)
    found = queries.op3_simhash(spark, FOLDER).collect()
    assert {(row.doc_id, int(row.fingerprint, 16)): row.component_id for row in found} == expected
    assert all(len(row.fingerprint) == 16 for row in found)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_connect_what_is_near(spark, distance):
    random.seed(distance)
    values = set()
    for _ in range(12):
        value = random.getrandbits(64)
        for _ in range(12):
            values.add(value)
            for _ in range(random.randint(1, 4)):
                value ^= 1 << random.randrange(64)
    values |= {0, 1, 1 << 63, (1 << 64) - 1}
    signed = [(value - (1 << 64) if value >> 63 else value,) for value in values]
    pairs = simhash.links(spark.createDataFrame(signed, "bits long"), distance)
    roots = {unsigned(row.node): unsigned(row.root) for row in components.components(pairs).collect()}
    expected = brute_components([(value, value) for value in values], distance)
    groups = {}
    for value in values:
        groups.setdefault(roots.get(value, value), set()).add(value)
    wanted = {}
    for (value, _), root in expected.items():
        wanted.setdefault(root, set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_distances_beyond_the_method_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "bits long"), 5)


def test_long_chains_and_hubs(spark):
    chain = [(n, n + 1) for n in range(300)]
    hub = [(10_000, 10_000 + n) for n in range(1, 500)]
    pairs = [*chain, *hub, (5, 5), (None, 3), (7, None), (20_001, 20_000), (20_000, 20_001)]
    random.shuffle(pairs)
    found = {row.node: row.root for row in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {n: 0 for n in range(301)} | {10_000 + n: 10_000 for n in range(500)} | {20_000: 20_000, 20_001: 20_000}


def test_no_rows(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_keeps_the_smallest(spark):
    left = simhash.one_of_each(docs(spark, TEXTS))
    assert left.columns == ["doc_id", "text", "bits", "component_id"]
    expected = brute_components([(key, brute_print(text)) for key, text in TEXTS], 2)
    keys = sorted(row.doc_id for row in left.filter(F.col("doc_id").isNotNull()).collect())
    stays = [(k, t) for k, t in TEXTS if k is not None and expected[k, brute_print(t)] == k]
    assert keys == sorted(k for k, _ in stays)


def test_any_column_names(spark):
    rows = [(1, "a b c d", "x", 1), (2, "a b c d", "y", 2), (3, "e f g h", "z", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _dropped string, component_id int")
    kept = simhash.one_of_each(frame, 3, 2)
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
