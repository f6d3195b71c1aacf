import brute
import numpy as np
import pytest
from brute import WORDS, prose

from hypercell.llm import neardup
from hypercell.llm.graph import components


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.link(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def edited(rng, words, share):
    out = list(words)
    for i in np.flatnonzero(rng.random(len(out)) < share):
        out[i] = WORDS[rng.integers(len(WORDS))]
    return " ".join(out)


def test_copies_edits_and_chains(spark):
    rng = np.random.default_rng(8)
    base = prose(1, 200).split()
    rows = [(100 + i, edited(rng, base, s)) for i, s in enumerate([0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.2])]
    rows += [(i, prose(i + 20, 150)) for i in range(20)] + [(50 + i, prose(3, 150).upper()) for i in range(3)]
    chain = base[:]
    for i in range(8):  # each is near the one before only
        chain = chain[8:] + prose(90 + i, 8).split()
        rows.append((200 - i, " ".join(chain)))
    check(spark, rows)


def test_crowds(spark, monkeypatch):
    """Groups of near copies whose members are often not similar to each other, by either way of meeting."""
    rng = np.random.default_rng(9)
    base = prose(5, 90).split()
    rows = [(1000 - i, edited(rng, base, rng.choice([0.01, 0.03, 0.05, 0.09]))) for i in range(120)]
    rows += [(2000 + i, prose(i, 40) + " " + prose(77, 40)) for i in range(60)]
    check(spark, rows)
    monkeypatch.setattr(neardup, "CROWD", 3)
    check(spark, rows)
    monkeypatch.setattr(neardup, "CROWD", 10**9)
    check(spark, rows)


@pytest.mark.parametrize("first_pass", [neardup.FIRST_PASS, 10**6])
def test_second_pass_finds_what_the_first_leaves(spark, monkeypatch, first_pass):
    monkeypatch.setattr(neardup, "FIRST_PASS", first_pass)
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def test_query(spark):
    from hypercell.llm import queries

    sf = "/root/testdata/sf0.001"
    want = brute.near([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    got = queries.op9_near_dedup(spark, sf).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, n, c, i == c) for i, (n, c) in want.items())


def test_short_texts(spark):
    check(spark, [(1, "a b"), (2, "A\tB"), (3, "b a"), (4, "a b c d e"), (5, "a b c d e f"), (6, "a b c d e f g h i j"), (7, "a b c d e f g h i"), (8, ""), (9, None), (10, "\n")])


def test_shingles_at_chunk_edges():
    texts = [prose(i, n) for i, n in enumerate([0, 1, 4, 5, 6, 50, 0, 3])]
    h, ends = neardup.shingles(texts)
    begin = 0
    for t, e in zip(texts, ends.tolist(), strict=True):
        alone, _ = neardup.shingles([t])
        assert h[begin:e].tolist() == alone.tolist() and len(alone) == len(brute.shingle_set(t))
        begin = e


def test_odd_rows(odd, none):
    got = neardup.link(odd)
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got.count() == odd.count() and len(by[None]) == 2 and all(x[1:] == (None, True) for x in by[None])
    assert by[5][0][1:] == (5, True) and by[6][0][1:] == (5, False)
    assert by[2] == by[3][:0] + [(0, 2, True)] and by[4] == [(0, 4, True)]
    assert len(by[8]) == 2 and len(by[9]) == 2
    assert neardup.link(none).collect() == []


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(900 + i, 901 + i) for i in range(40)] + [(7, 7), (None, 3), (5, None)] + [(1000, 2000 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "a long, b long")
    assert {r["node"]: r["label"] for r in components(df).collect()} == {x: find(x) for x in list(root)}
    assert components(df.where("false")).collect() == []
