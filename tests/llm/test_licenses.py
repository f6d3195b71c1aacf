import oracle

from hypercell.llm import licenses as L


def test_canonical_forms():
    a = L.canonical("Copyright (c) 2020 A. Person\n\nThis  LICENCE, whilst 'favoured'...")
    assert a == b"this license while favoured"
    assert L.canonical("(c) 1999 x\n© y\nCopyright © 2001 z\ncopyright notice stays") == b"copyright notice stays"
    assert L.canonical("") == b"" == L.canonical("...\n!")


def test_whole_texts_lines_and_blocks(spark):
    mit = "MIT License\n\nCopyright (c) 2024 Somebody\n\n" + L.KNOWN[0][1].upper().replace(" ", "  ")
    bsd = dict(L.KNOWN)["BSD-2-Clause"]
    rows = [(1, mit), (2, f"some words\n\n{bsd}\n\nmore words"), (3, "before\nlicensed under the APACHE licence -- version 2.0\nafter"), (4, "Licensed under CC BY-NC 4.0."), (5, mit + " and more")]
    got = {r["doc_id"]: (r["licenses"], r["n_matches"], r["whole"]) for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("MIT", 2, True) and got[2] == ("BSD-2-Clause", 1, False) and got[3] == ("Apache-2.0", 1, False)
    assert got[4] == ("CC-BY-NC-4.0", 2, True) and got[5] == ("", 0, False)


def test_odd_rows(odd, none):
    got = L.scan(odd).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted({r["doc_id"] or 0 for r in odd.collect()})
    assert {(r["licenses"], r["whole"]) for r in got} == {("", False)}
    assert L.scan(none).collect() == []
    assert L.matches(odd, []).collect() == []


def test_query(spark):
    from hypercell.llm import queries

    oracle.same(queries.op6_licenses(spark, "/root/testdata/sf0.01"), queries._op6_sql(), "/root/testdata/sf0.01")
