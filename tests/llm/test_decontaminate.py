import re
from collections import defaultdict

from brute import prose

from hypercell.llm import decontaminate as D

PATTERN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=13):
    def words(t):
        return PATTERN.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))

    wins = defaultdict(set)
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                wins[tuple(w[k : k + window])].add(i)
    out = []
    for i, t in docs:
        w = words(t)
        hit, who = set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    who |= ids
        out.append((i, len(w), len(hit), sorted(who), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r[0], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()), key=repr)


def setup(spark):
    bench = [(1, prose(1, 30)), (2, prose(2, 13)), (3, prose(3, 5)), (30, prose(3, 5)), (4, ""), (5, None), (None, prose(6, 20)), (7, prose(7, 40)), (7, prose(8, 15))]
    docs = [
        (1, prose(1, 30).upper() + "!"),
        (2, prose(50, 300) + " ... " + prose(1, 30)[40:] + " x " + prose(2, 13).replace(" ", ",  ")),
        (3, prose(60, 500) + " " + prose(3, 5)),
        (4, prose(3, 5)),
        (5, prose(61, 200)),
        (6, prose(6, 20)),
        (7, "é" + prose(7, 40) + "é " + prose(7, 40)[7:] + prose(8, 15)),
        (8, None),
        (9, "..."),
    ]
    return docs, bench, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")


def test_against_brute_force(spark):
    docs, bench, d, b = setup(spark)
    assert rows(D.scan(d, b)) == brute(docs, bench)


def test_several_automata(spark, monkeypatch):
    docs, bench, d, b = setup(spark)
    monkeypatch.setattr(D, "shards", lambda *a, f=D.shards: f(*a, size=1))
    assert rows(D.scan(d, b)) == brute(docs, bench)


def test_spans_point_into_the_original(spark):
    docs, _, d, b = setup(spark)
    texts = dict(docs)
    for r in D.scan(d, b).collect():
        for s in r["spans"]:
            part = texts[r["doc_id"]][s["start"] : s["end"]]
            assert part and len(D.words(part)) >= 5
        assert sum(len(D.words(texts[r["doc_id"]][s["start"] : s["end"]])) for s in r["spans"]) == r["n_hit"]


def test_question_and_answer_columns(spark):
    b = spark.createDataFrame([(1, prose(1, 20), prose(2, 20))], "item_id long, q string, a string")
    d = spark.createDataFrame([(1, prose(2, 20))], "doc_id long, text string")
    assert D.scan(d, b, bench_cols=("q", "a")).first()["items"] == [1]


def test_odd_rows(spark, odd, none):
    _, bench, _, b = setup(spark)
    b = b.unionByName(spark.createDataFrame([(90, "Same text here for two")], "item_id long, text string"))
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows(D.scan(odd, b)) == brute(docs, [*bench, (90, "Same text here for two")])
    assert D.scan(none, b).collect() == []
    assert {r["n_hit"] for r in D.scan(odd, b.where("false")).collect()} == {0}
    kept = D.clean(odd, b)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
