import oracle
from brute import prose

from hypercell.llm import linededup as L


def test_variable_fields_recur(spark):
    rows = [(i, f"{prose(i, 12)}\nUser number {i} logged in from host{i}.example today\n{prose(i + 50, 9)}") for i in range(20)]
    got = {r["doc_id"]: r for r in L.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["lines_dropped"] == 0 and "logged in" in got[0]["text"]  # the first document keeps it
    for i in range(1, 20):
        a, _, c = rows[i][1].split("\n")
        assert (got[i]["lines_dropped"], got[i]["text"]) == (1, f"{a}\n{c}")


def test_a_varying_word_becomes_a_field(spark):
    names = "ann bob cy dee eve fay gus hal ivy jo kim lou".split()
    rows = [(i, f"the report was sent to {n} on the same evening") for i, n in enumerate(names)]
    found = L.recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["id"] for r in found) == list(range(1, len(names)))


def test_rare_lines_stay(spark):
    rows = [(i, f"this line stands in seven documents only\n{prose(i, 20)}") for i in range(L.MIN_DOCS - 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert L.recurring(df).count() == 0
    twice = df.selectExpr("0 AS doc_id", "text").unionByName(df)
    assert L.recurring(twice).count() == 0  # repeated in one document


def test_repeated_rows_change_nothing(spark):
    """Lines with one varying word in as many documents as recur, and in one fewer, with rows and ids that repeat."""
    names = "ann bob cy dee eve fay gus hal".split()
    for n, dropped in ((8, 7), (7, 0)):
        rows = [(i, f"the report was sent to {names[i]} on the same evening\n{prose(i, 20)}") for i in range(n)]
        df = spark.createDataFrame([*rows, *rows[:1] * 8, (0, rows[0][1] + "\nmore"), (0, rows[0][1].replace("ann", "amy"))], "doc_id long, text string")
        got = L.dedup(df)
        assert got.where("doc_id > 0 and lines_dropped > 0").count() == dropped and got.where("doc_id = 0 and lines_dropped > 0").count() == 0


def test_short_lines(spark):
    rows = [(i, f"All rights reserved.\nAnd.\n漢字かな交じり文の一行です\n{prose(i, 20)}") for i in range(9)]
    got = {r["doc_id"]: r for r in L.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["lines_dropped"] for i in range(9)] == [0] + [2] * 8 and got[3]["text"] == f"And.\n{prose(3, 20)}"


def test_edited_variants_of_a_recurring_line_go(spark):
    line = "the committee met on the first floor and read the minutes of the last session aloud"
    rows = [(i, f"{line}\n{prose(i, 20)}") for i in range(20)]
    edited = [(30, line.replace("minutes", "letters")), (31, line.replace("first", "third").replace("aloud", "twice"))]
    far = (32, "the committee met " + " ".join(f"w{c}x" for c in "abcdefghijklm"))
    df = spark.createDataFrame([*rows, *edited, far], "doc_id long, text string")
    gone = sorted(r["id"] for r in L.recurring(df, variants=True).collect())
    assert gone == [*range(1, 20), 30, 31]
    assert L.dedup(df, variants=True).where("doc_id in (30, 31)").select("text").distinct().first()["text"] == ""


def test_joins_beyond_the_broadcast(spark, monkeypatch):
    from hypercell.llm import common, queries

    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    oracle.same(queries.op3_line_dedup(spark, "/root/testdata/sf0.001"), queries.OP3_SQL, "/root/testdata/sf0.001")


def test_long_lines_go_from_two_documents_on(spark):
    long, short = prose(1, 60).replace("\n", " "), prose(2, 20).replace("\n", " ")
    rows = [(i, f"{prose(i + 10, 30)}\n{long}\n{short}") for i in (3, 5)]
    df = spark.createDataFrame([*rows, (4, f"{long}\n{long}"), (9, f"{long}x")], "doc_id long, text string")
    assert sorted((r["id"], r["line"]) for r in L.repeats(df).collect()) == [(4, 0), (4, 1), (5, len(rows[1][1].split("\n")) - 2)]
    got = {r["doc_id"]: r for r in L.dedup_long(df).collect()}
    assert [got[i]["lines_dropped"] for i in (3, 4, 5, 9)] == [0, 2, 1, 0] and short in got[5]["text"] and got[4]["text"] == ""


def test_near_copies_go_whole_and_long_lines_of_others_once(spark):
    import corpus_pipeline

    parts = [" ".join(f"{w}{p}" for w in prose(p + 1, 60).split()) for p in range(8)]
    rows = [(1, "\n".join(parts)), (2, "\n".join([*parts[:-1], parts[-1].replace("alpha", "alphax")])), (3, prose(50, 300) + "\n" + parts[0])]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), ""), "").collect()}
    assert got == {1: rows[0][1], 3: prose(50, 300)}


def test_odd_rows(spark, odd, none):
    out = L.dedup(odd)
    assert out.columns == [*odd.columns, "lines_dropped"]
    assert sorted(map(repr, out.drop("lines_dropped").collect())) == sorted(map(repr, odd.collect()))
    assert L.dedup(none).collect() == []
    many = odd
    for k in range(10):
        many = many.unionByName(odd.withColumn("doc_id", odd["doc_id"] + 1000 * (k + 1)))
    again = L.dedup(many)
    assert again.count() == many.count()
    assert again.where("doc_id = 1001").first()["text"] == "" and again.where("doc_id = 1").first()["lines_dropped"] == 0


def test_clashing_column(odd):
    assert L.dedup(L.dedup(odd)).columns.count("lines_dropped") == 1


def test_query(spark):
    from hypercell.llm import queries

    oracle.same(queries.op3_line_dedup(spark, "/root/testdata/sf0.01"), queries.OP3_SQL, "/root/testdata/sf0.01")
