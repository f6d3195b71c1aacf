import brute
import corpus_pipeline
import oracle
import pytest
from brute import prose

from hypercell.llm import decontaminate, quality, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.schema.simpleString() == docs.schema.simpleString()
        before, after = docs.collect(), out.collect()
        kept.append((before, after))
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    ids = [({r["doc_id"] for r in a}, {r["doc_id"] for r in b}) for a, b in kept]
    assert all(b <= a for a, b in ids)

    scores = {r["doc_id"]: r["predicted"] for r in queries.op4_quality(spark, SF).collect()}
    assert ids[0][1] == {i for i in ids[0][0] if scores[i]}

    dropped = {r["doc_id"]: r for r in kept[1][1]}
    for r in kept[1][0]:
        if r["doc_id"] in dropped:
            old, new = r["text"].split("\n"), dropped[r["doc_id"]]["text"].split("\n")
            it = iter(old)
            assert all(x in it for x in new)  # what stays is in order
            assert dropped[r["doc_id"]]["n_chars"] == len(dropped[r["doc_id"]]["text"])

    near = brute.near([(r["doc_id"], r["text"]) for r in kept[2][0]])
    assert ids[2][1] == {i for i, (_, c) in near.items() if c == i}

    bench = decontaminate.Matcher([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])

    def bad(text):
        w = decontaminate.words(text)
        hit = sum(b - a for a, b in bench.scan(w)[0])
        return hit > 0 and 20 * hit >= len(w)

    assert ids[3][1] == {r["doc_id"] for r in kept[3][0] if not bad(r["text"])}
    assert ids[4][1] == ids[4][0]


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:2] == ["doc_id", "n_tokens"]
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_order_of_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near dedup", "decontamination", "byte bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows_pass_every_stage(spark, odd, none):
    docs = odd.unionByName(spark.createDataFrame([(500 + i, prose(i, 60)) for i in range(12)], "doc_id long, text string"), allowMissingColumns=True)
    for frame in (docs, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, SF)
            assert out.count() <= frame.count()
            if k < 4:
                assert out.columns == frame.columns


@pytest.mark.parametrize("name", ["op2_decontaminate"])
def test_sql(spark, name):
    oracle.same(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


def test_quality_needs_no_id(odd):
    assert quality.keep(odd.drop("doc_id"), quality.fit(*[__import__("numpy").empty((0, len(quality.FEATURES))), __import__("numpy").empty(0, int)])).count() == odd.count()
