"""The queries ``opN_<name>`` of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypercell.llm import bpe, chat, decontaminate, idfiles, licenses, linededup, neardup, quality, telephony, toxicity
from hypercell.llm.common import scratch
from hypercell.llm.labelled import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> bpe.Codec:
    import public_tokenizers

    return bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary(), decoded=True)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        "contaminated",
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {decontaminate.WINDOW} + 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw))),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {decontaminate.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_turns(turns))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("lines"))
    out = linededup.dedup(docs, variants=True, long=True)
    return out.select("doc_id", "lines", "lines_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


_RAW = "regexp_extract_all(l, '[^ \\t\\r\\f\\v]+')"
_CONSTANTS = f"list_filter(t.f, lambda x: x <> '{linededup.FIELD}')"
OP3_SQL = f"""
WITH raw AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
parsed AS (SELECT doc_id, i, l, list_transform({_RAW}, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{linededup.FIELD}' ELSE t END) AS t FROM raw WHERE length(array_to_string({_RAW}, '')) >= {linededup.MIN_CHARS}),
leaves AS (SELECT doc_id, i, t, len(t) || ' ' || array_to_string(t[1:{linededup.DEPTH}], ' ') AS leaf FROM parsed),
placed AS (SELECT doc_id, i, leaf, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM leaves),
stays AS (SELECT leaf, place, token FROM placed GROUP BY ALL HAVING count(DISTINCT doc_id) >= {linededup.MIN_DOCS}),
fields AS (SELECT doc_id, i, p.leaf, p.place, CASE WHEN s.token IS NULL THEN '{linededup.FIELD}' ELSE p.token END AS f FROM placed p LEFT JOIN stays s ON p.leaf = s.leaf AND p.place = s.place AND p.token = s.token),
made AS (SELECT doc_id, i, min(leaf) AS leaf, string_agg(f, ' ' ORDER BY place) AS template FROM fields GROUP BY doc_id, i HAVING 100 * count(*) FILTER (f <> '{linededup.FIELD}') >= {linededup.CONSTANT} * count(*)),
counted AS (SELECT template, min(leaf) AS leaf, min(doc_id) AS first, string_split(template, ' ') AS f FROM made GROUP BY template HAVING count(DISTINCT doc_id) >= {linededup.MIN_DOCS}),
own AS (SELECT doc_id, i, first FROM made JOIN counted USING (template)),
near AS (SELECT l.doc_id, l.i, t.template, t.first, len(list_filter(range(1, len(t.f) + 1), lambda k: t.f[k] <> '{linededup.FIELD}' AND t.f[k] = l.t[k])) AS same, len({_CONSTANTS}) AS size
  FROM leaves l JOIN counted t ON l.leaf = t.leaf ANTI JOIN own o ON l.doc_id = o.doc_id AND l.i = o.i),
variant AS (SELECT doc_id, i, first FROM near WHERE 100 * same >= {linededup.CONSTANT} * size QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY -same / size, template) = 1),
long AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY l) AS first FROM parsed WHERE len(t) > {linededup.LONG}),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT * FROM own UNION ALL SELECT * FROM variant UNION ALL SELECT * FROM long) WHERE doc_id <> first)
SELECT raw.doc_id, count(*) AS lines, count(gone.i) AS lines_dropped, sha256(coalesce(string_agg(l, chr(10) ORDER BY raw.i) FILTER (gone.i IS NULL), '')) AS text_sha256
FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.i = gone.i GROUP BY raw.doc_id"""


#: Folds by CRC-32 of the id, and the one that no label is learned from.
QUALITY_FOLDS, QUALITY_HELD_OUT = 4, 2
TOXIC_FOLDS, TOXIC_HELD_OUT = 5, 0


def _scored(scores: DataFrame, folds: int, held_out: int, cut: float) -> DataFrame:
    return scores.select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(_table(spark, sf_dir, "documents"))
    model = quality.train_measured(measured, _table(spark, sf_dir, "labels"), folds=QUALITY_FOLDS, held_out=QUALITY_HELD_OUT)
    return _scored(quality.score_measured(measured, model), QUALITY_FOLDS, QUALITY_HELD_OUT, quality.CUT)


def op7_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "ids")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        idfiles.write(_table(spark, sf_dir, "documents"), path, f.read(), end_id=0)
    return idfiles.read(spark, path, keep_ids=False).select(F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), folds=TOXIC_FOLDS, held_out=TOXIC_HELD_OUT)
    return _scored(toxicity.score(docs, model), TOXIC_FOLDS, TOXIC_HELD_OUT, 0.5)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(_table(spark, sf_dir, "documents"))


_CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]")
_LONGER = "(length({0}) - length(replace({0}, '\\', '')))" + "".join(f" + (length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in _CONTROL)
OP5_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({chat.FRAME} + length(role) + length(text) + {_LONGER.format("role")} + {_LONGER.format("text")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def _op6_sql() -> str:
    line = "array_to_string(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), ' ')"
    spelled = "array_to_string(list_transform(string_split(c, ' '), lambda w: CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in licenses.SPELLINGS.items()) + " ELSE w END), ' ')"
    known = ", ".join(f"('{n}', '{h}')" for n, h in licenses.digests())
    return f"""
WITH known(license, digest) AS (VALUES {known}),
raw AS (SELECT doc_id, i, {line} AS c FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
lines AS (SELECT doc_id, i, CASE WHEN regexp_matches(c, '^((copyright (c|©|[0-9]{{4}})|c [0-9]{{4}})( |$)|©)') THEN '' ELSE {spelled} END AS c FROM raw),
blocks AS (SELECT *, sum(CASE WHEN c = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM lines),
units AS (SELECT doc_id, 'line' AS unit, c FROM lines WHERE c <> ''
  UNION ALL SELECT doc_id, 'block', string_agg(c, ' ' ORDER BY i) FROM blocks WHERE c <> '' GROUP BY doc_id, b HAVING count(*) > 1
  UNION ALL SELECT doc_id, 'text', string_agg(c, ' ' ORDER BY i) FROM lines WHERE c <> '' GROUP BY doc_id),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_matches, bool_or(unit = 'text') AS whole FROM units JOIN known ON sha256(c) = digest GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0) AS n_matches, coalesce(whole, false) AS whole
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN found USING (doc_id)"""


def op10_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = telephony.load(telephony.store(_table(spark, sf_dir, "documents")))
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, length(payload) - 31, 32)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.sha2("pcm", 256).alias("pcm_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_decontaminate": op2_decontaminate,
        "op3_line_dedup": op3_line_dedup,
        "op4_quality": op4_quality,
        "op5_chat": op5_chat,
        "op6_licenses": op6_licenses,
        "op7_id_files": op7_id_files,
        "op8_toxicity": op8_toxicity,
        "op9_near_dedup": op9_near_dedup,
        "op10_telephony": op10_telephony,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2_SQL, "op3_line_dedup": OP3_SQL, "op5_chat": OP5_SQL, "op6_licenses": _op6_sql()}
