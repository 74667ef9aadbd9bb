"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.bpe import decode, encode
from sluice.llm.chat_format import format_conversations
from sluice.llm.html_extract import extract_text
from sluice.llm.lattice_dedup import near_vectors
from sluice.llm.license_rules import scan
from sluice.llm.packing import cut_pieces, pack
from sluice.llm.quality_rules import quality_rules
from sluice.llm.ranked_search import ranked_search
from sluice.llm.simhash_dedup import near_duplicates
from sluice.llm.suffix_dedup import remove_repeats
from sluice.llm.toxicity import held_out, learn, score_documents
from sluice.llm.warc import archive_round_trip
from sluice.llm.whitening import whiten

#: The vocabulary file of the contracts; every operator takes its path as a parameter.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_html_extract(spark, d):
    pages = _t(spark, d, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_quality_rules(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text", "source")
    return quality_rules(docs, carry_all=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "host_rejected", "kept")


def op3_packing(spark, d, tokenizer=TOKENIZER):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    pieces = cut_pieces(docs, tokenizer, keep=["doc_id"])
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op4_warc(spark, d):
    pages = _t(spark, d, "pages").select("page_id", "url", "html")
    return archive_round_trip(spark, pages).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op5_lattice_dedup(spark, d):
    vectors = _t(spark, d, "embeddings").select("vec_id", "embedding", "label")
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


def op6_bpe(spark, d, tokenizer=TOKENIZER):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return decode(encode(docs, tokenizer, keep=["doc_id"]), tokenizer).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_chat_format(spark, d):
    turns = _t(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return format_conversations(turns.unionByName(extra)).select(
        F.col("conversation").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op8_simhash_dedup(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return near_duplicates(docs, carry_text=False).select("doc_id", "fingerprint", "component_id")


def op9_license_rules(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return scan(docs).select(
        "doc_id", F.array_join("licenses.license", ",").alias("licenses"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["first"], x["last"], F.array_join(x["sentences"], "+"))), ",").alias("matches"))


def op10_suffix_dedup(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_ranked_search(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    items = _t(spark, d, "benchmark").select("item_id", "text")
    return ranked_search(docs, items).select("item_id", "rank", F.col("doc_id").cast("long").alias("doc_id"), "score")


def op12_embedding_whitening(spark, d):
    return whiten(_t(spark, d, "embeddings").select("vec_id", "embedding"))


def op13_toxicity(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    grammar = learn(docs, _t(spark, d, "labels").select("doc_id", "toxic"))
    return score_documents(docs, grammar).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


ORACLES = {
    "op11_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT r, doc_id, len(ws)::BIGINT AS n FROM d WHERE len(ws) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (r), c GROUP BY item_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50
""",
    "op4_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM r
""",
    # The formatted length counts the template's markers and the backslashes of escaped content.
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
c AS (
  SELECT *, regexp_matches(text, '<s>|</s>|\[TURN |\[/TURN\]|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>') AS hit,
         len(regexp_extract_all(text, '<\\*s>|<\\*/s>|\[\\*TURN |\[\\*/TURN\]|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>|<\\*\|im_start\|>|<\\*\|im_end\|>')) AS more
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (7 + sum(length(role) + length(text) + 14) + CASE WHEN bool_or(hit) THEN sum(more) ELSE 0 END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""",
    "op2_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)),
dup AS (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1),
pos AS (SELECT DISTINCT win.r, win.i + k AS p FROM win JOIN dup USING (r, g), range(5) AS o(k)),
rep AS (SELECT r, count(*) AS n FROM pos GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
dl AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.doc_id, d.source, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN dl USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS m, var_pop(f / n) - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * avg(1 / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v <= 0 THEN 1e6 ELSE least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) END AS k FROM p),
bad AS (SELECT source, (f + m * k) / (n + k) > 0.5 AS host_rejected FROM h, s)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
       NOT base_failed AND NOT host_rejected AS kept
FROM b JOIN bad ON b.source IS NOT DISTINCT FROM bad.source
""",
}


def queries() -> dict:
    return {f.__name__: f for f in (op1_html_extract, op2_quality_rules, op3_packing, op4_warc, op5_lattice_dedup, op6_bpe, op7_chat_format, op8_simhash_dedup, op9_license_rules, op10_suffix_dedup, op11_ranked_search, op12_embedding_whitening, op13_toxicity)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
