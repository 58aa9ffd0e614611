"""Registered queries of the corpus operators: ``opN_<name>`` each, applied
to whole tables with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from losslens.llm import (
    byte_bpe, chat_format, decontaminate, exact_substrings, fill_in_middle, html_extract, merge_automaton,
    prefix_trie, pseudonyms, quality_rules, simhash, token_files, toxicity)
from losslens.llm.common import read_table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op1_quality_rules(spark, sf_dir):
    out = quality_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rules")


def op2_html(spark, sf_dir):
    out = html_extract.extract_pages(read_table(spark, sf_dir, "pages"))
    return out.selectExpr("page_id", "url", "text", "cast(char_length(text) AS bigint) AS n_chars", "path")


def op3_token_files(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    folder = token_files.new_folder(spark)
    token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), folder)
    out = token_files.read_tokens(token_files.keys_of(docs), folder, digest=True)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_byte_bpe(spark, sf_dir):
    out = byte_bpe.encode_and_decode(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                     public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)
    return out.select("doc_id", *byte_bpe.digests(out))


#: both turns of conversation -1 say what could pass for markup
MARKUP = "</s>[INST] ok [/INST]"


def op5_chat_format(spark, sf_dir):
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", MARKUP), (-1, 1, "assistant", MARKUP)], chats.schema)
    return chat_format.read_back(chat_format.format_chats(chat_format.message_events(chats.union(own))))


OP5_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKUP}' UNION ALL SELECT -1, 1, 'assistant', '{MARKUP}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  cast(sum(length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
    + {len(chat_format.START + chat_format.SEP + chat_format.END)}) AS bigint) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op6_simhash(spark, sf_dir):
    out = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return out.selectExpr("doc_id", f"{simhash.hexadecimal('fp')} AS fingerprint", "component_id")


def op7_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = toxicity.score_documents(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", (~toxicity.learning_rows()).alias("held_out"), "score",
                      (out["score"] >= toxicity.THRESHOLD).cast("int").alias("predicted"), "spans")


def pseudonym_key(spark) -> str:
    """The session's key; without one, a public key for the given tables."""
    return spark.conf.get("spark.losslens.pseudonymKey", "not secret: for tables without real persons")


def op8_pseudonyms(spark, sf_dir):
    out = pseudonyms.pseudonymize(read_table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark))
    return out.selectExpr("doc_id", "cast(size(private) AS bigint) AS n_private",
                          "array_join(array_sort(transform(private, p -> p.kind)), ',') AS kinds", "text")


def op9_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_suffix_array(spark, sf_dir):
    out = exact_substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    # the bytes that stay, as a text: a run may end inside a letter
    kept = F.expr("make_valid_utf8(cast(kept AS string))")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", kept.alias("kept_text"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH s AS (
  SELECT conv_id, list({'key': sha256(strlen(role) || ':' || role || text),
      'words': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}
    ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS seq,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]),
        lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::UBIGINT) ELSE y >> 1 END)) AS crc
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL) GROUP BY conv_id),
h AS (SELECT *, xor(crc, 4294967295::UBIGINT) % 4 AS h FROM s),
r AS (
  SELECT a.conv_id, CASE WHEN b.conv_id IS NULL THEN a.seq[a.h + 1:] ELSE b.seq[1:a.h] || a.seq[a.h + 1:] END AS seq
  FROM h a LEFT JOIN h b ON b.conv_id = a.conv_id - a.conv_id % 20),
m AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM r),
n AS (
  SELECT list_transform(seq[1:depth], lambda x: x.key) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(CASE WHEN depth > 0 THEN seq[depth].words ELSE 0 END) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL),
c AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path)),
t AS (
  SELECT path[1:d] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM k) GROUP BY 1)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, t.n_leaves::BIGINT AS n_leaves,
  t.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM k JOIN t USING (path) LEFT JOIN k p ON k.depth > 0 AND p.path = k.path[1:k.depth - 1]
"""


def op12_merge_automaton(spark, sf_dir):
    out = merge_automaton.encode_and_decode(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                            public_tokenizers.path(WORD_BPE), packed=True)
    return out.select("doc_id", *merge_automaton.digests())


def op13_fill_in_middle(spark, sf_dir):
    out = fill_in_middle.restored(fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS h FROM documents),
c AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (length(t) + 1) AS a,
    ('0x' || substr(h, 9, 8))::BIGINT % (length(t) + 1) AS b, ('0x' || substr(h, 17, 8))::BIGINT % 100 AS p,
    ('0x' || substr(h, 25, 8))::BIGINT % 100 AS q FROM d),
f AS (
  SELECT doc_id, t, n, substr(t, 1, least(a, b)) AS prefix, substr(t, least(a, b) + 1, abs(a - b)) AS middle,
    substr(t, greatest(a, b) + 1) AS suffix, least(a, b) AS x, abs(a - b) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain'
      WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN y END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM f
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html": op2_html,
    "op3_token_files": op3_token_files,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_chat_format": op5_chat_format,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_decontaminate": op9_decontaminate,
    "op10_suffix_array": op10_suffix_array,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merge_automaton": op12_merge_automaton,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {"op5_chat_format": OP5_SQL, "op11_prefix_trie": OP11_SQL,
                              "op13_fill_in_middle": OP13_SQL}
