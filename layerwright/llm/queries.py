"""One registered query per operator, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import (
    bpe,
    chat,
    html,
    language,
    packing,
    periodic,
    prefixes,
    quality,
    recipes,
    simhash,
    substrings,
    toxicity,
    vectors,
)
from layerwright.llm.spark import read

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(read(spark, sf_dir, "pages"))


def op2_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents found toxic, with the probabilities of the chain. The chain follows the columns of ``labels``:
    low quality first, which feeds toxicity."""
    labels = read(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    found = toxicity.classified(read(spark, sf_dir, "documents"), labels, ("low_quality", "toxic"))
    return found.filter("toxic").select("doc_id", "toxic", "p_toxic", "p_low_quality")


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op5_binary_code_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(read(spark, sf_dir, "embeddings"), limit=0.98)


def op6_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(read(spark, sf_dir, "documents"))


def op7_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row is the opening event of a message of its own; conversation -7 has control strings for text."""
    own = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    planted = spark.createDataFrame(own, "conv_id long, turn int, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    events = rows.select(
        "conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("message_id"),
        F.lit("message").alias("kind"), "role", "text",
    )
    return chat.digests(chat.render(chat.fold(events)))


def op8_byte_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS))


def op9_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.linked(read(spark, sf_dir, "documents"), most=4, shingle=4)
    return found.select("doc_id", simhash.hex_code().alias("fingerprint"), "component_id")


def op10_language_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identified(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", F.col("score"), "accepted", "bits")


def op11_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.found(periodic.with_planted(read(spark, sf_dir, "documents"))))


def op12_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.classes(read(spark, sf_dir, "documents"))


def op13_zfast_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.marked(read(spark, sf_dir, "conversations"))
    return prefixes.trie(prefixes.with_shared_openings(turns), prefixes.conversation_ids(turns)).drop("key")


QUERIES = {
    "op1_wrapper_induction": op1_wrapper_induction,
    "op2_classifier_chain": op2_classifier_chain,
    "op3_quality_divergence": op3_quality_divergence,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_binary_code_embeddings": op5_binary_code_embeddings,
    "op6_collinear_chaining": op6_collinear_chaining,
    "op7_event_sourced_chat": op7_event_sourced_chat,
    "op8_byte_bpe_segment_tree": op8_byte_bpe_segment_tree,
    "op9_simhash_gray_index": op9_simhash_gray_index,
    "op10_language_kneser_ney": op10_language_kneser_ney,
    "op11_maximal_pair_runs": op11_maximal_pair_runs,
    "op12_chunk_recipes": op12_chunk_recipes,
    "op13_zfast_prefix_trie": op13_zfast_prefix_trie,
}


#: CRC-32 of a decimal number's digits, byte by byte and bit by bit.
CRC = """xor(list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in chat.CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


ORACLE: dict[str, str] = {
    "op5_binary_code_embeddings": """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON vec_id = a""",
    "op7_event_sourced_chat": f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(9 + length({_escaped('text')}) + length(replace({_escaped('role')}, chr(10), '\\n'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY 1""",
    "op11_maximal_pair_runs": f"""WITH split AS MATERIALIZED (
  SELECT doc_id, {WORDS.format("text")} AS v, {CRC.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents
), sized AS (
  SELECT *, len(v) AS n, h // 10 AS g FROM split
), placed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized
), planted AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN v ELSE list_transform(range(n),
    lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM placed
), words AS MATERIALIZED (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM planted
), fives AS MATERIALIZED (
  SELECT doc_id, n, i, [word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d] AS five
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM fives a JOIN fives b ON a.doc_id = b.doc_id AND a.five = b.five AND a.i < b.i
  WHERE b.i + 4 < b.n AND 4 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again) GROUP BY doc_id, q, island
), runs AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY 1, 2, 3
), longest AS (
  SELECT doc_id, count(*) AS n_runs, arg_min([start, length, period], [-length, start, period]) AS run,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY 1
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY 1
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, run[1] AS start, run[2] AS length, run[3] AS period,
  1000 * run[2] // run[3] AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_chunk_recipes": r"""WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), groups AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM texts JOIN groups USING (t)""",
    "op13_zfast_prefix_trie": f"""WITH turns AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len({WORDS.format("text")}) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC.format("CAST(conv_id AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT ids.conv_id, pos, digest, words FROM ids JOIN turns ON turns.conv_id = base WHERE pos < h
  UNION ALL SELECT conv_id, 4 + pos, digest, words FROM ids JOIN turns USING (conv_id) WHERE pos >= h
), paths AS (
  SELECT conv_id, coalesce(string_agg(digest, '' ORDER BY pos), '') AS path,
    coalesce(list(words ORDER BY pos) FILTER (digest IS NOT NULL), []) AS words
  FROM ids LEFT JOIN rebuilt USING (conv_id) GROUP BY 1
), members AS MATERIALIZED (
  SELECT conv_id, unnest(range(len(words) + 1)) AS depth, path, words FROM paths
), nodes AS MATERIALIZED (
  SELECT left(path, 64 * depth) AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS words,
    coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(words) = depth), '') AS ends
  FROM members GROUP BY 1, 2
), children AS (
  SELECT left(prefix, 64 * (depth - 1)) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS MATERIALIZED (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (prefix)
), sums AS (
  SELECT v.prefix, count(*) FILTER (u.n_children = 0) AS n_leaves, CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens
  FROM full_nodes v JOIN full_nodes u ON starts_with(u.prefix, v.prefix) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums USING (prefix)
LEFT JOIN full_nodes p ON n.depth > 0 AND p.prefix = left(n.prefix, 64 * (n.depth - 1))""",
}
