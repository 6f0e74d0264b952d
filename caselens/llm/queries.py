"""The registered queries of the text operators, with SQL where SQL can say the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from caselens.checks.common import Case
from caselens.llm import jaccard, languages, mixing, neighbours, phrases, pieces, quality, repair, repair_sql, repeats, secrets, sharding, token_counts, tools
from caselens.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans"
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least ON a = doc_id
"""


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tools.from_conversations(table(spark, sf_dir, "conversations"))
    return tools.link(calls, results, tools.SCHEMAS)


OP6_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, 'call_' || substr(md5(conv_id || ':' || turn), 1, 24) AS call_id FROM conversations
), calls AS (
  SELECT conv_id, turn, call_id, min(CASE role WHEN 'user' THEN 'reply' ELSE 'instruct' END) AS name,
         min(text) AS text, count(*) AS n
  FROM turns WHERE role IN ('user', 'system') GROUP BY ALL
), results AS (
  SELECT conv_id, turn - 1 AS turn, 'call_' || substr(md5(conv_id || ':' || (turn - 1)), 1, 24) AS call_id,
         min(text) AS content, count(*) AS n
  FROM conversations WHERE role = 'assistant' GROUP BY ALL
), ways AS (
  SELECT conv_id, turn, 0::BIGINT AS level FROM calls
  UNION
  SELECT c.conv_id, c.turn, w.level + 1 FROM ways w JOIN calls c ON c.conv_id = w.conv_id AND c.turn IN (w.turn + 1, w.turn + 2)
), levels AS (
  SELECT conv_id, turn, max(level) AS level FROM ways GROUP BY ALL
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.name, l.level,
       CASE WHEN c.n IS NULL THEN 'orphan' WHEN r.n IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       coalesce(c.n, 1) + coalesce(r.n, 1) - 2 AS repeats,
       CASE WHEN c.n IS NULL THEN 'no call' ELSE '' END AS errors,
       '{"arguments":' || CASE WHEN c.n IS NULL THEN 'null'
            ELSE '{"text":' || to_json(c.text) || ',"turn":' || c.turn || '}' END
         || ',"content":' || coalesce(to_json(r.content)::VARCHAR, 'null')
         || ',"errors":' || CASE WHEN c.n IS NULL THEN '["no call"]' ELSE '[]' END
         || ',"id":"' || coalesce(c.call_id, r.call_id) || '","level":' || coalesce(l.level::VARCHAR, 'null')
         || ',"name":' || CASE WHEN c.n IS NULL THEN 'null' ELSE '"' || c.name || '"' END || '}' AS json
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.turn
LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.turn = c.turn
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("score", 6).alias("anomaly"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


# Inverse Poisson: the number of terms of the distribution function below the uniform number.
OP8_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n) FROM sizes) * (pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM sizes)) / n AS rate FROM sizes
), steps AS (
  SELECT source, rate, greatest(ceil(rate / 8.0), 1)::BIGINT AS parts FROM rates
), keyed AS (
  SELECT d.*, s.rate, s.parts, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS k
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
), drawn AS (
  SELECT *, (SELECT sum((SELECT count(*) FROM (
      SELECT sum(exp(-rate / parts + j * ln(rate / parts) - lgamma(j + 1))) OVER (ORDER BY j) AS below FROM range(0, 64) t(j))
      WHERE below < (('0x' || substr(md5('11|' || k || '|' || i), 1, 13))::BIGINT + 0.5) / 4503599627370496.0))
    FROM range(1, parts + 1) g(i)) AS times
  FROM keyed
), copied AS (SELECT * EXCLUDE (parts, times), unnest(range(1, times::BIGINT + 1))::INTEGER AS copy FROM drawn)
SELECT * EXCLUDE (k), (('0x' || substr(md5('11 place|' || k || '|' || copy || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS position
FROM copied
"""


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(8)
    larger = sharding.grown(tree, 8, "region1", "rack3")
    return sharding.shard_documents(table(spark, sf_dir, "documents"), tree, larger)


def _draw_sql(leaves: list[sharding.Leaf], levels: tuple[str, ...], path: str | None) -> str:
    """The shard of the key ``k``: at every level the child with the least draw."""
    if not levels:
        return str(leaves[0].shard)
    groups: dict[str, list[sharding.Leaf]] = {}
    for leaf in leaves:
        groups.setdefault(f"step{leaf.step}/{leaf.region}" if path is None else f"{path}/{getattr(leaf, levels[0])}", []).append(leaf)
    below = [_draw_sql(part, levels[1:], name) for name, part in groups.items()]
    if len(groups) == 1:
        return below[0]
    draws = ", ".join(
        f"{{'d': -ln((('0x' || substr(md5(k || '/{name}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / {sum(x.weight for x in part)}, 'i': {i}}}"
        for i, (name, part) in enumerate(groups.items()))
    return f"CASE list_sort([{draws}])[1].i " + " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(below)) + " END"


# The rows are fewer than one tile holds, so slots are in order of id, checksum and size.
OP9_SQL = f"""
WITH {repair_sql.CRC}, sized AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'none') AS k, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM documents, crc
), placed AS (
  SELECT *, {_draw_sql(sharding.even_tree(8), ('region', 'rack', 'shard'), None)} AS shard,
    {_draw_sql(sharding.grown(sharding.even_tree(8), 8, 'region1', 'rack3'), ('region', 'rack', 'shard'), None)} AS grown_shard
  FROM sized
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM placed
"""


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("cuts")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM cut
), totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
  FROM words, range(1, 6) t(m) WHERE len(w) >= m
), found AS (
  SELECT lang, m, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100
), longer AS (
  SELECT lang, phrase, max(lft) AS left_most, max(rgt) AS right_most FROM (
    SELECT lang, array_to_string(w[2:], ' ') AS phrase, a AS lft, NULL::BIGINT AS rgt FROM found WHERE m > 2
    UNION ALL SELECT lang, array_to_string(w[:m - 1], ' '), NULL, a FROM found WHERE m > 2) GROUP BY lang, phrase
), held AS (
  SELECT DISTINCT s.lang, s.phrase FROM found s JOIN (
    SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM found, range(2, 5) g(k), range(1, 6) h(i) WHERE m > k AND i + k - 1 <= m) x
  ON s.lang = x.lang AND s.phrase = x.phrase AND 100 * x.a >= 100 * s.a
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM found c, range(1, 5) t(k), totals, found l, found r
  WHERE c.m > 1 AND k < c.m AND totals.lang = c.lang AND l.lang = c.lang AND r.lang = c.lang
    AND l.phrase = array_to_string(c.w[:k], ' ') AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts ANTI JOIN held USING (lang, phrase)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score::BIGINT AS score, left_most, right_most
FROM lowest LEFT JOIN longer USING (lang, phrase)
QUALIFY rank <= 2000
"""


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.predict_held_out(table(spark, sf_dir, "documents"))


CASES: dict[str, Case] = {
    "op1_secrets": Case(op1_secrets),
    "op2_jaccard": Case(op2_jaccard, OP2_SQL),
    "op3_neighbours": Case(op3_neighbours),
    "op4_token_counts": Case(op4_token_counts),
    "op5_pieces": Case(op5_pieces),
    "op6_tool_calls": Case(op6_tool_calls, OP6_SQL),
    "op7_quality": Case(op7_quality),
    "op8_mixing": Case(op8_mixing, OP8_SQL),
    "op9_sharding": Case(op9_sharding, OP9_SQL),
    "op10_repeats": Case(op10_repeats),
    "op11_phrases": Case(op11_phrases, OP11_SQL),
    "op12_repair": Case(op12_repair, repair_sql.SQL),
    "op13_language": Case(op13_language),
    "pipeline": Case(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
