"""The operators as queries over the driver tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import bpe, chat, fingerprints, langid, mixing, neardup, quality, records, sharding, spelling, substring, topk, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"""words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents)"""


@query("op1_bpe_transducer")
def op1(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_simhash_fingerprints")
def op2(spark, sf_dir):
    return fingerprints.compare(table(spark, sf_dir, "documents"))


@query("op3_binary_records")
def op3(spark, sf_dir):
    return records.through_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_factorisation_machine")
def op4(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_typed_chat_parts", r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (SELECT *, regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g') AS r, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS x FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, r, x) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(r) + length('<|text|>') + length(x) + length('<|end|>')) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM escaped GROUP BY conv_id""")
def op5(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    messages = said.unionByName(more).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_conversations(messages))


@query("op6_substring_dedup", f"""
WITH {WORDS_SQL},
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20),
hashed AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h FROM starts),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM hashed),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE n > 1),
gone_lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
    list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM documents d LEFT JOIN words USING (doc_id) LEFT JOIN gone_lists USING (doc_id)""")
def op6(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op7_pivotal_mixing")
def op7(spark, sf_dir):
    return mixing.copies(table(spark, sf_dir, "documents"))


@query("op8_pivot_distance_top_k", """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op8(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op9_minimax_shards")
def op9(spark, sf_dir):
    return sharding.shards_by_bytes(table(spark, sf_dir, "documents"))


@query("op10_simhash_near_dedup")
def op10(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


#: CRC-32 in SQL: the table of one byte's remainders, and the unsigned checksum of a list of bytes.
CRC_TABLE_SQL = """crc_table AS (SELECT list(v ORDER BY i) AS crc_t FROM (SELECT i, list_reduce(range(8), lambda c, x:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) AS r(i)))"""


def crc_sql(code_points: str) -> str:
    """Of a list of ASCII or Latin-1 code points, as UTF-8 bytes; ``crc_t`` must be in scope."""
    raw = f"flatten(list_transform({code_points}, lambda o: CASE WHEN o < 128 THEN [o] ELSE [192 + (o >> 6), 128 + (o & 63)] END))"
    return (f"xor(list_reduce({raw}, lambda c, b: xor(c >> 8, crc_t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")


def points_sql(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda ch: CAST(unicode(ch) AS BIGINT))"


@query("op11_byte_gru_language")
def op11(spark, sf_dir):
    return langid.judge(table(spark, sf_dir, "documents"))


@query("op12_bit_sliced_spelling", f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
checked AS (SELECT run, n, {crc_sql(points_sql("concat(doc_id, ':', run)"))} AS h FROM runs, crc_table),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
  ELSE run END AS word, n FROM checked),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, 100000) AS r(i) WHERE i <= length(word)),
near AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest),
best AS (SELECT near.word, count(*) AS n_near, arg_min({{'w': other, 'n': n}}, {{'m': -n, 'w': encode(other)}}) AS b FROM near JOIN words ON words.word = other GROUP BY near.word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.w END AS form,
  CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS place, 0 AS d FROM formed UNION ALL SELECT s.word, f.form, d + 1 FROM steps s JOIN formed f ON f.word = s.place WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(place, d) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM formed f JOIN steps s ON s.word = f.word GROUP BY f.word, f.form""")
def op12(spark, sf_dir):
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", f"""
WITH {CRC_TABLE_SQL},
said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
  md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS m FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'m': m, 'b': strlen(text)}} ORDER BY turn NULLS FIRST, role, m) AS turns FROM said GROUP BY conv_id),
shares AS (SELECT conv_id, turns, CAST({crc_sql(points_sql("CAST(conv_id AS VARCHAR)"))} % 9 AS BIGINT) AS h FROM own, crc_table),
made AS (SELECT s.conv_id, list_concat(CASE WHEN h = 0 THEN [] ELSE coalesce(f.turns[1:h], []) END, s.turns[h + 1:]) AS turns
  FROM shares s LEFT JOIN own f ON f.conv_id = s.conv_id - s.conv_id % 5),
steps AS (SELECT conv_id, d, md5(array_to_string(list_transform(CASE WHEN d = 0 THEN [] ELSE turns[1:d] END, lambda t: t.m), '')) AS k,
  CASE WHEN d = 0 THEN 0 ELSE turns[d].b END AS b, d = len(turns) AS is_end
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM made)),
nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, any_value(b) AS b,
  sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends FROM steps GROUP BY k, d),
family AS (SELECT n.k, n.d, s.k AS pk, p.conv_id AS pc FROM nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.d = n.d - 1
  JOIN nodes p ON p.k = s.k AND p.d = s.d),
kids AS (SELECT pk AS k, d - 1 AS d, count(*) AS c FROM family GROUP BY ALL),
sums AS (SELECT s.k, s.d, sum((u.n - 1) * u.b) AS saved, count(*) FILTER (kids.c IS NULL) AS leaves
  FROM nodes u LEFT JOIN kids ON kids.k = u.k AND kids.d = u.d JOIN steps s ON s.conv_id = u.conv_id AND s.d <= u.d GROUP BY s.k, s.d)
SELECT n.conv_id, n.d AS depth, pc AS parent_conv_id, n AS n_convs, coalesce(c, 0) AS n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM nodes n JOIN sums ON sums.k = n.k AND sums.d = n.d LEFT JOIN kids ON kids.k = n.k AND kids.d = n.d
LEFT JOIN family ON family.k = n.k AND family.d = n.d""")
def op13(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
