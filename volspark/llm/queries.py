"""The operators of this folder as queries over whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    exact,
    html,
    langid,
    licenses,
    mixing,
    pii,
    quality,
    simhash,
    spelling,
    topk,
    trie,
    wordpiece,
)

#: The key of the pseudonyms in the query; a user brings a secret one.
PII_KEY = "an open key, for tests only"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), PII_KEY)


def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op5_fuse_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


def op6_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op7_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.languages(docs, langid.fit(docs), spans=False)
    return found.withColumn("held_out", langid.held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op8_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = wordpiece.byte_strings(bpe.default_vocabulary())
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op9_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("licences", ",").alias("licences"))


def op10_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), with_ids=False)


def op11_pairwise_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    found = quality.scores(docs, model)
    return found.withColumn("held_out", quality.held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.sequences(table(spark, sf_dir, "conversations"), family=20))


def op13_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), every=31)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_pareto_mix,
        op2_pivot_topk,
        op3_feistel_pseudonyms,
        op4_simhash_anchors,
        op5_fuse_filter_dedup,
        op6_template_removal,
        op7_viterbi_language,
        op8_longest_match_counts,
        op9_licence_rules,
        op10_backtracking_bpe,
        op11_pairwise_additive_quality,
        op12_prefix_trie,
        op13_pivotal_spelling,
    )
    return {query.__name__: query for query in found}


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, text,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST('0x' || substr(md5(concat_ws(':', '1', CAST(doc_id AS VARCHAR), text)), 1, 13)
               AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3::DOUBLE WHEN 1 THEN 1::DOUBLE ELSE 2::DOUBLE END AS weight,
         2::DOUBLE * source_size AS most FROM per),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(most) OVER (ORDER BY most / weight, rank
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY most / weight, rank
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
plan AS (
  SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected FROM plan),
opened AS (
  SELECT *, floor(expected) AS whole, target - floor(expected) * source_size AS open_words,
         expected - floor(expected) AS part FROM parts),
keyed AS (
  SELECT d.*, o.source_size, o.target, o.whole, o.open_words,
         CASE WHEN part > 0 THEN
           (u / (1 - u)) / ((part / (1 - part)) * sqrt(greatest(size, 1)::DOUBLE)) END AS ratio
  FROM docs d JOIN opened o ON d.source IS NOT DISTINCT FROM o.source),
ordered AS (
  SELECT *, coalesce(least(CAST(floor(ratio / (1 + ratio) * 281474976710656) AS BIGINT),
                           281474976710655), 281474976710655) AS k FROM keyed),
added AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k
                            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
            sum(size) OVER (PARTITION BY source, k) AS here FROM ordered)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN open_words > 0 AND upto - here + here / 2.0 <= open_words
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM added
"""

OP2_SQL = r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
            AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP5_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM docs WINDOW same AS (PARTITION BY text)
"""


#: crc32, a byte at a time; SQL here has none. ``crc_of`` takes 'bytes', a list of numbers.
CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, step:
                CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) numbers(i)))
"""


def _crc(string: str) -> str:
    """crc32 of an SQL string, where crc_table is joined."""
    hexed = f"hex({string})"
    numbers = (
        f"list_transform(range(length({hexed}) // 2),"
        f" lambda i: CAST('0x' || substr({hexed}, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
    )
    return (
        f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {numbers}),"
        " lambda c, b: xor(crcs[CAST((xor(c, b) & 255) + 1 AS INTEGER)], c >> 8)))"
    )


OP12_SQL = rf"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS told
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(words || ':' || told ORDER BY turn NULLS FIRST, words, told) AS own,
         {_crc("CAST(conv_id AS VARCHAR)")} % 4 AS h
  FROM turns, crc_table GROUP BY conv_id, crcs),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
paths AS (
  SELECT conv_id, len(seq) AS size, seq, CAST(unnest(range(len(seq) + 1)) AS BIGINT) AS depth
  FROM whole),
nodes AS (
  SELECT seq[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth > 0 THEN CAST(split_part(any_value(seq[depth]), ':', 1) AS BIGINT)
              ELSE 0 END * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM paths GROUP BY 1, 2),
kids AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
upward AS (
  SELECT node[1:up] AS node, CAST(sum(saved) AS BIGINT) AS saved_tokens,
         count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, u.n_leaves,
       u.saved_tokens, c.ends_sha256
FROM counted c JOIN upward u USING (node)
LEFT JOIN nodes p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]
"""

OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
         count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, times, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
  FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(times) >= 2),
cut AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
links AS (
  SELECT DISTINCT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest)
  WHERE length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT word, rest FROM cut SEMI JOIN words w ON cut.rest = w.word
  UNION SELECT rest, word FROM cut SEMI JOIN words w ON cut.rest = w.word),
best AS (
  SELECT l.word, count(*) AS n_near, max(o.n) AS most, arg_min(l.other, (-o.n, l.other)) AS other
  FROM links l JOIN words o ON l.other = o.word GROUP BY 1),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN other END AS form,
         CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)),
walks AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT w.word, w.next, f.form FROM walks w JOIN formed f ON f.word = w.next)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, w.root
FROM formed f JOIN walks w ON f.word = w.word AND w.next IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_pareto_mix": OP1_SQL,
        "op2_pivot_topk": OP2_SQL,
        "op5_fuse_filter_dedup": OP5_SQL,
        "op12_prefix_trie": OP12_SQL,
        "op13_pivotal_spelling": OP13_SQL,
    }
