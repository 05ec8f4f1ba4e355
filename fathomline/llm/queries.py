"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import mixing, near_dedup, packing, piece_tokens, prefix_forest, quality, secrets, sharding, spelling, substring_dedup, suffix_dedup, vafile, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.cluster(_table(spark, sf_dir, "documents"))


def substring_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.search(_table(spark, sf_dir, "embeddings"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_table(spark, sf_dir, "documents"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.search(_table(spark, sf_dir, "embeddings"))


def rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_table(spark, sf_dir, "documents")).selectExpr("doc_id", "size", "text_crc32", "'key' AS law", "shard", "slot", "grown_shard")


def concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False)


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.digest(_table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": suffix_array_dedup,
        "op2_secret_scan": secret_scan,
        "op3_quality_classifier": quality_classifier,
        "op4_minhash_near_dedup": minhash_near_dedup,
        "op5_substring_dedup": substring_automaton_dedup,
        "op6_exact_top_k": exact_top_k,
        "op7_mixing": mix_sources,
        "op8_nearest_neighbours": nearest_neighbours,
        "op9_sharding": rendezvous_shards,
        "op10_packing": concatenate_and_cut,
        "op11_whitening": whitened_embeddings,
        "op12_sentencepiece": sentencepiece_round_trip,
        "op13_spelling_variants": spelling_variants,
    }


NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS t(i)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM words, unnest(range(1, len(w) - 11)) AS t(i)
), least AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k), gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM windows JOIN least USING (k), unnest(range(0, 13)) AS t(j) WHERE d < doc_id
), each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM words), left_ AS (
  SELECT each.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY each.i) AS t FROM each LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.i = each.i WHERE gone.i IS NULL GROUP BY each.doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM words LEFT JOIN left_ USING (doc_id)
"""

EXACT_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS key FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS no, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS whole FROM totals
), turns AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= weight * (whole - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS "full" FROM weighed
), levels AS (
  SELECT *, (max(whole) OVER () - sum(CASE WHEN "full" THEN cap ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN "full" THEN 0 ELSE weight END) OVER (), 0) AS level FROM turns
), goals AS (
  SELECT source, source_size, CASE WHEN "full" THEN cap ELSE least(cap, level * weight) END AS target FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget, sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, ((budget // greatest(source_size, 1)) * size + greatest(0, least(size, budget - (budget // greatest(source_size, 1)) * source_size - start)))::BIGINT AS taken FROM placed
"""

SHARDING = """
WITH bits AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t
), sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents
), summed AS (
  SELECT doc_id, size::BIGINT AS size, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM sized, bits
), bids AS (
  SELECT *, unnest(range(17)) AS bidder FROM summed
), hashed AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || bidder), 1, 15))::BIGINT AS u, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 15))::BIGINT AS place FROM bids
), won AS (
  SELECT doc_id, size, text_crc32, place, arg_max(bidder, u) FILTER (bidder < 16) AS shard, arg_max(bidder, u) AS grown_shard FROM hashed GROUP BY ALL
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard FROM won
"""

SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents), sized AS (SELECT doc_id, b, octet_length(b) AS n FROM texts),
windows AS (SELECT doc_id, s, array_slice(b, s + 1, s + 100) AS w FROM sized, unnest(range(n - 99)) AS t(s)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS turn FROM windows) WHERE turn > 1),
marked AS (SELECT doc_id, s, coalesce((s > lag(s) OVER w + 100)::INT, 1) AS new FROM late WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
runs AS (SELECT doc_id, min(s) AS start, max(s) + 100 AS stop FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked) GROUP BY doc_id, run),
cuts AS (SELECT doc_id, start, stop FROM runs UNION ALL SELECT doc_id, n, n FROM sized),
parts AS (SELECT doc_id, start, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start, stop), 0) AS begin FROM cuts),
kept AS (SELECT doc_id, unhex(string_agg(CASE WHEN start > begin THEN hex(array_slice(b, begin + 1, start)) ELSE '' END, '' ORDER BY start)) AS k FROM parts JOIN sized USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(k) AS kept_sha256 FROM sized JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

SPELLING = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents
), counted AS (
  SELECT doc_id, w, count(*) AS c FROM runs GROUP BY doc_id, w
), hashed AS (
  SELECT w, c, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)), '..'), lambda x: ('0x' || x)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM counted, crc
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 97 = 0 THEN w[: h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), cuts AS (
  SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, first(other ORDER BY m DESC, other) AS other FROM near GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.at WHERE form IS NOT NULL
)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk ON walk.word = f.word JOIN forms e ON e.word = walk.at WHERE e.form IS NULL
"""

ORACLE = {"op13_spelling_variants": SPELLING, "op1_suffix_array_dedup": SUFFIX_DEDUP, "op9_sharding": SHARDING, "op4_minhash_near_dedup": NEAR_DEDUP, "op5_substring_dedup": SUBSTRING_DEDUP, "op6_exact_top_k": EXACT_TOP_K, "op7_mixing": MIXING}
