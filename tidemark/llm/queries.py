"""The registered queries of this subpackage: thin forms of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer_path

from tidemark.llm import collocations, decontam, langid, packing, parsing, secrets, sharding, simhash, spelling, substring, suffixes, webtext, wordpiece
from tidemark.sources.star import table


def op1_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), threshold=4, shingle=4)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit_documents(docs)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


SHARD_NAMES = [f"shard-{i:03d}" for i in range(sharding.SHARDS)]


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.place(table(spark, sf, "documents"), "doc_id", SHARD_NAMES)


def op4_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.edit_likeness(table(spark, sf, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op7_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("row_key")


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(spelling.misprinted(spelling.letter_runs(docs))))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op13_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return webtext.extract(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_language_id": op2_language_id,
    "op3_sharding": op3_sharding,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scan": op9_secret_scan,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_html_extraction": op13_html_extraction,
}

#: The table is filled one claim a step; the last step has all slots.
OP3_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i, printf('shard-%03d', i) AS shard,
         CAST('0x' || substr(md5(printf('shard-%03d', i) || '/offset'), 1, 15) AS BIGINT) % {sharding.SLOTS} AS off,
         CAST('0x' || substr(md5(printf('shard-%03d', i) || '/skip'), 1, 15) AS BIGINT) % {sharding.SLOTS - 1} + 1 AS skip
  FROM range({sharding.SHARDS}) r(i)),
lists AS (SELECT list(off ORDER BY i) AS offs, list(skip ORDER BY i) AS skips FROM shards),
fill AS (
  SELECT 0 AS step, CAST(-1 AS BIGINT) AS slot, list_transform(range({sharding.SLOTS}), lambda x: true) AS free
  UNION ALL
  SELECT step + 1, s, list_transform(range({sharding.SLOTS}), lambda x: free[x + 1] AND x <> s)
  FROM (SELECT step, free,
               (offs[step % {sharding.SHARDS} + 1] + skips[step % {sharding.SHARDS} + 1] *
                 list_filter(range({sharding.SLOTS}), lambda j: free[(offs[step % {sharding.SHARDS} + 1] + j * skips[step % {sharding.SHARDS} + 1]) % {sharding.SLOTS} + 1])[1]) % {sharding.SLOTS} AS s
        FROM fill, lists WHERE step < {sharding.SLOTS})),
owned AS (SELECT slot, shard FROM fill JOIN shards ON i = (step - 1) % {sharding.SHARDS} WHERE slot >= 0)
SELECT doc_id, text, lang, source, n_chars, slot, shard
FROM (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) % {sharding.SLOTS} AS slot FROM documents)
JOIN owned USING (slot)
"""

OP10_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM items WHERE len(ws) > 0)),
there AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM lowered, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
found AS (SELECT doc_id, item_id, i, t.n FROM there t JOIN windows USING (w)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM lowered LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: CRC-32 byte by byte; the table of its 256 steps is made by the polynomial.
OP11_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS k, i AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
parts AS (
  SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS part FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM parts a JOIN parts b ON a.i = b.i AND a.part = b.part AND a.word <> b.word
  UNION ALL
  SELECT DISTINCT a.word, a.n, w.word, w.n FROM parts a JOIN words w ON a.part = w.word),
near AS (SELECT * FROM pairs UNION SELECT other, other_n, word, n FROM pairs),
told AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS top, max(other_n) AS top_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * w.n THEN top END AS form, CASE WHEN top_n >= 2 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN told USING (word)),
walk AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL
  SELECT walk.word, f.word, f.form FROM walk JOIN formed f ON f.word = walk.ahead)
SELECT f.word, f.form, walk.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN walk ON walk.word = f.word AND walk.ahead IS NULL
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
        FROM pieces, range(1, 6) r(k) WHERE len(ws) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
cuts AS (
  SELECT lang, k, phrase, f AS a, c, string_split(phrase, ' ') AS ws FROM f, range(1, 5) r(c) WHERE c < k),
scored AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, c, l.f AS l, r.f AS r, n,
         CAST((1000 * CAST(a AS HUGEINT) * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(ws[1 : c], ' ')
            JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(ws[c + 1 :], ' ')
            JOIN total ON total.lang = cuts.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, k, a, string_split(phrase, ' ') AS ws FROM weakest), range(2, 5) s(m), range(1, 5) t(i)
  WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inner_parts p USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

#: All pages of these tables mark the main text as an article and use four named references, some of them cut off.
OP13_SQL = r"""
WITH blocks AS (
  SELECT page_id, url, regexp_split_to_array(regexp_extract(html, '(?s)<article[^>]*>(.*?)(</article>|$)', 1), '</?(?:p|h[1-6])(?:\s[^>]*)?>') AS bs FROM pages),
cleaned AS (
  SELECT page_id, url, list_filter(list_transform(bs, lambda b: trim(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'),
      '&quot;', '"', 'g'), '&copy;', '©', 'g'), '&middot;', '·', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda b: b <> '') AS bs
  FROM blocks)
SELECT page_id, url, coalesce(array_to_string(bs, chr(10)), '') AS text, CAST(length(coalesce(array_to_string(bs, chr(10)), '')) AS BIGINT) AS n_chars
FROM cleaned
"""

ORACLES = {
    "op3_sharding": OP3_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_html_extraction": OP13_SQL,
}
