"""Queries of the text operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm.chat import repaired
from tidegrid.llm.decontaminate import contamination
from tidegrid.llm.exact_dedup import exact_duplicates
from tidegrid.llm.language_id import languages
from tidegrid.llm.line_dedup import near_duplicate_lines
from tidegrid.llm.lm_scoring import scores
from tidegrid.llm.near_dedup import near_duplicates
from tidegrid.llm.packing import pack
from tidegrid.llm.pii import pseudonymised
from tidegrid.llm.quality import qualities
from tidegrid.llm.resampling import resampled
from tidegrid.llm.secret_scan import secrets
from tidegrid.llm.variants import spelling_variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op2_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


def op3_line_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_lines(_table(spark, sf_dir, "documents"))


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(_table(spark, sf_dir, "documents"))


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).drop("text_hash")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(_table(spark, sf_dir, "documents"))


def op9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents")).drop("text_hash")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), least=7, often=2, ratio=10, drop=31)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), grams=1)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualities(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_near_duplicates,
        op2_chat_repair,
        op3_line_duplicates,
        op4_contamination,
        op5_lm_scores,
        op6_exact_duplicates,
        op7_packing,
        op8_secrets,
        op9_languages,
        op10_surrogates,
        op11_spelling_variants,
        op12_resampling,
        op13_quality,
    )
    return {f.__name__: f for f in ops}


SQL: dict[str, str] = {}

SQL["op1_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D]', ' ', 'g'), ' +'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id AND r.c < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


SQL["op3_line_duplicates"] = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, generate_subscripts(x, 1)::INTEGER - 1 AS line_no, trim(unnest(x), E' \t\r') AS norm
  FROM (SELECT doc_id, string_split(lower(coalesce(text, '')), E'\n') AS x FROM documents)),
c AS (SELECT norm, min(ROW(doc_id, line_no)) AS f FROM l WHERE norm <> '' GROUP BY norm),
s AS (SELECT DISTINCT norm, substring(norm, i, 9) AS g FROM (SELECT norm, unnest(range(1, greatest(length(norm) - 7, 2))) AS i FROM c)),
n AS (SELECT norm, count(*) AS n FROM s GROUP BY norm),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY t, g) AS p FROM (SELECT norm, g, count(*) OVER (PARTITION BY g) AS t FROM s)),
k AS (SELECT r.norm, r.g FROM r JOIN n USING (norm) WHERE p <= n - ceil(0.8 * n) + 1),
q AS (SELECT DISTINCT a.norm AS a, b.norm AS b FROM k a JOIN k b ON a.g = b.g AND a.norm < b.norm),
o AS (SELECT q.a, q.b, count(*) AS c FROM q JOIN s x ON x.norm = q.a JOIN s y ON y.norm = q.b AND y.g = x.g GROUP BY ALL),
e AS (
  SELECT a, b FROM (
    SELECT a, b FROM o JOIN n x ON x.norm = a JOIN n y ON y.norm = b WHERE 100 * c >= 80 * (x.n + y.n - c)
    UNION ALL
    SELECT b, a FROM o JOIN n x ON x.norm = a JOIN n y ON y.norm = b WHERE 100 * c >= 80 * (x.n + y.n - c))),
w(norm, f) AS (
  SELECT norm, f FROM c
  UNION
  SELECT e.b, w.f FROM w JOIN e ON e.a = w.norm),
m AS (SELECT norm, min(f) AS f FROM w GROUP BY norm)
SELECT doc_id, line_no, CASE WHEN m.f IS NULL THEN doc_id ELSE m.f[1] END AS keep_doc, CASE WHEN m.f IS NULL THEN line_no ELSE m.f[2] END AS keep_line,
  m.f IS NULL OR (doc_id = m.f[1] AND line_no = m.f[2]) AS kept
FROM l LEFT JOIN m ON m.norm = l.norm
"""

SQL["op4_contamination"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, w, least(len(w), 13) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
d AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
h AS (SELECT d.doc_id, d.i, d.k, v.item_id FROM d JOIN v ON d.g = v.g AND d.k = v.k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

SQL["op6_exact_duplicates"] = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM n
"""


#: crc32 of ``hex``, the bytes of a text as hexadecimal digits, by its table of 256 remainders.
_CRC = r"""
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"""


def _crc(hex_: str) -> str:
    octets = f"list_transform(range(length({hex_}) // 2), lambda i: ('0x' || substr({hex_}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)"


SQL["op11_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents),
g AS (SELECT doc_id, w, count(*) AS n FROM r WHERE length(w) >= 7 GROUP BY ALL),
h AS (SELECT w, n, {_crc("hex(encode(doc_id || ':' || w))")} AS h FROM g, crc_table),
d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
p AS (
  SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT x.word, v.word FROM x JOIN v ON v.word = x.cut
  UNION
  SELECT v.word, x.word FROM x JOIN v ON v.word = x.cut),
m AS (SELECT a, count(*) AS n_near, max(n) AS best FROM p JOIN v ON v.word = b GROUP BY a),
f AS (SELECT p.a AS word, min(b) AS form FROM p JOIN v ON v.word = b JOIN m ON m.a = p.a AND m.best = v.n JOIN v w ON w.word = p.a WHERE m.best >= 10 * w.n GROUP BY p.a),
c(word, root) AS (
  SELECT word, word FROM v
  UNION ALL
  SELECT c.word, f.form FROM c JOIN f ON f.word = c.root)
SELECT v.word, f.form, c.root, v.n, coalesce(m.n_near, 0)::BIGINT AS n_near, CASE WHEN f.form IS NOT NULL THEN m.best END AS form_n
FROM v LEFT JOIN m ON m.a = v.word LEFT JOIN f ON f.word = v.word JOIN c ON c.word = v.word AND NOT EXISTS (SELECT 1 FROM f z WHERE z.word = c.root)
"""

#: Words of a text between white space and punctuation of ASCII.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op12_resampling"] = rf"""
WITH {_CRC},
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
x AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
y AS (SELECT w, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) GROUP BY w),
b AS (SELECT w, {_crc("hex(encode(w))")} % 10000 AS b FROM (SELECT w FROM x UNION SELECT w FROM y), crc_table),
s AS (SELECT b, sum(n) AS s FROM x JOIN b USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS t FROM y JOIN b USING (w) GROUP BY b),
g AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS g
  FROM (SELECT DISTINCT b FROM b) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
m AS (SELECT doc_id, sum(n * g)::BIGINT AS total FROM x JOIN b USING (w) JOIN g USING (b) GROUP BY doc_id),
h AS (SELECT doc_id, len(w)::BIGINT AS n, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d),
f AS (
  SELECT doc_id, n, CASE WHEN n = 0 THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight, floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS z
  FROM h LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY weight + z DESC, doc_id) AS rank, count(*) OVER () AS e FROM f WHERE n >= 20)
SELECT f.doc_id, f.n AS n_features, weight::BIGINT AS weight, (weight + z)::BIGINT AS score, CASE WHEN rank <= 10 * e // 100 THEN rank END AS rank
FROM f LEFT JOIN r USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
