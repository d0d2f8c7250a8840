"""Registered queries of the operators, and the SQL of those that SQL can express."""

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    periodic_runs,
    quality,
    token_files,
    url_filter,
    warc,
    whitening,
)
from creditmill.llm.common import WORD, table

TOKENIZER = os.environ.get("CREDITMILL_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many went as equal or near copies, and the digest of the text that is left."""
    told = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return told.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("text", 256).alias("text_sha256"))


def op3_line_dedup_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op3_line_dedup, with near copies of long lines within two or three edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = line_dedup.dedup_lines(docs, edits=line_dedup.EDITS_BY_LENGTH)
    return told.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2("text", 256).alias("text_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mixing.mix(docs).withColumn("taken", F.col("size") * F.col("copies"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), TOKENIZER).drop("ids")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("component")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = whitening.whitening(table(spark, sf_dir, "embeddings"))
    return told.withColumn("deviation", F.col("deviation").cast("bigint"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which those whose key hashes to a multiple of ten repeat some of their words from a place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n = F.col("words"), F.col("n")
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    told = (docs.filter(F.pmod(h, F.lit(10)) == 0)
            .select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)).alias("words"))
            .withColumn("n", F.size("words").cast("bigint"))
            .select("doc_id", "words", "n", a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).alias("p")))
    place = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1),
                        lambda i: F.get(words, F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")))
    changed = told.select("doc_id", F.when(n > 0, F.array_join(place, " ")).otherwise("").alias("text"))
    return changed.union(docs.filter(F.coalesce(F.pmod(h, F.lit(10)) != 0, F.lit(True))).select("doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    told = periodic_runs.periodic_runs(with_periods(docs))
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                                r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -F.col("best.less")
    return told.withColumn("best", first).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return told.withColumn("kept", F.col("vec_id") == F.col("component_id"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_exact_dedup, op3_line_dedup, op3_line_dedup_by_length, op4_warc, op5_mixing, op6_token_files, op7_url_filter,
    op8_quality, op9_jaccard_join, op10_language_id, op11_whitening, op12_periodic_runs, op13_embedding_dedup)}

OP2_SQL = """
WITH d AS (SELECT doc_id, rowid_ AS r, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
           FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents))
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, r)"""

_WORDS = "list_filter(string_split_regex({t}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP3_SQL = f"""
WITH l AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS line, unnest(s) AS t
           FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
o AS (SELECT *, {_WORDS.format(t='t')} AS w, row_number() OVER (ORDER BY doc_id NULLS LAST, line) AS no FROM l),
e AS (SELECT *, len(w) > 0 AND no > min(no) OVER (PARTITION BY t) AS again FROM o),
k AS (SELECT no, -1 AS place, array_to_string(w, ' ') AS v, len(w) AS n FROM e WHERE NOT again AND len(w) >= {line_dedup.NEAR_WORDS}
      UNION ALL SELECT no, place, array_to_string(list_concat(w[1:place - 1], w[place + 1:]), ' '), len(w) - 1
      FROM (SELECT no, w, unnest(range(1, len(w) + 1)) AS place FROM e WHERE NOT again AND len(w) >= {line_dedup.NEAR_WORDS})),
g AS (SELECT no, place, min(no) OVER (PARTITION BY v, n, place) AS same, min(CASE WHEN place < 0 THEN no END) OVER (PARTITION BY v, n) AS whole,
             min(no) OVER (PARTITION BY v, n) AS any_of FROM k),
d AS (SELECT DISTINCT no FROM g WHERE same < no OR whole < no OR place < 0 AND any_of < no),
r AS (SELECT e.doc_id, e.line, e.t, e.again, d.no IS NOT NULL AS near FROM e LEFT JOIN d ON e.no = d.no)
SELECT x.doc_id, CAST(coalesce(len(string_split(x.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(a.n_exact, 0) AS BIGINT) AS n_exact, CAST(coalesce(a.n_near, 0) AS BIGINT) AS n_near,
       CASE WHEN x.text IS NOT NULL THEN sha256(coalesce(a.kept, '')) END AS text_sha256
FROM documents x LEFT JOIN (SELECT doc_id, sum(again::INT) AS n_exact, sum(near::INT) AS n_near,
     string_agg(t, chr(10) ORDER BY line) FILTER (WHERE NOT again AND NOT near) AS kept FROM r GROUP BY doc_id) a ON x.doc_id = a.doc_id"""

OP4_SQL = """
WITH d AS (SELECT page_id, coalesce(html, '') AS b, row_number() OVER () AS r FROM pages),
h AS (SELECT page_id, r, CAST(strlen(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM d),
f AS (SELECT *, first_value(page_id) OVER w AS first_id, row_number() OVER w AS k FROM h
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k > 1 AND payload_bytes >= 100 THEN first_id END AS refers_to FROM f"""

OP5_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|7'), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM s),
o AS (SELECT *, coalesce(sum(source_size) OVER a, 0) AS capped, sum(weight) OVER b AS open_weight,
             sum(source_size) OVER () AS total, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k
      FROM w WINDOW a AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT (1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * capped::DOUBLE) / open_weight AS level FROM o
      WHERE 2.0::DOUBLE * source_size > weight * ((1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * capped::DOUBLE) / open_weight)
      ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM l), 0)) AS target FROM w),
g AS (SELECT source, h, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source, h),
u AS (SELECT g.*, t.source_size, t.target, floor(t.target / greatest(t.source_size, 1)) AS whole,
             sum(n) OVER (PARTITION BY g.source ORDER BY h ROWS UNBOUNDED PRECEDING) AS upto
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source),
c AS (SELECT source, h, source_size, target,
             CAST(least(whole + CASE WHEN upto - n / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END, 2) AS BIGINT) AS copies FROM u)
SELECT d.doc_id, d.size, c.source_size, c.target, d.size * c.copies AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h"""

# The components over canonical and refresh links are a recursive reach over both directions of each link.
_OP7_KEY = "nullif(translate(regexp_extract({u}, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"


def _op7_rule(host: str, path: str) -> str:
    arms = " ".join(f"WHEN ({host} = '{h}' OR {host} LIKE '%.{h}') AND starts_with({path}, '{p}') THEN '{a} {h}{p}'"
                    for a, h, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2])))
    return f"CASE {arms} END"


OP7_SQL = f"""
WITH RECURSIVE p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
                  CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT *, coalesce({_OP7_KEY.format(u='rest')}, '') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM p),
l AS (SELECT host || tail AS a, url, host, path, unnest(list_concat(
        list_transform(regexp_extract_all(html, '(?i)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>'),
                       lambda t: regexp_extract(t, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)),
        list_transform(regexp_extract_all(html, '(?i)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>'),
                       lambda t: regexp_extract(t, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>;]+)', 1)))) AS raw FROM q WHERE host <> ''),
r AS (SELECT a, replace(raw, '&amp;', '&') AS href, regexp_extract(url, '^[^:/?#]*://[^/?#]*') AS root,
             regexp_extract(path, '^(.*/)?', 0) AS folder FROM l WHERE raw <> ''),
t AS (SELECT a, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr(href, instr(href, '://') + 3)
                     WHEN starts_with(href, '//') THEN substr(href, 3)
                     WHEN starts_with(href, '/') THEN substr(root || href, instr(root, '://') + 3)
                     ELSE substr(root || coalesce(nullif(folder, ''), '/') || href, instr(root, '://') + 3) END AS rest FROM r),
e AS (SELECT a, {_OP7_KEY.format(u='rest')} || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS b FROM t),
s AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(node, other) AS (SELECT a, a FROM s UNION SELECT reach.node, s.b FROM reach JOIN s ON reach.other = s.a),
ruled AS (SELECT node, other, {_op7_rule("regexp_extract(other, '^[^/?#]*')", "regexp_extract(other, '^[^/?#]*([^?#]*)', 1)")} AS r FROM reach),
carried AS (SELECT node, bool_or(coalesce(r LIKE 'allow %', false)) AS cleared, bool_or(coalesce(r LIKE 'block %', false)) AS blocked
            FROM ruled GROUP BY node),
o AS (SELECT page_id, host, path, host || tail AS k, {_op7_rule('host', 'path')} AS r FROM q)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
       coalesce(split_part(r, ' ', 1), CASE WHEN blocked AND NOT cleared THEN 'block' ELSE 'allow' END) AS verdict
FROM o LEFT JOIN carried ON o.host <> '' AND o.k = carried.node"""

OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(
    t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          ELSE list_filter([array_to_string(w, ' ')], lambda x: x <> '') END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
k AS (SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.a, k.b FROM reach JOIN k ON reach.b = k.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.doc_id"""

OP13_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_dot_product(a.x, b.x) >= 0.93 * sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))),
n AS (SELECT a, count(*) AS n_links FROM k GROUP BY a),
reach(a, b) AS (SELECT a, a FROM n UNION SELECT reach.a, k.b FROM reach JOIN k ON reach.b = k.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a"""

ORACLES = {"op2_exact_dedup": OP2_SQL, "op3_line_dedup": OP3_SQL, "op4_warc": OP4_SQL, "op5_mixing": OP5_SQL, "op7_url_filter": OP7_SQL,
           "op9_jaccard_join": OP9_SQL, "op13_embedding_dedup": OP13_SQL}
