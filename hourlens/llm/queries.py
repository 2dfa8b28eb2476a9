"""One query per operator over its whole table, with the check SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.llm import (
    decontaminate,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    periodic_runs,
    quality_rules,
    sharding,
    source_audit,
    suffix_dedup,
    token_store,
    url_filters,
    vector_search,
)
from hourlens.llm.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# ---- 1 url filters

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query("op1_url_filters", """
WITH p AS (SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r(rhost, rpath, v) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + """),
m AS (SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(v, length(rhost || rpath)) AS v
      FROM (SELECT DISTINCT host, path, page_id FROM p) p JOIN r
        ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY ALL)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND p.host = m.host AND p.path = m.path
""")
def op1_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


# ---- 2 n-gram Jaccard join

@query("op2_ngram_jaccard", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
        THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1),
        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
-- a pair of the ratio shares at least 90 % of the smaller set
r AS (SELECT doc_id, n, g, count(*) OVER (PARTITION BY g) AS df FROM e),
o AS (SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS i FROM r),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM o a JOIN o b
      ON a.g = b.g AND a.doc_id < b.doc_id WHERE a.i <= a.n - ceil(0.9 * a.n) + 1
      AND b.i <= b.n - ceil(0.9 * b.n) + 1 AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
k AS (SELECT c.a, c.b FROM c JOIN s x ON c.a = x.doc_id JOIN s y ON c.b = y.doc_id
      WHERE 190 * len(list_intersect(x.g, y.g)) >= 90 * (na + nb)),
l AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
t AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(t.b) AS component_id
FROM s JOIN t ON s.doc_id = t.a GROUP BY s.doc_id, g
""")
def op2_ngram_jaccard(spark, sf_dir):
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


# ---- 3 sharding

SHARD_BYTES = 1 << 20


@query("op3_sharding", f"""
WITH d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
        format('{{:064b}}', CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 16) AS UBIGINT)) AS bits
      FROM documents),
p AS (SELECT *, unnest(range(0, 65)) AS depth FROM d),
b AS (SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, substr(bits, 1, depth) AS shard,
        CAST(sum(n_bytes) OVER (PARTITION BY depth, substr(bits, 1, depth)) AS BIGINT) AS shard_bytes
      FROM p)
SELECT * FROM b WHERE shard_bytes <= {SHARD_BYTES}
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
""")
def op3_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES)


# ---- 4 token ids

def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query("op4_token_ids")
def op4_token_ids(spark, sf_dir):
    return token_store.token_report(table(spark, sf_dir, "documents"), tokenizer_json())


# ---- 5 quality rules

@query("op5_quality_rules", r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS th,
        row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS w FROM d),
g AS (SELECT r, len(w) AS n, unnest(list_transform(range(1, len(w) - 1),
        lambda i: {'i': i, 'v': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]})) AS x FROM w),
h AS (SELECT r, x.i AS i FROM g QUALIFY count(*) OVER (PARTITION BY r, x.v) > 1),
rep AS (SELECT r, count(DISTINCT k) AS n_repeat_words
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM h) z GROUP BY r),
l AS (SELECT r, source, th, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT r, source, th, line, len(regexp_extract_all(line, '[^ 	-
]+')) AS words,
        translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
q AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM k WHERE words > 0 GROUP BY r),
f AS (SELECT source, key FROM k WHERE words > 0 GROUP BY source, key
      HAVING count(DISTINCT th) > 20 AND count(DISTINCT th) > least(1000::DOUBLE, 0.05::DOUBLE * (
        SELECT count(DISTINCT d.th) FROM d WHERE d.source IS NOT DISTINCT FROM k.source))),
x AS (SELECT r, sum(words) AS lost FROM k JOIN f ON k.key = f.key
      AND k.source IS NOT DISTINCT FROM f.source GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda v: length(v))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(lost, 0) AS BIGINT) AS lost_words,
    len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
    NOT (len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w))
      AND NOT 100 * coalesce(lost, 0) > 50 * len(w) AS kept
FROM w LEFT JOIN rep USING (r) LEFT JOIN q USING (r) LEFT JOIN x USING (r)
""")
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "host")
    return quality_rules.judge(docs)[0].select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("lost_words").cast("long").alias("lost_words"), "base_failed", "kept")


# ---- 6 line dedup

@query("op6_line_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
l AS (SELECT doc_id, r, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, """ + _LOWER.format("trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))")
       + """ AS key FROM l),
s AS (SELECT key, min(doc_id) AS lo FROM k WHERE length(key) >= 10 GROUP BY key
      HAVING count(DISTINCT doc_id) >= 2)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE s.key IS NOT NULL AND k.doc_id <> lo) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
        FILTER (WHERE s.key IS NULL OR k.doc_id = lo), '')) AS kept_sha256
FROM k LEFT JOIN s ON k.key = s.key GROUP BY k.r
""")
def op6_line_dedup(spark, sf_dir):
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


# ---- 7 benchmark decontamination

@query("op7_decontaminate", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(list_transform(
        range(1, len(w) - least(10, len(w)) + 2),
        lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS g FROM b WHERE len(w) > 0),
dw AS (SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2),
        lambda i: {'i': i, 'g': array_to_string(w[i:i + n - 1], ' ')})) AS x
      FROM d, (SELECT DISTINCT n FROM bw) m WHERE len(w) >= n),
hit AS (SELECT r, x.i AS i, dw.n AS n, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = x.g),
hw AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) z
       GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS s
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS v FROM hit) z GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN it USING (r)
""")
def op7_decontaminate(spark, sf_dir):
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_sort(F.transform("items", lambda v: v.cast("string")))
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


# ---- 8 mixing sources

@query("op8_mixing", """
WITH RECURSIVE d AS (SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
      FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
        AS HUGEINT) AS w, CAST(sum(source_size) OVER () AS HUGEINT) AS total FROM g),
-- fill the fullest source first, one after the other
o AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i,
        CAST(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS left_w FROM p),
f AS (SELECT 1 AS i, CAST(0 AS HUGEINT) AS used, 1 AS go
      UNION ALL SELECT f.i + 1, CAST(f.used + 2 * o.source_size AS HUGEINT), 1 FROM f JOIN o USING (i)
      WHERE 4 * o.source_size * o.left_w <= (3 * o.total - 2 * f.used) * o.w),
z AS (SELECT max(i) AS i, max(used) AS used FROM f),
t AS (SELECT source, source_size, CASE WHEN o.i < z.i THEN CAST(2 * source_size AS DOUBLE)
        ELSE CAST(w * (3 * total - 2 * used) AS DOUBLE) / CAST(
          (sum(w) FILTER (WHERE o.i >= z.i) OVER ()) * 2 AS DOUBLE) END AS target FROM o, z),
x AS (SELECT d.*, source_size, target,
        CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE target / CAST(source_size AS DOUBLE) END AS rate,
        row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1 AS place,
        CAST(CAST('0x' || substr(md5('mix:' || coalesce('s' || d.source, 'n')), 1, 8) AS BIGINT)
          AS DOUBLE) / 4294967296.0::DOUBLE AS shift
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    CAST(floor(rate * (place + 1) + shift) - floor(rate * place + shift) AS BIGINT) AS copies,
    CAST(floor(rate * (place + 1) + shift) - floor(rate * place + shift) AS BIGINT) * size AS taken
FROM x
""")
def op8_mixing(spark, sf_dir):
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


# ---- 9 suffix-array dedup

@query("op9_suffix_dedup", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS k FROM d),
s AS (SELECT doc_id, k, md5(substr(h, 2 * k + 1, 200)) AS h FROM p),
r AS (SELECT doc_id, k FROM s QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, k) > 1),
g AS (SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 100 THEN 0 ELSE 1 END
        AS head FROM r),
n AS (SELECT doc_id, k, sum(head) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM g),
c AS (SELECT doc_id, run, min(k) AS lo, max(k) + 100 AS hi FROM n GROUP BY 1, 2),
e AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed,
        list(lo ORDER BY lo) AS lo, list(hi ORDER BY lo) AS hi FROM c GROUP BY 1)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(CASE WHEN n_spans IS NULL THEN encode(text) ELSE unhex(array_to_string(list_transform(
        range(0, n_spans + 1), lambda i: substr(h, CASE WHEN i = 0 THEN 1 ELSE 2 * hi[i] + 1 END,
          2 * (CASE WHEN i = n_spans THEN length(h) // 2 ELSE lo[i + 1] END
               - CASE WHEN i = 0 THEN 0 ELSE hi[i] END))), '')) END) AS kept_sha256
FROM d LEFT JOIN e ON d.doc_id = e.doc_id
""")
def op9_suffix_dedup(spark, sf_dir):
    left = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return left.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


# ---- 10 license scans

@query("op10_license_scan")
def op10_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


# ---- 11 periodic runs

def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which one text in ten repeats its own words from some place on, by its doc_id's checksum."""
    place, period = "({g} % size(w))", "(1 + (size(w) - {g} % size(w)) div (3 + {g} % 8))"
    g = "(crc32(cast(doc_id as string)) div 10)"
    place, period = place.format(g=g), period.format(g=g)
    words = r"filter(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]++', 0)), w -> size(w) > 0)"
    text = (f"get(transform({words}, w -> array_join(transform(sequence(0, size(w) - 1), i -> w[cast("
            f"if(i < {place}, i, {place} + (i - {place}) % {period}) as int)]), ' ')), 0)")
    return docs.withColumn("text", F.when(
        F.expr("crc32(cast(doc_id as string)) % 10 = 0"), F.coalesce(F.expr(text), "text")).otherwise(
        F.col("text")))


@query("op11_periodic_runs", r"""
WITH b AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM documents),
h AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(list_reduce(steps, lambda c, x:
          CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END,
          CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM b),
a AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM h),
d AS (SELECT r, doc_id, n, CASE WHEN n > 0 AND h % 10 = 0 THEN list_transform(range(n),
        lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM a),
g AS (SELECT r, n, unnest(range(1, n - 3)) AS i, unnest(list_transform(range(1, n - 3),
        lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE n > 5),
-- equal stretches of five words; places that follow each other at one distance make one stretch
e AS (SELECT x.r, x.i, y.i - x.i AS p FROM g x JOIN g y
      ON x.r = y.r AND x.g = y.g AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
f AS (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS k FROM e),
m AS (SELECT r, min(i) - 1 AS s, count(*) + 4 + p AS l, p FROM f GROUP BY r, p, k
      HAVING count(*) + 4 + p >= greatest(6, 4 * p)),
u AS (SELECT r, s, l, min(p) AS p FROM m GROUP BY r, s, l),
c AS (SELECT r, count(*) AS n_runs, arg_max({'s': s, 'l': l, 'p': p}, (l, -s, -p)) AS top,
        string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS runs FROM u GROUP BY r),
x AS (SELECT DISTINCT r, unnest(range(s + p, s + l)) AS i FROM u),
o AS (SELECT d.r, list(i) AS gone FROM x JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length,
    CAST(top.p AS BIGINT) AS period, CAST(1000 * top.l // top.p AS BIGINT) AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256,
    sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
        list_transform(list_filter(list_zip(w, range(n)), lambda z: NOT list_contains(gone, z[2])),
          lambda z: z[1]), ' ') END) AS collapsed_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN o USING (r)
""")
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("p"))))
    top = found.withColumn("_top", longest)
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_top.a")).alias("start"),
        F.col("_top.length").alias("length"), (-F.col("_top.p")).alias("period"),
        F.expr("1000 * _top.length div -_top.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


# ---- 12 nearest neighbours

@query("op12_nearest_vectors")
def op12_nearest_vectors(spark, sf_dir):
    found = vector_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


# ---- 13 source divergence audit

@query("op13_source_audit", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
w AS (SELECT r, lang, source, unnest(w) AS t FROM d),
k AS (SELECT lang, t FROM w GROUP BY lang, t HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
n AS (SELECT lang, source, t, count(*) AS c FROM w JOIN k USING (lang, t) GROUP BY ALL),
g AS (SELECT s.lang, s.source, coalesce(v, 0) AS v, coalesce(sum(c), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN v ON v.lang = s.lang
      LEFT JOIN n ON n.lang = s.lang AND n.source = s.source GROUP BY ALL),
l AS (SELECT lang, t, CAST(1 + (1000000000 * (sum(c) + 1)) // (
        (SELECT sum(n) FROM g WHERE g.lang = n.lang) + (SELECT v FROM v WHERE v.lang = n.lang)) AS BIGINT) AS q
      FROM n GROUP BY lang, t),
f AS (SELECT g.lang, g.source, k.t, coalesce(c, 0) AS c,
        CAST(1 + (1000000000 * (coalesce(c, 0) + 1)) // (g.n + v) AS BIGINT) AS p
      FROM g JOIN k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.t = k.t),
x AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS s
      FROM f a JOIN f b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
p AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
t AS (SELECT f.lang, f.source, 'term' AS part, f.t AS item, ((p - q) * (p - q)) // q AS value
      FROM f JOIN l ON l.lang = f.lang AND l.t = f.t WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM p UNION ALL FROM t) QUALIFY part = 'pair' OR rank <= 200
""")
def op13_source_audit(spark, sf_dir):
    return source_audit.audit(table(spark, sf_dir, "documents"))
