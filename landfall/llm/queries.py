"""One query per operator over its whole table, and the SQL that checks it where SQL can."""

from pyspark.sql import functions as F

from landfall.llm import (
    alignment, chat, decontam, divergence, html, langid, mixing, neardup, packing, pii, topk, toxicity, warc,
)

QUERIES = {}
CHECKS = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def load(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer(name):
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_topk_search(spark, sf_dir):
    return topk.top_k(spark, load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


CHECKS["op1_topk_search"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
  FROM v q JOIN v p ON len(q.v) = len(p.v) AND q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
WHERE rank <= 20
"""


@query
def op2_warc(spark, sf_dir):
    return warc.round_trip(spark, load(spark, sf_dir, "pages"))


CHECKS["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s,
             max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  translate(
    lpad(to_base(CAST('0x' || substr(s, 1, 10) AS BIGINT), 32), 8, '0')
    || lpad(to_base(CAST('0x' || substr(s, 11, 10) AS BIGINT), 32), 8, '0')
    || lpad(to_base(CAST('0x' || substr(s, 21, 10) AS BIGINT), 32), 8, '0')
    || lpad(to_base(CAST('0x' || substr(s, 31, 10) AS BIGINT), 32), 8, '0'),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM x
"""


@query
def op3_chat_format(spark, sf_dir):
    talk = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], talk.schema)
    return chat.read_back(chat.format_conversations(talk.union(extra)))


#: Written out, not taken from the operator.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped(text):
    sql = f"replace({text}, '\\', '\\\\')"
    for c in CONTROLS:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


CHECKS["op3_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS l,
    sum(24 + length({_escaped('role')}) + length({_escaped('text')})) AS f
  FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(t) AS turns_sha256,
       CAST(length(l) AS BIGINT) AS loss_chars, sha256(l) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars
FROM g
"""


@query
def op4_toxicity(spark, sf_dir):
    return toxicity.score(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op5_pii(spark, sf_dir):
    return pii.detect(spark, load(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark, sf_dir):
    return decontam.decontaminate(
        spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


CHECKS["op6_decontaminate"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
occ AS (
  SELECT DISTINCT t.doc_id, t.i, t.size, win.item_id
  FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
              FROM d, sizes WHERE len(w) >= size)) t
  JOIN win ON win.size = t.size AND win.k = t.k),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM occ))
  GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS t
  FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


@query
def decontaminate_proximity(spark, sf_dir):
    """Where documents nearly repeat a benchmark window: each word at most two places off."""
    return decontam.proximity_matches(
        spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 2)


CHECKS["decontaminate_proximity"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, w[i:i + 12] AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
tok AS (SELECT r, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM d),
freq AS (SELECT term, count(*) AS n FROM tok GROUP BY term),
rarest AS (
  SELECT words, arg_min(i, n) AS o, arg_min(term, n) AS term
  FROM (SELECT words, i, words[i + 1] AS term, coalesce(n, 0) AS n
        FROM (SELECT DISTINCT words, unnest(range(len(words))) AS i FROM win)
        LEFT JOIN freq ON freq.term = words[i + 1])
  GROUP BY words),
place AS (
  SELECT DISTINCT r, words, pos - o + unnest(range(-2, 3)) AS start
  FROM tok JOIN rarest USING (term))
SELECT d.doc_id, win.item_id, CAST(start AS INTEGER) AS start
FROM place JOIN d USING (r) JOIN win USING (words)
WHERE start >= 0 AND start + len(words) <= len(w)
  AND len(list_filter(range(len(words)), lambda i:
    list_contains(w[greatest(start + i - 2, 0) + 1:start + i + 3], words[i + 1]))) = len(words)
"""


@query
def op7_html_text(spark, sf_dir):
    return html.extract(spark, load(spark, sf_dir, "pages"))


@query
def op8_minhash_neardup(spark, sf_dir):
    return neardup.link_documents(spark, load(spark, sf_dir, "documents"))


CHECKS["op8_minhash_neardup"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM s
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.c AS component_id, m.c = s.doc_id AS kept
FROM s JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""


@query
def op9_language_id(spark, sf_dir):
    return langid.identify(spark, load(spark, sf_dir, "documents"))


@query
def op10_mix_sources(spark, sf_dir):
    mixed = mixing.mix(spark, load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


CHECKS["op10_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM s),
f AS (
  SELECT l.level FROM (
    SELECT a.cap / a.weight AS ratio,
      (1.5::DOUBLE * (SELECT sum(source_size) FROM w)
        - coalesce((SELECT sum(cap) FROM w b WHERE b.cap / b.weight < a.cap / a.weight), 0))
      / (SELECT sum(weight) FROM w b WHERE b.cap / b.weight >= a.cap / a.weight) AS level
    FROM w a) l WHERE l.level <= l.ratio ORDER BY l.ratio LIMIT 1),
t AS (
  SELECT source, source_size, least(cap, weight * coalesce((SELECT level FROM f), 1e300)) AS target FROM w)
SELECT d.doc_id, d.size, t.source_size, t.target,
  CAST(d.size * (floor(r) + CASE WHEN u < r - floor(r) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (SELECT *, CAST('0x' || substr(md5(k || ':' || (row_number() OVER (PARTITION BY k) - 1) || ':17'), 1, 13) AS BIGINT)
        / 4503599627370496.0::DOUBLE AS u FROM d) d
JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r FROM t) t
  ON t.source IS NOT DISTINCT FROM d.source
"""


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(spark, load(spark, sf_dir, "documents"))


CHECKS["op11_source_divergence"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT r, lang, source, unnest(w) AS term FROM d),
g AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM e GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (
  SELECT g.lang, g.source, k.term, coalesce(x.n, 0) AS n, k.n AS lang_n
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM e GROUP BY lang, source, term) x
    ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (
  SELECT lang, source, term, n,
    1 + (1000000000 * CAST(n + 2 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
    1 + (1000000000 * CAST(lang_n + 2 AS HUGEINT)) // (total + 2 * v) AS q
  FROM c JOIN l USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM s a JOIN s b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
    GROUP BY ALL) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM s WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM ranked)
WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_best_fit_packing(spark, sf_dir):
    return packing.pack(spark, load(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), checksums=True)


@query
def op13_cross_tokenizer(spark, sf_dir):
    return alignment.agreement(
        spark, load(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
