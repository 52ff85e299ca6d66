"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm import bpe, fingerprints, jaccard_join, language, line_dedup, mixing, pii, quality, ranked_search, secrets, spelling, topk_search, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


RULES = [
    url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow"),
]
SPAM_HOSTS = r"(^|[.])(cheap-pills|casino-win|free-bets|ads-track|spam-farm|adult-[a-z]+)[.]"
"""Hosts whose pages make up the list of blocked urls."""


@query
def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(SPAM_HOSTS)).select(url_filter.canonical(F.col("url")))
    return url_filter.judge(pages, listed, RULES).drop("url")


PARTS_SQL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
ORACLES["op2_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '{PARTS_SQL}', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    coalesce(regexp_extract(url, '{PARTS_SQL}', 2), '') AS path,
    coalesce(regexp_extract(url, '{PARTS_SQL}', 3), '') AS query
  FROM pages),
cleaned AS (
  SELECT page_id, host, path,
    regexp_replace(regexp_replace(regexp_replace(query, '([?&])(?:utm_[^=&]*|ref|gclid|fbclid)=[^&]*', '\1', 'g'),
      '&{{2,}}', '&', 'g'), '\?&', '?', 'g') AS query
  FROM parts),
named AS (
  SELECT page_id, host, path,
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || regexp_replace(query, '[?&]+$', '') AS canonical
  FROM cleaned),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM named),
listed AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '{SPAM_HOSTS}'))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op3_topk_search(spark, sf_dir):
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op3_topk_search"] = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.row <> c.row AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op4_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


@query
def op5_jaccard_join(spark, sf_dir):
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


@query
def op6_language(spark, sf_dir):
    langs, model = language.fit(table(spark, sf_dir, "documents"))
    return language.identify(table(spark, sf_dir, "pages"), langs, model)


@query
def op7_secret_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return secrets.scan(documents, secrets.fit(documents))


@query
def op8_quality_classifier(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.scored(documents, labels).select("doc_id", "held_out", "score", "predicted")


def tokenizer_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op9_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_pattern())


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


CRC_SQL = "CASE WHEN {x} % 2 = 1 THEN xor({x} >> 1, 3988292384) ELSE {x} >> 1 END"
ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE
bytes AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda x, step: {CRC_SQL.format(x='x')}) ORDER BY i) AS crc
  FROM range(256) t(i)),
runs AS (
  SELECT row, doc_id, run, count(*) AS n FROM (
    SELECT row_number() OVER () AS row, doc_id,
      unnest(regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
spelled AS (
  SELECT run, n, doc_id || ':' || run AS name, list_transform(string_split(doc_id || ':' || run, ''), lambda c: ord(c)) AS points FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [195, p - 64] END))),
    lambda h, b: xor(h >> 8, bytes.crc[xor(h & 255, b) + 1]))) AS h
  FROM spelled, bytes),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
counted AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
    CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN counted USING (word)),
chain AS (
  SELECT word, coalesce(form, word) AS top, form IS NULL AS done FROM formed
  UNION ALL
  SELECT c.word, coalesce(f.form, c.top), f.form IS NULL FROM chain c JOIN formed f ON f.word = c.top WHERE NOT c.done)
SELECT f.word, form, top AS root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.done
"""


@query
def op12_ranked_search(spark, sf_dir):
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERM_SQL = ranked_search.TERM.pattern
ORACLES["op12_ranked_search"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '{TERM_SQL}') AS terms FROM documents),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
items AS (
  SELECT row_number() OVER () AS item, item_id,
    regexp_extract_all(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '{TERM_SQL}') AS terms FROM benchmark),
asked AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term),
impacts AS (
  SELECT h.row, s.doc_id, h.term, w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * s.n * t.n_docs) // t.n_terms))) AS impact
  FROM held h JOIN sizes s USING (row) JOIN weights w USING (term), totals t),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id, CAST(sum(times * impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item, row),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranked_search.K}
"""


@query
def op13_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


ORACLES["op13_line_dedup"] = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
cut AS (
  SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{url_filter.UPPER}', '{url_filter.LOWER}') AS key
  FROM cut),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= {line_dedup.LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT row) >= {line_dedup.LEAST_DOCS}),
marked AS (
  SELECT k.row, k.doc_id, k.line, k.i, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.holder AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row
"""
