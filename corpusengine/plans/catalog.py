"""Registered queries: every relational operator of the engine on the shared test tables, with the SQL that answers the same.

Queries apply the engine's own operators (corpusengine.operators, corpusengine.functions) to stand-in tables: orders and
line items for trials, parts for proteins, documents for documents. Every ORDER BY ... LIMIT has a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.functions import scores as S
from corpusengine.functions import text as T
from corpusengine.operators import chunking, events, merge, quality, relational, retrieval, vectors
from corpusengine.operators import matching as M
from corpusengine.plans import catalog_kb  # noqa: F401  registers its queries
from corpusengine.plans.registry import QUERIES, SQL, query, table  # noqa: F401

#: Search terms for the link queries: words that the test texts use and one that they don't.
TERMS = ["the", "und", "que", "with", "der", "pour", "nowhere"]


def _terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in TERMS], "term string")


_VALUES = ", ".join(f"('{t}')" for t in TERMS)


# ---- events


@query("""
SELECT event_id, user_id, lower(event_type) AS event_type, CAST(value AS DOUBLE) AS value, ts, CAST(ts AS DATE) AS event_date FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts, user_id, event_type, value) AS rn FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL
) WHERE rn = 1
""")
def events_silver_dedup(spark, d):
    return events.clean(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT user_id, event_type, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events
) WHERE rn = 1
""")
def earliest_per_user_type(spark, d):
    return events.earliest(table(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


def _silver(spark, d):
    return table(spark, d, "events").withColumn("event_date", F.to_date("ts"))


_DAILY = "SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events, count(DISTINCT user_id) AS unique_users, round(sum(value), 2) AS revenue FROM events GROUP BY ALL"


@query(_DAILY)
def daily_metrics(spark, d):
    return events.daily(_silver(spark, d))


@query(f"SELECT event_date, round(sum(revenue), 2) AS revenue, CAST(sum(events) AS BIGINT) AS events FROM ({_DAILY}) GROUP BY event_date")
def daily_rollup(spark, d):
    return events.daily_revenue(events.daily(_silver(spark, d)))


@query("SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users, round(sum(value), 2) AS total_revenue FROM events")
def events_totals(spark, d):
    return events.totals(table(spark, d, "events"))


@query("SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def events_by_type(spark, d):
    return events.by_type(table(spark, d, "events"))


@query("SELECT event_type, round(sum(value), 2) AS revenue, count(*) AS events FROM events GROUP BY event_type ORDER BY revenue DESC, event_type LIMIT 5")
def top5_revenue(spark, d):
    return events.top_revenue(table(spark, d, "events"), "event_type", 5)


# ---- corpus reports, clusters, merges


@query("SELECT source, count(*) AS documents, count(*) FILTER (WHERE n_chars >= 1000) AS long_documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def corpus_report_sources(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("n_chars") >= 1000).alias("long_documents"), F.sum("n_chars").alias("chars"))


@query("SELECT lang, count(*) AS documents, count(DISTINCT source) FILTER (WHERE n_chars >= 1000) AS sources FROM documents GROUP BY lang ORDER BY documents DESC, lang LIMIT 3")
def corpus_report_langs(spark, d):
    out = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("documents"), F.countDistinct(F.when(F.col("n_chars") >= 1000, F.col("source"))).alias("sources"))
    return out.orderBy(F.desc("documents"), "lang").limit(3)


_CLUSTERS = """
SELECT doc_id, cluster_id, rn = 1 AS is_primary FROM (
  SELECT doc_id, md5(lower(trim(text))) AS cluster_id,
         row_number() OVER (PARTITION BY md5(lower(trim(text))) ORDER BY CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 9 END, doc_id) AS rn
  FROM documents)
"""


def _clustered(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.md5(F.lower(F.trim("text"))).alias("digest"))
    return merge.clusters(docs, "doc_id", F.col("digest"), merge.rank_of(F.col("lang"), ["en", "de", "fr"]))


@query(_CLUSTERS)
def cluster_primary(spark, d):
    return _clustered(spark, d).select("doc_id", "cluster_id", "is_primary")


@query(f'SELECT count(*) AS "rows", count(DISTINCT cluster_id) AS clusters, count(*) - count(DISTINCT cluster_id) AS duplicates FROM ({_CLUSTERS})')
def cluster_stats(spark, d):
    return merge.cluster_stats(_clustered(spark, d))


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'document' ELSE 'label' END AS origin, coalesce(l.quality, -1) AS quality
FROM documents d FULL JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)
""")
def keyed_merge(spark, d):
    old = table(spark, d, "documents").select("doc_id", F.lit("document").alias("origin"), F.lit(-1).alias("quality"), F.lit(0).alias("pos"))
    batch = table(spark, d, "labels").select("doc_id", F.lit("label").alias("origin"), F.col("quality").cast("int").alias("quality"), F.col("quality").cast("int").alias("pos"))
    return merge.keyed_merge(old, batch, ["doc_id"], "pos").drop("pos")


# ---- quality, text


def _records(spark, d):
    """Documents as candidate records: the first line for a title, the rest for an abstract."""
    t = F.col("text")
    return table(spark, d, "documents").select(F.concat(F.lit("PMC"), "doc_id").alias("pmcid"), F.split(t, "\n")[0].alias("title"), t.alias("abstract"), F.lit(False).alias("has_body"), (F.col("n_chars") + 1000).cast("string").alias("pub_year"), F.lit(None).cast("long").alias("body_words"), "source")


_REASONS = r"""
SELECT pmcid, array_to_string(list_filter([
  CASE WHEN title = '' THEN 'missing_title' WHEN length(title) < 8 THEN 'title_too_short' END,
  CASE WHEN year < 1500 OR year > 2100 THEN 'year_out_of_range' END,
  CASE WHEN regexp_matches(title, '(?i)^\s*(retracted|retraction|withdrawn|withdrawal|(editorial )?expression of concern)\b[:\s.-]') OR regexp_matches(substr(abstract, 1, 300), '(?i)this article has been (withdrawn|retracted|removed)') THEN 'withdrawn_or_retracted' END,
  CASE WHEN len(w) < 10 THEN 'no_indexable_content' END,
  CASE WHEN letters < 0.5 OR repeats > 0.6 THEN 'garbage_text' END
], lambda x: x IS NOT NULL), ';') AS reasons FROM (
  SELECT *, length(regexp_replace(sample, '[^\p{L}]', '', 'g')) / greatest(1, length(regexp_replace(sample, '\s', '', 'g'))) AS letters,
    CASE WHEN len(sw) < 20 THEN 0 ELSE list_max(list_transform(map_values(list_histogram(sw)), lambda v: CAST(v AS BIGINT))) / len(sw) END AS repeats
  FROM (SELECT *, title || ' ' || abstract AS sample, list_filter(regexp_split_to_array(abstract, '\s+'), lambda x: x <> '') AS w, list_filter(regexp_split_to_array(title || ' ' || abstract, '\s+'), lambda x: x <> '') AS sw
    FROM (SELECT 'PMC' || doc_id AS pmcid, trim(string_split(text, chr(10))[1]) AS title, trim(text) AS abstract, n_chars + 1000 AS year FROM documents)))
"""


@query(_REASONS)
def quality_reasons(spark, d):
    return quality.gate(_records(spark, d)).select("pmcid", "reasons")


@query(f"SELECT reason, count(*) AS documents FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM ({_REASONS})) WHERE reason <> '' GROUP BY reason")
def quarantine_rollup(spark, d):
    return quality.rollup(quality.gate(_records(spark, d)))


@query(r"SELECT doc_id, round(length(regexp_replace(text, '[^\p{L}]', '', 'g')) / length(regexp_replace(text, '\s', '', 'g')), 6) AS letter_ratio FROM documents")
def letter_ratio(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(T.letter_ratio(F.col("text")), 6).alias("letter_ratio"))


@query(r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS INTEGER) AS n_words FROM documents")
def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[.!?]\s+[A-Z0-9("'']')) + 1 AS INTEGER) AS n_sentences FROM documents""")
def sentence_count(spark, d):
    return table(spark, d, "documents").select("doc_id", T.sentence_count(F.col("text")).alias("n_sentences"))


@query(r"""
SELECT doc_id, CAST(i AS INTEGER) AS chunk_id, CAST(least(220, n - i * 180) AS INTEGER) AS n_words FROM (
  SELECT doc_id, n, unnest(generate_series(0, greatest(CAST(ceil((n - 220) / 180.0) AS BIGINT), 0))) AS i FROM (
    SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n FROM documents) WHERE n > 0)
""")
def fixed_chunks(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(T.fixed_chunks(T.words(F.col("text")), 220, 40)).alias("chunk_id", "chunk"))
    return docs.select("doc_id", "chunk_id", F.size("chunk").alias("n_words"))


#: The fold of sentences into chunks, a sentence a step: held, the words of the chunk that is open; tail, the sentences that the next one opens with.
_FOLD = r"""
WITH RECURSIVE s AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+([A-Z0-9("''])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')), lambda x: len(x) > 0) AS sentences FROM documents
), f AS (
  SELECT doc_id, 0 AS i, []::VARCHAR[] AS held, []::VARCHAR[][] AS tail, []::VARCHAR[][] AS made FROM s
  UNION ALL
  SELECT doc_id, i, CASE WHEN big THEN [] WHEN over THEN list_concat(flatten(tail), x) ELSE list_concat(held, x) END,
    CASE WHEN big THEN [] WHEN over THEN [x] ELSE long[list_min(list_filter(generate_series(1, len(long)), lambda p: p = len(long) OR len(flatten(long[p:])) <= 40)):] END,
    CASE WHEN big THEN list_concat(CASE WHEN len(held) > 0 THEN [held] ELSE [] END, list_transform(generate_series(0, CAST(greatest(ceil((len(x) - 220) / 180.0), 0) AS BIGINT)), lambda k: x[k * 180 + 1 : k * 180 + 220])) WHEN over THEN [held] ELSE [] END
  FROM (SELECT *, len(x) > 220 AS big, len(held) > 0 AND len(held) + len(x) > 220 AS over, list_append(tail, x) AS long FROM (
    SELECT f.doc_id, f.i + 1 AS i, held, tail, sentences[f.i + 1] AS x FROM f JOIN s ON s.doc_id = f.doc_id WHERE f.i < len(sentences)))
), c AS (
  SELECT doc_id, i, generate_subscripts(made, 1) AS j, unnest(made) AS words FROM f
  UNION ALL SELECT f.doc_id, i + 1, 1, held FROM f JOIN s ON s.doc_id = f.doc_id WHERE i = len(sentences) AND len(held) > 0
)
SELECT CAST(doc_id AS VARCHAR) AS pmcid, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1 AS INTEGER) AS chunk_id, 'abstract' AS sec_type, 'abstract' AS sec_kind, NULL::VARCHAR AS sec_title,
  array_to_string(words, ' ') AS text, CAST(len(words) AS INTEGER) AS n_words, FALSE AS is_methods, FALSE AS is_results, 0::INTEGER AS n_figures, 0::INTEGER AS n_tables FROM c
"""


@query(_FOLD)
def sentence_chunks(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("pmcid"), F.lit(0).alias("ordinal"), F.lit("abstract").alias("sec_type"), F.lit("abstract").alias("sec_kind"), F.lit(None).cast("string").alias("sec_title"), "text", F.lit(0).alias("n_figures"), F.lit(0).alias("n_tables"))
    return chunking.chunks(docs, 220, 40, True)


_KINDS = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(h), {chr(39)}{k}{chr(39)})' for k in keys)} THEN '{kind}'" for kind, keys in T.SECTION_KINDS) + " ELSE 'body' END"


@query(f"SELECT page_id, {_KINDS} AS sec_kind FROM (SELECT page_id, coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '') || ' ' || url || ' summary of methods'[1:CAST(page_id % 20 AS INTEGER)] AS h FROM pages)")
def section_kind(spark, d):
    h = F.concat(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(" "), F.col("url"), F.substring(F.lit(" summary of methods"), F.lit(1), (F.col("page_id") % 20).cast("int")))
    return table(spark, d, "pages").select("page_id", T.section_kind(F.lit("body"), h).alias("sec_kind"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<p[ >]')) AS INTEGER) AS n_paragraphs FROM pages")
def page_title(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p[ >]")).alias("n_paragraphs"))


@query("SELECT doc_id, substr(text, CAST(greatest(strpos(lower(text), 'ing ') - 1 - 60, 0) + 1 AS BIGINT), CAST(strpos(lower(text), 'ing ') - 1 + 120 - greatest(strpos(lower(text), 'ing ') - 1 - 60, 0) AS BIGINT)) AS snippet FROM (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents) WHERE text ILIKE '%ing %'")
def ilike_search(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    return retrieval.search(docs, "ing ", ["doc_id"])


# ---- links

_LINK = f"SELECT t.term, d.doc_id, CAST(len(regexp_extract_all(lower(d.text), '(^|[^a-z])' || t.term || '([^a-z]|$)')) AS BIGINT) AS n FROM (VALUES {_VALUES}) t(term) JOIN documents d ON regexp_matches(lower(d.text), '(^|[^a-z])' || t.term || '([^a-z]|$)')"


@query(_LINK)
def regex_theta_link(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return M.counted(M.mentions(_terms(spark), docs, ["doc_id"], "text"), docs, ["doc_id"], "text").select("term", "doc_id", "n")


@query(f"""
WITH body AS ({_LINK}), meta AS (SELECT DISTINCT t.term, d.doc_id FROM (VALUES {_VALUES}) t(term) JOIN documents d ON regexp_matches(lower(string_split(d.text, '.')[1]), '(^|[^a-z])' || t.term || '([^a-z]|$)'))
SELECT coalesce(m.term, b.term) AS term, coalesce(m.doc_id, b.doc_id) AS doc_id, m.doc_id IS NOT NULL AS in_metadata, coalesce(b.n, 0) AS n_body,
  CASE WHEN m.doc_id IS NOT NULL OR coalesce(b.n, 0) >= 2 THEN 'strong' ELSE 'weak' END AS confidence,
  round(least(1.0, (CASE WHEN m.doc_id IS NOT NULL THEN 0.6 ELSE 0 END) + (1 - exp(-coalesce(b.n, 0) / 1.5)) * 0.7), 3) AS score
FROM meta m FULL OUTER JOIN body b ON m.term = b.term AND m.doc_id = b.doc_id
""")
def link_score(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.split("text", r"\.")[0].alias("first"))
    body = M.counted(M.mentions(_terms(spark), docs, ["doc_id"], "text"), docs, ["doc_id"], "text")
    return relational.graded(M.mentions(_terms(spark), docs, ["doc_id"], "first"), body, ["term", "doc_id"])


@query("""
SELECT DISTINCT l.l_orderkey AS trial, p.ps AS document, l.l_partkey AS drug FROM lineitem l
JOIN (SELECT l_partkey, l_suppkey AS ps FROM lineitem WHERE l_quantity >= 49) p USING (l_partkey) WHERE l.l_discount = 0.1
""")
def trial_doc_bridge(spark, d):
    li = table(spark, d, "lineitem")
    trials = li.filter("l_discount = 0.1").select(F.col("l_partkey").alias("drug"), F.col("l_orderkey").alias("trial"))
    papers = li.filter("l_quantity >= 49").select(F.col("l_partkey").alias("drug"), F.col("l_suppkey").alias("document"))
    return relational.bridge(trials, papers, "drug").select("trial", "document", "drug")


# ---- stars, anti- and semi-joins

_STAR = "FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name"


@query(f"""SELECT n.n_name, count(DISTINCT c.c_custkey) FILTER (WHERE c.c_acctbal > 0) AS customers, count(DISTINCT s.s_suppkey) AS suppliers
{_STAR} ORDER BY customers + suppliers DESC, n_name LIMIT 12""")
def star_distinct_filter(spark, d):
    customers = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    suppliers = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    out = relational.star(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", [("customers", customers, "c_custkey"), ("suppliers", suppliers, "s_suppkey")])
    return out.select("n_name", "customers", "suppliers").orderBy(F.desc(F.col("customers") + F.col("suppliers")), "n_name").limit(12)


@query(f"""SELECT n.n_name, count(DISTINCT CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_custkey END) AS building, count(DISTINCT CASE WHEN s.s_acctbal > 5000 THEN s.s_suppkey END) AS rich
{_STAR} HAVING building > 0 OR rich > 0""")
def star_conditional_distinct(spark, d):
    customers = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    suppliers = table(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    out = relational.star(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", [("building", customers, "c_custkey"), ("rich", suppliers, "s_suppkey")])
    return out.filter("building > 0 or rich > 0").select("n_name", "building", "rich")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_not_in(spark, d):
    return relational.without(table(spark, d, "customer").select("c_custkey", "c_name"), table(spark, d, "orders").filter("o_orderstatus = 'F'"), "c_custkey", "o_custkey")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_not_exists(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""
SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey IN (
  SELECT l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size >= 40)) ORDER BY s_acctbal DESC NULLS LAST, s_suppkey LIMIT 25
""")
def semi_in_chain(spark, d):
    parts = table(spark, d, "part").filter("p_size >= 40").select(F.col("p_partkey").alias("l_partkey"))
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").join(parts, "l_partkey", "left_semi")
    out = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").join(lines.select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey", "left_semi")
    return out.orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey").limit(25)


@query("SELECT DISTINCT n.n_name, s.s_suppkey, l.l_partkey FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey JOIN lineitem l ON l.l_suppkey = s.s_suppkey")
def equi3(spark, d):
    n, s, li = table(spark, d, "nation"), table(spark, d, "supplier"), table(spark, d, "lineitem")
    return li.select("l_suppkey", "l_partkey").distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey", "l_partkey")


@query("SELECT o.o_orderkey, c.c_name FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 5000 WHERE c.c_name IS NOT NULL")
def left_is_not_null(spark, d):
    rich = table(spark, d, "customer").filter("c_acctbal > 5000")
    return table(spark, d, "orders").join(rich, F.col("c_custkey") == F.col("o_custkey"), "left").filter("c_name is not null").select("o_orderkey", "c_name")


@query("SELECT term, count(*) AS n FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS term FROM part) WHERE term <> '' GROUP BY term ORDER BY n DESC, term LIMIT 12")
def unnest_topk(spark, d):
    return relational.top_values(table(spark, d, "part"), "p_name", " ", 12)


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS blob FROM conversations GROUP BY conv_id")
def string_agg_ordered(spark, d):
    return relational.joined_text(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("SELECT l_partkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_discount > 0.09) AS discounted FROM lineitem GROUP BY l_partkey")
def bool_or_flags(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_or(F.col("l_discount") > 0.09).alias("discounted"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(min(l_extendedprice), 2) AS best FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag, l_linestatus")
def min_per_group(spark, d):
    return table(spark, d, "lineitem").filter("l_extendedprice is not null").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.min("l_extendedprice"), 2).alias("best"))


@query("SELECT p_partkey, p_size FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT 8")
def gaps(spark, d):
    out = relational.without(table(spark, d, "part").select("p_partkey", "p_size"), table(spark, d, "lineitem").filter("l_quantity = 50"), "p_partkey", "l_partkey")
    return out.orderBy(F.desc_nulls_last("p_size"), "p_partkey").limit(8)


@query("""
SELECT c.c_custkey, count(DISTINCT o.o_orderkey) AS orders, c.c_acctbal FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '1-URGENT' AND c.c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
GROUP BY c.c_custkey, c.c_acctbal HAVING count(DISTINCT o.o_orderkey) >= 3 ORDER BY orders DESC, c_custkey LIMIT 8
""")
def asymmetries(spark, d):
    orders = table(spark, d, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.countDistinct("o_orderkey").alias("orders")).filter("orders >= 3")
    poor = relational.without(table(spark, d, "customer").select("c_custkey", "c_acctbal"), orders.filter("o_totalprice > 450000"), "c_custkey", "o_custkey")
    return poor.join(urgent, "c_custkey").select("c_custkey", "orders", "c_acctbal").orderBy(F.desc("orders"), "c_custkey").limit(8)


@query("SELECT n.n_name, count(DISTINCT c.c_mktsegment) AS segments FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name HAVING count(DISTINCT c.c_mktsegment) >= 2")
def spanning(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.groupBy("c_nationkey").agg(F.countDistinct("c_mktsegment").alias("segments")).filter("segments >= 2").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "segments")


@query("""
SELECT (SELECT count(*) FROM documents WHERE text IS NULL OR trim(text) = '') AS missing_text, (SELECT count(*) FROM documents WHERE n_chars < 100 OR n_chars > 10000) AS size_out_of_range,
 (SELECT count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)) AS orphan_labels, (SELECT count(*) FROM documents WHERE NOT regexp_matches(source, '^src\\d+$')) AS bad_source
""")
def validate_counts(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    one = docs.agg(F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("missing_text"), F.count_if(~F.col("n_chars").between(100, 10000)).alias("size_out_of_range"), F.count_if(~F.col("source").rlike(r"^src\d+$")).alias("bad_source"))
    orphans = labels.join(docs.select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("orphan_labels"))
    return one.join(F.broadcast(orphans))  # one row each


# ---- index terms, vectors, retrieval

_STOP_SQL = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
_DF = f"SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{T.TOKEN}'))) AS term FROM documents) WHERE term NOT IN ({_STOP_SQL}) GROUP BY term HAVING count(*) >= 2"
_VOCABULARY = f"SELECT term, df FROM ({_DF}) ORDER BY df DESC, term LIMIT {vectors.MAX_VOCABULARY}"  # the size is the operator's own


@query(f"SELECT term, df FROM ({_DF}) ORDER BY df DESC, term LIMIT 100")
def doc_freq(spark, d):
    return vectors.vocabulary(table(spark, d, "documents"), "text", min_df=2, size=100)


@query(f"SELECT term, round(ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1, 6) AS idf FROM ({_VOCABULARY})")
def idf_table(spark, d):
    docs = table(spark, d, "documents")
    return vectors.idf(vectors.vocabulary(docs, "text"), docs.count()).select("term", F.round("idf", 6).alias("idf"))


_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"
_COS = f"{_DOT.format(a='e.embedding', b='q.embedding')} / (sqrt({_DOT.format(a='e.embedding', b='e.embedding')}) * sqrt({_DOT.format(a='q.embedding', b='q.embedding')}))"


@query(f"SELECT e.vec_id, round({_COS}, 4) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY {_COS} DESC, e.vec_id LIMIT 10")
def topk_cosine(spark, d):
    e = table(spark, d, "embeddings")
    return retrieval.top_k(e, "embedding", e.filter("vec_id = 0").select("embedding").first()[0], 10, ["vec_id"]).select("vec_id", F.round("score", 4).alias("score"))


@query(f"SELECT e.label, round(max({_COS}), 4) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q GROUP BY e.label")
def best_per_group(spark, d):
    e = table(spark, d, "embeddings")
    scored = retrieval.scored(e, "embedding", e.filter("vec_id = 0").select("embedding").first()[0])
    return scored.groupBy("label").agg(F.round(F.max("score"), 4).alias("score"))


@query(f"""
SELECT vec_id, lang, score FROM (SELECT e.vec_id, round({_COS}, 4) AS score, {_COS} AS s FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY s DESC, e.vec_id LIMIT 32) h
JOIN documents d ON d.doc_id = h.vec_id WHERE s >= 0.05 AND lang IN ('en', 'de') ORDER BY s DESC, vec_id LIMIT 8
""")
def retrieve_filtered(spark, d):
    e = table(spark, d, "embeddings")
    hits = retrieval.top_k(e, "embedding", e.filter("vec_id = 0").select("embedding").first()[0], 32, ["vec_id"])
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "lang")
    return retrieval.filtered(hits, docs, ["vec_id"], 8, min_score=0.05, lang=["en", "de"]).select("vec_id", "lang", F.round("score", 4).alias("score"))


@query()
def lsa_rank(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("pmcid"), F.lit(0).alias("chunk_id"), "text")
    model = vectors.fit(docs, "text")
    index = vectors.embed(docs, "text", model)
    return retrieval.top_k(index, "vector", model.embed_query("the of and that with heat thing"), 10, ["pmcid", "chunk_id"]).select("pmcid", "chunk_id", F.round("score", 4).alias("score"))


# ---- names, weights, payloads

_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
_NORM = f"""coalesce(list_filter(parts, lambda x: NOT list_contains({_LIST(T.SALTS + T.STEREO)}, x))[1], parts[1])"""
_ALLOWED = f"length({{x}}) >= 5 AND NOT list_contains({_LIST(T.COMMON_SUBSTANCES)}, {{x}})"


@query(f"""
SELECT doc_id, CASE WHEN {_ALLOWED.format(x="head")} THEN head END AS drug_norm FROM (
  SELECT doc_id, {_NORM} AS head FROM (SELECT doc_id, regexp_extract_all(lower(split_part(text, ' ', 2) || '-' || split_part(text, ' ', 3) || ' Sodium (R)'), '[a-z]+') AS parts FROM documents))
""")
def drug_names(spark, d):
    name = F.concat(F.split_part("text", F.lit(" "), F.lit(2)), F.lit("-"), F.split_part("text", F.lit(" "), F.lit(3)), F.lit(" Sodium (R)"))
    return table(spark, d, "documents").select("doc_id", T.drug_norm(name).alias("drug_norm"))


@query(f"""
SELECT doc_id, CASE WHEN len(parts) = 1 AND {_ALLOWED.format(x="parts[1]")} THEN parts[1] END AS term FROM (
  SELECT doc_id, regexp_extract_all(lower(split_part(text, ' ', 2)), '[a-z]+') AS parts FROM documents)
""")
def drug_terms(spark, d):
    return table(spark, d, "documents").select("doc_id", T.drug_term(F.split_part("text", F.lit(" "), F.lit(2))).alias("term"))


@query(f"""
SELECT p_partkey, term FROM (
  SELECT p_partkey, unnest(list_distinct(list_transform(list_filter([regexp_extract_all(lower(p_brand), '[a-z0-9]+'), regexp_extract_all(lower(p_name), '[a-z0-9]+'), regexp_extract_all(lower(p_type), '[a-z0-9]+')],
    lambda p: CASE WHEN len(p) = 1 THEN (length(p[1]) >= 4 AND NOT list_contains({_LIST(T.GENERIC_PROTEIN_WORDS)}, p[1])) OR (p[1] = lower(p_brand) AND length(p[1]) >= 3)
      ELSE len(list_filter(p, lambda t: length(t) >= 4 AND NOT list_contains({_LIST(T.GENERIC_PROTEIN_WORDS)}, t))) > 0 END), lambda p: array_to_string(p, ' ')))) AS term FROM part)
""")
def protein_terms(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(T.protein_terms(F.col("p_brand"), F.concat_ws(";", "p_name", "p_type"))).alias("term"))


@query(r"""
SELECT doc_id, CASE WHEN len(w) < 20 THEN 0.0 ELSE round(list_max(list_transform(map_values(list_histogram(w)), lambda v: CAST(v AS BIGINT))) / len(w), 6) END AS repeat_ratio
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents)
""")
def repeat_ratio(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(T.repeat_ratio(F.col("text")), 6).alias("repeat_ratio"))


@query(f"SELECT doc_id, CAST(len(list_filter(regexp_extract_all(lower(text), '{T.TOKEN}'), lambda t: NOT list_contains({_LIST(T.STOP_WORDS)}, t))) AS INTEGER) AS n_tokens FROM documents")
def token_count(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).alias("n_tokens"))


@query(f"""
WITH v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM ({_VOCABULARY})),
t AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{T.TOKEN}')) AS term FROM documents) GROUP BY doc_id, term)
SELECT doc_id, term, round(ln(1 + n) * idf, 6) AS weight FROM t JOIN v USING (term)
""")
def term_weights(spark, d):
    docs = table(spark, d, "documents")
    return vectors.weighted(docs, ["doc_id"], "text", vectors.idf(vectors.vocabulary(docs, "text"), docs.count())).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("SELECT doc_id, text FROM (SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda x: x <> ''), ' ') AS text FROM documents) WHERE text <> ''")
def inverted_index(spark, d):
    words = F.filter(F.split("text", " "), lambda w: w != "")
    index = table(spark, d, "documents").select("doc_id", F.posexplode(words).alias("at", "word")).groupBy("doc_id", "word").agg(F.sort_array(F.collect_list("at")).alias("at"))
    maps = index.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "at"))).alias("index"))
    return maps.select("doc_id", T.inverted_to_text(F.col("index")).alias("text"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_flatten(spark, d):
    return table(spark, d, "events").withColumn("j", F.from_json("props", "k bigint, absent string")).select("event_id", F.col("j.k").alias("k"), F.col("j.absent").alias("absent"))


@query("""
SELECT year(o_orderdate) AS pub_year, count(DISTINCT o_custkey) AS papers FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE c.c_acctbal > 0 AND o_orderdate IS NOT NULL GROUP BY year(o_orderdate)
""")
def trends(spark, d):
    primary = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, d, "orders").filter("o_orderdate is not null").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("pub_year"))
    return orders.join(primary, "o_custkey", "left_semi").groupBy("pub_year").agg(F.countDistinct("o_custkey").alias("papers"))


@query(f"SELECT term FROM (VALUES {_VALUES}) t(term) WHERE length(term) >= 3 AND contains('what is the answer, und warum, or that with which one works', term) ORDER BY length(term) DESC, term LIMIT 1")
def first_named_term(spark, d):
    return _terms(spark).filter((F.length("term") >= 3) & F.lit("what is the answer, und warum, or that with which one works").contains(F.col("term"))).orderBy(F.desc(F.length("term")), "term").limit(1)


@query("SELECT d.lang, count(*) AS chunks, count(*) FILTER (WHERE l.doc_id IS NULL) AS embedded FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY d.lang")
def index_refresh(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("pmcid"), F.lit(0).alias("chunk_id"), "text", "lang")
    prior = docs.join(table(spark, d, "labels").select(F.col("doc_id").alias("pmcid")), "pmcid", "left_semi").select("pmcid", "chunk_id", F.md5("text").alias("text_hash"), F.array(F.lit(0.0)).alias("vector"))
    fresh = lambda rows: rows.select("pmcid", "chunk_id", F.md5("text").alias("text_hash"), F.array(F.lit(1.0)).alias("vector"))
    index = vectors.refreshed(docs.drop("lang"), "text", prior, fresh)
    return index.join(docs.select("pmcid", "lang"), "pmcid").groupBy("lang").agg(F.count("*").alias("chunks"), F.count_if(F.col("vector")[0] == 1.0).alias("embedded"))


@query(f"""
WITH h AS (SELECT q.vec_id AS query, e.label = q.label AS hit, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, e.vec_id) AS r
  FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q WHERE e.vec_id <> q.vec_id)
SELECT round(avg(CASE WHEN r <= 5 THEN 1.0 ELSE 0.0 END), 6) AS recall, round(avg(1.0 / r), 6) AS mrr FROM (SELECT query, min(r) AS r FROM h WHERE hit GROUP BY query)
""")
def retrieval_metrics(spark, d):
    """Every vector whose id is divisible by 50 is a query against every vector; an answer of the same label counts."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    asked = e.filter("id % 50 = 0").select(F.col("id").alias("query"), F.col("label").alias("want"), F.col("vector").alias("asked"))
    ranks = retrieval.first_ranks(e, asked)
    return ranks.agg(F.round(F.avg((F.col("rank") <= 5).cast("double")), 6).alias("recall"), F.round(F.avg(1 / F.col("rank")), 6).alias("mrr"))
