"""More queries: the operators that the first catalogue reaches only through others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text as T
from ..operators import classify as C
from ..operators import describe as D
from ..operators import extract as X
from ..operators import joins as J
from ..operators import retrieve as R
from ..operators import validate as V
from ..operators import windows as W
from ..sources import filings as S
from ..streaming import arrivals
from . import models
from .queries import CAPTIONS, LABELS, NOTES, SEGMENTS, TICKERS, dealt, grids, lit, query, read, sql_contains, sql_dealt, sql_found, sql_hits, sql_tokens

STATEMENT_LABELS = (
    "Revenue Cost of revenue Net income", "Total revenue Advertising Other", "Net sales Products Services", "Revenues Operating expenses Net earnings Earnings per share", "Members Stores", "Total net sales United States China", "Operating income Net income Cost of sales Revenue",
)
DOCUMENTS = (
    "ITEM 1. BUSINESS We sell. ITEM 7. MANAGEMENT talks.", "Notes to the consolidated financial statements. Note 2 - Revenue.", "Management discussion and analysis (MD&A). Reportable segments.", "Contracts with customers. Note 18: Segment information.", "Nothing of note.",
)


@query(
    "q60_scout",
    f"""WITH t AS (SELECT doc_id, lower({sql_dealt(CAPTIONS, 'doc_id')}) AS c, lower({sql_dealt(STATEMENT_LABELS, 'doc_id // 5')}) AS n FROM documents), g AS (SELECT *, {sql_found("c || ' ' || n", fixed.SCOUT_GEOGRAPHY)} AS geo FROM t),
p AS (SELECT *, CASE WHEN {sql_found('c', fixed.SCOUT_REJECT)} OR {sql_contains('n', fixed.PL_MARKERS)} >= 2 THEN '' WHEN {sql_found('c', fixed.SCOUT_A)} THEN 'A' WHEN {sql_found('c', fixed.SCOUT_B)} THEN 'B' WHEN {sql_found('c', fixed.SCOUT_C)} THEN 'C' WHEN contains(c || ' ' || n, 'revenue') OR contains(c || ' ' || n, 'net sales') THEN 'X' ELSE '' END AS p FROM g)
SELECT doc_id, CASE WHEN p = 'X' THEN 'C' ELSE p END AS priority, CASE WHEN p = '' THEN '' WHEN geo THEN 'geography' WHEN p = 'A' THEN 'disaggregation' WHEN p = 'B' THEN 'segment' WHEN p = 'C' THEN 'product_service' ELSE 'unknown' END AS table_type,
  CAST(CASE p WHEN '' THEN 0 WHEN 'A' THEN CASE WHEN geo THEN 0.7 ELSE 0.95 END WHEN 'B' THEN CASE WHEN geo THEN 0.6 ELSE 0.85 END WHEN 'C' THEN CASE WHEN geo THEN 0.5 ELSE 0.75 END ELSE 0.5 END AS DOUBLE) AS confidence FROM p""",
)
def q60(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("_k", F.floor(F.col("doc_id") / 5).cast("bigint"))
    return docs.select("doc_id", C.scout(dealt(CAPTIONS, "doc_id"), dealt(STATEMENT_LABELS, "_k")).alias("s")).select("doc_id", "s.*")


@query(
    "q61_income_statement",
    f"""WITH t AS (SELECT doc_id, lower({sql_dealt(CAPTIONS, 'doc_id')}) AS c, lower({sql_dealt(STATEMENT_LABELS, 'doc_id // 5')}) AS n FROM documents), h AS (SELECT *, {sql_found('c', fixed.STATEMENT_CAPTION)} AS cap, {sql_hits('n', fixed.STATEMENT_MARKERS)} AS m FROM t)
SELECT doc_id, CAST(CASE WHEN cap AND m >= 2 THEN least(0.5 + m * 0.15, 0.95) WHEN regexp_matches(n, '\\b(net\\s+)?revenue[s]?\\b|\\bnet\\s+sales\\b') AND regexp_matches(n, '\\bnet\\s+income\\b|\\bnet\\s+earnings\\b') AND regexp_matches(n, '\\boperating\\s+expenses?\\b|\\bcost\\s+of\\b') THEN 0.85 WHEN cap THEN 0.6 ELSE 0 END AS DOUBLE) AS confidence,
  CASE WHEN contains(n, 'revenue') OR contains(n, 'net sales') THEN CAST(CASE WHEN contains(n, 'net income') THEN 3 ELSE 0 END + CASE WHEN contains(n, 'operating income') THEN 2 ELSE 0 END + CASE WHEN contains(n, 'cost of') THEN 1.5 ELSE 0 END + 1.5 + 0.25 + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) END AS score,
  {sql_contains('n', fixed.BREAKDOWN_POSITIVE)} > 0 AND {sql_contains('n', fixed.BREAKDOWN_NEGATIVE)} = 0 AS is_match, {sql_contains('n', fixed.BREAKDOWN_GEOGRAPHY)} > 0 AS is_geography FROM h""",
)
def q61(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("_k", F.floor(F.col("doc_id") / 5).cast("bigint"))
    labels = dealt(STATEMENT_LABELS, "_k")
    out = docs.select("doc_id", F.round(C.income_statement(dealt(CAPTIONS, "doc_id"), labels), 9).alias("confidence"), C.statement_score(labels, F.lit(0.5), F.lit(0.25), F.col("doc_id") % 2 == 0).alias("score"), C.is_breakdown(labels).alias("b"))
    return out.select("doc_id", "confidence", "score", "b.is_match", "b.is_geography")


@query(
    "q62_document_sections",
    f"""WITH t AS (SELECT doc_id, lower({sql_dealt(DOCUMENTS, 'doc_id')} || ' ' || text) AS x FROM documents) SELECT doc_id, """
    + ", ".join(f"{sql_found('x', ps if name != 'has_item1_business' else (ps[0], 'item' + chr(92) + 's*1' + chr(92) + 'b[^0-9A]', 'item' + chr(92) + 's*1$'))} AS {name}" for name, ps in fixed.SECTIONS.items())
    + " FROM t",
)
def q62(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", C.document_sections(F.concat_ws(" ", dealt(DOCUMENTS, "doc_id"), "text")).alias("s")).select("doc_id", "s.*")


@query(
    "q63_sane_tables",
    f"""WITH t AS (SELECT p_size AS grp, {sql_dealt(LABELS, 'p_partkey // 4')} AS item, CASE WHEN p_size % 10 = 0 THEN 0 WHEN p_size % 7 = 0 THEN 3 ELSE CAST(p_partkey AS BIGINT) END AS value, CASE WHEN p_size % 2 = 0 THEN 'in percent' ELSE '' END AS hint FROM part)
SELECT grp, avg(CAST(regexp_matches(trim(item), '^[\\s$€£¥(),.0-9\\-]+$') AS INTEGER)) <= 0.5 AND avg(CAST({sql_found('item', fixed.DATE_LABEL)} AS INTEGER)) <= 0.3 AND NOT (sum(CAST({sql_found('item', fixed.STAFF_LABEL)} AS INTEGER)) > 0 AND sum(CAST({sql_found('item', fixed.STAFF_LABEL)} AS INTEGER)) >= count(*) * 0.2)
  AND max(abs(value)) > 0 AND NOT (max(hint) <> '' AND max(abs(value)) <= 5) AS sane FROM t GROUP BY grp""",
)
def q63(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").withColumn("_k", F.floor(F.col("p_partkey") / 4).cast("bigint"))
    size = F.col("p_size")
    rows = part.select(size.alias("grp"), dealt(LABELS, "_k").alias("item"), F.when(size % 10 == 0, F.lit(0)).when(size % 7 == 0, F.lit(3)).otherwise(F.col("p_partkey")).cast("bigint").alias("value"), F.when(size % 2 == 0, "in percent").otherwise("").alias("hint"))
    return C.sane_tables(rows, "grp")


@query(
    "q64_without_totals",
    f"""WITH t AS (SELECT p_partkey, p_partkey % 500 AS grp, {sql_dealt(LABELS, 'p_partkey // 3')} AS item FROM part), c AS (SELECT * FROM t WHERE NOT {sql_found('item', fixed.COST_ROW)}),
o AS (SELECT *, {sql_found('trim(item)', fixed.TOTAL_ROW)} AS total, sum(CAST(NOT {sql_found('trim(item)', fixed.TOTAL_ROW)} AS INTEGER)) OVER (PARTITION BY grp) AS n FROM c) SELECT p_partkey, grp FROM o WHERE NOT (total AND n >= 3)""",
)
def q64(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").withColumn("_k", F.floor(F.col("p_partkey") / 3).cast("bigint"))
    rows = part.select("p_partkey", (F.col("p_partkey") % 500).alias("grp"), dealt(LABELS, "_k").alias("item"))
    return C.without_total_rows(C.without_cost_rows(rows), "grp").select("p_partkey", "grp")


@query(
    "q65_segment_sums",
    """WITH t AS (SELECT l_orderkey, l_returnflag AS segment, 'i' || l_linenumber AS item, CAST(round(l_extendedprice) AS BIGINT) AS value, CASE WHEN l_linenumber = 7 THEN 'adjustment' ELSE 'item' END AS row_type, CASE WHEN l_suppkey % 3 = 0 THEN 'segment' ELSE 'product_service' END AS dimension FROM lineitem),
d AS (SELECT DISTINCT l_orderkey, segment FROM t WHERE dimension = 'product_service')
SELECT l_orderkey, segment AS name, 'segment' AS kind, CAST(sum(value) AS BIGINT) AS value FROM t WHERE row_type = 'item' AND (dimension <> 'segment' OR NOT EXISTS (SELECT 1 FROM d WHERE d.l_orderkey = t.l_orderkey AND d.segment = t.segment)) GROUP BY l_orderkey, segment
UNION ALL SELECT l_orderkey, item, 'adjustment', CAST(sum(value) AS BIGINT) FROM t WHERE row_type = 'adjustment' GROUP BY l_orderkey, item""",
)
def q65(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("segment"), F.concat(F.lit("i"), k).alias("item"), F.round("l_extendedprice").cast("bigint").alias("value"), F.when(k == 7, "adjustment").otherwise("item").alias("row_type"), F.when(F.col("l_suppkey") % 3 == 0, "segment").otherwise("product_service").alias("dimension"))
    return X.segment_sums(rows, "l_orderkey").select("l_orderkey", "name", "kind", "value")


@query(
    "q66_segment_keys",
    f"""WITH s(segment, pos) AS (VALUES {', '.join(f"({lit(s)}, {k})" for k, s in enumerate((*SEGMENTS, 'Cloud (1)', 'cloud')))}), t AS (SELECT segment, pos, {sql_tokens('segment')} AS w FROM s),
k AS (SELECT lower(segment) AS key, segment, pos, 0 AS n FROM t UNION ALL SELECT lower(trim(regexp_replace(segment, '\\s*\\([^)]*\\)\\s*$', ''))), segment, pos, 1 FROM t UNION ALL SELECT array_to_string(list_sort(w), ' '), segment, pos, 2 FROM t WHERE len(w) > 0)
SELECT key, max_by(segment, (pos, n)) AS segment FROM k GROUP BY key""",
)
def q66(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.segment_keys(spark.createDataFrame([(s, k) for k, s in enumerate((*SEGMENTS, "Cloud (1)", "cloud"))], "segment string, pos int"))


@query(
    "q67_last_table_attributes",
    """WITH t AS (SELECT o_custkey, o_orderpriority AS item, o_orderdate AS d, o_orderkey, o_orderstatus FROM orders) SELECT lower(item) AS label, max_by(o_custkey || '', (d, -o_orderkey)) AS segment, max_by(o_orderstatus, (d, -o_orderkey)) AS dimension FROM t GROUP BY lower(item)""",
)
def q67(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(F.concat("o_orderpriority", F.lit(" (3)")).alias("item"), F.col("o_orderdate").alias("table_pos"), F.col("o_orderkey").alias("row_idx"), F.col("o_custkey").cast("string").alias("segment"), F.col("o_orderstatus").alias("dimension"))
    labels = rows.select(F.lower(T.clean_line(F.col("item"))).alias("label")).distinct()
    return J.last_table_attributes(labels, rows).select("label", "segment", "dimension")


@query(
    "q68_footnotes_of",
    """WITH t AS (SELECT p_partkey, unnest([p_size, p_size + 1, p_size % 7]) AS id, unnest([0, 1, 2]) AS k FROM part), n AS (SELECT DISTINCT p_size AS id FROM part WHERE p_size % 3 = 0) SELECT p_partkey AS label, 'note ' || min_by(t.id, k) AS footnote FROM t JOIN n USING (id) GROUP BY p_partkey""",
)
def q68(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    labels = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("label"), F.array(size, size + 1, size % 7).alias("ids"))
    notes = read(spark, sf_dir, "part").where("p_size % 3 = 0").select(size.alias("id"), F.concat(F.lit("note "), size).alias("definition")).distinct()
    return J.footnotes_of(labels, notes)


@query(
    "q69_containing",
    f"""WITH w(word) AS (VALUES {', '.join(f"({lit(k)})" for k in fixed.LABEL_EXPANSIONS)}), l AS (SELECT DISTINCT {sql_dealt(LABELS, 'p_partkey')} AS label FROM part) SELECT label, word FROM l, w WHERE contains(lower(label), lower(word)) OR contains(lower(word), lower(label))""",
)
def q69(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "part").select(dealt(LABELS, "p_partkey").alias("label")).distinct()
    return J.containing(labels, spark.createDataFrame([(k,) for k in fixed.LABEL_EXPANSIONS], "word string"))


@query(
    "q70_within_tolerance",
    """SELECT o.o_custkey, o.o_orderkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE abs(CAST(round(o_totalprice) AS BIGINT) - CAST(round(c_acctbal * 20) AS BIGINT)) < abs(CAST(round(c_acctbal * 20) AS BIGINT)) * 0.3""",
)
def q70(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").cast("bigint").alias("amount"))
    targets = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.round(F.col("c_acctbal") * 20).cast("bigint").alias("target"))
    return J.within_tolerance(amounts, targets, 0.3, "o_custkey").select("o_custkey", "o_orderkey")


@query(
    "q71_header_mode",
    """WITH t AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events QUALIFY i < 50), m AS (SELECT user_id, min(CASE WHEN event_type = 'view' THEN i END) AS h, max(CASE WHEN event_type = 'purchase' THEN i END) AS r FROM t GROUP BY user_id) SELECT user_id, coalesce(h < r, false) AS header_mode FROM m""",
)
def q71(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.ranked(read(spark, sf_dir, "events"), [F.col("ts"), F.col("event_id")], "user_id").select("user_id", (F.col("rank") - 1).alias("row_idx"), F.when(F.col("event_type") == "purchase", " Revenue ").otherwise(F.upper("event_type")).alias("first"))
    segments = rows.select("user_id", F.lit("View").alias("segment")).distinct()
    return C.header_mode(rows, segments, "user_id")


@query("q72_pass_rate", "SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS BIGINT) AS n_passed, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 9) AS pass_rate FROM orders GROUP BY o_custkey")
def q72(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pass_rate(read(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderstatus") == "F").alias("ok")), "o_custkey").withColumn("pass_rate", F.round("pass_rate", 9))


@query(
    "q73_snippets_and_chunks",
    r"""WITH t AS (SELECT doc_id, text || repeat(' .... 12' || chr(10), CAST(doc_id % 14 AS INTEGER)) AS x, 'Item ' || (7 + doc_id % 3) || ' of note ' || doc_id || ' on the segment' AS s FROM documents)
SELECT doc_id, len(regexp_extract_all(x, '\.{3,}')) > 5 OR len(regexp_extract_all(x, '(?m)\.\s*\d{1,3}\s*$')) > 8 OR doc_id % 10 < 3 AS is_toc, CAST(3 * CAST(doc_id % 3 = 1 AS INTEGER) + 1 - CAST(doc_id % 3 = 0 AS INTEGER) AS INTEGER) AS score FROM t""",
)
def q73(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    x = F.concat("text", F.repeat(F.lit(" .... 12\n"), (k % 14).cast("int")))
    snippet = F.concat(F.lit("Item "), 7 + k % 3, F.lit(" of note "), k, F.lit(" on the segment"))
    regions = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("end")))
    return read(spark, sf_dir, "documents").select("doc_id", C.is_contents_chunk(x, (k % 10).cast("int"), regions).alias("is_toc"), C.snippet_score(snippet).alias("score"))


@query(
    "q74_boosted",
    f"""WITH t AS (SELECT doc_id // 10 AS q, doc_id, {sql_dealt(NOTES, 'doc_id')} AS x, CAST(n_chars % 997 AS DOUBLE) AS s FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, doc_id) AS was FROM t),
b AS (SELECT *, CASE WHEN contains(lower(x), 'revenue') AND {sql_found('x', fixed.DEFINITION_BOOST)} THEN s * 1.25 ELSE s END AS b FROM r) SELECT q AS query_id, doc_id, row_number() OVER (PARTITION BY q ORDER BY b DESC, was) AS rank FROM b QUALIFY rank <= 5""",
)
def q74(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 10).cast("bigint").alias("query_id"), "doc_id", dealt(NOTES, "doc_id").alias("text"), (F.col("n_chars") % 997).cast("double").alias("score"))
    hits = W.ranked(docs, [F.col("score").desc(), F.col("doc_id")], "query_id")
    return R.boosted(hits, F.lit("Revenue")).select("query_id", "doc_id", "rank")


@query(
    "q75_verified",
    """SELECT doc_id, doc_id % 3 <> 1 AND doc_id % 4 <> 3 AS verified FROM documents""",
)
def q75(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    chunks = F.array(F.struct(F.lit("c1").alias("chunk_id"), F.concat(F.lit("Alpha beta gamma "), "text").alias("text")), F.struct(F.lit("c2").alias("chunk_id"), F.lit("Delta").alias("text")))
    ids = F.when(k % 3 == 1, F.array(F.lit("c1"), F.lit("c9"))).otherwise(F.array(F.lit("c2")))
    quotes = F.when(k % 4 == 3, F.array(F.lit("no such words anywhere"))).otherwise(F.array(F.lit(""), F.lit("ALPHA beta")))
    return read(spark, sf_dir, "documents").select("doc_id", R.verified(quotes, ids, chunks).alias("verified"))


@query(
    "q76_accepted_items",
    """WITH t AS (SELECT doc_id % 100 AS f, doc_id AS pos, CASE WHEN doc_id % 2 = 0 THEN 'Azure Cloud' ELSE 'azure-cloud' END AS item, doc_id % 5 <> 4 AS ok FROM documents) SELECT f AS filing, min_by(pos, pos) AS pos, min_by(item, pos) AS item FROM t WHERE ok GROUP BY f""",
)
def q76(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    item = F.when(k % 2 == 0, "Azure Cloud").otherwise("azure-cloud")
    rows = read(spark, sf_dir, "documents").select((k % 100).alias("filing"), F.lit("s").alias("segment"), k.alias("pos"), item.alias("item"), F.when(k % 5 == 4, "sentences that cannot be found").otherwise(F.concat(F.lit("we offer "), item)).alias("span"), F.concat(F.lit("Here We Offer "), item, F.lit(" and more")).alias("text"))
    return D.accepted_items(rows, "filing").select("filing", "pos", "item")


@query(
    "q77_enumeration",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'gaming platforms number ' || doc_id || ' for everyone at home' WHEN 1 THEN 'Our compute offerings include servers and accelerators for all number ' || doc_id || '.' END AS definition FROM documents""",
)
def q77(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    doc = F.concat(F.lit("The Compute &amp; Networking segment includes our accelerated platforms; gaming platforms number "), k, F.lit(" for everyone at home; more. Our compute offerings include servers and accelerators for all number "), k, F.lit(". "), "text")
    line = F.when(k % 3 == 0, "Gaming").when(k % 3 == 1, "Compute").otherwise("Unheard")
    return read(spark, sf_dir, "documents").select("doc_id", D.enumeration_definition(line, F.lit("Compute & Networking"), doc).alias("definition"))


@query(
    "q78_retrieval_query",
    """SELECT c_custkey, 'Customer (' || c_custkey || ') FY2024 revenue line ''' || c_mktsegment || '''' || CASE WHEN c_custkey % 2 = 0 THEN ' in segment ''' || c_nationkey || '''' ELSE '' END || ' "' || c_mktsegment || ' consists of" "' || c_mktsegment || ' includes" products and services offerings generated from' AS q FROM customer""",
)
def q78(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise("")
    return read(spark, sf_dir, "customer").select("c_custkey", T.retrieval_query(F.lit("Customer"), F.col("c_custkey").cast("string"), F.lit(2024), F.col("c_mktsegment"), group, F.lit(None).cast("string")).alias("q"))


@query("q79_primary_dimension", "SELECT p_brand, CASE WHEN bool_or(p_size = 1) THEN 'product_service' WHEN bool_or(p_size = 2) THEN 'end_market' ELSE 'segment' END AS dimension FROM part GROUP BY p_brand")
def q79(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_brand", F.when(F.col("p_size") == 1, "product_service").when(F.col("p_size") == 2, "end_market").otherwise("geography").alias("dimension"))
    return W.primary_dimension(rows, "p_brand")


@query(
    "q80_attempt_order",
    """WITH t AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders), a AS (SELECT o_custkey, o_orderkey, 0 AS s, 0 AS g, 0 AS p FROM t QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
UNION ALL SELECT o_custkey, o_orderkey, 1, CAST(o_orderkey % 2 = 0 AS INTEGER), CAST(o_orderkey AS INTEGER) FROM t WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, 2, 0, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM t QUALIFY r <= 15),
m AS (SELECT o_custkey, o_orderkey, min((s, g, p)) AS o FROM a GROUP BY ALL) SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o) AS attempt FROM m""",
)
def q80(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("table_idx"), "o_totalprice", "o_orderstatus")
    best = W.ranked(rows, [F.col("o_totalprice").desc(), F.col("table_idx")], "o_custkey", most=1)
    ways = rows.where("o_orderstatus = 'F'").withColumn("is_geography", F.col("table_idx") % 2 == 0)
    out = W.attempt_order(best, ways, W.ranked(rows, [F.col("table_idx").desc()], "o_custkey", most=15), "o_custkey")
    return out.select("o_custkey", F.col("table_idx").alias("o_orderkey"), "attempt")


@query(
    "q81_hint_rank",
    f"""WITH h(who, hint) AS (VALUES {', '.join(f"({lit(t)}, {lit(h)})" for t, h in fixed.KEYWORD_HINTS)}), t AS (SELECT source, doc_id, {sql_dealt(TICKERS, 'doc_id')} AS who, lower({sql_dealt(CAPTIONS, 'doc_id')} || ' total revenues') AS x FROM documents),
s AS (SELECT source, doc_id, coalesce((SELECT count(*) FROM h WHERE h.who = t.who AND contains(t.x, h.hint)), 0) AS n FROM t) SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n DESC, doc_id) AS rank FROM s QUALIFY rank <= 15""",
)
def q81(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("table_idx"), dealt(TICKERS, "doc_id").alias("ticker"), F.concat_ws(" ", dealt(CAPTIONS, "doc_id"), F.lit("total revenues")).alias("blob"))
    return W.hint_rank(docs, spark.createDataFrame(list(fixed.KEYWORD_HINTS), "ticker string, hint string"), "source").select("source", F.col("table_idx").alias("doc_id"), "rank")


@query("q82_still_wanted", "SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ORDER BY name")
def q82(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("ticker"))
    return S.still_wanted(wanted, read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("ticker")))


@query("q83_sliding_windows", """WITH w AS (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) SELECT s AS "start", s + INTERVAL 2 HOUR AS "end", event_type, count(*) AS n FROM w GROUP BY ALL""")
def q83(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals.counts(read(spark, sf_dir, "events"), "ts", "2 hours", "1 hour", "event_type")


@query(
    "q84_search_terms",
    f"""SELECT doc_id, contains(lower({sql_dealt(LABELS, 'doc_id')}), 'ad') AS has_ad, {sql_found(sql_dealt(NOTES, 'doc_id'), fixed.CONTRA_REVENUE)} AS contra, len({sql_tokens(sql_dealt(LABELS, 'doc_id'))}) AS n_tokens FROM documents""",
)
def q84(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = dealt(LABELS, "doc_id")
    terms = T.search_terms(label)
    return read(spark, sf_dir, "documents").select("doc_id", F.contains(F.get(terms, F.lit(0)), F.lit("ad")).alias("has_ad"), V.is_contra_revenue(dealt(NOTES, "doc_id")).alias("contra"), F.size(T.tokens(label)).cast("bigint").alias("n_tokens"))


@query("q85_with_description", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS item, coalesce(c_name, '') AS description FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 3) ON o_custkey = c_custkey")
def q85(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("item"))
    known = read(spark, sf_dir, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").cast("string").alias("item"), F.col("c_name").alias("description"))
    return J.with_description(rows, known).select("o_orderkey", "item", "description")


ORDERS_AS_TABLES = "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {}) AS place FROM orders"


def tables_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("table_idx"), F.col("o_orderkey").alias("table_id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("confidence"), F.col("o_orderstatus").alias("kind"))


@query("q86_by_priority", ORDERS_AS_TABLES.format("o_orderpriority, o_totalprice DESC, o_orderkey"))
def q86(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.by_priority(tables_of_customers(spark, sf_dir), "o_custkey").select("o_custkey", F.col("table_idx").alias("o_orderkey"), "place")


@query("q87_best_of_kind", "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1")
def q87(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.best_of_kind(tables_of_customers(spark, sf_dir), "F", "o_custkey").select("o_custkey", F.col("table_id").alias("o_orderkey"))


@query(
    "q88_segment_col_fits",
    """WITH v AS (SELECT DISTINCT user_id, trim(lower(event_type)) AS v FROM events WHERE length(trim(event_type)) > 1), e AS (SELECT DISTINCT user_id, lower(event_type) AS s FROM events WHERE user_id % 3 = 0 AND value > 50),
n AS (SELECT v.user_id, v.v, max(CAST(coalesce(contains(v.v, e.s) OR contains(e.s, v.v), false) AS INTEGER)) AS near FROM v LEFT JOIN e USING (user_id) GROUP BY v.user_id, v.v) SELECT user_id, NOT (avg(near) < 0.3 AND count(*) > 2) AS fits FROM n GROUP BY user_id""",
)
def q88(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    segments = events.where("user_id % 3 = 0 AND value > 50").select("user_id", F.upper("event_type").alias("segment"))
    return C.segment_col_fits(events.select("user_id", F.concat(F.lit(" "), F.initcap("event_type")).alias("value")), segments, "user_id")


@query(
    "q89_plain_check",
    """WITH s AS (SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * (1 - l_discount)) AS BIGINT)) AS BIGINT) AS s FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey, abs(CAST(round(o_totalprice) AS BIGINT) - s) / CAST(greatest(1, CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) <= 0.5 AS ok FROM orders JOIN s ON l_orderkey = o_orderkey""",
)
def q89(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")).alias("s"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.round("o_totalprice").cast("bigint").alias("t"))
    return orders.join(sums, "o_orderkey").select("o_orderkey", V.plain_check(F.col("t"), F.col("s"), 0.5).alias("ok"))


AMOUNT = r"(?i)\$?[\d,]+(?:\.\d+)?\s*(?:million|billion)"


@query(
    "q90_mentions_in_context",
    rf"""WITH t AS (SELECT doc_id, text || ' We sold $' || (doc_id % 97 + 1) || '.5 million of goods, and more of them later on, as the year went by.' AS x FROM documents WHERE text IS NOT NULL), m AS (SELECT doc_id, x, regexp_extract(x, '{AMOUNT}') AS m FROM t)
SELECT doc_id, substring(x, greatest(1, instr(x, m) - 100), length(m) + 200) AS context FROM m WHERE m <> ''""",
)
def q90(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat("text", F.lit(" We sold $"), F.col("doc_id") % 97 + 1, F.lit(".5 million of goods, and more of them later on, as the year went by."))
    return V.mentions_in_context(read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", said.alias("text")), 100, "doc_id")


@query(
    "q91_label_values",
    """WITH t AS (SELECT l_orderkey AS filing_id, 'Product ' || l_returnflag || l_linestatus AS label, CAST(round(l_extendedprice) AS BIGINT) AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem)
SELECT filing_id, label, min_by(v, k) AS value FROM t GROUP BY filing_id, label UNION ALL SELECT filing_id, 'Total revenue', CAST(sum(v) AS BIGINT) FROM t GROUP BY filing_id""",
)
def q91(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = grids(spark, sf_dir)
    years = C.year_cols(X.cells(grid, *X.KEYS), *X.KEYS)
    return X.label_values(grid, years, *X.KEYS).select("filing_id", F.explode("values").alias("label", "value")).select("filing_id", "label", F.col("value").cast("bigint").alias("value"))


@query(
    "q92_segment_summaries",
    """WITH c AS (SELECT doc_id % 20 AS filing_id, doc_id AS chunk_idx, text, CASE doc_id % 4 WHEN 0 THEN 'other' WHEN 1 THEN 'item1' WHEN 2 THEN 'note_revenue' ELSE 'note_segment' END AS section, CASE doc_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS r FROM documents WHERE doc_id % 11 <> 0),
s(segment) AS (VALUES ('The'), ('And')), f AS (SELECT filing_id, segment, text, row_number() OVER (PARTITION BY filing_id, segment ORDER BY r, chunk_idx) AS k FROM c, s WHERE contains(lower(text), lower(segment)) QUALIFY k <= 3)
SELECT filing_id, segment, md5(string_agg(text, ' ' ORDER BY k)) AS text_md5 FROM f GROUP BY filing_id, segment""",
)
def q92(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    section = F.when(k % 4 == 0, "other").when(k % 4 == 1, "item1").when(k % 4 == 2, "note_revenue").otherwise("note_segment")
    chunks = read(spark, sf_dir, "documents").select((k % 20).alias("filing_id"), k.alias("chunk_idx"), "text", section.alias("section"), (k % 11 == 0).alias("is_toc"))
    segments = chunks.select("filing_id").distinct().withColumn("segment", F.explode(F.array(F.lit("The"), F.lit("And"))))
    return models.segment_summaries(chunks, segments).select("filing_id", "segment", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("q93_ticker_ciks", "SELECT upper(trim(c_mktsegment)) || (c_nationkey % 5) AS ticker, max(c_custkey) AS cik FROM customer GROUP BY ALL")
def q93(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.ticker_ciks(read(spark, sf_dir, "customer").select(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.col("c_nationkey") % 5, F.lit(" ")).alias("ticker"), F.col("c_custkey").cast("string").alias("cik_str")))


@query(
    "q94_quantile",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_discount, 0.25), 6) AS p25 FROM lineitem GROUP BY l_returnflag""",
)
def q94(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of many values and of few that repeat."""
    lines = read(spark, sf_dir, "lineitem")
    of = lambda c, share, name: R.quantile(lines.select("l_returnflag", F.col(c).alias("score")), share, "l_returnflag").select("l_returnflag", F.round("quantile", 6).alias(name))
    return of("l_extendedprice", 0.9, "p90").join(of("l_discount", 0.25, "p25"), "l_returnflag")
