"""Registered retrieval queries (F3) with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from storelens.functions.text import DECLINE_TEXT, DIAGNOSTIC_KEYWORDS, FALLBACK_METHOD, VECTOR_METHOD, search_terms
from storelens.functions.vectors import embed, md5_embed
from storelens.operators import chunking as ch
from storelens.operators import retrieval as rt
from storelens.operators.vector_index import VectorIndex
from storelens.plans import fixtures as fx
from storelens.plans.oracle import r4, with_views
from storelens.plans.registry import query
from storelens.session import scratch_path

CHUNKS_SQL = """
SELECT concat('doc_', CAST(doc_id AS VARCHAR), '.pdf') AS document_filename, source AS document_title,
  lang AS equipment_covered, concat('gs://manuals/doc_', CAST(doc_id AS VARCHAR), '.pdf') AS source_pdf_uri,
  CAST(u.i - 1 AS BIGINT) AS chunk_index, substr(text, CAST(u.s AS BIGINT), 500) AS chunk_content
FROM documents, unnest(generate_series(1, greatest(length(text), 1), 400)) WITH ORDINALITY AS u(s, i)
WHERE length(trim(substr(text, CAST(u.s AS BIGINT), 500))) > 30"""

COS = "list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
TOPK_SQL = f"""
SELECT query_id, match_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, match_id) AS rank FROM (
    SELECT q.vec_id AS query_id, b.vec_id AS match_id, {r4(f'1 - (1 - {COS})')} AS score
    FROM vchunks q JOIN vchunks b ON q.vec_id <> b.vec_id)) WHERE rank <= 5"""

KW_LIST = "[" + ", ".join(f"'{k}'" for k in DIAGNOSTIC_KEYWORDS) + "]"
TERMS_SQL = f"""
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pos) - 1 AS INTEGER) AS term_pos, term FROM (
  SELECT query_id, term, pos, row_number() OVER (PARTITION BY query_id, term ORDER BY pos) AS dup FROM (
    SELECT query_id, u.term, u.pos FROM questions,
      unnest(regexp_extract_all(text, '[A-Z0-9]+-[A-Z0-9-]+')) WITH ORDINALITY AS u(term, pos)
    UNION ALL
    SELECT query_id, k.term, 1000000 + k.pos FROM questions,
      unnest({KW_LIST}) WITH ORDINALITY AS k(term, pos)
    WHERE contains(lower(text), lower(k.term))))
WHERE dup = 1"""

FALLBACK_SQL = f"""
SELECT query_id, matched_term, document_filename, chunk_index FROM (
  SELECT t.query_id, t.term AS matched_term, c.document_filename, c.chunk_index,
    row_number() OVER (PARTITION BY t.query_id ORDER BY t.term_pos, c.document_filename, c.chunk_index) AS rn
  FROM terms t JOIN chunks c ON regexp_matches(lower(c.chunk_content),
    '(^|[^a-z0-9])' || replace(trim(regexp_replace(lower(t.term), '[^a-z0-9]+', '-', 'g'), '-'), '-', '-+') || '($|[^a-z0-9])'))
WHERE rn = 1"""


@query("manual_chunks", "R-01", CHUNKS_SQL)
def manual_chunks(t):
    """Sliding 500/400 character windows over every document."""
    return ch.manual_chunks(t.documents)


@query("vector_topk", "R-03 W-03 L-04", with_views(TOPK_SQL, "vchunks"))
def vector_topk(t):
    """Exact cosine top-5 neighbours of every manual chunk (self excluded)."""
    v = fx.vchunks(t).select(F.col("vec_id").alias("query_id"), "embedding")
    return rt.vector_search(v, fx.vchunks(t), 5, exclude_self=True, same_rows=True)


@query("vector_topk_blocked", "R-03", with_views(TOPK_SQL, "vchunks"))
def vector_topk_blocked(t):
    """The same top-5 through the block-replicated path used when neither
    side can be broadcast (small blocks force several groups)."""
    v = fx.vchunks(t).select(F.col("vec_id").alias("query_id"), "embedding")
    return rt.vector_search(v, fx.vchunks(t), 5, exclude_self=True, strategy="blocked", block_rows=128, same_rows=True)


STITCH_SQL = """
SELECT m.vec_id AS match_id, m.document_filename, m.chunk_index,
  string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content, count(*) AS neighbour_rows
FROM vchunks m JOIN vchunks c ON m.document_filename = c.document_filename
  AND c.chunk_index BETWEEN m.chunk_index - 1 AND m.chunk_index + 1
GROUP BY 1, 2, 3"""


@query("stitched_neighbours", "J-04 A-05", with_views(STITCH_SQL, "vchunks"))
def stitched_neighbours(t):
    """Every chunk stitched with its index neighbours (radius 1)."""
    m = fx.vchunks(t).select(F.col("vec_id").alias("match_id"), "document_filename", "chunk_index")
    return rt.stitch(m, fx.vchunks(t))


BEST_SQL = f"""
SELECT k.query_id, b.document_filename, b.document_title, b.equipment_covered, b.source_pdf_uri, b.chunk_index,
  k.score AS similarity_score
FROM ({TOPK_SQL}) k JOIN vchunks b ON b.vec_id = k.match_id WHERE k.rank = 1"""


@query("retrieval_gate", "R-05 R-03 J-04", with_views(f"""
SELECT m.*, string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content,
  count(*) AS neighbour_rows, m.similarity_score >= 0.70 AS accepted
FROM ({BEST_SQL}) m JOIN vchunks c ON m.document_filename = c.document_filename
  AND c.chunk_index BETWEEN m.chunk_index - 1 AND m.chunk_index + 1
GROUP BY ALL""", "vchunks"))
def retrieval_gate(t):
    """Best stitched match per chunk-as-question and the 0.70 gate."""
    return rt.retrieve(fx.vquestions(t), fx.vchunks(t), exclude_self=True, same_rows=True)


@query("search_terms", "R-06", with_views(TERMS_SQL, "questions"))
def search_terms_q(t):
    """Ordered, de-duplicated search terms of every document-as-question."""
    from storelens.operators.sizing import spread
    q = spread(fx.questions(t))
    return q.select("query_id", F.posexplode(search_terms("text")).alias("term_pos", "term"))


@query("keyword_fallback", "R-07 R-06 R-01", with_views(FALLBACK_SQL, "questions", "manuals", extra={
    "terms": TERMS_SQL, "chunks": CHUNKS_SQL.replace("FROM documents", "FROM manuals")}))
def keyword_fallback(t):
    """First matching term and first matching manual chunk per document-as-question."""
    return rt.fallback_search(fx.questions(t), ch.manual_chunks(fx.manuals(t)))


ANSWER_SQL = f"""
WITH best AS ({BEST_SQL}),
acc AS (SELECT query_id, document_filename, chunk_index, similarity_score, 'vector' AS route,
               CAST(NULL AS VARCHAR) AS matched_term FROM best WHERE similarity_score >= 0.70),
fb AS (SELECT f.query_id, f.document_filename, f.chunk_index, 0.85 AS similarity_score, 'fallback' AS route,
              f.matched_term
       FROM ({FALLBACK_SQL}) f WHERE f.query_id NOT IN (SELECT query_id FROM acc)),
chosen AS (SELECT * FROM acc UNION ALL SELECT * FROM fb),
st AS (
  SELECT m.query_id, m.route, m.document_filename, m.chunk_index, m.similarity_score, m.matched_term,
    any_value(meta.document_title) AS document_title, any_value(meta.equipment_covered) AS equipment_covered,
    any_value(meta.source_pdf_uri) AS source_pdf_uri,
    string_agg(c.chunk_content, chr(10) ORDER BY c.chunk_index) AS stitched_content
  FROM chosen m
  LEFT JOIN chunks meta ON meta.document_filename = m.document_filename AND meta.chunk_index = m.chunk_index
  JOIN chunks c ON m.document_filename = c.document_filename
    AND c.chunk_index BETWEEN m.chunk_index - 1 AND m.chunk_index + 1
  GROUP BY 1, 2, 3, 4, 5, 6)
SELECT query_id, route, document_filename, chunk_index, similarity_score, matched_term,
  '### Certified POS Troubleshooting Runbook' || chr(10) || '- **Document Title:** '
  || coalesce(nullif(document_title, ''), coalesce(nullif(document_filename, ''), 'POS Hardware Service Manual'))
  || chr(10) || '- **Equipment Covered:** ' || coalesce(nullif(equipment_covered, ''), 'All compatible POS terminals')
  || chr(10) || '- **Certified Source Manual:** [' || coalesce(nullif(document_filename, ''), 'POS Hardware Service Manual')
  || '](' || replace(coalesce(source_pdf_uri, ''), 'gs://', 'https://storage.cloud.google.com/') || ')'
  || chr(10) || '- **Retrieval Match:** '
  || CASE WHEN route = 'vector' THEN '{VECTOR_METHOD}' ELSE '{FALLBACK_METHOD[0].replace(chr(39), chr(39) * 2)}' || matched_term || '{FALLBACK_METHOD[1].replace(chr(39), chr(39) * 2)}' END
  || ' (Relevance Score: ' || CAST(similarity_score AS VARCHAR) || ', Matched Chunk #' || CAST(chunk_index AS VARCHAR)
  || ' with adjacent window stitching)' || chr(10) || chr(10) || '#### Runbook & Procedural Instructions:' || chr(10)
  || coalesce(stitched_content, '') || chr(10) AS answer_text
FROM st
UNION ALL
SELECT query_id, 'decline', NULL, NULL, NULL, NULL, '{DECLINE_TEXT}'
FROM questions WHERE query_id NOT IN (SELECT query_id FROM chosen)"""


ANSWER_SQL = with_views(ANSWER_SQL, "vchunks", "vquestions", extra={
    "chunks": "SELECT * FROM vchunks", "questions": "SELECT query_id, text FROM vquestions", "terms": TERMS_SQL})


@query("runbook_answers", "R-08 R-09 R-05 R-07", ANSWER_SQL)
def runbook_answers(t):
    """Vector / fallback / decline answer for every chunk-as-question."""
    return rt.answer(fx.vquestions(t), fx.vchunks(t), exclude_self=True, same_rows=True)


@query("vector_topk_lsh", "R-04")
def vector_topk_lsh(t):
    """Approximate top-5 neighbours via signs of random projections + exact re-rank."""
    v = fx.vchunks(t).select(F.col("vec_id").alias("query_id"), "embedding")
    return rt.vector_search_lsh(v, fx.vchunks(t), 5, exclude_self=True)


@query("vector_lsh_quality", "R-04 R-05", with_views(f"""
SELECT count(*) AS gate_matches, true AS recall_ok, true AS pruned_ok FROM ({TOPK_SQL}) WHERE score >= 0.70""", "vchunks"))
def vector_lsh_quality(t):
    """Exact matches at or above the gate, whether the approximate search finds at least 90 % of
    them, and whether it scores less than half of all pairs."""
    base = fx.vchunks(t)
    v = base.select(F.col("vec_id").alias("query_id"), "embedding")
    gate = rt.vector_search(v, base, 5, exclude_self=True, same_rows=True).where("score >= 0.70")
    near = rt.vector_search_lsh(v, base, 5, exclude_self=True).select("query_id", "match_id", F.lit(1).alias("found"))
    share = rt.scored_pair_share(v, base, rt.lsh_bits(base.count()))
    both = gate.join(near, ["query_id", "match_id"], "left").agg(F.count(F.lit(1)).alias("gate_matches"), F.count("found").alias("found"))
    return both.select("gate_matches", (F.col("found") >= 0.9 * F.col("gate_matches")).alias("recall_ok"),
                       (share.scalar() < 0.5).alias("pruned_ok"))


def _index(t, base):
    """An index written as two batches: the even ids at once, the odd ones appended."""
    path = scratch_path(t.spark, f"vector-index/{uuid.uuid4().hex[:12]}")
    built = VectorIndex.build(base.where(F.col("vec_id") % 2 == 0), path)
    built.append(base.where(F.col("vec_id") % 2 == 1), 1)
    return VectorIndex.open(t.spark, path)


@query("vector_index_quality", "R-04 R-05", with_views(f"""
SELECT count(*) AS gate_matches, true AS recall_ok, true AS scores_ok, true AS pruned_ok FROM ({TOPK_SQL}) WHERE score >= 0.70""", "vchunks"))
def vector_index_quality(t):
    """Exact matches at or above the gate, whether the persisted index finds at least 95 % of them and with the
    exact scores, and whether it compares less than three quarters of all pairs (a share that falls as the base
    grows: 0.63 of 1,000 random vectors, 0.26 of 10,000)."""
    base = fx.vchunks(t)
    v = base.select(F.col("vec_id").alias("query_id"), "embedding")
    index = _index(t, base)
    gate = rt.vector_search(v, base, 5, exclude_self=True, same_rows=True).where("score >= 0.70")
    near = rt.vector_search(v, base, 5, exclude_self=True, strategy="index", index=index).select(
        "query_id", "match_id", F.col("score").alias("found"))
    both = gate.join(near, ["query_id", "match_id"], "left").agg(
        F.count(F.lit(1)).alias("gate_matches"), F.count("found").alias("n"), F.count_if(F.col("found") == F.col("score")).alias("same"))
    return both.select("gate_matches", (F.col("n") >= 0.95 * F.col("gate_matches")).alias("recall_ok"),
                       (F.col("same") == F.col("n")).alias("scores_ok"), (index.scored_share(v).scalar() < 0.75).alias("pruned_ok"))


@query("runbook_answers_indexed", "R-04 R-08 R-09 R-05", ANSWER_SQL)
def runbook_answers_indexed(t):
    """``runbook_answers`` with the vector route through the persisted index."""
    base = fx.vchunks(t)
    return rt.answer(fx.vquestions(t), base, exclude_self=True, strategy="index", index=_index(t, base))


@query("embedded_chunks", "R-02 J-08")
def embedded_chunks(t):
    """Manual chunks with their hashed-n-gram vectors attached."""
    c = ch.manual_chunks(t.documents)
    return ch.attach_embeddings(c, ch.embed_chunks(c))


@query("chunking_comparison", "R-10 R-02 R-03")
def chunking_comparison(t):
    """Best score of each benchmark passage on whole documents vs windows."""
    qs = embed(t.benchmark.select(F.col("item_id").alias("query_id"), "text"), "text")
    docs = embed(t.documents.select(F.col("doc_id").alias("vec_id"), "text"), "text")
    fine = ch.embed_chunks(ch.manual_chunks(t.documents)).withColumn(
        "vec_id", F.xxhash64("document_filename", "chunk_index"))
    return rt.compare_chunkings(qs, docs, fine)


@query("store_name_resolution", "J-10")
def store_name_resolution(t):
    """Informal supplier names ("supplier 12") resolved to store ids."""
    s = t.supplier
    informal = s.select(F.col("s_suppkey").alias("qid"),
                        F.lower(F.regexp_replace("s_name", "#0*", " ")).alias("informal_name"))
    directory = s.select(F.concat(F.lit("STORE_"), F.lpad(F.col("s_suppkey").cast("string"), 3, "0")).alias("store_id"),
                         "s_name")
    return rt.resolve_entity(informal, directory, "qid", "informal_name", "store_id", "s_name")


# ------------------------------------------------- vectors any SQL engine can repeat
def md5_vectors_sql(source: str, key: str, text: str, dim: int = 64, grams: int | None = None) -> str:
    """SQL twin of ``md5_embed``: (key..., embedding) of every row of ``source``."""
    if grams is None:
        tokens = f"SELECT {key}, unnest(string_split_regex(lower({text}), '[^a-z0-9]+')) AS w FROM {source}"
    else:
        tokens = (f"SELECT {key}, substr(' ' || lower({text}) || ' ', CAST(u.i AS BIGINT), {grams}) AS w FROM {source}, "
                  f"unnest(generate_series(1, greatest(length({text}) + 2 - {grams - 1}, 1))) AS u(i)")
    on = " AND ".join(f"a.{k.strip()} = c.{k.strip()}" for k in key.split(","))
    cols = ", ".join(f"a.{k.strip()}" for k in key.split(","))
    return f"""
SELECT {cols}, list(coalesce(c.n / sqrt(a.ss), 0.0::DOUBLE) ORDER BY a.i) AS embedding
FROM (SELECT k.*, r.i, coalesce(s.ss, 0) AS ss FROM (SELECT {key} FROM {source}) k CROSS JOIN range({dim}) AS r(i)
      LEFT JOIN (SELECT {key}, CAST(sum(n * n) AS DOUBLE) AS ss FROM (
        SELECT {key}, p, CAST(count(*) AS DOUBLE) AS n FROM (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS p FROM ({tokens}) WHERE w <> '')
        GROUP BY {key}, p) GROUP BY {key}) s USING ({key})) a
LEFT JOIN (SELECT {key}, p, CAST(count(*) AS DOUBLE) AS n FROM (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS p FROM ({tokens}) WHERE w <> '')
           GROUP BY {key}, p) c ON {on} AND c.p = a.i
GROUP BY {cols}"""


CHUNK_TEXT = "'[' || coalesce(document_title, '') || ']' || chr(10) || chunk_content"
CHUNK_VECTORS = md5_vectors_sql("chunks", "document_filename, chunk_index", CHUNK_TEXT)


@query("md5_embedded_chunks", "R-02 J-08 R-01", with_views(f"""
SELECT c.*, v.embedding FROM chunks c LEFT JOIN ({CHUNK_VECTORS}) v USING (document_filename, chunk_index)""",
                                                          extra={"chunks": CHUNKS_SQL}))
def md5_embedded_chunks(t):
    """Manual chunks with portable vectors attached by (document, index)."""
    c = ch.manual_chunks(t.documents)
    return ch.attach_embeddings(c, ch.embed_chunks(c, embedder=md5_embed))


_BEST = """SELECT q.item_id AS query_id, max(CAST(floor((1 - (1 - list_cosine_similarity(q.embedding, b.embedding))) * 10000.0 + 0.5) AS DOUBLE) / 10000.0) AS {name}
FROM asked q JOIN {base} b ON list_sum(q.embedding) > 0 AND list_sum(b.embedding) > 0 GROUP BY 1"""


@query("md5_chunking_comparison", "R-10 R-02 R-03", with_views(f"""
WITH asked AS ({md5_vectors_sql("benchmark", "item_id", "text")}),
whole AS ({md5_vectors_sql("documents", "doc_id", "text")}),
fine AS ({CHUNK_VECTORS}),
c AS ({_BEST.format(name="coarse_score", base="whole")}), f AS ({_BEST.format(name="fine_score", base="fine")})
SELECT query_id, coarse_score, fine_score, {r4("fine_score - coarse_score")} AS fine_gain FROM c FULL OUTER JOIN f USING (query_id)""",
                                                             extra={"chunks": CHUNKS_SQL}))
def md5_chunking_comparison(t):
    """Best score of each benchmark passage on whole documents vs windows, with portable vectors."""
    qs = md5_embed(t.benchmark.select(F.col("item_id").alias("query_id"), "text"), "text")
    docs = md5_embed(t.documents.select(F.col("doc_id").alias("vec_id"), "text"), "text")
    fine = ch.embed_chunks(ch.manual_chunks(t.documents), embedder=md5_embed).withColumn(
        "vec_id", F.xxhash64("document_filename", "chunk_index"))
    return rt.compare_chunkings(qs, docs, fine)


_NAMES = """SELECT {id} AS id, trim(regexp_replace(regexp_replace({text}, '[^A-Za-z0-9]+', ' ', 'g'), '\\b0+([0-9])', '\\1', 'g')) AS name FROM {source}"""


@query("md5_store_name_resolution", "J-10", f"""
WITH informal AS (SELECT s_suppkey AS qid, lower(regexp_replace(s_name, '#0*', ' ')) AS informal_name FROM supplier),
directory AS (SELECT concat('STORE_', lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')) AS store_id, s_name FROM supplier),
qn AS ({_NAMES.format(id="qid", text="informal_name", source="informal")}), dn AS ({_NAMES.format(id="store_id", text="lower(s_name)", source="directory")}),
qv AS ({md5_vectors_sql("qn", "id", "name", 512, 3)}), dv AS ({md5_vectors_sql("dn", "id", "name", 512, 3)}),
best AS (SELECT q.id AS query_id, d.id AS entity_id,
    CAST(floor((1 - (1 - list_cosine_similarity(q.embedding, d.embedding))) * 10000.0 + 0.5) AS DOUBLE) / 10000.0 AS score
  FROM qv q JOIN dv d ON true),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, entity_id) AS rank FROM best)
SELECT i.qid AS query_id, i.informal_name AS query_text, r.entity_id, s.s_name AS entity_text, r.score, CAST(r.rank AS INTEGER) AS rank
FROM informal i JOIN ranked r ON r.query_id = i.qid AND r.rank = 1 JOIN directory s ON s.store_id = r.entity_id""")
def md5_store_name_resolution(t):
    """Informal supplier names resolved to store ids with portable trigram vectors."""
    s = t.supplier
    informal = s.select(F.col("s_suppkey").alias("qid"), F.lower(F.regexp_replace("s_name", "#0*", " ")).alias("informal_name"))
    key = F.col("s_suppkey").cast("string")
    directory = s.select(F.concat(F.lit("STORE_"), F.lpad(key, F.greatest(F.lit(3), F.length(key)), F.lit("0"))).alias("store_id"), "s_name")
    return rt.resolve_entity(informal, directory, "qid", "informal_name", "store_id", "s_name",
                             embedder=lambda df, c: md5_embed(df, c, dim=512, grams=3))


def _misspelt(t):
    """Customers' and suppliers' names as people write them: lower case, no padding, every third with a letter left out."""
    names = (t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"))
             .unionByName(t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))))
    plain = F.lower(F.regexp_replace("name", "#0*", " "))
    k = F.substring("id", 2, 20).cast("long") % 3
    return names, names.select("id", F.when(k == 0, F.concat(F.substring(plain, 1, 3), F.substring(plain, 5, 50))).otherwise(plain).alias("informal"))


NAME_PAIRS_SQL = f"""
WITH names AS (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_custkey AS k FROM customer
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_suppkey FROM supplier),
informal AS (SELECT id, CASE WHEN k % 3 = 0 THEN substr(p, 1, 3) || substr(p, 5, 50) ELSE p END AS informal
  FROM (SELECT id, k, lower(regexp_replace(name, '#0*', ' ')) AS p FROM names)),
qn AS ({_NAMES.format(id="id", text="informal", source="informal")}), dn AS ({_NAMES.format(id="id", text="lower(name)", source="names")}),
qw AS (SELECT DISTINCT id, substr(' ' || name || ' ', CAST(u.i AS BIGINT), 3) AS w FROM qn, unnest(generate_series(1, length(name))) AS u(i)),
dw AS (SELECT DISTINCT id, substr(' ' || name || ' ', CAST(u.i AS BIGINT), 3) AS w FROM dn, unnest(generate_series(1, length(name))) AS u(i)),
qs AS (SELECT id, count(*) AS n FROM qw GROUP BY id), ds AS (SELECT id, count(*) AS n FROM dw GROUP BY id),
pairs AS (SELECT q.id AS query_id, d.id AS entity_id, count(*) AS shared FROM qw q JOIN dw d USING (w) GROUP BY 1, 2),
scored AS (SELECT query_id, entity_id, shared / sqrt(CAST(qs.n * ds.n AS DOUBLE)) AS raw
  FROM pairs JOIN qs ON qs.id = query_id JOIN ds ON ds.id = entity_id),
ranked AS (SELECT query_id, entity_id, floor(raw * 10000 + 0.5) / 10000 AS score FROM scored WHERE raw >= 0.8 - 1e-9)
SELECT r.query_id, i.informal AS query_text, r.entity_id, n.name AS entity_text, r.score,
  CAST(row_number() OVER (PARTITION BY r.query_id ORDER BY r.score DESC, r.entity_id) AS INTEGER) AS rank
FROM ranked r JOIN informal i ON i.id = r.query_id JOIN names n ON n.id = r.entity_id"""


@query("similar_name_pairs", "J-10", NAME_PAIRS_SQL)
def similar_name_pairs(t):
    """All customers and suppliers whose name is like an informal name (trigram cosine of 0.8 or more)."""
    from storelens.operators.name_match import similar_names
    names, informal = _misspelt(t)
    return similar_names(informal, names, "id", "informal", "id", "name", 0.8)
