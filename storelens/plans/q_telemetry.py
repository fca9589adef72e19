"""Registered telemetry-mart queries (F5) with their DuckDB twins."""

from __future__ import annotations

from storelens.operators import telemetry as tel
from storelens.plans import fixtures as fx
from storelens.plans.oracle import with_views
from storelens.plans.registry import query

LOGS_SQL = f"""
SELECT CASE WHEN c = 0 THEN insert_id ELSE insert_id || '-dup' END AS insert_id,
  TIMESTAMP '{fx.TELEMETRY_BASE}' + call_turn * INTERVAL 1 MINUTE + c * INTERVAL 1 SECOND AS timestamp,
  trace, span_id, CAST(conversation_id AS VARCHAR) AS conversation_id, input_ref, output_ref,
  CASE WHEN call_id % 13 = 0 THEN 'n/a' ELSE CAST(call_turn * 100 AS VARCHAR) END AS usage_input_tokens,
  usage_output_tokens, 'operations_agent' AS agent_name, '["STOP"]' AS finish_reasons,
  'user-' || CAST(conversation_id % 10 AS VARCHAR) AS user_id
FROM log_refs, unnest(CASE WHEN call_id % 5 = 0 THEN [0, 1] ELSE [0] END) AS u(c)"""

MART_SQL = """
WITH refs AS (SELECT * FROM logs WHERE input_ref IS NOT NULL OR output_ref IS NOT NULL),
unpivoted AS (
  SELECT * EXCLUDE (input_ref, output_ref), input_ref AS messages_ref_uri, 'input' AS message_type FROM refs WHERE input_ref IS NOT NULL
  UNION ALL
  SELECT * EXCLUDE (input_ref, output_ref), output_ref, 'output' FROM refs WHERE output_ref IS NOT NULL),
parts AS (
  SELECT file_name, role, idx AS message_idx, u.i - 1 AS part_idx, u.line, (idx + u.i - 1) % 5 AS kind
  FROM messages, unnest(string_split(content, chr(10))) WITH ORDINALITY AS u(line, i)),
flat AS (
  SELECT r.*, split_part(nullif(regexp_extract(r.messages_ref_uri, '/([^/]+)\\.jsonl', 1), ''), '_', 1) AS api_call_id,
    p.role, p.message_idx, p.part_idx,
    CASE kind WHEN 1 THEN 'tool_call' WHEN 2 THEN 'tool_call_response' WHEN 3 THEN 'uri' ELSE 'text' END AS part_type,
    CASE WHEN kind NOT IN (1, 2, 3) THEN p.line END AS content, CASE WHEN kind = 3 THEN 'gs://media/' || md5(p.line) END AS uri,
    CASE WHEN kind = 3 THEN 'image/png' END AS mime_type, CASE WHEN kind NOT IN (1, 2, 3) THEN md5(p.line) END AS data_md5_hex,
    CASE WHEN kind IN (1, 2) THEN 'lookup_store' END AS tool_name,
    CASE WHEN kind = 1 THEN '{"chars":' || length(p.line) || '}' END AS tool_args,
    CASE WHEN kind = 2 THEN '{"found":' || length(p.line) || '}' END AS tool_response
  FROM unpivoted r JOIN parts p ON r.messages_ref_uri = p.file_name),
w1 AS (
  SELECT *, row_number() OVER (PARTITION BY conversation_id, trace, span_id, message_type, role, message_idx, part_idx
                               ORDER BY timestamp DESC, insert_id ASC) AS rn1 FROM flat),
w2 AS (
  SELECT *, CASE WHEN message_type = 'input' THEN row_number() OVER (
      PARTITION BY conversation_id, message_type, role, message_idx, part_idx ORDER BY timestamp ASC, insert_id ASC)
    ELSE 1 END AS rn2
  FROM w1 WHERE rn1 = 1)
SELECT timestamp, insert_id, trace, span_id, conversation_id, api_call_id, message_type, role, message_idx, part_idx,
  content, part_type, tool_name, tool_args, tool_response, usage_input_tokens, usage_output_tokens, agent_name,
  finish_reasons, user_id, uri, mime_type, data_md5_hex, messages_ref_uri
FROM w2 WHERE rn2 = 1 AND NOT (message_type = 'input' AND role = 'assistant')"""


@query("completions_mart", "M-01 M-02 M-03 M-04 U-01 J-05 W-01 W-02 S-10",
       with_views(MART_SQL, "log_refs", "messages", extra={"logs": LOGS_SQL}))
def completions_mart(t):
    """De-duplicated model-call message mart (24 columns)."""
    return tel.completions_mart(fx.inference_logs(t), fx.completions(t))


@query("completions_mart_counts", "M-04 W-01 W-02 L-03",
       with_views(f"SELECT message_type, role, count(*) AS messages, count(DISTINCT api_call_id) AS calls "
                  f"FROM ({MART_SQL}) GROUP BY 1, 2", "log_refs", "messages", extra={"logs": LOGS_SQL}))
def completions_mart_counts(t):
    """Mart rows and calls per message type and role."""
    from pyspark.sql import functions as F
    m = tel.completions_mart(fx.inference_logs(t), fx.completions(t))
    return m.groupBy("message_type", "role").agg(F.count(F.lit(1)).alias("messages"),
                                                 F.count_distinct("api_call_id").alias("calls"))


@query("conversation_turns", "A-07", """
SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role = 'assistant') AS assistant_turns
FROM conversations GROUP BY 1""")
def conversation_turns(t):
    """Turns per conversation."""
    return tel.turn_count(t.conversations)


@query("usage_by_agent_user", "A-08 M-01", with_views("""
SELECT agent_name, user_id, count(*) AS calls, sum(TRY_CAST(usage_input_tokens AS BIGINT)) AS input_tokens,
  sum(TRY_CAST(usage_output_tokens AS BIGINT)) AS output_tokens
FROM (SELECT DISTINCT ON (insert_id) * FROM logs WHERE input_ref IS NOT NULL OR output_ref IS NOT NULL)
GROUP BY 1, 2""", "log_refs", extra={"logs": LOGS_SQL}))
def usage_by_agent_user(t):
    """Token usage per agent and user, one row per log insert id."""
    return tel.usage_by(fx.inference_logs(t))


@query("completions_mart_from_files", "S-03 J-05 M-04 S-10",
       with_views(MART_SQL, "log_refs", "messages", extra={"logs": LOGS_SQL}))
def completions_mart_from_files(t):
    """The mart with messages read back from NDJSON files whose lines name their message
    file, beside a malformed line that the reader sets aside under its bad-record limit."""
    import uuid

    from storelens.session import scratch_path
    from storelens.sources.messages import read_messages, write_messages

    base = scratch_path(t.spark, f"messages/{uuid.uuid4().hex[:12]}")
    write_messages(fx.completions(t), f"{base}/lines")
    t.spark.createDataFrame([("{not json",)], "value string").write.text(f"{base}/broken")
    msgs = read_messages(t.spark, f"{base}/*", max_bad=1000, file_column="file_name")
    return tel.completions_mart(fx.inference_logs(t), msgs)


@query("completions_view_ordered", "S-10 L-03",
       with_views(MART_SQL, "log_refs", "messages", extra={"logs": LOGS_SQL}))
def completions_view_ordered(t):
    """The mart through its registered view, in presentation order."""
    view = tel.register_completions_view(t.spark, fx.inference_logs(t), fx.completions(t))
    return tel.order_mart(view)


TOOL_SQL = """
WITH parts AS (
  SELECT u.i - 1 AS part_idx, length(u.line) AS n, (idx + u.i - 1) % 5 AS kind
  FROM messages, unnest(string_split(content, chr(10))) WITH ORDINALITY AS u(line, i)),
calls AS (
  SELECT CASE kind WHEN 1 THEN 'arguments' ELSE 'response' END AS tool_side, CASE kind WHEN 1 THEN 'chars' ELSE 'found' END AS field,
    part_idx % 3 AS form, n FROM parts WHERE kind IN (1, 2)),
vals AS (
  SELECT tool_side, '$.' || field AS path, 'BIGINT' AS kind, false AS malformed, n FROM calls WHERE form = 0
  UNION ALL SELECT tool_side, '$.query.inner.' || field, 'BIGINT', false, n FROM calls WHERE form = 1
  UNION ALL SELECT tool_side, '$.query.tags[0]', 'STRING', false, NULL FROM calls WHERE form = 1
  UNION ALL SELECT tool_side, '$.query.tags[1]', 'VOID', false, NULL FROM calls WHERE form = 1
  UNION ALL SELECT tool_side, NULL, NULL, true, NULL FROM calls WHERE form = 2)
SELECT 'lookup_store' AS tool_name, tool_side, path, kind, malformed, count(*) AS occurrences, min(n) AS smallest, max(n) AS largest,
  sum(n)::BIGINT AS total
FROM vals GROUP BY ALL"""


@query("tool_argument_paths", "M-03", with_views(TOOL_SQL, "messages"))
def tool_argument_paths(t):
    """Paths, types and ranges of the values in tool calls' arguments and responses, malformed JSON
    counted; a third of the calls has nested arguments and a third is cut short."""
    from pyspark.sql import functions as F

    def forms(c):
        nested = F.concat(F.lit('{"query":{"inner":'), F.col(c), F.lit(',"tags":["a",null]}}'))
        return F.when(F.col("part_idx") % 3 == 1, nested).when(F.col("part_idx") % 3 == 2, F.substring(c, 1, 6)).otherwise(F.col(c))

    flat = tel.flatten_parts(fx.completions(t))
    flat = flat.select("tool_name", "part_idx", "tool_args", "tool_response").withColumns(
        {c: forms(c) for c in ("tool_args", "tool_response")})
    number = F.when(F.col("kind") == "BIGINT", F.col("value").cast("long"))
    return tel.tool_values(flat).groupBy("tool_name", "tool_side", "path", "kind", "malformed").agg(
        F.count(F.lit(1)).alias("occurrences"), F.min(number).alias("smallest"), F.max(number).alias("largest"), F.sum(number).alias("total"))
