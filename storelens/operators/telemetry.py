"""Model-call telemetry mart: log references joined to message files,
flattened, de-duplicated in two stages (U-01, J-05, M-01..M-04, W-01,
W-02, A-07, A-08, L-03, S-10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Completion message files: one JSON object per line.
PART_TYPE = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("content", T.StringType()),
    T.StructField("mime_type", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("data", T.BinaryType()), T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType()),
    T.StructField("response", T.StringType()),
])
MESSAGE_SCHEMA = T.StructType([
    T.StructField("parts", T.ArrayType(PART_TYPE)),
    T.StructField("role", T.StringType()),
    T.StructField("index", T.LongType()),
])

# Output columns of the mart, in the reference's order.
MART_COLUMNS = (
    "timestamp", "insert_id", "trace", "span_id", "conversation_id", "api_call_id",
    "message_type", "role", "message_idx", "part_idx", "content", "part_type", "tool_name",
    "tool_args", "tool_response", "usage_input_tokens", "usage_output_tokens", "agent_name",
    "finish_reasons", "user_id", "uri", "mime_type", "data_md5_hex", "messages_ref_uri",
)
REF_FIELDS = ("conversation_id", "input_ref", "output_ref", "usage_input_tokens",
              "usage_output_tokens", "agent_name", "finish_reasons", "user_id")
WITHIN_TRACE_KEYS = ("conversation_id", "trace", "span_id", "message_type", "role", "message_idx", "part_idx")
ACROSS_TRACE_KEYS = ("conversation_id", "message_type", "role", "message_idx", "part_idx")


def extract_refs(logs: DataFrame) -> DataFrame:
    """M-01: project the reference fields out of the nested ``labels``
    struct (nested column pruning reads only these leaves) and keep rows
    that carry an input or an output reference."""
    L = lambda f: F.col(f"labels.gen_ai_{f}")
    out = logs.select(
        F.col("insertId").alias("insert_id"), "timestamp", "trace", F.col("spanId").alias("span_id"),
        L("conversation_id").alias("conversation_id"), L("input_messages_ref").alias("input_ref"),
        L("output_messages_ref").alias("output_ref"), L("usage_input_tokens").alias("usage_input_tokens"),
        L("usage_output_tokens").alias("usage_output_tokens"), L("agent_name").alias("agent_name"),
        L("response_finish_reasons").alias("finish_reasons"), F.col("labels.user_id").alias("user_id"))
    return out.where(F.col("input_ref").isNotNull() | F.col("output_ref").isNotNull())


def unpivot_refs(refs: DataFrame) -> DataFrame:
    """U-01: one row per message reference with its type tag, in a single
    pass over the source (explode of a two-element array, nulls dropped)
    instead of a UNION ALL that scans the source twice."""
    keep = [c for c in refs.columns if c not in ("input_ref", "output_ref")]
    pairs = F.array(F.struct(F.lit("input").alias("t"), F.col("input_ref").alias("u")),
                    F.struct(F.lit("output").alias("t"), F.col("output_ref").alias("u")))
    x = refs.select(*keep, F.explode(pairs).alias("_r"))
    return (x.where(F.col("_r.u").isNotNull())
             .select(*keep, F.col("_r.u").alias("messages_ref_uri"), F.col("_r.t").alias("message_type")))


def api_call_id(uri) -> F.Column:
    """M-02: base name before ``.jsonl``, text before the first ``_``;
    null when the path has no ``.jsonl`` base name."""
    base = F.nullif(F.regexp_extract(uri, r"/([^/]+)\.jsonl", 1), F.lit(""))
    return F.split(base, "_").getItem(0)


def normalise_path(c) -> F.Column:
    """One form of a file uri, so that the uris a scan reports compare with
    those written in log records: the ``file:`` scheme is stripped and the object-store
    connectors' ``s3a`` and ``s3n`` become ``s3``; ``gs://`` and others stay."""
    return F.regexp_replace(F.regexp_replace(c, r"^file:(//)?", ""), r"^s3[an]://", "s3://")


def decode_path(c) -> F.Column:
    """Undo the percent encoding of ``_metadata.file_path`` (a plus sign is itself there)."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def join_messages(refs: DataFrame, messages: DataFrame) -> DataFrame:
    """J-05: log reference = message file name (inner equi-join). Both
    sides grow with traffic, so this is a shuffle join on the path."""
    m = messages.select(F.col("file_name").alias("_file"), "role", "parts",
                        F.col("index").alias("message_idx"))
    j = refs.join(m, normalise_path(refs.messages_ref_uri) == normalise_path(m._file))
    return j.drop("_file").withColumn("api_call_id", api_call_id(F.col("messages_ref_uri")))


def flatten_parts(joined: DataFrame) -> DataFrame:
    """M-03: one row per part with its 0-based position and the hex MD5
    of its binary payload."""
    keep = [c for c in joined.columns if c != "parts"]
    x = joined.select(*keep, F.posexplode("parts").alias("part_idx", "part"))
    return x.select(
        *keep, "part_idx", F.col("part.type").alias("part_type"), F.col("part.content").alias("content"),
        F.col("part.uri").alias("uri"), F.col("part.mime_type").alias("mime_type"),
        F.md5(F.col("part.data")).alias("data_md5_hex"), F.col("part.id").alias("tool_id"),
        F.col("part.name").alias("tool_name"), F.col("part.arguments").alias("tool_args"),
        F.col("part.response").alias("tool_response"))


def tool_values(flat: DataFrame, depth: int = 4) -> DataFrame:
    """M-03 on the inside of tool calls: every value within the JSON arguments and responses of
    flattened parts, as (all columns of ``flat``, tool_side, path, kind, value, malformed).

    JSON is parsed once into a Variant; objects and arrays are opened level by
    level, in generators, without a shuffle. What lies deeper than ``depth`` levels comes as one
    row of kind OBJECT or ARRAY with its JSON; so do empty objects and arrays. Text that is no JSON is one row
    with ``malformed`` true and no path; a JSON null is a row of kind VOID; a null column gives none."""
    keep = [F.col(f"`{c}`") for c in flat.columns]
    sides = F.array(F.struct(F.lit("arguments").alias("side"), F.col("tool_args").alias("json")),
                    F.struct(F.lit("response").alias("side"), F.col("tool_response").alias("json")))
    rows = flat.select(F.struct(*keep).alias("row"), F.explode(sides).alias("s")).where("s.json IS NOT NULL")
    node = F.try_parse_json("s.json")
    rows = rows.select("row", F.col("s.side").alias("side"), F.when(node.isNotNull(), F.lit("$")).alias("path"), node.alias("node"))
    done = []
    for level in range(depth + 1):
        kind = F.expr("regexp_extract(schema_of_variant(node), '^[A-Z]+', 0)")
        rows = rows.withColumn("kind", kind)
        full = F.col("kind").isin("OBJECT", "ARRAY") & ~F.to_json("node").isin("{}", "[]")
        opens = F.coalesce(full, F.lit(False)) if level < depth else F.lit(False)
        done.append(rows.where(~opens))
        if level == depth:
            break
        inner = rows.where(opens).selectExpr("row", "side", "path", "kind AS up", "node AS whole")
        inner = inner.lateralJoin(inner.sparkSession.tvf.variant_explode(F.col("whole").outer()))
        step = F.when(F.col("up") == "ARRAY", F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(
            F.concat(F.lit("."), F.col("key")))
        rows = inner.select("row", "side", F.concat("path", step).alias("path"), F.col("value").alias("node"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    text = F.when(F.col("kind").isin("OBJECT", "ARRAY"), F.to_json("node")).otherwise(F.expr("try_variant_get(node, '$', 'string')"))
    return out.select("row.*", F.col("side").alias("tool_side"), "path", "kind", text.alias("value"), F.col("path").isNull().alias("malformed"))


def dedup_within_trace(flat: DataFrame) -> DataFrame:
    """W-01: keep the latest copy of a part within one trace/span
    (insert id breaks timestamp ties)."""
    w = Window.partitionBy(*WITHIN_TRACE_KEYS).orderBy(F.col("timestamp").desc(), F.col("insert_id").asc())
    return flat.withColumn("_rn1", F.row_number().over(w)).where(F.col("_rn1") == 1).drop("_rn1")


def dedup_across_traces(df: DataFrame) -> DataFrame:
    """W-02: input messages repeat in later calls' input files; keep the
    earliest copy of each (timestamp ascending, as the reference's code
    does, whatever its comment says). Outputs are all kept."""
    w = Window.partitionBy(*ACROSS_TRACE_KEYS).orderBy(F.col("timestamp").asc(), F.col("insert_id").asc())
    rn = F.when(F.col("message_type") == "input", F.row_number().over(w)).otherwise(F.lit(1))
    return df.withColumn("_rn2", rn).where(F.col("_rn2") == 1).drop("_rn2")


def completions_mart(logs: DataFrame, messages: DataFrame, ordered: bool = False,
                     partitions: int | None = None) -> DataFrame:
    """M-04: U-01 -> J-05 -> M-03 -> W-01 -> W-02 -> drop echoed assistant
    inputs -> 24 columns.

    The rows are hash-partitioned once on the across-trace keys; that
    partitioning also satisfies the within-trace window (its keys are a
    superset), so both de-dup windows run without another shuffle.
    """
    out = settled(flatten_parts(join_messages(unpivot_refs(extract_refs(logs)), messages)), partitions)
    return order_mart(out) if ordered else out


def settled(flat: DataFrame, partitions: int | None = None) -> DataFrame:
    """Both de-dup stages over flattened parts, without echoed assistant inputs: the mart's rows."""
    keys = [F.col(k) for k in ACROSS_TRACE_KEYS]
    flat = flat.repartition(partitions, *keys) if partitions else flat.repartition(*keys)
    out = dedup_across_traces(dedup_within_trace(flat))
    out = out.where(~((F.col("message_type") == "input") & (F.col("role") == "assistant")))
    return out.select(*MART_COLUMNS)


def order_mart(df: DataFrame) -> DataFrame:
    """L-03: the mart's presentation order (a global sort; use only for output)."""
    return df.orderBy("conversation_id", "timestamp", "message_type", "message_idx", "part_idx")


def register_completions_view(spark: SparkSession, logs: DataFrame, messages: DataFrame,
                              name: str = "completions_view") -> DataFrame:
    """S-10: expose the mart as a named, lazily evaluated view."""
    df = completions_mart(logs, messages)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def turn_count(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """A-07: turns per conversation (and how many were the assistant's)."""
    return conversations.groupBy(key).agg(
        F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col("role") == "assistant").alias("assistant_turns"))


def usage_by(logs: DataFrame, keys=("agent_name", "user_id")) -> DataFrame:
    """A-08: token usage per key. Log rows are first reduced to one per
    ``insert_id`` (exports can repeat a row); token counts arrive as
    strings and are parsed with ``try_cast`` (bad values count as null)."""
    refs = extract_refs(logs).dropDuplicates(["insert_id"])
    return refs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(F.col("usage_input_tokens").try_cast("long")).alias("input_tokens"),
        F.sum(F.col("usage_output_tokens").try_cast("long")).alias("output_tokens"))
