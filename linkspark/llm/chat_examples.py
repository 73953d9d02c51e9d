"""Chat formatting: prefix-target expansion, in built-in functions only.

Every assistant turn becomes one training example whose text is the conversation up to and
including that turn; only the reply lies under the loss mask.  A conversation that does not end
with an assistant turn gives one further row without a target, so that no turn is lost.

Template: ``<turn:ROLE>TEXT</turn>`` for each turn, nothing between turns.  In texts and roles
``\\`` becomes ``\\b``, ``</turn>`` becomes ``\\c`` and ``<turn:`` becomes ``\\o``; in roles ``>``
becomes ``\\g`` too.  Every backslash of a formatted text therefore starts one of these pairs,
which makes the escape reversible and a marker inside a text impossible.

Defined cases: a null text or role is empty; rows of a conversation go by (turn, role, text), nulls
first; repeated rows are repeated turns; a null ``conv_id`` is a conversation of its own; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkspark.llm.common import read

OPEN, CLOSE = "<turn:", "</turn>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\b"), (CLOSE, "\\c"), (OPEN, "\\o")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in ((OPEN, "\\o"), (CLOSE, "\\c"), (">", "\\g"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def transcripts(turns: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """One row per conversation: ``formatted``, and ``targets`` with the end of each example and the
    span of its reply (0-based code points, end exclusive).

    One exchange by ``conv_id``: running lengths come from a streaming window, and the transcript is
    put together in the same partitioning.  Two copies of a conversation's text are the largest thing
    a task holds.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit(">"))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = turns.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escape(text).alias("body"),
    ).select(
        "conv_id",
        F.row_number().over(by_turn).alias("n"),
        F.sum(F.length("head") + F.length("body") + F.lit(len(CLOSE))).over(
            by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long").alias("end"),
        F.length("body").cast("long").alias("body_len"),
        F.coalesce(F.col("role") == target_role, F.lit(False)).alias("is_target"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
    )
    rows = F.array_sort(F.collect_list(F.struct("n", "end", "body_len", "is_target", "piece")))
    grouped = pieces.groupBy("conv_id").agg(rows.alias("r"))
    body_end = lambda x: x["end"] - F.lit(len(CLOSE))
    last = F.element_at("r", -1)
    spans = F.transform(F.filter("r", lambda x: x["is_target"]), lambda x: F.struct(
        x["end"].alias("end"), (body_end(x) - x["body_len"]).alias("loss_start"), body_end(x).alias("loss_end")))
    rest = F.when(~last["is_target"], F.array(F.struct(
        last["end"].alias("end"), last["end"].alias("loss_start"), last["end"].alias("loss_end"))))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("r", lambda x: x["piece"]), "").alias("formatted"),
        F.concat(spans, F.coalesce(rest, F.expr(
            "cast(array() as array<struct<end:bigint,loss_start:bigint,loss_end:bigint>>)"))).alias("targets"),
    )


def expand_targets(turns: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """One row per example: ``conv_id, example`` (from 0), ``text`` (context and reply), ``loss_start,
    loss_end`` (the reply's span in ``text``, equal where nothing is trainable), ``is_last``."""
    t = transcripts(turns, target_role).select(
        "conv_id", "formatted", F.size("targets").alias("n_examples"), F.posexplode("targets").alias("example", "t"))
    return t.select(
        "conv_id", "example",
        F.substring("formatted", F.lit(1), F.col("t.end").cast("int")).alias("text"),
        F.col("t.loss_start").alias("loss_start"), F.col("t.loss_end").alias("loss_end"),
        (F.col("example") == F.col("n_examples") - 1).alias("is_last"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples hold, per conversation: the turns of the last (longest) example, and the
    unescaped texts under all loss masks in order."""
    masked = F.substring("text", (F.col("loss_start") + 1).cast("int"),
                         (F.col("loss_end") - F.col("loss_start")).cast("int"))
    per = examples.select(
        "conv_id", F.struct("example", unescape(masked).alias("reply")).alias("reply"),
        F.length("text").cast("long").alias("chars"), F.when(F.col("is_last"), F.col("text")).alias("whole"))
    conv = per.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("reply")).alias("replies"), F.max("whole").alias("whole"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
    # every turn ends with CLOSE, so the last piece of the split is empty
    parts = F.split(F.col("whole"), CLOSE)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    canon = F.transform(turns, lambda p: F.concat(
        unescape(F.substring_index(F.substring(p, F.lit(len(OPEN) + 1), F.length(p)), ">", 1)), F.lit("\n"),
        unescape(F.substring(p, F.instr(p, ">") + 1, F.length(p))), F.lit("\n")))
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return conv.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(canon, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_examples")


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return read_back(expand_targets(turns.unionByName(probe)))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM t
), l AS (
  SELECT *,
    13 + length(replace(replace(replace(text, '\', '\b'), '</turn>', '\c'), '<turn:', '\o'))
       + length(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\c'), '<turn:', '\o'), '>', '\g')) + 1 AS len
  FROM e
), p AS (
  SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY n) AS until,
    max(n) OVER (PARTITION BY conv_id) AS last_n
  FROM l
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR n = last_n THEN until ELSE 0 END) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (role = 'assistant' OR n = last_n) AS BIGINT) AS n_examples
FROM p GROUP BY conv_id
"""
