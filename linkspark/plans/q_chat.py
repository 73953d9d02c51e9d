"""Chat rendering queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chat as CH
from ..sources.tables import read_table
from .oracle_fixtures import with_views
from .registry import query

_TURN = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"


@query("chat_render", with_views(f"""
    SELECT conv_id, count(*) AS n_turns,
      CASE WHEN arg_min(role, turn) = 'system' THEN ''
           ELSE '<|im_start|>system' || chr(10) || '{CH.DEFAULT_SYSTEM}' || '<|im_end|>' || chr(10) END
      || string_agg({_TURN}, '' ORDER BY turn) AS rendered
    FROM conversations GROUP BY conv_id"""))
def q_chat_render(spark, d):
    conv = read_table(spark, d, "conversations")
    return CH.render_chat(conv).select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "rendered")


@query("prompt_completion", with_views("""
    SELECT conv_id, count(*) - 1 AS n_prompt,
      coalesce(string_agg(role, ',' ORDER BY turn) FILTER (WHERE turn < max_turn), '') AS prompt_roles,
      arg_max(role, turn) AS completion_role, arg_max(text, turn) AS completion_text
    FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS max_turn FROM conversations) c GROUP BY conv_id"""))
def q_prompt_completion(spark, d):
    pc = CH.prompt_completion(read_table(spark, d, "conversations"))
    return pc.select("conv_id", F.size("prompt").cast("long").alias("n_prompt"),
                     F.array_join(F.transform("prompt", lambda x: x["role"]), ",").alias("prompt_roles"),
                     pc.completion[0]["role"].alias("completion_role"),
                     pc.completion[0]["content"].alias("completion_text"))
