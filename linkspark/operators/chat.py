"""Chat records: ChatML rendering and prompt / completion split.

A conversation is one group (its own turns), ordered by ``turn``; nothing larger
than a conversation is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the chat template (plain turns).
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."


def _turn_text(role, content):
    return F.concat(F.lit(IM_START), role, F.lit("\n"), content, F.lit(IM_END), F.lit("\n"))


def render_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", add_generation_prompt: bool = False) -> DataFrame:
    """``(conv, n_turns, rendered)``: a default system turn is prepended when the
    first message is not a system message; every message is rendered in turn order."""
    msgs = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("r"),
                                                F.col(text).alias("c"))))
    g = turns.groupBy(conv).agg(msgs.alias("m"))
    header = F.when(g.m[0]["r"] == "system", F.lit("")).otherwise(_turn_text(F.lit("system"), F.lit(DEFAULT_SYSTEM)))
    body = F.array_join(F.transform("m", lambda x: _turn_text(x["r"], x["c"])), "")
    out = F.concat(header, body)
    if add_generation_prompt:
        out = F.concat(out, F.lit(IM_START + "assistant\n"))
    return g.select(conv, F.size("m").alias("n_turns"), out.alias("rendered"))


def prompt_completion(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """prompt = every message but the last, completion = the last message."""
    msgs = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                                                F.col(text).alias("content"))))
    g = turns.groupBy(conv).agg(msgs.alias("m"))
    n = F.size("m")
    prompt = F.slice("m", 1, n - 1)
    last = F.element_at("m", -1)
    return g.select(conv, F.transform(prompt, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("prompt"),
                    F.array(F.struct(last["role"].alias("role"), last["content"].alias("content"))).alias("completion"))
