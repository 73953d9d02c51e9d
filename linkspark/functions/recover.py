"""Recover structured links from untidy model output (B13, B14), JVM-side.

Direct path: clean the text, ``try_parse_json``, accept an OBJECT root.  An object with a repeated key (the last one
counts) or with NaN or Infinity is read once more, by ``lenient_object``.
Fallback (only rows whose direct parse is not an object): one pass over the string
literals, braces and gaps of the text finds the top-level ``{...}`` blocks; the
first block that parses to an object wins.  No Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference recovery rules.
END_OF_TURN_MARKERS = ("<|im_end|>", "<|endoftext|>", "<|eot_id|>", "</s>")
FENCE_OPEN = r"^```(?:json)?\s*"
FENCE_CLOSE = r"\s*```$"
STRIP = r"^\s+|\s+$"

#: A string literal, a brace, or a run of anything else; possessive, so long strings need no backtracking stack.
TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[{}]|[^"{}]++'


def clean_model_text(col: Column) -> Column:
    s = F.regexp_replace(col, STRIP, "")
    s = F.regexp_replace(s, FENCE_OPEN, "")
    s = F.regexp_replace(s, FENCE_CLOSE, "")
    for tok in END_OF_TURN_MARKERS:
        s = F.replace(s, F.lit(tok), F.lit(""))
    return F.regexp_replace(s, STRIP, "")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def lenient_object(s: Column) -> Column:
    """The JSON object at the beginning of ``s`` as VARIANT, or NULL.  Of a repeated key the last value counts; NaN and
    Infinity are numbers.  Keys repeated inside a nested object are not accepted."""
    read = F.from_json(s, "map<string,variant>", {"allowSingleQuotes": "false"})

    def last_of_each(m: Column) -> Column:
        ordered = F.array_sort(F.transform(F.map_keys(m), lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        pairs = F.arrays_zip(ordered.alias("this"), F.slice(ordered, 2, F.size(ordered)).alias("next"))
        lasts = F.filter(pairs, lambda p: ~p["this"]["k"].eqNullSafe(p["next"]["k"]))
        return F.transform(F.array(F.map_values(m)), lambda v: F.to_variant_object(F.map_from_arrays(
            F.transform(lasts, lambda p: p["this"]["k"]), F.transform(lasts, lambda p: v[p["this"]["i"]]))))[0]

    # a lambda variable holds the map, or each use of it would parse the text again
    return F.transform(F.array(read), last_of_each)[0]


def parse_object(s: Column) -> Column:
    """``s`` as VARIANT if it is a JSON object, else NULL; only what looks like one is read a second time."""
    strict = F.try_parse_json(s)
    likely = s.startswith("{") & s.endswith("}") & s.contains('"')
    return F.when(is_object(strict), strict).when(likely & strict.isNull(), lenient_object(s))


def scanned_object(s: Column) -> Column:
    """The first top-level balanced ``{...}`` block of ``s`` that is a JSON object, as VARIANT, or NULL.

    The text is cut into string literals (escapes respected, the last may be open), single braces and
    whatever lies between, and depth is carried over these pieces, so the work is linear in the text.  An
    unmatched ``}`` drives the depth negative and hides later blocks, as in the reference."""
    init = F.struct(s.cast("binary").alias("bytes"), F.lit(1).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("start"),
                    F.try_parse_json(F.lit(None).cast("string")).alias("found"))

    def step(st: Column, token: Column) -> Column:
        at, depth, start = st["at"], st["depth"], st["start"]
        opening, closing = token == "{", token == "}"
        ends = closing & (depth == 1) & (start > 0)
        # bytes are cut in place; characters would be counted from the beginning of the text, elements copied as a whole
        block = parse_object(F.substring(st["bytes"], start, at - start + 1).cast("string"))
        found = F.when(st["found"].isNull() & ends, block).otherwise(st["found"])
        return F.struct(st["bytes"].alias("bytes"), (at + F.octet_length(token)).alias("at"),
                        F.when(opening, depth + 1).when(closing, depth - 1).otherwise(depth).alias("depth"),
                        F.when(opening & (depth == 0), at).when(ends, F.lit(0)).otherwise(start).alias("start"),
                        found.alias("found"))

    return F.aggregate(F.regexp_extract_all(s, F.lit(TOKEN), F.lit(0)), init, step)["found"]


def recover_object(raw: Column) -> Column:
    """VARIANT holding the recovered JSON object, or NULL when none is found."""
    s = clean_model_text(raw)
    return F.coalesce(parse_object(s), scanned_object(s))


def object_links(v: Column) -> Column:
    """VARIANT object -> ``ARRAY<STRUCT<tbl, col>>`` link rows: one table row per key
    (col NULL) plus one row per string-able element of a list value; a non-list value
    credits the table only."""
    m = F.try_variant_get(v, "$", "map<string,variant>")
    entries = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:variant>>"))

    def per_key(e: Column) -> Column:
        cols = F.coalesce(F.try_variant_get(e["value"], "$", "array<string>"), F.array().cast("array<string>"))
        cols = F.filter(cols, lambda c: c.isNotNull())
        head = F.array(F.struct(e["key"].alias("tbl"), F.lit(None).cast("string").alias("col")))
        return F.concat(head, F.transform(cols, lambda c: F.struct(e["key"].alias("tbl"), c.alias("col"))))

    return F.flatten(F.transform(entries, per_key))


def recover_array(raw: Column, element_schema: str) -> Column:
    """Strip a code fence / ``json`` tag and parse a JSON *list*; NULL when the text
    is not a list of the element type."""
    s = F.regexp_replace(raw, STRIP, "")
    s = F.regexp_replace(s, FENCE_OPEN, "")
    s = F.regexp_replace(s, FENCE_CLOSE, "")
    s = F.regexp_replace(s, STRIP, "")
    v = F.try_parse_json(s)
    ok = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    return F.when(ok, F.try_variant_get(v, "$", f"array<{element_schema}>"))
