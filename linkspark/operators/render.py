"""Render schemas, prompts and training targets.

Per-table lines are rendered once (one group = one table's columns); a schema
text is the ordered join of its table lines; a question's prompt context joins
only the lines of the tables kept for it.  Nothing larger than one schema or one
question's context is ever assembled in a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small

# Fixed texts of the prompt format.
SYSTEM_PROMPT = (
    "You are a schema-linking assistant. Given a database schema and a natural-language "
    "question, identify the tables and columns that the underlying SQL query would reference. "
    "Reply with a single JSON object on one line and nothing else. "
    "The JSON keys are table names from the schema; the value for each key is a list of "
    "column names from that table that the SQL would reference. "
    "A table referenced with no specific columns (e.g. `SELECT COUNT(*) FROM t`) must appear "
    "with an empty list: {\"t\": []}. "
    "Use only identifiers that appear in the provided schema -- do not invent table or column names."
)
STYLES = ("compact", "types", "keys", "types_keys")


def render_column(style: str) -> Column:
    """``c``, ``c (type)``, ``c*``, ``c->T.c`` or ``c (type)*->T.c``.
    Expects ``col, data_type, is_pk, to_table, to_column`` (FK columns may be NULL)."""
    if style not in STYLES:
        raise ValueError(f"Unknown style: {style!r}")
    s = F.col("col")
    if style in ("types", "types_keys"):
        s = F.concat(s, F.lit(" ("), F.lower("data_type"), F.lit(")"))
    if style in ("keys", "types_keys"):
        s = F.concat(s, F.when(F.col("is_pk"), F.lit("*")).otherwise(F.lit("")),
                     F.when(F.col("to_table").isNotNull(),
                            F.concat(F.lit("->"), F.col("to_table"), F.lit("."), F.col("to_column")))
                     .otherwise(F.lit("")))
    return s


def with_fk_targets(columns: DataFrame, fks: DataFrame) -> DataFrame:
    """Attach each column's FK target; of several FKs of a column the last listed (by ``fk_idx``)."""
    f = fks.groupBy("db_id", "from_table", "from_column").agg(
        F.max(F.struct("fk_idx", "to_table", "to_column")).alias("t"))
    f = f.select("db_id", F.col("from_table").alias("tbl"), F.col("from_column").alias("col"),
                 F.col("t.to_table").alias("to_table"), F.col("t.to_column").alias("to_column"))
    return columns.join(broadcast_if_small(f), ["db_id", "tbl", "col"], "left")


def table_lines(columns: DataFrame, style: str = "compact") -> DataFrame:
    """``(db_id, table_idx, tbl, n_cols, line)`` with ``line = 'T: c1, c2'`` in column order."""
    rendered = columns.select("db_id", "table_idx", "tbl", "column_idx", render_column(style).alias("txt"))
    g = rendered.groupBy("db_id", "table_idx", "tbl").agg(
        F.array_sort(F.collect_list(F.struct("column_idx", "txt"))).alias("c"))
    return g.select("db_id", "table_idx", "tbl", F.size("c").alias("n_cols"),
                    F.concat(F.col("tbl"), F.lit(": "),
                             F.array_join(F.transform("c", lambda x: x["txt"]), ", ")).alias("line"))


def serialize(lines: DataFrame) -> DataFrame:
    """One text per database, tables in schema order."""
    g = lines.groupBy("db_id").agg(F.array_sort(F.collect_list(F.struct("table_idx", "line"))).alias("l"))
    return g.select("db_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("schema_text"))


def context_for_questions(kept: DataFrame, lines: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """B6 (assembly): ``kept(keys, db_id, table_idx)`` -> the kept tables' lines in schema order.  Lines are looked
    up where ``kept`` is, if they are small, and not exchanged where it comes partitioned by ``keys``."""
    keys = list(keys)
    j = kept.join(broadcast_if_small(lines.select("db_id", "table_idx", "line")), ["db_id", "table_idx"])
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("table_idx", "line"))).alias("l"))
    return g.select(*keys, F.size("l").alias("n_tables"),
                    F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("context"))


def user_message(db_id: Column, question: Column, schema_text: Column) -> Column:
    """The user turn of the prompt."""
    return F.concat(F.lit("Database: "), db_id, F.lit("\nSchema:\n"), schema_text,
                    F.lit("\n\nQuestion: "), question, F.lit("\n\nOutput the schema_links JSON now."))


# fixed values: the system turns of the two stages
STAGE_A_SYSTEM = (
    "You are a schema-linking assistant. Given a database's TABLE NAMES and a "
    "natural-language question, identify the tables the underlying SQL would "
    "reference. Reply with a single JSON object on one line and nothing else, "
    "of the form: {\"tables\": [\"Table1\", \"Table2\"]}. Use only table names "
    "that appear in the provided list -- do not invent names."
)
STAGE_B_SYSTEM = (
    "You are a schema-linking assistant. Given a database table's COLUMN names "
    "and a natural-language question, identify the columns of that table the "
    "underlying SQL would reference. Reply with a single JSON object on one "
    "line and nothing else, of the form: {\"columns\": [\"Col1\", \"Col2\"]}. "
    "A table referenced with no specific columns (e.g. `SELECT COUNT(*) FROM t`) "
    "should produce {\"columns\": []}. Use only column names that appear in the "
    "provided list -- do not invent names."
)


def messages(system: str, user: Column, assistant: Column) -> Column:
    """A training record's three turns."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user), turn("assistant", assistant))


def named_list(name: str, items: Column) -> Column:
    """``{"name": ["x","y"]}`` with the items as given."""
    return F.concat(F.lit('{"' + name + '": ['), F.array_join(F.transform(items, _json_str), ","), F.lit("]}"))


def reasoned(reasoning: Column, target: Column) -> Column:
    """The assistant turn with a rationale before the target; null without one."""
    bare = F.regexp_replace(reasoning, r"^\s+|\s+$", "")
    return F.when(reasoning != "", F.concat(bare, F.lit("\n"), target))


# fixed values: the texts of the user turns
def stage_a_user(db_id: Column, question: Column, table_list: Column) -> Column:
    """B10 stage A: table names only."""
    return F.concat(F.lit("Database: "), db_id, F.lit("\nTables:\n"),
                    F.array_join(F.transform(table_list, lambda t: F.concat(F.lit("- "), t)), "\n"),
                    F.lit("\n\nQuestion: "), question, F.lit("\n\nOutput the tables JSON now."))


def stage_b_user(db_id: Column, question: Column, table: Column, columns: Column) -> Column:
    """B10 stage B: one table and its columns."""
    return F.concat(F.lit("Database: "), db_id, F.lit("\nTable: "), table, F.lit("\nColumns: "),
                    F.array_join(columns, ", "), F.lit("\n\nQuestion: "), question,
                    F.lit("\n\nOutput the columns JSON now."))


# fixed values: the short JSON escapes, by UTF-16 unit in hex
_JSON_SHORT = {"0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f", "000D": "\\r", "0022": '\\"', "005C": "\\\\"}


def _json_str(c: Column) -> Column:
    """A JSON string in ASCII: other characters as ``\\uXXXX``, one per UTF-16 unit."""
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    units = F.hex(F.encode(c, "UTF-16BE"))
    short = F.create_map(*[F.lit(x) for pair in _JSON_SHORT.items() for x in pair])

    def one(i: Column) -> Column:
        u = F.substring(units, i * 4 + 1, F.lit(4))
        return (F.when(short[u].isNotNull(), short[u])
                .when((u < "0020") | (u > "007E"), F.concat(F.lit("\\u"), F.lower(u)))
                .otherwise(F.char(F.conv(u, 16, 10).cast("int"))))

    escaped = F.array_join(F.transform(F.sequence(F.lit(0), (F.length(units) / 4 - 1).cast("int")), one), "")
    return F.concat(F.lit('"'), F.when(c.rlike("[^ -~]"), escaped).otherwise(plain), F.lit('"'))


def canonical_target(links: DataFrame, keys: Sequence[str] = ("question_id",)) -> DataFrame:
    """``{"A": ["x","y"],"B": []}`` - sorted keys and columns, ``,`` between items and
    ``: `` after keys, empty lists kept.  Built per question from the normal form."""
    keys = list(keys)
    per_t = links.groupBy(*keys, "tlc").agg(F.min("tbl").alias("tbl"),
                                            F.array_sort(F.collect_set("col")).alias("cols"))
    item = F.concat(_json_str(F.col("tbl")), F.lit(": ["),
                    F.array_join(F.transform("cols", _json_str), ","), F.lit("]"))
    per_t = per_t.select(*keys, "tbl", item.alias("item"))
    g = per_t.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tbl", "item"))).alias("i"))
    return g.select(*keys, F.concat(F.lit("{"), F.array_join(F.transform("i", lambda x: x["item"]), ","),
                                    F.lit("}")).alias("target"))
