"""Tool-call linking for chat data.

Calls are joined with their results by conversation and identifier, put in a topological order
of the identifiers they depend on, checked against the schema of their tool and serialised as
canonical JSON: keys sorted at every level, no spaces, one form per number, no needless escapes.

The level of a call is the longest chain of calls it depends on; ordering a conversation by
``level, turn, call_id`` puts every call after those it needs. Levels are found for all
conversations at once: in rounds that double the steps looked back where no call needs more than
one other, else one join a level, as in Kahn's algorithm. What is never placed lies on or behind
a cycle.

Scale: DataFrame functions only, JSON as variants. Rows stay one per call, so a conversation that
holds a third of them is spread like any others; the joins are plain equi-joins by hashed key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folianta.llm.tables import small
from folianta.storage import materialize

# Per tool: types of its arguments, those it cannot do without, whether others are allowed.
SCHEMAS = {
    "count": {"properties": {"text": "string", "unit": "string"}, "required": ["text", "unit"], "open": False},
    "open": {"properties": {"address": "string", "deep": "boolean"}, "required": ["address"], "open": True},
    "search": {
        "properties": {"exact": "boolean", "limit": "integer", "query": "string"},
        "required": ["limit", "query"],
        "open": False,
    },
}
# What the types of a schema are called when a variant's type is asked for.
TYPES = {
    "array": r"^ARRAY",
    "boolean": r"^BOOLEAN$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "null": r"^VOID$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)",
    "object": r"^OBJECT",
    "string": r"^STRING$",
}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_value(json: str) -> str:
    """SQL condition that column ``json`` is one JSON value and nothing else; false for null.

    ``try_parse_json`` ends with the first whole value. What may follow it inside an array is not
    what may follow it inside an object, but for white space.
    """
    listed = f"size(cast(try_parse_json(concat('[', {json}, ']')) as array<variant>))"
    keyed = f"size(cast(try_parse_json(concat('{{\"v\":', {json}, '}}')) as map<string, variant>))"
    return f"coalesce(try_parse_json({json}) IS NOT NULL AND {listed} = 1 AND {keyed} = 1, false)"


def argument_errors(tool: str, arguments: str, schemas: dict = SCHEMAS) -> Column:
    """Sorted array of what is wrong with JSON column ``arguments`` of the tool in ``tool``.

    ``json`` (not readable, with a repeated key, followed by more than white space, or null), ``object`` (something else),
    ``tool:NAME`` (without a schema), ``missing:KEY``, ``type:KEY``, ``unknown:KEY``.
    """
    parsed, keys = f"try_parse_json({arguments})", f"json_object_keys({arguments})"
    cases = []
    for name, schema in sorted(schemas.items()):
        known = "array(" + ", ".join(_literal(k) for k in sorted(schema["properties"])) + ")"
        required = "array(" + ", ".join(_literal(k) for k in sorted(schema["required"])) + ")"
        parts = [f"transform(array_except(cast({required} as array<string>), {keys}), k -> concat('missing:', k))"]
        for key, kind in sorted(schema["properties"].items()):
            path = _literal("$['" + key.replace("'", "\\'") + "']")
            found = f"schema_of_variant(try_variant_get({parsed}, {path}, 'variant'))"
            parts.append(
                f"if(array_contains({keys}, {_literal(key)}) AND NOT coalesce(regexp_like({found}, {_literal(TYPES[kind])}), false), "
                f"array({_literal('type:' + key)}), cast(array() as array<string>))"
            )
        if not schema["open"]:
            parts.append(f"transform(array_except({keys}, cast({known} as array<string>)), k -> concat('unknown:', k))")
        cases.append(f"WHEN {tool} = {_literal(name)} THEN array_sort(concat({', '.join(parts)}))")
    return F.expr(
        f"CASE WHEN NOT {one_value(arguments)} THEN array('json') WHEN {keys} IS NULL THEN array('object') "
        f"{' '.join(cases)} ELSE array(concat('tool:', coalesce({tool}, ''))) END"
    )


def _key(call_id: Column) -> Column:
    """Conversation and identifier as one text; null without an identifier."""
    return F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("\x01")), F.lit("\x00"), call_id)


def _chain_levels(known: DataFrame, edges: DataFrame) -> DataFrame:
    """Levels where no call needs more than one other: each round doubles the steps looked back."""
    ways = materialize(
        known.join(edges, "key", "left").select("key", F.col("need").alias("up"), F.col("need").isNotNull().cast("bigint").alias("level")),
        "call-ways",
    )
    for _ in range(ways.count().bit_length() + 1):
        if ways.filter("up IS NOT NULL").isEmpty():
            break
        above = ways.select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        ways = materialize(
            ways.join(above, "up", "left").select("key", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")),
            "call-ways",
        )
    return ways.filter("up IS NULL").select("key", F.col("level").cast("int").alias("level"))


def levels(calls: DataFrame) -> DataFrame:
    """``key, level`` of calls (``key``, array ``needs`` of keys); without those in cycles.

    Needs that no call has are left out.
    """
    known = calls.select("key")
    edges = materialize(
        calls.select("key", F.explode(F.array_distinct("needs")).alias("need"))
        .join(known.withColumnRenamed("key", "need"), "need", "left_semi"),
        "call-edges",
    )
    waiting = materialize(edges.groupBy("key").agg(F.count("*").alias("open")), "call-waiting")
    # needs stay in their conversation, so conversations of chains alone never wait for others
    conversation = F.substring_index("key", "\x00", 1).alias("of")
    branching = materialize(waiting.where("open > 1").select(conversation).distinct(), "branching-conversations")
    if branching.isEmpty():
        return _chain_levels(known, edges)
    branching = small(branching, 32)

    def part(rows: DataFrame, how: str) -> DataFrame:
        return rows.select(conversation, *rows.columns).join(branching, "of", how).drop("of")

    chains = _chain_levels(part(known, "left_anti"), part(edges, "left_anti"))
    return chains.unionAll(_branch_levels(*(part(rows, "left_semi") for rows in (known, edges, waiting))))


def _branch_levels(known: DataFrame, edges: DataFrame, waiting: DataFrame) -> DataFrame:
    """Levels by Kahn's rounds: a call is placed once all calls that it needs are."""
    edges, waiting = materialize(edges, "call-edges"), materialize(waiting, "call-waiting")
    placed = materialize(
        known.join(waiting, "key", "left_anti").select("key", F.lit(0).alias("level")), "call-level"
    )
    every, level = placed, 0
    while not waiting.isEmpty():
        level += 1
        met = edges.join(placed.select(F.col("key").alias("need")), "need").groupBy("key").agg(F.count("*").alias("met"))
        now = materialize(
            waiting.join(met, "key", "left").select("key", (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")),
            "call-waiting",
        )
        placed = now.where("open = 0").select("key", F.lit(level).alias("level"))
        if placed.isEmpty():
            break
        every, waiting = every.unionAll(placed), now.where("open > 0")
    return every


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """``conv_id, call_id, turn, tool, level, linked, errors, json``, one row per call.

    ``calls``: ``conv_id, call_id, turn, tool, arguments`` (JSON text) and ``depends_on`` (ids of
    the same conversation); ``results``: ``conv_id, call_id, turn, content``. ``errors`` are those
    of :func:`argument_errors` and ``depends:ID`` (no such call), ``repeated`` (an earlier call has
    the identifier), ``id`` (none) and ``cycle``; the last three have a null level and, but for
    the last, no result. Of results that repeat an identifier the earliest counts. A null
    conversation is one conversation; null arguments are not readable; other columns are
    ignored; without calls there are no rows.
    """
    order = F.struct("turn", "tool", "arguments")
    named = calls.select(
        "conv_id",
        "call_id",
        "turn",
        "tool",
        "arguments",
        _key(F.col("call_id")).alias("key"),
        F.transform(F.coalesce("depends_on", F.array().cast("array<string>")), _key).alias("needs"),
    )
    first = materialize(
        named.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min_by("needs", order).alias("needs"), F.min(order).alias("first"), F.count("*").alias("n")),
        "first-calls",
    )
    answers = (
        results.select(_key(F.col("call_id")).alias("key"), F.struct("turn", "content").alias("r"))
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("r").alias("result"))
    )
    missing = (
        first.select("key", F.explode(F.array_distinct("needs")).alias("need"))
        .join(first.select(F.col("key").alias("need")), "need", "left_anti")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(F.concat(F.lit("depends:"), F.element_at(F.split("need", "\x00", 2), 2)))).alias("lost"))
    )
    facts = (
        first.select("key", "first", "n")
        .join(levels(first), "key", "left")
        .join(answers, "key", "left")
        .join(missing, "key", "left")
    )
    # exact repetitions of the first call cannot be told from it, so they count as it
    joined = named.join(facts, "key", "left").withColumn("counts", F.col("first").eqNullSafe(order) & F.col("key").isNotNull())
    none = F.array().cast("array<string>")
    errors = F.array_sort(
        F.concat(
            argument_errors("tool", "arguments", schemas),
            F.when(F.col("key").isNull(), F.array(F.lit("id"))).otherwise(none),
            F.when(F.col("key").isNotNull() & ~F.col("counts"), F.array(F.lit("repeated"))).otherwise(none),
            F.when(F.col("counts") & F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(none),
            F.when(F.col("counts"), F.coalesce("lost", none)).otherwise(none),
        )
    )
    rows = joined.select(
        "conv_id",
        "call_id",
        "turn",
        "tool",
        F.when(F.col("counts"), F.col("level")).alias("level"),
        (F.col("counts") & F.col("result").isNotNull()).alias("linked"),
        errors.alias("errors"),
        F.when(F.col("counts"), F.col("result.content")).alias("content"),
        F.when(F.expr(one_value("arguments")), F.try_parse_json("arguments")).alias("arguments"),
    )
    record = F.struct("arguments", "errors", F.col("call_id").alias("id"), "level", F.col("content").alias("result"), "tool")
    return rows.withColumn("json", F.to_json(record, {"ignoreNullFields": "false"})).drop("content", "arguments")


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of ``conversations`` stand for.

    An assistant's turn is a call about its text, which depends on the assistant's turn two
    turns before; the user's next turn is its result. Some arguments break their schema.
    """
    text = F.substring(F.to_json(F.struct("text"), {"ignoreNullFields": "false"}), 9, 1 << 30)
    text = F.substring(text, F.lit(1), F.char_length(text) - 1)
    number = F.coalesce(F.col("conv_id"), F.lit(0)) + F.coalesce(F.col("turn"), F.lit(0))
    limit = F.when(number % 7 == 0, F.concat(F.lit('"'), number.cast("string"), F.lit('"'))).otherwise(number.cast("string"))
    arguments = (
        F.when(number % 3 == 0, F.concat(F.lit('{ "query": '), text, F.lit(', "limit" : '), limit, F.lit(', "exact": true }')))
        .when(number % 3 == 1, F.concat(F.lit('{"deep":false, "address":'), text, F.lit(', "again": null}')))
        .otherwise(F.concat(F.lit('{"unit": "words"'), F.when(number % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(', "text": '), text)), F.lit("}")))
    )
    calls = turns.where("role = 'assistant'").withColumn("whole", arguments).select(
        "conv_id",
        F.concat(F.lit("call-"), F.col("turn").cast("string")).alias("call_id"),
        "turn",
        F.element_at(F.array(F.lit("search"), F.lit("open"), F.lit("count")), (F.pmod(number, F.lit(3)) + 1).cast("int")).alias("tool"),
        F.when(number % 11 == 0, F.expr("substring(whole, 1, char_length(whole) - 1)")).otherwise(F.col("whole")).alias("arguments"),
        F.when(F.col("turn") >= 3, F.array(F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string")))).alias("depends_on"),
    )
    results = turns.where("role = 'user'").select(
        "conv_id", F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of all conversations, linked, ordered, checked and serialised."""
    found = link_calls(*calls_of_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return found.select(
        "conv_id",
        "call_id",
        "turn",
        "tool",
        "level",
        "linked",
        F.array_join("errors", ",").alias("errors"),
        F.sha2("json", 256).alias("json_sha256"),
    )


ORACLE = """
WITH RECURSIVE calls AS (
    SELECT conv_id, turn, 'call-' || turn AS call_id, ['search', 'open', 'count'][(conv_id + turn) % 3 + 1] AS tool,
           conv_id + turn AS n, CAST(to_json(text) AS VARCHAR) AS q
    FROM conversations WHERE role = 'assistant'
), depths AS (
    SELECT conv_id, turn, 0 AS level FROM calls c
    WHERE turn < 3 OR NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
    UNION ALL
    SELECT c.conv_id, c.turn, d.level + 1 FROM depths d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2 AND c.turn >= 3
), facts AS (
    SELECT c.*, d.level, r.conv_id IS NOT NULL AS linked, CAST(to_json(r.text) AS VARCHAR) AS answer,
           c.turn >= 3 AND p.conv_id IS NULL AS lost,
           c.n % 11 = 0 AS broken,
           CASE c.tool WHEN 'search' THEN '{"exact":true,"limit":' || CASE WHEN c.n % 7 = 0 THEN '"' || c.n || '"' ELSE CAST(c.n AS VARCHAR) END || ',"query":' || c.q || '}'
                WHEN 'open' THEN '{"address":' || c.q || ',"again":null,"deep":false}'
                ELSE '{' || CASE WHEN c.n % 5 = 0 THEN '' ELSE '"text":' || c.q || ',' END || '"unit":"words"}' END AS canonical
    FROM calls c JOIN depths d USING (conv_id, turn)
    LEFT JOIN conversations r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1 AND r.role = 'user'
    LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2
), errors AS (
    SELECT *, list_sort(list_filter([
        CASE WHEN lost THEN 'depends:call-' || (turn - 2) END,
        CASE WHEN broken THEN 'json' END,
        CASE WHEN NOT broken AND tool = 'search' AND n % 7 = 0 THEN 'type:limit' END,
        CASE WHEN NOT broken AND tool = 'count' AND n % 5 = 0 THEN 'missing:text' END], lambda e: e IS NOT NULL)) AS found
    FROM facts
)
SELECT conv_id, call_id, turn, tool, level, linked, array_to_string(found, ',') AS errors,
       sha256('{"arguments":' || CASE WHEN broken THEN 'null' ELSE canonical END
              || ',"errors":[' || array_to_string(list_transform(found, lambda e: '"' || e || '"'), ',')
              || '],"id":"' || call_id || '","level":' || level || ',"result":' || coalesce(answer, 'null')
              || ',"tool":"' || tool || '"}') AS json_sha256
FROM errors
"""

QUERIES = {"op9_tool_calls": op9_tool_calls}
ORACLES = {"op9_tool_calls": ORACLE}
