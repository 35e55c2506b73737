"""Chat formatting with tool-call linking, in DataFrame operations only.

Input messages hold ``conv_id, turn, role, text``, the calls a message makes
(``calls``: array of struct id, name, arguments (JSON text), needs (ids of the
calls whose results it uses)) and, for results, ``result_of`` (a call's id).

* Linking: calls and results meet in a hash join on (conversation, call id). A
  result without its call and a call without its result are told apart.
* Order: every call has a level: 1 where it needs no call of its conversation,
  else one more than the highest of its needs. Calls lie in blocks of
  consecutive positions (about ``SPAN`` calls, whatever a conversation's
  length); a block is levelled at once by sweeps up and down its positions until
  a sweep settles none. Conversations of one block are ready then. The blocks of
  longer ones hand their levels on in rounds (their table is stored each round)
  until a round settles none, so rounds go with the blocks on a path, not with
  its calls. What is left lies on or behind a cycle: its level is null. Needs
  that name no call of the conversation do not hold a call back.
* Validation: arguments must be a JSON object; each is joined with the tool's
  parameters (known name, type, required ones present). Text that Spark reads
  no value from is no object and stands in the line as a JSON string: broken
  JSON, an object that repeats a key, values beyond a variant's size limit
  (arguments of some megabytes are read).
* Canonical JSON: keys sorted at every level, no white space, one line for each
  message and each call, so no conversation is gathered in one place.

Defined results: null text is an empty string in the JSON; messages with a null
conv_id come out and link with nothing, a null turn stands before all others;
rows that repeat a call id make one call each, their results link with each, and
they share one level, by the needs of all of them; empty input gives an empty
result. Columns besides those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hvault.llm.common import discard, store, stored

SPAN = 2048  # calls of a block, about; turns that it spans at most

#: Parameters of the derived tools: fixed values (tool, parameter, type, required).
TOOLS = (
    ("count_words", "min_length", "BIGINT", False),
    ("count_words", "text", "STRING", True),
    ("lookup", "exact", "BOOLEAN", False),
    ("lookup", "term", "STRING", True),
    ("translate", "target", "STRING", True),
    ("translate", "text", "STRING", True),
)
CALLS = "array<struct<id:string,name:string,arguments:string,needs:array<string>>>"


def tool_table(spark: SparkSession, tools=TOOLS) -> DataFrame:
    return spark.createDataFrame([tuple(t) for t in tools], "name string, param string, type string, required boolean")


def placed(calls: DataFrame) -> DataFrame:
    """(conv_id, block, position, call_id, needs): one row per call id, in blocks of about ``SPAN`` neighbours.

    ``SPAN`` turns are a block; more calls than that share it out by turns, the
    calls of one turn by items, and ids that repeat a position by a hash."""
    nodes = calls.groupBy("conv_id", "call_id").agg(F.min("position").alias("position"), F.array_distinct(F.flatten(F.collect_set("needs"))).alias("needs"))
    nodes = nodes.withColumns({"turn": F.coalesce("position.turn", F.lit(-1)).cast("long"), "part": F.expr(f"position.item div {SPAN}")})
    cells = nodes.groupBy("conv_id", "turn", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("range", F.expr(f"turn div {SPAN}"))
    around = F.sum("n").over(Window.partitionBy("conv_id", "range"))
    cells = cells.withColumn("width", F.least(F.lit(SPAN), F.greatest(F.lit(1), F.floor(F.lit(SPAN * SPAN) / around)))).withColumn("at", F.expr("turn div width"))
    inside = F.sum("n").over(Window.partitionBy("conv_id", "range", "at", "part"))
    cells = cells.withColumn("shares", F.ceil(inside / SPAN)).drop("n")
    block = F.concat_ws(":", "range", "at", "part", F.pmod(F.xxhash64("call_id"), "shares"))
    return nodes.join(cells, ["conv_id", "turn", "part"]).select("conv_id", block.alias("block"), "position", "call_id", "needs")


def named(value, use):
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sweep(steps, before):
    """Levels of a block's calls, in the order of ``steps``, one after the other; ``before``: levels known already (null: none)."""

    def level(known, step):
        at = lambda j: F.coalesce(F.get(known, j - 1), F.get(before, j - 1))
        most = F.aggregate(step["inner"], step["base"], lambda m, j: F.when(at(j).isNotNull(), F.when(m >= at(j), m).when(m < at(j), at(j))))
        return F.coalesce(F.get(before, F.size(known)), F.when(step["ready"], most + 1))

    return F.aggregate(steps, F.array().cast("array<bigint>"), lambda known, step: F.concat(known, F.array(level(known, step))))


def settled(nodes: DataFrame) -> DataFrame:
    """``placed`` calls with ``level``, as far as each block gives it.

    Beside the columns of ``placed``, ``nodes`` holds ``base`` (highest level of needs
    in other blocks, 0 without any), ``ready`` (all those have one) and ``level`` (known already, or null)."""
    item = F.struct("position", "call_id", "needs", "base", "ready", "level")
    blocks = nodes.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(item)).alias("items"))
    n = F.size("items")
    inner = lambda x: F.filter(F.transform(x["needs"], lambda k: F.array_position("items.call_id", k)), lambda j: j > 0)
    blocks = blocks.withColumn("up", F.transform("items", lambda x: F.struct(inner(x).alias("inner"), x["base"].alias("base"), x["ready"].alias("ready"))))
    turned = lambda x: F.struct(F.transform(x["inner"], lambda j: n + 1 - j).alias("inner"), x["base"].alias("base"), x["ready"].alias("ready"))
    blocks = blocks.withColumn("down", F.transform(F.reverse("up"), turned))
    count = lambda levels: F.size(F.filter(levels, lambda v: v.isNotNull()))

    def both_ways(state, _):
        judged = lambda v: F.struct(v.alias("levels"), ((count(v) > count(state["levels"])) & (count(v) < n)).alias("go"))
        upwards = sweep(F.col("up"), state["levels"])
        more = named(F.reverse(upwards), lambda v: named(F.reverse(sweep(F.col("down"), v)), judged))
        return F.when(state["go"], more).otherwise(state)

    start = F.struct(F.col("items.level").alias("levels"), F.lit(True).alias("go"))
    blocks = blocks.withColumn("levels", F.aggregate(F.sequence(F.lit(1), n), start, both_ways, lambda state: state["levels"]))
    each = blocks.select("conv_id", "block", F.inline(F.arrays_zip(F.col("items").alias("item"), F.col("levels").alias("found"))).alias("item", "found"))
    return each.select("conv_id", "block", "item.position", "item.call_id", "item.needs", F.col("found").alias("level"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, position, needs); null on or behind a cycle."""
    spark = calls.sparkSession
    nodes = stored(placed(calls), "placed").withColumns({"base": F.lit(0).cast("long"), "ready": F.lit(True), "level": F.lit(None).cast("long")})
    result = lambda df: df.select("conv_id", "call_id", F.col("level").cast("int").alias("level"))
    long = stored(nodes.select("conv_id", "block").distinct().groupBy("conv_id").count().where("count > 1").select("conv_id"), "long")
    if long.isEmpty():
        return result(settled(nodes))
    first = settled(nodes.join(long, "conv_id", "left_anti"))
    cur, path = store(nodes.join(long, "conv_id", "left_semi").drop("base", "ready"), "rounds")
    known = cur.select("conv_id", F.col("call_id").alias("need"), F.col("block").alias("at"))
    across = cur.select("conv_id", "call_id", "block", F.explode("needs").alias("need")).join(known, ["conv_id", "need"])
    across = stored(across.where("at <> block").select("conv_id", "call_id", "need"), "across")
    have = -1
    while True:
        met = across.join(cur.select("conv_id", F.col("call_id").alias("need"), "level"), ["conv_id", "need"])
        met = met.groupBy("conv_id", "call_id").agg(F.max("level").alias("base"), F.every(F.col("level").isNotNull()).alias("ready"))
        given = cur.join(met, ["conv_id", "call_id"], "left").withColumns({"base": F.coalesce("base", F.lit(0).cast("long")), "ready": F.coalesce("ready", F.lit(True))})
        nxt, nxt_path = store(settled(given), "rounds")
        discard(spark, path)
        cur, path = nxt, nxt_path
        total, now = cur.agg(F.count(F.lit(1)), F.count("level")).first()
        if now in (have, total):
            return result(first).unionByName(result(cur))
        have = now


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """(row, errors) of calls (row, name, arguments): sorted messages, empty when the arguments fit the tool's parameters.

    ``tools`` (name, param, type, required) is a catalogue of the caller's; the joins leave its size to Spark."""
    parsed = calls.select("row", "name", F.try_parse_json("arguments").alias("args"))
    parsed = parsed.withColumn("is_object", F.coalesce(F.schema_of_variant("args").startswith("OBJECT"), F.lit(False)))
    names = tools.select("name").distinct().withColumn("is_tool", F.lit(True))
    whole = parsed.join(names, "name", "left")
    basic = whole.select(
        "row", F.explode(F.filter(F.array(F.when(F.col("is_tool").isNull(), F.lit("unknown tool")), F.when(~F.col("is_object"), F.lit("arguments are no object"))), lambda x: x.isNotNull())).alias("error")
    )
    fit = whole.where("is_object AND is_tool")
    each = calls.sparkSession.tvf.variant_explode(F.col("args").outer())
    keys = fit.select("row", "name", "args").lateralJoin(each).select("row", "name", F.col("key").alias("param"), F.schema_of_variant("value").alias("found"))
    met = keys.join(tools.select("name", "param", "type"), ["name", "param"], "left")
    wrong = met.select(
        "row",
        F.when(F.col("type").isNull(), F.concat(F.lit("unknown argument "), "param")).when(
            F.col("found") != F.col("type"), F.concat(F.lit("argument "), "param", F.lit(" is "), "found", F.lit(", not "), "type")
        ).alias("error"),
    ).where("error is not null")
    required = fit.select("row", "name").join(tools.where("required").select("name", "param"), "name")
    missing = required.join(keys.select("row", "param"), ["row", "param"], "left_anti").select("row", F.concat(F.lit("missing argument "), "param").alias("error"))
    errors = basic.unionByName(wrong).unionByName(missing).groupBy("row").agg(F.array_sort(F.collect_list("error")).alias("errors"))
    return calls.select("row").join(errors, "row", "left").select("row", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def canonical(arguments):
    """JSON text with sorted keys and no white space; text that is no JSON as a JSON string."""
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), quoted(arguments))


def quoted(text):
    """A string as JSON text."""
    one = F.to_json(F.array(F.coalesce(text, F.lit(""))))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def format_chats(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """One row per message and call: conv_id, turn, item (-1: the message), kind, call_id, linked, level, valid, errors, json."""
    messages = stored(messages.select("conv_id", "turn", "role", "text", "calls", "result_of"), "messages")
    calls = messages.select("conv_id", "turn", F.posexplode("calls").alias("item", "call")).select(
        "conv_id", "turn", "item", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"),
        F.coalesce("call.needs", F.array().cast("array<string>")).alias("needs"),
    )
    calls = stored(calls.withColumn("row", F.monotonically_increasing_id()).withColumn("position", F.struct("turn", "item")), "calls")
    results = messages.where("result_of is not null").groupBy("conv_id", F.col("result_of").alias("call_id")).agg(F.count(F.lit(1)).alias("results"))
    of_calls = calls.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("n_calls"))
    level = levels(calls.where("call_id is not null"))
    lines = (
        calls.join(results, ["conv_id", "call_id"], "left")
        .join(level, ["conv_id", "call_id"], "left")
        .join(validated(calls, tools), "row")
        .select(
            "conv_id", "turn", "item", F.lit("call").alias("kind"), "call_id", F.col("results").isNotNull().alias("linked"), "level",
            (F.size("errors") == 0).alias("valid"), F.array_join("errors", "; ").alias("errors"),
            F.concat(
                F.lit('{"arguments":'), canonical(F.col("arguments")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")),
                F.lit(',"needs":'), F.to_json(F.array_sort("needs")), F.lit(',"type":"call"}'),
            ).alias("json"),
        )
    )
    plain = messages.withColumn("call_id", F.col("result_of")).join(of_calls, ["conv_id", "call_id"], "left").select(
        "conv_id", "turn", F.lit(-1).alias("item"), F.when(F.col("result_of").isNull(), "message").otherwise("result").alias("kind"), "call_id",
        F.when(F.col("result_of").isNotNull(), F.col("n_calls").isNotNull()).alias("linked"), F.lit(None).cast("int").alias("level"),
        F.lit(True).alias("valid"), F.lit("").alias("errors"),
        F.concat(
            F.lit('{"content":'), quoted(F.col("text")), F.lit(',"role":'), quoted(F.col("role")),
            F.when(F.col("result_of").isNull(), F.lit("")).otherwise(F.concat(F.lit(',"tool_call_id":'), quoted(F.col("result_of")))), F.lit(',"type":"message"}'),
        ).alias("json"),
    )
    return plain.unionByName(lines)


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls derived from plain turns.

    A user turn calls a tool (by conv_id + turn modulo 3) on its text; the next
    turn, if an assistant's, is its result. By conv_id modulo 7 a call needs
    the call two turns before it (0, 5, 6), a later one (1), calls on both
    sides, which makes cycles (2), the two calls before it (4), or shares its id
    with the call before or after it (3). Some calls are wrong on purpose:
    arguments by the number of words in the turn, broken JSON (5), an unknown tool (6).
    """
    n = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    turn, kind, four = F.col("turn"), F.pmod("conv_id", F.lit(7)), F.pmod("turn", F.lit(4))
    which = F.pmod(F.col("conv_id") + turn, F.lit(3))
    name = lambda t: F.concat(F.lit("c"), t.cast("string"))
    text = F.coalesce("text", F.lit(""))
    arguments = (
        F.when((kind == 5) & (turn % 6 == 0), F.lit('{"term":'))
        .when(which == 0, F.to_json(F.struct(text.alias("text"), F.when(n % 7 == 0, F.lit("4")).alias("min_length"))))
        .when(which == 1, F.to_json(F.struct(F.when(n % 5 != 0, F.substring_index(text, " ", 1)).alias("term"), (n % 2 == 0).alias("exact"))))
        .otherwise(F.to_json(F.struct(text.alias("text"), F.lit("en").alias("target"), F.when(n % 11 == 0, n).alias("limit"))))
    )
    tool = F.when((kind == 6) & (turn % 8 == 0), "search").when(which == 0, "count_words").when(which == 1, "lookup").otherwise("translate")
    wanted = (
        F.when((kind == 1) & (four == 0), F.array(turn + 2))
        .when(kind == 1, F.array(turn - 4))
        .when((kind == 2) & (four == 0), F.array(turn - 2, turn + 2))
        .when(kind == 3, F.array(turn - four - 4))
        .when(kind == 4, F.array(turn - 4, turn - 2))
        .otherwise(F.array(turn - 2))
    )
    call_id = name(F.when(kind == 3, turn - four).otherwise(turn))
    needs = F.transform(F.filter(wanted, lambda t: t >= 0), name)
    call = F.struct(call_id.alias("id"), tool.alias("name"), arguments.alias("arguments"), needs.alias("needs"))
    return conversations.select(
        "conv_id", "turn", "role", "text",
        F.when((F.col("role") == "user") & F.col("turn").isNotNull(), F.array(call)).otherwise(F.array().cast(CALLS)).alias("calls"),
        F.when((F.col("role") == "assistant") & (F.col("turn") > 0), name(F.col("turn") - 1)).alias("result_of"),
    )


def chat_lines(conversations: DataFrame) -> DataFrame:
    """The registered query: conversations with derived calls, formatted."""
    return format_chats(derived_messages(conversations), tool_table(conversations.sparkSession))


#: DuckDB: one row per message and derived call. A walk along needs that has more calls than its conversation goes round a cycle.
CHAT_SQL = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, len(string_split(coalesce(text, ''), ' ')) AS n, (conv_id + turn) % 3 AS which, conv_id % 7 AS kind,
    role = 'user' AND turn IS NOT NULL AS calls, CASE WHEN role = 'assistant' AND turn > 0 THEN 'c' || (turn - 1) END AS result_of
  FROM conversations
), c AS (
  SELECT *, 'c' || CASE WHEN kind = 3 THEN turn - turn % 4 ELSE turn END AS call_id,
    ['c' || t FOR t IN CASE WHEN kind = 1 THEN [CASE WHEN turn % 4 = 0 THEN turn + 2 ELSE turn - 4 END]
      WHEN kind = 2 AND turn % 4 = 0 THEN [turn - 2, turn + 2] WHEN kind = 3 THEN [turn - turn % 4 - 4] WHEN kind = 4 THEN [turn - 4, turn - 2]
      ELSE [turn - 2] END IF t >= 0] AS needs
  FROM m WHERE calls
), node AS (SELECT DISTINCT conv_id, call_id FROM c),
edge AS (
  SELECT DISTINCT e.conv_id, e.call_id, e.need FROM (SELECT conv_id, call_id, unnest(needs) AS need FROM c) AS e
  JOIN node ON node.conv_id = e.conv_id AND node.call_id = e.need
), extent AS (SELECT conv_id, count(*) AS calls FROM node GROUP BY conv_id),
walk AS (
  SELECT conv_id, call_id, 1 AS level FROM node WHERE conv_id IS NOT NULL
  UNION
  SELECT edge.conv_id, edge.call_id, walk.level + 1 FROM walk JOIN edge ON edge.conv_id = walk.conv_id AND edge.need = walk.call_id
  JOIN extent ON extent.conv_id = walk.conv_id WHERE walk.level <= extent.calls
), ranked AS (
  SELECT conv_id, call_id, CASE WHEN max(level) <= any_value(calls) THEN max(level) END AS level FROM walk JOIN extent USING (conv_id) GROUP BY conv_id, call_id
), lines AS (
  SELECT conv_id, turn, -1 AS item, CASE WHEN result_of IS NULL THEN 'message' ELSE 'result' END AS kind, result_of AS call_id,
    CASE WHEN result_of IS NOT NULL THEN EXISTS (SELECT 1 FROM c WHERE c.conv_id = m.conv_id AND c.call_id = m.result_of) END AS linked,
    CAST(NULL AS INT) AS level, true AS valid, '' AS errors,
    '{"content":' || to_json(text) || ',"role":' || to_json(role) || CASE WHEN result_of IS NULL THEN '' ELSE ',"tool_call_id":' || to_json(result_of) END || ',"type":"message"}' AS json
  FROM m
  UNION ALL
  SELECT conv_id, turn, 0, 'call', call_id, EXISTS (SELECT 1 FROM m WHERE m.conv_id = x.conv_id AND m.result_of = x.call_id), level, errors = '', errors,
    '{"arguments":' || arguments || ',"id":' || to_json(call_id) || ',"name":"' || name || '","needs":' || to_json(list_sort(needs)) || ',"type":"call"}'
  FROM (
    SELECT c.*, ranked.level,
      CASE WHEN kind = 6 AND turn % 8 = 0 THEN 'search' WHEN which = 0 THEN 'count_words' WHEN which = 1 THEN 'lookup' ELSE 'translate' END AS name,
      CASE WHEN kind = 5 AND turn % 6 = 0 THEN 'arguments are no object' WHEN kind = 6 AND turn % 8 = 0 THEN 'unknown tool'
        WHEN which = 0 AND n % 7 = 0 THEN 'argument min_length is STRING, not BIGINT' WHEN which = 1 AND n % 5 = 0 THEN 'missing argument term'
        WHEN which = 2 AND n % 11 = 0 THEN 'unknown argument limit' ELSE '' END AS errors,
      CASE WHEN kind = 5 AND turn % 6 = 0 THEN to_json('{"term":')
        WHEN which = 0 THEN '{' || CASE WHEN n % 7 = 0 THEN '"min_length":"4",' ELSE '' END || '"text":' || to_json(text) || '}'
        WHEN which = 1 THEN '{"exact":' || CAST(n % 2 = 0 AS VARCHAR) || CASE WHEN n % 5 <> 0 THEN ',"term":' || to_json(split_part(text, ' ', 1)) ELSE '' END || '}'
        ELSE '{' || CASE WHEN n % 11 = 0 THEN '"limit":' || n || ',' ELSE '' END || '"target":"en","text":' || to_json(text) || '}' END AS arguments
    FROM c LEFT JOIN ranked ON ranked.conv_id = c.conv_id AND ranked.call_id = c.call_id
  ) AS x
)
SELECT * FROM lines
"""
