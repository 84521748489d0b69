"""Chat formatting: tool calls joined with their results by identifier, ordered, checked and written as canonical JSON.

``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (the call whose result it needs, or null).
``results``: conv_id, turn, call_id, content.
``messages``: conv_id, turn, role, content of the turns that are neither.

Defined results: an identifier used again in its conversation, or answered again, counts once, with its earliest turn (then the
smallest other values), and the call says so; a result without a call is an ``orphan`` row; a call without a result is
``unanswered``; a null conversation is a conversation of its own; a call without an id is one with the id ''; arguments that are
no JSON (or repeat a key, or hold a number beyond the range of doubles) stay text; calls in or behind a circle come last and say so.
Every message is a row of its own, repeated ones too; ``turns`` counts the rows that a row of the result stands for, so its sum is
the number of rows given. No rows, no result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import running, stored, table

#: tool -> field -> (type, required).
SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", True), "deep": ("object", False)},
    "summarize": {"query": ("string", True), "deep": ("object", False)},
    "translate": {"query": ("string", True), "limit": ("integer", False), "deep": ("object", True)},
}
# What Spark calls the JSON types; fixed values.
TYPES = {"string": "STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "object": "OBJECT<.*", "array": "ARRAY<.*"}


def outside_strings(json: Column, body: Callable[[Column], Column]) -> Column:
    """The pieces of a JSON text between its quotes: strings as they are, ``body`` of what stands outside of them.

    Escaped backslashes and quotes stand aside as control characters, which JSON may not hold as such, until the pieces are joined.
    """
    masked = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    return F.transform(F.split(masked, '"'), lambda piece, i: F.when(i % 2 == 0, body(piece)).otherwise(piece))


def parsed_json(text: Column) -> Column:
    """The text as VARIANT; null if it is no JSON, repeats a key or holds a number beyond the range of doubles."""
    beyond = lambda piece: F.exists(F.regexp_extract_all(piece, F.lit(r"[-+0-9.eE]+"), 0), lambda n: F.abs(n.try_cast("double")) == float("inf"))
    marks = outside_strings(text, lambda piece: F.when(beyond(piece), "beyond").otherwise(""))
    kept = F.exists(marks, lambda mark: mark == "beyond")
    # Only texts with an exponent or very many digits can be beyond.
    long = text.rlike(r"[0-9][eE][+]?[0-9]{3}|[0-9]{300}")
    return F.when(~F.coalesce(long & kept, F.lit(False)), F.try_parse_json(text))


def canonical_number(n: Column) -> Column:
    """One way to write each number: plain digits without needless zeros, an exponent only beyond 38 digits before or after the point."""
    mantissa, exponent = F.substring_index(n, "E", 1), F.coalesce(F.regexp_extract(n, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    sign = F.when(mantissa.startswith("-"), "-").otherwise("")
    whole, part = F.regexp_extract(mantissa, r"^-?([0-9]*)", 1), F.regexp_replace(F.regexp_extract(mantissa, r"\.([0-9]*)$", 1), "0+$", "")
    digits = F.concat(whole, part)
    point = F.length(whole) + exponent  # digits before the point
    after = F.rpad(F.regexp_replace(digits, "0+$", ""), F.greatest(point, F.length(digits)), "0")
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits), F.rpad(digits, point, "0"))
        .otherwise(F.concat(F.substring(after, F.lit(1), point), F.lit("."), F.substring(after, point + 1, F.length(after))))
    )
    cut = F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    cut = F.regexp_replace(cut, r"^0+(?=[0-9])", "")
    short = F.concat(whole, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)), F.lit("E"), exponent)
    number = F.when((point <= 38) & (F.length(digits) - point <= 38), cut).otherwise(short)
    return F.when(number == "0", number).otherwise(F.concat(sign, number))


def canonical_json(parsed: Column) -> Column:
    """A VARIANT as JSON: keys in order at every depth, no blanks, equal numbers written equally.

    Numbers with an exponent or of more than 38 digits are read as doubles, all others exactly.
    """
    number = lambda t: F.when(t.rlike("^-?[0-9]"), canonical_number(t)).otherwise(t)
    numbers = lambda piece: F.array_join(F.transform(F.regexp_extract_all(piece, F.lit(r"[-0-9.E]+|[^-0-9.E]+"), 0), number), "")
    text = F.array_join(outside_strings(F.to_json(parsed), lambda piece: F.when(piece.rlike("[.E]|-0"), numbers(piece)).otherwise(piece)), '"')
    return F.replace(F.replace(text, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def schema_errors(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> Column:
    """What speaks against the arguments, in order of field; the schemas are compiled into one expression."""
    parsed = parsed_json(arguments)
    fields = F.coalesce(F.map_keys(F.from_json(arguments, "map<string,string>")), F.array().cast("array<string>"))

    def of(tool: str) -> Column:
        found = []
        for field, (kind, required) in sorted(schemas[tool].items()):
            kind_of = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            fits = kind_of.rlike(f"^({TYPES[kind]})$")
            if kind == "integer":  # 1e2 is one
                value = F.try_variant_get(parsed, f"$.{field}", "double")
                fits = fits | ((kind_of == "DOUBLE") & (value == F.rint(value)))
            wrong = F.when(~fits, F.lit(f"{field} is not {kind}"))
            found.append(F.when(F.array_contains(fields, field), wrong).otherwise(F.lit(f"{field} is missing") if required else F.lit(None)))
        others = F.array_sort(F.array_except(fields, F.array(*[F.lit(f) for f in sorted(schemas[tool])])))
        return F.concat(F.filter(F.array(*found), lambda e: e.isNotNull()), F.transform(others, lambda f: F.concat(f, F.lit(" is unknown"))))

    checked = F.array(F.lit("unknown tool"))
    for tool in sorted(schemas):
        checked = F.when(name == tool, of(tool)).otherwise(checked)
    no_object = parsed.isNull() | ~F.coalesce(F.schema_of_variant(parsed), F.lit("")).startswith("OBJECT")
    return F.when(no_object, F.array(F.lit("arguments are no object"))).otherwise(checked)


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth (calls before it in its chain; null in or behind a circle) and whether ``after`` is unknown.

    ``calls``: one row per (conv_id, call_id). Each round doubles the way every call has gone up its chain, so the rounds grow with
    the logarithm of the longest chain. No chain is longer than the calls that need another, counted once at the start.
    """
    known = calls.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"))
    same = lambda conv, call: F.col(conv).eqNullSafe(F.col("_conv")) & (F.col(call) == F.col("_call"))
    up = calls.join(known.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("after") == F.col("_call")), "left")
    way = up.select("conv_id", "call_id", F.col("_call").alias("up"), F.col("_call").isNotNull().cast("int").alias("depth"), (F.col("after").isNotNull() & F.col("_call").isNull()).alias("unknown"))
    way = stored(way, "chat-depth-0")
    left = needy = way.filter("up IS NOT NULL").count()
    reach, rounds = 1, 0
    while left and reach <= needy:  # a way longer than all calls that need another is a circle
        reach, rounds = reach * 2, rounds + 1
        step = way.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        way = way.join(step.hint("shuffle_hash"), same("conv_id", "up"), "left")
        way = way.select("conv_id", "call_id", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), "unknown")
        way = stored(way, f"chat-depth-{rounds}")
        left = way.filter("up IS NOT NULL").count()
    return way.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "unknown")


def link(calls: DataFrame, results: DataFrame, messages: DataFrame | None = None, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> DataFrame:
    """conv_id, call_id, position (from 0 in the conversation's order), status, errors, message and turns of each call, orphan and message.

    System messages come first, then the other messages, by turn. Calls follow in order of depth, then turn, then id; so a call
    follows the one whose result it needs. Orphans come last. Calls and results meet in hash joins by identifier, so a long
    conversation is spread over its identifiers.
    """
    calls = calls.withColumn("call_id", F.coalesce("call_id", F.lit("")))
    results = results.withColumn("call_id", F.coalesce("call_id", F.lit("")))
    first = calls.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("call"), F.count("*").alias("calls"))
    first = stored(first.select("conv_id", "call_id", "call.*", "calls"), "chat-calls")
    answers = results.groupBy("conv_id", "call_id").agg(F.min(F.struct(F.col("turn").alias("answered"), "content")).alias("answer"), F.count("*").alias("answers"))
    answers = stored(answers.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), "answer.*", "answers"), "chat-answers")
    way = depths(first).select(F.col("conv_id").alias("_way_conv"), F.col("call_id").alias("_way_call"), "depth", "unknown")

    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("call_id") == F.col("_call"))
    rows = first.join(answers.hint("shuffle_hash"), same, "left").join(way.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("_way_conv")) & (F.col("call_id") == F.col("_way_call")))
    flags = F.array(
        F.when(F.col("calls") > 1, "id is used again"), F.when(F.col("answers") > 1, "answered again"), F.when(F.col("answered") < F.col("turn"), "answered before the call"),
        F.when(F.col("unknown"), "needs an unknown call"), F.when(F.col("depth").isNull(), "needs itself"),
    )
    nothing = F.lit(None).cast("string")
    rows = rows.select(
        "conv_id", "call_id", "turn", F.coalesce("depth", F.lit(2**31 - 2)).alias("depth"),
        F.when(F.col("answers").isNull(), "unanswered").otherwise("linked").alias("status"),
        F.concat(F.filter(flags, lambda e: e.isNotNull()), schema_errors(F.col("name"), F.col("arguments"), schemas)).alias("errors"),
        "name", "arguments", "content", nothing.alias("tie"), (F.col("calls") + F.coalesce("answers", F.lit(0))).alias("turns"),
    )
    orphans = answers.join(first.hint("shuffle_hash"), same, "left_anti")
    orphans = orphans.select(
        F.col("_conv").alias("conv_id"), F.col("_call").alias("call_id"), F.col("answered").alias("turn"), F.lit(2**31 - 1).alias("depth"), F.lit("orphan").alias("status"),
        F.array().cast("array<string>").alias("errors"), nothing.alias("name"), nothing.alias("arguments"), "content", nothing.alias("tie"), F.col("answers").alias("turns"),
    )
    rows = rows.union(orphans)
    if messages is not None:
        rows = rows.union(messages.select(
            "conv_id", nothing.alias("call_id"), "turn", F.when(F.col("role") == "system", -2).otherwise(-1).alias("depth"), F.lit("message").alias("status"),
            F.array().cast("array<string>").alias("errors"), F.col("role").alias("name"), nothing.alias("arguments"), "content",
            F.md5(F.coalesce("content", F.lit("")).cast("binary")).alias("tie"), F.lit(1).cast("long").alias("turns"),
        ))
    placed = running(rows.withColumn("_one", F.lit(1)), ["conv_id", "depth", "turn", "call_id", "name", "tie"], {"_nth": "_one"}, "chat-order")
    placed = stored(placed, "chat-placed")
    starts = placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_nth").alias("_first"))
    placed = placed.join(starts.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    return placed.select("conv_id", "call_id", (F.col("_nth") - F.col("_first")).alias("position"), "status", F.array_join("errors", "; ").alias("errors"), message().alias("message"), "turns")


def as_json(text: str) -> Column:
    """A text column as a JSON string, null as null: what stands between the brackets of an array of it."""
    listed = F.to_json(F.array(F.col(text)))
    return F.when(F.col(text).isNull(), F.lit("null")).otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def message() -> Column:
    """Canonical JSON of a row: keys in order at every depth, no blanks, equal numbers written equally."""
    parsed = parsed_json(F.col("arguments"))
    arguments = F.when(parsed.isNull(), as_json("arguments")).otherwise(canonical_json(parsed))

    def of(**fields: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]), F.lit("}"))

    call = of(arguments=arguments, id=as_json("call_id"), name=as_json("name"), result=as_json("content"))
    return F.when(F.col("status") == "message", of(content=as_json("content"), role=as_json("name"))).otherwise(call)


def tool_log(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls and results that the turns of a conversation stand for, and the messages that are neither.

    An assistant's turn calls a tool with its text as query; the user's next turn is the result. Every third call by length
    needs the call two turns before. Some lengths stand for wrong types, missing fields and an unknown tool.
    System turns, user turns at turn 0 or without a turn, and rows with another or no role are messages.
    """
    n = F.coalesce(F.length("text"), F.lit(0))
    # to_json writes a map with one text; its value is the text as JSON.
    query = F.regexp_replace(F.to_json(F.create_map(F.lit("query"), F.coalesce("text", F.lit("")))), r"\}$", "")
    limit = F.when(n % 11 == 0, F.concat(F.lit('"'), n % 50, F.lit('"'))).otherwise((n % 50).cast("string"))
    deep = F.when(n % 13 == 0, F.lit("")).otherwise(F.lit(', "deep" : {"b": true, "a": null}'))
    calls = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("call_"), "turn").alias("call_id"),
        F.array(*[F.lit(t) for t in ("search", "translate", "summarize", "plan")])[n % 4].alias("name"),
        F.concat(query, F.lit(', "limit": '), limit, deep, F.lit(" }")).alias("arguments"),
        F.when(n % 3 == 0, F.concat(F.lit("call_"), F.col("turn") - 2)).alias("after"),
    )
    results = conversations.filter("role = 'user' AND turn > 0").select("conv_id", "turn", F.concat(F.lit("call_"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    neither = ~F.coalesce((F.col("role") == "assistant") | ((F.col("role") == "user") & (F.col("turn") > 0)), F.lit(False))
    return calls, results, conversations.filter(neither).select("conv_id", "turn", "role", F.col("text").alias("content"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(*tool_log(table(spark, sf_dir, "conversations")))
