"""Chat formatting with tool-call linking.

Messages (conv_id, turn, role, text) become canonical JSON records. A text that is a JSON object of one of these forms is read as such:

    system     {"tools": [{"name": "f", "parameters": {"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"]}}]}
    assistant  {"tool_calls": [{"id": "1", "name": "f", "arguments": {"x": 1}}], "content": "..."}
               or, of a call, {"id": "1", "type": "function", "function": {"name": "f", "arguments": "{\\"x\\": 1}"}}
    tool       {"tool_call_id": "1", "content": "..."}

anything else is plain content. Calls and results meet in a hash join on (conversation, identifier). Calls are put in topological
order: a call whose arguments name another call of the conversation as "${id}" stands on a higher level than that,
and a result right after its call or in its own turn, whichever is later. Arguments are validated against the tool's schema at
every depth: type (one or several; a number without a fraction is an integer, of any size), enum, const, required, properties, additionalProperties, items (each a schema
or true or false), minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf (as doubles), minLength, maxLength (code points), minItems, maxItems, minProperties,
maxProperties. Other keywords that can refuse a value (UNSUPPORTED) are not judged, and said to be so. Each record's JSON is canonical: keys sorted at every depth, no white space, one spelling of escapes, and of numbers that of
JavaScript (100 for 1e2 and 100.0; whole numbers written without fraction or exponent keep all their digits), so equal records are equal
texts. What a call or an assistant's message with calls holds besides is kept under "extra".

Output: a row for each message, call and result: conv_id, turn (where it stands), level, part (its place among a turn's calls), kind (message,
call, result), role, status, json. Ascending (turn, kind, level, part) is the conversation's order; rows, not whole conversations, are the unit, so
a conversation of any length needs no task of its own.

status of a call: ok, no_result, duplicate (its id was used before: only the first call is linked), cycle; then ":" and the
schema's complaints, sorted, where there are any (unknown_tool, missing x, type x, enum x, unexpected x, unsupported k x, and k x for another
keyword k; x is a path as a.b[0], $ for the arguments themselves). Of a result: ok, orphan (no call of
that id), duplicate (only the first result is linked). Of a message: ok.

DataFrame operations only. Defined cases: null or empty text is empty content; null conv_id is a conversation and null turns come first;
null roles are kept and null; rows that agree in conv_id, turn, role and text are repeats and count once; several schemas of one name in
a conversation: the first counts; calls without id are never linked (no_result); other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import settle

TOOL = "struct<name:string,parameters:variant>"
#: What JSON types a schema's types admit, as Spark names a value's kind.
KINDS = {"string": "STRING", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*", "null": "VOID"}
#: Keywords of schemas that may refuse a value and are not judged here.
UNSUPPORTED = (
    "$ref", "$dynamicRef", "allOf", "anyOf", "oneOf", "not", "if", "pattern", "patternProperties", "propertyNames", "contains", "prefixItems", "additionalItems",
    "uniqueItems", "dependentRequired", "dependentSchemas", "dependencies", "unevaluatedItems", "unevaluatedProperties",
)
#: A string (its quotes and escapes skipped), a number, or what lies between; each possessive, so none is tried twice.
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+\-]*+|[^"0-9\-]++|-'


def _let(x: Column, f) -> Column:
    """f(x) with x worked out once."""
    return F.get(F.transform(F.array(x), f), 0)


def _number(t: Column) -> Column:
    """A JSON number as JavaScript writes it."""
    value = F.abs(t.try_cast("double"))
    # the fewest of 15, 16, 17 digits that read back as the same number
    shown = F.coalesce(*(F.when(F.format_string(f"%.{n}e", value).try_cast("double") == value, F.format_string(f"%.{n}e", value)) for n in (14, 15)), F.format_string("%.16e", value))

    def write(x: Column) -> Column:
        digits, point, sign = x["digits"], x["point"], F.when(F.startswith(t, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        n = F.length(digits)
        tail = F.when(n > 1, F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.lit("."), F.substr(digits, F.lit(2)))).otherwise(digits)
        power = F.concat(F.when(point > 0, F.lit("e+")).otherwise(F.lit("e-")), F.abs(point - 1).cast("string"))
        plain = F.when((n <= point) & (point <= 21), F.concat(digits, F.repeat(F.lit("0"), point - n)))
        plain = plain.when((point > 0) & (point <= 21), F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
        plain = plain.when((point > -6) & (point <= 0), F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        return F.when(n == 0, F.lit("0")).otherwise(F.concat(sign, plain.otherwise(F.concat(tail, power))))

    def parts(x: Column) -> Column:
        whole, rest = F.regexp_extract(x, r"^([0-9]+)\.", 1), F.regexp_extract(x, r"\.([0-9]+)", 1)
        power = F.coalesce(F.nullif(F.regexp_extract(x, r"e([+-][0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
        every = F.concat(whole, rest)
        return F.struct(F.regexp_replace(every, "^0+|0+$", "").alias("digits"), (F.length(whole) + power - F.length(F.regexp_extract(every, "^(0*)", 1))).alias("point"))

    written = _let(_let(shown, parts), write)
    return F.when(t == "-0", F.lit("0")).when(t.rlike("^-?[0-9]+$"), t).when(value.isNull() | (value == float("inf")), t).otherwise(written)


def canonical(json: Column) -> Column:
    """JSON text, as to_json() writes it, with one spelling of numbers."""
    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(TOKEN), F.lit(0)), lambda t: F.when(t.rlike("^-?[0-9]"), _number(t)).otherwise(t)), "")


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _besides(v: Column, *names: str) -> Column:
    """The other keys of an object, as JSON; null if there are none."""
    rest = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: ~k.isin(*names))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def _conv(*names: str) -> list[Column]:
    """Join keys that let null conversations meet."""
    return [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_c"), F.col("conv_id").isNull().alias("_z"), *map(F.col, names)]


def parsed(messages: DataFrame) -> DataFrame:
    """The messages with `v`, the JSON object that the text is, if it is one."""
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    looks = F.col("text").rlike(r'^\s*\{') & (F.contains(F.col("text"), F.lit('"tools"')) | F.contains(F.col("text"), F.lit('"tool_call')))
    return m.withColumn("v", F.when(looks, F.try_parse_json("text")))


def call_rows(m: DataFrame) -> DataFrame:
    """conv_id, turn, at, id, name, args and extra (JSON) of every call; `first`: whether its id is new; `key`: the call's own."""
    calls = m.where("role = 'assistant' and v is not null").select("conv_id", "turn", "text", F.posexplode_outer(F.try_variant_get("v", "$.tool_calls", "array<variant>")).alias("at", "c")).where("c is not null")
    of = lambda path, kind: F.try_variant_get("c", path, kind)
    given = F.coalesce(of("$.arguments", "variant"), of("$.function.arguments", "variant"))
    read = F.try_parse_json(F.when(_kind(given) == "STRING", F.try_variant_get(given, "$", "string")))  # arguments written as a text
    args = F.when(_kind(read).startswith("OBJECT"), F.to_json(read)).when(given.isNotNull(), F.to_json(given))
    calls = calls.select("conv_id", "turn", "text", "at", of("$.id", "string").alias("id"), F.coalesce(of("$.name", "string"), of("$.function.name", "string")).alias("name"), canonical(args).alias("args"), _besides(F.col("c"), "id", "name", "arguments", "function", "type").alias("extra"))
    calls = calls.withColumn("key", F.xxhash64("conv_id", "turn", "text", "at"))
    # calls without id are alone: no window gathers them
    place = F.row_number().over(Window.partitionBy("conv_id", "id", F.when(F.col("id").isNull(), F.col("key"))).orderBy(F.col("turn").asc_nulls_first(), "at", "text"))
    return calls.withColumn("first", F.col("id").isNotNull() & (place == 1))


def result_rows(m: DataFrame) -> DataFrame:
    r = m.where("role = 'tool' and v is not null").select("conv_id", F.col("turn").alias("r_turn"), "text", F.try_variant_get("v", "$.tool_call_id", "string").alias("id"), F.try_variant_get("v", "$.content", "variant").alias("content"))
    place = F.row_number().over(Window.partitionBy("conv_id", "id").orderBy(F.col("r_turn").asc_nulls_first(), "text"))
    return r.where("id is not null").withColumn("first_r", place == 1)


def complaints(m: DataFrame, calls: DataFrame) -> DataFrame:
    """key and complaints (sorted, comma-joined) of the calls whose arguments break their schema.

    Values meet their schemas depth by depth: each pass judges the values of one depth and hands on their parts that have a schema, so
    there are as many passes as schemas are deep, and none without calls.
    """
    tools = m.where("role = 'system' and v is not null").select("conv_id", "turn", "text", F.posexplode_outer(F.try_variant_get("v", "$.tools", f"array<{TOOL}>")).alias("at", "t")).where("t.name is not null")
    place = F.row_number().over(Window.partitionBy("conv_id", "t.name").orderBy(F.col("turn").asc_nulls_first(), "text", "at"))
    tools = tools.withColumn("place", place).where("place = 1").select("conv_id", F.col("t.name").alias("name"), F.coalesce(F.to_json("t.parameters"), F.lit("{}")).alias("schema"))
    c = calls.select("key", *_conv("name"), F.coalesce("args", F.lit("{}")).alias("value")).join(tools.select(*_conv("name"), "schema"), ["_c", "_z", "name"], "left")
    now = settle(c.select("key", F.lit("").alias("path"), "value", "schema"))
    said = now.where("schema is null").select("key", F.lit("unknown_tool").alias("complaint"))
    now = now.where("schema is not null")
    while not now.isEmpty():
        judged = settle(_judged(now))
        said = said.unionAll(judged.select("key", F.explode("complaints").alias("complaint")))
        now = settle(judged.select("key", F.explode("parts").alias("p")).select("key", "p.*"))
    return said.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("complaint")), ",").alias("complaints"))


def _judged(now: DataFrame) -> DataFrame:
    """key, complaints, parts (path, value, schema) of values (key, path, value, schema; JSON)."""
    now = now.select("key", "path", F.try_parse_json("value").alias("v"), F.try_parse_json("schema").alias("s"))
    of = lambda path, kind: F.try_variant_get("s", path, kind)
    own = of("$.type", "variant")
    types = F.when(_kind(own).startswith("ARRAY"), of("$.type", "array<string>")).when(_kind(own) == "STRING", F.array(of("$.type", "string")))
    now = now.select("key", "path", "v", _kind(F.col("v")).alias("kind"), types.alias("types"), of("$.enum", "array<variant>").alias("enum"), of("$.required", "array<string>").alias("required"),
                     of("$.properties", "map<string,variant>").alias("props"), of("$.additionalProperties", "variant").alias("more"), of("$.items", "variant").alias("items"), of("$", "map<string,variant>").alias("keys"))
    is_object, is_array = F.col("kind").startswith("OBJECT"), F.col("kind").startswith("ARRAY")
    number = F.try_variant_get("v", "$", "double")
    whole = F.col("kind").rlike(r"^(?:BIGINT|DECIMAL\(\d+,0\))$") | (F.col("kind").rlike(f"^(?:{KINDS['number']})$") & (number == F.floor(number)))
    admits = F.create_map(*(x for k, p in KINDS.items() for x in (F.lit(k), F.lit(f"^(?:{p})$"))))
    fits = F.exists("types", lambda t: F.coalesce(F.when(t == "integer", whole).otherwise(F.rlike(F.col("kind"), F.try_element_at(admits, t))), F.lit(True)))
    name = F.when(F.col("path") == "", F.lit("$")).otherwise(F.col("path"))
    below = lambda k: F.concat(F.col("path"), F.when(F.col("path") == "", F.lit("")).otherwise(F.lit(".")), k)
    given = F.coalesce(F.when(is_object, F.try_variant_get("v", "$", "map<string,variant>")), F.create_map().cast("map<string,variant>"))
    elements = F.coalesce(F.when(is_array, F.try_variant_get("v", "$", "array<variant>")), F.array().cast("array<variant>"))
    now = now.withColumns({"given": given, "elements": elements, "props": F.coalesce("props", F.create_map().cast("map<string,variant>"))})
    same = F.exists("enum", lambda e: canonical(F.to_json(e)) == canonical(F.to_json("v")))
    unknown = F.filter(F.map_entries("given"), lambda e: ~F.map_contains_key("props", e["key"]))
    refuses = lambda x: F.coalesce((_kind(x) == "BOOLEAN") & ~F.try_variant_get(x, "$", "boolean"), F.lit(False))
    closed = refuses(F.col("more"))
    refused = F.filter(F.map_entries("given"), lambda e: refuses(F.try_element_at("props", e["key"])))
    is_number = F.col("kind").rlike(f"^(?:{KINDS['number']})$")
    length = F.when(F.col("kind") == "STRING", F.length(F.try_variant_get("v", "$", "string"))).cast("double")
    items_n, given_n = F.when(is_array, F.size("elements")).cast("double"), F.when(is_object, F.size("given")).cast("double")
    value = F.when(is_number, number)
    asked = lambda k: F.try_variant_get(F.try_element_at("keys", F.lit(k)), "$", "double")
    broken = {
        "minimum": value < asked("minimum"), "maximum": value > asked("maximum"), "exclusiveMinimum": value <= asked("exclusiveMinimum"), "exclusiveMaximum": value >= asked("exclusiveMaximum"),
        "multipleOf": F.when(asked("multipleOf") > 0, value / asked("multipleOf") != F.rint(value / asked("multipleOf"))),
        "minLength": length < asked("minLength"), "maxLength": length > asked("maxLength"), "minItems": items_n < asked("minItems"), "maxItems": items_n > asked("maxItems"),
        "minProperties": given_n < asked("minProperties"), "maxProperties": given_n > asked("maxProperties"),
        "const": F.map_contains_key("keys", F.lit("const")) & (canonical(F.to_json(F.try_element_at("keys", F.lit("const")))) != canonical(F.to_json("v"))),
    }
    nothing = F.array().cast("array<string>")
    wrong = F.concat(
        F.when(F.coalesce(~fits, F.lit(False)), F.array(F.concat(F.lit("type "), name))).otherwise(nothing),
        F.when(F.coalesce(~same, F.lit(False)), F.array(F.concat(F.lit("enum "), name))).otherwise(nothing),
        F.when(is_object, F.transform(F.filter(F.coalesce("required", nothing), lambda k: ~F.map_contains_key("given", k)), lambda k: F.concat(F.lit("missing "), below(k)))).otherwise(nothing),
        F.when(closed, F.transform(unknown, lambda e: F.concat(F.lit("unexpected "), below(e["key"])))).otherwise(nothing),
        F.transform(refused, lambda e: F.concat(F.lit("unexpected "), below(e["key"]))),
        F.when(refuses(F.col("items")), F.transform("elements", lambda _, i: F.concat(F.lit("unexpected "), name, F.lit("["), i.cast("string"), F.lit("]")))).otherwise(nothing),
        F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.concat(F.lit(f"{k} "), name)) for k, c in broken.items())), lambda x: x.isNotNull()),
        F.transform(F.filter(F.map_keys(F.coalesce("keys", F.create_map().cast("map<string,variant>"))), lambda k: k.isin(*UNSUPPORTED)), lambda k: F.concat(F.lit("unsupported "), k, F.lit(" "), name)),
    )
    part = lambda path, v, s: F.struct(path.alias("path"), F.to_json(v).alias("value"), F.to_json(s).alias("schema"))
    is_schema = lambda s: _kind(s).startswith("OBJECT")
    known = F.filter(F.map_entries("given"), lambda e: is_schema(F.try_element_at("props", e["key"])))
    parts = F.concat(
        F.transform(known, lambda e: part(below(e["key"]), e["value"], F.try_element_at("props", e["key"]))),
        F.transform(F.when(is_schema(F.col("more")), unknown).otherwise(F.filter(unknown, lambda e: F.lit(False))), lambda e: part(below(e["key"]), e["value"], F.col("more"))),
        F.transform(F.when(is_schema(F.col("items")), F.col("elements")).otherwise(F.array().cast("array<variant>")), lambda v, i: part(F.concat(name, F.lit("["), i.cast("string"), F.lit("]")), v, F.col("items"))),
    )
    return now.select("key", wrong.alias("complaints"), parts.alias("parts"))


def levels(calls: DataFrame) -> DataFrame:
    """key, level: 0 for calls that name no other, else one more than the highest they name; null in or behind a cycle.

    Each pass settles what depends on settled calls only, so there are as many as the longest chain; a pass reads what was settled in the one
    before and the references still open, not what is done.
    """
    names = calls.where("first").select("key", "conv_id", "args", F.explode_outer(F.regexp_extract_all("args", F.lit(r"\$\{([^{}$]+)\}"), F.lit(1))).alias("ref")).where("ref is not null").distinct()
    ids = calls.where("first").select(*_conv(), F.col("id").alias("ref"), F.col("key").alias("on"))
    edges = settle(names.select("key", *_conv("ref")).join(ids, ["_c", "_z", "ref"]).select("key", "on").distinct())
    front = settle(calls.select("key").distinct().join(edges.select("key").distinct(), "key", "left_anti").withColumn("level", F.lit(0)))
    done, waiting, passes = front, edges.select("key", F.lit(0).alias("below")).limit(0), 0
    while not edges.isEmpty() and not front.isEmpty():
        met = edges.join(front.withColumnsRenamed({"key": "on", "level": "below"}), "on").select("key", "below")
        edges = settle(edges.join(front.select(F.col("key").alias("on")), "on", "left_anti"))
        heard = settle(waiting.unionAll(met).groupBy("key").agg(F.max("below").alias("below")))
        front = settle(heard.join(edges.select("key").distinct(), "key", "left_anti").select("key", (F.col("below") + 1).alias("level")))
        waiting = heard.join(edges.select("key").distinct(), "key", "left_semi")
        done, passes = done.unionAll(front), passes + 1
        if passes % 20 == 0:
            done = settle(done)
    return done


def formatted(messages: DataFrame) -> DataFrame:
    m = settle(parsed(messages).withColumn("has", F.col("v").isNotNull()).drop("v"))
    talk = m.withColumn("v", F.when(F.col("has"), F.try_parse_json("text")))
    calls = settle(call_rows(talk)).withColumns({"arguments": F.parse_json("args"), "extra": F.parse_json("extra")})
    calls = calls.join(levels(calls), "key", "left").join(complaints(talk, calls), "key", "left")
    results = result_rows(talk)

    linked = calls.where("first").select("key", "level", F.col("turn").alias("call_turn"), "name", *_conv("id"))
    answers = results.select("*", *_conv()).join(linked, ["_c", "_z", "id"], "left")
    got = answers.where("first_r and key is not null").select("key", F.lit(True).alias("answered"))
    calls = calls.join(got, "key", "left")
    state = F.when(~F.col("first") & F.col("id").isNotNull(), "duplicate").when(F.col("level").isNull(), "cycle").when(F.col("answered"), "ok").otherwise("no_result")
    status = F.concat_ws(":", state, "complaints")
    order = Window.partitionBy("conv_id", "turn", "text").orderBy(F.col("level").asc_nulls_last(), "at")
    call_json = F.to_json(F.struct("arguments", "extra", F.col("id").alias("id"), F.lit("call").alias("kind"), "name"))
    call_out = calls.select("conv_id", "turn", F.coalesce("level", F.lit(-1)).alias("level"), F.row_number().over(order).alias("part"), F.lit("call").alias("kind"), F.lit("assistant").alias("role"), status.alias("status"), canonical(call_json).alias("json"))

    answer = F.when(F.col("key").isNull(), "orphan").when(F.col("first_r"), "ok").otherwise("duplicate")
    result_json = F.to_json(F.struct("content", F.col("id").alias("id"), F.lit("result").alias("kind"), "name"))
    result_out = answers.select("conv_id", F.greatest("r_turn", "call_turn").alias("turn"), F.coalesce("level", F.lit(0)).alias("level"), F.lit(0).alias("part"), F.lit("result").alias("kind"), F.lit("tool").alias("role"), answer.alias("status"), canonical(result_json).alias("json"))

    is_result = (F.col("role") == "tool") & F.try_variant_get("v", "$.tool_call_id", "string").isNotNull()
    is_call = (F.col("role") == "assistant") & F.try_variant_get("v", "$.tool_calls", "array<variant>").isNotNull()
    plain = talk.where(~F.coalesce(is_result, F.lit(False)))
    extra, content = F.parse_json(_besides(F.col("v"), "tool_calls", "content", "role")), F.coalesce(F.try_variant_get("v", "$.content", "variant"), F.parse_json(F.lit('""')))
    calling = canonical(F.to_json(F.struct(content.alias("content"), extra.alias("extra"), F.lit("message").alias("kind"), "role")))
    told = canonical(F.to_json(F.struct(F.lit("message").alias("kind"), "role", F.col("v").alias("tools"))))
    said = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content"), F.lit("message").alias("kind"), "role"))
    body = F.when(is_call, calling).when((F.col("role") == "system") & F.col("has"), told).otherwise(said)
    message_out = plain.select("conv_id", "turn", F.lit(0).alias("level"), F.lit(0).alias("part"), F.lit("message").alias("kind"), "role", F.lit("ok").alias("status"), body.alias("json"))
    return message_out.unionAll(call_out).unionAll(result_out)


#: The same rows by DuckDB where no message is a tool's, a call's or a schema's, as in the tables here; see the tests for the rest.
SQL = """
SELECT conv_id, turn, 0 AS level, 0 AS part, 'message' AS kind, role, 'ok' AS status,
       '{"content":' || to_json(coalesce(text, '')) || ',"kind":"message"' || coalesce(',"role":' || to_json(role), '') || '}' AS json
FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
"""
