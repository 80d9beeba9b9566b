import json
from decimal import Decimal

import duckdb
import numpy as np

from brindle.llm import tool_calls as tc

TOOLS = json.dumps({"tools": [{"name": "f", "parameters": {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "string"}}, "required": ["x"], "additionalProperties": False}}, {"name": "g", "parameters": {"properties": {"n": {"type": "number"}, "l": {"type": "array"}}}}]})


def call(*calls, content=None):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments"), c)) for c in calls], **({"content": content} if content else {})})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


ROWS = [
    (1, 0, "system", TOOLS), (1, 1, "user", "hé \"there\"\n"),
    (1, 2, "assistant", call(("b", "f", {"y": "see ${a}", "x": 1}), ("a", "f", {"x": 2}), ("c", "g", {"n": 1.5, "l": [1, {"z": 1, "a": None}]}), content="doing")),
    (1, 3, "tool", result("a", {"z": 1, "a": [2]})), (1, 4, "tool", result("b", "fine")), (1, 5, "tool", result("b", "again")), (1, 6, "tool", result("zz", "?")),
    (1, 7, "assistant", call(("a", "f", {"x": 3}), ("d", "f", {"y": 1, "q": 2}), ("e", "h", {}))),
    (2, 0, "assistant", call(("p", "f", {"x": "${q}"}), ("q", "f", {"x": "${p}"}), ("r", "f", {"x": "${p}"}))),
    (2, 1, "tool", result("p", "x")), (3, 0, "tool", result("late", 1)), (3, 1, "assistant", call(("late", "f", {}))),
    (4, 0, "user", None), (4, 1, "user", ""), (None, 0, "user", "x"), (None, None, None, "y"), (4, 1, "user", ""),
    (5, 0, "assistant", '{"tool_calls": broken'), (5, 1, "tool", '{"other": "tool_call_id"}'), (5, 2, "user", call(("n", "f", {}))),
]


def test_linking(spark):
    df = spark.createDataFrame([(*r, 1, "s") for r in ROWS], "conv_id long, turn long, role string, text string, level int, status string")
    got = tc.formatted(df).collect()
    assert all(json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json for r in got)
    of = {(r.conv_id, json.loads(r.json)["id"], r.kind, r.status): r for r in got if r.kind != "message"}
    assert set(of) == {
        (1, "a", "call", "ok"), (1, "b", "call", "ok"), (1, "c", "call", "no_result"), (1, "a", "call", "duplicate"), (1, "d", "call", "no_result:missing x,type y,unexpected q"), (1, "e", "call", "no_result:unknown_tool"),
        (1, "a", "result", "ok"), (1, "b", "result", "ok"), (1, "b", "result", "duplicate"), (1, "zz", "result", "orphan"),
        (2, "p", "call", "cycle:unknown_tool"), (2, "q", "call", "cycle:unknown_tool"), (2, "r", "call", "cycle:unknown_tool"), (2, "p", "result", "ok"), (3, "late", "call", "ok:unknown_tool"), (3, "late", "result", "ok"),
    }
    assert of[1, "a", "call", "ok"].level == 0 and of[1, "b", "call", "ok"].level == 1
    assert [of[1, i, "call", s].part for i, s in (("a", "ok"), ("c", "no_result"), ("b", "ok"))] == [1, 2, 3]
    assert of[3, "late", "result", "ok"].turn == 1
    assert of[1, "a", "result", "ok"].json == '{"content":{"a":[2],"z":1},"id":"a","kind":"result","name":"f"}'
    assert of[1, "c", "call", "no_result"].json == '{"arguments":{"l":[1,{"a":null,"z":1}],"n":1.5},"id":"c","kind":"call","name":"g"}'
    plain = {(r.conv_id, r.turn, r.json) for r in got if r.kind == "message"}
    assert (1, 2, '{"content":"doing","kind":"message","role":"assistant"}') in plain and (None, None, '{"content":"y","kind":"message"}') in plain
    assert (4, 0, '{"content":"","kind":"message","role":"user"}') in plain and (5, 0, '{"content":"{\\"tool_calls\\": broken","kind":"message","role":"assistant"}') in plain
    assert len([r for r in got if r.kind == "message"]) == 13


def script(x):
    """A number as JavaScript writes it, from Python's shortest digits."""
    if isinstance(x, int):
        return str(x)
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    d, n = "".join(map(str, digits)), len(digits) + exponent
    if d == "0":
        return "0"
    if len(d) <= n <= 21:
        out = d + "0" * (n - len(d))
    elif 0 < n <= 21:
        out = d[:n] + "." + d[n:]
    elif -6 < n <= 0:
        out = "0." + "0" * -n + d
    else:
        out = (d[0] + "." * (len(d) > 1) + d[1:]) + f"e{'+' if n > 0 else '-'}{abs(n - 1)}"
    return "-" * sign + out


def test_one_spelling_of_numbers(spark):
    rng = np.random.default_rng(2)
    numbers = [0.0, -0.0, 1e2, 100.0, 1.5, -2.50, 1e21, 1e20, 123e-20, 1e-6, 1e-7, 12345678.25, 0.001, 5e-5, 12345678901234567890, 10**30, 7, -7, 0]
    numbers += [float(f"{rng.integers(-10**9, 10**9)}e{rng.integers(-30, 30)}") for _ in range(300)]
    text = '{"a": [' + ", ".join(map(repr, numbers)) + '], "s": "1e2 \\\\\\" 1.0", "t": "-", "u": "\\\\"}'
    got = spark.createDataFrame([(text,)], "t string").select(tc.canonical(tc.F.to_json(tc.F.parse_json("t")))).first()[0]
    inner = got[got.index("[") + 1 : got.index("]")].split(",")
    assert inner == [script(x) for x in numbers]
    assert got.endswith('],"s":"1e2 \\\\\\" 1.0","t":"-","u":"\\\\"}')
    long = json.dumps({"a": "\n\"" * 200_000})
    assert spark.createDataFrame([(long,)], "t string").select(tc.canonical(tc.F.col("t"))).first()[0] == long


def test_forms_and_other_keys(spark):
    rows = [
        (1, 0, "assistant", json.dumps({"tool_calls": [{"id": "t", "type": "function", "function": {"name": "f", "arguments": '{"x": 1e2}'}, "index": 0}, {"name": "g", "arguments": "not json"}, {"name": "g"}, 5], "content": [{"type": "text", "text": "hi"}], "refusal": None, "model": "m"})),
        (1, 1, "tool", json.dumps({"tool_call_id": "t", "content": 1.0})),
    ]
    got = {r.json for r in tc.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {
        '{"content":[{"text":"hi","type":"text"}],"extra":{"model":"m","refusal":null},"kind":"message","role":"assistant"}', '{"content":1,"id":"t","kind":"result","name":"f"}',
        '{"arguments":{"x":100},"extra":{"index":0},"id":"t","kind":"call","name":"f"}', '{"arguments":"not json","kind":"call","name":"g"}', '{"kind":"call","name":"g"}', '{"kind":"call"}',
    }


def judged(v, s, path=""):
    """The schema's complaints, by plain recursion."""
    name = path or "$"
    below = lambda k: f"{path}.{k}" if path else k
    num = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    of = {"string": lambda x: isinstance(x, str), "integer": lambda x: num(x) and x == int(x), "number": num, "boolean": lambda x: isinstance(x, bool), "array": lambda x: isinstance(x, list), "object": lambda x: isinstance(x, dict), "null": lambda x: x is None}
    out = set()
    types = s.get("type")
    types = [types] if isinstance(types, str) else types
    if types is not None and not any(of[t](v) for t in types):
        out.add(f"type {name}")
    if "enum" in s and not any(type(e) is type(v) and e == v or num(e) and num(v) and e == v for e in s["enum"]):
        out.add(f"enum {name}")
    if "const" in s and not (type(s["const"]) is type(v) and s["const"] == v or num(s["const"]) and num(v) and s["const"] == v):
        out.add(f"const {name}")
    n = len(v) if isinstance(v, (str, list, dict)) else v if num(v) else None
    for key, kind, bad in (
        ("minimum", num, lambda a, b: a < b), ("maximum", num, lambda a, b: a > b), ("exclusiveMinimum", num, lambda a, b: a <= b), ("exclusiveMaximum", num, lambda a, b: a >= b), ("multipleOf", num, lambda a, b: not (float(a) / b).is_integer()),
        ("minLength", of["string"], lambda a, b: a < b), ("maxLength", of["string"], lambda a, b: a > b), ("minItems", of["array"], lambda a, b: a < b), ("maxItems", of["array"], lambda a, b: a > b),
        ("minProperties", of["object"], lambda a, b: a < b), ("maxProperties", of["object"], lambda a, b: a > b),
    ):
        if key in s and kind(v) and bad(n, s[key]):
            out.add(f"{key} {name}")
    out |= {f"unsupported {k} {name}" for k in s if k in tc.UNSUPPORTED}
    if isinstance(v, dict):
        out |= {f"missing {below(k)}" for k in s.get("required", []) if k not in v}
        for k, x in v.items():
            if k in s.get("properties", {}):
                of_k = s["properties"][k]
                out |= {f"unexpected {below(k)}"} if of_k is False else set() if of_k is True else judged(x, of_k, below(k))
            elif s.get("additionalProperties") is False:
                out.add(f"unexpected {below(k)}")
            elif isinstance(s.get("additionalProperties"), dict):
                out |= judged(x, s["additionalProperties"], below(k))
    if isinstance(v, list) and "items" in s:
        for k, x in enumerate(v):
            out |= {f"unexpected {name}[{k}]"} if s["items"] is False else set() if s["items"] is True else judged(x, s["items"], f"{name}[{k}]")
    return out


def test_validation_against_brute_force(spark):
    rng = np.random.default_rng(4)
    pick = lambda x: x[int(rng.integers(len(x)))]

    def value(depth):
        kind = int(rng.integers(8 if depth else 6))
        if kind == 6:
            return [value(depth - 1) for _ in range(int(rng.integers(3)))]
        if kind == 7:
            return {k: value(depth - 1) for k in "abc" if rng.random() < 0.5}
        return [1, 2.5, 3.0, "xyz"[: 1 + int(rng.integers(3))], True, None][kind] if rng.random() < 0.9 else 12345678901234567890

    def schema(depth):
        s = {}
        if rng.random() < 0.8:
            s["type"] = pick(["string", "integer", "number", "boolean", "array", "object", "null", ["string", "null"], ["object", "integer"], ["array", "number"]])
        if rng.random() < 0.15:
            s["enum"] = [value(1) for _ in range(3)]
        if depth and rng.random() < 0.8:
            s["properties"] = {k: pick([True, False]) if rng.random() < 0.1 else schema(depth - 1) for k in "abc" if rng.random() < 0.6}
        if rng.random() < 0.3:
            s["required"] = [k for k in "abc" if rng.random() < 0.5]
        if rng.random() < 0.4:
            s["additionalProperties"] = pick([False, True, schema(depth - 1) if depth else False])
        if depth and rng.random() < 0.6:
            s["items"] = pick([True, False]) if rng.random() < 0.1 else schema(depth - 1)
        for key in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"):
            if rng.random() < 0.2:
                s[key] = pick([1, 2, 2.5, 3]) if key[:3] not in ("min", "max") or key in ("minimum", "maximum") else pick([0, 1, 2])
        if rng.random() < 0.06:
            s["const"] = value(1)
        if rng.random() < 0.06:
            s[pick(tc.UNSUPPORTED)] = pick([[], {}, True])
        return s

    rows, want = [], {}
    for k in range(180):
        s = schema(3) | ({"type": "object"} if rng.random() < 0.7 else {})
        args = {n: value(3) for n in "abc"}
        rows.append((k, 0, "system", json.dumps({"tools": [{"name": "f", "parameters": s}]})))
        rows.append((k, 1, "assistant", json.dumps({"tool_calls": [{"id": "1", "name": "f", "arguments": args}]})))
        want[k] = ":".join(["no_result", *filter(None, [",".join(sorted(judged(args, s)))])])
    got = {r.conv_id: r.status for r in tc.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("kind = 'call'").collect()}
    assert got == want and sum(":" in x for x in want.values()) > 50


def test_each_keyword(spark):
    one = {
        "const": ("b", {"const": "a"}), "minimum": (1, {"minimum": 2}), "maximum": (2.5, {"maximum": 2}), "exclusiveMinimum": (2, {"exclusiveMinimum": 2}), "exclusiveMaximum": (3, {"exclusiveMaximum": 3.0}),
        "multipleOf": (7, {"multipleOf": 2}), "minLength": ("é😀", {"minLength": 3}), "maxLength": ("abc", {"maxLength": 2}), "minItems": ([], {"minItems": 1}), "maxItems": ([1, 2], {"maxItems": 1}),
        "minProperties": ({}, {"minProperties": 1}), "maxProperties": ({"p": 1, "q": 2}, {"maxProperties": 1}), "unsupported anyOf": (1, {"anyOf": [{"type": "string"}]}), "unsupported pattern": ("x", {"pattern": "(("}), "unexpected": (1, False),
    }
    fine = {"const": ("a", {"const": "a"}), "minimum": (2, {"minimum": 2}), "minLength": ("é😀", {"minLength": 2, "maxLength": 2}), "numbers": ("x", {"minimum": 5, "minItems": 3}), "true": (1, True), "null": (None, {"const": None})}
    rows = []
    for k, (v, s) in enumerate([*one.values(), *fine.values()]):
        rows += [(k, 0, "system", json.dumps({"tools": [{"name": "f", "parameters": {"properties": {"x": s}}}]})), (k, 1, "assistant", call(("1", "f", {"x": v})))]
    got = {r.conv_id: r.status for r in tc.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("kind = 'call'").collect()}
    assert [got[k] for k in sorted(got)] == [f"no_result:{k} x" for k in one] + ["no_result"] * len(fine)


LINKS = """
WITH m AS (SELECT DISTINCT conv_id, turn, role, text FROM t WHERE json_valid(text)),
c AS (SELECT conv_id, turn, text, x->>'id' AS id, k FROM (SELECT conv_id, turn, text, unnest(json_extract(text, '$.tool_calls[*]')) AS x, unnest(range(json_array_length(text, '$.tool_calls')::BIGINT)) AS k FROM m WHERE role = 'assistant')),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY turn, k, text) AS place FROM c),
r AS (SELECT conv_id, turn, text, text->>'tool_call_id' AS id, row_number() OVER (PARTITION BY conv_id, text->>'tool_call_id' ORDER BY turn, text) AS place FROM m WHERE role = 'tool')
SELECT n.conv_id, n.turn, 'call' AS kind, n.id, CASE WHEN n.place > 1 THEN 'duplicate' WHEN r.id IS NULL THEN 'no_result' ELSE 'ok' END || ':unknown_tool' AS status FROM n LEFT JOIN r ON r.conv_id = n.conv_id AND r.id = n.id AND r.place = 1
UNION ALL SELECT r.conv_id, greatest(r.turn, n.turn), 'result', r.id, CASE WHEN n.id IS NULL THEN 'orphan' WHEN r.place > 1 THEN 'duplicate' ELSE 'ok' END FROM r LEFT JOIN n ON n.conv_id = r.conv_id AND n.id = r.id AND n.place = 1
"""


def test_links_by_sql(spark):
    """Calls and results of random conversations, half of the identifiers used more than once, against DuckDB."""
    rng = np.random.default_rng(8)
    rows = []
    for c in range(60):
        for t in range(int(rng.integers(1, 9))):
            ids = [str(x) for x in rng.integers(0, 6, 1 + int(rng.integers(2)))]
            rows.append((c, t, "assistant", call(*((i, "f", {"x": int(rng.integers(9))}) for i in ids))) if rng.random() < 0.5 else (c, t, "tool", result(ids[0], int(rng.integers(3)))))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
    got = [(r.conv_id, r.turn, r.kind, json.loads(r.json)["id"], r.status) for r in tc.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("kind <> 'message'").collect()]
    assert sorted(got) == sorted(con.execute(LINKS).fetchall()) and len(got) > 200


def test_long_chain_and_repeats(spark):
    rows = [(1, k, "assistant", call((str(k), "f", {"x": f"${{{k - 1}}}"} if k else {}))) for k in range(12)] * 2
    got = tc.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("kind = 'call'").collect()
    assert sorted((r.turn, r.level) for r in got) == [(k, k) for k in range(12)]


def test_empty(spark):
    assert tc.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_whole_table(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    got = tc.formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(tc.SQL).fetchall())


def test_plan_is_native(spark):
    plan = tc.formatted(spark.createDataFrame(ROWS[:3], "conv_id long, turn long, role string, text string"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "CartesianProduct"))
