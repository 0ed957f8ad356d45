import json
import random

from souk.llm import toolcalls as T

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
RULE = {"type": "object", "properties": {"q": {"type": "string"}, "n": {"type": "integer"}, "c": {"type": "string", "enum": ["red", "blue"]}},
        "required": ["q"], "additionalProperties": False}


def tables(spark, seed=3, n=300):
    r = random.Random(seed)
    calls = []
    for k in range(n):
        conv = r.choice([1, 1, 1, r.randrange(60)])
        args = r.choice([{"q": "x", "n": 3}, {"q": 1}, {"n": 2.5, "q": "é\n\"/"}, {"z": {"b": [1, None], "a": True}, "q": "y"}, {}, {"q": "x", "c": r.choice(["red", "green"])}])
        after = [f"k{r.randrange(n)}" for _ in range(r.randrange(3))] if k % 3 else None
        calls.append((conv, k % 40, f"k{k}", r.choice(["tool", "tool", "none"]), json.dumps(args) if k % 11 else "broken", after))
    calls += [(1, 0, "p", "tool", "{}", ["q"]), (1, 0, "q", "tool", "{}", ["p"]), (1, 9, "after_circle", "tool", '{"q":"a"}', ["p"]),
              (1, 50, "k0", "tool", "{}", []), (1, 50, "k0", "tool", "{}", []), (None, 0, "a", "tool", "{}", []), (2, 0, None, "tool", None, None), (2, None, "noturn", None, "[1]", [None])]
    results = [(c[0], 60, c[2], f"result {i}") for i, c in enumerate(calls) if i % 4 == 0] + [(77, 0, "lost", "x"), (1, 61, "k1", "later"), (1, 60, "k1", None)]
    return calls, results


def brute(calls, results):
    first = {}
    for c in sorted(calls, key=lambda c: (c[1] is not None, c[1] or 0, c[3] is not None, c[3] or "", c[4] or "")):
        if c[0] is not None and c[2] is not None:
            first.setdefault((c[0], c[2]), c)
    answer = {}
    for a in sorted(results, key=lambda a: (a[1], a[3] is not None, a[3] or "")):
        answer.setdefault((a[0], a[2]), a)
    level, left = {}, dict(first)
    while left:
        ready = [k for k, c in left.items() if not any((k[0], w) in left for w in c[5] or [] if w is not None)]
        if not ready:
            break
        n = max(level.values(), default=-1) + 1
        for k in ready:
            level[k] = n
        for k in ready:
            del left[k]
    level |= dict.fromkeys(left, -1)
    place = {}
    for conv in {k[0] for k in first}:
        order = sorted((k for k in first if k[0] == conv), key=lambda k: (level[k] < 0, level[k], first[k][1] if first[k][1] is not None else -1, k[1]))
        place |= {k: i for i, k in enumerate(order)}
    out = {}
    for k, c in first.items():
        try:
            args = json.loads(c[4]) if c[4] is not None else None
        except ValueError:
            args = c[4]
        errors = []
        if c[3] != "tool":
            errors = ["no schema"]
        elif not isinstance(args, dict):
            errors = ["not an object"]
        else:
            kind = {"string": str, "integer": int}
            errors = sorted([f"missing {n}" for n in RULE["required"] if n not in args] + [f"unknown {n}" for n in args if n not in RULE["properties"]]
                            + [f"type {n}" for n, p in RULE["properties"].items() if n in args and not isinstance(args[n], kind[p["type"]])]
                            + [f"enum {n}" for n, p in RULE["properties"].items() if n in args and "enum" in p and args[n] not in p["enum"]])
        waits = sorted({w for w in c[5] or [] if w is not None})
        errors += [f"waits for unknown {w}" for w in waits if (k[0], w) not in first]
        text = json.dumps({"after": waits, "arguments": args, "id": k[1], "name": c[3], "position": place[k], "result": answer[k][3] if k in answer else None},
                          sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        out[k] = ("linked" if k in answer else "unanswered", level[k], place[k], not errors, errors, text)
    return out


def test_equals_brute_force(spark):
    calls, results = tables(spark)
    got = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), spark.createDataFrame([("tool", json.dumps(RULE)), (None, "{}")], "name string, schema string")).collect()
    want = brute(calls, results)
    mine = {(r["conv_id"], r["call_id"]): (r["status"], r["level"], r["position"], r["valid"], r["errors"], r["json"]) for r in got if r["position"] is not None}
    assert mine.keys() == want.keys()
    for k in want:
        assert mine[k] == want[k], k
    rest = sorted((r["status"], str(r["conv_id"]), str(r["call_id"])) for r in got if r["position"] is None)
    # a repeated row, the other row of its identifier, two rows without identifier, results without call
    assert [x for x in rest if x[0] == "duplicate"] == [("duplicate", "1", "k0")] * (2 if ("1", "k0") in {(str(k[0]), k[1]) for k in want if want[k][0] and calls[0][0] == 1} else 1)
    assert [x for x in rest if x[0] == "unanswered"] == [("unanswered", "2", "None"), ("unanswered", "None", "a")]
    assert ("orphan", "77", "lost") in rest
    assert len(got) == len(calls) + sum(x[0] == "orphan" for x in rest)


def test_empty(spark):
    none = T.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), spark.createDataFrame([], "name string, schema string"))
    assert none.count() == 0


def test_stand_in_keeps_every_message(spark, sf_small):
    m = spark.read.parquet(f"{sf_small}/conversations.parquet")
    calls, results = T.conversation_calls(m)
    assert calls.count() == results.count() == m.count()


def test_every_result_is_reported(spark):
    calls = [(1, 0, "a", "tool", '{"q":"x"}', [])]
    results = [(1, 1, "a", "one"), (1, 1, "a", "one"), (1, 1, "a", "two"), (1, 2, "a", None), (None, 1, "a", "x"), (1, None, "a", "z"), (1, 3, "b", "lost")]
    got = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), spark.createDataFrame([("tool", json.dumps(RULE))], "name string, schema string")).collect()
    assert sorted((str(r["conv_id"]), r["call_id"], str(r["turn"]), r["errors"][0] if r["errors"] else r["status"]) for r in got) == sorted(
        [("1", "a", "0", "linked"), ("1", "a", "1", "duplicate result"), ("1", "a", "1", "duplicate result"), ("1", "a", "1", "duplicate result"),
         ("1", "a", "2", "duplicate result"), ("None", "a", "1", "orphan"), ("1", "b", "3", "orphan")])


def judged(spark, cases):
    """The errors of each case (schema text, arguments text)."""
    d = spark.createDataFrame([(f"t{i:03}", c[0]) for i, c in enumerate(cases)], "name string, schema string")
    calls = spark.createDataFrame([(1, i, f"k{i}", f"t{i:03}", c[1], []) for i, c in enumerate(cases)], CALLS)
    out = T.link(calls, spark.createDataFrame([], RESULTS), d).collect()
    assert all(r["valid"] == (not r["errors"]) for r in out)
    return [r["errors"] for r in sorted(out, key=lambda r: r["turn"])], [r["json"] for r in sorted(out, key=lambda r: r["turn"])]


def props(**rules):
    return json.dumps({"type": "object", "properties": rules})


def test_schemas(spark):
    nested = props(o={"type": "object", "properties": {"x": {"type": "integer"}, "l": {"type": "array", "items": {"type": "object", "properties": {"y": {"enum": ["a", 1]}}, "required": ["y"]}}},
                      "required": ["x"], "additionalProperties": False})
    odd = props(**{"a/b": {"items": {"type": "string"}}, "*": {"properties": {"~": {"type": "null"}}}})
    cases = [
        # a schema that cannot be read refuses, with its reason
        ("not json", "{}", ["bad schema"]), ("[]", "{}", ["bad schema"]), ('{"required":"a"}', '{"a":1}', ["bad required"]), (None, "{}", ["no schema"]),
        ('{"properties":{"x":3}}', '{"x":1}', ["bad schema of x"]), ('{"properties":[]}', "{}", ["bad properties"]), ('{"type":"objekt"}', "{}", ["type", "bad type"]),
        (props(x={"minimum": "1", "maxLength": -1, "enum": 3}), '{"x":1}', ["bad enum of x", "bad maxLength of x", "bad minimum of x"]),
        ("true", '{"x":1}', []), ("false", "{}", ["not allowed"]), ('{"anyOf":[],"title":"t"}', "{}", ["unchecked anyOf"]), (props(x={"$ref": "#"}), "{}", ["unchecked $ref of x"]),
        ('{"additionalProperties":{"type":"string"}}', "{}", ["unchecked additionalProperties"]), (props(x=False), '{"x":1}', ["not allowed x"]), (props(x=False), "{}", []),
        # types, values and bounds
        (props(e={"enum": ["1"]}), '{"e":1}', ["enum e"]), (props(e={"enum": [1, None, {"b": 1, "a": [2.0]}]}), '{"e":{"a":[2],"b":1.0}}', []), (props(e={"enum": [1e2]}), '{"e":100}', []),
        (props(e={"const": 5}), '{"e":5.0}', []), (props(e={"const": 5}), '{"e":"5"}', ["const e"]),
        (props(a={"type": "integer"}), '{"a":' + "9" * 42 + "}", []), (props(a={"type": "integer"}), '{"a":1e2}', []), (props(a={"type": "integer"}), '{"a":1.5}', ["type a"]),
        (props(t={"type": ["string", "null"]}), '{"t":null}', []), (props(t={"type": ["string", "null"]}), '{"t":1}', ["type t"]), (props(t={"type": "number"}), '{"t":true}', ["type t"]),
        (props(n={"minimum": 3, "exclusiveMaximum": 4.5}), '{"n":3}', []), (props(n={"minimum": 3, "exclusiveMaximum": 4.5}), '{"n":4.5}', ["exclusiveMaximum n"]),
        (props(n={"minimum": 3}), '{"n":2.99}', ["minimum n"]), (props(n={"minimum": 3}), '{"n":"x"}', []), (props(n={"maximum": 9007199254740993}), '{"n":9007199254740994}', ["maximum n"]),
        (props(s={"minLength": 2, "maxLength": 3}), '{"s":"\U0001f600"}', ["minLength s"]), (props(s={"minLength": 2, "maxLength": 3}), '{"s":"abcd"}', ["maxLength s"]),
        (props(a={"minItems": 1, "uniqueItems": True}), '{"a":[]}', ["minItems a"]), (props(a={"uniqueItems": True}), '{"a":[1,1.0]}', ["uniqueItems a"]), (props(a={"uniqueItems": True}), '{"a":[1,"1"]}', []),
        ('{"minProperties":2}', '{"a":1}', ["minProperties"]), ('{"maxProperties":0}', '{"a":1}', ["maxProperties"]),
        (props(d={"pattern": "^[0-9]{4}-\\d{2}$"}), '{"d":"2024-01"}', []), (props(d={"pattern": "^[0-9]{4}-\\d{2}$"}), '{"d":"2024-01\\n"}', ["pattern d"]), (props(d={"pattern": "(a"}), '{"d":"a"}', ["unchecked pattern of d"]),
        # nested
        (nested, '{"o":{"x":1,"l":[{"y":"a"},{"y":1}]}}', []), (nested, '{"o":{"x":"no"}}', ["type o.x"]), (nested, '{"o":{"l":[{"y":"a"},{"y":"b"},{},3],"z":1}}',
         ["missing o.x", "unknown o.z", "enum o.l[].y", "missing o.l[].y", "type o.l[]"]), (nested, '{"o":null}', ["type o"]), (nested, "[1]", ["not an object"]), (nested, None, ["not an object"]),
        (nested, '{"o":{"x":1},"o":{}}', ["not an object"]), (odd, '{"a/b":["x",1],"*":{"~":null},"a":{"b":1}}', ["type a/b[]"]), (odd, '{"a/b":["x"],"*":{"~":0}}', ["type *.~"]),
    ]
    got, _ = judged(spark, [c[:2] for c in cases])
    for g, c in zip(got, cases, strict=True):
        assert g == c[2], c


def test_canonical_numbers(spark):
    same = [("1e2", "100"), ("100.0", "100"), ("1.0", "1"), ("-0", "0"), ("-0.0", "0"), ("0.10", "0.1"), ("1E-7", "1e-7"), ("0.000001", "0.000001"), ("9" * 42, "9" * 42), ("12.5e1", "125"), ("-1.50e+1", "-15"),
            ("1.5e300", "1.5e+300"), ("123456789012345678901234567890.125", "123456789012345678901234567890.125"), ("1e22", "1e+22"), ("5e21", "5" + "0" * 21)]
    texts = [f'{{ "b" : [{a}, "{a}, \\"1.0"], "a":{a} }}' for a, _ in same]
    _, got = judged(spark, [("true", t) for t in texts])
    for g, (a, want) in zip(got, same, strict=True):
        assert f'"arguments":{{"a":{want},"b":[{want},"{a}, \\"1.0"]}},' in g, (g, want)


def test_long_chains(spark):
    n = 1000
    calls = [(1, i, f"k{i}", "t", "{}", [f"k{i - 1}"] if i else []) for i in range(n)]
    calls += [(2, i, f"k{i}", "t", "{}", [f"k{i - 1}", f"k{i - 2}"] if i > 1 else []) for i in range(12)] + [(2, 20, "tail", "t", "{}", ["k11"])]
    calls += [(3, i, f"k{i}", "t", "{}", [f"k{(i + 1) % 5}"]) for i in range(5)] + [(3, 9, "x", "t", "{}", ["k0"]), (3, 9, "y", "t", "{}", ["x", "z"]), (3, 9, "z", "t", "{}", []), (3, 9, "w", "t", "{}", ["y"])]
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in T.levels(spark.createDataFrame(calls, CALLS)).collect()}
    assert all(got[1, f"k{i}"] == i for i in range(n))
    assert [got[2, f"k{i}"] for i in range(12)] == [0, 0, *range(1, 11)] and got[2, "tail"] == 11
    assert {c: v for (k, c), v in got.items() if k == 3} == {**{f"k{i}": -1 for i in range(5)}, "x": -1, "y": -1, "w": -1, "z": 0}
