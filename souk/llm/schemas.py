"""Validating JSON arguments against JSON schemas, and canonical JSON (DataFrame functions only).

A schema becomes a table of rules, a row for each of its nodes, taken apart level
by level; the rules of a tool's top level and of its properties stand beside a call and
are checked in one projection.  Deeper values are taken out of the arguments level
by level and meet their rules in a join; a level is run only if some schema has it.

Checked: type (a name or a list), enum and const (of any type), required, properties,
additionalProperties (true or false), items (one schema), minimum, maximum and their
exclusive forms, lengths, numbers of items and of properties, uniqueItems, and patterns
of literals, classes and counts without groups.  What describes (title, format ...)
refuses nothing.  Any other keyword is named in the errors as ``unchecked``, and what
a schema says in a wrong form as ``bad``, so that no call passes as valid under a rule
that was not read.

Defined cases: a null schema is ``no schema``, one that is neither a JSON object nor
true or false is a ``bad schema``; arguments that are null or no JSON object (or
name a key twice) are ``not an object``; numbers equal in value are equal, and 1.0 is an integer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

#: what describes and refuses nothing
NOTES = ["$schema", "$id", "$comment", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format"]
TYPES = ["string", "boolean", "null", "integer", "number", "array", "object"]
BOUNDS = ["minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"]
COUNTS = ["minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"]
READ = ["type", "enum", "const", "required", "properties", "additionalProperties", "items", "uniqueItems", "pattern", *BOUNDS, *COUNTS]
#: patterns that mean the same to every engine and always compile: literals, \d, \w, classes, counts
PLAIN_PATTERN = (r"^\^?(?:(?:[A-Za-z0-9_ @:/,=#%&~;!<>'\"-]|\\[dwDW.+*?()\[\]{}|^$/\\-]"
                 r"|\[\^?(?:a-z|A-Z|0-9|a-f|A-F|[A-Za-z0-9_ .@:/,+]|\\[dw.\\-])+-?\])(?:[*+?]|\{[0-9]{1,3},?\})?)*\$?$")
NO_TEXTS = "array<string>"
MAP = "map<string,variant>"


def _none() -> Column:
    return F.array().cast(NO_TEXTS)


def _let(value: Column, body) -> Column:
    """body(value), with value worked out and written into the plan once."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---- canonical JSON ---------------------------------------------------------------------------------------------

#: a text without a match holds numbers in their canonical form only (a match may also lie in a string)
ODD_NUMBER = r"[0-9][.eE]|-0|[0-9]{19}"
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*+|[^"0-9-]++'


def canonical_number(token: Column) -> Column:
    """One text for each value: digits without exponent from 1e-6 on and up to 21 appended zeros, else d.ddde+n."""
    zeros = lambda k: F.repeat(F.lit("0"), k.cast("int"))
    part = lambda t, n: F.regexp_extract(t, r"^-?([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]{1,9}))?$", n)

    def cut(t):  # its digits without zeros in front and the power of ten behind them
        every = F.regexp_replace(F.concat(part(t, 1), part(t, 2)), "^0+", "")
        return F.struct(every.alias("every"), (F.coalesce(part(t, 3).try_cast("long"), F.lit(0)) - F.length(part(t, 2))).alias("power"))

    def trimmed(c):
        return _let(F.regexp_replace(c["every"], "0+$", ""), lambda d: F.struct(
            d.alias("d"), F.length(d).alias("n"), (c["power"] + F.length(c["every"]) - F.length(d)).alias("power"), (c["power"] + F.length(c["every"])).alias("point")))

    def plain(c):
        d, n, power, point = c["d"], c["n"], c["power"], c["point"]
        return (F.when((power >= 0) & (power <= 21), F.concat(d, zeros(power)))
                .when((power < 0) & (point > 0), F.concat(F.substr(d, F.lit(1), point.cast("int")), F.lit("."), F.substr(d, (point + 1).cast("int"))))
                .when((power < 0) & (point > -6), F.concat(F.lit("0."), zeros(-point), d))
                .otherwise(F.concat(F.substr(d, F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substr(d, F.lit(2)))).otherwise(F.lit("")),
                                    F.when(point > 0, F.lit("e+")).otherwise(F.lit("e")), (point - 1).cast("string"))))

    sign = F.when(token.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    # an exponent of ten digits and more is no number of use: kept as it is
    return F.when(part(token, 1) == "", token).otherwise(
        _let(cut(token), lambda c: F.when(c["every"] == "", F.lit("0")).otherwise(F.concat(sign, _let(trimmed(c), plain)))))


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys, no white space and one form for each number; null if it is no JSON.

    Numbers are carried through the parser as strings that start with the text's own md5, so no digit is lost.
    """
    def back(c):
        number = lambda t: F.concat(F.lit('"'), c["mark"], canonical_number(t), F.lit('"'))
        marked = F.array_join(F.transform(F.regexp_extract_all(c["text"], F.lit(TOKEN), F.lit(0)), lambda t: F.when(t.rlike("^-?[0-9]"), number(t)).otherwise(t)), "")
        return F.regexp_replace(F.to_json(F.try_parse_json(marked)), F.concat(F.lit('"'), c["mark"], F.lit('([^"]*)"')), F.lit("$1"))

    odd = _let(F.struct(text.alias("text"), F.concat(F.lit("#"), F.md5(text.cast("binary")), F.lit(":")).alias("mark")), back)
    return F.when(text.rlike(ODD_NUMBER) & F.try_parse_json(text).isNotNull(), odd).otherwise(F.to_json(F.try_parse_json(text)))


def _written(v: Column) -> Column:
    """A value's canonical JSON, for comparing."""
    return _let(F.to_json(v), canonical_json)


# ---- rules ------------------------------------------------------------------------------------------------------

def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _read() -> list[Column]:
    """Of a schema node (label, s variant, m its keywords): the struct ``rule`` and ``unread``, what cannot be read."""
    m = F.col("m")
    has = lambda k: F.map_contains_key(m, F.lit(k))
    at = lambda k: F.element_at(m, F.lit(k))
    get = lambda k, t: F.try_variant_get(at(k), "$", t)
    is_ = lambda k, pattern: _kind(at(k)).rlike(pattern)
    texts = lambda k: F.when(is_(k, "^ARRAY<(STRING|VOID)>$"), get(k, NO_TEXTS))
    types = F.when(is_("type", "^STRING$"), F.array(get("type", "string"))).otherwise(texts("type"))
    number = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
    listed = F.when(is_("enum", "^ARRAY"), F.transform(get("enum", "array<variant>"), _written))
    rule = F.struct(
        types.alias("types"), listed.alias("enum"), F.when(has("const"), _written(at("const"))).alias("const"), texts("required").alias("required"),
        F.when(is_("properties", "^OBJECT"), F.map_keys(get("properties", MAP))).alias("names"),
        F.when(is_("additionalProperties", "^BOOLEAN$"), get("additionalProperties", "boolean")).alias("more"),
        F.when(is_("uniqueItems", "^BOOLEAN$"), get("uniqueItems", "boolean")).alias("unique"),
        F.when(is_("pattern", "^STRING$") & get("pattern", "string").rlike(PLAIN_PATTERN), F.regexp_replace(get("pattern", "string"), r"(?<!\\)\$$", r"\\z")).alias("pattern"),
        (_kind(F.col("s")).eqNullSafe("BOOLEAN") & F.try_variant_get("s", "$", "boolean").eqNullSafe(False)).alias("never"),
        *[F.when(is_(k, number), at(k)).alias(k) for k in BOUNDS],
        *[F.when(is_(k, r"^(BIGINT|DECIMAL\(\d+,0\))$"), get(k, "long")).alias(k) for k in COUNTS])
    of = lambda word, k: F.concat(F.lit(f"{word} "), k if isinstance(k, Column) else F.lit(k), F.when(F.col("label") == "", F.lit("")).otherwise(F.concat(F.lit(" of "), F.col("label"))))
    bad = lambda k, fine: F.when(has(k) & ~F.coalesce(fine, F.lit(False)), of("bad", k))
    unread = F.concat(F.array_compact(F.array(
        F.when(m.isNull() & ~_kind(F.col("s")).eqNullSafe("BOOLEAN"), of("bad", "schema")),
        bad("type", types.isNotNull() & F.forall(types, lambda t: t.isin(TYPES))), bad("enum", is_("enum", "^ARRAY")),
        bad("required", texts("required").isNotNull()), bad("properties", is_("properties", "^OBJECT")),
        bad("additionalProperties", is_("additionalProperties", "^(BOOLEAN|OBJECT)")), bad("items", is_("items", "^(BOOLEAN|OBJECT|ARRAY)")),
        bad("uniqueItems", is_("uniqueItems", "^BOOLEAN$")), bad("pattern", is_("pattern", "^STRING$")),
        F.when(is_("additionalProperties", "^OBJECT"), of("unchecked", "additionalProperties")), F.when(is_("items", "^ARRAY"), of("unchecked", "items")),
        F.when(is_("pattern", "^STRING$") & ~get("pattern", "string").rlike(PLAIN_PATTERN), of("unchecked", "pattern")),
        *[bad(k, is_(k, number)) for k in BOUNDS], *[bad(k, is_(k, r"^(BIGINT|DECIMAL\(\d+,0\))$") & (get(k, "long") >= 0)) for k in COUNTS])),
        F.transform(F.array_except(F.coalesce(F.map_keys(m), _none()), F.array(*[F.lit(k) for k in (*READ, *NOTES)])), lambda k: of("unchecked", k)))
    return [rule.alias("rule"), unread.alias("unread")]


def _below(nodes: DataFrame) -> DataFrame:
    """The children of nodes: path ends in the property's name (escaped), or in * for the items of an array."""
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("key"), "~", "~0"), "/", "~1"), r"\*", "~2")
    label = F.when(F.col("label") == "", F.col("key")).otherwise(F.concat("label", F.lit("."), "key"))
    inside = F.when(_kind(F.element_at("m", F.lit("properties"))).startswith("OBJECT"), F.try_variant_get(F.element_at("m", F.lit("properties")), "$", MAP))
    props = (nodes.select("name", "path", "label", F.explode(inside).alias("key", "s"))
             .select("name", F.col("path").alias("parent"), F.concat("path", F.lit("/"), name).alias("path"), label.alias("label"), F.col("key"), "s"))
    item = F.element_at("m", F.lit("items"))
    items = (nodes.filter(_kind(item).rlike("^(OBJECT|BOOLEAN)"))
             .select("name", F.col("path").alias("parent"), F.concat("path", F.lit("/*")).alias("path"), F.concat("label", F.lit("[]")).alias("label"), F.lit(None).cast("string").alias("key"), item.alias("s")))
    return props.unionByName(items)


def _stashed(df: DataFrame, name: str) -> DataFrame:
    """Variants are written as JSON text and parsed again."""
    kept = stash(df.withColumn("s", F.to_json("s")), name)
    return kept.withColumn("s", F.parse_json("s"))


class Rules:
    """top: a row a tool with its rule, its properties' rules and unread keywords; deeper: the levels below, a row a node."""

    def __init__(self, top: DataFrame, deeper: list[DataFrame]):
        self.top, self.deeper = top, deeper


def rules(schemas: DataFrame) -> Rules:
    """schemas(name, schema): one row a tool."""
    roots = schemas.select("name", F.lit("").alias("path"), F.lit("").alias("label"), F.try_parse_json("schema").alias("s"), F.col("schema").isNull().alias("lacks"))
    keywords = F.when(_kind(F.col("s")).startswith("OBJECT"), F.try_variant_get("s", "$", MAP))
    read = _read()  # one expression for all levels
    node = lambda df: df.withColumn("m", keywords).select("*", *read)
    level = node(_stashed(roots, "schema_0"))
    top = level.select("name", "rule", F.when(F.col("lacks"), F.array(F.lit("no schema"))).otherwise(F.col("unread")).alias("unread"))
    deeper, unread = [], [top.select("name", "unread")]
    while True:
        level = node(_stashed(_below(level), f"schema_{len(deeper) + 1}"))
        if level.isEmpty():
            break
        deeper.append(level.select("name", "parent", "path", "label", "key", "rule"))
        unread.append(level.select("name", "unread"))
    # a tool's rules: as many as its schema has nodes
    bad = reduce(DataFrame.unionAll, unread).groupBy("name").agg(F.array_sort(F.flatten(F.collect_list("unread"))).alias("unread"))
    out = top.drop("unread").join(bad, "name")
    if deeper:
        props = (deeper[0].filter("key is not null").groupBy("name")
                 .agg(F.map_from_entries(F.collect_list(F.struct("key", "rule"))).alias("props")))
        out = out.join(props, "name", "left")
    return Rules(stash(out, "schema_rules"), [stash(d, "schema_nodes") for d in deeper])


# ---- values -----------------------------------------------------------------------------------------------------

def _fits(k: Column, v: Column, want: Column) -> Column:
    whole = F.try_variant_get(v, "$", "double")
    return (F.when(want == "string", k == "STRING").when(want == "boolean", k == "BOOLEAN").when(want == "null", k == "VOID")
            .when(want == "integer", k.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$") | (k.rlike("^(DECIMAL|DOUBLE|FLOAT)") & (whole == F.rint(whole))))
            .when(want == "number", k.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
            .when(want == "array", k.startswith("ARRAY")).when(want == "object", k.startswith("OBJECT")).otherwise(False))


def _less(a: Column, b: Column) -> Column:
    """a < b for variant numbers: as doubles, and integers that are one double exactly."""
    x, y = F.try_variant_get(a, "$", "double"), F.try_variant_get(b, "$", "double")
    i, j = F.try_variant_get(a, "$", "decimal(38,0)"), F.try_variant_get(b, "$", "decimal(38,0)")
    return F.when(x != y, x < y).otherwise(F.coalesce(i < j, F.lit(False)))


def _wrong(value: Column, its_rule: Column, its_label: Column) -> Column:
    """What is wrong with the value itself (not with what it holds), each named with its place."""
    def parsed(c):
        v, k = c["v"], c["k"]
        return F.struct(v.alias("v"), k.alias("k"), c["rule"].alias("rule"), c["label"].alias("label"), k.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)").alias("number"),
                        F.when(k.startswith("OBJECT"), F.map_keys(F.try_variant_get(v, "$", MAP))).alias("keys"),
                        F.when(k.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).alias("parts"),
                        F.when(k == "STRING", F.try_variant_get(v, "$", "string")).alias("string"),
                        F.when(c["rule"]["enum"].isNotNull() | c["rule"]["const"].isNotNull(), _written(v)).alias("text"))

    def errors(c):
        v, k, rule, label, number, keys, parts, string = (c[n] for n in ("v", "k", "rule", "label", "number", "keys", "parts", "string"))
        named = lambda word: F.when(label == "", F.lit(word)).otherwise(F.concat(F.lit(word + " "), label))
        place = F.when(label == "", F.lit("")).otherwise(F.concat(label, F.lit(".")))
        size = {"Length": F.char_length(string), "Items": F.size(parts), "Properties": F.size(keys)}
        held = {"Length": string, "Items": parts, "Properties": keys}
        # word -> whether the value breaks it (null: the keyword is not there)
        broken = {
            "not allowed": rule["never"], "type": ~F.exists(rule["types"], lambda t: _fits(k, v, t)),
            "enum": ~F.array_contains(rule["enum"], c["text"]), "const": rule["const"] != c["text"],
            "minimum": number & _less(v, rule["minimum"]), "maximum": number & _less(rule["maximum"], v),
            "exclusiveMinimum": number & rule["exclusiveMinimum"].isNotNull() & ~_less(rule["exclusiveMinimum"], v),
            "exclusiveMaximum": number & rule["exclusiveMaximum"].isNotNull() & ~_less(v, rule["exclusiveMaximum"]),
            **{f"min{n}": held[n].isNotNull() & (size[n] < rule[f"min{n}"]) for n in size}, **{f"max{n}": held[n].isNotNull() & (size[n] > rule[f"max{n}"]) for n in size},
            "uniqueItems": rule["unique"] & (F.size(F.array_distinct(F.transform(parts, _written))) < F.size(parts)),
            "pattern": rule["pattern"].isNotNull() & ~F.rlike(string, F.coalesce(rule["pattern"], F.lit("")))}
        own = F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(False)), named(word)) for word, b in broken.items()]))
        missing = F.transform(F.array_except(F.coalesce(rule["required"], _none()), keys), lambda n: F.concat(F.lit("missing "), place, n))
        unknown = F.when(rule["more"].eqNullSafe(False), F.transform(F.array_except(keys, F.coalesce(rule["names"], _none())), lambda n: F.concat(F.lit("unknown "), place, n)))
        return F.concat(own, F.coalesce(missing, _none()), F.coalesce(unknown, _none()))

    start = F.struct(value.alias("v"), _kind(value).alias("k"), its_rule.alias("rule"), its_label.alias("label"))
    return F.when(value.isNotNull() & its_rule.isNotNull(), _let(_let(start, parsed), errors)).otherwise(_none())


def argument_errors(calls: DataFrame, tools: Rules) -> DataFrame:
    """calls(conv_id, call_id, name, arguments) -> conv_id, call_id, wrong: the sorted errors of each call."""
    args = F.col("args")
    base = calls.join(tools.top, "name", "left").withColumn("args", F.try_parse_json("arguments"))
    checks = [_wrong(args, F.col("rule"), F.lit(""))]
    if tools.deeper:
        held = F.try_variant_get(args, "$", MAP)
        given = F.filter(F.coalesce(F.map_keys("props"), _none()), lambda n: F.map_contains_key(held, n))
        checks.append(F.coalesce(F.flatten(F.transform(given, lambda n: _wrong(F.element_at(held, n), F.element_at("props", n), n))), _none()))
    unread = F.when(F.col("rule").isNull(), F.array(F.lit("no schema"))).otherwise(F.col("unread"))
    none = F.array(F.lit("no schema"))
    wrong = (F.when(unread == none, none)
             .when(args.isNull() | ~_kind(args).startswith("OBJECT"), F.concat(F.array(F.lit("not an object")), unread))
             .otherwise(F.concat(F.array_sort(F.concat(*checks)), unread)))
    out = base.select("conv_id", "call_id", wrong.alias("wrong"))
    if len(tools.deeper) < 2:
        return out

    # only calls of tools with deeper rules, and of their arguments only what has a rule
    deep = tools.deeper[1].select("name", "parent").distinct()
    names = deep.select("name").distinct()
    level = (calls.join(names, "name", "left_semi").withColumn("v", F.try_parse_json("arguments")).filter(_kind(F.col("v")).startswith("OBJECT"))
             .select("conv_id", "call_id", "name", F.lit("").alias("path"), "v"))
    found, wrong = [], _wrong(F.col("v"), F.col("rule"), F.col("label"))
    for depth, nodes in enumerate(tools.deeper):
        rule = nodes.select("name", F.col("parent").alias("path"), F.col("path").alias("_path"), "label", "key", "rule")
        inside = F.when(_kind(F.col("v")).startswith("OBJECT"), F.try_variant_get("v", "$", MAP))
        parts = F.when(_kind(F.col("v")).startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>"))
        met = level.join(rule, ["name", "path"])
        value = F.when(F.col("key").isNull(), parts).otherwise(F.when(F.map_contains_key(inside, F.col("key")), F.array(F.element_at(inside, F.col("key")))))
        level = (met.select("conv_id", "call_id", "name", F.col("_path").alias("path"), "label", "rule", F.explode(value).alias("v")))
        if depth:  # the first level was checked beside the call
            found.append(level.select("conv_id", "call_id", F.explode(wrong).alias("e")))
        level = level.select("conv_id", "call_id", "name", "path", "v")
    # the errors of a call, each place of its schema named once
    deeper = reduce(DataFrame.unionAll, found).groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set("e")).alias("deeper"))
    return (out.join(deeper, ["conv_id", "call_id"], "left")
            .select("conv_id", "call_id", F.concat("wrong", F.coalesce("deeper", _none())).alias("wrong")))
