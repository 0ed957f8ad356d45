"""Chat formatting, tool-call linking (DataFrame functions only).

Calls and results meet by conversation and call identifier in a hash-partitioned
join.  Arguments are validated against the tool's JSON schema (``schemas.py``).
Calls are ordered topologically: a call's level is one more than the highest level
among the calls of its conversation that it waits for.  Chains of calls that wait
for one call each are followed by pointer jumping, so a chain of n calls takes
log n joins; calls that wait for several are levelled round by round (Kahn), as many
rounds as the longest chain of such calls has; within a level turn and
identifier decide.  Every call is written as canonical JSON (sorted keys, no white
space, one form for each number).

Defined cases: a null conversation or call identifier links nothing (the row is
kept, unlinked); if identifiers repeat within a conversation the call (result)
of the lowest turn counts, ties by its content, and the other calls are reported as
``duplicate``, the other results as ``orphan`` with the error ``duplicate result``; a result without call is reported as ``orphan``; arguments that
are null or no JSON object are invalid; a tool without schema, or with one that
cannot be read, is invalid;
calls that wait for each other in a circle, or for a call that does, get the
level -1 and come last; waiting for an unknown call is an error that does not
change the order; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, table
from .schemas import argument_errors, canonical_json, rules

#: turns of a conversation that are numbered together
TURNS = 1024


def _first(df: DataFrame, *order: str) -> DataFrame:
    """One row of each (conv_id, call_id), the least by order; without null identifiers."""
    rest = [c for c in df.columns if c not in ("conv_id", "call_id", *order)]
    return (df.filter("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id")
            .agg(F.min(F.struct(*order, *rest)).alias("r")).select("conv_id", "call_id", "r.*"))


def _chains(edges: DataFrame, waits: DataFrame) -> DataFrame:
    """Of every call with one wait: the first call behind it that has none or several (``end``), and how far it is.

    ``open`` marks calls whose chain never ends (it leads into a circle).
    """
    only = waits.filter("n = 1").select("conv_id", "call_id")
    at = stash(edges.join(only, ["conv_id", "call_id"]).select("conv_id", "call_id", F.col("wait").alias("end"), F.lit(1).cast("long").alias("steps"),
                                                               F.lit(True).alias("open")), "call_chains")
    most = at.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while True:
        ahead = at.select("conv_id", F.col("call_id").alias("end"), F.col("end").alias("_end"), F.col("steps").alias("_steps"))
        at = stash(at.join(ahead, ["conv_id", "end"], "left").select(
            "conv_id", "call_id", F.coalesce("_end", "end").alias("end"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.col("_end").isNotNull().alias("open")), "call_chains")
        if reach > most or at.filter("open").isEmpty():
            return at
        reach *= 2


def _joins(edges: DataFrame, waits: DataFrame, chains: DataFrame) -> DataFrame:
    """conv_id, call_id, level of every call that waits for several (-1 for circles), round by round."""
    several = waits.filter("n > 1").select("conv_id", "call_id")
    way = chains.select("conv_id", F.col("call_id").alias("wait"), "end", "steps", F.col("open").alias("stuck"))
    known = several.select("conv_id", F.col("call_id").alias("end"), F.lit(True).alias("later"))
    left = (edges.join(several, ["conv_id", "call_id"]).join(way, ["conv_id", "wait"], "left")
            .select("conv_id", "call_id", F.coalesce("end", "wait").alias("end"), (F.coalesce("steps", F.lit(0)) + 1).cast("long").alias("level"),
                    F.coalesce("stuck", F.lit(False)).alias("stuck"))
            .join(known, ["conv_id", "end"], "left")
            .select("conv_id", "call_id", F.when(F.col("later"), F.col("end")).alias("end"), "level", "stuck"))
    left = stash(left, "call_joins")
    done, rounds = [], 0
    while True:
        state = left.groupBy("conv_id", "call_id").agg(F.max(F.col("end").isNotNull() | F.col("stuck")).alias("_held"), F.max("level").alias("level"))
        now = stash(state.filter("not _held").drop("_held"), "call_level")
        if now.isEmpty():
            break
        done.append(now)
        if len(done) == 16:
            done = [stash(_union(done), "call_levels")]
        found = now.select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("_level"))
        left = stash(left.join(now.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti").join(found, ["conv_id", "end"], "left")
                     .select("conv_id", "call_id", F.when(F.col("_level").isNull(), F.col("end")).alias("end"),
                             (F.col("level") + F.coalesce("_level", F.lit(0))).alias("level"), "stuck"), "call_joins")
    circles = left.select("conv_id", "call_id", F.lit(-1).cast("long").alias("level")).distinct()
    return stash(_union([*done, circles]), "call_levels")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def levels(calls: DataFrame) -> DataFrame:
    """calls(conv_id, call_id, after array<string>) -> conv_id, call_id, level, unknown (calls it waits for that do not exist)."""
    nodes = calls.select("conv_id", "call_id")
    waits = stash(calls.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("wait")).filter("wait is not null"), "call_waits")
    known = nodes.select("conv_id", F.col("call_id").alias("wait"))
    edges = stash(waits.join(known, ["conv_id", "wait"]), "call_edges")
    unknown = (waits.join(known, ["conv_id", "wait"], "left_anti").groupBy("conv_id", "call_id")
               .agg(F.array_sort(F.collect_list(F.concat(F.lit("waits for unknown "), F.col("wait")))).alias("unknown")))
    number = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"))
    chains = _chains(edges, number)
    joins = _joins(edges, number, chains)
    behind = joins.select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("_level"))
    singles = (chains.join(behind, ["conv_id", "end"], "left")
               .select("conv_id", "call_id", F.when(F.col("open") | (F.col("_level") < 0), F.lit(-1))
                       .otherwise(F.col("steps") + F.coalesce("_level", F.lit(0))).cast("long").alias("level")))
    return (nodes.join(singles.unionByName(joins), ["conv_id", "call_id"], "left")
            .select("conv_id", "call_id", F.coalesce("level", F.lit(0)).cast("int").alias("level"))
            .join(unknown, ["conv_id", "call_id"], "left"))


def _positions(df: DataFrame) -> DataFrame:
    """position: the place of a call in its conversation, from 0, by level (-1 last), turn and identifier.

    A conversation of any length is numbered in slices of TURNS turns of a
    level, plus the number of calls in the slices before.
    """
    df = df.withColumn("_last", (F.col("level") < 0).cast("int")).withColumn("_slice", F.floor(F.coalesce("turn", F.lit(-1)) / TURNS))
    cut = ["conv_id", "_last", "level", "_slice"]
    sums = df.groupBy(*cut).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_last", "level", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy(*cut).orderBy(F.col("turn").asc_nulls_first(), "call_id"))
    return df.withColumn("_place", place).join(offsets, cut).withColumn("position", F.col("_off") + F.col("_place") - 1).drop("_last", "_slice", "_place", "_off")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls(conv_id, turn, call_id, name, arguments, after), results(conv_id, turn, call_id, content), schemas(name, schema).

    Returns conv_id, call_id, turn, status (linked, unanswered, duplicate,
    orphan), level, position, valid, errors, json.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    first = stash(_first(calls, "turn", "name", "arguments"), "calls")
    answer = _first(results, "turn", "content").select("conv_id", "call_id", "content", F.col("turn").alias("answered"))
    tool = rules(schemas.filter("name is not null").groupBy("name").agg(F.min("schema").alias("schema")))
    ordered = _positions(first.select("conv_id", "call_id", "turn").join(levels(first), ["conv_id", "call_id"]))

    judged = argument_errors(first.select("conv_id", "call_id", "name", "arguments"), tool)
    linked = (first.join(answer, ["conv_id", "call_id"], "left").join(judged, ["conv_id", "call_id"])
              .join(ordered.drop("turn"), ["conv_id", "call_id"])
              .withColumn("errors", F.concat("wrong", F.coalesce("unknown", F.array().cast("array<string>"))))
              .withColumn("status", F.when(F.col("answered").isNotNull() | F.col("content").isNotNull(), "linked").otherwise("unanswered")))
    # keys in their order; the arguments are written canonically, or kept as text if they are no JSON
    waits = F.array_sort(F.array_distinct(F.filter(F.coalesce("after", F.array().cast("array<string>")), lambda x: x.isNotNull()))).alias("after")
    whole = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    head, tail = whole(waits), whole(F.col("call_id").alias("id"), "name", "position", F.col("content").alias("result"))
    text = F.coalesce(canonical_json(F.col("arguments")), F.to_json(F.col("arguments").cast("variant")), F.lit("null"))
    linked = linked.withColumn("json", F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"arguments":'), text, F.lit(","), F.substring(tail, 2, 2147483647)))
    linked = linked.select("conv_id", "call_id", "turn", "status", "level", "position", (F.size("errors") == 0).alias("valid"), "errors", "json")

    bare = lambda df, status: df.select("conv_id", "call_id", "turn", F.lit(status).alias("status"), F.lit(None).cast("int").alias("level"),
                                        F.lit(None).cast("long").alias("position"), F.lit(False).alias("valid"), F.array(F.lit(status)).alias("errors"), F.lit(None).cast("string").alias("json"))
    # of rows with one identifier all but the first: counted, not gathered
    again = (calls.groupBy("conv_id", "call_id", "turn", "name", "arguments").agg(F.count("*").alias("n"))
             .join(first.select("conv_id", "call_id", F.col("turn").alias("_t"), F.col("name").alias("_n"), F.col("arguments").alias("_a")), ["conv_id", "call_id"], "left"))
    is_first = F.col("turn").eqNullSafe(F.col("_t")) & F.col("name").eqNullSafe(F.col("_n")) & F.col("arguments").eqNullSafe(F.col("_a"))
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    extra = again.withColumn("n", F.col("n") - (is_first & named).cast("int")).filter("n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    no_id = bare(extra.filter(~named), "unanswered")
    duplicates = bare(extra.filter(named), "duplicate")
    orphans = bare(results.join(first.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"), "orphan")
    # of the results of a call all but the one that counts
    more = (results.groupBy("conv_id", "call_id", "turn").agg(F.count("*").alias("n")).join(answer.select("conv_id", "call_id", "answered"), ["conv_id", "call_id"])
            .join(first.select("conv_id", "call_id"), ["conv_id", "call_id"]).withColumn("n", F.col("n") - F.col("turn").eqNullSafe(F.col("answered")).cast("int"))
            .filter("n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))))
    return linked.unionByName(no_id).unionByName(duplicates).unionByName(bare(more, "orphan").withColumn("errors", F.array(F.lit("duplicate result")))).unionByName(orphans)


def conversation_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stand-in input: conversations have no tool calls, so every message asks for one and the next message answers it.

    The call's tool is the message's role, its arguments are the message; a
    message that does not start a conversation waits for the call of its
    predecessor or, where the text's md5 begins with 8 to f, for none.
    """
    m = messages.select("conv_id", "turn", "role", "text")
    odd = F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 1) >= "8"
    name = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    lines = F.split("text", "\n")
    arguments = F.to_json(F.struct(F.col("text"), F.when(odd, F.size(lines)).alias("lines"), F.col("turn").cast("string").alias("turn")))
    calls = m.select("conv_id", "turn", name(F.col("turn")).alias("call_id"), F.col("role").alias("name"), arguments.alias("arguments"),
                     F.when((F.col("turn") > 0) & ~odd, F.array(name(F.col("turn") - 1))).otherwise(F.array().cast("array<string>")).alias("after"))
    results = m.select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


#: the tools of the stand-in: what a user, an assistant and a system message must carry
SCHEMAS = [
    ("user", '{"type":"object","properties":{"text":{"type":"string"},"lines":{"type":"integer"},"turn":{"type":"string"}},"required":["text"]}'),
    ("assistant", '{"type":"object","properties":{"text":{"type":"string"},"lines":{"type":"integer"},"turn":{"type":"string"}},"required":["lines","text"]}'),
    ("system", '{"type":"object","properties":{"text":{"type":"string"},"turn":{"type":"integer"}},"additionalProperties":false}'),
]


def op1(spark, sf_dir: str) -> DataFrame:
    """Calls and results of all conversations, linked, ordered, validated and as canonical JSON."""
    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, schema string")
    out = link(calls, results, schemas)
    return out.select("conv_id", "call_id", "turn", "status", "level", "position", "valid", F.array_join("errors", "; ").alias("errors"), "json")


#: the same in SQL; one level of waiting a message, so a level is one more than that of the message before
SQL = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, substr(md5(coalesce(text, '')), 1, 1) >= '8' AS odd FROM conversations
), args AS (
  SELECT *, 'call_' || turn AS call_id,
    '{' || concat_ws(',', CASE WHEN odd AND text IS NOT NULL THEN '"lines":' || len(string_split(text, chr(10))) END, '"text":' || to_json(text)::VARCHAR, '"turn":"' || turn || '"') || '}' AS arguments,
    CASE WHEN turn > 0 AND NOT odd THEN 'call_' || (turn - 1) END AS wait,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS copy
  FROM m
), calls AS (SELECT * FROM args WHERE copy = 1 AND conv_id IS NOT NULL AND call_id IS NOT NULL
), answers AS (
  SELECT conv_id, 'call_' || (turn - 1) AS call_id, turn, text AS content FROM m
), first_answer AS (
  SELECT * FROM answers WHERE conv_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, content NULLS FIRST) = 1
), lev AS (
  SELECT c.conv_id, c.call_id, 0 AS level FROM calls c WHERE c.wait IS NULL OR NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.wait)
  UNION ALL
  SELECT c.conv_id, c.call_id, l.level + 1 FROM lev l JOIN calls c ON c.conv_id = l.conv_id AND c.wait = l.call_id
), placed AS (
  SELECT c.*, l.level, row_number() OVER (PARTITION BY c.conv_id ORDER BY l.level, c.turn, c.call_id) - 1 AS position,
    a.conv_id IS NOT NULL AS answered, a.content,
    CASE WHEN c.wait IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.wait) THEN 'waits for unknown ' || c.wait END AS lost,
    odd AND text IS NOT NULL AS lines
  FROM calls c JOIN lev l USING (conv_id, call_id) LEFT JOIN first_answer a USING (conv_id, call_id)
), judged AS (
  SELECT *, concat_ws('; ', CASE role
      WHEN 'user' THEN CASE WHEN text IS NULL THEN 'missing text' END
      WHEN 'assistant' THEN nullif(concat_ws('; ', CASE WHEN NOT lines THEN 'missing lines' END, CASE WHEN text IS NULL THEN 'missing text' END), '')
      WHEN 'system' THEN concat_ws('; ', 'type turn', CASE WHEN lines THEN 'unknown lines' END)
      ELSE 'no schema' END, lost) AS errors
  FROM placed
)
SELECT conv_id, call_id, turn, CASE WHEN answered THEN 'linked' ELSE 'unanswered' END AS status, level, position, errors = '' AS valid, errors,
  '{"after":[' || coalesce('"' || wait || '"', '') || '],"arguments":' || arguments || ',"id":"' || call_id || '","name":' || coalesce(to_json(role)::VARCHAR, 'null')
    || ',"position":' || position || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM judged
UNION ALL SELECT conv_id, call_id, turn, CASE WHEN conv_id IS NULL OR call_id IS NULL THEN 'unanswered' ELSE 'duplicate' END AS status, NULL, NULL, false,
  CASE WHEN conv_id IS NULL OR call_id IS NULL THEN 'unanswered' ELSE 'duplicate' END, NULL FROM args WHERE copy > 1 OR conv_id IS NULL OR call_id IS NULL
UNION ALL SELECT a.conv_id, a.call_id, a.turn, 'orphan', NULL, NULL, false, 'orphan', NULL FROM answers a
  WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = a.conv_id AND c.call_id = a.call_id)
"""
