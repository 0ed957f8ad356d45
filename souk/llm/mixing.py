"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every source has a target number of words.  Its documents stand in a shuffled
queue (order: md5 of a seed and the id); a document's virtual finish time is
the cumulative number of words of its source's queue up to and including it,
divided by the source's target.  Sorting all documents of all sources by
virtual finish time and cutting at the total budget takes from every source in
proportion to its target.  A queue that is shorter than its target starts
again, so a document can be taken up to three times.

No task ever holds a whole source: running totals are made of two parts, a
window inside a slice of the hash range (or of the finish-time range) and a
small table of slice sums.  There are as many slices as keep a slice at
``SLICE_ROWS`` rows.  Different texts under one id stand together in the queue;
their totals are made the same way, in slices of the text's hash.  What comes out is the last place taken in each turn
of each queue; texts are never shuffled.

Defined cases: a null text has size 0; documents of size 0 are never taken
(taken 0); a null id is an id like any other; rows that agree in source, id
and text are queued one by one, and any of them stands for any other; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, running, stash

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
#: slices of the hash range within a source, and of the finish-time range: this many at least, and a slice for so many rows
SLICES, SLICE_ROWS = 1024, 20_000
#: copies of a row that a task makes in a go
CHUNK = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Per source: source_size and target.

    Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3 ...  They
    share the total by weight, but no target exceeds ``MAX_REPEATS`` times its
    source; the excess goes to the others by weight.  With sources in order of
    cap / weight, the level all uncapped sources reach is the largest of
    (total - caps before) / (weights - weights before).
    """
    per = units.groupBy("source").agg(F.sum("words").alias("source_size"))
    # one row per source from here on: a configuration-sized table
    named = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1))
    per = per.withColumn("weight", w.cast("long"))
    before = Window.orderBy(MAX_REPEATS * F.col("source_size").cast("double") / F.col("weight"),
                            F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - MAX_REPEATS * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / rest.cast("double"))
    return per.select("source", "source_size",
                      F.least(MAX_REPEATS * F.col("source_size").cast("double"),
                              F.col("weight") * F.max("level").over(everything)).alias("target"))


def _queue(seed: int, id_: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))).cast("binary"))


def _queued(units: DataFrame, seed: int, slices: int) -> DataFrame:
    """units with queue and upto, the words of their source's queue up to and with them: by (queue, id, hash, size)."""
    ids = units.groupBy("source", "id").agg(F.sum("words").alias("words"), F.count("*").alias("units"), *[F.max(c).alias(c) for c in ("size", "hash", "copies")])
    ids = ids.withColumn("queue", _queue(seed, F.col("id")))
    ids = ids.withColumn("slice", F.floor(F.conv(F.substring("queue", 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32)))
    ids = stash(running(ids, ["source"], "slice", [F.col("queue"), F.col("id").asc_nulls_first()], "words", "upto"), "mix_queue")
    columns = ["source", "id", "size", "hash", "copies", "words", "queue", "upto"]
    one = ids.filter("units = 1").select(*columns)
    many = ids.filter("units > 1").select(F.col("source").alias("_s"), F.col("id").alias("_i"), "queue", (F.col("upto") - F.col("words")).alias("_before"))
    if many.isEmpty():
        return one
    # an id may hold any share of a source's rows: slices of the text's hash, which also is the order within an id
    q = units.join(many, units["source"].eqNullSafe(many["_s"]) & units["id"].eqNullSafe(many["_i"])).drop("_s", "_i")
    q = q.withColumn("slice", F.floor((F.col("hash").cast("double") / float(1 << 64) + 0.5) * slices))
    q = running(q, ["source", "id"], "slice", [F.col("hash"), F.col("size")], "words", "_upto")
    return one.unionAll(q.withColumn("upto", F.col("_before") + F.col("_upto")).select(*columns))


def fair_queue(units: DataFrame, seed: int = 7, weights: tuple[int, ...] = (1, 2, 3), slices: int = SLICES) -> DataFrame:
    """units(source, id, size, hash, copies, words): distinct keys, their number and total words.

    Returns a row for each source: source_size, target, and cuts, the last place
    (queue, id, hash, size) taken in each turn of its queue, MAX_REPEATS at most,
    with the number of its copies that are taken and of all.  As finish times grow
    along a queue, what the budget takes of a turn is all up to that place; so rows
    need no join with each other's plans, only with their source.
    """
    targets = source_targets(units, weights)
    q = _queued(units, seed, slices)
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    q = q.join(t, q["source"].eqNullSafe(t["_s"]), "left").drop("_s")
    turns = F.least(F.lit(MAX_REPEATS), F.ceil(F.col("target") / F.col("source_size"))).cast("int")
    # the copies of a key stand one behind the other; they are made in short runs, dealt to all tasks
    runs = (q.filter("words > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1)))
            .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK))))
            .repartition("source", "queue", "id", "size", "hash", "turn", "run"))
    items = (runs.withColumn("copy", F.explode(F.sequence(F.col("run") * CHUNK + 1, F.least("copies", (F.col("run") + 1) * CHUNK))))
             .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("upto") - F.col("words") + F.col("copy") * F.col("size")).cast("double") / F.col("target"))
             .select("source", "queue", "id", "size", "hash", "copy", "copies", "turn", "finish"))
    # equal slices up to time 1, where the budget ends but for a few documents; beyond it ever longer ones
    items = items.withColumn("slice", F.when(F.col("finish") <= 1, F.floor(F.col("finish") * slices))
                             .otherwise(slices + F.floor(F.log("finish") * slices)).cast("long"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("id").asc_nulls_first(), F.col("size"), F.col("turn"), F.col("hash"), F.col("copy")]
    ranked = running(items, [], "slice", order, "size", "total")
    budget = targets.agg(F.sum("source_size").alias("budget"))
    last = (ranked.crossJoin(F.broadcast(budget)).filter("total <= budget")  # one row
            .groupBy("source", "turn").agg(F.max(F.struct("queue", "id", "hash", "size", "copy", "copies")).alias("last")))
    cuts = last.groupBy(F.col("source").alias("_s")).agg(F.collect_list("last").alias("cuts"))
    return (targets.join(cuts, targets["source"].eqNullSafe(cuts["_s"]), "left")
            .select("source", "source_size", "target", "cuts"))


def mix(docs: DataFrame, seed: int = 7, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", carry: bool = True, slices: int | None = None) -> DataFrame:
    """Every row of docs with its size, its source's size and target, and times taken.

    ``slices`` only says how the running totals are divided (default: by the number of rows); it changes no result.

    Returns columns row (the whole row as a struct, if ``carry``), source, id,
    size, source_size, target, times.
    """
    base = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"),
                       F.xxhash64(F.col(text_col)).alias("_hash"), *([packed(docs, "row")] if carry else []))
    if not carry:  # narrow: counted once, read several times
        base = stash(base, "mix_sizes")
        units = base
    else:
        units = stash(base.drop("row"), "mix_sizes")
    slices = slices or max(SLICES, -(-units.count() // SLICE_ROWS))
    units = (units.groupBy("source", "id", "size", F.col("_hash").alias("hash")).agg(F.count("*").alias("copies"))
             .withColumn("words", F.col("copies") * F.col("size")))
    # written, so that Spark knows its size (a row for each source) when it plans the join
    plan = stash(fair_queue(units, seed, weights, slices), "mix_plan").withColumnRenamed("source", "_s")
    place = F.struct(_queue(seed, F.col("id")).alias("queue"), "id", F.col("_hash").alias("hash"), "size")
    key = lambda c: F.struct(c["queue"].alias("queue"), c["id"].alias("id"), c["hash"].alias("hash"), c["size"].alias("size"))
    cuts = F.coalesce("cuts", F.array())
    rows = base.withColumn("_place", place).join(plan, base["source"].eqNullSafe(plan["_s"]), "left")
    split = lambda c: (c["copy"] < c["copies"])
    gone = ["_s", "cuts", "_place", "_hash"]

    def times(number):
        """How many turns take the row that is the number-th copy of its key."""
        taken = F.filter(cuts, lambda c: (F.col("_place") < key(c)) | ((F.col("_place") == key(c)) & (~split(c) | (number <= c["copy"]))))
        return F.when(F.col("size") > 0, F.size(taken)).otherwise(0)

    if plan.filter(F.exists(cuts, split)).isEmpty():
        return rows.withColumn("times", times(F.lit(1))).drop(*gone)
    # only copies of a key at a cut need a number: counted in slices of rows, as one key may hold any share of them
    among = F.exists(cuts, lambda c: split(c) & (F.col("_place") == key(c)))
    some = stash(rows.filter(among).withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(slices))).withColumn("_one", F.lit(1)), "mix_copies")
    some = some.withColumn("_order", F.lit(0))
    some = running(some, ["source", "id", "size", "_hash"], "_slice", [F.col("_order")], "_one", "_number")
    some = some.withColumn("times", times(F.col("_number"))).drop(*gone, "_slice", "_one", "_order", "_number")
    return rows.filter(~among).withColumn("times", times(F.lit(1))).drop(*gone).unionByName(some)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken."""
    m = mix(docs, **options).filter("times > 0")
    return m.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    """Weighted fair queueing over all documents: what each document gives to the mix."""
    from .common import table
    docs = table(spark, sf_dir, "documents")
    m = mix(docs.select("doc_id", "text", "source"), carry=False)
    return m.select(F.col("id").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    (F.col("times") * F.col("size")).cast("long").alias("taken"))


SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), units AS (
  SELECT source, doc_id, size, (count(*) * size)::BIGINT AS words FROM base GROUP BY source, doc_id, size
), per AS (
  SELECT source, sum(words)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM units GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE AS level
  FROM per
), targets AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), queued AS (
  SELECT u.*, t.source_size, t.target,
    sum(words) OVER (PARTITION BY u.source ORDER BY md5('7:' || coalesce(doc_id::VARCHAR, 'null')), doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT *, (turn * source_size + upto)::DOUBLE / target AS finish
  FROM queued, (VALUES (0), (1), (2)) AS r(turn)
  WHERE words > 0 AND turn < ceil(target / source_size)
), ranked AS (
  SELECT *, sum(words) OVER (ORDER BY finish, source NULLS LAST, doc_id NULLS FIRST, size, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS total FROM items
), taken AS (
  SELECT source, doc_id, size, count(*) AS times FROM ranked WHERE total <= (SELECT sum(source_size) FROM per) GROUP BY source, doc_id, size
)
SELECT b.doc_id, b.size, t.source_size, t.target, (coalesce(k.times, 0) * b.size)::BIGINT AS taken
FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
LEFT JOIN taken k ON b.source IS NOT DISTINCT FROM k.source AND b.doc_id IS NOT DISTINCT FROM k.doc_id AND b.size = k.size
"""
