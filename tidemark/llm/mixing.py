"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

1. *Targets.* ``total`` times all words are shared among the sources by weight. A
   source takes ``limit`` times its words at most; the excess goes to the others by
   weight until none is above. With the sources in order of words per weight
   this is a running sum, one row per source.
2. *Dual.* Per source, the rates nearest to 1 in entropy, between 0 and ``limit``, that
   give the target are ``limit / (1 + (limit - 1) * exp(-lam * size))``: exponentially tilted, with one
   multiplier per source. Newton iterations on the convex dual find it. Each is
   one grouped sum over (source, size) classes, with a bracket around the root
   as a safeguard. A source at its limit has rate ``limit``.
3. *Copies.* Documents of one source and size have one rate. Along the sizes
   of a source, largest first, the rounded running sum of the rates gives whole copies
   per class, short of the target by less than the largest document. The rest is
   filled from at most ``FILL_CLASSES`` classes per power of two of the size. The documents of a
   class are numbered inside (source, size, salt) groups, with group offsets, so
   that a class with a third of all rows is split over tasks.

Everything is a function of the rows, so reruns agree.

Defined results: a null or empty text has size 0 and takes 0 words (it still
gets copies by its rate). Sources are ordered by code point, a null source is a source of its own
and last. A source without words has target 0. Repeated rows count each;
of equal rows it is open which one gets the odd copy. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, sf_table, stash

WEIGHTS, WORD = (5.0, 2.0, 1.0), r"[^\x20\x09-\x0D]+"
MAX_ROUNDS, GROUP_ROWS, FILL_CLASSES = 40, 20000, 64


def source_targets(rows: DataFrame, weights=WEIGHTS, total: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, target) per source of (source, size)."""
    # a null source sorts last and joins null-safely
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn % len(weights) + 1).cast("int"))
    sums = sums.withColumn("weight", weight)
    everything = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = everything.rowsBetween(W.unboundedPreceding, -1)
    sums = (
        sums.withColumn("full", limit * F.col("source_size"))
        .withColumn("due", total * F.sum("source_size").over(W.partitionBy()))
        .withColumn("left", F.col("due") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        .withColumn("share", F.col("left") / F.sum("weight").over(everything.rowsBetween(0, W.unboundedFollowing)))
    )
    # the first source in this order that stays under its limit fixes the share per weight of all that follow
    open_ = F.min(F.when(F.col("share") * F.col("weight") <= F.col("full"), F.struct(F.col("full") / F.col("weight"), F.col("share")))).over(W.partitionBy())
    target = F.least("full", F.coalesce(open_["share"], F.col("share")) * F.col("weight"))
    return sums.select("source", "source_size", target.alias("target"))


def _balance(classes: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """(source, lam): the multiplier of each source; null where it is at its limit."""
    scale = F.try_divide(F.sum(F.col("n") * F.col("size") * F.col("size")), F.sum(F.col("n") * F.col("size")))
    state = targets.where("source_size > 0").join(classes.groupBy(F.col("source").alias("s")).agg(scale.alias("scale")), F.col("source").eqNullSafe(F.col("s")))
    part = F.col("target") / (limit * F.col("source_size"))
    state = state.where(part < 1 - 1e-12).select(
        "source", "target", "scale", (F.log(part / (1 - part)) + F.log(F.lit(limit - 1))).alias("lam"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(1.0).alias("miss")
    )
    state = stash(state, "dual")
    rated = classes.withColumnRenamed("source", "s")
    for _ in range(MAX_ROUNDS):
        tilt = F.col("lam") * F.col("size") / F.col("scale")
        rate = _rate(tilt, limit)
        sums = rated.where("size > 0").join(state, F.col("s").eqNullSafe(F.col("source"))).groupBy("source", "target", "scale", "lam", "lo", "hi").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("scale") * rate * (1 - rate / limit)).alias("slope"),
        )
        miss = F.col("target") - F.col("got")
        sums = sums.withColumn("lo", F.when(miss > 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(miss > 0, F.col("hi")).otherwise(F.col("lam")))
        step = F.col("lam") + miss / F.greatest("slope", F.lit(1e-300))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        near = F.abs(miss) <= 1e-10 * F.col("target")
        # outside the bracket: double on an open side, else halve
        apart = F.when(F.col("hi") >= 1e6, F.abs(F.col("lam")) * 2 + 1).when(F.col("lo") <= -1e6, -F.abs(F.col("lam")) * 2 - 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        lam = F.when(near, F.col("lam")).when(inside, step).otherwise(apart)
        state = stash(sums.select("source", "target", "scale", lam.alias("lam"), "lo", "hi", (F.abs(miss) / F.col("target")).alias("miss")), "dual")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= 1e-10:
            break
    return state.select("source", "lam", "scale")


def _rate(tilt, limit: float):
    return limit / (1 + (limit - 1) * F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt))))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = 1.5, limit: int = 2) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of every row of ``docs`` (doc_id, text, source)."""
    with scratch(docs.sparkSession, "mix"):
        rows = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
        rows = stash(rows, "sizes")
        classes = stash(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "classes")
        targets = stash(source_targets(classes.select("source", (F.col("size") * F.col("n")).alias("size")), weights, total, limit), "targets")
        lam = _balance(classes, targets, float(limit)).withColumnRenamed("source", "s")
        by = targets.join(lam, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
        rate = F.when(F.col("source_size") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(float(limit))).otherwise(_rate(F.col("lam") * F.col("size") / F.col("scale"), float(limit)))
        rated = classes.join(by, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rate", rate)
        down = W.partitionBy("source").orderBy(F.desc("size"))
        whole = F.floor(F.sum(F.col("n") * F.col("rate")).over(down.rowsBetween(W.unboundedPreceding, 0)) + 1e-9)
        rated = rated.withColumn("run", whole).withColumn("k", F.col("run") - F.coalesce(F.lag("run").over(down), F.lit(0)))
        rated = stash(rated.withColumn("k", F.least("k", limit * F.col("n"))), "rated")
        # a few classes per power of two of the size, those with most room, fill what is left
        level = W.partitionBy("source", F.floor(F.log2("size"))).orderBy(F.desc("room"), F.desc("size"))
        room = rated.where(f"size > 0 AND k < {limit} * n").withColumn("room", F.col("n") * limit - F.col("k"))
        room = room.withColumn("turn", F.row_number().over(level)).where(F.col("turn") <= FILL_CLASSES)
        room = room.groupBy(F.col("source").alias("s")).agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "room")))).alias("levels"))
        short = rated.groupBy("source").agg((F.floor(F.max("target")) - F.sum(F.col("k") * F.col("size"))).cast("long").alias("short"))
        fill = short.join(room, F.col("source").eqNullSafe(F.col("s"))).select(
            "source",
            F.expr("""aggregate(levels, named_struct('rest', greatest(short, 0L), 'out', cast(array() as array<struct<size:bigint,more:bigint>>)),
                (a, x) -> named_struct('rest', a.rest - least(x.room, a.rest div x.size) * x.size,
                                       'out', concat(a.out, array(named_struct('size', x.size, 'more', least(x.room, a.rest div x.size))))),
                a -> a.out)""").alias("out"),
        )
        fill = fill.select(F.col("source").alias("s"), F.inline("out")).withColumnRenamed("size", "z")
        on = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
        rated = rated.join(fill, on, "left").drop("s", "z").withColumn("k", F.col("k") + F.coalesce("more", F.lit(0)))

        # number the documents of a class: inside salted groups, with the offset of the group
        salts = F.ceil(F.sum("n").over(W.partitionBy("source", "size")) / GROUP_ROWS)
        rated = stash(rated.withColumn("salts", salts).select("source", "size", "n", "source_size", "target", "rate", "k", "salts"), "copies")
        r2 = rated.withColumnsRenamed({"source": "s", "size": "z"})
        on = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
        dealt = rows.join(r2, on).drop("s", "z").withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.col("salts")))
        group = ["source", "size", "salt"]
        offsets = dealt.groupBy(group).count().withColumn(
            "before", F.sum("count").over(W.partitionBy("source", "size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
        ).select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("salt").alias("t"), F.coalesce("before", F.lit(0)).alias("before"))
        numbered = dealt.withColumn("number", F.row_number().over(W.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id")) - 1)
        numbered = numbered.join(offsets, on & (F.col("salt") == F.col("t")))
        number = F.col("number") + F.col("before")
        copies = F.floor(F.col("k") / F.col("n")) + F.when(number < F.col("k") % F.col("n"), 1).otherwise(0)
        out = numbered.withColumn("copies", copies.cast("int")).select(
            "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
        )
        return stash(out, "mix", keep=True)


def apply_mix(docs: DataFrame, weights=WEIGHTS, total: float = 1.5, limit: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its copies say."""
    key = ["doc_id", "source", "size"]
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", "source", size.alias("size"))
    # rows that share id, source and size are told apart by number
    whole = whole.withColumn("nth", F.row_number().over(W.partitionBy(key).orderBy("row.text")))
    copies = mix(docs, weights, total, limit).select(*(F.col(k).alias(f"{k}_") for k in key), "copies")
    copies = copies.withColumn("nth_", F.row_number().over(W.partitionBy(*(f"{k}_" for k in key)).orderBy(F.desc("copies"))))
    same = F.lit(True)
    for k in [*key, "nth"]:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    joined = whole.join(copies.where("copies > 0"), same)
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    out = mix(sf_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken", "copies", "rate")
