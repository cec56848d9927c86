"""Mixing sources to target weights by entropy balancing (operator 6), DataFrame functions only.

Document i of source s gets a rate r_i. The rates stay as close as possible (in
entropy) to one copy of everything, subject to one token constraint per source:
sum of r_i * size_i over s equals the target of s, with r_i at most ``CAP``. The
convex dual has one multiplier per source and exponentially tilted rates,
r_i = min(CAP, exp(lambda_s * z_i)), z_i = size_i / (token-weighted mean size of s).
Newton's method solves it: each iteration is one distributed aggregation over
the distinct (source, size) pairs (documents of one size share their rate),
safeguarded by a bracket around every multiplier.

Rates become copies: floor(r_i), and one more for some documents so that the
source's words come out at its target. Per source and size class (a factor of
2^(1/4)) the number of extra copies is fixed from the largest class to the
smallest, each class taking over what the classes before left open; inside a
class a keyed race picks the documents in proportion to the fraction of their
rate. A class is split into salts of about ``SALT_ROWS`` documents, so that no
hot source is ranked in one task. Rows of one id, size and source are ranked as
one row with their number, so that a repeated or null id is never ranked row by row.

Everything is a function of the rows and fixed constants: reruns agree. Cases:
null text has size 0 (taken 0, one copy); null source is a source of its own,
last in order; repeated rows are separate documents; without any words every
target is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dumpwise.llm.common import staged

CAP = 3
TOLERANCE = 1e-9
ITERATIONS = 60  # Newton needs about 8; the bracket halves otherwise
SALT_ROWS = 1_000
SMALL_BYTES = 8 << 20  # per-source tables are broadcast up to this size
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str = "text") -> Column:
    """Words of a whole text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size``: words of the whole text (null: 0)."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))


def targets(sized: DataFrame, weights: Column | None = None) -> DataFrame:
    """Per source: its words and its target.

    Sources in code point order (null last) weigh 1, 2, 3, repeating, unless
    ``weights`` gives another expression over ``source`` and ``place``. A target
    stops at CAP times the source's words and the excess goes to the others by
    weight: target = min(cap, level * weight) for the level at which the targets
    add up to all words. The windows run over one row per source (a label; a few
    hundred bytes each), in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weigh = weights if weights is not None else (F.pmod(F.col("place") - 1, F.lit(3)) + 1)
    total = F.sum("source_size").over(Window.partitionBy())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") ** 2).alias("squares"))
    per = per.withColumn("place", place).withColumn("weight", weigh.cast("double")).withColumn("all", total).withColumn("cap", F.col("source_size") * F.lit(float(CAP)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("all") - full) / open_weight).withColumn("nth", F.row_number().over(order))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct("nth", "level"))).over(Window.partitionBy())["level"]
    return per.withColumn("target", F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))).select("source", "source_size", "squares", "target")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a per-source table if its measured size is within the bound; else Spark joins as it sees fit."""
    size = df.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 96)).first()[0] or 0
    return F.broadcast(df) if size <= SMALL_BYTES else df


def _rate(multiplier: Column, z: Column) -> Column:
    return F.when(multiplier * z >= math.log(CAP), F.lit(float(CAP))).otherwise(F.exp(F.least(multiplier * z, F.lit(2.0))))


def solve(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """``source, source_size, target, mean, multiplier`` by distributed Newton iterations."""
    counts = staged(sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    mean = F.when(F.col("source_size") > 0, F.col("squares") / F.col("source_size")).otherwise(1.0)
    state = staged(
        per_source.select("source", "source_size", "target", mean.alias("mean"))
        .withColumn("full", F.col("target") >= F.col("source_size") * CAP * (1 - 1e-12))
        .withColumn("multiplier", F.when(F.col("full"), F.col("mean") * 2 * math.log(CAP)).otherwise(F.lit(0.0)))
        .withColumn("low", F.lit(-1.0e6)).withColumn("high", F.col("mean") * 2 * math.log(CAP))
        .withColumn("done", F.col("full") | (F.col("source_size") == 0)),
        "mix-state-0",
    )
    for k in range(1, ITERATIONS + 1):
        if not state.where("not done").limit(1).count():
            break
        todo = state.where("not done").alias("s")
        z = F.col("size") / F.col("s.mean")
        r = _rate(F.col("s.multiplier"), z)
        words = F.col("n") * F.col("size")
        sums = (
            counts.alias("c").join(_small(todo), F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("g_source")).agg(F.sum(words * r).alias("got"), F.sum(F.when(r < CAP, words * z * r).otherwise(0.0)).alias("slope"))
        )
        new = state.join(sums, F.col("source").eqNullSafe(F.col("g_source")), "left")
        error = F.col("got") - F.col("target")
        low = F.when(error < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("multiplier")).otherwise(F.col("high"))
        # Newton on the logarithm of the words taken, which is nearly linear in the multiplier
        step = F.col("multiplier") - (F.log("got") - F.log("target")) * F.col("got") / F.when(F.col("slope") > 0, F.col("slope"))
        inside = step.isNotNull() & (step > F.col("new_low")) & (step < F.col("new_high"))
        close = F.abs(error) <= F.col("target") * TOLERANCE
        state = staged(
            new.withColumn("new_low", low).withColumn("new_high", high)
            .select(
                "source", "source_size", "target", "mean", "full",
                F.when(F.col("done") | close, F.col("multiplier")).when(inside, step).otherwise((F.col("new_low") + F.col("new_high")) / 2).alias("multiplier"),
                F.when(F.col("done"), F.col("low")).otherwise(F.col("new_low")).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(F.col("new_high")).alias("high"),
                (F.col("done") | F.coalesce(close, F.lit(True))).alias("done"),
            ),
            f"mix-state-{k}",
        )
    # rounded, so that the order in which partial sums arrive leaves no trace in the rates
    return state.select("source", "source_size", "target", "mean", F.round("multiplier", 9).alias("multiplier"))


def _size_class(size: Column) -> Column:
    return F.when(size <= 32, size).otherwise(F.lit(12) + F.floor(F.log2(size.cast("double")) * 4)).cast("int")


def _allot(classes: DataFrame) -> DataFrame:
    """Extra copies per source and size class, from the largest class down, with the open rest carried on.

    The array per source has one entry per size class: at most 32 + 4 * 63.
    """
    rows = F.array_sort(F.collect_list(F.struct((-F.col("class")).alias("order"), "n", "words", "wanted")))
    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<struct<class: int, n: bigint, k: bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        mean = x["words"] / x["n"]
        want = x["wanted"] + acc["carry"]
        k = F.greatest(F.lit(0), F.least(x["n"], F.floor(want / mean + 0.5))).cast("long")
        one = F.array(F.struct((-x["order"]).cast("int").alias("class"), x["n"].alias("n"), k.alias("k")))
        return F.struct((want - k * mean).alias("carry"), F.concat(acc["out"], one).alias("out"))

    done = classes.groupBy("source").agg(rows.alias("rows")).withColumn("r", F.explode(F.aggregate("rows", start, step)["out"]))
    return done.select("source", F.col("r.class").alias("class"), F.col("r.n").alias("n"), F.col("r.k").alias("k"))


def _unit(key: Column, seed: str) -> Column:
    """A keyed uniform number in (0, 1)."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(2**52)).cast("double") + 0.5) / float(2**52)


def _rows_again(dealt: DataFrame) -> DataFrame:
    """``c`` rows for each row, the first ``lucky`` of them with one more copy.

    A row that stands for more than SALT_ROWS is cut into spans first, which are dealt to all tasks.
    """
    many = F.col("c") > SALT_ROWS
    spans = F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(SALT_ROWS).cast("long"))
    last = F.least(F.col("c"), F.col("from") + SALT_ROWS)
    hot = dealt.where(many).withColumn("from", F.explode(spans)).withColumn("upto", last).repartition("doc_id", "size", "from")
    rest = dealt.where(~many).withColumn("from", F.lit(0).cast("long")).withColumn("upto", F.col("c"))
    nth = F.explode(F.sequence(F.col("from") + 1, F.col("upto")))
    return rest.unionByName(hot).withColumn("nth", nth).withColumn("copies", F.col("base") + (F.col("nth") <= F.col("lucky")).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", weights: Column | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, rate`` for every document."""
    sized = staged(sizes(docs, id_col, text_col, source_col), "mix-docs")
    solved = solve(sized, targets(sized, weights)).withColumnRenamed("source", "s_source")
    rate = _rate(F.col("multiplier"), F.col("size") / F.col("mean"))
    rated = (
        sized.join(_small(solved.withColumnRenamed("s_source", "source")).withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source")))
        .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(1.0))).withColumn("base", F.floor(F.col("rate") + 1e-9).cast("long"))
        .withColumn("part", F.greatest(F.lit(0.0), F.col("rate") - F.col("base"))).withColumn("class", _size_class(F.col("size")))
        .drop("s_source", "mean", "multiplier")
    )
    rated = staged(rated, "mix-rates")
    # Rows of one id, size and source cannot be told apart: one row with their number stands for them until the copies are fixed.
    kinds = rated.where("part > 0").groupBy("doc_id", "size", "source", "source_size", "target", "rate", "base", "part", "class").agg(F.count(F.lit(1)).alias("c"))
    open_ = staged(kinds, "mix-open")
    classes = open_.groupBy("source", "class").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("size")).alias("words"), F.sum(F.col("c") * F.col("part") * F.col("size")).alias("wanted"))
    allotted = staged(_allot(classes).withColumn("salts", F.ceil(F.col("n") / SALT_ROWS).cast("long")), "mix-classes")
    a = _small(allotted).select(F.col("source").alias("a_source"), F.col("class").alias("a_class"), "n", "k", "salts")
    salted = open_.join(a, F.col("source").eqNullSafe(F.col("a_source")) & (F.col("class") == F.col("a_class"))).withColumn("salt", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("salts")))
    per_salt = salted.groupBy("source", "class", "salt", "n", "k").agg(F.sum("c").alias("m"))
    upto = F.sum("m").over(Window.partitionBy("source", "class").orderBy("salt"))
    share = lambda m: F.floor(F.col("k") * m / F.col("n") + 0.5)
    per_salt = per_salt.select(F.col("source").alias("p_source"), F.col("class").alias("p_class"), F.col("salt").alias("p_salt"), (share(upto) - share(upto - F.col("m"))).alias("extra"))
    race = -F.log(_unit(F.struct("doc_id", "size"), seed)) / F.col("part")
    in_order = Window.partitionBy("source", "class", "salt").orderBy(race, "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = salted.withColumn("before", F.sum("c").over(in_order) - F.col("c"))
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("class") == F.col("p_class")) & (F.col("salt") == F.col("p_salt"))
    lucky = F.greatest(F.lit(0).cast("long"), F.least(F.col("c"), F.col("extra") - F.col("before")))
    columns = ["doc_id", "size", "source_size", "target", "rate", "copies"]
    dealt = staged(ranked.join(per_salt, same).select(*columns[:-1], "base", "c", lucky.alias("lucky")), "mix-dealt")
    every = _rows_again(dealt).select(columns).unionByName(rated.where("part <= 0").withColumn("copies", F.col("base")).select(columns))
    return every.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")
