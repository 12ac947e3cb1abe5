"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

Each source has a target number of words. All documents of a source share one
expected number of copies, target / source size. Its whole part is certain; the
fractions are rounded by the pivotal method: two fractional documents exchange mass
(fraction x size) in a random direction, without bias, until one is integral; the
other goes on to the next document. So a source's expected words stay what they are
in every step, and only the one fraction that is left at the root is rounded on its own,
to the nearest. What that adds or lacks is given back in change: of every size class of
the source at most four documents are at hand, and from the largest on each one whose
turning (taken once more or once less, between the same whole numbers) brings the source
nearer to its target is turned.

The order of the exchanges is a reduction tree. Documents are dealt into blocks of
about ``BLOCK`` by source, size class and hash; each block is folded by one
``aggregate`` call and leaves at most one fractional document; ``BLOCK`` of those make
a block of the next level, and at last the classes of a source are folded, large
sizes first, so that what is left over is small. No block grows with a source.

Defined results: a null text has size 0 and takes 0 words; a null source is a source
of its own, last in order; repeated rows are rounded one by one; very long texts count whole;
an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import cut, fresh_names, row_order

#: Fractional documents that one fold takes on average.
BLOCK = 64
#: A document is taken at most so often.
MAX_REPEAT = 3
WORD = r"[^\x20\x09-\x0D]+"
ITEM = "struct<p:double,size:double,doc_id:bigint,ord:int>"
DONE = "array<struct<doc_id:bigint,ord:int,size:double,bit:int>>"
STATE = f"struct<carry:{ITEM},done:{DONE}>"


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size`` -> the same with ``target``.

    Weights 1, 2, 3, 1, ... by code point order, nulls last. A target above
    ``max_repeat`` times its source is cut to that and the excess reshared by weight.
    In the order of cap / weight, the level (what is left by weight, once all before are
    cut) rises to its largest value just at the first source that isn't cut.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy(F.expr("cap / weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    return (
        sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
        .withColumn("cap", (max_repeat * F.col("source_size")).cast("double"))
        .withColumn("left_mass", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.max(F.expr("left_mass / left_weight")).over(every))
        .select("source", "source_size", F.greatest(F.lit(0.0), F.least("cap", F.expr("weight * level"))).alias("target"))
    )


def _uniform(seed: int, level: int) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "ord"), F.lit(1 << 30)) + 0.5) / float(1 << 30)


def _exchange(acc: Column, x: Column) -> Column:
    """One pivotal step between the carried document a and the next document b."""
    a, b = acc["carry"], x
    into_a = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
    into_b = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
    up = x["u"] * (into_a + into_b) < into_b
    room_a_binds = (1 - a["p"]) * a["size"] <= b["p"] * b["size"]
    mass_a_binds = a["p"] * a["size"] <= (1 - b["p"]) * b["size"]
    a_done = F.when(up, room_a_binds).otherwise(mass_a_binds)
    bit = F.when(up, room_a_binds).otherwise(~mass_a_binds)
    moved = F.when(up, into_a).otherwise(-into_b)
    item = lambda who, p: F.struct(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"), who["size"].alias("size"), who["doc_id"].alias("doc_id"), who["ord"].alias("ord")
    ).cast(ITEM)
    done = lambda who: F.struct(who["doc_id"], who["ord"], who["size"], bit.cast("int"))
    new_carry = F.when(a_done, item(b, b["p"] - moved / b["size"])).otherwise(item(a, a["p"] + moved / a["size"]))
    first = F.struct(item(b, b["p"]), acc["done"]).cast(STATE)
    later = F.struct(new_carry, F.concat(acc["done"], F.array(F.when(a_done, done(a)).otherwise(done(b))).cast(DONE))).cast(STATE)
    return F.when(a.isNull(), first).otherwise(later)


def _fold(items: DataFrame, keys: list[str], seed: int, level: int) -> DataFrame:
    """Items (keys, p, size, doc_id, ord, rank) -> keys, carry, done. One row per block."""
    one = F.struct("rank", _uniform(seed, level).alias("u"), "p", "size", "doc_id", "ord")
    start = F.expr(f"cast(named_struct('carry', null, 'done', array()) as {STATE})")
    grouped = items.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("items"))
    return grouped.select(*keys, F.aggregate("items", start, _exchange).alias("state")).select(*keys, "state.carry", "state.done")


def _change(acc: Column, x: Column) -> Column:
    after = acc["over"] + F.when(x["bit"] == 1, -x["size"]).otherwise(x["size"])
    turn = F.abs(after) < F.abs(acc["over"])
    return F.when(turn, F.struct(after.alias("over"), F.concat(acc["turned"], F.array(x)).alias("turned"))).otherwise(acc)


def _give_change(bits: DataFrame, left: DataFrame, seed: int) -> DataFrame:
    """Turn a few documents so that what the last rounding added to a source (p x size, signed) goes away."""
    one, mark = F.struct("size", "bit", "doc_id", "ord"), F.xxhash64(F.lit(seed), "doc_id", "ord")
    hand = bits.groupBy("source", F.floor(F.log2("size")).alias("class"), "bit").agg(F.min_by(one, mark).alias("x"), F.max_by(one, mark).alias("y"))
    hand = hand.select("source", F.explode(F.array_distinct(F.array("x", "y"))).alias("x")).groupBy("source").agg(F.sort_array(F.collect_list("x"), asc=False).alias("hand"))
    owed = left.select(F.col("source").alias("s"), (F.col("p") * F.col("size")).alias("over"))
    start = F.expr("struct(over as over, cast(array() as array<struct<size:double,bit:int,doc_id:bigint,ord:int>>) as turned)")
    turned = hand.join(owed, F.expr("source <=> s")).select("source", F.explode(F.aggregate("hand", start, _change)["turned"]).alias("x"))
    turned = cut(turned.select(F.col("source").alias("ts"), F.col("x.doc_id").alias("td"), F.col("x.ord").alias("to")), "turned")
    joined = bits.join(turned, F.expr("source <=> ts and doc_id <=> td and ord = to"), "left")
    return joined.select("source", "doc_id", "ord", "size", F.when(F.col("to").isNull(), F.col("bit")).otherwise(1 - F.col("bit")).alias("bit"))


def mix_sizes(sized: DataFrame, seed: int = 7, block: int = BLOCK, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``doc_id, source, size`` -> ``doc_id, ord, source, size, source_size, target, copies``; one row per row."""
    spread = Window.partitionBy("doc_id", "source", "size").orderBy(F.lit(0))
    base = cut(
        sized.select("doc_id", F.col("source").cast("string").alias("source"), F.col("size").cast("double").alias("size"))
        .withColumn("ord", F.row_number().over(spread).cast("int"))
        .withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int")),
        "sized",
    )
    counts = cut(base.groupBy("source", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "classes")
    goal = cut(targets(counts.groupBy("source").agg(F.sum("words").cast("bigint").alias("source_size")), max_repeat), "targets")
    # one row per source and size class: read back, so Spark broadcasts it while it is small
    cells = counts.join(goal, counts["source"].eqNullSafe(goal["source"])).select(
        counts["source"], "class", F.ceil(F.col("n") / block).alias("blocks"), F.expr("coalesce(try_divide(target, source_size), 0D)").alias("rate")
    )
    largest = counts.agg(F.max("n")).first()[0]
    items = (
        base.alias("d")
        .join(cells.alias("c"), F.expr("d.source <=> c.source and d.class = c.class"))
        .where("d.size > 0")
        .select("d.source", "d.class", "d.size", "d.doc_id", "d.ord", F.expr("rate - floor(rate)").alias("p"), F.pmod(F.xxhash64(F.lit(seed), "doc_id", "ord"), F.col("blocks")).alias("block"))
        .withColumn("rank", F.xxhash64(F.lit(seed + 1), "doc_id", "ord"))
    )
    keys, rounded, level = ["source", "class", "block"], [], 0
    levels = 1 + max(0, math.ceil(math.log(max(1, math.ceil((largest or 1) / block)), block) - 1e-9))
    for level in range(levels + 1):
        last = level == levels
        folded = cut(_fold(items, ["source"] if last else keys, seed, level), f"fold{level}")
        rounded.append(folded.select("source", F.explode("done").alias("x")).select("source", "x.doc_id", "x.ord", "x.size", "x.bit"))
        carried = folded.where("carry is not null").select("source", "carry.*", *([] if last else ["class", "block"]))
        if last:
            rounded.append(carried.select("source", "doc_id", "ord", "size", (F.col("p") >= 0.5).cast("int").alias("bit")))
        elif level < levels - 1:
            items = carried.withColumn("block", F.floor(F.col("block") / block)).withColumn("rank", F.xxhash64(F.lit(level), "doc_id", "ord"))
        else:
            items = carried.withColumn("rank", -F.col("class").cast("bigint"))
    bits = rounded[0]
    for more in rounded[1:]:
        bits = bits.unionByName(more)
    bits = _give_change(bits, carried.select("source", ((F.col("p") >= 0.5).cast("double") - F.col("p")).alias("p"), "size"), seed)
    bits = bits.unionByName(base.where("size <= 0").select("source", "doc_id", "ord", "size", F.lit(0).alias("bit")))
    rate = F.expr("coalesce(try_divide(target, source_size), 0D)")
    return bits.alias("b").join(goal.alias("g"), F.expr("b.source <=> g.source")).select(
        "doc_id", "ord", "b.source", F.col("size").cast("bigint").alias("size"), "source_size", "target", (F.floor(rate) + F.col("bit")).cast("int").alias("copies")
    )


def word_count(df: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(df[text].cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Documents -> ``doc_id, size, source_size, target, copies, taken, source``, one row per document."""
    sized = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["source"], word_count(docs).alias("size"))
    return mix_sizes(sized, **options).select(
        "doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"), "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), "copies", "source", "ord"
    )


def take_copies(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Documents that hold no word count as taken once, since they weigh nothing. Rows that share
    doc_id, source and size are told by their other columns, alike in every run.
    """
    names = docs.columns
    size, nth, id_, source, words, number, copies, one = fresh_names(docs, 8)
    keyed = docs.withColumn(size, word_count(docs))
    keyed = keyed.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", "source", size).orderBy(row_order(docs))))
    plan = mix(docs, **options).where("copies > 0 or size = 0")
    plan = plan.select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("size").alias(words), F.col("ord").alias(number), F.greatest("copies", F.lit(1)).alias(copies))
    joined = keyed.join(plan, F.expr(f"doc_id <=> {id_} and source <=> {source} and {size} = {words} and {nth} = {number}"))
    return joined.select(*[F.col(f"`{n}`") for n in names], F.explode(F.sequence(F.lit(1), copies)).alias(one)).drop(one)
