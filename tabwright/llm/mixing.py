"""Mixing sources to target weights with a low-discrepancy schedule of slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabwright.llm.common import WORD, fresh, running_total, sized
from tabwright.session import materialize

# Points of the schedule are i * STEP modulo 2 ** BITS: the golden ratio's fraction as a
# whole number, so that every engine and retry gets the same points.
BITS = 31
STEP = 1_327_217_885
# Cells that a point and the sources' intervals meet by, as a power of two.
CELL_BITS = 12
# Slots that are ranked together.
CHUNK = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"))


def with_targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """Targets of sources (source, source_size): weights 1, 2, 3, repeating, by code point.

    All targets together are all sizes together. A target stops at ``most`` times the size;
    what is over goes to the others by weight. In the order of cap over weight the capped
    sources come first, so running sums find the level at which nobody is above the cap.
    The table has a row per source, and only that table is ordered as a whole.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("sid", F.row_number().over(by_name).cast("long"))
    ranked = ranked.withColumn("weight", (F.col("sid") - 1) % 3 + 1).withColumn("cap", most * F.col("source_size"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    left = ranked.select(
        "*",
        F.row_number().over(by_cap).alias("place"),
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("shares"),
    )
    free = F.col("cap") * F.col("shares") >= F.col("weight") * F.col("rest")
    level = left.withColumn("free", free)
    first = F.min(F.when(F.col("free"), F.col("place"))).over(whole)
    level = level.withColumn("first", first)
    at_first = lambda c: F.max(F.when(F.col("place") == F.col("first"), F.col(c))).over(whole)
    level = level.withColumn("rest_1", at_first("rest")).withColumn("shares_1", at_first("shares"))
    target = F.when(F.col("place") < F.col("first"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * F.col("rest_1")).cast("double") / F.col("shares_1").cast("double")
    )
    return level.select("sid", "source", "source_size", target.alias("target")).withColumn(
        "line", F.least(F.floor(F.col("target") + 0.5), most * F.col("source_size")).cast("long")
    )


def slots_for(sources: DataFrame, block: int) -> DataFrame:
    """The schedule: (slot, sid, rank), ``rank`` being the slot's place among its source's.

    Point i of the golden-ratio sequence falls into one of the intervals that the lines
    cut from [0, 1). A source that the points gave too few slots gets the missing ones, a
    handful, at the end; slots beyond a source's need are left out.
    """
    spark = sources.sparkSession
    ordered = W.orderBy("sid")
    total = F.sum("line").over(W.partitionBy())
    reach = F.sum("line").over(ordered.rowsBetween(W.unboundedPreceding, 0))
    at = lambda c: F.floor(c.cast("double") / total * (1 << BITS)).cast("long")
    spans = sources.filter("line > 0").select(
        "sid", F.ceil(F.col("line") / F.lit(block)).cast("long").alias("need"), at(reach - F.col("line")).alias("lo"), at(reach).alias("hi")
    )
    shift = BITS - CELL_BITS
    cells = spans.filter("lo < hi").withColumn(
        "cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift)))
    )
    n = spans.agg(F.sum("need")).first()[0] or 0
    points = spark.range(n).select(
        F.col("id").alias("slot"), ((F.col("id") % (1 << BITS)) * STEP % (1 << BITS)).alias("point")
    )
    drawn = (
        points.withColumn("cell", F.shiftright("point", shift))
        .join(cells, "cell")
        .filter("point >= lo and point < hi")
        .select("sid", "slot", (F.col("slot") / CHUNK).cast("long").alias("chunk"), F.lit(1).alias("one"))
    )
    ranked = running_total(drawn, ["sid"], "chunk", [F.col("slot")], "one", "rank").select("slot", "sid", "rank")
    got = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("got"))
    late = (
        spans.join(got, "sid", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .filter("got < need")
        .withColumn("rank", F.explode(F.sequence("got", F.col("need") - 1)))
        .select((F.lit(n) + F.col("rank")).alias("slot"), "sid", "rank")
    )
    used = ranked.join(spans.select("sid", "need"), "sid").filter("rank < need").drop("need")
    return used.unionByName(late)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = 2048,
    seed: int = 7,
    most: int = 3,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, sources and the mixture of a corpus.

    A source's documents stand in the order of a seeded hash on a line of words that is
    read again from the start, up to ``most`` times. The line is cut into blocks of
    ``block`` words, and the schedule's slot of rank r takes block r. Returns

    * documents: sid, doc_id, size, place (first word on the line; null without words);
    * sources: sid, source, source_size, target, line (words that the mix takes);
    * mixture: slot, sid, doc_id, place, first_word, n_words, one row per piece of a document
      in a slot. Read by slot, it is the mixed stream.

    Null text has no words, and a null source is a source of its own, the last. Documents
    without words are in no slot. Rows that share an id are told apart by their place.
    """
    d = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")
    )
    counted = materialize(d.withColumn("key", shuffle_key(F.col("doc_id"), seed)), "mix-sizes")
    sources = materialize(with_targets(counted.groupBy("source").agg(F.sum("size").alias("source_size")), most), "mix-sources")
    # A stretch of the hash order holds about a thousand documents.
    digits, n = 1, counted.count()
    while 16**digits * 1000 < n:
        digits += 1
    named = sources.select("sid", F.col("source").alias("_source"))
    rows = counted.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("stretch", F.substring("key", 1, digits))
    placed = running_total(rows, ["sid"], "stretch", [F.col("key"), F.col("size"), F.col("doc_id")], "size", "place")
    documents = materialize(
        placed.select("sid", "doc_id", "size", F.when(F.col("size") > 0, F.col("place")).alias("place")), "mix-documents"
    )
    rounds = (
        documents.filter("size > 0")
        .join(sources.filter("line > 0").select("sid", "source_size", "line"), "sid")
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.floor((F.col("line") - 1) / F.col("source_size")).cast("int"))))
        .withColumn("start", F.col("round") * F.col("source_size") + F.col("place"))
        .withColumn("end", F.least(F.col("start") + F.col("size"), F.col("line")))
        .filter("start < end")
    )
    pieces = rounds.withColumn(
        "rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)))
    )
    first = F.greatest(F.col("start"), F.col("rank") * block)
    last = F.least(F.col("end"), (F.col("rank") + 1) * block)
    pieces = pieces.select(
        "sid", "rank", "doc_id", "place", (first - F.col("start")).alias("first_word"), (last - first).alias("n_words")
    )
    mixture = slots_for(sources, block).join(pieces, ["sid", "rank"]).select(
        "slot", "sid", "doc_id", "place", "first_word", "n_words"
    )
    return documents, sources, mixture


def taken(documents: DataFrame, sources: DataFrame, mixture: DataFrame) -> DataFrame:
    """What the mixture takes of each document: doc_id, size, source_size, target, taken."""
    used = mixture.groupBy("sid", "place").agg(F.sum("n_words").alias("words"))
    return (
        documents.join(sources.select("sid", "source_size", "target"), "sid")
        .join(used, ["sid", "place"], "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))
    )


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """Rows of ``docs`` as often as the mixture takes them, to the nearest whole number.

    Rows that share an id share its average, so that rows are not mistaken for each other.
    """
    per_row = taken(*mix(docs, id_col=id_col, **settings))
    key, times, turn = fresh(docs, "_id", "_times", "_turn")
    copies = materialize(
        per_row.groupBy(F.col("doc_id").alias(key))
        .agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share"))
        .select(key, F.floor(F.col("share") + 0.5).cast("int").alias(times))
        .filter(F.col(times) > 0),
        "mix-copies",
    )
    joined = docs.join(sized(copies), F.col(id_col).eqNullSafe(F.col(key)))
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(key, times, turn)


SQL = r"""
with d as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
           md5('7:' || coalesce(cast(doc_id as varchar), 'null')) as key
    from documents),
s as (
    select source, cast(sum(size) as bigint) as source_size,
           (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight,
           row_number() over (order by source nulls last) as sid
    from d group by source),
o as (
    select *, 3 * source_size as cap, row_number() over w as place,
           sum(source_size) over () - coalesce(sum(3 * source_size) over (w rows between unbounded preceding and 1 preceding), 0) as rest,
           sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0) as shares
    from s window w as (order by cast(3 * source_size as double) / weight, sid)),
f as (select * from o where cap * shares >= weight * rest order by place limit 1),
t as (
    select o.source, o.source_size,
           case when o.place < f.place then cast(o.cap as double)
                else cast(o.weight * f.rest as double) / cast(f.shares as double) end as target
    from o, f),
l as (select *, least(cast(floor(target + 0.5) as bigint), 3 * source_size) as line from t),
p as (
    select d.doc_id, d.size, l.source_size, l.target, l.line,
           cast(coalesce(sum(d.size) over (partition by l.source order by d.key, d.size, d.doc_id
               rows between unbounded preceding and 1 preceding), 0) as bigint) as place
    from d join l on d.source is not distinct from l.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       case when source_size = 0 then 0 else
       cast(line // source_size * size + greatest(0, least(place + size, line % source_size) - place) as bigint) end as taken
from p
"""
