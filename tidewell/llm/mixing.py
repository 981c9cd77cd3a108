"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by a keyed hash and laid end to end, pass after pass, as a
stream of words. The mix is a sequence of slots. Slot i belongs to the source in whose part of the
cumulative targets the i-th point of the van der Corput sequence falls, so every stretch of
the mix is close to the targets. The slots of a source are ranked, its stream is cut into as
many equal blocks of words, and the r-th slot takes the r-th block.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.storage import write_once

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
SLOT_BITS = 16
CELL_BITS = 12
SEED = 8
COPIES_AT_ONCE = 1000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D; 0 for null."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "w")
    return F.coalesce(F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("bigint")


def row_key(docs: DataFrame) -> Column:
    """128 bits of hash of a whole row, which only rows equal in every column share."""
    cells = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in docs.columns]
    return F.struct(F.xxhash64(*cells), F.xxhash64(F.lit(SEED), *cells))


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = MOST_PASSES,
) -> DataFrame:
    """source, source_size, weight and target, one row per source.

    `sizes` has source and size. Sources in code point order, null last, take `weights` in turn.
    Together they get `share` of all words by weight; none gets more than `passes` times its own,
    and what is above goes to the others by weight, until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    per = write_once(per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn)), "mix-sources")
    total = per.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    wanted = Fraction(share) * total
    # What a source gets per unit of weight rises as others stop; a stopped one never resumes.
    most = F.col("source_size") * passes
    level, stopped = Fraction(0), -1
    while True:
        above = F.col("weight") * F.lit(float(level)) >= most if stopped >= 0 else F.lit(False)
        row = per.agg(
            F.count_if(above).alias("stopped"),
            F.sum(F.when(above, most).otherwise(0)).alias("filled"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row["stopped"] == stopped:
            break
        stopped = row["stopped"]
        if not row["open"]:
            break
        level = (wanted - row["filled"]) / row["open"]
    target = F.least(F.col("weight") * F.lit(float(level)), most.cast("double"))
    return per.withColumn("target", target)


def schedule(targets: DataFrame, slot_bits: int = SLOT_BITS) -> DataFrame:
    """slot, source, block (rank among the source's slots), blocks, start and stop (words of the stream).

    There are 2**slot_bits slots. A source whose part no point meets gets one slot after them, and
    one without target gets none.
    """
    slots = 1 << slot_bits
    by_name = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    upto = F.sum("target").over(by_name.rowsBetween(W.unboundedPreceding, 0))
    parts = targets.filter("round(target) > 0").select(
        F.struct("source").alias("part"),
        F.round("target").cast("bigint").alias("words"),
        (upto - F.col("target")).alias("at"),
        upto.alias("upto"),
    )
    whole = parts.agg(F.max("upto")).first()[0] or 0.0
    # Bits of the slot's number in reverse order, behind the binary point.
    turned = F.conv(F.reverse(F.lpad(F.bin("id"), slot_bits, "0")), 2, 10).cast("double") / F.lit(float(slots))
    points = targets.sparkSession.range(slots, numPartitions=1).select(
        F.col("id").alias("slot"), (turned * whole).alias("at")
    )
    starts = parts.select("at", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("slot"), "part")
    asks = points.select("at", F.lit(1).alias("kind"), "slot", F.lit(None).cast(starts.schema["part"].dataType).alias("part"))
    # The source of a point is the last one that starts at or before it: slots and sources only.
    along = W.orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    met = (
        starts.unionByName(asks)
        .withColumn("part", F.last("part", ignorenulls=True).over(along))
        .filter("kind = 1 AND part IS NOT NULL")
        .select("slot", "part")
    )
    unmet = parts.join(met.select("part").distinct(), "part", "left_anti").select(
        (F.row_number().over(W.orderBy("part")) - 1 + slots).cast("bigint").alias("slot"), "part"
    )
    of_source = W.partitionBy("part")
    ranked = met.unionByName(unmet).select(
        "slot",
        "part",
        (F.row_number().over(of_source.orderBy("slot")) - 1).cast("bigint").alias("block"),
        F.count(F.lit(1)).over(of_source).alias("blocks"),
    )
    base, more = F.floor(F.col("words") / F.col("blocks")).cast("bigint"), F.col("words") % F.col("blocks")
    start = lambda r: r * base + F.least(r, more)
    return ranked.join(parts.select("part", "words"), "part").select(
        "slot",
        "part.source",
        "block",
        "blocks",
        "words",
        start(F.col("block")).alias("start"),
        start(F.col("block") + 1).alias("stop"),
    )


def _block_of(word: Column) -> Column:
    """The block of a word's place, where the first `words % blocks` blocks have one word more."""
    base = F.expr("words div blocks")
    more = F.col("words") % F.col("blocks")
    long = more * (base + 1)
    return F.when(word < long, F.floor(word / (base + 1))).otherwise(
        more + F.floor((word - long) / F.greatest(base, F.lit(1)))
    ).cast("bigint")


def streams(
    sizes: DataFrame, targets: DataFrame, seed: int = SEED, cell_bits: int = CELL_BITS
) -> DataFrame:
    """Adds to id, source, size and row: source_size, target, cell, place and offset, where the document's words
    start in the first pass of its source's stream. (source, cell, place) tells rows apart."""
    # Rows without id are shuffled by what else they hold.
    order = F.when(F.col("id").isNull(), F.xxhash64("row", F.lit(seed))).otherwise(F.xxhash64("id", F.lit(seed)))
    rows = sizes.withColumn("order", order).withColumn(
        "cell", F.shiftrightunsigned("order", 64 - cell_bits).cast("int")
    )
    # Running totals of a source in two steps, so that no task holds all of a large source.
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    cells = cells.alias("c").join(
        targets.select("source", "source_size", "target").alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))
    ).select("c.*", "t.source_size", "t.target")
    here = W.partitionBy("source", "cell").orderBy("order", "id", "size", "row")
    rows = rows.withColumn("place", F.row_number().over(here)).withColumn(
        "inner", F.coalesce(F.sum("size").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    same = F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.cell") == F.col("k.cell"))
    return rows.alias("r").join(cells.alias("k"), same).select(
        "r.id", "r.source", "r.size", "r.row", "k.source_size", "k.target", "r.cell", "r.place",
        (F.col("k.base") + F.col("r.inner")).alias("offset"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = MOST_PASSES,
    slot_bits: int = SLOT_BITS,
    seed: int = SEED,
) -> DataFrame:
    """Which words of which documents every slot of the mix takes.

    One row per piece: slot, block, first and words (the piece's place within its document), pass, and
    of the document id, source, size, row (see `row_key`), source_size, target, cell and place. A document the mix
    does not take has one row without slot and with 0 words. A null text has size 0, null is a source of its
    own, repeated rows are documents of their own, an empty table gives no rows.
    """
    sizes = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        row_key(docs).alias("row"),
    )
    sizes = write_once(sizes, "mix-sizes")
    targets = write_once(source_targets(sizes, weights, share, passes), "mix-targets")
    slots = write_once(schedule(targets, slot_bits), "mix-slots")
    rows = streams(sizes, targets, seed)
    totals = slots.groupBy("source").agg(F.max("words").alias("words"), F.max("blocks").alias("blocks"))
    rows = rows.alias("r").join(
        totals.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")), "left"
    ).select("r.*", "t.words", "t.blocks")
    turns = F.transform(
        F.sequence(F.lit(0), F.lit(passes - 1)),
        lambda p: F.struct(
            p.alias("pass"),
            (F.col("offset") + p * F.col("source_size")).alias("at"),
            F.least(F.col("offset") + p * F.col("source_size") + F.col("size"), F.col("words")).alias("end"),
        ),
    )
    rows = rows.withColumn("turn", F.explode_outer(F.filter(turns, lambda t: t["at"] < t["end"])))
    first, last = _block_of(F.col("turn.at")), _block_of(F.col("turn.end") - 1)
    pieces = rows.withColumn("block", F.explode_outer(F.when(F.col("turn").isNotNull(), F.sequence(first, last))))
    taken = F.least(F.col("s.stop"), F.col("p.turn.end")) - F.greatest(F.col("s.start"), F.col("p.turn.at"))
    same = F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.block") == F.col("s.block"))
    return pieces.alias("p").join(slots.alias("s"), same, "left").select(
        "s.slot",
        "p.block",
        F.col("p.turn.pass").alias("pass"),
        (F.greatest(F.col("s.start"), F.col("p.turn.at")) - F.col("p.turn.at")).alias("first"),
        F.coalesce(taken, F.lit(0)).cast("bigint").alias("words"),
        *[f"p.{c}" for c in ("id", "source", "size", "row", "source_size", "target", "cell", "place")],
    )


def taken_words(pieces: DataFrame) -> DataFrame:
    """One row per document of a mix: id, source, size, source_size, target and taken."""
    document = ["id", "source", "size", "source_size", "target", "cell", "place"]
    return pieces.groupBy(*document).agg(F.sum("words").alias("taken")).drop("cell", "place")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, in the columns of `docs`.

    A document is there once for every pass in which its first word is taken; a document without
    words is there once. Rows that share an id, or have none, are documents of their own. Of rows equal in every
    column only the copies of all together can be told.
    """
    pieces = mix(docs, id_col, **options)
    # A row without words has one piece.
    begun = F.count_if(F.col("first") == 0) + F.count_if(F.col("size") == 0)
    places = pieces.groupBy("row", "source", "cell", "place").agg(begun.alias("copies"))
    copies = places.groupBy(F.col("row").alias("key")).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    copies = write_once(copies.filter("copies > 0"), "mix-copies")
    # The document's own columns stay in a struct, whatever they are called.
    met = docs.select(F.struct("*").alias("doc"), row_key(docs).alias("key")).join(copies, "key")
    times = lambda n: F.explode(F.sequence(F.lit(1), n)).alias("copy")
    alone = met.filter("rows = 1").select("doc", times(F.col("copies")))
    # Equal rows become one, whose copies are dealt out in parts.
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE))).alias("part")
    one = met.filter("rows > 1").dropDuplicates(["key"]).select("doc", "key", "copies", part)
    left = F.least(F.lit(COPIES_AT_ONCE), F.col("copies") - F.col("part") * COPIES_AT_ONCE)
    repeated = one.repartition("part", "key").select("doc", times(left))
    return alone.unionByName(repeated).select("doc.*")
