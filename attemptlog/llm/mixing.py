"""Mixing sources to target weights (operator 2), with DataFrame functions only.

Sizes count words. Sources weigh 1, 2, 3, repeating in their order; a source's target is its
share of all words, at most ``MOST`` times its size, the excess going to the others by
weight. The mix is a schedule of slots of ``block`` words each. Slot t is a point of a
golden-ratio sequence on a grid of 2**31; the interval of cumulative targets that it falls
into names the source, and the slot's rank among the source's slots names the block it takes.
A source's documents are shuffled by hash and laid end to end, up to ``MOST`` times, and that
stream is cut into blocks of equal words. Joining slots and blocks gives the pieces.

No source is ever one task: ranks and offsets are counted in parts (runs of slots, ranges of
hashes) and joined up by the parts' totals.

Defined results: a null or blank text has size 0 and is never taken. Documents without a
source form one source, the last. Rows that repeat a document count each by itself. Without
any words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attemptlog.session import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 64
#: A block is smaller where the whole input would not give this many slots.
LEAST_SLOTS = 4096
#: Odd, next to 2**31 divided by the golden ratio.
GOLDEN, GRID = 1327217885, 1 << 31
#: Parts that a source's shuffled documents and the slots are counted in.
PARTS, RUN = 256, 1 << 11
#: Cells of the grid for finding a point's interval by an equal key.
CELLS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weigh(sizes: DataFrame) -> DataFrame:
    """Sources (source, source_size) with their weights.

    The order needs the rank of a source, modulo 3. Sources are put into ranges first, so
    the ranks are counted per range.
    """
    key = F.struct(F.col("source").isNull().alias("missing"), F.col("source").alias("name"))
    ranged = sizes.withColumn("key", key).repartitionByRange("key").withColumn(
        "part", F.spark_partition_id()
    )
    ranged = materialize(ranged, "sources")
    per_part = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_part.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    rank = (F.col("place") + F.col("before")) % len(WEIGHTS)
    return (
        ranged.withColumn("place", place)
        .join(starts, "part")
        .select(
            "source",
            "key",
            "source_size",
            F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank + 1).cast("int")).alias("weight"),
        )
    )


def targets(weighed: DataFrame) -> DataFrame:
    """Adds ``target``: the level times the weight, at most ``MOST`` times the size.

    The level rises as sources reach their limit; each round collects three sums.
    """
    cap = F.lit(MOST) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap
        row = weighed.agg(
            F.sum(F.when(full, cap).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.sum(full.cast("long")),
        ).first()
        if not row[1] or (capped >= 0 and row[2] == capped):
            break
        capped, level = row[2], (total - row[0]) / row[1]
    share = F.lit(level) * F.col("weight")
    return weighed.withColumn("target", F.least(share, cap.cast("double")))


def source_key(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def stream(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with ``start``, their offset in their source's shuffled order."""
    order = F.xxhash64(F.col("doc"), F.col("size"), F.lit("shuffle"))
    # A range of hashes is a part; the shuffled order goes through parts, then hashes.
    part = F.shiftrightunsigned(F.col("h"), 64 - (PARTS.bit_length() - 1)).cast("int")
    placed = sized.withColumn("h", order).select(
        source_key(F.col("source")).alias("sk"), part.alias("part"), "h", "doc", "size", "row"
    )
    within = Window.partitionBy("sk", "part").orderBy("h", "doc", "size", "row")
    local = placed.withColumn(
        "upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    along = Window.partitionBy("sk").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    known = sources.select(source_key(F.col("source")).alias("sk"), "source_size", "target")
    # The source's figures travel with its parts, so that no join meets a whole source.
    parts = (
        placed.groupBy("sk", "part")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
        .join(known, "sk")
        .drop("words")
    )
    return local.join(parts, ["sk", "part"]).select(
        "sk", "doc", "row", "size", "source_size", "target",
        (F.col("upto") - F.col("size") + F.col("before")).alias("start"),
    )


def slots(sources: DataFrame, total: int, block: int) -> DataFrame:
    """The schedule: slot, sk (source) and k, the slot's rank among its source's slots."""
    spark = sources.sparkSession
    known = sources.filter("target > 0").select(
        "key", source_key(F.col("source")).alias("sk"), "target"
    )
    # At least as many cells as sources, so that a cell meets few intervals.
    width = GRID // min(GRID, max(CELLS, 1 << known.count().bit_length()))
    # Cumulative shares on the grid. A row per source: the windows hold no documents.
    along = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("target").over(along) / F.lit(float(max(total, 1))) * F.lit(GRID)
    upto = known.withColumn("upto", F.least(F.round(share), F.lit(GRID)).cast("long"))
    low = F.coalesce(F.lag("upto").over(Window.orderBy("key")), F.lit(0))
    # The last interval ends where the grid ends, whatever the rounding of the sums.
    last = F.lead("upto").over(Window.orderBy("key")).isNull()
    high = F.when(last, F.lit(GRID)).otherwise(F.col("upto"))
    spans = upto.select("sk", low.alias("low"), high.alias("high")).filter("low < high")
    cells = spans.withColumn(
        "cell",
        F.explode(F.sequence((F.col("low") / width).cast("int"),
                             ((F.col("high") - 1) / width).cast("int"))),
    )
    points = spark.range(-(-total // block)).select(
        F.col("id").alias("slot"), ((F.col("id") % GRID) * GOLDEN % GRID).alias("point")
    )
    points = points.withColumn("cell", (F.col("point") / width).cast("int"))
    dealt = points.join(cells, "cell").filter("point >= low AND point < high")
    dealt = dealt.select("sk", "slot", F.floor(F.col("slot") / RUN).alias("run"))
    ranked = dealt.withColumn(
        "place", F.row_number().over(Window.partitionBy("sk", "run").orderBy("slot")) - 1
    )
    runs = (
        dealt.groupBy("sk", "run")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "sk",
            "run",
            F.coalesce(
                F.sum("rows").over(
                    Window.partitionBy("sk").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("before"),
        )
    )
    return ranked.join(runs, ["sk", "run"]).select(
        "sk", "slot", (F.col("place") + F.col("before")).alias("k")
    )


def plan(
    documents: DataFrame, key: str, text: str, source: str, row: str | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """Sized documents in their source's stream, the slots, and the block size.

    ``row`` names a unique id of the rows, for a caller that has to tell copies apart.
    """
    sized = documents.select(
        F.col(f"`{key}`").alias("doc"),
        (F.col(f"`{row}`") if row else F.lit(0)).cast("long").alias("row"),
        F.col(f"`{source}`").alias("source"),
        words(F.col(f"`{text}`")).alias("size"),
    )
    sized = materialize(sized, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(targets(materialize(weigh(sizes), "mix-weights")), "mix-targets")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    block = min(BLOCK, max(1, total // LEAST_SLOTS))
    return stream(sized, sources), slots(sources, total, block), block


def pieces(placed: DataFrame, schedule: DataFrame, block: int) -> DataFrame:
    """The mix: slot, doc, row, epoch, and the words [first, last) of the document it takes.

    Positions in a source's stream repeat after its size; an epoch is one repeat.
    """
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    laid = (
        placed.filter("size > 0")
        .withColumn("epoch", F.explode(F.array(*[F.lit(e).cast("long") for e in range(MOST)])))
        .withColumn("begin", begin)
        # A source's slots exceed its share by less than the logarithm of their number.
        .filter(F.col("begin") < F.col("target") + F.lit(64 * block))
        .withColumn("end", F.col("begin") + F.col("size"))
        .withColumn(
            "k",
            F.explode(F.sequence(F.floor(F.col("begin") / block),
                                 F.floor((F.col("end") - 1) / block))),
        )
    )
    cut = laid.select(
        "sk", "k", "doc", "row", "size", "start", "epoch",
        (F.greatest(F.col("begin"), F.col("k") * block) - F.col("begin")).alias("first"),
        (F.least(F.col("end"), (F.col("k") + 1) * block) - F.col("begin")).alias("last"),
    )
    return cut.join(schedule, ["sk", "k"])


def _taken(placed: DataFrame, schedule: DataFrame, block: int) -> DataFrame:
    """``placed`` with the words the mix takes of every document, all repeats together."""
    sums = (
        pieces(placed, schedule, block)
        .groupBy("sk", "start")
        .agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    )
    # A document with words is named by its offset; the others are told apart from it.
    some = placed.filter("size > 0").join(sums, ["sk", "start"], "left")
    none = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return some.withColumn("taken", F.coalesce("taken", F.lit(0))).unionByName(none)


def mix(documents: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Per document: key, size, source_size, target, taken."""
    return _taken(*plan(documents, key, text, source)).select(
        F.col("doc").alias(key), "size", "source_size", "target", "taken"
    )


def mixed_rows(documents: DataFrame, key: str, text: str, source: str, whole: bool = False) -> DataFrame:
    """The mix as documents: a row for every repeat taken, with the columns of ``documents``.

    Blocks go through a source's stream in order, so a repeat is whole, or, for the document
    in which a source's last block ends, the words up to there. With ``whole`` that one is taken
    as it is, or not at all, whichever is nearer.
    """
    tagged = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"),
    )
    tagged = materialize(tagged, "mix-rows")
    parts = tagged.select(
        "row", *[F.col(f"document.`{c}`").alias(n) for c, n in ((key, "k"), (text, "t"), (source, "s"))]
    )
    taken = _taken(*plan(parts, "k", "t", "s", "row")).filter("taken > 0").select("row", "size", "taken")
    body = F.col(f"document.`{text}`")
    left = F.least(F.col("size"), F.col("taken") - F.col("repeat") * F.col("size"))
    head = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), 1, F.col("left").cast("int")), " ")
    kept = F.when(F.col("left") < F.col("size"), head).otherwise(body)
    if whole:
        kept = body
        taken = taken.withColumn("taken", F.floor(F.expr("(taken * 2 + size) div (size * 2)")) * F.col("size"))
        taken = taken.filter("taken > 0")
    repeats = F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("size")))
    return (
        tagged.join(taken, "row")
        .withColumn("repeat", F.explode(repeats))
        .withColumn("left", left)
        .select(*[(kept if c == text else F.col(f"document.`{c}`")).alias(c) for c in documents.columns])
    )
