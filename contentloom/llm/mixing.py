"""Sources mixed to target weights by a low-discrepancy schedule over shuffled blocks.

Each source is a line of words: its documents one after the other, shuffled by a hash of their ids,
cut into blocks of equal numbers of words. The schedule is a row of slots. Slot t has the point
frac(t * golden ratio); the source whose part of the cumulative weights holds the point gets the
slot, so every stretch of slots, long or short, has the sources in nearly their shares. The slots of
a source are ranked, and rank r takes its block r, beginning again after the last one.

A low-discrepancy sequence misses a share by a few slots at most. What a source gets beyond its
quota stays unused, what it lacks follows at the end, and its last block is cut, so that each source
gives its target to the word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, set_aside

#: Points are whole numbers below 2 ** POINT_BITS; the step is the golden ratio's part of that.
POINT_BITS = 44
STEP = int((5**0.5 - 1) / 2 * (1 << POINT_BITS)) | 1
#: Slots whose ranks one window numbers, and the hash digits that cut a source's line into buckets.
CHUNK_BITS = 12
BUCKET_DIGITS = 4
#: Intervals of points by which slots find their source, if there are not more sources.
CELL_BITS = 12

SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class MixSettings:
    """``block``: words of a slot. ``weights``: of the sources in code point order, repeated as
    needed, NULL last. ``most``: how often a source's words may be taken at most.
    ``broadcast_bytes``: the table of sources is sent to all tasks if it is not larger.
    """

    block: int = 1024
    weights: tuple[float, ...] = (1, 2, 3)
    most: int = 3
    broadcast_bytes: int = 8 << 20


def word_count(text: Column) -> Column:
    """Words between ASCII white space, 0 for NULL; each becomes one sign, so no array is made."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{SPACE}]+", "")
    return F.length(F.regexp_replace(trimmed, f"[^{SPACE}]++[{SPACE}]*+", "x")).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text, source (NULL where the table has none), size in words, key to shuffle by."""
    source = F.lit(None).cast("string")
    if "source" in docs.columns:
        source = F.col(f"rest.c{docs.columns.index('source')}").cast("string")
    return set_aside(docs).select(
        "doc_id",
        "text",
        source.alias("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
    )


def targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """``sources`` (source_no, source_size, weight) with target, the words that each shall give.

    The targets share the sum of all sizes by weight. None is above ``most`` times its source's
    size: the excess goes to the others by weight until none is above. So a target is either that
    cap or weight * level with one level for all. In the order of cap / weight a source is capped
    exactly if its cap is not above its share of what the sources before it leave. One row for
    each source passes through one task.
    """
    cap, weight = F.col("source_size") * most, F.col("weight")
    ranked = Window.orderBy((cap / F.nullif(weight, F.lit(0.0))).asc_nulls_last(), "source_no")
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    onward = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    rest = F.sum("source_size").over(everyone) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    tested = sources.withColumn(
        "capped", (weight > 0) & (cap * F.sum("weight").over(onward) <= rest * weight)
    )
    taken = F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(everyone)
    others = F.sum(F.when(F.col("capped"), 0.0).otherwise(weight)).over(everyone)
    share = (F.sum("source_size").over(everyone) - taken) * weight / F.nullif(others, F.lit(0.0))
    return tested.withColumn(
        "target", F.when(F.col("capped"), cap.cast("double")).otherwise(F.coalesce(share, F.lit(0.0)))
    ).drop("capped")


def planned(measured: DataFrame, settings: MixSettings, weights: DataFrame | None = None) -> DataFrame:
    """One row per source: source_no (from 0 in code point order, NULL last), source, source_size,
    weight, target, words to take, blocks, quota (slots), and ``last``, the words taken in the last,
    incomplete round (0 if there is none).

    ``weights`` (source, weight) replaces the settings' weights; a source without one gives nothing.
    """
    b = settings.block
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    numbered = sizes.withColumn("source_no", number)
    if weights is None:
        cycle = F.array(*[F.lit(float(w)) for w in settings.weights])
        own = F.get(cycle, F.col("source_no") % len(settings.weights))
        weighed = numbered.withColumn("weight", own)
    else:
        given = weights.select(
            F.col("source").alias("of"), F.greatest(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
        ).dropDuplicates(["of"])
        weighed = numbered.join(given, numbered["source"].eqNullSafe(given["of"]), "left").drop("of")
        weighed = weighed.fillna(0.0, "weight")
    size = F.greatest("source_size", F.lit(1))
    cut = F.col("words") % size
    return (
        targets(weighed, settings.most)
        .withColumn("words", F.least(F.round("target").cast("bigint"), F.col("source_size") * settings.most))
        .withColumn("blocks", F.ceil(F.col("source_size") / b).cast("bigint"))
        .withColumn("last", cut)
        .withColumn(
            "quota",
            (F.floor(F.col("words") / size) * F.col("blocks") + F.ceil(F.col("last") / b)).cast("bigint"),
        )
    )


def schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """slot, source_no, rank: which source each slot takes, and how many it took before.

    ``sources`` has source_no and quota. As many slots as all quotas together are dealt by their
    points; then ranks at or beyond a quota are left out and missing ones are put behind, in turn.
    Slots meet only the sources of their own small interval of points, two on average. Ranks come
    from counts of chunks of slots and the order inside a chunk, so no task holds a whole source.
    """
    whole = sources.agg(F.sum("quota").alias("slots"), F.count("*").alias("sources")).first()
    slots = whole["slots"] or 0
    cells = max(CELL_BITS, whole["sources"].bit_length())
    shift = POINT_BITS - cells

    up_to = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    high = F.sum("quota").over(up_to)
    points = float(1 << POINT_BITS)

    def point(quotas: Column) -> Column:
        return F.floor(quotas / F.lit(float(max(1, slots))) * points).cast("bigint")

    parts = sources.select(
        "source_no", "quota", point(high - F.col("quota")).alias("low"), point(high).alias("high")
    ).where("high > low")
    cell = F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))
    parts = parts.select("source_no", "low", "high", F.explode(cell).alias("cell"))

    t = F.col("slot")
    # slot * STEP modulo 2 ** 44 in 64 bits: the upper half of the slot needs the lower bits of STEP.
    upper = F.shiftright(t, 16) * (STEP % (1 << 28)) % (1 << 28)
    at = (t.bitwiseAND(0xFFFF) * STEP + upper * (1 << 16)) % (1 << POINT_BITS)
    dealt = (
        spark.range(slots)
        .toDF("slot")
        .withColumn("point", at)
        .withColumn("cell", F.shiftright("point", shift))
        .join(parts, "cell")
        .where("point >= low AND point < high")
        .select("slot", "source_no", F.shiftright("slot", CHUNK_BITS).alias("chunk"))
    )
    counts = dealt.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = (
        dealt.withColumn("place", F.row_number().over(inside) - 1)
        .join(first, ["source_no", "chunk"])
        .select("slot", "source_no", (F.col("first") + F.col("place")).alias("rank"))
    )
    quotas = sources.select("source_no", "quota")
    kept = ranked.join(quotas, "source_no").where("rank < quota").drop("quota")
    missing = (
        quotas.join(counts.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
        .fillna(0, "n")
        .where("n < quota")
        .select("source_no", "n", F.explode(F.sequence(F.col("n"), F.col("quota") - 1)).alias("rank"))
    )
    behind = F.lit(slots) + (F.col("rank") - F.col("n")) * max(1, whole["sources"]) + F.col("source_no")
    return kept.unionByName(missing.select(behind.alias("slot"), "source_no", "rank"))


def laid_out(rows: DataFrame) -> DataFrame:
    """``rows`` (source_no, key, doc_id, size, more) with bucket, row and start: the place of each
    document in its source's line, in the order of the key.

    Repeated ids follow each other by size. Buckets are beginnings of the key, and shorter beginnings
    are buckets of those; their sums give the offsets, so that no task sorts a whole source.
    """
    placed = rows.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("outer", F.substring("bucket", 1, BUCKET_DIGITS // 2))

    def before(sizes: DataFrame, of: tuple[str, ...], by: str, name: str) -> DataFrame:
        above = Window.partitionBy(*of).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select(*of, by, F.coalesce(F.sum("n").over(above), F.lit(0)).alias(name))

    outer = sums.groupBy("source_no", "outer").agg(F.sum("n").alias("n"))
    first = (
        before(sums, ("source_no", "outer"), "bucket", "inside")
        .join(before(outer, ("source_no",), "outer", "first"), ["source_no", "outer"])
        .select("source_no", "bucket", (F.col("first") + F.col("inside")).alias("first"))
    )
    ties = [c for c in ("text",) if c in rows.columns]
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "size", *ties)
    return (
        placed.withColumn("row", F.row_number().over(inside))
        .withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(first, ["source_no", "bucket"])
        .withColumn("start", F.col("first") + F.col("upto") - F.col("size"))
        .drop("upto", "first")
    )


class Mix:
    """The mix of a table of documents: its sources, its schedule and the pieces that fill it.

    Words stand between ASCII white space. A NULL text has none; a NULL source is one like others
    and so is a table without sources. Rows with a NULL or a repeated doc_id are rows like others.
    An empty table has no sources, slots or pieces. Other columns are ignored. The same table gives
    the same mix, whatever its partitions.
    """

    def __init__(
        self, docs: DataFrame, settings: MixSettings = MixSettings(), weights: DataFrame | None = None
    ):
        self.docs, self.settings = docs, settings
        self._measured = cut_lineage(sized(docs).drop("text"))
        self.sources = cut_lineage(planned(self._measured, settings, weights))
        size = self.sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 100)).first()[0]
        small = (size or 0) <= settings.broadcast_bytes
        self._by_source = F.broadcast(self.sources) if small else self.sources

    def _lined(self, rows: DataFrame) -> DataFrame:
        named = self._by_source.select(F.col("source").alias("of"), "source_no", "source_size", "target")
        same = rows["source"].eqNullSafe(named["of"])
        return laid_out(rows.join(named, same).drop("of"))

    def slots(self) -> DataFrame:
        """slot, source_no, source, epoch, block, low, high: the words of the source's line from
        ``low`` up to ``high`` fill the slot; slots in ascending order are the mix."""
        b = self.settings.block
        dealt = schedule(self.docs.sparkSession, self.sources)
        facts = self._by_source.select("source_no", "source", "source_size", "blocks", "quota", "last")
        cut = (F.col("rank") == F.col("quota") - 1) & (F.col("last") > 0)
        low = F.col("rank") % F.col("blocks") * b
        return dealt.join(facts, "source_no").select(
            "slot",
            "source_no",
            "source",
            F.floor(F.col("rank") / F.col("blocks")).cast("bigint").alias("epoch"),
            (F.col("rank") % F.col("blocks")).alias("block"),
            low.alias("low"),
            F.least(low + b, F.when(cut, F.col("last")).otherwise(F.col("source_size"))).alias("high"),
        )

    def _joined(self, rows: DataFrame, how: str) -> DataFrame:
        """Lined rows in as many copies as slots take some of their words; from, upto are words of
        the document."""
        b = self.settings.block
        over = F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))
        cut = rows.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, over)))
        slots = self.slots().drop("source")
        met = cut.join(slots, ["source_no", "block"], how)
        begin = F.greatest("start", "low") - F.col("start")
        end = F.least(F.col("start") + F.col("size"), F.col("high")) - F.col("start")
        return met.withColumns({"from": begin, "upto": F.greatest(begin, end)})

    def counts(self) -> DataFrame:
        """doc_id, size, source, source_size, target, taken for each row of the documents: how many
        words of it the mix takes, repeats counted."""
        rows = self._lined(self._measured)
        keys = ["source_no", "bucket", "row", "doc_id", "size", "source", "source_size", "target"]
        words = F.when(F.col("slot").isNotNull(), F.col("upto") - F.col("from"))
        taken = F.coalesce(F.sum(words), F.lit(0)).alias("taken")
        return self._joined(rows, "left").groupBy(*keys).agg(taken).select(*keys[3:], "taken")

    def pieces(self) -> DataFrame:
        """slot, place, epoch, source, doc_id, from, upto, text: the words [from, upto) of documents
        that fill the slots, in the order of ``place`` inside a slot; text has them between single
        blanks.

        Texts move once to their source's line; each slot's copy of a piece is cut before the next
        shuffle would carry the rest of the text.
        """
        b = self.settings.block
        lined = self._lined(sized(self.docs))
        words = F.array_remove(F.split(F.coalesce("text", F.lit("")), f"[{SPACE}]+"), "")
        start, size = F.col("start"), F.col("size")
        blocks = F.sequence(F.floor(start / b), F.floor((start + size - 1) / b))

        def piece(block: Column) -> Column:
            begin = F.greatest(start, block * b) - start
            end = F.least(start + size, (block + 1) * b) - start
            part = F.slice("words", (begin + 1).cast("int"), (end - begin).cast("int"))
            return F.struct(block.alias("block"), begin.alias("from"), part.alias("part"))

        cut = (
            lined.where("size > 0")
            .withColumn("words", words)
            .select("source_no", "doc_id", "start", F.explode(F.transform(blocks, piece)).alias("p"))
            .select("source_no", "doc_id", "start", "p.block", "p.from", "p.part")
        )
        met = cut.join(self.slots(), ["source_no", "block"])
        room = F.col("high") - F.col("start") - F.col("from")
        left = F.least(F.size("part").cast("bigint"), room)
        return met.where(room > 0).select(
            "slot",
            F.greatest(F.col("start") - F.col("low"), F.lit(0)).alias("place"),
            "epoch",
            "source",
            "doc_id",
            "from",
            (F.col("from") + left).alias("upto"),
            F.array_join(F.slice("part", 1, left.cast("int")), " ").alias("text"),
        )
