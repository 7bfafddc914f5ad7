"""Documents dealt into shards that are equal in bytes, tokens and rows: vector bin packing."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, keyed_only, parts_of


@dataclass(frozen=True)
class ShardSettings:
    """Groups of equal texts above 1 / ``heavy`` of a shard's share, in bytes, tokens or rows, are placed
    first and together; there are at most 3 * ``shards`` * ``heavy`` of them. ``per_task``: other
    groups that one task places. Only a group above a shard's whole share is split, at random
    into pieces of about 1 / ``pieces`` of a share.
    """

    shards: int = 16
    heavy: int = 1000
    pieces: int = 4
    per_task: int = 20_000
    per_block: int = 50_000
    seed: int = 5


def words_of(text: Column) -> Column:
    """Words between ASCII white space, as a measure of tokens that needs no vocabulary."""
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("bigint")


def place(vectors: np.ndarray, shards: int, first: int, room: np.ndarray | None = None) -> np.ndarray:
    """The shard of each group, largest groups first.

    A shard's capacity is its part of every dimension, equal parts or those of ``room`` (shards by
    dimensions); a group goes where the dot product of its vector with the residual capacity is
    highest, both measured in equal parts. Ties go to the first shard from ``first`` on.
    """
    total = vectors.sum(axis=0)
    scaled = vectors * (shards / np.where(total > 0, total, 1))
    residual = np.ones((shards, vectors.shape[1]))
    if room is not None:
        whole = room.sum(axis=0)
        residual = np.where(whole > 0, room * shards / np.where(whole > 0, whole, 1), 1.0)
        residual = np.roll(residual, -first, axis=0)
    out = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -scaled.max(axis=1))).tolist():
        best = int(np.argmax(residual @ scaled[i]))
        residual[best] -= scaled[i]
        out[i] = (best + first) % shards
    return out


def shard(
    docs: DataFrame, settings: ShardSettings = ShardSettings(), tokens: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, tokens, text_crc32, shard, slot.

    size is the UTF-8 bytes of the text and one for its end; tokens are ``tokens`` of the column
    ``text``, by default its words. Equal texts (NULL is empty) are a group and share a shard,
    unless the group is larger than a shard's whole share. The heaviest groups are placed together by
    ``place``; the others are dealt to tasks at random, and each task fills its part of the room that
    is left, starting at another shard. slot numbers the rows of a shard from 0 without gaps, in
    random order.

    Rows with a NULL or a repeated doc_id are rows like others. Other columns are ignored; an
    empty table gives no rows.
    """
    s = settings
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = keyed_only(docs).select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.coalesce(words_of(text) if tokens is None else tokens, F.lit(0)).alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("key"),
    )
    # The number tells repeated rows apart; the checkpoint fixes it.
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = rows.select(*sums).first().asDict()
    if not whole["rows"]:
        return rows.select(
            "doc_id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"), F.col("row").alias("slot")
        )
    groups = cut_lineage(rows.groupBy("key").agg(*sums))
    names = ("size", "tokens", "rows")
    shares = {c: max(1.0, whole[c] / s.shards) for c in names}
    # Groups above a part of a share: their number is bounded, and so is what is sent to all tasks.
    most = F.greatest(*(F.col(c) / share for c, share in shares.items()))
    parts = F.when(most > 1, F.ceil(most * s.pieces)).otherwise(1)
    is_heavy = F.greatest(*(F.col(c) * s.heavy / share for c, share in shares.items())) > 1
    # A row cannot be split, so a group has as many pieces as rows at most.
    heavy = groups.where(is_heavy).select("key", F.least(parts, "rows").cast("int").alias("n"))
    marked = rows.join(F.broadcast(heavy), "key", "left")
    piece = F.pmod(F.xxhash64("row"), F.col("n")).cast("int")
    first = cut_lineage(marked.where("n IS NOT NULL").withColumn("piece", piece).drop("n"))
    rest = marked.where("n IS NULL").drop("n")

    def arrays(table: pa.Table) -> np.ndarray:
        return np.stack([np.asarray(table.column(c), float) for c in names], 1)

    def together(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("piece", "ascending")])
        found = place(arrays(table), s.shards, 0)
        return table.append_column("shard", pa.array(found, pa.int32())).drop_columns(["one"])

    pieces = first.groupBy("key", "piece").agg(*sums)
    form = "key string, piece int, size long, tokens long, rows long, shard int"
    settled = cut_lineage(pieces.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(together, form))
    room = np.array([[shares[c] for c in names]] * s.shards)
    for row in settled.groupBy("shard").agg(*(F.sum(c).alias(c) for c in names)).collect():
        room[row["shard"]] -= [row[c] for c in names]
    room = np.maximum(room, 0)

    light = groups.where(~is_heavy)
    tasks = parts_of(light.count(), s.per_task)
    dealt = light.withColumn("task", F.pmod(F.xxhash64("key", F.lit(s.seed)), F.lit(tasks)))

    def run(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        found = place(arrays(table), s.shards, key[0].as_py() % s.shards, room)
        return table.select(["key"]).append_column("shard", pa.array(found, pa.int32()))

    placed = dealt.groupBy("task").applyInArrow(run, "key string, shard int")
    done = (
        first.join(F.broadcast(settled.select("key", "piece", "shard")), ["key", "piece"])
        .drop("piece")
        .unionByName(rest.join(placed, "key"))
        .withColumn(
            "block", F.pmod(F.xxhash64("row", F.lit(s.seed)), F.lit(parts_of(whole["rows"], s.per_block)))
        )
    )
    done = cut_lineage(done.select("doc_id", "size", "tokens", "text_crc32", "row", "shard", "block"))
    counts = done.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("row")
    return (
        done.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "block"])
        .select(
            "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot")
        )
    )
