"""Documents packed into token sequences of a fixed length: first-fit decreasing in random groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, keyed_only, parts_of
from .tokens import Vocabulary


@dataclass(frozen=True)
class PackSettings:
    """Sequences of ``length`` tokens; every document ends with the token ``end``.

    ``group`` is the number of pieces that are packed together; it bounds a task's work and
    hardly changes the padding.
    """

    length: int = 2048
    end: int = 1
    group: int = 8192
    seed: int = 3


def _pieces(docs: DataFrame, vocabulary: Vocabulary, settings: PackSettings, with_ids: bool) -> DataFrame:
    """Each document's tokens, cut every ``length`` tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        number = 0
        for batch, ids, bounds in encoder.batches(batches, "text", settings.end):
            sizes = np.diff(bounds)
            cuts = -(-sizes // length)
            row = np.repeat(np.arange(len(sizes)), cuts)
            order = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            starts = order * length
            lengths = np.minimum(length, sizes[row] - starts)
            at = bounds[row] + starts
            parts = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), lengths.tolist())]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                "doc_tokens": pa.array(sizes[row], pa.int64()),
                "piece": pa.array(np.arange(number, number + len(row)), pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([narrow(p) for p in parts], pa.binary())
            number += len(row)
            yield pa.RecordBatch.from_pydict(columns)

    ids = ", ids binary" if with_ids else ""

    def narrow(part: bytes) -> bytes:
        """Two bytes an id while the piece is moved, if they all fit."""
        found = np.frombuffer(part, np.uint32)
        small = found.max() < 1 << 16
        return (b"\x02" if small else b"\x04") + found.astype(np.uint16 if small else np.uint32).tobytes()

    return docs.mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, piece long{ids}",
    )


class Capacities:
    """Room left in bins, in a tournament tree: each node holds the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size``, and its room before; the room shrinks."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        room = most[at]
        most[at] = room - size
        bin_ = at - self.leaves
        at >>= 1
        while at:
            top = max(most[2 * at], most[2 * at + 1])
            if most[at] == top:
                break
            most[at] = top
            at >>= 1
        return bin_, room


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset there of every size; no size is above ``room``."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    tree = Capacities(len(sizes), room)
    for i in order.tolist():
        bins[i], left = tree.put(int(sizes[i]))
        offsets[i] = room - left
    return bins, offsets


def pack(
    docs: DataFrame,
    vocabulary: Vocabulary,
    settings: PackSettings = PackSettings(),
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and the end token; a NULL or empty text is the end token alone.
    Documents longer than a sequence are cut into whole sequences and a rest. All pieces are dealt
    into random groups, and each group is packed by itself, so a group's sequences are its own;
    sequence ids are distinct over all groups but not gapless. Offsets are gapless from 0 in a
    sequence; a sequence's rest up to ``length`` is padding. ids_crc32 is the checksum of the
    piece's ids as little-endian unsigned 32-bit numbers; ``with_ids`` adds the ids themselves.

    Every row is packed, also one with a NULL or a repeated doc_id. Other columns are ignored; an
    empty table gives no rows. Groups depend on a piece's place in its partition alone, so a task
    that runs again deals its pieces as before.
    """
    pieces = _pieces(keyed_only(docs), vocabulary, settings, with_ids)
    # The place is taken after the scan; the partition of a piece is that of its document.
    pieces = cut_lineage(pieces.withColumn("part", F.spark_partition_id()))
    groups = parts_of(pieces.count(), settings.group)
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64("part", "piece", F.lit(settings.seed)), F.lit(groups))
    )

    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("part", "ascending"), ("piece", "ascending")])
        bins, offsets = first_fit_decreasing(np.asarray(rows.column("length")), settings.length)
        out = rows.drop_columns(["part", "piece", "group"])
        if with_ids:
            at = out.column_names.index("ids")
            out = out.set_column(at, "ids", pa.array(map(widened, out.column("ids")), pa.list_(pa.int32())))
        out = out.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins))
        return out.append_column("offset", pa.array(offsets))

    def widened(part: pa.Scalar) -> np.ndarray:
        part = part.as_py()
        return np.frombuffer(part[1:], np.uint16 if part[0] == 2 else np.uint32).astype(np.int32)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""
    return dealt.groupBy("group").applyInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, {ids}"
        "sequence_id long, offset long",
    )
