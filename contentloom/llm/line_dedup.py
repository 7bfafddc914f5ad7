"""Lines that many documents share, found with two Bloom filters.

One filter holds the lines seen once, the other those seen again. Each task fills a pair for its
own documents, and pairs merge bit by bit: what one of them saw twice, or both saw once, counts as
seen twice. A line that was seen by two documents is always in the second filter; a line that is
there by chance is only checked in vain. So nothing but suspected repeats is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, keyed_only, restored, set_aside, text_batches

_SPACE = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineSettings:
    """Keys of ``least_chars`` code points or more, in ``least_docs`` documents or more, repeat.

    The filters get ``bits_per_line`` bits for each long line, up to ``most_bits`` (32 MB), which
    bounds what is broadcast. Beyond that they fill up: more lines are suspected and shuffled as
    24-byte rows, in the end all of them, and the result stays the same.
    """

    least_chars: int = 40
    least_docs: int = 5
    bits_per_line: int = 16
    hashes: int = 4
    most_bits: int = 1 << 28


SEGMENT = 1 << 16
"""Bytes of a filter that are merged at a time."""


SALTS = 32
"""Parts into which the documents that hold one key are dealt."""


def _key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lowered."""
    return line.strip(_SPACE).lower()


def _long(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= least


def _line_keys(docs: DataFrame, settings: LineSettings) -> DataFrame:
    """(doc_id, keys): 16 bytes for each distinct long key of a document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    least = settings.least_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            data = texts.data.tobytes()
            found = []
            for a, b in zip(texts.bounds[:-1], texts.bounds[1:]):
                keys = {_key(line) for line in data[a:b].split(b"\n")}
                found.append(b"".join(xxhash.xxh3_128_digest(k) for k in keys if _long(k, least)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "keys"]
            )

    return docs.mapInArrow(run, f"doc_id {kind}, keys binary").where(F.length("keys") > 0)


def _places(keys: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """The bit numbers of each key, one row per hash; keys are pairs of 64-bit numbers."""
    step = keys[:, 1] | np.uint64(1)
    return np.stack([(keys[:, 0] + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(hashes)])


def _are_set(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether all bits of a column of ``places`` are set."""
    bits = filter_[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)
    return (bits & np.uint8(1)).all(axis=0)


def _put(filter_: np.ndarray, places: np.ndarray) -> None:
    places = places.ravel()
    bits = np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)
    np.bitwise_or.at(filter_, (places >> np.uint64(3)).astype(np.int64), bits)


def _as_pairs(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64).reshape(-1, 2) for x in column]


def _twice_seen(marked: DataFrame, bits: int, hashes: int) -> np.ndarray:
    """The second filter over all documents, eight bits to a byte."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for keys in _as_pairs(batch.column("keys")):
                places = _places(keys, bits, hashes)
                # A document's keys are distinct, so a key in the first filter was in another one;
                # bits that two keys of one document share only add suspects.
                again = _are_set(once, places)
                _put(once, places)
                if again.any():
                    _put(twice, places[:, again])
        yield from _segments(once, twice)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        for batch in batches:
            for segment, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if segment == at:
                    once, twice = once | a, twice | b | (once & a)
                else:
                    if at is not None:
                        yield _row(at, twice)
                    at, once, twice = segment, a, b
        if at is not None:
            yield _row(at, twice)

    def _row(segment: int, twice: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([twice.tobytes()], pa.binary())],
            ["segment", "twice"],
        )

    def _segments(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(once), SEGMENT):
            if once[i : i + SEGMENT].any():
                packed = [zlib.compress(x[i : i + SEGMENT].tobytes(), 1) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // SEGMENT], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                    ["segment", "once", "twice"],
                )

    merged = (
        marked.select("keys")
        .mapInArrow(fill, "segment int, once binary, twice binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(merge, "segment int, twice binary")
    )
    whole = np.zeros(max(1, bits // 8), np.uint8)
    for row in merged.toLocalIterator():
        part = np.frombuffer(row.twice, np.uint8)
        whole[row.segment * SEGMENT : row.segment * SEGMENT + len(part)] = part
    return whole


def _drops(docs: DataFrame, settings: LineSettings) -> DataFrame:
    """(doc_id, drop): the keys of the lines that each document loses, 16 bytes each."""
    marked = cut_lineage(_line_keys(docs.where("doc_id IS NOT NULL"), settings))
    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = marked.select(F.sum(F.length("keys"))).first()[0] or 0
    wanted = max(1024, lines // 16 * settings.bits_per_line)
    bits = min(settings.most_bits, 1 << (wanted - 1).bit_length())
    hashes = settings.hashes
    filter_ = docs.sparkSession.sparkContext.broadcast(_twice_seen(marked, bits, hashes).tobytes())

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(filter_.value, np.uint8)
        for batch in batches:
            ids, found = [], []
            for row, keys in enumerate(_as_pairs(batch.column("keys"))):
                again = keys[_are_set(twice, _places(keys, bits, hashes))]
                ids += [row] * len(again)
                found += [k.tobytes() for k in again]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(ids, pa.int32())), pa.array(found, pa.binary())],
                ["doc_id", "key"],
            )

    # A key that a third of all documents hold is joined in as many parts as there are salts.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    # A document counts once for a key, in however many rows it comes.
    rows = (
        marked.mapInArrow(suspects, f"doc_id {kind}, key binary")
        .withColumn("salt", salt)
        .dropDuplicates(["doc_id", "key", "salt"])
    )
    common = (
        rows.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= settings.least_docs)
        .select("key", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    return (
        rows.join(common, ["key", "salt"])
        .where("doc_id != keeper")
        .groupBy("doc_id")
        .agg(F.array_join(F.collect_set(F.hex("key")), "").alias("drop"))
    )


def dedup_lines(docs: DataFrame, settings: LineSettings = LineSettings()) -> DataFrame:
    """(doc_id, text, rest, n_lines, n_dropped) per row: the text without its repeated lines.

    A line's key is the line without ASCII white space at its ends, A-Z lowered. Keys of at least
    ``least_chars`` code points that at least ``least_docs`` documents hold lose all their lines
    except in the largest doc_id that holds them; a document that keeps a key keeps all its lines. Keys
    are compared by 128-bit hashes. Lines end at \\n only.

    A NULL or empty text is one empty line; NULL stays NULL. Rows with a NULL doc_id keep all
    lines and do not count. The rows of a repeated doc_id are one document with all their lines: it
    counts once for a key, and where it is the largest all its rows keep theirs. ``rest`` holds the other columns (see ``common.set_aside``);
    an empty table gives no rows.
    """
    whole = set_aside(docs)
    # Read from files, so that adaptive execution can split the rows of a much repeated doc_id.
    drops = cut_lineage(_drops(whole.select("doc_id", "text"), settings))
    rest = whole.schema["rest"].dataType.simpleString()
    kind = whole.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            data = texts.data.tobytes()
            counts, dropped, kept = [], [], []
            for i, drop in enumerate(batch.column("drop").to_pylist()):
                text = data[texts.bounds[i] : texts.bounds[i + 1]]
                if drop is None:
                    counts.append(text.count(b"\n") + 1)
                    dropped.append(0)
                    kept.append(text if texts.valid[i] else None)
                    continue
                drop = bytes.fromhex(drop)
                gone = {drop[j : j + 16] for j in range(0, len(drop), 16)}
                lines = text.split(b"\n")
                left = [x for x in lines if xxhash.xxh3_128_digest(_key(x)) not in gone]
                counts.append(len(lines))
                dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    batch.column("rest"),
                    pa.array(counts, pa.int64()),
                    pa.array(dropped, pa.int64()),
                ],
                ["doc_id", "text", "rest", "n_lines", "n_dropped"],
            )

    return whole.join(drops, "doc_id", "left").mapInArrow(
        run, f"doc_id {kind}, text string, rest {rest}, n_lines long, n_dropped long"
    )


def without_repeats(docs: DataFrame, settings: LineSettings = LineSettings()) -> DataFrame:
    """``docs`` with their repeated lines removed and n_chars, if there, counted anew."""
    done = dedup_lines(docs, settings)
    changed = {}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        old = F.col(f"rest.c{docs.columns.index('n_chars')}")
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(kind)).otherwise(old)
    return restored(done, docs.columns, **changed)
