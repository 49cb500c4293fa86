"""Line dedup with two Bloom filters.

1. Every task adds the hashes of its documents' line keys to a filter of once-seen hashes, and those already there to
   one of twice-seen hashes. Tasks' filters are merged segment by segment: seen twice is what one task saw twice or two
   tasks saw once. The filters have a fixed size, at most ``BITS`` bits each, chosen from the number of lines.
2. Lines whose hash is in the twice-seen filter are suspects. Only their digests are shuffled: a digest found in two
   documents is a repeat, and its first occurrence is in the smallest doc_id. A fuller filter lets more suspects
   through and never loses one, so that results do not depend on its size.
3. Documents that hold no suspect are finished in the scan. The others meet the digests they lose.

A key is the line without white space at its ends and A-Z lower-cased; keys under ten code points are left alone.

Defined cases: a null or empty text is one empty line; rows with the same doc_id count as one document, and each loses
the same lines; rows without a doc_id count as one document, last in order; a line repeated within the first document
stays there every time; an empty table gives no rows; extra columns are not read by ``marked`` and stay in ``dedupe``.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import A_TO_Z, BROADCAST_ROWS, LOWER, SPACES, columns_of, free, measured, small_batches, text_or_empty, written

LEAST = 10
BITS = 1 << 27
BITS_PER_LINE = 16
PROBES = 4
SEGMENT = 1 << 17

_LOWER = bytes.maketrans(A_TO_Z.encode(), LOWER.encode())


def key_of(line: bytes) -> bytes | None:
    """The line's key, or nothing if it is too short to count."""
    key = line.strip(SPACES).translate(_LOWER)
    if len(key) < LEAST or len(key) < 4 * LEAST and len(key.decode("utf-8", "replace")) < LEAST:
        return None
    return key


def keys_of(text: str) -> list[bytes | None]:
    return [key_of(line) for line in text.encode("utf-8", "replace").split(b"\n")]


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` filter positions of each hash, one column each."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def get(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filter_[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(1)


def put(filter_: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(filter_, flat >> np.uint64(3), np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


class Filters:
    """Once-seen and twice-seen hashes."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Add one document's hashes after another's; a document's own repeats may be among them."""
        hashes, times = np.unique(hashes, return_counts=True)
        places = positions(hashes, self.bits)
        put(self.twice, places[get(self.once, places) | (times > 1)])
        put(self.once, places)


def _build(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(bits)
        for batch in batches:
            hashes = [
                xxhash.xxh3_64_intdigest(key)
                for text in batch.column(0)
                for key in set(keys_of(text.as_py()))
                if key is not None
            ]
            filters.add(np.array(hashes, np.uint64))
        for at in range(0, bits // 8, SEGMENT // 8):
            once = filters.once[at : at + SEGMENT // 8]
            if once.any():
                twice = filters.twice[at : at + SEGMENT // 8]
                columns = [pa.array([at * 8 // SEGMENT], pa.int32())]
                columns += [pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "once", "twice"])

    return build


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order, the parts of each one after the other: one pair of filters is held at a time."""
    held, once, twice = None, None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())],
            ["segment", "twice"],
        )

    for batch in batches:
        for segment, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
            if segment != held:
                if held is not None and twice.any():
                    yield row()
                held, once, twice = segment, o, t
            else:
                once, twice = once | o, twice | t | (once & o)
    if held is not None and twice.any():
        yield row()


def twice_seen(texts: DataFrame, most: int = BITS) -> tuple[int, Broadcast]:
    """Size and bits of the twice-seen filter of all line keys; ``texts`` has one text column."""
    lines = texts.agg(F.sum(F.length(F.col("text")) - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 1
    bits = int(min(most, max(SEGMENT, 1 << math.ceil(math.log2(lines * BITS_PER_LINE)))))
    parts = texts.mapInArrow(_build(bits), "segment int, once binary, twice binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment int, twice binary")
    whole = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():
        at = row["segment"] * (SEGMENT // 8)
        whole[at : at + SEGMENT // 8] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return bits, texts.sparkSession.sparkContext.broadcast(whole)


def _suspects(bits: int, sent: Broadcast):
    def suspects(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for text in batch:
                keys = list({k for k in keys_of(text.as_py()) if k is not None})
                hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                seen = get(sent.value, positions(hashes, bits))
                rows.append([digest(k) for k, s in zip(keys, seen.tolist(), strict=True) if s])
            yield pa.array(rows, pa.list_(pa.binary()))

    return F.arrow_udf(suspects, "array<binary>")


KEPT = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])


def _kept(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch, lost in texts:
        rows = []
        for text, gone in zip(batch, lost, strict=True):
            lines = text.as_py().encode("utf-8", "replace").split(b"\n")
            gone = set(gone.as_py() or ())
            if gone:
                kept = [x for x in lines if (key := key_of(x)) is None or digest(key) not in gone]
            else:
                kept = lines
            rows.append({
                "n_lines": len(lines),
                "n_dropped": len(lines) - len(kept),
                "text": b"\n".join(kept).decode("utf-8", "replace"),
            })
        yield pa.array(rows, KEPT)


def lost(docs: DataFrame, bits: int, sent: Broadcast) -> DataFrame:
    """``doc_id, lost``: the digests whose lines a document loses, if any."""
    found = docs.select("doc_id", F.explode(_suspects(bits, sent)(text_or_empty())).alias("digest"))
    suspects = written(found, "line-suspects")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    first = written(
        suspects.groupBy("digest")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .filter("first <> last")
        .select(F.col("digest").alias("key"), F.col("first.doc_id").alias("keeper")),
        "line-repeats",
    )
    again = (F.col("digest") == F.col("key")) & ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    gone = suspects.join(measured(first), again).groupBy("doc_id").agg(F.collect_set("digest").alias("lost"))
    return written(gone, "line-lost")


def without_repeats(docs: DataFrame, into: str, most: int = BITS, broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with the struct ``into``: ``n_lines, n_dropped`` and the ``text`` that is left.

    If more than ``broadcast`` digests are lost in all, they are not broadcast, and the documents that hold a suspect
    are shuffled by id to meet them; the others never are.
    """
    small_batches(docs)
    bits, sent = twice_seen(docs.select(text_or_empty().alias("text")), most)
    id_, lost_, flag = free(docs, "id_"), free(docs, "lost_"), free(docs, "suspect_")
    gone = lost(docs, bits, sent).select(F.col("doc_id").alias(id_), F.col("lost").alias(lost_))
    same = F.col("doc_id").eqNullSafe(F.col(id_))
    if (gone.agg(F.sum(F.size(lost_))).first()[0] or 0) <= broadcast:
        met = docs.join(F.broadcast(gone), same, "left")
    else:
        flagged = docs.withColumn(flag, F.size(_suspects(bits, sent)(text_or_empty())) > 0)
        alone = flagged.filter(~F.col(flag)).withColumn(lost_, F.lit(None).cast("array<binary>"))
        met = flagged.filter(flag).join(gone, same, "left").drop(id_).unionByName(alone)
    kept = F.arrow_udf(_kept, "n_lines bigint, n_dropped bigint, text string")(text_or_empty(), F.col(lost_))
    return met.select(*columns_of(docs), kept.alias(into))


def marked(docs: DataFrame) -> DataFrame:
    """Per document its lines, how many are dropped, and the digest of the rest."""
    kept = F.col("kept")
    return without_repeats(docs.select("doc_id", "text"), "kept").select(
        "doc_id",
        kept["n_lines"].alias("n_lines"),
        kept["n_dropped"].alias("n_dropped"),
        F.sha2(kept["text"].cast("binary"), 256).alias("kept_sha256"),
    )


def dedupe(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``; a null text stays null."""
    into = free(docs, "kept")
    text = F.when(F.col("text").isNotNull(), F.col(into)["text"]).alias("text")
    found = without_repeats(docs, into)
    return found.select(*(text if c == "text" else F.col(f"`{c}`") for c in docs.columns))
