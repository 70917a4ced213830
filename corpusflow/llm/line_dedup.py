"""Line deduplication with a sharded minimal perfect hash.

1. Every line's key (white space stripped, A-Z lower-cased) of at least
   min_chars code points is hashed to 128 bits; an aggregate counts the
   distinct documents of each hash and finds the largest doc_id.
2. All distinct hashes are dealt to shards of bounded size. Each shard is one
   task, which builds a minimal perfect hash (levels of bit arrays with ranks, as
   in Limasset et al. 2017) that indexes compact arrays: 32-bit fingerprints,
   32-bit counts and the largest doc_ids.
3. Documents probe the arrays: each of a document's distinct hashes is sent to its
   shard, where the count decides and the largest doc_id tells whose lines stay.
   A task streams probes past one shard; shards that get many, as
   those of very common lines, are probed by several tasks. Lines themselves never
   move, are never joined, and no index is broadcast.
4. Lost hashes, a list for each document that loses any, meet the texts, from which their
   lines are then taken, in one pass however large the index is.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.common import bounded, map_arrow, materialize, release, release_at_exit, splitmix, text_bytes, without

SPACE = b" \t\n\x0b\x0c\r"
#: Distinct hashes in a shard, and probes of a shard that one task takes.
SHARD_KEYS = 1 << 18
TASK_PROBES = 1 << 22


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class PerfectHash:
    """A minimal perfect hash over distinct 128-bit keys, with a 32-bit fingerprint, a
    count (2^32 - 1 at most) and a largest id for each key. Arrays only, so it can be shipped."""

    def __init__(self, words: list[np.ndarray], fingerprint: np.ndarray, count: np.ndarray, largest: np.ndarray):
        self.words, self.fingerprint, self.count, self.largest = words, fingerprint, count, largest
        self.ranks, start = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.ranks.append(start + np.cumsum(ones) - ones)
            start += int(ones.sum())

    @staticmethod
    def _spot(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
        x = splitmix(splitmix(h1.view(np.uint64) + np.uint64(level * 0x9E3779B9)) ^ h2.view(np.uint64))
        return (x % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, largest: np.ndarray) -> PerfectHash:
        """The pairs (h1, h2) must be distinct."""
        words, left = [], np.arange(len(h1))
        while len(left):
            bits = -(-2 * len(left) // 64) * 64
            spot = cls._spot(h1[left], h2[left], len(words), bits)
            alone = np.bincount(spot, minlength=bits)[spot] == 1
            flags = np.zeros(bits, np.uint8)
            flags[spot[alone]] = 1
            words.append(np.packbits(flags, bitorder="little").view(np.uint64))
            left = left[~alone]
        out = cls(words, np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.uint32), np.zeros(len(h1), np.int64))
        at = out._index(h1, h2)
        out.fingerprint[at], out.count[at], out.largest[at] = cls._mark(h2), np.minimum(count, 2**32 - 1), largest
        return out

    @staticmethod
    def _mark(h2: np.ndarray) -> np.ndarray:
        return h2.view(np.uint64).astype(np.uint32)

    def _index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The place of each key; of a key that is not in the set: some place or -1."""
        out, open_ = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (w, r) in enumerate(zip(self.words, self.ranks, strict=True)):
            if not len(open_):
                break
            spot = self._spot(h1[open_], h2[open_], level, 64 * len(w))
            word, bit = w[spot >> 6], (spot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (r[spot >> 6] + below)[hit]
            open_ = open_[~hit]
        return out

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The place of each key that is in the set; -1 for others, but for one in 2^32 of them."""
        at = self._index(h1, h2)
        if len(self.fingerprint):
            at[(at >= 0) & (self.fingerprint[at] != self._mark(h2))] = -1
        return at

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for a in (self.fingerprint, self.count, self.largest, *self.words):
            np.save(out, a)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        source, arrays = io.BytesIO(raw), []
        while source.tell() < len(raw):
            arrays.append(np.load(source))
        return cls(arrays[3:], *arrays[:3])


def _keyed(text: bytes, min_chars: int) -> tuple[list[bytes], list[tuple[int, bytes]]]:
    """A text's lines, and (place, hash) of those that are long enough."""
    lines = text.split(b"\n")
    return lines, [(i, xxhash.xxh3_128_digest(k)) for i, x in enumerate(lines) if len(x) >= min_chars and long_enough(k := line_key(x), min_chars)]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, id): the distinct hashes of the long lines of each row; id is its doc_id."""

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, ids = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            own = {h for _, h in _keyed(text, min_chars)[1]}
            digests += own
            ids += [doc_id] * len(own)
        h1, h2 = _halves(digests)
        return pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(ids, pa.int64())], ["h1", "h2", "id"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), keys, T.StructType([T.StructField(n, T.LongType()) for n in ("h1", "h2", "id")]))


def line_counts(hashes: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, largest): distinct doc_ids, null being one, and the largest doc_id of every hash.

    A hash's ids are first made distinct, dealt by hash and id, so a very common line is no hot key."""
    own = hashes.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    return own.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("largest"))


def build_index(counts: DataFrame, shard_keys: int) -> tuple[DataFrame, int]:
    """(shard, probes, blob) of perfect hashes over the keys of counts, and the number of shards; probes is how many
    documents hold a key of the shard, once for each."""
    shards = max(1, -(-counts.count() // shard_keys))

    def one(table: pa.Table) -> pa.Table:
        h1, h2, n = (table.column(c).to_numpy() for c in ("h1", "h2", "n_docs"))
        # Only a null id can have no largest one; its count is 1.
        blob = PerfectHash.build(h1, h2, n, table.column("largest").fill_null(0).to_numpy()).to_bytes()
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "probes": pa.array([int(n.sum())], pa.int64()), "blob": pa.array([blob], pa.binary())})

    dealt = counts.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("long"))
    return materialize(dealt.groupBy("shard").applyInArrow(one, "shard long, probes long, blob binary"), "line-shards"), shards


def lost_hashes(hashes: DataFrame, index: DataFrame, shards: int, min_docs: int, task_probes: int) -> DataFrame:
    """(id, h1, h2): the hashes that documents lose, from a probe of each (h1, h2, id) in its shard."""
    parts = index.select("shard", F.ceil(F.col("probes") / task_probes).alias("parts"))
    many = materialize(parts.where("parts > 1"), "line-many")  # at most probes / task_probes rows
    own = F.coalesce("parts", F.lit(1))
    probes = hashes.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("long")).join(bounded(many), "shard", "left")
    probes = probes.select("shard", F.pmod(F.xxhash64("id", "h2"), own).alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("blob"), "h1", "h2", "id")
    none = F.lit(None).cast("long")
    blobs = index.join(parts.withColumnRenamed("shard", "__s"), F.col("shard") == F.col("__s"))
    blobs = blobs.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "blob", none.alias("h1"), none.alias("h2"), none.alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: PerfectHash | None = None
        for batch in batches:
            # A shard's blob comes before its probes.
            starts = np.nonzero(batch.column("kind").to_numpy() == 0)[0].tolist()
            for lo, hi in zip([-1, *starts], [*starts, batch.num_rows], strict=True):
                if lo >= 0:
                    found = PerfectHash.from_bytes(batch.column("blob")[lo].as_py())
                some = batch.slice(lo + 1, hi - lo - 1)
                if not some.num_rows:
                    continue
                h1, h2 = some.column("h1").to_numpy(), some.column("h2").to_numpy()
                at = found.find(h1, h2)
                ids = some.column("id")
                other = np.asarray(ids.is_null()) | (ids.fill_null(0).to_numpy() != found.largest[at])
                gone = pa.array((at >= 0) & (found.count[at] >= min_docs) & other)
                yield pa.RecordBatch.from_arrays([some.column(c).filter(gone) for c in ("id", "h1", "h2")], ["id", "h1", "h2"])

    rows = blobs.union(probes).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
    out = materialize(rows.mapInArrow(run, "id long, h1 long, h2 long"), "line-lost")
    release(many)
    return out


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, shard_keys: int = SHARD_KEYS, task_probes: int = TASK_PROBES) -> DataFrame:
    """docs (doc_id, text, ...) with the repeated lines taken out of text, plus
    n_lines (before) and n_dropped, both long.

    A key found in at least min_docs documents, that is distinct doc_ids, loses all its lines except in
    the rows of the largest doc_id that holds it. A null text is one empty
    line and becomes ''. A null doc_id counts as a document and as smaller than any other. Rows that
    repeat a doc_id are one document, each loses its lines; a text that loses all lines becomes ''. Other
    columns pass through, but for those named n_lines or n_dropped, which are
    replaced. No rows in, no rows out."""
    docs = without(docs, ["n_lines", "n_dropped", "__id", "__lost"])
    hashes = line_hashes(docs, min_chars)
    counts = materialize(line_counts(hashes), "line-counts")
    index, shards = build_index(counts, shard_keys)
    lost = lost_hashes(hashes, index, shards, min_docs, task_probes)
    release(counts, index)
    # The list of a document is no longer than its text.
    own = lost.distinct().groupBy(F.col("id").alias("__id")).agg(F.collect_list(F.struct("h1", "h2")).alias("__lost"))
    release_at_exit(lost)
    rows = docs.join(own, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left").select(*docs.columns, "__lost")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return map_arrow(rows, _dropper(min_chars, [c.lower() for c in docs.columns].index("text")), schema)


def _dropper(min_chars: int, at_text: int):
    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, lost = text_bytes(batch.column(at_text)), batch.column(batch.num_columns - 1)
        kept, counts, dropped = [], [], []
        for k, text in enumerate(texts):
            if not lost[k].is_valid:
                kept.append(text)
                counts.append(text.count(b"\n") + 1)
                dropped.append(0)
                continue
            own = {np.array([x["h1"], x["h2"]], "<i8").tobytes() for x in lost[k].as_py()}
            lines, keys = _keyed(text, min_chars)
            gone = {i for i, h in keys if h in own}
            kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone))
            counts.append(len(lines))
            dropped.append(len(gone))
        columns = list(batch.columns[:-1])
        columns[at_text] = pa.array(kept, pa.binary()).cast(batch.column(at_text).type)
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], [*batch.schema.names[:-1], "n_lines", "n_dropped"])

    return drop


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line,
             regexp_replace(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, (f.k IS NOT NULL AND l.doc_id <> f.top) AS lost FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
