"""Best-fit packing by length histogram.

1. Documents become token ids and then pieces of at most max_tokens. Every
   task numbers its pieces within their length. The pieces are written to the
   shared folder, so the numbers stay as they are.
2. Only the counts by length (at most max_tokens rows) reach the driver,
   where best fit decreasing runs over counts: a step places as many pieces of one length
   as fit into all bins that have the same room left. The plan is a few rows
   per length: ranks from, sequences from, offset.
3. Pieces take their slots by joining the plan on rank within length.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import materialize, ship

SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COMPARED = 64


class ByteBpe:
    """Ids of whole texts by a BPE file of the tokenizers library, used as it is: the file's added tokens
    (as '<|endoftext|>') are found in a text and have their own ids; none are put around it.

    A byte-level file whose merges are in the order of their ids is the same map as a
    table of ranks, which tiktoken applies several times faster: both split a text by the same pattern, write its
    words as bytes, and join, again and again, the pair whose merge comes first, that is, whose result has the lowest
    id. That the file is of this kind is read from the file itself: its pattern, its normaliser, and that merge
    i makes token 256 + i, for all of them. If it isn't, tokenizers encodes all. Texts that hold an added token
    always go to tokenizers, which knows the token's rules. Besides, both libraries encode the first texts of a
    worker and one text of every batch after them; if they ever differed, the job would fail."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path
        self.tokenizer = self._load()
        file = json.loads(Path(path).read_text())
        self.added = tuple(t["content"] for t in file.get("added_tokens") or ())
        self.ranked = self._ranked(file)
        self.compared = 0

    def _load(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _ranked(file: dict):
        """The tiktoken encoding of the file, None if it isn't of that kind."""
        model, before = file["model"], file["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not file["normalizer"]
        if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            return None
        merged = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
        if len(model["vocab"]) != 256 + len(merged) or merged != list(range(256, 256 + len(merged))):
            return None
        import tiktoken

        # Byte-level files write a byte as itself if it is printable, others as the characters from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        others = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.ranked is None:
            return self._slow(texts)
        odd = [i for i, t in enumerate(texts) if self._holds_added(t)]
        plain = [t for t in texts if not self._holds_added(t)] if odd else texts
        ids = [self.ranked.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() for t in plain]
        some = range(len(plain)) if self.compared < COMPARED else [self.compared % len(plain)] if plain else []
        for i, x in zip(some, self._slow([plain[i] for i in some]), strict=True):
            if ids[i] != x:
                raise ValueError(f"the table of ranks and tokenizers differ on a text that begins with {plain[i][:80]!r}")
        self.compared += len(some)
        for i, x in zip(odd, self._slow([texts[i] for i in odd]), strict=True):
            ids.insert(i, x)
        return ids

    def _holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def _slow(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        self.tokenizer = self.tokenizer or self._load()
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_LOADED: dict[str, ByteBpe] = {}


def load_tokenizer(path: str) -> ByteBpe:
    """One tokenizer for each worker process, so that tasks find what others looked up."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def plan(counts: dict[int, int], most: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: rows (length, rank, pieces, per_bin, sequence,
    offset): pieces of this length from this rank on go per_bin to a sequence, from
    this sequence and offset on. The number of rows grows with the lengths, not with the pieces."""
    room: dict[int, list[tuple[int, int]]] = {}
    rows, bins = [], 0

    def put(length: int, rank: int, left: int, start: int, n: int, space: int) -> int:
        """Fill n bins that have this space; how many pieces that took."""
        per = space // length
        full = min(n, left // per)
        if full:
            rows.append((length, rank, full * per, per, start, most - space))
            room.setdefault(space - full_size(per, length), []).append((start, full))
        taken, rest = full * per, left - full * per
        if n > full and rest and rest < per:
            rows.append((length, rank + taken, rest, rest, start + full, most - space))
            room.setdefault(space - rest * length, []).append((start + full, 1))
            taken, full = taken + rest, full + 1
        if n > full:
            room.setdefault(space, []).append((start + full, n - full))
        return taken

    full_size = lambda per, length: per * length
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for space in sorted(s for s in room if s >= length):
            for start, n in room.pop(space):
                taken = put(length, rank, left, start, n, space) if left else room.setdefault(space, []).append((start, n)) or 0
                rank, left = rank + taken, left - taken
        if left:
            n = -(-left // (most // length))
            put(length, rank, left, bins, n, most)
            bins += n
    return rows


def pieces(docs: DataFrame, tokenizer: str, most: int, end_id: int | None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, local): one row per piece;
    local numbers the pieces of one length within the task called part."""
    ship(docs.sparkSession)
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "local")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen, part = load_tokenizer(tokenizer), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = []
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc_id, ids in zip(some.column(0).to_pylist(), bpe.encode(texts), strict=True):
                    ids = ids + end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, most)):
                        rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, local long")


def pack(docs: DataFrame, tokenizer: str, most: int = 1024, end_id: int | None = 2) -> DataFrame:
    """Pieces of docs (doc_id, text, ...) with their slots: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    Every row of docs is packed: a null or empty text has the end token alone (without
    an end token: one piece of length 0, which takes no room, at offset 0 of sequence -1). Rows that
    repeat a doc_id, null ones included, are packed each. Other columns of docs are not read."""
    spark = docs.sparkSession
    rows = materialize(pieces(docs, tokenizer, most, end_id), "pieces")
    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect() if r[0]}  # at most `most` rows
    slots = spark.createDataFrame(plan(totals, most) or [(0, 0, 0, 1, 0, 0)], "p_length long, p_rank long, p_pieces long, p_per long, p_sequence long, p_offset long")
    ranked = rows.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    fits = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_rank")) & (F.col("rank") < F.col("p_rank") + F.col("p_pieces"))
    nth = F.col("rank") - F.col("p_rank")
    return ranked.join(F.broadcast(slots), fits, "left").select(  # the plan: a few rows for each length
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce(F.col("p_sequence") + F.floor(nth / F.col("p_per")), F.lit(-1)).cast("long").alias("sequence_id"),
        F.coalesce(F.col("p_offset") + nth % F.col("p_per") * F.col("length"), F.lit(0)).cast("long").alias("offset"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
