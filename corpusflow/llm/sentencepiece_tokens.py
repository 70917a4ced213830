"""SentencePiece models run by the tokenizers library.

The model's protobuf is parsed here, without the sentencepiece library: pieces with
scores and types, trainer and normaliser settings. They are rebuilt as a tokenizers
pipeline: normaliser (compiled character map, extra spaces, dummy prefix, spaces as the metaspace
marker), a Unigram model with its scores or a BPE model whose merges are ordered by piece score,
byte fallback, and a decoder that undoes all that. Batches are encoded and decoded by the
library's threads; where no piece goes over the start of a word, a worker has each word encoded once and puts
texts together of their words' ids. The ids of every text are compared with those that the sentencepiece
library finds for the whole text; a difference is an error.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import ship, without

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
BATCH = 128
THREADS = 2
# A part has this many characters or more and ends where a word does: before a marker that follows other characters.
PART = re.compile(f".{{1,400}}{MARK}*[^{MARK}]*", re.DOTALL)
KNOWN = 1 << 21  # ids of words that a worker keeps


def wire(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: ints, 4 or 8 raw bytes, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError("not a SentencePiece model")
            size = varint()
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    fewer_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, raw: bytes) -> Model:
        out = cls()
        for number, value in wire(raw):
            if number == 1:
                own = dict(wire(value))
                out.pieces.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 2:
                own = dict(wire(value))
                out.kind, out.byte_fallback, out.unknown = own.get(3, UNIGRAM), bool(own.get(35, 0)), own.get(40, 0)
            elif number == 3:
                own = dict(wire(value))
                out.charsmap = own.get(2, b"")
                out.dummy_prefix, out.fewer_spaces, out.escape_spaces = (bool(own.get(k, 1)) for k in (3, 4, 5))
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return out

    def merges(self) -> list[tuple[str, str]]:
        """Every way to make a piece of two others, best score first."""
        score = {p: s for p, s, t in self.pieces if t in (NORMAL, USER_DEFINED)}
        rank = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        found = [(-s, rank[p], rank[p[:i]], rank[p[i:]], p[:i], p[i:]) for p, s in score.items() for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
        return [(a, b) for *_, a, b in sorted(found)]

    def words_are_apart(self) -> bool:
        """Whether no piece goes on after a metaspace marker that follows other characters."""
        return self.kind == BPE and not any(MARK in p.lstrip(MARK) for p, _, t in self.pieces if t == NORMAL) and not any(t == USER_DEFINED for _, _, t in self.pieces)

    def spaces_only(self) -> bool:
        """Whether all that normalising does is a dummy prefix and markers for spaces."""
        return self.dummy_prefix and self.escape_spaces and not self.fewer_spaces and not self.charsmap and not any(t == USER_DEFINED for _, _, t in self.pieces)

    def in_parts(self) -> bool:
        """Whether a text's ids are those of its words: they are apart, and begin with markers, which are all that normalising puts in."""
        return self.spaces_only() and self.words_are_apart() and (MARK, NORMAL) in {(p, t) for p, _, t in self.pieces}

    def tokenizer(self):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unknown = self.pieces[self.unknown][0]
        if self.kind == UNIGRAM:
            lowest = min((s for _, s, _ in self.pieces), default=0.0)
            scores = [(p, s if t in (NORMAL, USER_DEFINED) else lowest - 1e6) for p, s, t in self.pieces]
            out = Tokenizer(models.Unigram(scores, unk_id=self.unknown, byte_fallback=self.byte_fallback))
        else:
            out = Tokenizer(models.BPE({p: i for i, (p, _, _) in enumerate(self.pieces)}, self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback, **({"cache_capacity": 0} if self.in_parts() else {})))
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.fewer_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape_spaces else " "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        if self.words_are_apart() and not self.in_parts():
            # Merges never cross the start of a word, so words may be looked up one by one. (Parts are faster: a word costs more to split off than to merge.)
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        own = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        out.decoder = decoders.Sequence([*own, decoders.Strip(" ", 1, 0)] if self.dummy_prefix else own)
        out.add_tokens([AddedToken(p, normalized=True, special=False) for p, _, t in self.pieces if t == USER_DEFINED])
        return out


def apart(marked: str) -> str:
    """A marked text, which has no spaces, with spaces between words: before each marker that follows another character."""
    out = marked.replace(MARK, f" {MARK}")
    while (twin := f"{MARK} {MARK}") in out:
        out = out.replace(twin, MARK * 2)
    return out.removeprefix(" ")


def differ(text: str) -> ValueError:
    return ValueError(f"the rebuilt tokenizer and sentencepiece differ on a text that begins with {text[:80]!r}")


class Codec:
    """Encodes and decodes batches of texts by a model file."""

    def __init__(self, path: str):
        # As many threads as a task may count on: more only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        model = Model.parse(Path(path).read_bytes())
        self.path, self.tokenizer, self.spaces_only, self.in_parts = path, model.tokenizer(), model.spaces_only(), model.in_parts()
        if self.spaces_only:  # done on whole strings: the tokenizer's normaliser keeps the place of every character
            from tokenizers import normalizers

            self.tokenizer.normalizer = normalizers.Sequence([])
        self.processor, self.prefix = None, " " * model.dummy_prefix
        # The bytes of normal pieces and of byte pieces, null for others.
        spelled = {i: p.replace(MARK, " ").encode() for i, (p, _, t) in enumerate(model.pieces) if t == NORMAL and not p.startswith("<0x")}
        spelled |= {i: bytes([int(p[3:5], 16)]) for i, (p, _, t) in enumerate(model.pieces) if t == BYTE}
        self.spelled = pa.array([spelled.get(i) for i in range(len(model.pieces))], pa.large_binary())
        self.begins, self.marks = (np.array([t == NORMAL and f(p) for p, _, t in model.pieces], bool) for f in (lambda p: p.startswith(MARK), lambda p: not p.strip(MARK)))
        self.forget()

    def forget(self):
        """Drops the words seen: their numbers, and the ids of word n, known[ends[n]:ends[n + 1]]."""
        self.number: dict[str, int] = {}
        self.known, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.tolist() for x in self.arrays(texts)]

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, compared with the library's."""
        given = [MARK + t.replace(" ", MARK) if t else t for t in texts] if self.spaces_only else texts
        out = self.of_words(texts, given) if self.in_parts else [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(given, add_special_tokens=False)]
        for text, own, expected in zip(texts, out, self.library().encode(texts, out_type="numpy", num_threads=1), strict=True):
            if not np.array_equal(own, expected):
                self.forget()
                raise differ(text)
        return out

    def of_words(self, texts: list[str], given: list[str]) -> list[np.ndarray]:
        """The ids of each text by those of its words. The tokenizer gets each text's new words, in a row; only the last can be markers alone."""
        lists = pc.split_pattern(pa.array([apart(t) or None for t in given], pa.large_string()), " ")
        words, n_words = lists.flatten().dictionary_encode(), pc.list_value_length(lists).fill_null(0).to_numpy()
        own, at = words.dictionary.to_numpy(zero_copy_only=False), words.indices.to_numpy()
        # Words are numbered as they come, so a word is first met where the number is above all before.
        first = np.flatnonzero(np.diff(np.maximum.accumulate(at), prepend=-1))
        text_of = np.repeat(np.arange(len(texts)), n_words)[first]
        number = np.fromiter(map(self.number.get, own, repeat(-1)), np.int64, len(own))
        new = np.flatnonzero(number < 0)
        number[new] = np.arange(len(self.number), len(self.number) + len(new))
        fresh: list[list[str]] = [[] for _ in texts]
        for word, i in zip(own[new], text_of[new].tolist(), strict=True):
            fresh[i].append(word)
        found = self.tokenizer.encode_batch_fast([PART.findall("".join(x)) for x in fresh], is_pretokenized=True, add_special_tokens=False)
        found = [np.array(e.ids, np.int32) for e in found]
        # A word begins with a piece that does, unless markers alone are before it in the word.
        flat, sizes = np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        begins = self.begins[flat]
        begins[1:] &= ~self.marks[flat[:-1]]
        begins[(sizes.cumsum() - sizes)[sizes > 0]] = True
        for text, sent, n in zip(texts, fresh, np.bincount(np.repeat(np.arange(len(found)), sizes), begins, len(found)), strict=True):
            if len(sent) != n:
                raise differ(text)
        self.number.update(zip(own[new], number[new].tolist(), strict=True))
        self.ends = np.concatenate([self.ends, len(self.known) + np.append(np.flatnonzero(begins), len(flat))[1:]])
        self.known = np.concatenate([self.known, flat])
        ids = pa.LargeListArray.from_arrays(pa.array(self.ends), pa.array(self.known)).take(pa.array(number[at]))
        ends = ids.offsets.to_numpy()[np.append(0, n_words.cumsum())]
        flat = ids.values.to_numpy()
        out = [flat[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        if len(self.known) > KNOWN:
            self.forget()
        return out

    def library(self):
        """The sentencepiece library's processor of the model. Parity can't be verified without it, so it must be there."""
        if self.processor is None:
            import sentencepiece

            self.processor = sentencepiece.SentencePieceProcessor(model_file=self.path)
        return self.processor

    def decode(self, ids: list[list[int] | np.ndarray]) -> list[str]:
        """Texts of normal pieces and bytes are spelled out. Pieces are whole characters, so a text's bytes are UTF-8 just where each run
        of bytes is; where one is not, or ids hold anything else, the tokenizer decodes."""
        flat = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, np.int32) for x in ids)])
        pieces = self.spelled.take(pa.array(flat, mask=(flat < 0) | (flat >= len(self.spelled))))
        ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int64())
        out: list[str | None] = []
        for raw in pc.binary_join(pa.LargeListArray.from_arrays(ends, pieces), pa.scalar(b"", pa.large_binary())).to_pylist():
            try:
                out.append(None if raw is None else raw.decode().removeprefix(self.prefix))
            except UnicodeDecodeError:
                out.append(None)
        rest = [i for i, t in enumerate(out) if t is None]
        for i, text in zip(rest, self.tokenizer.decode_batch([list(map(int, ids[i])) for i in rest], skip_special_tokens=False), strict=True):
            out[i] = text
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """docs (text, ...) plus ids: array<int>. A null or empty text has an empty array. Other columns
    and repeated rows pass through; a column that is already named ids is replaced."""
    ship(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        own, out = codec(model), []
        for at in range(0, len(texts), BATCH):
            out += own.arrays([t or "" for t in texts.slice(at, BATCH).to_pylist()])
        return pa.array(out, pa.list_(pa.int32()))

    return without(docs, ["ids"]).withColumn("ids", ids("text"))


def decode(docs: DataFrame, model: str) -> DataFrame:
    """docs (ids, ...) plus text. Null or empty ids have the text ''. Other columns pass
    through; a column that is already named text is replaced."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        own, out = codec(model), []
        for at in range(0, len(ids), BATCH):
            out += own.decode([x or [] for x in ids.slice(at, BATCH).to_pylist()])
        return pa.array(out, pa.string())

    return without(docs, ["text"]).withColumn("text", text("ids"))


def summarise(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip) for each row of docs (doc_id, text, ...):
    ids_crc32 is of the little-endian unsigned 32-bit ids, round_trip whether decoding gives the text
    back. A null text is empty, with no ids. Ids stay in the worker, so long texts do not move them."""
    ship(docs.sparkSession)

    @F.arrow_udf("struct<n_tokens:bigint,ids_crc32:bigint,round_trip:boolean>")
    def summary(texts: pa.Array) -> pa.Array:
        own, n, crc, same = codec(model), [], [], []
        for at in range(0, len(texts), BATCH):
            some = [t or "" for t in texts.slice(at, BATCH).to_pylist()]
            ids = own.arrays(some)
            n += [len(x) for x in ids]
            crc += [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            same += [a == b for a, b in zip(own.decode(ids), some, strict=True)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], ["n_tokens", "ids_crc32", "round_trip"])

    return docs.select(F.col("doc_id"), summary("text").alias("__s")).select("doc_id", "__s.*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return summarise(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())
