"""N-gram Jaccard join with PartEnum signatures (Arasu, Ganti, Kaushik 2006).

A document's set holds the 64-bit hashes of its distinct word n-grams. Two sets
of sizes up to r with Jaccard similarity of at least a/b differ in at most
k = 2r(b-a)/(b+a) elements. For each band of sizes the hash domain is cut
into n1 groups of PARTS parts; if k < 2 * n1, some group differs in at most one element, so all
its parts but one are equal, and each subset of PARTS - 1 parts is a signature.

Groups in which a set has few elements make weak signatures that many sets
share. A set whose strong groups alone number more than k / 2 emits these only, other sets emit all
groups. No pair is lost. Let A and B have no signature in common. Whether a group is strong depends on what the
set has in it, so a group that is strong in one of them only differs by an element at least,
and one that both emit by two. If both emit strong groups only, they differ by |strong in A| + |strong
in B| > k elements at least; if one emits all, by two in each strong group of the other, again more than k; if both do, by
two in each of the n1 groups.

Sets that share a signature are candidates. Signatures with the same members count once.
Within a signature a parity sketch (bit h mod B flipped for every element h) bounds the difference
of two sets from below, so it only drops pairs that cannot link. What decides is the exact
comparison of whole sets. A signature's sets are dealt into chunks. At first each chunk meets itself and the
first one, and forests of what the sketches let pass are drawn and compared. A signature is done once its sets are one
component, or if it is one chunk and its forest held. For the rest, chunks of the sets outside the largest
component meet all other chunks, each pair of chunks a task, and the closest pairs between different
components are drawn, more in every round until none was left out. So the components are those of all links.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import bounded, joined, materialize, release, release_at_exit, ship, splitmix, text_bytes, without

WORD_CACHE = 100_000
BAND = 1.25
MARGIN = 1.15
PARTS = 2
CHUNK = 256
MEET = 2048
MOST = 64
MEMBERS = 4096
SLICE = 512


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the n-word shingles of a UTF-8 text.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. Fewer than n words make
    one shingle of all of them; no words make none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    count = len(words) - n + 1
    out = splitmix(h[:count] + np.uint64(n))
    for i in range(1, n):
        out = splitmix(out ^ (h[i : i + count] * np.uint64(0x9FB21C651E98DF25)))
    return np.unique(out)


@dataclass(frozen=True)
class Band:
    """One PartEnum instance: sets of sizes up to `most`, from `least` on."""

    least: int
    most: int
    k: int
    groups: int
    tag: int

    @property
    def weak(self) -> int:
        """A group is strong if all but its largest part hold this many elements together."""
        return max(1, int(0.9 * self.most / self.groups * (PARTS - 1) / PARTS / 2))


class Bands:
    """The instances for similarity num/den, made for sizes as they come."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.all: list[Band] = []
        self.edge = 0
        while self._k(self.edge + 1) == 0:
            self.edge += 1  # sets of these sizes link only if they are equal

    def _k(self, most: int) -> int:
        return 2 * most * (self.den - self.num) // (self.den + self.num)

    def of(self, size: int) -> list[Band]:
        """Where a set of this size takes part: its own band and those above it
        that hold sizes of possible partners."""
        top = size * self.den // self.num
        last = self.all[-1].most if self.all else self.edge
        while last < top:
            least, last = last + 1, max(last + 1, int(last * BAND))
            k = self._k(last)
            self.all.append(Band(least, last, k, max(1, -(-int((k + 1) * MARGIN) // 2)), len(self.all)))
        return [b for b in self.all if b.least <= top and b.most >= size]


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures (int64) of a sorted set; none for a set that links with equal sets only."""
    if not len(s):
        return np.zeros(0, np.int64)
    g, out = splitmix(s ^ np.uint64(0xA0761D6478BD642F)), []
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(g, dtype=np.uint64)])
    for band in bands.of(len(s)):
        n = PARTS * band.groups
        edges = (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
        sums, sizes = np.diff(total[at]).reshape(-1, PARTS), np.diff(at).reshape(-1, PARTS)
        strong = sizes.sum(1) - sizes.max(1) >= band.weak
        if 2 * strong.sum() <= band.k:
            strong[:] = True
        sums, group = sums[strong], np.nonzero(strong)[0].astype(np.uint64)
        whole = sums.sum(1, dtype=np.uint64)
        for part in range(PARTS):  # the subset of all parts but this one
            tag = splitmix(group * np.uint64(PARTS) + np.uint64(part + (band.tag << 40)))
            out.append(splitmix((whole - sums[:, part]) ^ tag))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sketch(s: np.ndarray, k: int) -> bytes:
    """Parities of the elements' counts in B places, B a power of two of about 8 k, 2^17 (16 KB) at
    most. Half of it xor the other half is the sketch for B / 2."""
    bits = min(1 << 17, max(64, 1 << (8 * k - 1).bit_length()))
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """A row of uint64 words for each sketch, all of the shortest's length."""
    least = min(map(len, sketches))
    out = np.empty((len(sketches), least // 8), np.uint64)
    for i, raw in enumerate(sketches):
        words = np.frombuffer(raw, "<u8")
        while len(words) > out.shape[1]:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        out[i] = words
    return out


def _sets(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sketch): s1 and s2 are a 128-bit hash of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                sizes, whole, sketches = [], [], []
                for text in text_bytes(some.column(1)):
                    s = shingles(text, n)
                    sizes.append(len(s))
                    whole.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sketches.append(sketch(s, 2 * len(s) * (den - num) // (den + num)))
                both = np.frombuffer(b"".join(whole), "<i8").reshape(-1, 2)
                columns = [some.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "s1", "s2", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, sketch binary")


def _signed(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(sig, s1): every signature of every set. They go straight into the shuffle: computing sets a
    second time costs less than writing all signatures to disk besides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                sigs, sets = [], []
                for text in text_bytes(batch.column(0).slice(at, SLICE)):
                    s = shingles(text, n)
                    sigs.append(signatures(s, bands))
                    s1 = int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[:8], "little", signed=True)
                    sets.append(np.full(len(sigs[-1]), s1, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(sets))], ["sig", "s1"])

    return docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(run, "sig long, s1 long")


def _runs(key: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    return np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)


def _shared(rows: DataFrame) -> DataFrame:
    """(key, y, side, s1): the distinct sets of every signature that has several, dealt to the tasks (key, y) of the first round.

    A signature's sets are cut into chunks of CHUNK. A task is a chunk with itself (side 1) and, after the
    first, with the first chunk (side 0), so rows are doubled at most. Up to MEMBERS sets the key is a hash of the
    members, so signatures with the same members have one key; beyond, it is the signature.
    Rows come sorted by signature and set, sets being hashes, and are streamed; MEMBERS rows are held at
    most. A very common signature is one in a hundred or so of each set's, and costs its task a pass over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, done = None, [], OrderedDict()
        seen, first = 0, np.zeros(0, np.int64)  # of a signature of more than MEMBERS sets: those given so far, its first chunk
        out: list[tuple[int, int, int, np.ndarray]] = []

        def give(key: int, members: np.ndarray) -> None:
            """Deal the next members of a signature."""
            nonlocal seen, first
            for lo in range(0, len(members), CHUNK):
                some, y = members[lo : lo + CHUNK], (seen + lo) // CHUNK
                if y:
                    out.append((key, y, 0, first))
                else:
                    first = some
                out.append((key, y, 1, some))
            seen += len(members)

        def close() -> None:
            nonlocal seen, first
            members = np.concatenate(held) if held else np.zeros(0, np.int64)
            if seen:
                give(at, members)
            elif len(members) > 1:
                key = int.from_bytes(xxhash.xxh3_64_digest(members.tobytes()), "little", signed=True)
                if key not in done:
                    done[key] = None
                    if len(done) > 100_000:
                        done.popitem(last=False)
                    give(key, members)
            seen, first = 0, np.zeros(0, np.int64)

        def rows_out() -> pa.RecordBatch:
            sizes = [len(x[3]) for x in out]
            columns = [np.repeat(np.array([x[k] for x in out], np.int64), sizes) for k in range(3)] + [np.concatenate([x[3] for x in out])]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "y", "side", "s1"])

        for batch in batches:
            if not batch.num_rows:
                continue
            sig, s1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (s1[1:] != s1[:-1])])
            if held and sig[0] == at and s1[0] == held[-1][-1]:
                fresh[0] = False
            sig, s1 = sig[fresh], s1[fresh]
            edges = _runs(sig)
            alone = np.diff(edges) == 1
            for lo, hi, one in zip(edges[:-1].tolist(), edges[1:].tolist(), alone.tolist(), strict=True):
                if one and hi < len(sig) and (lo or sig[lo] != at):
                    continue  # a signature of one set
                if at is None or sig[lo] != at:
                    close()
                    at, held = int(sig[lo]), []
                held.append(s1[lo:hi])
                if sum(map(len, held)) > MEMBERS:  # whole chunks go, one set at least stays
                    members = np.concatenate(held)
                    whole = (len(members) - 1) // CHUNK * CHUNK
                    give(at, members[:whole])
                    held = [members[whole:]]
            if out:
                yield rows_out()
        close()
        if out:
            yield rows_out()

    return rows.repartition("sig").sortWithinPartitions("sig", "s1").mapInArrow(run, "key long, y long, side long, s1 long")


def _meets_again(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """groups (key, rep, comp, ...) with (x, y, side): the tasks in which sets of different components meet.

    sizes has (key, size, major, others): a key's sets, its largest component and the sets outside it. Sets of
    the largest component need not meet each other, so every chunk of the others meets all chunks. Chunks of about MEET are dealt by the sets'
    hashes; they are larger than at first, as each goes to as many tasks as there are others."""
    rows = groups.join(bounded(sizes), "key")
    one, out = F.col("size") <= MEET, F.col("comp") != F.col("major")
    few = F.when(one, 1).otherwise(F.ceil(F.col("others") / MEET))
    many = F.when(one, 0).otherwise(F.ceil((F.col("size") - F.col("others")) / MEET))
    rows = rows.withColumns({"few": few, "many": many})
    at = F.pmod(F.xxhash64("rep"), F.when(out | one, F.col("few")).otherwise(F.col("many")))
    rows = rows.withColumn("own", at + F.when(out | one, 0).otherwise(F.col("few")))
    last = F.when(F.col("own") < F.col("few"), F.col("few") + F.col("many") - 1).otherwise(F.col("few") - 1)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    side = F.when(F.col("own") == F.col("other"), 1).when(F.col("own") < F.col("other"), 0).otherwise(2)
    return rows.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other"), "side": side}).drop(*sizes.columns[1:], "few", "many", "own", "other")


def _pairs(n: np.ndarray, comp: np.ndarray, side: np.ndarray, words: np.ndarray, num: int, den: int, most: int) -> tuple[list[tuple[int, int]], bool]:
    """Places of pairs whose sizes and sketches may link, whose components differ and whose sides may meet.

    With most = 0 they are a forest: a set gets one pair with each component, and both become one. Else a set gets
    the `most` pairs of least difference with each component; the second value tells whether others were left."""
    out, cut = [], False
    comp = comp.copy()
    for lo in range(0, len(n), 64):
        hi = min(lo + 64, len(n))
        differ = np.bitwise_count(words[lo:hi, None, :] ^ words[None, :hi]).sum(2, dtype=np.int64)
        mine, theirs = n[lo:hi, None], n[None, :hi]
        ok = (differ <= (mine + theirs) * (den - num) // (den + num)) & (np.minimum(mine, theirs) * den >= np.maximum(mine, theirs) * num)
        ok &= (np.arange(hi)[None] < np.arange(lo, hi)[:, None]) & ((side[lo:hi, None] != side[None, :hi]) | (side[None, :hi] == 1))
        for i in np.nonzero(ok.any(1))[0].tolist():
            near = np.nonzero(ok[i])[0]
            near = near[comp[near] != comp[lo + i]]
            if not len(near):
                continue
            if not most:
                _, at = np.unique(comp[near], return_index=True)
                near = near[at]
                comp[np.isin(comp, comp[near])] = comp[lo + i]
            elif len(near) > most:
                near = near[np.lexsort((differ[i, near], comp[near]))]
                first = np.searchsorted(comp[near], comp[near])
                keep = np.arange(len(near)) - first < most
                cut |= not keep.all()
                near = near[keep]
            out += [(j, lo + i) for j in near.tolist()]
    return out, cut


def _draw(rows: DataFrame, num: int, den: int, most: int) -> DataFrame:
    """From (key, x, y, side, rep, n, comp, sketch): (key, a, b), a < b, the pairs that each task (key, x, y) draws,
    and (key, null, null) if it left others. A task's rows are held: about two chunks."""
    columns = ["rep", "n", "comp", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        keys, firsts, seconds = [], [], []

        def close() -> None:
            if not held:
                return
            rep, n, comp, side = (np.concatenate([h[0][k] for h in held]) if len(held) > 1 else held[0][0][k] for k in range(4))
            raw = [x for h in held for x in h[1].to_pylist()]
            held.clear()
            if len(rep) < 2 or (comp == comp[0]).all():
                return
            pairs, cut = _pairs(n, comp, side, folded(raw), num, den, most)
            for i, j in pairs:
                keys.append(at[0])
                firsts.append(min(int(rep[i]), int(rep[j])))
                seconds.append(max(int(rep[i]), int(rep[j])))
            if cut:
                keys.append(at[0])
                firsts.append(None)
                seconds.append(None)

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, firsts, seconds)], ["key", "a", "b"])
            for c in (keys, firsts, seconds):
                c.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            place = [batch.column(c).to_numpy() for c in ("key", "x", "y")]
            values, sketches = [batch.column(c).to_numpy() for c in columns], batch.column("sketch")
            differ = np.any([p[1:] != p[:-1] for p in place], axis=0)
            edges = np.concatenate([[0], np.nonzero(differ)[0] + 1, [batch.num_rows]]).tolist()
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                now = tuple(int(p[lo]) for p in place)
                if now != at:
                    close()
                    at = now
                held.append(([v[lo:hi] for v in values], sketches.slice(lo, hi - lo)))
            if keys:
                yield give()
        close()
        if keys:
            yield give()

    dealt = rows.select("key", "x", "y", *columns, "sketch").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "rep")
    return dealt.mapInArrow(run, "key long, a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b), a written table, whose whole sets have den * common >= num * union, as (u, v).

    An id that repeats with other texts has several sets; each is compared. Texts of b go to those of a; those of
    neither go nowhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[tuple[int, bytes], np.ndarray] = OrderedDict()

        def set_of(doc: int, text: bytes) -> np.ndarray:
            key = doc, xxhash.xxh3_128_digest(text)
            if key in known:
                known.move_to_end(key)
                return known[key]
            known[key] = shingles(text, n)
            if len(known) > 64:
                known.popitem(last=False)
            return known[key]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ok = []
            for x, y, s, t in zip(a, b, text_bytes(batch.column("ta")), text_bytes(batch.column("tb")), strict=True):
                p, q = set_of(x, s), set_of(y, t)
                common = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(den * common >= num * (len(p) + len(q) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["u", "v"])

    tb = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")).join(bounded(pairs), "b")
    ta = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).join(bounded(pairs.select("a")), "a", "left_semi")
    return tb.join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(run, "u long, v long")


class _Links:
    """Pairs compared so far and the stars (node, component) of those that link, copies (u, v) of one set from the start."""

    def __init__(self, docs: DataFrame, copies: DataFrame, n: int, num: int, den: int):
        self.docs, self.copies, self.rule = docs, copies, (n, num, den)
        self.comp: DataFrame | None = None
        self.tried: list[DataFrame] = []

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sets are not in one component yet."""
        x, y = (bounded(self.comp.select(F.col("node").alias(e), F.col("component").alias(f"__c{e}"))) for e in ("a", "b"))
        out = pairs.join(x, "a", "left").join(y, "b", "left")
        return out.where(F.coalesce("__ca", "a") != F.coalesce("__cb", "b")).select(pairs.columns)

    def named(self, groups: DataFrame) -> DataFrame:
        """groups (key, rep, ...) with comp, the component of each set."""
        comp = bounded(self.comp.select(F.col("node").alias("rep"), F.col("component").alias("comp")))
        return groups.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))

    def compare(self, pairs: DataFrame) -> None:
        """Compare the whole sets of distinct pairs (a, b) that were not tried before."""
        for before in self.tried:
            pairs = pairs.join(bounded(before), ["a", "b"], "left_anti")
        fresh = materialize(pairs.select("a", "b"), "jaccard-pairs")
        first = not self.tried
        self.tried.append(fresh)
        if not first and fresh.isEmpty():
            return
        found = _verify(fresh, self.docs, *self.rule)
        self.comp = joined(self.comp, found.union(self.copies) if first else found)


def jaccard_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of docs (doc_id, text, ...).

    Two documents link when den * |A and B| >= num * |A or B| over their sets of
    distinct n-word shingles; component_id is the smallest doc_id reachable by
    links. Null, empty and wordless texts have an empty set and link with nothing.
    Rows that repeat a doc_id are one node: what links with either is in its component. A null
    doc_id has no links and a null component_id. Other columns are not read."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = materialize(_sets(docs, n, num, den), "jaccard-sets")
    ids = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", F.col("n_shingles").alias("n"), "s1", "s2", "sketch")
    reps = materialize(ids.groupBy("s1", "s2", "n", "sketch").agg(F.min("doc_id").alias("rep")), "jaccard-reps")
    copies = ids.select("doc_id", "s1", "s2").join(reps.select("s1", "s2", "rep"), ["s1", "s2"]).where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    # Two sets of one s1 would both be found here and compared like others.
    shared = _shared(_signed(docs, n, num, den)).distinct()
    groups = materialize(shared.join(reps.select("s1", "rep", "n", "sketch"), "s1").select("key", "y", "side", "rep", "n", "sketch"), "jaccard-groups")
    links = _Links(texts, copies, n, num, den)

    # Every two sets of a task are compared by size and sketch. What passes is drawn as a forest; if
    # all its trees hold, so do the components. A pair brings two texts together, so at first each set gets one; then
    # those follow that are still apart.
    step = materialize(_draw(groups.withColumns({"comp": F.col("rep"), "x": F.lit(0)}), num, den, 0), "jaccard-step")
    links.compare(step.groupBy("b").agg(F.min("a").alias("a")))
    links.compare(links.apart(step.select("a", "b")).distinct())
    # Keys of a pair that did not link may have others between the same components, and chunks of large keys have met
    # the first only. Of these keys the ones that are not yet one component go on.
    again = links.apart(step).select("key").union(groups.where("y > 0").select("key")).distinct()
    own, most = groups.where("side = 1").select("key", "rep", "n", "sketch"), MOST
    while True:
        keys = materialize(again, "jaccard-keys")
        if keys.isEmpty():
            release(keys)
            break
        todo = materialize(links.named(own.join(bounded(keys), "key", "left_semi")), "jaccard-todo")
        parts = todo.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key")
        sizes = parts.agg(F.sum("c").alias("size"), F.max_by("comp", "c").alias("major"), (F.sum("c") - F.max("c")).alias("others"))
        sizes = materialize(sizes.where("others > 0"), "jaccard-sizes")
        release(step)
        step = materialize(_draw(_meets_again(todo, sizes), num, den, most), "jaccard-step")
        release(todo, sizes, keys)
        links.compare(step.where("a IS NOT NULL").select("a", "b").distinct())
        again, most = step.where("a IS NULL").select("key").distinct(), 64 * most
    comp = links.comp.withColumnsRenamed({"node": "doc_id", "component": "component_id"})
    out = sets.select("doc_id", "n_shingles").join(comp, "doc_id", "left")
    release(reps, groups, step, *links.tried)
    release_at_exit(sets, links.comp)
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_unique(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one document left of each class: that of the smallest doc_id. Rows
    that repeat the kept doc_id stay, rows of a null doc_id too."""
    gone = jaccard_classes(docs, n, num, den).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    gone, docs = materialize(gone, "jaccard-gone"), without(docs, ["__gone"])
    release_at_exit(gone)
    return docs.join(bounded(gone), F.col("doc_id") == F.col("__gone"), "left_anti")


def op7_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90, 100)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) END AS sh
  FROM w),
e AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u)
SELECT s.doc_id, len(s.sh) AS n_shingles, c.component_id
FROM s JOIN (SELECT u AS doc_id, min(v) AS component_id FROM r GROUP BY u) c USING (doc_id)
"""
