"""SimHash near-dedup with pivot distance tables.

1. A fingerprint a text: 64 bits by majority over the XXH64 hashes of its word shingles. Documents are then represented
   by their distinct fingerprints, so exact copies cost nothing further.
2. Candidates: two fingerprints within r bits agree on at least blocks - r of `blocks` bit blocks. Each fingerprint is
   listed under every choice of blocks - r blocks; only lists of two or more go on.
3. Lists of up to `bucket_cap`: the Hamming distances of each fingerprint to reference fingerprints (pivots) are tabulated;
   a pair whose tables differ by more than r at any pivot cannot be within r (triangle inequality) and is discarded;
   survivors are verified. Longer lists are linked exactly without pairs (r = 2): two fingerprints within 2 bits share a
   point within one bit of both, so members that reach a common point are linked to the least of them, 33 points each.
4. Connected components of the links, by alternating large-star and small-star steps on tables with reliable checkpoints.

Edge cases: null or empty text has the fingerprint 0 and is linked like any other; with fewer words than a shingle the
whole word sequence is one shingle; null ids take part but never name a component unless all its ids are null; repeated
rows repeat; an empty table gives no rows; ties of the least id are one id, and of equal (id, text) rows `drop_near_duplicates`
keeps one, all of whose columns then come from one row; other columns may have any names; a very long text is hashed in one
pass, its shingles' hashes (eight bytes a word) in memory. Texts are known by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freeing_shuffles, map_arrow, materialize, release, slices, text_of

BLOCKS = 4
RADIUS = 2
N_PIVOTS = 16
BUCKET_CAP = 48
#: Texts drawn to find hot shingles, copies of one among them that make it hot, and the most that are kept.
HOT_SAMPLE = 4_000
HOT_COUNT = 4
HOT_MOST = 100_000
#: Members of one list that are compared in one piece; bounds memory only.
LIST_CAP = 512
#: Bits of the sketch that each of them brings, for sets of any size: those of long texts discard less, never wrongly.
LIST_BITS = 512
#: Most pairs whose keys are broadcast to pick their texts.
BROADCAST_PAIRS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, far apart (about 32 bits)."""
    return np.random.default_rng(20240229).integers(0, 2**64, n, dtype=np.uint64)


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit majority word for each run of hashes [ends[i], ends[i+1]); empty runs give 0.

    Eight byte-wide counters share a 64-bit word, so runs are first summed in chunks of at most 255 hashes.
    """
    n = np.diff(ends)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    chunks = -(-n[full] // 255)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    at = np.repeat(ends[:-1][full], chunks) + 255 * (np.arange(chunks.sum()) - np.repeat(first, chunks))
    low = np.uint64(0x0101010101010101)
    half = n[full]
    for j in range(8):
        counts = np.add.reduceat((hashes >> np.uint64(j)) & low, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        sums = np.add.reduceat(counts, first, axis=0)
        for byte in range(8):  # little-endian: byte b holds bit 8*b + j
            out[full] |= (2 * sums[:, byte] > half).astype(np.uint64) << np.uint64(8 * byte + j)
    return out


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(id, fp long): the contract's fingerprint, XXH64 with seed 42 of space-joined shingles, A-Z lower-cased."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as h

        join = b" ".join
        for batch in slices(batches):
            hashes: list[int] = []
            ends = [0]
            for text in batch.column(1).to_pylist():
                w = text.encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
                if len(w) > words:
                    hashes += [h(join(s), 42) for s in zip(*[w[i:] for i in range(words)])]
                elif w:
                    hashes.append(h(join(w), 42))
                ends.append(len(hashes))
            fp = majority(np.array(hashes, np.uint64), np.array(ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), text_of()), run, "id long, fp long").withColumnRenamed("id", id_col)


def shingle_hashes(word_hashes: list[int], words: int) -> np.ndarray:
    """A hash for each window of words, from the words' hashes; fewer words: one for the whole sequence."""
    w = np.array(word_hashes, np.uint64)
    if not len(w):
        return w
    k = min(words, len(w))
    out = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(31))) * _ODD + w[i : len(w) - k + 1 + i]
    return out


def _mask(blocks: tuple[int, ...]) -> int:
    width = 64 // BLOCKS
    return sum(((1 << width) - 1) << (width * b) for b in blocks)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(points: DataFrame, pivot_count: int = N_PIVOTS, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """(a, b): links between fingerprints within 2 bits, enough to connect all that are. points: (space, fp), distinct.

    Fingerprints of different spaces are never linked.
    """
    chosen = [_mask(c) for c in combinations(range(BLOCKS), BLOCKS - RADIUS)]
    listed = points.select("space", "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key")) for i, m in enumerate(chosen)])).alias("e"))
    listed = listed.select("space", "fp", "e.t", "e.key")
    sizes = listed.groupBy("space", "t", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = listed.join(sizes, ["space", "t", "key"])
    small = shared.where(F.col("n") <= bucket_cap).groupBy("space", "t", "key").agg(F.collect_list("fp").alias("fps"))
    near = map_arrow(small.select("space", "fps"), _verify(pivot_count), "space int, a long, b long")
    free = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)).cast("long") for b in range(64) if not m >> b & 1]) for m in chosen])
    reach = shared.where(F.col("n") > bucket_cap).select("space", "t", "fp", F.explode(F.element_at(free, F.col("t") + 1)).alias("bit"))
    reach = reach.select("space", "t", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"), "fp")
    # At most 33 fingerprints lie within one free bit of a point, so these sets are bounded.
    met = reach.groupBy("space", "t", "point").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    star = met.select("space", F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    return near.unionByName(star).distinct()


def _verify(pivot_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = pivots(pivot_count)
        for batch in slices(batches, 4096):
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            fp = lists.flatten().to_numpy().view(np.uint64)
            own = np.repeat(np.arange(len(size)), size)
            space = np.repeat(batch.column(0).to_numpy(), size)
            tables = np.stack([np.bitwise_count(fp ^ p) for p in reference], axis=1).astype(np.int8)
            found = []
            for step in range(1, int(size.max(initial=1))):
                i = np.flatnonzero(own[:-step] == own[step:])
                for p in range(pivot_count):
                    i = i[np.abs(tables[i, p] - tables[i + step, p]) <= RADIUS]
                i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= RADIUS]
                found.append(np.stack([i, i + step]))
            i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            x, y = fp.view(np.int64)[i], fp.view(np.int64)[j]
            yield pa.RecordBatch.from_arrays([pa.array(space[i], pa.int32()), pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["space", "a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (a, b), the least node that it can reach; single nodes do not appear.

    Alternating star contraction. Minima are aggregated before they meet their rows again, so a node of many links is
    an ordinary skewed join, which adaptive execution splits.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND m < b").select(F.col("m").alias("a"), "b").distinct()
        least = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
        small = large.join(least, large["b"] == least["n"]).select(F.col("m").alias("p"), F.explode(F.array("a", "b")).alias("q")).where("p < q")
        edges = materialize(small.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct())
        with freeing_shuffles(edges.sparkSession):
            now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct())
        before = now


def near_duplicates(docs: DataFrame, words: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint, component_id): contract form, one row a document."""
    fps = materialize(fingerprints(docs, words, id_col))
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("first"))
    found = links(classes.select(F.lit(0).alias("space"), "fp"))
    roots = components(found.select("a", "b"))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.join(best, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id") -> DataFrame:
    """(key, root): classes of equal texts (key: the text's hash) and the least key of their near-duplicate group.

    Two texts are linked if the Jaccard similarity of their sets of `words`-word shingles is at least `similarity`; none
    is missed. First come the links of SimHash: fingerprints, tables of blocks and pivots as above, each pair verified.
    Two bits leave out texts further apart, so an exact search for links between SimHash's groups follows.

    Prefix filter: with every set in one common order, two such sets share an element among the first
    n - ceil(similarity * n) + 1 of each, n the set's size, so only texts listed under a common prefix element are
    compared. Any order is exact; hot shingles, found in a sample, come last, which keeps the lists short. In each list
    all members of other groups are first compared with the least one, then those left unconnected with one drawn by
    hash, which differs from list to list; last, every pair that these links left unconnected is compared.
    """
    keyed = docs.select(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"), "text")
    found = materialize(_alike(fingerprint_pairs(keyed, words), keyed, words, similarity))
    prefixes = _prefixes(keyed, words, similarity, _hot_shingles(keyed, words)).dropDuplicates(["key"])
    rows = map_arrow(prefixes, _unfold, "h long, key long, n int, pos int")
    mine = Window.partitionBy("h")
    rows = materialize(rows.select("*", F.min("key").over(mine).alias("least"), F.max("key").over(mine).alias("most")).where("least < most").drop("least", "most"))
    release(docs.sparkSession)
    for by in (F.col("key"), F.xxhash64("h", "key")):
        pairs = _hub_pairs(_rooted(rows, found), by, similarity)
        found = materialize(found.unionByName(_alike(pairs, keyed, words, similarity)))
        release(docs.sparkSession)
    listed = materialize(_unsettled(_rooted(rows, found)))
    del rows
    release(docs.sparkSession)
    pairs = materialize(_unconnected(listed, keyed, words, similarity))
    del listed
    release(docs.sparkSession)
    return components(found.unionByName(_alike(pairs, keyed, words, similarity)))


def fingerprint_pairs(keyed: DataFrame, words: int) -> DataFrame:
    """(a, b): pairs of texts by SimHash: the least key of a fingerprint with its others, and with that of each linked fingerprint."""
    fps = materialize(fingerprints(keyed, words, "key").dropDuplicates(["key"]))
    classes = fps.groupBy("fp").agg(F.min("key").alias("first"))
    same = fps.join(classes, "fp").where("first < key").select(F.col("first").alias("a"), F.col("key").alias("b"))
    near = links(classes.select(F.lit(0).alias("space"), "fp")).select(F.col("a").alias("fa"), F.col("b").alias("fb"))
    near = near.join(classes.select(F.col("fp").alias("fa"), F.col("first").alias("x")), "fa").join(classes.select(F.col("fp").alias("fb"), F.col("first").alias("y")), "fb")
    return same.unionByName(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def _rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    roots = components(found)
    return rows.join(roots, rows["key"] == roots["node"], "left").select("h", "key", F.coalesce("root", "key").alias("root"), "n", "pos")


def _hub_pairs(rooted: DataFrame, by: Column, similarity: float) -> DataFrame:
    """(a, b): in each list the member that is first `by` something against those of other roots."""
    first = F.min(F.struct(by.alias("by"), "key", "root", "n", "pos")).over(Window.partitionBy("h"))
    met = rooted.withColumn("hub", first).where("root != hub.root").where(_may_reach(similarity, F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos")))
    return met.select(F.least("key", "hub.key").alias("a"), F.greatest("key", "hub.key").alias("b")).distinct()


def _hot_shingles(keyed: DataFrame, words: int) -> np.ndarray:
    """The sorted hashes of the most frequent shingles of about HOT_SAMPLE texts: bounded, whatever the input's size."""
    every = max(1, keyed.count() // HOT_SAMPLE)
    sample = shingle_forms(keyed.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0), words, np.ndarray.tobytes).dropDuplicates(["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat = b"".join(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(flat, np.int64))], ["h"])

    counts = map_arrow(sample.select("own"), run, "h long").groupBy("h").count()
    with freeing_shuffles(keyed.sparkSession):
        top = counts.where(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "h").limit(HOT_MOST).collect()
    return np.sort(np.array([r["h"] for r in top], np.int64).view(np.uint64))


def _prefixes(keyed: DataFrame, words: int, similarity: float, hot: np.ndarray) -> DataFrame:
    """(key, n, prefix): the set's size and, as bytes, its first elements: others by hash, then hot ones by hash."""

    def prefix(own: np.ndarray) -> bytes:
        last = hot.take(np.searchsorted(hot, own), mode="clip") == own if len(hot) else np.zeros(len(own), bool)
        order = np.concatenate([own[~last], own[last]])
        # Without words: one list for all such texts, which are alike.
        return order[: len(own) - math.ceil(similarity * len(own) - 1e-9) + 1].tobytes() or bytes(8)

    return shingle_forms(keyed, words, prefix).withColumnRenamed("own", "prefix")


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n, prefix) to (h, key, n, pos), a row an element."""
    for batch in slices(batches):
        prefix = batch.column(2).to_pylist()
        size = np.array([len(x) // 8 for x in prefix])
        pos = np.concatenate([np.arange(k, dtype=np.int32) for k in size])
        cols = [np.frombuffer(b"".join(prefix), np.int64), np.repeat(batch.column(0).to_numpy(), size), np.repeat(batch.column(1).to_numpy(), size), pos]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h", "key", "n", "pos"])


def _may_reach(similarity: float, n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Whether sets of n and m elements whose first common one lies at pos and at can be similar enough."""
    return F.least(n - pos, m - at) >= similarity / (1 + similarity) * (n + m) - 1e-6


def _unsettled(rooted: DataFrame) -> DataFrame:
    """Lists that hold different roots, with their lengths c."""
    mine = Window.partitionBy("h")
    counted = rooted.select("*", F.count("*").over(mine).alias("c"), F.min("root").over(mine).alias("least"), F.max("root").over(mine).alias("most"))
    return counted.where("least < most").drop("least", "most")


def _unconnected(listed: DataFrame, keyed: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): every pair of a common list that may be similar enough and has different roots.

    Each member brings an odd sketch of LIST_BITS bits, so that most pairs are discarded where they meet and never
    become rows. Lists over LIST_CAP are dealt into blocks and compared block with block, so that no task holds more at
    a time.
    """
    sketches = _forms(listed.select("key").distinct(), listed.count() <= BROADCAST_PAIRS, keyed, words, lambda own: odd_bits(own, LIST_BITS))
    listed = listed.join(sketches, "key")
    blocks = F.ceil(F.col("c") / (LIST_CAP // 2)).cast("int")
    long = listed.where(F.col("c") > LIST_CAP).withColumn("x", F.pmod(F.xxhash64("key"), blocks).cast("int")).select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("y"))
    side = F.when(F.col("x") == F.col("y"), 0).when(F.col("x") < F.col("y"), 1).otherwise(2)
    short = listed.where(F.col("c") <= LIST_CAP).select("h", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("side"), "key", "root", "n", "pos", "own")
    long = long.select("h", F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q"), side.alias("side"), "key", "root", "n", "pos", "own")
    lists = short.unionByName(long).groupBy("h", "p", "q").agg(F.array_sort(F.collect_list(F.struct("n", "key", "root", "pos", "side", "own"))).alias("l")).where("size(l) > 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            lists = batch.column(0)
            *numbers, sketch = lists.flatten().flatten()
            n, key, root, pos, side = [c.to_numpy() for c in numbers]
            sketch = np.frombuffer(b"".join(sketch.to_pylist()), np.uint64).reshape(-1, LIST_BITS // 64)
            own = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            i, step = np.arange(len(own)), 0
            while len(i):
                step += 1
                i = i[i + step < len(own)]
                j = i + step
                # Sizes rise within a list: once too large, all later ones are.
                i = i[(own[i] == own[j]) & (n[i] >= similarity * n[j] - 1e-6)]
                j = i + step
                good = (root[i] != root[j]) & ((side[i] == 0) | (side[i] != side[j]))
                good &= np.minimum(n[i] - pos[i], n[j] - pos[j]) >= similarity / (1 + similarity) * (n[i] + n[j]) - 1e-6
                x, y = i[good], j[good]
                near = np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64) <= (1 - similarity) / (1 + similarity) * (n[x] + n[y]) + 1e-6
                if near.any():
                    x, y = key[x[near]], key[y[near]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return map_arrow(lists.select("l"), run, "a long, b long").distinct()


def _alike(pairs: DataFrame, keyed: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of keys whose texts are similar enough: sketches discard most others before any set travels."""
    near = _compared(pairs, keyed, words, odd_sketch, _sketches_allow(similarity))
    return _compared(near, keyed, words, _shorten, _jaccard(similarity))


def _compared(pairs: DataFrame, keyed: DataFrame, words: int, form: Callable[[np.ndarray], bytes], check: Callable) -> DataFrame:
    """The pairs (a, b) whose shingle sets, each put in a form of bytes, pass a check."""
    pairs = materialize(pairs)
    members = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    # The forms travel once, to their keys' partitions, where both joins find them.
    sets = _forms(members, pairs.count() <= BROADCAST_PAIRS, keyed, words, form)
    checked = pairs.join(sets.select(F.col("key").alias("a"), F.col("own").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("own").alias("sb")), "b")
    return map_arrow(checked.select("a", "b", "sa", "sb"), check, "a long, b long")


def _forms(members: DataFrame, few: bool, keyed: DataFrame, words: int, form: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(key, own): a form of each member's shingle set; those of few members need no exchange of the texts."""
    members = F.broadcast(members) if few else members
    return shingle_forms(keyed.join(members, "key", "left_semi"), words, form).select("key", "own").dropDuplicates(["key"])


def odd_bits(own: np.ndarray, size: int) -> bytes:
    """For each value of the hashes' low bits, below the size (a power of two), whether an odd number of elements has it."""
    odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def odd_sketch(own: np.ndarray) -> bytes:
    """The set's size and its odd bits.

    The table has a bit an element, rounded up to a power of two. An element in only one of two sets changes one bit, so
    the bits in which two tables differ are never more than such elements. A table folds to half its size by exclusive or.
    """
    size = max(64, 1 << (len(own) - 1).bit_length()) if len(own) else 64
    return len(own).to_bytes(8, "little") + odd_bits(own, size)


def sketches_allow(x: bytes, y: bytes, similarity: float) -> bool:
    """Whether two sets can be similar enough by their sketches: never false of two that are."""
    n = int.from_bytes(x[:8], "little") + int.from_bytes(y[:8], "little")
    u, v = np.frombuffer(x, np.uint8, offset=8), np.frombuffer(y, np.uint8, offset=8)
    width = min(len(u), len(v))
    u, v = (np.bitwise_xor.reduce(t.reshape(-1, width), axis=0) for t in (u, v))
    return int(np.bitwise_count(u ^ v).sum()) <= (1 - similarity) / (1 + similarity) * n + 1e-6


def _sketches_allow(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = [sketches_allow(x, y, similarity) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return run


def _shorten(own: np.ndarray) -> bytes:
    """Of each 64-bit hash the upper five bytes: within one pair of texts they tell shingles apart as well."""
    return own.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def _lengthen(short: bytes) -> np.ndarray:
    out = np.zeros((len(short) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(short, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def shingle_forms(keyed: DataFrame, words: int, form: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(key, n, own): the number of a text's distinct shingles and a form of their sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as h

        for batch in slices(batches):
            sizes, out = [], []
            for text in batch.column(1):  # one text at a time as a Python string
                own = np.unique(shingle_hashes([h(w) for w in text.as_py().encode().lower().split()], words))
                sizes.append(len(own))
                out.append(form(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], ["key", "n", "own"])

    return map_arrow(keyed.select("key", text_of()), run, "key long, n int, own binary")


def _jaccard(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = _lengthen(x.as_py()), _lengthen(y.as_py())
                both = len(np.intersect1d(u, v))
                total = len(u) + len(v) - both
                good.append(both >= similarity * total)  # two texts without words are alike
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return run


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """One row of each group stays: the least (doc_id, text hash) of it. All columns as they came."""
    roots = materialize(similar_groups(docs.select("doc_id", "text"), words, similarity))
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    slim = docs.select("doc_id", key.alias("own_key")).join(roots, F.col("own_key") == F.col("node"), "left")
    slim = slim.select(F.coalesce("root", "own_key").alias("root"), F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("d"), F.col("own_key").alias("k")).alias("me"))
    stays = slim.groupBy("root").agg(F.min("me").alias("me")).select("me.*")
    mine = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*mine).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("d"), key.alias("k"))
    # Rows equal in both are copies of each other: one of them stays.
    kept = marked.join(stays, ["d", "k"], "left_semi")
    return kept.dropDuplicates(["d", "k"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
