"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact check.

1. Rows with equal word sequences are one node, whatever their number; its least id stands for it.
2. Signatures of ``BANDS * ROWS`` minima of the set of shingles' hashes; equal bands share a bucket.
3. A bucket's centre is the member that has most company in all its buckets.  Every member is
   compared with the centre: a star, not all pairs of the bucket.  Links give components.
4. Where a bucket still holds several components, members outside its largest one are compared with
   all members of other components.  Each node that is in such a bucket is stored once, in a block of
   its largest one; a bucket only says which blocks meet, so a pair of blocks meets once, however
   many buckets its members share.

Every comparison, of a star or of two blocks, is the same: signatures are read batch by batch, and
after each batch the posterior probability (uniform prior) that the similarity reaches the threshold
is bounded: a pair whose posterior is below ``MISS`` is pruned.  Survivors are verified on their full
sets of shingles where they are, inside Python, and only links that join two components so far are
given out: a forest of each pair of blocks, not its pairs.

So every banded pair of different components is looked at, and pairs inside a component are not
needed.  At similarity 0.8 the bands miss a pair with a chance of 6e-7.  Blocks are bounded by bytes;
the number of comparisons inside them grows with the square of a bucket's members outside its largest
component.  Tables are written to the shared folder and deleted when what is made of them is written.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .workspace import fresh, release, small_batches, stage

BANDS, ROWS, BATCH = 36, 5, 30
#: Chance with which a pair at the threshold may be pruned, each time a batch is read.
MISS = 1e-6
#: Size of a block of members, in numbers of eight bytes.
CELLS = 500_000
#: Such numbers that a member takes beside its set of shingles.
OWN_CELLS = BANDS * ROWS // 2 + 8

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _rng.integers(0, 1 << 62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_of(words: list[bytes]) -> int:
    """64-bit digest of a sequence of words, as ``text_key`` gives it."""
    import xxhash

    h = xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def text_key(text: Column) -> Column:
    """Digest of the words of a text; equal for texts that differ in white space and ASCII case only."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.trim(F.regexp_replace(F.coalesce(lower, F.lit("")), r"[\x20\x09-\x0D]+", " ")))


class Shingler:
    """Sets of shingles as sorted 64-bit hashes. Words are split at ASCII white space, A-Z lower-cased."""

    def __init__(self, width: int, most: int = 150_000):
        import xxhash

        self.width, self.most, self.hash = width, most, xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}
        self.factors = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(width)], np.uint64)

    def split(self, text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.words
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            if len(known) > self.most:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.hash(w)
            return np.array([known[w] for w in words], np.uint64)

    def set_of(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        h, w = self.hashes(words), min(self.width, len(words))
        n = len(h) - w + 1
        total = h[:n] * self.factors[0]
        for j in range(1, w):
            total = total + h[j : j + n] * self.factors[j]
        return np.unique(_mix(total + np.uint64(w)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS * ROWS minima for each set; sets are not empty."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(_XOR), len(sets)), np.uint32)
    for k in range(len(_XOR)):
        out[k] = np.minimum.reduceat((h ^ _XOR[k]) * _MUL[k], starts)
    return np.ascontiguousarray(out.T)


def buckets_of(sig: np.ndarray) -> np.ndarray:
    """One row of BANDS buckets for each signature: a bucket's lowest six bits are its band."""
    x = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = _mix((x * _BAND).sum(axis=2, dtype=np.uint64)) & ~np.uint64(63)
    return (h | np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def _signed_sets(sets: list[np.ndarray], most: int = 60_000):
    """(first, signatures) of runs of ``sets`` of about ``most`` hashes; none is empty."""
    first, held = 0, 0
    for i, s in enumerate(sets):
        held += len(s)
        if held > most or i == len(sets) - 1:
            yield first, signatures(sets[first : i + 1])
            first, held = i + 1, 0


def _sketch(width: int):
    """(id, key, n, buckets) of (id, text); texts without words have no buckets."""

    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            words = [shingler.split(t.as_py()) for t in batch.column(1)]
            sets = [shingler.set_of(w) for w in words]
            some = [s for s in sets if len(s)]
            parts = [buckets_of(sig) for _, sig in _signed_sets(some)]
            values = pa.array(np.concatenate(parts).ravel() if parts else np.zeros(0, np.int64))
            ends = np.cumsum([0] + [BANDS if len(s) else 0 for s in sets])
            buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([key_of(w) for w in words], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), buckets], names=["id", "key", "n", "buckets"])

    return run


def _members(width: int):
    """(node, sig, set) of (id, text, node); rows whose text is another one than the node's are left out."""

    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            nodes, sets = [], []
            for text, node in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = shingler.split(text.as_py())
                if words and key_of(words) == node:
                    nodes.append(node)
                    sets.append(shingler.set_of(words))
            sigs = [row.tobytes() for _, sig in _signed_sets(sets) for row in sig]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "sig", "set"])

    return run


def least_matches(threshold: float, miss: float = MISS, total: int = BANDS * ROWS) -> dict[int, int]:
    """Hashes read so far -> least number of agreeing ones at which the posterior probability of a
    similarity of ``threshold`` or more is ``miss`` at least."""
    x = threshold
    out = {}
    for n in [*range(BATCH, total, BATCH), total]:
        tail = 0.0
        for m in range(n + 2):
            tail += math.comb(n + 1, m) * x**m * (1 - x) ** (n + 1 - m)
            if tail >= miss:
                out[n] = m
                break
    return out


def _prune(one: np.ndarray, sigs: np.ndarray, at: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Those of the rows ``at`` of ``sigs`` that no batch prunes when compared with ``one``."""
    agree, before = np.zeros(len(at), np.int32), 0
    for n, m in least.items():
        agree += (sigs[at, before:n] == one[before:n]).sum(axis=1, dtype=np.int32)
        keep = agree >= m
        at, agree, before = at[keep], agree[keep], n
        if not len(at):
            break
    return at


def _numbers(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of binaries, and where each row's begin (one more than rows)."""
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(memoryview(data)[at[0] : at[-1]].tobytes() if data else b"", kind)
    return flat, (at - at[0]) // np.dtype(kind).itemsize


class _Block:
    """Members of a block: an array of structs (node, component, outside, sig, set)."""

    def __init__(self, items: pa.StructArray):
        self.node, self.component, self.outside = (items.field(c).to_numpy(zero_copy_only=False) for c in ("node", "component", "outside"))
        self.sig = _numbers(items.field("sig"), np.uint32)[0].reshape(len(items), BANDS * ROWS)
        self.hashes, self.at = _numbers(items.field("set"), np.uint64)
        self.sizes = np.diff(self.at)
        self.index = None

    def set_of(self, i: int) -> np.ndarray:
        return self.hashes[self.at[i] : self.at[i + 1]]

    def common(self, one: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of the sorted set ``one`` with the sets of the members ``at``."""
        if len(at) <= 8:
            out = []
            for j in at:
                other = self.set_of(j)
                small, large = (one, other) if len(one) < len(other) else (other, one)
                found = np.minimum(np.searchsorted(large, small), len(large) - 1)
                out.append(np.count_nonzero(large[found] == small))
            return np.array(out, np.int64)
        if self.index is None:
            order = np.argsort(self.hashes, kind="stable")
            self.index = self.hashes[order], np.repeat(np.arange(len(self.node), dtype=np.int32), self.sizes)[order]
        hashes, owner = self.index
        low, high = np.searchsorted(hashes, one, "left"), np.searchsorted(hashes, one, "right")
        n = high - low
        places = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        return np.bincount(owner[places], minlength=len(self.node))[at]


def forest(left: _Block, right: _Block, least: dict[int, int], percent: int) -> list[tuple[int, int]]:
    """Links between members of two blocks (or of one: the same object twice) that join components.

    Pairs of one component are not compared, nor are pairs of which neither is outside.
    """
    labels, at = np.unique(np.concatenate([left.component, right.component]), return_inverse=True)
    root, mine, theirs = np.arange(len(labels)), at[: len(left.node)], at[len(left.node) :]
    found = []
    for i in range(len(left.node)):
        open_ = root[theirs] != root[mine[i]]
        if not left.outside[i]:
            open_ &= right.outside
        if left is right:
            open_[: i + 1] = False
        near = _prune(left.sig[i], right.sig, np.flatnonzero(open_), least)
        if not len(near):
            continue
        one = left.set_of(i)
        inter = right.common(one, near)
        for j in near[100 * inter >= percent * (len(one) + right.sizes[near] - inter)].tolist():
            a, b = root[mine[i]], root[theirs[j]]
            if a != b:
                root[root == b] = a
                found.append((int(left.node[i]), int(right.node[j])))
    return found


def _links(percent: int):
    """(a, b) of (left, right, same): blocks of members, and whether they are one."""
    least = least_matches(percent / 100)

    def run(batches):
        for batch in batches:
            found = []
            for r in range(batch.num_rows):
                left = _Block(batch.column(0)[r].values)
                right = left if batch.column(2)[r].as_py() else _Block(batch.column(1)[r].values)
                found += forest(left, right, least, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


PAIR = "a bigint, b bigint"


def _member(component: str, outside: Column) -> Column:
    return F.struct("node", F.col(component).alias("component"), outside.alias("outside"), "sig", "set")


def _parts(cells: str) -> Column:
    return F.ceil(F.col(cells) / CELLS)


def _star_links(shared: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links of the members of each bucket with its centre. shared: (bucket, node, n, cells)."""
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    centre = shared.join(company, "node").groupBy("bucket").agg(F.max_by("node", F.struct("company", -F.col("node"))).alias("centre"))
    rays = shared.join(centre, "bucket").where("node <> centre").groupBy("centre", "node").agg(F.max("cells").alias("cells"))
    # a centre's members are dealt over parts of a bounded size: its set is sent once for each part
    parts = _parts("cells")
    rays = rays.select("centre", "node", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).alias("part"))
    yes = F.lit(True)
    held = rays.join(members, "node").groupBy("centre", "parts", "part").agg(F.collect_list(_member("node", yes)).alias("held"))
    hub = members.select(F.col("node").alias("centre"), F.array(_member("node", yes)).alias("hub"))
    return held.join(hub, "centre").select("hub", "held", F.lit(False).alias("same")).mapInArrow(_links(percent), PAIR)


def _open_links(shared: DataFrame, found: DataFrame, members: DataFrame, percent: int) -> DataFrame | None:
    """Links between components that share a bucket, None where no bucket holds two. found: (id, component)."""
    labels = found.select(F.col("id").alias("node"), "component")
    labelled = shared.join(labels, "node", "left").select("bucket", "node", "cells", F.coalesce("component", "node").alias("component"))
    kinds = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("members"))
    largest = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.max_by("component", F.struct("members", -F.col("component"))).alias("largest")).where("kinds > 1").select("bucket", "largest")
    open_ = stage(labelled.join(largest, "bucket").select("bucket", "node", "cells", "component", (F.col("component") != F.col("largest")).alias("outside")), "near-open")
    if open_.isEmpty():
        release(open_)
        return None
    home = open_.groupBy("node", "component").agg(F.max(F.struct("cells", "bucket")).alias("home"), F.max("outside").alias("outside"))
    part = F.pmod(F.xxhash64("node"), _parts("home.cells"))
    nodes = stage(home.select("node", "component", "outside", F.xxhash64("home.bucket", "outside", part).alias("block")), "near-nodes")
    blocks = stage(nodes.join(members, "node").groupBy("block").agg(F.collect_list(_member("component", F.col("outside"))).alias("held")), "near-blocks")
    at = open_.select("bucket", "node").join(nodes.select("node", "block", "outside"), "node").select("bucket", "block", "outside").distinct()
    left, right = at.where("outside").select("bucket", F.col("block").alias("x")), at.select("bucket", F.col("block").alias("y"), "outside")
    pairs = stage(left.join(right, "bucket").where("not outside or x <= y").select("x", "y").distinct(), "near-meets")
    met = pairs.join(blocks.toDF("x", "left"), "x").join(blocks.toDF("y", "right"), "y")
    links = stage(met.select("left", "right", (F.col("x") == F.col("y")).alias("same")).mapInArrow(_links(percent), PAIR), "near-links")
    release(open_, nodes, blocks, pairs)
    return links


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (id, component) with the components that ``links`` (a, b) connect joined up."""
    label = lambda c: found.select(F.col("id").alias(c), F.col("component").alias(c + "_component"))
    bridges = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    joined = components(bridges)
    final = joined.toDF("component", "final")
    moved = found.join(final, "component", "left").select("id", F.coalesce("final", "component").alias("component"))
    new = final.select(F.col("component").alias("id"), F.col("final").alias("component")).join(found.select("id"), "id", "left_anti")
    out = stage(moved.unionAll(new), "near-joined")
    release(found, joined)
    return out


def _classes(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(id, key, n, component) of each row, from a table in the shared folder."""
    small_batches(df.sparkSession)
    docs = df.select(df[key].cast("bigint").alias("id"), df[text].alias("text"))
    sketched = stage(docs.mapInArrow(_sketch(width), "id bigint, key bigint, n bigint, buckets array<bigint>"), "near-sketch")
    usable = sketched.where("id is not null and n > 0")
    nodes = stage(usable.groupBy("key").agg(F.min("id").alias("id")), "near-nodes")

    one_each = usable.groupBy("key").agg(F.max("n").alias("n"), F.first("buckets").alias("buckets"))
    rows = one_each.select(F.col("key").alias("node"), (F.col("n") + OWN_CELLS).cast("int").alias("cells"), F.explode("buckets").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("cells").alias("cells")).where("n > 1")
    shared = stage(rows.select("bucket", "node").join(sizes, "bucket"), "near-buckets")

    wanted = nodes.join(shared.select(F.col("node").alias("key")).distinct(), "key").select("id", F.col("key").alias("node"))
    members = docs.join(wanted, "id").mapInArrow(_members(width), "node bigint, sig binary, set binary")
    members = stage(members.dropDuplicates(["node"]), "near-members")

    links = stage(_star_links(shared, members, percent), "near-links")
    found = components(links)
    release(links)
    links = _open_links(shared, found, members, percent)
    if links is not None:
        found = _joined(found, links)
        release(links)
    release(shared, members)

    linked = nodes.join(found.select(F.col("id").alias("key"), F.col("component").alias("root")), "key")
    least = linked.groupBy("root").agg(F.min("id").alias("component"))
    whose = nodes.join(linked.join(least, "root").select("key", "component"), "key", "left").select("key", F.coalesce("component", "id").alias("component"))
    whole = usable.select("id", "key", "n").join(whose, "key").select("id", "key", "n", "component")
    rest = sketched.where("id is null or n = 0").select("id", "key", "n", F.col("id").alias("component"))
    out = stage(whole.unionAll(rest), "near-classes")
    release(sketched, nodes, found)
    return out


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component) for each row of ``df``.

    Two texts are linked if ``100 * |intersection| >= percent * |union|`` of their sets of shingles
    of ``width`` words (with fewer words: the whole sequence); ``component`` is the least id that
    links reach.  Words and texts are told apart by 64-bit digests.  Null and empty texts, and texts
    without words, have no shingles and are linked with nothing.  Rows with equal texts share a
    class, whatever their ids; of rows with equal ids and different texts each is in its own text's
    class.  Rows with a null id are linked with nothing and have a null component.  Other columns
    are ignored; an empty table gives an empty one.  Very long texts are read whole.  Nothing is
    capped, and no links, components or signatures are sent to the driver.
    """
    return _classes(df, key, text, width, percent).select("id", F.col("n").alias("n_shingles"), "component")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``df`` of which the id is its class's least; rows with a null id stay, and all of
    several rows with that least id.  Columns are those of ``df``."""
    i, k = fresh(df.columns, "__id", "__key")
    gone = _classes(df, key, text, width, percent).where("id <> component").select(F.col("id").alias(i), F.col("key").alias(k)).distinct()
    gone = stage(gone, "near-gone")
    return df.join(gone, (df[key].cast("bigint") == F.col(i)) & (text_key(df[text]) == F.col(k)), "left_anti")
