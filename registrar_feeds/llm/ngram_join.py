"""N-gram Jaccard join: groups of documents whose word shingles overlap.

Two documents link when 100 * |intersection| >= 80 * |union| of their sets of
five-word shingles; the result gives each document the smallest doc_id it can
reach by links.  No link between different texts is lost, and no list of all
pairs of a group is ever made:

1. Each document becomes a sorted array of 64-bit shingle hashes.  Documents of
   equal sets are one from here on (first inside a chunk, later over all).
2. Document frequencies of the shingles that can matter.  A document that links
   to another shares one of its n - ceil(0.8 n) + 1 first shingles with it under
   any order of all shingles (prefix filter).  The order used: hashes below
   ``UNIVERSE`` first, by frequency, then the others; so only the low hashes
   are counted, and shingles that many documents share come late.  Chunks of
   documents send their distinct hashes to buckets of the hash range, each hash
   once for a chunk, and get back those that others have too.
3. A document whose first shingles are all its own links to nothing and is
   done.  What stands before the first shingle that two documents share is not
   shared, so its place bounds the sizes of partners (position filter).  The
   documents of a shingle, by size, fall into runs that no such bound reaches
   across; runs in which nobody can have a partner go, the others are stars
   around their smallest document, and connected stars are candidate sets that
   no link leaves.  Texts of one template that differ in more than a link
   allows so make no set, however many they are.
4. A candidate set is joined exactly: its documents are sorted by set size, a
   document meets those within the size band that still belong to another
   component, or if they are fewer those that share a first shingle in places
   that allow a link, hashed bitmaps bound the overlap from above, and sorted
   arrays arrays are intersected where the bound allows a link.  Sets too large for a
   task are formed anew with all their shingles counted; those still too large
   are cut to size-banded tiles: tiles are joined inside, then with a few
   representatives of the largest components, then every document outside the
   largest component with every tile in its bands.

Defined cases: a null or empty text has no shingle and links to nothing, also
not to its like; fewer than five words are one shingle; equal rows are separate
documents that link; a null doc_id counts only where its component has no other;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.llm.common import LOWER, UPPER, kept, modest_batches, table, text_or_empty

SHINGLE = 5
#: Links need PERCENT / 100 of the union.
PERCENT = 80
#: Part of the hash range whose frequencies are counted; over 1 - PERCENT / 100.
UNIVERSE = 0.28
#: Kept hashes in a chunk, and shingles of a candidate set that one task joins.
CHUNK_KEYS = 1_000_000
TILE_SHINGLES = 4_000_000
PIVOTS = 4
#: Documents of a tile that simply meet all others of their size band.
FEW = 32

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                         0x85EBCA77C2B2AE63], dtype=np.uint64)
_SETS = ("uid long, doc_id long, th long, n long, d1 long, d2 long, chunk long, rep long, keys binary")
_KEY_BITS = 48


class _Words(dict):
    """Hash of each word, worked out once while it is held (a few tens of MB)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, words: _Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``text``."""
    parts = text.encode("utf-8", "replace").translate(_FOLD).split()
    n = len(parts)
    if not n:
        return np.empty(0, np.uint64)
    if n < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed=n)], dtype=np.uint64)
    w = np.fromiter(map(words.__getitem__, parts), np.uint64, n)
    with np.errstate(over="ignore"):
        h = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            h ^= h >> np.uint64(29)
            h = (h + w[k:n - size + 1 + k]) * _MULTIPLIERS[k % len(_MULTIPLIERS)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def prefix_length(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


def largest_partner(n, at, percent: int = PERCENT):
    """Largest set that one of ``n`` can link to if the first they share, in an
    order of all, is its number ``at`` (from 0): n - at of the union at most are shared."""
    return (100 + percent) * (n - at) // percent - n


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _arrow(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), schema, strict=True)],
                                      [name for name, _ in schema])


def document_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, universe: float = UNIVERSE,
                  chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """A row per document: uid, doc_id, th (hash of the text), n (shingles), d1
    and d2 (digest of the set), chunk, rep (the first uid of an equal set in the
    chunk), keys (of a rep: the top 48 bits of its lowest hashes)."""
    whole = universe >= 1
    limit = np.uint64(0 if whole else int(universe * 2.0 ** 64))
    schema = [(x.split()[0], pa.binary() if x.endswith("binary") else pa.int64()) for x in _SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base, count = _Words(), TaskContext.get().partitionId() << 40, 0
        chunk, held, seen = base, 0, {}
        for rb in batches:
            rows = []
            for doc, th, text in zip(rb["doc_id"].to_pylist(), rb["th"].to_pylist(), rb["text"], strict=True):
                uid, h = base + count, shingles(text.as_py(), words, size)
                count += 1
                n, keys, d, rep = len(h), None, 0, uid
                if n:
                    d = xxhash.xxh3_128_intdigest(h.tobytes())
                    rep = seen.setdefault((n, d), uid)
                    if rep == uid:
                        low = n if whole else max(int(np.searchsorted(h, limit)), prefix_length(n, percent))
                        keys = _pack(h[:low] >> np.uint64(64 - _KEY_BITS))
                        held += low
                rows.append((uid, doc, th, n, _signed(d >> 64), _signed(d & ((1 << 64) - 1)), chunk, rep, keys))
                if held > chunk_keys:
                    chunk, held, seen = uid + 1, 0, {}
            if rows:
                yield _arrow(rows, schema)

    rows = modest_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    return kept(rows.withColumn("th", F.xxhash64("text")).mapInArrow(run, _SETS), "ngram-sets")


def _shared_keys(sets: DataFrame, bits: int) -> DataFrame:
    """(chunk, keys, dfs): of a chunk's keys, cut to their bucket's precision,
    those that occur in more than one set, and in how many."""
    cut = max(0, _KEY_BITS - bits - 32)  # what of a key fits 32 bits beside its bucket
    rest = _KEY_BITS - bits
    block = [("bucket", pa.int64()), ("chunk", pa.int64()), ("low", pa.binary()), ("counts", pa.binary())]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held) >> np.uint64(cut), return_counts=True)
            bucket = keys >> np.uint64(rest - cut)
            low = (keys & np.uint64((1 << (rest - cut)) - 1)).astype("<u4")
            counts = np.minimum(counts, 255).astype(np.uint8)
            edge = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1), append=bucket[-1:] + np.uint64(1)))
            rows = [(int(bucket[a]), now, low[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield _arrow(rows, block)

        for rb in batches:
            for chunk, packed in zip(rb["chunk"].to_pylist(), rb["keys"].to_pylist(), strict=True):
                if (chunk != now or size > 2 * CHUNK_KEYS) and held:
                    yield from flush()
                    held, size = [], 0
                now = chunk
                held.append(_unpack(packed))
                size += len(held[-1])
        if held:
            yield from flush()

    out = [("chunk", pa.int64()), ("keys", pa.binary()), ("dfs", pa.binary())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            lows = [np.frombuffer(x, "<u4") for _, x, _ in held]
            _, place = np.unique(np.concatenate(lows), return_inverse=True)
            df = np.bincount(place, np.concatenate([np.frombuffer(x, np.uint8) for _, _, x in held])).astype(np.uint32)[place]
            rows, at = [], 0
            for (chunk, _, _), low in zip(held, lows, strict=True):
                mine = df[at:at + len(low)]
                at += len(low)
                some = mine > 1
                if some.any():
                    keys = low[some].astype("<u8") | np.uint64(now << (rest - cut))
                    rows.append((chunk, keys.tobytes(), mine[some].tobytes()))
            if rows:
                yield _arrow(rows, out)

        for rb in batches:
            for b, *x in zip(*(rb[c].to_pylist() for c in ("bucket", "chunk", "low", "counts")), strict=True):
                if b != now and held:
                    yield from flush()
                    held = []
                now = b
                held.append(x)
        if held:
            yield from flush()

    blocks = sets.where("keys IS NOT NULL").select("chunk", "keys").mapInArrow(
        send, "bucket long, chunk long, low binary, counts binary")
    return (blocks.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(count, "chunk long, keys binary, dfs binary"))


def first_keys(sets: DataFrame, percent: int = PERCENT, universe: float = UNIVERSE) -> DataFrame:
    """(key, uid, n, most): the shared keys among the first of each document, its
    size and the largest partner that it can meet at this key."""
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, int(np.ceil(np.log2(4 * parts / universe))))
    cut = max(0, _KEY_BITS - bits - 32)
    limit = np.uint64(int(universe * 2.0 ** _KEY_BITS))
    out = [("key", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()), ("most", pa.int64())]

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.Table.from_batches([], pa.schema(out))
        if not left.num_rows or not right.num_rows:
            return none
        shared = np.concatenate([np.frombuffer(x, "<u8") for x in right["keys"].to_pylist()])
        dfs = np.concatenate([np.frombuffer(x, "<u4") for x in right["dfs"].to_pylist()])
        order = np.argsort(shared, kind="stable")
        shared, dfs = shared[order], dfs[order]
        found = []
        for uid, n, packed in zip(left["uid"].to_pylist(), left["n"].to_pylist(), left["keys"].to_pylist(), strict=True):
            own, need = _unpack(packed), prefix_length(n, percent)
            at = np.minimum(np.searchsorted(shared, own >> np.uint64(cut)), len(shared) - 1)
            hit = shared[at] == own >> np.uint64(cut)
            late = own >= limit
            if not hit.any() or int((~hit & ~late).sum()) >= need:
                continue
            df = np.where(hit, dfs[at], 1)
            first = np.lexsort((own, np.where(late, 0, df), late))[:need]
            at = np.flatnonzero(hit[first])
            if len(at):
                found.append((own[first[at]].astype(np.int64), np.full(len(at), uid, np.int64), np.full(len(at), n, np.int64),
                              largest_partner(n, at, percent)))
        if not found:
            return none
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], names=[name for name, _ in out])

    reps = sets.where("keys IS NOT NULL").select("chunk", "uid", "n", "keys")
    return (reps.groupBy("chunk").cogroup(_shared_keys(sets, bits).groupBy("chunk"))
            .applyInArrow(pick, "key long, uid long, n long, most long"))


def stars(keys: DataFrame) -> DataFrame:
    """Edges (u, v) that connect documents of ``first_keys`` wherever a link can.

    Two documents can meet at a key only if neither is larger than the other's
    ``most``.  The sizes at a key, in order, are cut where no smaller document's
    ``most`` reaches the next size; a run of one size needs two documents that
    reach their own.  Sizes are aggregated before any window, so a key of very
    many documents is a row for each size there.
    """
    sized = keys.groupBy("key", "n").agg(F.max("most").alias("__top"), F.count_if(F.col("most") >= F.col("n")).alias("__same"))
    smaller = Window.partitionBy("key").orderBy("n")
    reach = F.max("__top").over(smaller.rowsBetween(Window.unboundedPreceding, -1))
    cut = sized.withColumn("__starts", F.coalesce(reach < F.col("n"), F.lit(True)))
    runs = kept(cut.withColumn("run", F.max(F.when(F.col("__starts"), F.col("n"))).over(smaller.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("__alive", F.sum(F.col("__same")).over(Window.partitionBy("key", "run")))
                .withColumn("__sizes", F.count(F.lit(1)).over(Window.partitionBy("key", "run")))
                .where("__sizes > 1 OR __alive > 1").select("key", "n", "run"), "ngram-runs")
    posts = kept(keys.join(runs, ["key", "n"]).where("most >= run").select("key", "run", "uid"), "ngram-posts")
    centres = kept(posts.groupBy("key", "run").agg(F.min("uid").alias("v"), F.max("uid").alias("__last"))
                   .where("v <> __last").select("key", "run", "v"), "ngram-stars")
    return posts.withColumnRenamed("uid", "u").join(centres, ["key", "run"]).where("u <> v").select("u", "v").distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(u, root): the smallest node connected with each node of ``edges`` (u, v).

    Alternating large and small stars: each round links a node's neighbours to
    the smallest node among them, until nothing changes (an error after ``rounds``:
    each round shortens the longest path by a constant factor).  A node of very many
    edges is pre-aggregated before the shuffle; the aggregates are written, so
    that the joins with them are plain shuffles whose skew Spark splits (or
    broadcasts while they are small).
    """
    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    now = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = mark(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = kept(large, "cc-large")
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u")
        now = kept(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                   .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select("u", F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())


class _Meetings:
    """The documents of a tile that share a first shingle with a document, in
    places that allow a link; ``sets`` are sorted by size.  Rare shingles of the
    tile come first in its order."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, percent: int):
        n, starts = len(sets), np.cumsum(sizes) - sizes
        _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        doc, df = np.repeat(np.arange(n), sizes), count[token]
        order = np.lexsort((token, df, doc))
        at = np.arange(len(order)) - starts[doc]  # places do not move between documents
        use = (at < prefix_length(sizes, percent)[doc]) & (df[order] > 1)
        token, doc, at = token[order][use], doc[use], at[use]
        most = largest_partner(sizes[doc], at, percent)
        order = np.argsort(token, kind="stable")
        token, self.doc, self.most = token[order], doc[order], most[order]
        # from a posting to the last of its shingle whose document is small enough
        self.ends = np.searchsorted(token * n + self.doc, token * n + np.searchsorted(sizes, self.most, side="right"))
        self.count = np.bincount(self.doc, np.maximum(0, self.ends - np.arange(len(token)) - 1), n)
        self.of = np.argsort(self.doc, kind="stable")
        self.bounds = np.searchsorted(self.doc[self.of], np.arange(n + 1))
        self.sizes = sizes

    def later(self, i: int) -> np.ndarray:
        """Documents after ``i`` that it can link to."""
        if not self.count[i]:
            return np.empty(0, np.int64)
        mine = self.of[self.bounds[i]:self.bounds[i + 1]]
        spans = [slice(k + 1, e) for k, e in zip(mine.tolist(), self.ends[mine].tolist(), strict=True) if e > k + 1]
        return np.unique(np.concatenate([self.doc[x][self.most[x] >= self.sizes[i]] for x in spans]))


class Tile:
    """Documents (uid, sorted hashes) of one task, joined exactly."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.uids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.labels: list[int] = []
        self.sides: list[bool] = []

    def add(self, uid: int, hashes: np.ndarray, label: int, side: bool = False) -> None:
        self.uids.append(uid)
        self.sets.append(hashes)
        self.labels.append(label)
        self.sides.append(side)

    def links(self, across: bool = False) -> Iterator[tuple[int, int]]:
        """Links that connect documents of different labels, enough to connect
        all that links connect; ``across``: only between the two sides."""
        sizes = np.array([len(s) for s in self.sets])
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        sets = [self.sets[i] for i in order]
        uids = [self.uids[i] for i in order]
        _, label = np.unique(np.array(self.labels, np.int64)[order], return_inverse=True)
        side = np.array(self.sides)[order]
        width = 256
        while width < min(65536, 4 * int(np.median(sizes))):
            width *= 2
        bits = np.zeros((len(sets), width // 64), np.uint64)
        for i, s in enumerate(sets):
            flags = np.zeros(width, bool)
            flags[s & np.uint64(width - 1)] = True
            bits[i] = np.packbits(flags).view(np.uint64)
        meet = _Meetings(sets, sizes, self.percent) if len(sets) > FEW else None
        for i in range(len(sets) - 1):
            end = int(np.searchsorted(sizes, sizes[i] * 100 // self.percent, side="right"))
            if end <= i + 1:
                continue
            others = meet.later(i) if meet and meet.count[i] < end - i - 1 else np.arange(i + 1, end)
            others = others[label[others] != label[i]]
            if across:
                others = others[side[others] != side[i]]
            for a in range(0, len(others), 4096):
                self_and = others[a:a + 4096]
                mine_only = np.bitwise_count(bits[i] & ~bits[self_and]).sum(1)
                his_only = np.bitwise_count(~bits[i] & bits[self_and]).sum(1)
                most = np.minimum(sizes[i] - mine_only, sizes[self_and] - his_only)
                total = sizes[i] + sizes[self_and]
                may = self_and[(100 + self.percent) * most >= self.percent * total]
                for j in may.tolist():
                    if label[j] == label[i]:
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= self.percent * (sizes[i] + sizes[j] - both):
                        yield uids[i], uids[j]
                        label[label == label[j]] = label[i]


def _join_tiles(rows: DataFrame, keys: list[str], across: bool, size: int, percent: int) -> DataFrame:
    """Links (u, v) inside each tile, a run of rows of equal ``keys``; rows:
    the keys, uid, label, side, text."""
    out = [("u", pa.int64()), ("v", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, now, tile = _Words(), None, Tile(percent)

        def flush() -> Iterator[pa.RecordBatch]:
            found = list(tile.links(across)) if len(tile.uids) > 1 else []
            if found:
                yield _arrow(found, out)

        for rb in batches:
            tags = zip(*(rb[c].to_pylist() for c in keys), strict=True)
            for tag, uid, label, side, text in zip(tags, rb["uid"].to_pylist(), rb["label"].to_pylist(), rb["side"].to_pylist(), rb["text"], strict=True):
                if tag != now:
                    yield from flush()
                    now, tile = tag, Tile(percent)
                tile.add(uid, shingles(text.as_py(), words, size), label, side)
        yield from flush()

    return (rows.select(*keys, "uid", "label", "side", "text").repartition(*keys).sortWithinPartitions(*keys, "uid")
            .mapInArrow(run, "u long, v long"))


def _large_sets(members: DataFrame, tile: int, pivots: int, size: int, percent: int) -> DataFrame:
    """Links of candidate sets that one task cannot hold (cc, uid, n, text)."""
    step = float(np.log(100 / percent))
    banded = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("long"))
    count = kept(banded.groupBy("cc", "band").agg(F.sum("n").alias("__sum"))
                 .select("cc", "band", F.ceil(F.col("__sum") / F.lit(tile)).cast("long").alias("__tiles")), "ngram-bands")
    tiled = kept(banded.join(count, ["cc", "band"])
                 .withColumn("tile", F.pmod(F.xxhash64("uid"), F.col("__tiles"))).drop("__tiles"), "ngram-tiles")
    keys = ["cc", "band", "tile"]
    inside = kept(_join_tiles(tiled.select("*", F.col("uid").alias("label"), F.lit(False).alias("side")), keys, False, size, percent), "ngram-inside")

    def labelled(links: DataFrame) -> DataFrame:
        roots = components(links)
        return (tiled.join(roots.withColumnRenamed("u", "uid"), "uid", "left")
                .withColumn("label", F.coalesce("root", "uid")).drop("root"))

    def meet(guests: DataFrame, hosts: DataFrame, name: str) -> DataFrame:
        """Links of ``guests`` with the tiles of their own and the next bands."""
        tiles = count.select("cc", F.col("band").alias("to_band"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("__tiles") - 1)).alias("to_tile"))
        sent = (guests.withColumn("to_band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
                .join(tiles, ["cc", "to_band"])
                .select("cc", "to_band", "to_tile", F.col("band").alias("from_band"), F.col("tile").alias("from_tile"), "uid", "label", "text", F.lit(True).alias("side")))
        groups = sent.select("cc", "to_band", "to_tile", "from_band", "from_tile").distinct()
        here = (hosts.select("cc", F.col("band").alias("to_band"), F.col("tile").alias("to_tile"), "uid", "label", "text", F.lit(False).alias("side"))
                .join(groups, ["cc", "to_band", "to_tile"]))
        rows = sent.unionByName(here)
        return kept(_join_tiles(rows, ["cc", "to_band", "to_tile", "from_band", "from_tile"], True, size, percent), name)

    first = labelled(inside)
    rank = F.row_number().over(Window.partitionBy("cc", "band").orderBy(F.desc("__n"), "uid"))
    largest = (first.groupBy("cc", "band", "label").agg(F.count(F.lit(1)).alias("__n"), F.min("uid").alias("uid"))
               .withColumn("__rank", rank).where(F.col("__rank") <= pivots).select("uid"))
    star = meet(first.join(largest, "uid", "left_semi"), first, "ngram-star")
    second = labelled(inside.unionByName(star))
    main = kept(second.groupBy("cc", "label").agg(F.count(F.lit(1)).alias("__n"))
                .groupBy("cc").agg(F.max(F.struct("__n", "label")).alias("__m")).select("cc", F.col("__m.label").alias("__main")), "ngram-main")
    apart = second.join(main, "cc").where("label <> __main").drop("__main")
    return inside.unionByName(star).unionByName(meet(apart, second, "ngram-apart"))


def _join_sets(members: DataFrame, size: int, percent: int) -> DataFrame:
    """Links inside candidate sets (cc, uid, text) that one task holds each."""
    return _join_tiles(members.select("cc", "uid", F.col("uid").alias("label"), F.lit(False).alias("side"), "text"), ["cc"], False, size, percent)


def _sets_anew(members: DataFrame, size: int, percent: int, chunk_keys: int) -> tuple[DataFrame, int]:
    """Candidate sets (cc, uid, n, text, __total) of the documents of large ones
    (uid, text), and the largest total.  Now all their shingles are counted, so that
    the rare ones come first whatever their hashes and the position filter sees all."""
    sets = document_sets(members.withColumnRenamed("uid", "doc_id"), size, percent, 1.0, chunk_keys)
    cc = components(stars(kept(first_keys(sets, percent, 1.0), "ngram-keys")))
    found = kept(sets.join(cc.withColumnRenamed("u", "uid"), "uid").select(F.col("doc_id").alias("uid"), "n", F.col("root").alias("cc")), "ngram-anew")
    total = kept(found.groupBy("cc").agg(F.sum("n").alias("__total")), "ngram-totals")
    most = total.agg(F.max("__total")).first()[0] or 0
    return kept(members.join(found.join(total, "cc"), "uid"), "ngram-members"), most


def near_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, universe: float = UNIVERSE,
                chunk_keys: int = CHUNK_KEYS, tile_shingles: int = TILE_SHINGLES, pivots: int = PIVOTS) -> DataFrame:
    """uid, doc_id, th, n and root (one uid for each component) per document."""
    sets = document_sets(docs, size, percent, universe, chunk_keys)
    keys = kept(first_keys(sets, percent, universe), "ngram-keys")
    cc = components(stars(keys)).select(F.col("u").alias("uid"), F.col("root").alias("cc"))
    # equal sets of a candidate set are one
    of = kept(sets.select("uid", "doc_id", "th", "n", "d1", "d2").join(cc, "uid"), "ngram-candidates")
    same = of.groupBy("cc", "n", "d1", "d2").agg(F.min("uid").alias("one"))
    alias = kept(of.join(same, ["cc", "n", "d1", "d2"]).select("uid", "one"), "ngram-alias")
    ones = of.join(alias.where("uid = one").select("uid"), "uid").select("uid", "doc_id", "th", "n", "cc")
    total = kept(ones.groupBy("cc").agg(F.sum("n").alias("__total"), F.count(F.lit(1)).alias("__ones"))
                 .where("__ones > 1").select("cc", "__total"), "ngram-totals")
    ones = kept(ones.join(total, "cc"), "ngram-ones")

    no_id = F.lit(-(1 << 62)).cast("long")
    wanted = ones.select("uid", "cc", "n", "__total", "th", F.coalesce("doc_id", no_id).alias("__id"))
    texts = (docs.select(F.coalesce(docs["doc_id"].cast("long"), no_id).alias("__id"), text_or_empty(docs).alias("text"))
             .withColumn("th", F.xxhash64("text")))
    members = texts.join(wanted.hint("merge"), ["__id", "th"])  # the same plan at every size
    small = members.where(F.col("__total") <= tile_shingles).select("cc", "uid", "text").dropDuplicates(["uid"])
    links = kept(_join_sets(small, size, percent), "ngram-links")
    if not ones.where(F.col("__total") > tile_shingles).isEmpty():
        large = kept(members.where(F.col("__total") > tile_shingles).select("uid", "text").dropDuplicates(["uid"]), "ngram-large")
        large, most = _sets_anew(large, size, percent, chunk_keys)
        links = links.unionByName(kept(_join_sets(large.where(F.col("__total") <= tile_shingles), size, percent), "ngram-links"))
        if most > tile_shingles:
            links = links.unionByName(_large_sets(large.where(F.col("__total") > tile_shingles).drop("__total"), tile_shingles, pivots, size, percent))
    roots = components(links).select(F.col("u").alias("one"), "root")
    known = (alias.join(roots, "one", "left").select(F.col("uid").alias("rep"), F.coalesce("root", "one").alias("root")))
    return (sets.select("uid", "doc_id", "th", "n", "rep").join(known, "rep", "left")
            .select("uid", "doc_id", "th", "n", F.coalesce("root", "rep").alias("root")))


def component_ids(groups: DataFrame) -> DataFrame:
    groups = kept(groups, "ngram-groups")
    least = kept(groups.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ngram-least")
    return groups.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    doc_id, one of these if several share it.  All columns stay."""
    groups = kept(near_groups(docs, **options), "ngram-groups")
    no_id = F.lit(-(1 << 62)).cast("long")
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid", "th", "n")).alias("b"))
    stay = best.select(F.coalesce("b.doc_id", no_id).alias("__id"), F.col("b.th").alias("__th"))
    # rows equal in doc_id and text are copies, or have no words: as many stay as are named
    named = kept(stay.groupBy("__id", "__th").agg(F.count(F.lit(1)).alias("__named")), "ngram-stay")
    rows = docs.withColumn("__id", F.coalesce(docs["doc_id"].cast("long"), no_id)).withColumn("__th", F.xxhash64(text_or_empty(docs)))
    there = groups.groupBy(F.coalesce("doc_id", no_id).alias("__id"), F.col("th").alias("__th")).agg(F.count(F.lit(1)).alias("__there"))
    known = kept(named.join(there, ["__id", "__th"]), "ngram-named")
    kept_rows = rows.join(known, ["__id", "__th"])
    sure = kept_rows.where("__named = __there").select(*docs.columns)
    if known.where("__named < __there").isEmpty():
        return sure
    turn = Window.partitionBy("__id", "__th").orderBy(*[F.col(c).cast("string") for c in docs.columns])
    some = (kept_rows.where("__named < __there").withColumn("__turn", F.row_number().over(turn))
            .where("__turn <= __named").select(*docs.columns))
    return sure.unionByName(some)


def op8_ngram_join(spark, sf_dir):
    return component_ids(near_groups(table(spark, sf_dir, "documents")))


OP8_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS r FROM documents
  UNION
  SELECT ways.y, reach.r FROM reach JOIN ways ON ways.x = reach.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT x, min(r) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""
