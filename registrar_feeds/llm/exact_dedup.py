"""Exact deduplication by Grace hashing.

Every input partition first folds its own copies in an open-addressing table,
so a text held by a third of all rows reaches the shuffle once for each
partition.  The representatives are dealt by a hash of their text; a task whose
bucket outgrows the table's memory partitions it to spill files by further
bits of the hash, again and again until a bucket fits.  The tables compare
complete contents, never hashes alone.  Members find their class by an
equi-join on the number of their local representative.

Defined cases: a null text equals the empty one; a null doc_id is smaller than
any other; of rows that share the largest doc_id one stays; equal rows are
separate members; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar_feeds.llm.common import LOWER, UPPER, kept, modest_batches, table, text_or_empty

#: Bytes of text that a table holds: of the pass before the shuffle (which then
#: starts a new one), and of a bucket after it (which is then partitioned).
LOCAL_BYTES = 64 << 20
BUCKET_BYTES = 128 << 20
FAN_BITS = 4
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


class Table:
    """Open addressing with linear probing; ``place`` finds the entry of a
    text or makes one."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.slots: list[int] = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.values: list[list] = []
        self.bytes = 0

    def place(self, h: int, text: bytes) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return e
            at = (at + 1) & mask
        self.slots[at] = e = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.values.append([])
        self.bytes += len(text) + 200
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return e

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for e, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


def _order(doc: int | None, uid: int) -> tuple:
    """What the staying row has the most of."""
    return (doc is not None, doc or 0, -uid)


_LOCAL = pa.schema([("rep", pa.int64()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()),
                    ("h", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
_LOCAL_SQL = "rep long, uid long, doc_id long, sha string, h long, n long, text binary"
_REP = pa.schema([f for f in _LOCAL if f.name != "sha"])
_CLASS = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_uid", pa.int64()), ("group_size", pa.int64())])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def fold_locally(most: int):
    """Members (uid, doc_id, rep, sha) and, with ``n`` and the text, the
    representatives (uid and doc_id are those of the row that would stay)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count, held = TaskContext.get().partitionId() << 40, 0, Table()

        def reps() -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for h, text, (rep, n, doc, uid) in zip(held.hashes, held.texts, held.values, strict=True):
                rows.append((rep, uid, doc, None, _signed(h), n, text))
                size += len(text)
                if size > 8 << 20:
                    yield _batch(rows, _LOCAL)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _LOCAL)

        for rb in batches:
            rows = []
            for doc, text in zip(rb["doc_id"].to_pylist(), rb["text"].cast(pa.binary()).to_pylist(), strict=True):
                text, uid = text.translate(_FOLD), base + count
                count += 1
                e = held.place(xxhash.xxh3_64_intdigest(text), text)
                v = held.values[e]
                if not v:
                    v += [uid, 0, doc, uid, hashlib.sha256(text).hexdigest()]
                v[1] += 1
                if _order(doc, uid) > _order(v[2], v[3]):
                    v[2:4] = doc, uid
                rows.append((v[0], uid, doc, v[4], None, None, None))
            if rows:
                yield _batch(rows, _LOCAL)
            if held.bytes > most:
                for v in held.values:
                    v.pop()
                yield from reps()
                held = Table()
        for v in held.values:
            v.pop()
        yield from reps()

    return run


def grace(most: int, fan_bits: int = FAN_BITS):
    """Classes of the representatives of one shuffle partition."""

    def classes(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        held, batches = Table(), iter(batches)
        for rb in batches:
            rows = rb.to_pydict()
            for h, text, *v in zip(rows["h"], rows["text"], rows["rep"], rows["n"], rows["doc_id"], rows["uid"], strict=True):
                held.values[held.place(h & ((1 << 64) - 1), text)].append(tuple(v))
            if held.bytes > most and (level + 1) * fan_bits <= 64:
                yield from spilled(held, batches, level)
                return
        out = []
        for v in held.values:
            keep = max(v, key=lambda x: _order(x[2], x[3]))
            size = sum(x[1] for x in v)
            out += [(rep, keep[2], keep[3], size) for rep, *_ in v]
            if len(out) > 20_000:
                yield _batch(out, _CLASS)
                out = []
        if out:
            yield _batch(out, _CLASS)

    def spilled(held: Table, batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        folder = tempfile.mkdtemp(prefix="grace-")  # this task's own, gone at its end
        try:
            files = [pa.OSFile(f"{folder}/{i}", "wb") for i in range(1 << fan_bits)]
            writers = [pa.ipc.new_stream(f, _REP) for f in files]

            def write(rows: list[tuple]) -> None:
                parts: dict[int, list] = {}
                for r in rows:
                    parts.setdefault((r[3] >> (64 - (level + 1) * fan_bits)) & ((1 << fan_bits) - 1), []).append(r)
                for i, part in parts.items():
                    writers[i].write_batch(_batch(part, _REP))

            rows, size = [], 0
            for h, text, v in zip(held.hashes, held.texts, held.values, strict=True):
                rows += [(rep, uid, doc, _signed(h), n, text) for rep, n, doc, uid in v]
                size += len(text) * len(v)
                if size > 8 << 20:
                    write(rows)
                    rows, size = [], 0
            write(rows)
            held.clear()
            for rb in batches:
                d = rb.to_pydict()
                write(list(zip(*[d[f.name] for f in _REP], strict=True)))
            for w, f in zip(writers, files, strict=True):
                w.close()
                f.close()
            for i in range(1 << fan_bits):
                with pa.OSFile(f"{folder}/{i}") as f, pa.ipc.open_stream(f) as r:
                    yield from classes(r, level + 1)
                os.unlink(f"{folder}/{i}")
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return lambda batches: classes(batches, 0)


def exact_groups(docs: DataFrame, local_bytes: int = LOCAL_BYTES, bucket_bytes: int = BUCKET_BYTES,
                 fan_bits: int = FAN_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    local = kept(modest_batches(rows).mapInArrow(fold_locally(local_bytes), _LOCAL_SQL), "exact-local")
    reps = (local.where("n IS NOT NULL").select("rep", "uid", "doc_id", "h", "n", "text").repartition("h"))
    classes = reps.mapInArrow(grace(bucket_bytes, fan_bits), "rep long, keep_id long, keep_uid long, group_size long")
    return (local.where("n IS NULL").join(classes, "rep")
            .select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def op5_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


_SQL_TEXT = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_TEXT} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
