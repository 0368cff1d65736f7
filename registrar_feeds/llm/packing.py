"""Packing documents into training sequences.

Documents are dealt into randomised groups by a hash of the row.  Inside a
group each document's whole pieces of ``length`` tokens are sequences of their
own; the remainders (shorter than a sequence) are packed by first-fit
decreasing, the first bin with room being found in a tournament tree of bin
capacities.  A task streams its groups in order and holds at most ``group_docs``
remainders, however large the group or a document is.

Token ids are those of the ``tokenizers`` file at ``tokenizer``.  The file
``ranks`` states the same vocabulary as byte ranks; texts whose characters all
lie below U+0250 are encoded from it, four times as fast and to the same ids
(tests hold the two against each other), all other texts by ``tokenizers``, and
so is a text that holds an added token of the file, such as <|endoftext|>, which
is one id there.

Defined cases: a null or empty text is the end id alone; equal rows are packed
as separate documents; an empty table gives no sequences.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar_feeds.llm.common import modest_batches, table, text_or_empty

LENGTH = 1024
END_ID = 0
GROUP_DOCS = 2048
#: Longer texts are encoded in parts, cut where no token can span.
PART_CHARS = 1 << 20
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each item, and the number of bins.

    The tree's leaves are the bins' free room, its inner nodes the larger of
    their children; the way down to the left wherever there is room ends at
    the first bin that fits.
    """
    n = len(sizes)
    width = 1
    while width < max(1, n):
        width *= 2
    free = [capacity] * (2 * width)
    bins, offsets, used = [0] * n, [0] * n, 0
    for i in sorted(range(n), key=lambda i: -sizes[i]):
        size, node = sizes[i], 1
        while node < width:
            node *= 2
            if free[node] < size:
                node += 1
        bins[i], offsets[i] = node - width, capacity - free[node]
        used = max(used, bins[i] + 1)
        free[node] -= size
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return bins, offsets, used


def parts(text: str, most: int = PART_CHARS, added: re.Pattern | None = None) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters, cut before a space that
    stands between letters and not inside a match of ``added``: a token begins
    there in any case."""
    cut = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
    whole = [m.span() for m in added.finditer(text)] if added else []
    at = held = 0
    while len(text) - at > most:
        found = cut.search(text, at + most)
        while found:
            while held < len(whole) and whole[held][1] <= found.start():
                held += 1
            if held == len(whole) or whole[held][0] >= found.start():
                break
            found = cut.search(text, whole[held][1])
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def encoder(tokenizer: str | None = None, ranks: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids; both files default to the installed public ones."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    held = vars(tiktoken).setdefault("_held_encoders", {})  # one per worker process
    key = (tokenizer, ranks)
    if key not in held:
        exact = Tokenizer.from_file(tokenizer or public_tokenizers.path(TOKENIZER))
        # the longest first, as one may begin another
        names = sorted((t.content for t in exact.get_added_tokens_decoder().values()), key=len, reverse=True)
        added = re.compile("|".join(map(re.escape, names))) if names else None
        with open(ranks or public_tokenizers.path(RANKS)) as f:
            table_ = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_, special_tokens={})
        other = re.compile("[^\x00-ɏ]")

        def encode(text: str) -> list[int]:
            if len(text) > PART_CHARS:
                return [i for p in parts(text, PART_CHARS, added) for i in one(p)]
            return one(text)

        def one(text: str) -> list[int]:
            if other.search(text) or added and added.search(text):
                return exact.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        held[key] = encode
    return held[key]


def pack(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, group_docs: int = GROUP_DOCS,
         tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """The pieces of all sequences: doc_id, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset.  The pieces of a
    sequence, by offset, are its tokens; what is missing to ``length`` is
    padding."""
    groups = max(1, round(docs.count() / group_docs))
    rows = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
            .withColumn("__key", F.xxhash64("doc_id", "text"))
            .withColumn("__group", F.pmod("__key", F.lit(groups)))
            .repartition("__group").sortWithinPartitions("__group", "__key", "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        rest: list[tuple] = []
        out: list[tuple] = []
        held, now, base = 0, None, 0

        def batch() -> pa.RecordBatch:
            nonlocal out, held
            cols = list(zip(*out, strict=True))
            out, held = [], 0
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        def settle() -> None:
            nonlocal rest, base
            bins, offsets, used = first_fit_decreasing([len(r[2]) // 4 for r in rest], length)
            for (doc, start, ids, n), b, at in zip(rest, bins, offsets, strict=True):
                out.append((doc, start, len(ids) // 4, ids, n, base + b, at))
            rest, base = [], base + used

        for rb in batches:
            for doc, text, group in zip(rb["doc_id"].to_pylist(), rb["text"].to_pylist(), rb["__group"].to_pylist(), strict=True):
                if group != now:
                    settle()
                    now, base = group, group << 32
                ids = np.array([*encode(text), end_id], dtype="<u4")
                n = len(ids)
                for start in range(0, n - n % length, length):
                    out.append((doc, start, length, ids[start:start + length].tobytes(), n, base, 0))
                    base += 1
                if n % length:
                    rest.append((doc, n - n % length, ids[n - n % length:].tobytes(), n))
                held += n
                if len(rest) >= group_docs:
                    settle()
                if held > 1 << 20 and out:
                    yield batch()
        settle()
        if out:
            yield batch()

    return modest_batches(rows).mapInArrow(run, SCHEMA)


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_pack(spark, sf_dir):
    return piece_digest(pack(table(spark, sf_dir, "documents")))
