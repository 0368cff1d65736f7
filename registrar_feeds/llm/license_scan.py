"""License scan by a generalised suffix automaton.

The automaton holds the word sequences of all license templates and of the
base phrases.  A document is streamed through it: after each word its state and
match length are the longest run of words, ending there, that stands in some
template (the matching statistics).  Phrase places are read off the states.
Runs of at least ``min_match`` words that cannot be extended are chained for
each template, in order in both texts, and a chain that covers enough of its
template gives a span with the template's label.  Labels of versions are given
where the words that tell the version stand: in one match of the chain, or in the
full name of the license, which is read off the states as the phrases are.

Words that open no pair of template words are skipped in bulk: no match of two
words or more spans them; phrases and names of one word are looked up beside.

Defined cases: a null or empty text has no words and no labels; equal rows are
scanned alike; of chains that cover as much, the first one counts; a very long
text is read whole, in time in proportion to its words and matches; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from registrar_feeds.llm.common import LOWER, UPPER, modest_batches, table, text_or_empty
from registrar_feeds.llm.license_texts import NAMES, PHRASES, TEMPLATES, VERSIONS

#: Words of a match that counts for a chain, words of the document between two
#: matches of a chain, and the part of a template that a chain must cover.
MIN_MATCH = 5
MAX_GAP = 40
COVERED = 0.6

#: Bytes of a word stay (A-Z folded), all others become a space.
_WORDS = bytes(
    LOWER.encode()[UPPER.encode().index(b)] if b in UPPER.encode()
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans string")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORDS).split()


class Automaton:
    """Suffix automaton over several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, seq in enumerate(sequences):
            at = 0
            for i, w in enumerate(seq):
                at = self._extend(at, w)
                self.ends[at].add((k, i + 1))
        # where the words of a state end is also where those of its suffixes do
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of ``q`` for the suffixes that ``p`` reaches by ``w``."""
        copy = self._new(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        cur, p = self._new(self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        while state and w not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(w)
        return (to, length + 1) if to is not None else (0, 0)


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP,
                 covered: float = COVERED, names=NAMES, versions=VERSIONS):
        self.min_match, self.max_gap, self.covered = min_match, max_gap, covered
        named = [(label, words_of(text)) for label, text in templates.items()]
        named = [(label, w) for label, w in named if w]
        base = [(label, words_of(text)) for text, label in [*phrases.items(), *names.items()]]
        of_base = [True] * len(phrases) + [False] * len(names)
        # of each template: first word and end of the words that tell a version
        self.versions = [[(a, a + len(v), version) for words, version in versions.get(label, {}).items()
                          for v in [words_of(words)] for a in range(len(w) - len(v) + 1) if w[a:a + len(v)] == v]
                         for label, w in named]
        self.labels = [label for label, _ in named]
        self.sizes = [len(w) for _, w in named]
        self.ids: dict[bytes, int] = {}
        seqs = [[self.ids.setdefault(x, len(self.ids)) for x in w] for _, w in [*named, *base]]
        self.auto = Automaton(seqs)
        self.none = len(self.ids)
        self.pairs = np.zeros((self.none + 1, self.none + 1), bool)
        for s in seqs:
            for a, b in zip(s, s[1:], strict=False):
                self.pairs[a, b] = True
        self.single = {seqs[len(named) + k][0]: (label, of_base[k]) for k, (label, w) in enumerate(base) if len(w) == 1}
        # at a state: phrases and names of two words or more that its words end with
        self.phrase_at: list[list[tuple[int, str, bool]]] = [[] for _ in self.auto.next]
        for s in range(len(self.auto.next)):
            for k, end in self.auto.ends[s]:
                if k >= len(named) and end > 1 and end == len(base[k - len(named)][1]) == self.auto.length[s]:
                    self.phrase_at[s].append((end, base[k - len(named)][0], of_base[k - len(named)]))
        for s in sorted(range(1, len(self.auto.next)), key=lambda s: self.auto.length[s]):
            self.phrase_at[s] = list(dict.fromkeys([*self.phrase_at[s], *self.phrase_at[self.auto.link[s]]]))

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        places: list[tuple[int, int, str, bool]] = []  # first word, end, label, base?
        matches: list[tuple[int, int, int]] = []  # state, first word, words
        if len(words) > 1:
            get, none = self.ids.get, self.none
            ids = np.fromiter((get(w, none) for w in words), np.int32, len(words))
            linked = self.pairs[ids[:-1], ids[1:]]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], linked, [False])).astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                self._stream(ids[a:b + 1].tolist(), a, places, matches)
        if self.single:
            at = ((i, self.single.get(self.ids.get(w))) for i, w in enumerate(words))
            places += [(i, i + 1, *found) for i, found in at if found]
        spans = self._chains(matches) + [(label, a, b, 1.0) for a, b, label, of_base in places if not of_base]
        first = [a for a, _, _, of_base in places if of_base]
        base = sorted({label for _, _, label, of_base in places if of_base})
        labels = sorted({*base, *(s[0] for s in spans)})
        score = max([1.0 if base else 0.0, *(s[3] for s in spans)])
        return (len(words), len(first), min(first, default=None), max(first, default=None),
                ",".join(base), ",".join(labels), score, ",".join(f"{k}:{a}:{b}" for k, a, b, _ in sorted(spans, key=lambda s: (s[1], s[2], s[0]))))

    def _stream(self, ids: list[int], first: int, places: list, matches: list) -> None:
        state, length, step, phrases = 0, 0, self.auto.step, self.phrase_at
        for i, w in enumerate(ids):
            before, had = state, length
            state, length = step(state, length, w)
            if length <= had and had >= self.min_match:
                matches.append((before, first + i - had, had))
            for size, label, of_base in phrases[state]:
                if size <= length:
                    places.append((first + i + 1 - size, first + i + 1, label, of_base))
        if length >= self.min_match:
            matches.append((state, first + len(ids) - length, length))

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, end, part of the template covered)."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for state, at, n in matches:
            for k, end in self.auto.ends[state]:
                if k < len(self.labels):
                    by.setdefault(k, []).append((at, end - n, n))
        out = []
        for k, found in by.items():
            need, group = self.covered * self.sizes[k], []
            found.sort()
            reach = 0
            for m in found:  # apart by more than the gap: other chains
                if group and m[0] > reach + self.max_gap:
                    out += self._best(k, group, need)
                    group = []
                group.append(m)
                reach = max(reach, m[0] + m[2]) if len(group) > 1 else m[0] + m[2]
            if group:
                out += self._best(k, group, need)
        return out

    def _best(self, k: int, found: list[tuple[int, int, int]], need: float) -> list[tuple[str, int, int, float]]:
        """Chains that cover enough, those of most words first, none within another.

        One pass works out the best chain that ends at each match and takes all
        that stand apart; what they leave is gone through again, until a pass
        takes none."""
        out: list[tuple[str, int, int, float]] = []
        while found:
            best = [m[2] for m in found]
            back = [-1] * len(found)
            for j, (a, t, n) in enumerate(found):
                for i in range(j - 1, -1, -1):
                    a0, t0, n0 = found[i]
                    if a - a0 > self.max_gap + self.sizes[k]:
                        break
                    over = max(0, a0 + n0 - a, t0 + n0 - t)
                    if a0 < a and t0 < t and over < n and a - (a0 + n0) <= self.max_gap and best[i] + n - over > best[j]:
                        best[j], back[j] = best[i] + n - over, i
            taken: list[tuple[int, int]] = []
            for j in sorted((j for j in range(len(found)) if best[j] >= need), key=lambda j: (-best[j], j)):
                end, chain = found[j][0] + found[j][2], [j]
                place = bisect.bisect_left(taken, (end,))
                if place and taken[place - 1][1] > found[j][0]:
                    continue
                while back[chain[-1]] >= 0:
                    chain.append(back[chain[-1]])
                start = found[chain[-1]][0]
                if place < len(taken) and taken[place][0] < end or place and taken[place - 1][1] > start:
                    continue
                taken.insert(place, (start, end))
                part = min(1.0, best[j] / self.sizes[k])
                out.append((self.labels[k], start, end, part))
                out += [(version, start, end, part) for a, b, version in self.versions[k]
                        if any(found[i][1] <= a and b <= found[i][1] + found[i][2] for i in chain)]
            if not taken:
                break
            left = []
            for m in found:
                place = bisect.bisect_left(taken, (m[0] + m[2],))
                if not place or taken[place - 1][1] <= m[0]:
                    left.append(m)
            found = left
        return out


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, **options) -> DataFrame:
    """One row per document; spans are label:first word:end (exclusive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, **options)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for rb in batches:
            if rb.num_rows:
                rows = [scanner.scan(t) for t in rb["text"].to_pylist()]
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([rb["doc_id"], *cols], ["doc_id", *names])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    return modest_batches(rows).mapInArrow(run, SCHEMA)


def op7_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
