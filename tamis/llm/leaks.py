"""Problem 9: passages of held-out items in documents.

SimHash fingerprints of all word windows of the items are indexed by blocks of bits: two
fingerprints that differ in at most RADIUS bits agree in at least one of RADIUS + 1 blocks, so
a look-up by every block finds all of them. The windows of a document that hit an item give
candidates; one window that is equal makes a candidate, however many items have it, as every passage
leaves one whole. Of a candidate, some 20 successive item words must mostly stand in the document, then
mostly near one diagonal: counts that no passage can miss, taken for all documents of an item at once.
A local alignment of words decides.

The items are the fixed side. Their words, in blocks of at most PASS_WORDS words, are broadcast as
numbers; a set of items beyond one block takes another pass over the documents for each.

A passage of 20 words with a sixth of them changed leaves a run of 4 or 5 words whole, but a
fingerprint of 20 words so changed is some 11 of 64 bits away, a radius no block index can
serve. So windows are as long as such runs, not as an item.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tamis.plans.runtime import spread

#: Words of a window; bits by which fingerprints may differ; least words of a passage.
WINDOW, RADIUS, PASSAGE = 4, 3, 20
#: Changed, dropped and added words, as a share of a passage.
CHANGED = 1 / 6
#: Cost of a changed, dropped or added word against 1 for an equal one.
EDIT = 2.0
#: Words of items of one pass over the documents (of 8 bytes each); more take more passes.
PASS_WORDS = 4_000_000
#: Documents that are looked up together, at most so many words of them.
TOGETHER, TOGETHER_WORDS = 256, 1_000_000
#: Buckets in which the words, and the pairs of successive words, of a document are marked.
WORD_BUCKETS, PAIR_BUCKETS = 1 << 15, 1 << 16

TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,80}>|&(?:nbsp|amp|lt|gt|quot|#\d+);")
HYPHEN = re.compile(r"(?<=[^\W\d_])(?:-|‐|­)[ \t\r]*\n[ \t]*(?:(?://+|\*+|#+|--+|>+|;+)[ \t]*)*(?=[^\W\d_])")
HYPHENS = re.compile("[-\u2010\u00ad][ \t\r]*\n")
WORD = re.compile(r"[^\W_]+")
SOFT = str.maketrans("", "", "­​‌‍﻿*`~")


def words(text: str | None) -> list[str]:
    """Words in lower case without markup, comment signs and hyphens at line ends; words with
    inner hyphens and apostrophes are split."""
    if not text:
        return []
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "<" in text or "&" in text:
        text = TAG.sub("", text)
    if HYPHENS.search(text):
        text = HYPHEN.sub("", text)
    if not text.isascii() or "*" in text or "`" in text or "~" in text:
        text = text.translate(SOFT).replace("’", "'")
    return WORD.findall(text.lower() if text.isascii() else text.casefold())


def word_hashes(ws: list[str], known: dict[str, int]) -> np.ndarray:
    import xxhash

    out = []
    for w in ws:
        h = known.get(w)
        if h is None:
            if len(known) > 500_000:
                known.clear()
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def fingerprints(h: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """SimHash of every window of ``width`` words: bit by bit the majority over the words'
    hashes, the first word counting twice in windows of an even number."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    voters = [h[i : n + i] for i in range(width)]
    if width % 2 == 0:
        voters.append(h[:n])
    # A bit-sliced counter: ones, twos and fours of the votes for each of the 64 bits.
    planes = [np.zeros(n, np.uint64) for _ in range(max(1, len(voters).bit_length()))]
    for v in voters:
        carry = v.copy()
        for p in planes:
            p_old = p.copy()
            np.bitwise_xor(p, carry, out=p)
            carry &= p_old
    need = len(voters) // 2 + 1
    # votes >= need, by comparing the planes with the constant from the top bit down
    more, same = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))
    for i in reversed(range(len(planes))):
        if need >> i & 1:
            same &= planes[i]
        else:
            more |= same & planes[i]
            same &= ~planes[i]
    return more | same


class BlockIndex:
    """Fingerprints by each of RADIUS + 1 blocks of their bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.bits = 64 // (radius + 1)
        self.blocks = []
        for i in range(radius + 1):
            key = self._key(prints, i)
            order = np.argsort(key, kind="stable")
            self.blocks.append((order, np.searchsorted(key[order], np.arange((1 << self.bits) + 1))))

    def _key(self, f: np.ndarray, i: int) -> np.ndarray:
        return (f >> np.uint64(i * self.bits) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def within(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, entry) positions whose fingerprints differ in at most radius bits, once each."""
        qs, es = [], []
        for i, (order, start) in enumerate(self.blocks):
            key = self._key(f, i)
            n = start[key + 1] - start[key]
            q = np.repeat(np.arange(len(f)), n)
            if not len(q):
                continue
            at = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[key], n)
            e = order[at]
            near = np.bitwise_count(f[q] ^ self.prints[e]) <= self.radius
            qs.append(q[near])
            es.append(e[near])
        if not qs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pair = np.unique(np.concatenate(qs) * np.int64(len(self.prints)) + np.concatenate(es))
        return pair // len(self.prints), pair % len(self.prints)


def may_hold(item: np.ndarray, doc: np.ndarray, least: int = PASSAGE, changed: float = CHANGED) -> bool:
    """A necessary condition of :func:`passage`, by counting alone: among some ``least`` successive item
    words, all but the edits have an equal word in the document near one diagonal, as added and
    dropped words shift it by no more than the edits."""
    edits = math.ceil(least * changed) + 1
    n, m, width = len(item), len(doc), 2 * edits + 1
    i, j = np.nonzero(item[:, None] == doc[None, :])
    if len(i) < least - edits:
        return False
    grid = np.zeros((n + m + width, n), np.int8)
    grid[j - i + n - 1, i] = 1
    band = np.cumsum(grid, axis=0, dtype=np.int16)
    near = band.copy()
    near[width:] -= band[:-width]
    near = np.cumsum(near > 0, axis=1, dtype=np.int16)
    span = near.copy()
    span[:, least:] -= near[:, :-least]
    return int(span.max()) >= least - edits


def may_share(held: np.ndarray, run: int = 1, least: int = PASSAGE, changed: float = CHANGED) -> np.ndarray:
    """A necessary condition of :func:`passage`, cheaper still, for a document each row: among some ``least``
    successive item words, all runs of ``run`` words but those with an edit are ``held`` by the document anywhere."""
    n_runs = least - run + 1
    if held.shape[1] < n_runs:
        return np.zeros(len(held), bool)
    n = np.cumsum(held, axis=1, dtype=np.int32)
    n[:, n_runs:] -= n[:, :-n_runs].copy()
    return n[:, n_runs - 1 :].max(axis=1) >= n_runs - run * (math.ceil(least * changed) + 1)


def word_buckets(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)


def pair_buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of successive words."""
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    return ((x ^ x >> np.uint64(29)) & np.uint64(PAIR_BUCKETS - 1)).astype(np.int64)


def may_align(item: np.ndarray, doc: np.ndarray, least: int = PASSAGE, changed: float = CHANGED) -> bool:
    """A necessary condition of :func:`may_hold`, without its matrix: its diagonals are taken in blocks as wide as
    its band, so any band lies in two neighbours."""
    edits = math.ceil(least * changed) + 1
    order = np.argsort(doc, kind="stable")
    held = doc[order]
    lo, hi = (np.searchsorted(held, item, side) for side in ("left", "right"))
    n = hi - lo
    i = np.repeat(np.arange(len(item)), n)
    if len(i) < least - edits:
        return False
    j = order[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    block = (j - i + len(item)) // (2 * edits + 1)
    grid = np.zeros((int(block.max()) + 2, len(item)), bool)
    grid[block, i] = grid[block + 1, i] = True
    span = np.cumsum(grid[grid.sum(axis=1) >= least - edits], axis=1, dtype=np.int16)
    span[:, least:] -= span[:, :-least].copy()
    return bool((span >= least - edits).any())


def passage(item: np.ndarray, doc: np.ndarray, least: int = PASSAGE, changed: float = CHANGED) -> bool:
    """Some stretch of at least ``least`` item words stands in the document with at most
    ``changed`` of its words edited (one word more is allowed for rounding)."""
    n, m = len(item), len(doc)
    cols, places = np.arange(m + 1) * EDIT, np.arange(m + 1)
    score = np.zeros(m + 1)
    # For each cell: the item word before which its alignment began, and its equal words.
    begin, same = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i in range(n):
        eq = doc == item[i]
        diag = score[:-1] + np.where(eq, 1.0, -EDIT)
        up = score[1:] - EDIT
        take = diag >= up
        best = np.maximum(np.where(take, diag, up), 0.0)
        b = np.where(take, begin[:-1], begin[1:])
        s = np.where(take, same[:-1] + eq, same[1:])
        fresh = best <= 0
        b[fresh], s[fresh] = i + 1, 0
        row = np.concatenate([[0.0], best])
        b, s = np.concatenate([[i + 1], b]), np.concatenate([[0], s])
        # Added words: a cell may come from any cell to its left.
        lifted = row + cols
        top = np.maximum.accumulate(lifted)
        src = np.maximum.accumulate(np.where(lifted >= top, places, 0))
        new = top - cols
        moved = new > row
        score = np.where(moved, new, row)
        begin, same = np.where(moved, b[src], b), np.where(moved, s[src], s)
        span = i + 1 - begin
        # score = same - EDIT * edits
        edits = (same - score) / EDIT
        if ((span >= least) & (edits <= np.ceil(span * changed)) & (score > 0)).any():
            return True
    return False


class ItemIndex:
    """The items of one pass: fingerprints of their windows by blocks of bits, and their words as numbers."""

    def __init__(self, seqs: list[np.ndarray]):
        self.seqs = seqs
        prints = [fingerprints(s) for s in seqs]
        owner = np.repeat(np.arange(len(seqs)), [len(p) for p in prints])
        flat = np.concatenate([np.empty(0, np.uint64), *prints])
        # Equal windows are one entry that lists its items.
        self.distinct, which = np.unique(flat, return_inverse=True)
        pairs = np.unique(which.astype(np.int64) * max(1, len(seqs)) + owner)
        entry, self.item_of = pairs // max(1, len(seqs)), pairs % max(1, len(seqs))
        self.first = np.searchsorted(entry, np.arange(len(self.distinct) + 1))
        self.blocks = BlockIndex(self.distinct)
        # Words as places in a sorted list; those of no item share the last place.
        self.words = np.unique(np.concatenate([np.empty(0, np.uint64), *seqs]))
        self.word_at = [np.searchsorted(self.words, s).astype(np.int32) for s in seqs]
        self.singles, self.doubles = [word_buckets(x) for x in seqs], [pair_buckets(x) for x in seqs]
        self.held = np.zeros(len(self.words) + 1, bool)

    def hits(self, hs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, window, whole) of every window of a document within the radius of an item's."""
        fs = [fingerprints(h) for h in hs]
        size = np.array([len(f) for f in fs], np.int64)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flat = np.concatenate([np.empty(0, np.uint64), *fs])
        q, e = self.blocks.within(flat)
        n = self.first[e + 1] - self.first[e]
        items = self.item_of[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[e], n)]
        whole = np.repeat(flat[q] == self.distinct[e], n)
        q = np.repeat(q, n)
        return np.repeat(np.arange(len(fs)), size)[q], items, at[q], whole

    def search(self, hs: list[np.ndarray]) -> list[tuple[int, int]]:
        """(document, item) of every document that holds a passage of an item."""
        if not len(self.distinct):
            return []
        doc, item, place, whole = self.hits(hs)
        # Any passage of an item leaves a window whole: a pair without one can't hold it.
        doc, item, place = doc[whole], item[whole], place[whole]
        order = np.lexsort((place, doc, item))
        doc, item, place = doc[order], item[order], place[order]
        if not len(doc):
            return []
        # What a document holds, by bucket: two that fall together only let more pass.
        some, row = np.unique(doc, return_inverse=True)
        single, double = np.zeros((len(some), WORD_BUCKETS), bool), np.zeros((len(some), PAIR_BUCKETS), bool)
        for k, d in enumerate(some.tolist()):
            single[k, word_buckets(hs[d])] = True
            double[k, pair_buckets(hs[d])] = True
        numbers: dict[int, np.ndarray] = {}
        new = np.flatnonzero(np.diff(item, prepend=-1) | np.diff(doc, prepend=-1))
        ends = np.append(new[1:], len(doc))
        starts_item = np.flatnonzero(np.diff(item[new], prepend=-1))
        out = []
        for lo, hi in zip(starts_item.tolist(), [*starts_item[1:].tolist(), len(new)]):
            i = int(item[new[lo]])
            if len(self.seqs[i]) < PASSAGE:
                continue
            docs, at = doc[new[lo:hi]], np.arange(lo, hi)
            rows = row[new[lo:hi]]
            can = may_share(single[rows[:, None], self.singles[i][None, :]])
            docs, at, rows = docs[can], at[can], rows[can]
            can = may_share(double[rows[:, None], self.doubles[i][None, :]], 2)
            for d, k in zip(docs[can].tolist(), at[can].tolist()):
                if d not in numbers:
                    w = np.searchsorted(self.words, hs[d])
                    w[self.words[np.minimum(w, len(self.words) - 1)] != hs[d]] = len(self.words)
                    numbers[d] = w.astype(np.int32)
                if self._holds(i, numbers[d], place[new[k] : ends[k]]):
                    out.append((d, i))
        return sorted(out)

    def _holds(self, i: int, doc: np.ndarray, hits: np.ndarray) -> bool:
        """Only the surroundings of the equal windows can hold the passage. Words are numbers here."""
        seq = self.word_at[i]
        reach = len(seq) * 7 // 6 + 8
        cuts = np.flatnonzero(hits[1:] - hits[:-1] > reach) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hits)]):
            part = doc[max(0, hits[lo] - reach) : hits[hi - 1] + WINDOW + reach]
            if len(part) < len(doc):
                self.held[part] = True
                self.held[-1] = False
                can = may_share(self.held[seq][None, :])[0]
                self.held[part] = False
                if not can:
                    continue
            if may_align(seq, part) and may_hold(seq, part) and passage(seq, part):
                return True
        return False


def item_passes(items: DataFrame, per_pass: int = PASS_WORDS) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, word hashes) of the distinct items, in blocks of at most so many words (one item at least); one block
    at a time is on the driver."""
    known: dict[str, int] = {}
    ids, seqs, n = [], [], 0
    rows = items.where("item_id is not null and text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        seq = word_hashes(words(r["text"]), known)
        if len(seq) < PASSAGE:
            continue
        if ids and n + len(seq) > per_pass:
            yield ids, seqs
            ids, seqs, n = [], [], 0
        ids.append(r["item_id"])
        seqs.append(seq)
        n += len(seq)
    yield ids, seqs


def together(texts: list[str | None], known: dict[str, int]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(place of the first, word hashes) of runs of documents."""
    at, hs, n = 0, [], 0
    for k, t in enumerate(texts):
        h = word_hashes(words(t), known)
        if hs and (len(hs) >= TOGETHER or n + len(h) > TOGETHER_WORDS):
            yield at, hs
            at, hs, n = k, [], 0
        hs.append(h)
        n += len(h)
    if hs:
        yield at, hs


def leaked(docs: DataFrame, items: DataFrame, per_pass: int = PASS_WORDS) -> DataFrame:
    """``doc_id, item_id`` of documents that hold a passage of an item, with ids of any type.

    Null and short texts hold none, repeated documents come out once per row, repeated items
    once; other columns are ignored.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    sc, id_type = docs.sparkSession.sparkContext, to_arrow_type(items.schema["item_id"].dataType)
    kinds = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    src = spread(docs.select("doc_id", "text"))
    out = None
    for ids, seqs in item_passes(items, per_pass):
        sent = sc.broadcast((ids, seqs))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, seqs = sent.value
            index = ItemIndex(seqs)
            known: dict[str, int] = {}
            for b in batches:
                for at, hs in together(b.column(1).to_pylist(), known):
                    got = index.search(hs)
                    if got:
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([at + d for d, _ in got])), pa.array([ids[i] for _, i in got], id_type)], ["doc_id", "item_id"])

        part = src.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}")
        out = part if out is None else out.unionByName(part)
    return out
