"""Problem 8: encoding of a corpus by a byte-level BPE vocabulary.

Words of a whole batch of documents are encoded at once: an inverted index from token pair to
the places where it stands applies every merge in rank order to all words together and
touches only the neighbours of each merge. A word is encoded once and then kept by its
spelling, so the work follows the distinct words and no row is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame

#: Default places of the public vocabulary; both are parameters everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits a text into words before the merges.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words kept per Python worker; beyond it the table is begun anew.
CACHE_WORDS = 400_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Encodes sets of words by replaying the merges of a vocabulary in rank order."""

    def __init__(self, path: str = VOCABULARY):
        import regex

        ranks = load_ranks(path)
        self.byte_id = [ranks[bytes([i])] for i in range(256)]
        self.spelled = {i: b for b, i in ranks.items()}
        self.ranks = ranks
        self.split = regex.compile(WORD_PATTERN).findall
        self.known: dict[str, list[int]] = {}
        self.merged: dict[tuple[int, int], int] = {}

    def merge_of(self, pair: tuple[int, int]) -> int:
        """Id that the pair merges to, or -1."""
        got = self.merged.get(pair)
        if got is None:
            got = self.merged[pair] = self.ranks.get(self.spelled[pair[0]] + self.spelled[pair[1]], -1)
        return got

    def learn(self, words: set[str]) -> None:
        """Encodes all words that aren't known yet, together."""
        todo = [w for w in words if w not in self.known]
        ids: list[int] = []
        after: list[int] = []
        before: list[int] = []
        heads: list[int] = []
        for w in todo:
            data = w.encode("utf-8", "surrogatepass")
            at, n = len(ids), len(data)
            heads.append(at)
            ids.extend([self.byte_id[x] for x in data])
            after.extend(range(at + 1, at + n))
            after.append(-1)
            before.append(-1)
            before.extend(range(at, at + n - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for i, j in enumerate(after):
            if j >= 0:
                places[ids[i], ids[j]].append(i)
        heap = [(m, p) for p in places if (m := self.merge_of(p)) >= 0]
        heapq.heapify(heap)
        while heap:
            new, pair = heapq.heappop(heap)
            a, b = pair
            for i in sorted(places.pop(pair, ())):
                j = after[i]
                if ids[i] != a or j < 0 or ids[j] != b:
                    continue  # a neighbour's merge took one of the two
                k = after[j]
                ids[i], ids[j], after[i] = new, -1, k
                if k >= 0:
                    before[k] = i
                for left, right in ((before[i], i), (i, k)):
                    if left >= 0 and right >= 0:
                        p = (ids[left], ids[right])
                        held = places.get(p)
                        if held is None:
                            places[p] = [left]
                            if (m := self.merge_of(p)) >= 0:
                                heapq.heappush(heap, (m, p))
                        else:
                            held.append(left)
        for w, i in zip(todo, heads):
            out = []
            while i >= 0:
                out.append(ids[i])
                i = after[i]
            self.known[w] = out

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts have none."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        split = [self.split(t) if t else [] for t in texts]
        self.learn({w for ws in split for w in ws})
        known = self.known
        out = []
        for ws in split:
            row: list[int] = []
            for w in ws:
                row += known[w]
            out.append(row)
        return out


@lru_cache(maxsize=2)
def replay(path: str) -> MergeReplay:
    """One encoder per worker and vocabulary."""
    return MergeReplay(path)


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``id_col`` and ``ids`` of every row, without special tokens.

    Null and empty texts give an empty list, blanks are encoded as they are, strings that look
    like special tokens are ordinary text; repeated rows are kept. Other columns are ignored.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = replay(vocabulary)
        for b in batches:
            ids = enc.encode_batch(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["k", "ids"])

    return docs.select(docs[id_col].alias("k"), docs[text_col].alias("t")).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", id_col)
