"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where no merge can cross, each part is merged on its own and its count is kept for
the next time the part occurs. Merging pops the best adjacent pair from a heap until none is left; the
count is the symbols at the start less the merges, and no identifier is ever made.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.common import ready, table, texts, worker_cache

BLANK = "▁"  # how the vocabulary writes a space
# Parts whose counts a worker keeps; when full it starts anew, so memory is bounded.
KEPT_PARTS = 500_000
KEPT_LENGTH = 48


def load_ranks(model: str) -> dict[str, int]:
    """Rank of every piece a merge may make, best first, from a sentencepiece BPE model file."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = (
        i
        for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) or pieces.is_unused(i))
    )
    return {pieces.id_to_piece(i): round(-pieces.get_score(i)) for i in plain}


def merged_count(part: str, ranks: dict[str, int]) -> int:
    """Tokens of ``part``: pairs are merged lowest rank first, leftmost of equals.

    Symbols are a doubly linked list over character positions. A heap entry is one whole number: rank,
    left symbol and end of the pair. A symbol that is no piece counts as its UTF-8 bytes.
    """
    n = len(part)
    bits = (n + 1).bit_length()
    mask, high = (1 << bits) - 1, 2 * bits
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        rank = rank_of(part[i : i + 2])
        if rank is not None:
            heap.append((rank << high) | (i << bits) | (i + 2))
    if heap:
        heapify(heap)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    merges = 0
    while heap:
        entry = heappop(heap)
        end, left = entry & mask, (entry >> bits) & mask
        middle = after[left]
        # Stale when the left symbol is gone or either side has grown since.
        if not 0 <= middle < n or after[middle] != end:
            continue
        merges += 1
        after[left], after[middle], before[end] = end, -1, left
        if end < n:
            wider = after[end]
            rank = rank_of(part[left:wider])
            if rank is not None:
                heappush(heap, (rank << high) | (left << bits) | wider)
        first = before[left]
        if first >= 0:
            rank = rank_of(part[first:end])
            if rank is not None:
                heappush(heap, (rank << high) | (first << bits) | end)
    count = n - merges
    if not part.isascii() or "\x00" <= min(part) < " ":
        at = 0
        while at < n:
            if after[at] - at == 1 and part[at] not in ranks:
                count += len(part[at].encode()) - 1
            at = after[at]
    return count


class PartCounts(dict):
    """Counts by part, merged when first asked for. When full, the older half is let go."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks, self.older = ranks, {}
        # Characters that stand side by side in some piece: no merge reaches across any others.
        self.mates = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}

    def __missing__(self, part: str) -> int:
        count = self.older.get(part)
        if count is None:
            count = self.counted(part)
        if len(part) <= KEPT_LENGTH:
            if len(self) >= KEPT_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = count
        return count

    def counted(self, part: str) -> int:
        """A part is the sum of its stretches between characters that stand side by side in no piece."""
        mates = self.mates
        cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in mates]
        if cuts:
            # No stretch is cut again.
            return sum(self[part[a:b]] for a, b in zip([0, *cuts], [*cuts, len(part)]))
        return merged_count(part, self.ranks) if part else 0


class Counter:
    """Counts tokens of whole texts; merges never reach across a break before a blank or at a line end."""

    def __init__(self, ranks: dict[str, int]):
        crossing = [p for p in ranks if "\n" in p or re.search(f"[^{BLANK}]{BLANK}", p)]
        if crossing:
            raise ValueError(f"pieces reach across words: {crossing[:3]}")
        self.parts = PartCounts(ranks)
        self.break_before = re.compile(f"(?<!{BLANK}){BLANK}")

    def count(self, text: str) -> int:
        if not text:
            return 0
        # A blank is put in front of every text that is not empty.
        shown = BLANK + text.replace(" ", BLANK)
        if BLANK * 2 in shown:
            broken = self.break_before.sub("\n" + BLANK, shown)
        else:
            broken = shown.replace(BLANK, "\n" + BLANK)
        return sum(map(self.parts.__getitem__, broken.split("\n"))) + text.count("\n")


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs(doc_id, text)``.

    Counts are those of the model's library without begin, end or added tokens. A null text counts
    as an empty one (0 tokens); null and repeated ids give one row each; other columns are ignored; an
    empty table gives no rows. Texts of any length are counted whole.
    """
    ranks = load_ranks(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker_counter(model, ranks)
        for batch in batches:
            bodies = batch.column("text").to_pylist()
            tokens = [counter.count(t) for t in bodies]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in bodies], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def _worker_counter(model: str, ranks: dict[str, int]) -> Counter:
    """The counter of this Python worker, kept from task to task."""
    held = worker_cache()
    if model not in held:
        held[model] = Counter(ranks)
    return held[model]


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    import public_tokenizers

    docs = table(ready(spark), sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
