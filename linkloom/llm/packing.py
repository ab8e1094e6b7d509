"""Harmonic packing of token sequences.

A piece of length L belongs to the class of the largest k with k * L <= capacity, and k pieces of
one class fill a sequence. Every worker fills the sequences of each class on its own; what is left,
less than one sequence per class and worker, is packed again by fewer workers. Documents longer than
the capacity, or of a length that would leave a class's sequences loose, are cut to fit.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ready, saved, table, texts, worker_cache

CAPACITY = 2048
END = 1  # closes every document
# A piece may leave this share of its length unused in its sequence before it is cut.
LOOSE = 1 / 32
FOLD = 16  # workers whose leftovers meet in one of the next round
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECE}, sequence_id long, offset long"


def classes(capacity: int, loose: float = LOOSE) -> list[int]:
    """Pieces per sequence of each class: every whole number at first, then steps within ``loose``."""
    out, k = [], 1
    while k <= capacity:
        out.append(k)
        k = max(k + 1, int(k * (1 + loose)))
    return out


def cuts(length: int, capacity: int, loose: float = LOOSE) -> list[int]:
    """Lengths of the pieces of a document: full sequences, then pieces that fill a class closely."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if rest <= capacity * loose * 2 or capacity - k * rest <= k * rest * loose:
            out.append(rest)
            break
        part = capacity // (k + 1)
        out.append(part)
        rest -= part
    return out


def _byte_letters() -> dict[str, int]:
    """Byte of each letter a byte-level vocabulary is written in: printable bytes stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


# The split of a byte-level vocabulary before merging (fixed value of the format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of whole texts as the ``tokenizers`` file ``path`` gives them without added tokens.

    A plain byte-level vocabulary whose ids are its merge ranks is run by ``tiktoken``, which gives
    the same ids several times faster; any other file, and a text that ``tiktoken`` gives up on (a run
    of a million blanks), by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self._ranked(spec)
        self.specials = sorted(self.fast.special_tokens_set) if self.fast else []
        self.path, self.library = path, None

    @property
    def slow(self):
        """The file in ``tokenizers``, read when first asked for."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.no_padding()
            self.library.no_truncation()
        return self.library

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, before, letters = spec["model"], spec["pre_tokenizer"] or {}, _byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = (
            model.get("type") == "BPE"
            and spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
            and all(set(w) <= letters.keys() for w in model["vocab"] if w not in added)
        )
        if not plain:
            return None
        words = {w: i for w, i in model["vocab"].items() if w not in added}
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        if [words[m] for m in merged] != list(range(256, 256 + len(merged))):
            return None
        ranks = {bytes(letters[c] for c in w): i for w, i in words.items()}
        return tiktoken.Encoding(
            "byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added
        )

    def ids(self, text: str) -> bytes:
        """Ids of a text, four little-endian bytes each."""
        if self.fast is not None:
            try:
                if any(t in text for t in self.specials):
                    ids = self.fast.encode(text, allowed_special="all", disallowed_special=())
                    return np.array(ids, "<u4").tobytes()
                return self.fast.encode_to_numpy(text, disallowed_special=()).tobytes()
            except ValueError:
                pass  # too many blanks in a row for its pattern
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _encoder(path: str) -> Encoder:
    held = worker_cache()
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class _Bins:
    """Open sequences by class; a class's sequence is handed out when its pieces are complete."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.sizes = np.array(classes(capacity))
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def put(self, piece: tuple) -> None:
        k = int(self.sizes[np.searchsorted(self.sizes, self.capacity // piece[2], side="right") - 1])
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.close(self.open.pop(k))

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((*p, self.next, offset))
            offset += p[2]
        self.next += 1

    def leave(self) -> None:
        """Pieces of sequences that are not full, with no sequence."""
        for pieces in self.open.values():
            self.rows.extend((*p, None, None) for p in pieces)
        self.open = {}

    def close_all(self) -> None:
        """The last pieces, long ones first, each to the first sequence it fits in."""
        rest = [p for held in self.open.values() for p in held]
        rest.sort(key=lambda p: (-p[2], p[0] is not None, p[0] or 0, p[1], p[3]))
        bins: list[list] = []
        free: list[int] = []
        for p in rest:
            at = next((i for i, room in enumerate(free) if room >= p[2]), None)
            if at is None:
                bins.append([])
                free.append(self.capacity)
                at = len(bins) - 1
            bins[at].append(p)
            free[at] -= p[2]
        for pieces in bins:
            self.close(pieces)
        self.open = {}

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            names = [c.split()[0] for c in _PACKED.split(", ")]
            columns = [pa.array(c, pa.int64()) for c in zip(*self.rows)]
            self.rows = []
            yield pa.record_batch(columns, names=names)


def _first_sequence(turn: int) -> int:
    """Sequence numbers of a worker: its round and place above, a running number below."""
    return (turn << 56) | (TaskContext.get().partitionId() << 32)


def packed(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, loose: float = LOOSE
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    A document's tokens are its ids and ``end``; each token lies in exactly one piece. Offsets in a
    sequence run from 0 without a gap and never pass ``capacity``; what is missing to it is padding. A
    null or empty text is one piece of the end token. Rows with repeated or null ids are documents of
    their own; other columns are ignored; an empty table gives no rows.
    """

    def cut_and_fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = _encoder(path), _Bins(capacity, _first_sequence(0))
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.ids(text) + end.to_bytes(4, "little")
                total, at = len(ids) // 4, 0
                for length in cuts(total, capacity, loose):
                    crc = zlib.crc32(ids[4 * at : 4 * (at + length)])
                    bins.put((doc, at, length, crc, total))
                    at += length
            yield from bins.batches(10_000)
        bins.leave()
        yield from bins.batches(0)

    def fill_again(turn: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = _Bins(capacity, _first_sequence(turn))
            for batch in batches:
                for piece in zip(*(batch.column(i).to_pylist() for i in range(5))):
                    bins.put(piece)
                yield from bins.batches(10_000)
            bins.close_all() if last else bins.leave()
            yield from bins.batches(0)

        return run

    now = saved(texts(docs).mapInArrow(cut_and_fill, _PACKED))
    workers, turn, done = now.rdd.getNumPartitions(), 0, []
    while True:
        done.append(now.filter("sequence_id is not null"))
        if turn and workers == 1:
            break
        workers, turn = max(1, workers // FOLD), turn + 1
        # Less than a sequence per class comes from each worker, whatever the size of the table.
        rest = now.filter("sequence_id is null").drop("sequence_id", "offset").coalesce(workers)
        now = saved(rest.mapInArrow(fill_again(turn, workers == 1), _PACKED))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    import public_tokenizers

    docs = table(ready(spark), sf_dir, "documents")
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
