"""Exact n-gram Jaccard join by a token-group matrix.

Three steps keep the join exact and small:

1. A document can only have a partner if enough of its shingles lie in other documents too. Blocks of texts
   send each of their shingles once, packed, to buckets, which answer which of them other documents have
   and how many. Only documents that share enough go on, with their shared shingles, one for each
   distinct set. The texts are read once.
2. Similar documents are put into groups: runs of the order of their minwise values, and of those with the
   document among them that has the least of its own, are compared first; then linked documents lie
   next to each other. A row of the token-group matrix says which groups hold a shingle; as a pair at the
   threshold shares one of the rarest shingles of both, only those are looked up.
3. A document is sent to a group that it may match. There the group's token union bounds the overlap with
   any member, and only if the bound reaches the threshold is the group opened and compared in full.

Documents already known to be linked are not compared again: of a shingle's documents, those outside its
largest component look up the groups, which is every pair that may still join two components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import let_go, partitions, ready, saved, table, text_pieces, texts, written
from linkloom.llm.components import components
from linkloom.llm.near_dedup import set_keys
from linkloom.llm.nodes import clusters, groups
from linkloom.llm.words import LOWER, overlaps, shingle_sets, sketches, word_codes, word_spans
from linkloom.session import own_side

PERCENT = 85
BLOCK = 1 << 21  # shingles that a block of texts sends at once
BLOCK_DOCS = 60_000
BUCKET_BYTES = 8 << 20  # bytes of text whose shingles meet in one bucket, on average
MEMBERS = 64  # documents of a group
MARKS = 3  # minwise values that order documents
ASKERS = 2048  # documents compared with one copy of a group
_U = np.uint64
_SEVERAL = 0xFFFF  # in place of a document's number: several of the block have the shingle
_LOW = _U((1 << 48) - 1)

# What blocks send: shingles to a bucket, and one row with what the block knows of its documents.
_ASKED = (
    "bucket int, block long, low binary, high binary, owners binary, times binary,"
    " ids binary, sizes binary, key_a binary, key_b binary, marks binary"
)
# What they get back.
_ANSWERED = (
    "block long, bucket int, low binary, high binary, owners binary, times binary,"
    " ids binary, sizes binary, key_a binary, key_b binary, marks binary"
)
_KNOWN = (
    "doc_id long, n_shingles long, key_a long, key_b long, passed boolean, marks binary, codes binary,"
    " rare array<long>"
)
_HEAD = ("ids", "sizes", "key_a", "key_b", "marks")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[part.split()[1]] for part in schema.split(",")]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_names(schema))


def _shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[data]
    starts, ends, firsts = word_spans(low, offsets)
    return shingle_sets(word_codes(low, starts, ends), firsts, width)


def _asked(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Requests of blocks of texts, by bucket.

    A shingle is sent once for a block, with its document's number or, where several have it, how many:
    however common it is, a bucket gets it once from each block. 48 bits tell shingles of a bucket apart.
    """

    def block(number: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, codes, sizes, keys, marks = (np.concatenate(c, axis=-1) for c in zip(*parts))
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(codes)
        codes, owner = codes[order], owner[order]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
        times = np.diff(np.r_[first, len(codes)])
        place = ((codes[first] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        again = np.repeat(times > 1, times)
        ident, holders = _ident(codes[again], np.repeat(place, times)[again]), owner[again].astype(np.uint16)
        rows = []
        codes, owner = codes[first], np.where(times > 1, _SEVERAL, owner[first])
        cuts = np.searchsorted(place, np.arange(buckets + 1))
        nothing = (None,) * len(_HEAD)
        for b in np.flatnonzero(np.diff(cuts)):
            # By document: steps from one number to the next are small and compress well.
            at = cuts[b] + np.argsort(owner[cuts[b] : cuts[b + 1]], kind="stable")
            own = owner[at]
            rows.append((
                int(b), number, codes[at].astype(np.uint32).tobytes(), (codes[at] >> _U(32)).astype(np.uint16).tobytes(),
                np.diff(own, prepend=0).astype(np.uint16).tobytes(),
                times[at[own == _SEVERAL]].astype(np.uint32).tobytes(), *nothing,
            ))
        rows.append((
            number % buckets, number, ident.tobytes(), None, holders.tobytes(), None,
            ids.tobytes(), sizes.tobytes(), keys[0].tobytes(), keys[1].tobytes(), np.ascontiguousarray(marks.T).tobytes(),
        ))
        return _batch(_ASKED, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, rows = TaskContext.get().partitionId() << 32, [], 0, 0
        for part, data, offsets in text_pieces(batches):
            flat, where = _shingles(data, offsets, width)
            marks = sketches(flat, where, MARKS)
            ids = part.column("doc_id").to_numpy()
            held.append((ids, flat, np.diff(where), set_keys(flat, where), marks.T))
            size, rows = size + len(flat), rows + part.num_rows
            if size >= BLOCK or rows >= BLOCK_DOCS:
                yield block(number, held)
                number, held, size, rows = number + 1, [], 0, 0
        if held:
            yield block(number, held)

    return texts(docs.filter("doc_id is not null")).mapInArrow(run, _ASKED)


def _ident(codes: np.ndarray, bucket) -> np.ndarray:
    """A shingle's name after its bucket has seen it."""
    return (codes & _LOW) | (np.asarray(bucket).astype(_U) << _U(48))


def _answered(requests: DataFrame) -> DataFrame:
    """For each block and bucket the shingles that more than one document has, and how many have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in groups(batches, "bucket"):
            number = bucket.column("bucket")[0].as_py()
            asks, out = [], []
            for row in bucket.select(_names(_ASKED)[1:]).to_pylist():
                if row["ids"] is not None:
                    kept = (row["block"], number, row["low"], None, row["owners"], None)
                    out.append((*kept, *(row[c] for c in _HEAD)))
                else:
                    asks.append(row)
            if asks:
                low = np.concatenate([np.frombuffer(r["low"], np.uint32) for r in asks]).astype(_U)
                high = np.concatenate([np.frombuffer(r["high"], np.uint16) for r in asks]).astype(_U)
                owner = np.concatenate([np.cumsum(np.frombuffer(r["owners"], np.uint16), dtype=np.uint16) for r in asks])
                times = np.ones(len(low), np.int64)
                times[owner == _SEVERAL] = np.concatenate([np.frombuffer(r["times"], np.uint32) for r in asks])
                code = low | (high << _U(32))
                _, at = np.unique(code, return_inverse=True)
                df = np.bincount(at, weights=times).astype(np.int64)[at]
                df = np.minimum(df, 2**32 - 1).astype(np.uint32)
                cuts = np.r_[0, np.cumsum([len(r["low"]) // 4 for r in asks])]
                for r, a, b in zip(asks, cuts[:-1], cuts[1:]):
                    hit = a + np.flatnonzero(df[a:b] > 1)
                    if len(hit):
                        told = (low[hit].astype(np.uint32), high[hit].astype(np.uint16), owner[hit], df[hit])
                        out.append((r["block"], number, *(x.tobytes() for x in told), *(None,) * len(_HEAD)))
            if out:
                yield _batch(_ANSWERED, out)

    return requests.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _ANSWERED)


def _told(answer: dict) -> np.ndarray:
    low, high = np.frombuffer(answer["low"], np.uint32), np.frombuffer(answer["high"], np.uint16)
    return _ident(low.astype(_U) | (high.astype(_U) << _U(32)), answer["bucket"])


def _sets_of(block: pa.Table, percent: int) -> Iterator[tuple]:
    """Rows of ``_KNOWN`` of the documents of one block from its answers."""
    rows = block.to_pylist()
    head = next(r for r in rows if r["ids"] is not None)
    ids, sizes, key_a, key_b = (np.frombuffer(head[c], np.int64) for c in ("ids", "sizes", "key_a", "key_b"))
    marks = np.frombuffer(head["marks"], np.uint32).reshape(len(ids), -1)
    told = [r for r in rows if r["ids"] is None]
    none = [np.zeros(0, _U)]
    code = np.concatenate([_told(r) for r in told] or none)
    owner = np.concatenate([np.frombuffer(r["owners"], np.uint16) for r in told] or none).astype(np.int64)
    df = np.concatenate([np.frombuffer(r["times"], np.uint32) for r in told] or none).astype(np.int64)
    # Shingles that several of the block have: their documents are known here, their number is in the answers.
    common, holders = np.frombuffer(head["low"], _U), np.frombuffer(head["owners"], np.uint16)
    several = owner == _SEVERAL
    order = np.argsort(code[several])
    at = np.searchsorted(code[several][order], common)
    code = np.r_[code[~several], common]
    df = np.r_[df[~several], df[several][order][at]]
    owner = np.r_[owner[~several], holders.astype(np.int64)]
    order = np.lexsort((code, df, owner))
    code, owner = code[order].view(np.int64), owner[order]
    where = np.searchsorted(owner, np.arange(len(ids) + 1))
    shared = np.diff(where)
    passed = (sizes > 0) & (100 * shared >= percent * sizes)
    # Of equal sets of a block one row carries the shingles.
    _, first = np.unique(np.stack([key_a, key_b], axis=1), axis=0, return_index=True)
    carries = np.zeros(len(ids), bool)
    carries[first] = True
    for i in range(len(ids)):
        codes = rare = mark = None
        if passed[i] and carries[i]:
            own = code[where[i] : where[i + 1]]
            least = -(-int(sizes[i]) * percent // 100)
            codes, rare, mark = np.sort(own).tobytes(), own[: len(own) - least + 1], marks[i].astype(">u4").tobytes()
        yield int(ids[i]), int(sizes[i]), int(key_a[i]), int(key_b[i]), bool(passed[i]), mark, codes, rare


def known_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, passed, marks, codes, rare`` of each row with an id, written.

    ``passed`` says that ``percent`` of the shingles lie in other rows too; of such sets one row of a block
    at least has ``codes``, the shared shingles in order, and ``rare``, the rarest of them that any partner
    must share one of (those that no other document has come before them and are left out).
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    answers = _answered(_asked(docs, width, max(1, -(-size // BUCKET_BYTES))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in groups(batches, "block"):
            rows = []
            for row in _sets_of(block, percent):
                rows.append(row)
                if len(rows) == 512:
                    yield _batch(_KNOWN, rows)
                    rows = []
            if rows:
                yield _batch(_KNOWN, rows)

    dealt = answers.repartition("block").sortWithinPartitions("block")
    return written(dealt.mapInArrow(run, _KNOWN), "sets")


def _sizes(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles`` of rows without id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_pieces(batches):
            _, where = _shingles(data, offsets, width)
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(np.diff(where))], names=["doc_id", "n_shingles"]
            )

    return texts(docs.filter("doc_id is null")).mapInArrow(run, "doc_id long, n_shingles long")


def _loaded(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, set sizes, shared shingles of all rows and where each begins."""
    blobs = rows.column("codes").to_pylist()
    flat = np.frombuffer(b"".join(blobs), np.int64)
    where = np.r_[0, np.cumsum([len(b) // 8 for b in blobs])].astype(np.int64)
    return rows.column("id").to_numpy(), rows.column("n").to_numpy(), flat, where


def _runs_linked(sets: DataFrame, percent: int, members: int) -> DataFrame:
    """Links ``a, b`` inside runs of ``members`` documents in the order of their minwise values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _stretches(batches, members):
            ids, n, flat, where = _loaded(block)
            common = overlaps(flat, where)
            alike = (100 * common >= percent * (n[:, None] + n[None, :] - common)) & (common > 0)
            label = clusters(alike)
            at = np.flatnonzero(label != np.arange(len(ids)))
            if len(at):
                yield pa.record_batch([pa.array(ids[label[at]]), pa.array(ids[at])], names=["a", "b"])

    order = ["marks", "id"]
    dealt = sets.repartitionByRange(partitions(sets.sparkSession), *order)
    return dealt.sortWithinPartitions(*order).select("id", "n", "codes").mapInArrow(run, "a long, b long")


def _hub_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` to hubs: of the documents with a rare shingle the one with the least of its own.

    Copies that were changed in different places are alike to what they were made from more often
    than to each other. Each document is compared with one hub per rare shingle.
    """
    own = sets.select("id", "n", (F.octet_length("codes") / 8 / F.col("n")).alias("part"), F.explode("rare").alias("code"))
    hubs = own.groupBy("code").agg(F.max(F.struct("part", (-F.col("id")).alias("last"))).alias("hub"), F.count("*").alias("docs"))
    hubs = own_side(hubs.filter("docs > 1").select("code", (-F.col("hub.last")).alias("grp")))
    asks = own.select("id", "code").join(hubs, "code").filter("id != grp").select("id", "grp").distinct()
    placed = hubs.select(F.col("grp").alias("id"), "grp").distinct()
    return _open(saved(asks), sets, placed, percent)


def _stretches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The stream in tables of ``size`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            take = batch.slice(0, size - n)
            held.append(take)
            n += take.num_rows
            batch = batch.slice(take.num_rows)
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _grouped(sets: DataFrame, whole: DataFrame, members: int) -> DataFrame:
    """``id, component, grp, only``: groups of ``members`` documents, linked ones next to each other.

    Components follow the minwise values of their first document. ``only`` is the component of a group
    that holds no other. Groups are numbered by the partition and the run, once: the table is written.
    """
    known = sets.select("id").join(whole, "id", "left")
    known = known.withColumn("component", F.coalesce("component", "id"))
    heads = sets.select(F.col("id").alias("component"), F.col("marks").alias("head"))
    rows = known.join(heads, "component")
    order = ["head", "component", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        of: list[int] = []

        def out() -> pa.RecordBatch:
            only = of[0] if of[0] == of[-1] else None
            rows = [pa.array(c, pa.int64()) for c in (ids, of, [number] * len(ids), [only] * len(ids))]
            return pa.record_batch(rows, names=["id", "component", "grp", "only"])

        for batch in batches:
            for i, c in zip(batch.column("id").to_pylist(), batch.column("component").to_pylist()):
                # A run of one component is not filled up with others, unless it is short.
                if len(ids) == members or len(ids) >= members // 4 and of[0] == of[-1] != c:
                    yield out()
                    number, ids, of = number + 1, [], []
                ids.append(i)
                of.append(c)
        if ids:
            yield out()

    dealt = rows.repartitionByRange(partitions(sets.sparkSession), *order).sortWithinPartitions(*order)
    return written(
        dealt.select("id", "component").mapInArrow(run, "id long, component long, grp long, only long"),
        "groups",
    )


def _open(asks: DataFrame, sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between the documents of ``asks(id, grp)`` and members of those groups."""
    copies = asks.groupBy("grp").agg(F.ceil(F.count("*") / ASKERS).alias("copies"))
    copies = own_side(copies)
    members = (
        placed.select("id", "grp")
        .join(copies, "grp")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select("id", "grp", "copy", F.lit(False).alias("asks"))
    )
    asking = asks.join(copies, "grp").select(
        "id", "grp", F.pmod(F.xxhash64("id"), "copies").alias("copy"), F.lit(True).alias("asks")
    )
    rows = members.unionByName(asking).join(sets.select("id", "n", "codes"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, group = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("grp", "copy", "asks"))))
            a = 0
            while a < len(keys):
                b = a + 1
                while b < len(keys) and keys[b] == keys[a]:
                    b += 1
                part = batch.slice(a, b - a)
                if keys[a][:2] != at:
                    at, held, group = keys[a][:2], [], None
                if not keys[a][2]:
                    held.append(part)
                else:
                    if group is None:
                        ids, n, flat, where = _loaded(pa.Table.from_batches(held))
                        owner = np.repeat(np.arange(len(ids)), np.diff(where))
                        union, place = np.unique(flat, return_inverse=True)
                        group = ids, n, owner, union, place
                    found = _matches(part, group, percent)
                    if found.num_rows:
                        yield found
                a = b

    dealt = rows.repartition("grp", "copy").sortWithinPartitions("grp", "copy", "asks")
    return dealt.mapInArrow(run, "a long, b long")


def _matches(asking: pa.RecordBatch, group, percent: int) -> pa.RecordBatch:
    ids, n, owner, union, place = group
    out: list[tuple[np.ndarray, np.ndarray]] = []
    names, sizes, flat, where = _loaded(pa.Table.from_batches([asking]))
    spot = np.searchsorted(union, flat)
    spot[spot == len(union)] = 0
    known = union[spot] == flat
    smallest = int(n.min())
    for k in range(len(names)):
        a, b, size = where[k], where[k + 1], int(sizes[k])
        hits = spot[a:b][known[a:b]]
        # No member shares more than the union does, nor is a member smaller than the smallest.
        if 100 * len(hits) < percent * max(size, size + smallest - len(hits)):
            continue
        inside = np.zeros(len(union), bool)
        inside[hits] = True
        common = np.bincount(owner[inside[place]], minlength=len(ids))
        alike = (100 * common >= percent * (n + size - common)) & (common > 0) & (ids != names[k])
        other = ids[alike]
        out.append((np.minimum(other, names[k]), np.maximum(other, names[k])))
    pairs = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2
    return pa.record_batch([pa.array(c) for c in pairs], names=["a", "b"])


def _asks(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """``id, grp``: groups that share a rare shingle with a document outside the shingle's largest
    component, and whose sizes allow a match."""
    tokens = sets.select("id", "n", F.explode("rare").alias("code"))
    rows = saved(tokens.join(placed, "id"))
    # How often a shingle lies in each component, then which component has most of it.
    held = rows.groupBy("code", "component").agg(F.count("*").alias("docs"))
    most = held.groupBy("code").agg(
        F.max(F.struct("docs", "component")).alias("most"), F.count("*").alias("kinds")
    )
    several = own_side(most.filter("kinds > 1").select("code", F.col("most.component").alias("main")))
    mixed = saved(rows.join(several, "code"))
    sizes = F.min("n").alias("low"), F.max("n").alias("high")
    matrix = mixed.groupBy("code", "grp", "only").agg(*sizes)
    outside = mixed.filter("component != main")
    # Documents that ask lie in groups as well: groups are paired first, then each asks for its documents.
    asking = outside.groupBy("code", "grp", "only").agg(*sizes)
    asking = asking.select("code", *[F.col(c).alias(f"a_{c}") for c in ("grp", "only", "low", "high")])
    pairs = asking.join(own_side(matrix), "code").filter(
        (F.col("only").isNull() | F.col("a_only").isNull() | (F.col("only") != F.col("a_only")))
        & (100 * F.col("high") >= percent * F.col("a_low"))
        & (percent * F.col("low") <= 100 * F.col("a_high"))
    )
    asks = outside.select("id", F.col("grp").alias("a_grp")).distinct()
    return saved(pairs.select("a_grp", "grp").distinct().join(asks, "a_grp").select("id", "grp"))


def group_join(
    docs: DataFrame, width: int = 5, percent: int = PERCENT, members: int = MEMBERS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    Two texts are linked when their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent``/100 or more; a component is named by its smallest ``doc_id``. No link between different
    sets is missed; equal sets are one set to the join, however many there are. A text with fewer words
    is one shingle; a null or empty text, or one of blanks only, has none and stands alone. A row without
    ``doc_id`` stands alone too, with a null component. Repeated ids are one document for linking and
    give one row each; other columns are ignored. An empty table gives no rows.
    """
    known = known_sets(docs, width, percent)
    let_go(docs.sparkSession)
    key = ["n_shingles", "key_a", "key_b"]
    one = F.min(F.struct("doc_id", "codes", "rare", "marks")).alias("one")
    sets = known.filter("codes is not null").groupBy(*key).agg(one)
    sets = written(
        sets.select(
            F.monotonically_increasing_id().alias("id"), *key, F.col("n_shingles").alias("n"),
            "one.codes", "one.rare", "one.marks",
        ),
        "distinct-sets",
    )
    let_go(docs.sparkSession)
    links = saved(_runs_linked(sets, percent, members).union(_hub_links(sets, percent)).distinct())
    let_go(docs.sparkSession)
    placed = _grouped(sets, components(links), members)
    opened = _open(_asks(sets, placed, percent), sets, placed, percent)
    # Sets of one id are linked.
    passed = known.filter("passed").select("doc_id", *key).distinct()
    own = saved(passed.join(own_side(sets.select("id", *key)), key).select("doc_id", "id"))
    least = own.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    several = own.join(least.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b"))
    whole = components(links.union(opened).union(several))
    of = own.join(own_side(whole), "id", "left").select("doc_id", F.coalesce("component", "id").alias("component"))
    of = saved(of.distinct())
    names = own_side(of.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    named = of.join(names, "component").select("doc_id", "component_id").distinct()
    rows = known.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    alone = _sizes(docs, width).withColumn("component_id", F.lit(None).cast("long"))
    return rows.unionByName(alone)


def op13_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by their four-word shingles."""
    return group_join(table(ready(spark), sf_dir, "documents"), width=4)
