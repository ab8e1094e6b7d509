"""Fuzzy line deduplication by MinHash.

Lines that are equal are one line to begin with. A line is the set of its character shingles; minwise
signatures are cut into bands. Which bands several lines share is found by buckets of packed band values, so
only lines with a candidate become rows. Candidates are compared on their sketches first, then, once
however many bands they share, on their exact sets; the links are joined into components by distributed
union-find. The first line of a component stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import let_go, partitions, ready, saved, table, text_pieces, texts, written
from linkloom.llm.components import components
from linkloom.llm.nodes import bundles, clusters, groups, star_links
from linkloom.llm.words import mixed, sketches
from linkloom.session import own_side

SHINGLE = 5  # characters
BANDS = 10
ROWS = 4  # minwise values of a band: a pair at 0.8 shares one of the bands with chance 0.995
LIMIT = 1024  # lines compared exhaustively at once
PIECE = 1 << 17  # text bytes worked on at once: their arrays stay in a core's cache
BLOCK = 60_000  # lines that send their bands at once
BUCKET = 1 << 21  # band values of a bucket, on average
PAIRS = 1 << 16  # pairs of sketches compared at once
PACK = 8 << 20  # text bytes packed at once
_U = np.uint64
_STEP = np.random.default_rng(41).integers(1, 2**63, 64, dtype=np.int64).astype(_U) | _U(1)


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with A-Z in lower case, and the offsets of the texts among them."""
    letters = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = letters + ((letters >= 65) & (letters <= 90)) * np.uint32(32)
    # A character has one byte that continues none.
    return letters, offsets - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), offsets)


def _lines(letters: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all lines, their text and their number in it; a text has one at least."""
    at = np.flatnonzero(letters == 10)
    owner = np.searchsorted(offsets, at, side="right") - 1
    count = np.bincount(owner, minlength=len(offsets) - 1) + 1
    firsts = np.r_[0, np.cumsum(count)]
    starts = np.zeros(firsts[-1], np.int64)
    starts[firsts[:-1]] = offsets[:-1]
    inner = np.ones(len(starts), bool)
    inner[firsts[:-1]] = False
    starts[inner] = at + 1
    ends = np.r_[starts[1:] - 1, 0]
    ends[firsts[1:] - 1] = offsets[1:]
    texts_of = np.repeat(np.arange(len(count)), count)
    return starts, ends, texts_of, np.arange(len(starts)) - firsts[:-1][texts_of]


def line_sets(
    letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each line in order, with repeats, and their offsets; a shorter line is one shingle.

    Lines follow each other without overlap. A code of twice the width is made of two neighbours, one of
    any other width of two that overlap.
    """
    sizes = ends - starts
    counts = np.where(sizes >= width, sizes - width + 1, (sizes > 0).astype(np.int64))
    offsets = np.r_[0, np.cumsum(counts)]
    if len(letters) == 0:
        return np.zeros(0, _U), offsets
    padded = np.zeros(len(letters) + width, _U)
    padded[: len(letters)] = letters
    padded += _U(1)
    longer = np.empty_like(padded)
    reach, step = 1, 0
    while reach < width:
        on = min(reach, width - reach)
        np.multiply(padded, _STEP[step], out=longer)
        longer[:-on] += padded[on:]
        padded, longer = longer, padded
        reach, step = reach + on, step + 1
    runs = mixed(padded[: len(letters)])
    chosen = np.zeros(len(letters) + 1, np.int8)
    long = sizes >= width
    np.add.at(chosen, starts[long], 1)
    np.add.at(chosen, ends[long] - width + 1, -1)
    short = np.flatnonzero((sizes > 0) & ~long)
    chosen = np.cumsum(chosen[:-1], dtype=np.int8).astype(bool)
    chosen[starts[short]] = True
    flat = runs[chosen]
    for i in short:
        own = letters[starts[i] : ends[i]].astype(_U) + _U(1)
        flat[offsets[i]] = mixed(np.array([(own * _STEP[20 : 20 + len(own)]).sum() + _U(len(own))], _U))[0]
    return flat, offsets


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, row, line_no, key_a, key_b, bands, sketch`` of every line that has more than blanks.

    ``row`` tells texts of one id apart. The keys identify the line's characters, letters A-Z in lower
    case. ``sketch`` holds four bits of each minwise value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_pieces(batches, most=PIECE):
            letters, where = _letters(data, offsets)
            starts, ends, owner, number = _lines(letters, where)
            # Characters 9 to 13 and 32 are blank.
            blanks = np.flatnonzero((letters == 32) | (letters - np.uint32(9) <= 4))
            full = np.searchsorted(blanks, ends) - np.searchsorted(blanks, starts) < ends - starts
            starts, ends, owner, number = starts[full], ends[full], owner[full], number[full]
            flat, at = line_sets(letters, starts, ends)
            if len(starts) == 0:
                continue
            # A shingle's place takes part, so the keys tell apart lines with equal sets.
            steps = np.arange(len(flat), dtype=_U) * _STEP[8]
            steps -= np.repeat(steps[at[:-1]], np.diff(at))
            codes = mixed(flat + steps)
            key_a = np.add.reduceat(codes, at[:-1])
            key_b = np.add.reduceat(codes ^ (codes >> _U(32)), at[:-1]) * _STEP[9]
            values = sketches(flat, at, BANDS * ROWS)
            marks = values.astype(_U).reshape(-1, BANDS, ROWS)
            bands = mixed((marks * _STEP[10 : 10 + ROWS]).sum(axis=2, dtype=_U)).astype(np.uint32)
            few = (values & np.uint32(15)).astype(np.uint8)
            few = few[:, ::2] | (few[:, 1::2] << np.uint8(4))
            yield pa.record_batch(
                [
                    part.column("doc_id").take(pa.array(owner)),
                    part.column("row").take(pa.array(owner)),
                    pa.array(number.astype(np.int32)),
                    pa.array(key_a.view(np.int64)),
                    pa.array(key_b.view(np.int64)),
                    pa.array([b.tobytes() for b in bands], pa.binary()),
                    pa.array([f.tobytes() for f in few], pa.binary()),
                ],
                names=["doc_id", "row", "line_no", "key_a", "key_b", "bands", "sketch"],
            )

    schema = "doc_id long, row long, line_no int, key_a long, key_b long, bands binary, sketch binary"
    return _rows(docs).mapInArrow(run, schema)


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text`` of the rows with an id; ``row`` is a hash of the text."""
    named = texts(docs.filter("doc_id is not null"))
    return named.select("doc_id", F.xxhash64("text").alias("row"), "text")


def _asked(firsts: DataFrame, buckets: int) -> DataFrame:
    """Band values of blocks of lines, packed by bucket: ``bucket, low, owners, base, several``.

    A value that several lines of a block have is sent once, without them; they are in a row with
    ``several``, which says that the value is shared as it is. So however common a band is, a bucket gets
    it once from each block.
    """

    def block(lids: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
        bands = np.frombuffer(b"".join(blobs), np.uint32).reshape(-1, BANDS).astype(_U)
        codes = mixed(bands + (np.arange(BANDS, dtype=_U) << _U(32))).ravel()
        owner = np.repeat(np.arange(len(lids)), BANDS)
        order = np.argsort(codes)
        codes, owner = codes[order], owner[order]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        times = np.diff(np.r_[first, len(codes)])
        place = ((codes >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
        again = np.repeat(times > 1, times)
        path = (codes & _U(0xFFFFFFFF)) | (place.astype(_U) << _U(32))
        rows = [(TaskContext.get().partitionId() % buckets, path[again].tobytes(), lids[owner[again]].tobytes(), 0, True)]
        codes, place = codes[first], place[first]
        owner = np.where(times > 1, 0xFFFF, owner[first])
        cuts = np.searchsorted(place, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            at = cuts[b] + np.argsort(owner[cuts[b] : cuts[b + 1]], kind="stable")
            steps = np.diff(owner[at], prepend=0).astype(np.uint16)
            rows.append((int(b), codes[at].astype(np.uint32).tobytes(), steps.tobytes(), int(lids[0]), False))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = ["bucket", "low", "owners", "base", "several"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lids, blobs = [], []
        for batch in batches:
            for lid, bands in zip(batch.column("lid").to_pylist(), batch.column("bands").to_pylist()):
                # Lines of a block follow each other, so that a short number names them.
                if lids and (len(lids) == BLOCK or lid != lids[-1] + 1):
                    yield block(np.array(lids), blobs)
                    lids, blobs = [], []
                lids.append(lid)
                blobs.append(bands)
        if lids:
            yield block(np.array(lids), blobs)

    schema = "bucket int, low binary, owners binary, base long, several boolean"
    return firsts.select("lid", "bands").mapInArrow(run, schema)


def _met(firsts: DataFrame, total: int) -> DataFrame:
    """``path, lid`` of lines that share a band with another line; a path names a band value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in groups(batches, "bucket"):
            number = bucket.column("bucket")[0].as_py()
            paths, lids = [], []
            low, owner, base = [], [], []
            for row in bucket.to_pylist():
                if row["several"]:
                    paths.append(np.frombuffer(row["low"], np.int64))
                    lids.append(np.frombuffer(row["owners"], np.int64))
                    continue
                low.append(np.frombuffer(row["low"], np.uint32))
                owner.append(np.cumsum(np.frombuffer(row["owners"], np.uint16), dtype=np.uint16))
                base.append(np.full(len(low[-1]), row["base"]))
            if low:
                values, own, start = np.concatenate(low), np.concatenate(owner), np.concatenate(base)
                _, at, times = np.unique(values, return_inverse=True, return_counts=True)
                shared = times > 1
                shared[at[own == 0xFFFF]] = True
                hit = shared[at] & (own != 0xFFFF)
                paths.append(values[hit].astype(np.int64) | (number << 32))
                lids.append(start[hit] + own[hit])
            out = pa.table({"path": np.concatenate(paths), "lid": np.concatenate(lids)})
            yield from out.to_batches(max_chunksize=1 << 16)

    buckets = max(1, -(-total * BANDS // BUCKET))
    dealt = _asked(firsts, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "path long, lid long")


def _sized(rows: DataFrame, limit: int) -> DataFrame:
    """``rows(path, lid)`` in groups of at most ``limit``: larger ones as pairs of blocks."""
    sizes = own_side(rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"))
    met = saved(rows.join(sizes, "path"))
    small = met.filter(F.col("n") <= limit).select("path", "lid")
    return small.unionByName(_blocks(met.filter(F.col("n") > limit), limit))


def _blocks(large: DataFrame, limit: int) -> DataFrame:
    """Groups above the limit as all pairs of blocks of half the limit, so no pair is left out."""
    half = limit // 2
    count = F.ceil(F.col("n") / half).cast("int")
    dealt = large.withColumn("count", count).withColumn("at", F.pmod(F.xxhash64("lid"), F.col("count")))
    other = F.explode(F.sequence(F.lit(0), F.col("count") - 1))
    paired = dealt.withColumn("other", other).filter("count = 1 or at != other")
    block = F.xxhash64("path", F.least("at", "other"), F.greatest("at", "other"))
    return paired.select(block.alias("path"), "lid")


def _near(some: np.ndarray, all_: np.ndarray, most: int) -> np.ndarray:
    """Which rows of packed four-bit values differ from which others of their group in ``most`` at the most."""
    apart = np.zeros((len(some), some.shape[1], all_.shape[1]), np.uint8)
    for k in range(some.shape[2]):
        x = some[:, :, None, k] ^ all_[:, None, :, k]
        x |= x >> _U(2)
        x |= x >> _U(1)
        apart += np.bitwise_count(x & _U(0x1111111111111111))
    return apart <= most


def _likely(met: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """``path, lid`` of lines whose sketch agrees with another of the group almost as asked.

    Lines of a group that hang together by such pairs are a group of their own, named by its members, so
    lines that meet in several bands are one candidate.
    """
    size = BANDS * ROWS
    # Four standard deviations of the share of equal four-bit values of a pair at the threshold.
    p = percent / 100 + (1 - percent / 100) / 16
    least = int(size * (p - 4 * (p * (1 - p) / size) ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in bundles(batches, "path", 4096):
            few = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, size // 2)
            marks = np.pad(few, ((0, 0), (0, -few.shape[1] % 8))).view(_U)
            lids = part.column("lid").to_numpy()
            names = mixed(lids.astype(_U) + _U(1))
            label = np.arange(len(lids))
            many = np.diff(cuts)
            for n in np.unique(many[many > 1]):
                starts = cuts[:-1][many == n]
                for at in np.array_split(starts, -(-len(starts) * n * n // PAIRS)):
                    spot = at[:, None] + np.arange(n)
                    own = marks[spot]
                    near = np.concatenate([_near(own[:, i : i + 64], own, size - least) for i in range(0, n, 64)], axis=1)
                    label[spot] = at[:, None] + clusters(near)
            sums = np.zeros(len(lids), _U)
            np.add.at(sums, label, names)
            keep = np.bincount(label, minlength=len(lids))[label] > 1
            yield pa.record_batch([pa.array(sums[label[keep]].view(np.int64)), pa.array(lids[keep])], names=["path", "lid"])

    rows = met.join(firsts.select("lid", "sketch"), "lid").select("path", "lid", "sketch")
    dealt = rows.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(run, "path long, lid long").distinct()


def _packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Texts of many documents packed by bucket: ``bucket, head, texts``.

    ``head`` holds their ids, their ``row`` and their sizes. Equal rows of one id are one text.
    """

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        keys = np.stack([table.column(c).to_numpy() for c in ("row", "doc_id", "bucket")])
        order = np.lexsort(keys)
        new = np.r_[True, (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)]
        table = table.take(pa.array(order[new])).combine_chunks()
        rows = []
        for part, data, offsets in text_pieces(iter(table.to_batches()), most=1 << 62):
            row, doc, bucket = (part.column(c).to_numpy().astype(np.int64) for c in ("row", "doc_id", "bucket"))
            cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                head = np.stack([doc[a:b], row[a:b], np.diff(offsets[a : b + 1])])
                texts = pa.compress(data[offsets[a] : offsets[b]].tobytes(), codec="zstd", asbytes=True)
                rows.append((int(bucket[a]), head.tobytes(), texts))
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["bucket", "head", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= PACK:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    rows = _rows(docs).select(_bucket(buckets), "doc_id", "row", "text")
    return rows.mapInArrow(run, "bucket int, head binary, texts binary")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "row"), F.lit(buckets)).cast("int").alias("bucket")


def _places(asked: list[pa.RecordBatch]) -> dict:
    """``(line_no, lid, path)`` of the lines asked of each text, by id and ``row``."""
    places: dict[tuple, list] = {}
    for batch in asked:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "row", "line_no", "lid", "path"))
        for doc, row, *place in zip(*columns):
            places.setdefault((doc, row), []).append(place)
    return places


def _cut_lines(head: bytes, texts: bytes, places: dict) -> Iterator[pa.RecordBatch]:
    """``path, lid, text`` of the lines asked of packed texts."""

    def out() -> pa.RecordBatch:
        rows = [pa.array(paths, pa.int64()), pa.array(lids, pa.int64()), pa.array(lines, pa.binary()).view(pa.string())]
        return pa.record_batch(rows, names=["path", "lid", "text"])

    ids, rows, sizes = np.frombuffer(head, np.int64).reshape(3, -1).tolist()
    whole = pa.decompress(texts, sum(sizes), codec="zstd", asbytes=True)
    paths, lids, lines, held, begin = [], [], [], 0, 0
    for doc, row, size in zip(ids, rows, sizes):
        # Taken out, so that equal rows of one id give their lines once.
        asked = places.pop((doc, row), None)
        own = whole[begin : begin + size].split(b"\n") if asked else []
        begin += size
        for number, lid, path in asked or ():
            paths.append(path)
            lids.append(lid)
            lines.append(own[number])
            held += len(own[number])
            if held >= PACK:
                yield out()
                paths, lids, lines, held = [], [], [], 0
    if lids:
        yield out()


def _line_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``path, lid, text`` of the lines ``wanted(path, lid, doc_id, row, line_no)``, each document cut once.

    Documents are dealt packed to the places asked of them; from there only lines go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, places = None, [], None
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            packed = batch.column("head").is_valid().to_numpy(zero_copy_only=False)
            new = (bucket[1:] != bucket[:-1]) | (packed[1:] != packed[:-1])
            cuts = np.r_[0, np.flatnonzero(new) + 1, len(bucket)] if len(bucket) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if bucket[a] != at:
                    at, asked, places = bucket[a], [], None
                part = batch.slice(a, b - a)
                if not packed[a]:
                    asked.append(part)
                    continue
                places = _places(asked) if places is None else places
                for head, texts in zip(part.column("head"), part.column("texts")):
                    yield from _cut_lines(head.as_py(), texts.as_py(), places)

    buckets = 4 * partitions(docs.sparkSession)
    lists = wanted.select(_bucket(buckets), "path", "lid", "doc_id", "row", "line_no")
    rows = lists.unionByName(_packed(docs, buckets), allowMissingColumns=True)
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", F.isnotnull("head"))
    return dealt.mapInArrow(run, "path long, lid long, text string")


def _ordered(owner: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The order of ``flat`` by owner and value.

    Owner and leading bits make one number, which sorts much faster; should values of an owner differ
    behind those bits only, it is done again with all.
    """
    if len(flat) == 0:
        return np.zeros(0, np.int64)
    bits = int(owner.max()).bit_length()
    leading = (owner.astype(_U) << _U(64 - bits) if bits else _U(0)) | (flat >> _U(bits))
    order = np.argsort(leading)
    leading, values = leading[order], flat[order]
    if ((leading[1:] == leading[:-1]) & (values[1:] != values[:-1])).any():
        return np.lexsort((flat, owner))
    return order


def _distinct(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each list, sorted, and how many they are."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flat = flat[_ordered(owner, flat)]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    return flat[new], np.bincount(owner[new], minlength=len(offsets) - 1)


def _pairs_alike(flat: np.ndarray, offsets: np.ndarray, pairs: np.ndarray, percent: int) -> np.ndarray:
    """``pair_alike`` of the sets numbered ``pairs`` and the ones after them, all at once."""
    sizes = np.diff(offsets)
    number = np.full(len(sizes), -1)
    number[pairs] = number[pairs + 1] = np.arange(len(pairs))
    owner = np.repeat(number, sizes)
    flat, owner = flat[owner >= 0], owner[owner >= 0]
    order = _ordered(owner, flat)
    flat, owner = flat[order], owner[order]
    both = owner[1:][(flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])]
    common = np.bincount(both, minlength=len(pairs))
    return (common > 0) & (100 * common >= percent * (sizes[pairs] + sizes[pairs + 1] - common))


def _confirmed(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of lines in one group by their exact shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in bundles(batches, "path"):
            part = part.combine_chunks()
            flats, sizes = [], []
            for _, data, offsets in text_pieces(iter(part.to_batches()), most=PIECE):
                letters, where = _letters(data, offsets)
                own, size = _distinct(*line_sets(letters, where[:-1], where[1:]))
                flats.append(own)
                sizes.append(size)
            flat, where = np.concatenate(flats), np.r_[0, np.cumsum(np.concatenate(sizes))]
            ids = part.column("lid").to_numpy()
            pairs = cuts[:-1][np.diff(cuts) == 2]
            pairs = pairs[_pairs_alike(flat, where, pairs, percent)]
            found = [(ids[pairs + 1], ids[pairs])]
            found += [
                star_links(ids[a:b], flat[where[a] : where[b]], where[a : b + 1] - where[a], percent)
                for a, b in zip(cuts[:-1], cuts[1:])
                if b - a > 2
            ]
            yield pa.record_batch(
                [pa.array(np.concatenate(c)) for c in zip(*found)], names=["a", "b"]
            )

    dealt = rows.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(run, "a long, b long")


def repeated_lines(docs: DataFrame, percent: int = 80, limit: int = LIMIT) -> DataFrame:
    """``doc_id, line_no, first_doc_id, first_line_no, row`` of every line that repeats an earlier one.

    Lines are numbered from 0 within ``docs(doc_id, text)`` and end at line feeds. Two are alike when
    their sets of five-character shingles (A-Z in lower case; a shorter line is one shingle) have a
    Jaccard similarity of ``percent``/100 or more; the first of a component, by ``doc_id``, number and
    ``row``, stays. ``row`` is a hash of the text: texts of one id are told apart by it, and rows with the
    same id and text are one, none of which repeats the others. Lines of blanks only always stay, as do
    rows with a null text. Rows without ``doc_id`` take no part. Other columns are ignored; an empty
    table gives no rows.
    """
    place = ["doc_id", "line_no", "row"]
    lines = written(signatures(docs), "lines")
    firsts = lines.groupBy("key_a", "key_b").agg(
        F.min(F.struct(*place, "bands", "sketch")).alias("f"), F.count("*").alias("times")
    )
    firsts = written(
        firsts.select("key_a", "key_b", "times", "f.*").withColumn("lid", F.monotonically_increasing_id()),
        "first-lines",
    )
    let_go(docs.sparkSession)
    met = saved(_met(firsts, firsts.count()))
    let_go(docs.sparkSession)
    likely = saved(_likely(_sized(met, limit), firsts, percent))
    let_go(docs.sparkSession)
    wanted = firsts.select(*place, "lid").join(likely, "lid")
    links = saved(_confirmed(_line_texts(wanted, docs), percent))
    let_go(docs.sparkSession)
    whole = own_side(components(links).withColumnRenamed("id", "lid"))
    # Lines that nothing repeats are left out before the last join.
    members = firsts.select("lid", "key_a", "key_b", "times", F.struct(*place).alias("own")).join(whole, "lid", "left")
    members = members.filter("component is not null or times > 1")
    members = saved(members.withColumn("component", F.coalesce("component", "lid")))
    least = own_side(members.groupBy("component").agg(F.min("own").alias("first")))
    keys = own_side(members.join(least, "component").select("key_a", "key_b", "first"))
    return (
        lines.select(*place, "key_a", "key_b")
        .join(keys, ["key_a", "key_b"])
        .filter(F.struct(*place) != F.col("first"))
        .distinct()
        .select(
            "doc_id",
            "line_no",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.line_no").alias("first_line_no"),
            "row",
        )
    )


def without_lines(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` less the lines ``repeated(doc_id, row, line_no)``, all columns kept.

    A text that loses all its lines goes with its row; texts that lose nothing stay as they are, null
    ones too. Another text under the same id keeps its lines. ``n_chars``, where it is a column, is
    counted anew for texts that change.
    """
    gone = repeated.groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("gone"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("all"),
        docs["doc_id"],
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("row"),
    )
    joined = rows.join(own_side(gone), ["doc_id", "row"], "left").select("all", "gone")
    own = F.col("all.text")
    # A map: every line is looked up at once, however many go.
    went = F.map_from_arrays("gone", F.transform("gone", lambda i: F.lit(True)))
    kept = F.filter(F.split(own, "\n", -1), lambda line, i: ~F.map_contains_key("went", i))
    changed = F.col("gone").isNotNull()
    solid = F.exists("kept", lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    out = joined.withColumn("went", went).withColumn("kept", F.when(changed, kept)).filter(~changed | solid)
    new = {"text": F.array_join("kept", "\n")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return out.select(
        *[
            (F.when(changed, new[c]).otherwise(F.col("all")[c]) if c in new else F.col("all")[c]).alias(c)
            for c in docs.columns
        ]
    )


def op5_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that repeats an earlier line, with that line."""
    return repeated_lines(table(ready(spark), sf_dir, "documents")).drop("row")
