"""Near duplicates, lines, sentences, tokens and packing against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from linkloom.llm import line_dedup, near_dedup, packing, sentence_spans, token_counts
from linkloom.llm.common import ready
from tests.llm import plain

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, id string, path int, score double, n int, row string, gone int, source string"


def frame(spark, docs):
    """Documents with columns whose names clash with those the operators use."""
    rows = [(d, t, "x", 1, 0.5, 2, "r", 3, "s") for d, t in docs]
    return ready(spark).createDataFrame(rows, SCHEMA)


def hard(seed=3):
    """Nulls, blanks, short and long texts, equal and near texts, repeated rows."""
    r = random.Random(seed)
    words = [f"w{i}é" for i in range(300)]
    base = [" ".join(r.choices(words, k=120)) for _ in range(4)]
    docs = [(None, "no id"), (None, None), (0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "A"), (5, "a b")]
    docs += [(6, "one\ntwo\n\none"), (7, "</s> <|endoftext|> <s>"), (8, "x" * 40000), (9, "日本 語\n" * 400)]
    for i in range(10, 70):
        own = r.choice(base).split(" ")
        for _ in range(r.choice([0, 1, 2, 5])):
            own[r.randrange(len(own))] = r.choice(words)
        docs.append((i, "\n".join(" ".join(own[k : k + 12]) + "." for k in range(0, 120, 12))))
    docs += [(70 + i, " ".join(r.choices(words, k=9000))) for i in range(2)]
    return docs + docs[3:8] + docs[20:22]


def read(path):
    import pyarrow.parquet as pq

    t = pq.read_table(path, columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"]))


@pytest.fixture(scope="module")
def given():
    return read("/root/testdata/sf0.01/documents.parquet")


@pytest.mark.parametrize("limit", [1024, 4])
def test_near_duplicates(spark, limit):
    docs = hard()
    out = near_dedup.near_duplicates(frame(spark, docs), width=4, limit=limit, trees=16).collect()
    want = plain.near_duplicates([d for d in docs if d[0] is not None], 4)
    assert len(out) == len(docs)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_documents(spark, given):
    out = near_dedup.op8_minhash_near_dedup(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain.near_duplicates(given, 4)


def test_nodes_that_never_split_are_dealt_into_blocks(spark):
    text = [f"t{i}" for i in range(3000)]
    docs = [(i, " ".join([*text, f"end{i}"])) for i in range(60)]
    out = near_dedup.near_duplicates(frame(spark, docs), limit=8, levels=3).collect()
    assert {r.component_id for r in out} == {0}


def test_nodes_left_after_the_last_level_miss_no_pair(spark):
    """A star of edits, alike to the centre only, which is not the smallest id."""
    text = [f"t{i}" for i in range(1000)]
    docs = [(999, " ".join(text))]
    for i in range(50):
        own = list(text)
        own[i * 16 : i * 16 + 100] = [f"e{i}_{k}" for k in range(100)]
        docs.append((i, " ".join(own)))
    want = plain.near_duplicates(docs, 5)
    assert max(c for _, c in want.values()) == 0
    out = near_dedup.near_duplicates(frame(spark, docs), limit=8, levels=1).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want


def test_pairs_in_deep_nodes_meet(spark):
    """A hot group of sketches, pairs of it equal in 52 of 64 places or a few more."""
    r = np.random.default_rng(7)
    core = r.integers(0, 2**32, near_dedup.SIZE, dtype=np.uint32)
    rows = []
    for i in range(60):
        own = core.copy()
        own[r.choice(near_dedup.SIZE, 6, replace=False)] = r.integers(0, 2**32, 6, dtype=np.uint32)
        rows.append((i, own.tobytes()))
    marks = ready(spark).createDataFrame(rows, "id long, sketch binary")
    found, left = near_dedup.nodes(marks, 80, near_dedup.TREES, 4, near_dedup.LEVELS)
    members = defaultdict(set)
    for level, part in enumerate([*found, *([left] if left is not None else [])]):
        for x in part.collect():
            members[level, x.path].add(x.id)
    met = {(a, b) for own in members.values() for a in own for b in own if a < b}
    assert len(met) >= 0.99 * (60 * 59 / 2)


def test_trees_reach_the_recall_at_every_depth():
    assert near_dedup.recall(8, 10, 80) == pytest.approx(0.995, abs=1e-3)
    assert near_dedup.recall(24, 16, 80) == pytest.approx(0.969, abs=1e-3)
    assert near_dedup.recall(16, near_dedup.TREES, 80) >= near_dedup.RECALL


@pytest.mark.parametrize("limit", [1024, 6])
def test_lines(spark, limit):
    docs = [d for d in hard() if d[0] is not None]
    docs = list(dict(docs).items())
    found = line_dedup.repeated_lines(frame(spark, docs), limit=limit)
    assert {tuple(r)[:4] for r in found.collect()} == plain.repeated_lines(docs)
    left = {r.doc_id: r.text for r in line_dedup.without_lines(frame(spark, docs), found).collect()}
    gone = defaultdict(set)
    for d, n, _, _ in plain.repeated_lines(docs):
        gone[d].add(n)
    for d, text in docs:
        if d not in gone:
            assert left[d] == text
            continue
        kept = [x for i, x in enumerate(text.split("\n")) if i not in gone[d]]
        if any(x.strip(" \t\n\x0b\x0c\r") for x in kept):
            assert left[d] == "\n".join(kept)
        else:
            assert d not in left


def test_lines_of_documents(spark, given):
    out = line_dedup.op5_fuzzy_line_dedup(spark, "/root/testdata/sf0.01").collect()
    assert {tuple(r) for r in out} == plain.repeated_lines(given)


def test_passages_go_and_the_rest_stays(spark):
    r = random.Random(5)
    say = lambda n: " ".join(r.choices([f"v{i}" for i in range(5000)], k=n)).capitalize() + "."
    passage = " ".join(say(13) for _ in range(4))
    docs = [(i, f"{say(9)} {say(12)}\n{passage} {say(20)}\n{say(8)}") for i in range(5)]
    docs += [(10, None), (11, ""), (12, "One. Two."), (13, "One. Two."), (None, passage)]
    found = sentence_spans.repeated_sentences(frame(spark, docs), least=20)
    assert {(x.doc_id, x.sentence_no) for x in found.collect()} == {
        (i, n) for i in range(1, 5) for n in range(2, 6)
    }
    left = {x.doc_id: x.text for x in sentence_spans.without_sentences(frame(spark, docs), found).collect()}
    assert left[0] == docs[0][1] and left[12] == left[13] == "One. Two." and left[10] is None
    for i in range(1, 5):
        assert left[i] == docs[i][1].replace(passage + " ", "")


def test_short_stretches_and_control_characters(spark):
    """Without a least length every covered sentence is reported; no character of a text is lost."""
    odd = "One.\x01 Two. Thr\x01ee!\n\n Four? Five\x00"
    docs = [(1, "A b. C d. E f."), (2, "x y. A b. C d."), (3, odd), (4, odd + " Six."), (5, "\n\n Q r. " + odd)]
    found = sentence_spans.repeated_sentences(frame(spark, docs))
    rows = {(x.doc_id, x.sentence_no): x for x in found.collect()}
    assert {k for k in rows if k[0] < 3} == {(2, 1), (2, 2)}
    assert {(x.first_doc_id, x.first_sentence_no, x.stretch_words) for k, x in rows.items() if k[0] == 2} == {(1, 0, 4), (1, 1, 4)}
    assert {k[0] for k in rows} == {2, 4, 5}
    left = {x.doc_id: x.text for x in sentence_spans.without_sentences(frame(spark, docs), found.filter("doc_id < 4")).collect()}
    assert left[3] == odd and left[2] == "x y. " and left[4] == odd + " Six."
    none = sentence_spans.without_sentences(frame(spark, docs[4:]), found.filter("doc_id = 5 and sentence_no = 0"))
    assert none.first().text == docs[4][1]


def test_token_counts(spark):
    docs = hard()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in token_counts.token_counts(frame(spark, docs), PIECES, limit=100).collect():
        assert r.over_limit == (r.n_tokens > 100)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame(spark, docs), PIECES).collect())
    assert got == sorted((d or -1, len((t or "").encode()), len(library.encode(t or ""))) for d, t in docs)


def test_token_counts_of_odd_texts(given):
    counter = token_counts.Counter(token_counts.load_ranks(PIECES))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t", "é", "日", "▁", "the", "ing", "\x00", "1", "</s>", "\r\n", "😀", "ﬁ", "."]
    odd = ["".join(r.choices(parts, k=r.randrange(40))) for _ in range(3000)] + [t for _, t in given[:200]]
    assert [counter.count(t) for t in odd] == [len(library.encode(t)) for t in odd]


def test_encoder_gives_the_library_ids(given):
    encoder, library = packing.Encoder(BYTES), Tokenizer.from_file(BYTES)
    r = random.Random(2)
    parts = ["a", " ", "\n", "é", "日", "ing", "\x00", "1", "<|endoftext|>", "\r\n", "😀", "   ", ".", "'s"]
    odd = ["".join(r.choices(parts, k=r.randrange(40))) for _ in range(3000)] + [t for _, t in given[:200]]
    for text in odd:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want


def test_packing(spark):
    docs = [d for d in dict(hard()).items()]
    library = Tokenizer.from_file(BYTES)
    rows = packing.packed(frame(spark, docs), BYTES).collect()
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and len(own) == r.length > 0
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for d, own in pieces.items():
        assert [s for s, _ in sorted(own)] == np.r_[0, np.cumsum([n for _, n in sorted(own)])][:-1].tolist()
        assert sum(n for _, n in own) == len(ids[d])
    for own in bins.values():
        sizes = [n for _, n in sorted(own)]
        assert [o for o, _ in sorted(own)] == np.r_[0, np.cumsum(sizes)][:-1].tolist()
        assert sum(sizes) <= packing.CAPACITY
    used = sum(map(len, ids.values()))
    assert len(bins) <= used / packing.CAPACITY * 1.05 + 2


def test_cuts_cover_every_length():
    for length in [*range(1, 2100), 5000, 100_000]:
        own = packing.cuts(length, 2048)
        assert sum(own) == length and all(0 < n <= 2048 for n in own)
        assert len(own) <= length // 2048 + 5


def test_empty_tables(spark):
    docs = frame(spark, [])
    for out in (
        near_dedup.near_duplicates(docs),
        line_dedup.repeated_lines(docs),
        line_dedup.without_lines(docs, line_dedup.repeated_lines(docs)),
        sentence_spans.repeated_sentences(docs),
        token_counts.token_counts(docs, PIECES),
        packing.packed(docs, BYTES),
    ):
        assert out.count() == 0
