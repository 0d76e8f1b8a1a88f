"""BPE, token files and packing against the libraries they must agree with."""

import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paytally.llm import bpe, frame_of_reference, packing, queries, token_files
from paytally.llm.perfect_hash import PerfectHash
from paytally.llm.tokenizer import LibraryEncoder, definition, library_encoder
from paytally.llm.vocab import read_ranks

SF = "/root/testdata/sf0.001"
RANKS = public.path("byte_bpe_multi_50k.tiktoken")
MIXED = st.text(alphabet=" \n\t\r\x1c\x85\xa0 a'stÉß1٣²漢字😀#*_-́<|>", max_size=60)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Bpe(read_ranks(RANKS), public.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(read_ranks(RANKS))}
    return tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def whole(name):
    tokenizer = Tokenizer.from_file(public.path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_perfect_hash_is_minimal_and_rejects_others(encoder):
    keys = encoder.tokens
    assert (encoder.whole.find(keys) == np.arange(len(keys))).all()
    assert sorted(encoder.whole.owner) == list(range(len(keys)))
    assert (encoder.whole.find([b"", b"no such token at all"]) == -1).all()
    small = PerfectHash([b"a"])
    assert small.find([b"a", b"b"]).tolist() == [0, -1]
    assert PerfectHash([]).find([b"a"]).tolist() == [-1]
    with pytest.raises(ValueError):
        PerfectHash([b"a", b"a"])


def test_bpe_equals_the_library(encoder, library, texts, odd):
    every = [*texts, *(t or "" for _, t in odd), "'S 's <|endoftext|> a\n\n\n  b  "]
    for text, ids in zip(every, encoder.encode(every), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids.tolist()) == text.encode()


@settings(max_examples=200, deadline=None)
@given(MIXED)
def test_bpe_equals_the_library_on_mixed_text(encoder, library, text):
    (ids,) = encoder.encode([text])
    assert ids.tolist() == library.encode_ordinary(text)


def test_bpe_frames(docs, odd, library):
    frame = docs(*odd)
    encoded = bpe.encode(frame, RANKS, public.PATTERN)
    assert encoded.columns == ["doc_id", "text", "n_words", "score", "fp", "ids"]
    back = bpe.decode(encoded, RANKS, public.PATTERN).collect()
    assert len(back) == len(odd)
    for row in back:
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.digests(docs(*odd).limit(0), RANKS, public.PATTERN).collect() == []


def test_op2(spark, library, texts):
    rows = {r.doc_id: r for r in queries.op2_bpe(spark, SF).collect()}
    assert len(rows) == len(texts)
    for doc_id, text in enumerate(texts):
        ids = np.array(library.encode_ordinary(text), "<u4")
        row = rows[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_whole_texts(name, texts, odd):
    own, library = LibraryEncoder(definition(public.path(name))), whole(name)
    every = [*texts, *(t or "" for _, t in odd if len(t or "") < 60_000), "a\t \n b <|endoftext|>"]
    for text, ids in zip(every, own.encode(every), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(MIXED)
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_on_mixed_text(name, text):
    if name not in CACHE:
        CACHE[name] = LibraryEncoder(definition(public.path(name))), whole(name)
    own, library = CACHE[name]
    (ids,) = own.encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_operators_take_the_librarys_own_way_with_special_tokens(name, texts):
    own, library = library_encoder(definition(public.path(name))), Tokenizer.from_file(public.path(name))
    tokens = [t.content for t in library.get_added_tokens_decoder().values()]
    assert tokens
    some = [f"end {t} next{t}{t.upper()} a" for t in tokens] + [f"{tokens[0]}\n b", "", texts[0]]
    for text, ids in zip(some, own.encode(some), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


CACHE = {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=2000), st.integers(0, 2000), st.integers(0, 900))
def test_blocks_round_trip(values, start, count):
    ids = np.array(values, np.uint32)
    counts = [len(ids)] if len(ids) else []
    data = frame_of_reference.file_bytes(ids, [7] * len(counts), counts)
    file = frame_of_reference.TokenFile(io.BytesIO(data))
    assert (file.ids(0, len(ids)) == ids).all()
    start = min(start, len(ids))
    count = min(count, len(ids) - start)
    assert (file.ids(start, count) == ids[start : start + count]).all()
    assert file.docs["doc_id"].tolist() == [7] * len(counts)


def test_outliers_are_patched_not_widening_the_block():
    ids = np.arange(512, dtype=np.uint32) % 16
    ids[::64] = 40_000
    (block,) = frame_of_reference.encode_blocks(ids)
    assert len(block) == 8 + 512 * 4 // 8 + 8 * 6
    with pytest.raises(ValueError):
        frame_of_reference.TokenFile(io.BytesIO(b"x" * 100))


def expected_tokens(rows, name, end):
    library = whole(name)
    for doc_id, text in rows:
        yield doc_id, np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@given(st.text(alphabet=" \n\t.,a'sZÉ1²漢\x1c\xa0\u0301-", max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_cut_at_full_stops_have_the_ids_of_the_text(text):
    path = public.path("word_bpe_49k.json")
    found = [ids.tolist() for ids in library_encoder(definition(path)).encode([text])]
    assert found == [Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids]


def test_token_files_of_odd_rows(spark, docs, odd, tmp_path):
    path = public.path("word_bpe_49k.json")
    files = token_files.write(docs(*odd), f"file://{tmp_path}/t", path, 1, ids_per_file=30)
    assert files.count() > 3
    found = sorted(
        (r.start, r.doc_id, r.n_tokens, r.ids_crc32)
        for r in token_files.digests(files).collect()
    )
    ordered = sorted(odd, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for doc_id, ids in expected_tokens(ordered, "word_bpe_49k.json", 1):
        want.append((start, doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == want
    none = token_files.write(docs(*odd).limit(0), f"file://{tmp_path}/e", path, 1)
    assert none.collect() == [] and token_files.digests(none).collect() == []


def test_token_files_of_one_id_are_spread(spark, tmp_path, monkeypatch):
    path = public.path("word_bpe_49k.json")
    rows = [(None, "the same words")] * 300 + [(7, f"words {i % 50}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(token_files, "partitions", lambda df, size: 16)
    files = token_files.write(frame, f"file://{tmp_path}/t", path, 1)
    parts = files.orderBy("start").collect()
    assert len(parts) >= 8  # no task holds all rows of an id, nor all equal ones
    assert max(r.ids for r in parts) < sum(r.ids for r in parts) / 4
    assert [r.start for r in parts] == list(np.cumsum([0] + [r.ids for r in parts])[:-1])
    found = sorted(token_files.digests(files).collect(), key=lambda r: r.start)
    ids = [len(ids) for _, ids in expected_tokens(rows, "word_bpe_49k.json", 1)]
    assert [r.doc_id for r in found] == [None] * 300 + [7] * 300
    assert sorted(r.n_tokens for r in found) == sorted(ids)
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found])[:-1])
    hashed = [r.ids_crc32 for r in found if r.doc_id == 7]
    assert len([1 for a, b in zip(hashed, hashed[1:], strict=False) if a != b]) == 49


def test_op4(spark, texts):
    found = sorted(queries.op4_token_files(spark, SF).collect(), key=lambda r: r.doc_id)
    start = 0
    for row, (doc_id, ids) in zip(
        found, expected_tokens(enumerate(texts), "word_bpe_49k.json", 1), strict=True
    ):
        crc = zlib.crc32(ids.tobytes())
        assert tuple(row) == (doc_id, start, len(ids), crc)
        start += len(ids)


def check_packing(rows, want, size):
    placed = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert placed == Counter(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def cut_pieces(documents, size):
    for doc_id, ids in documents:
        begin, stop, k = 0, len(ids) % size or min(size, len(ids)), 0
        while begin < len(ids):
            yield doc_id, k, begin, stop - begin, zlib.crc32(ids[begin:stop].tobytes())
            begin, stop, k = stop, stop + size, k + 1


def test_op5(spark, texts):
    rows = queries.op5_packing(spark, SF).collect()
    want = list(cut_pieces(expected_tokens(enumerate(texts), "byte_bpe_50k.json", 0), 2048))
    used = check_packing(rows, want, 2048)
    assert used <= 1.01 * -(-sum(w[3] for w in want) // 2048) + 1


def test_packing_of_odd_rows_in_many_groups(spark, docs, odd):
    path = public.path("byte_bpe_50k.json")
    pieces = packing.cut(docs(*odd), path, 64, 0)
    want = list(cut_pieces(expected_tokens(odd, "byte_bpe_50k.json", 0), 64))
    check_packing(packing.pack(pieces, 64, group=3).collect(), want, 64)
    assert packing.pack_documents(docs(*odd).limit(0), path, 64, 0).collect() == []


@pytest.mark.parametrize("doc_id", ["id", "CAST(NULL AS LONG)"])
def test_pieces_that_fit_with_no_other_have_sequences_of_their_own(spark, doc_id):
    # Dealt at random, some groups have more than three pieces, and so more sequences.
    same = "0 AS piece, 0L AS start, 40L AS length, 7L AS ids_crc32"
    pieces = spark.range(300).selectExpr(f"{doc_id} AS doc_id", *same.split(", "))
    rows = packing.pack(pieces, 64, group=3).collect()
    want = [(r.doc_id, 0, 0, 40, 7) for r in pieces.collect()]
    assert check_packing(rows, want, 64) == 300


def test_equal_pieces_are_dealt_apart_and_ids_stay_exact(spark, monkeypatch):
    written = []

    def kept(frame, purpose):
        written.append((purpose, materialised(frame, purpose)))
        return written[-1][1]

    materialised = packing.materialised
    monkeypatch.setattr(packing, "materialised", kept)
    ids = spark.sql("SELECT CAST(NULL AS LONG) AS doc_id FROM range(1000) UNION ALL SELECT 9007199254740993L")
    same = "0 AS piece, 0L AS start, 40L AS length, 7L AS ids_crc32"
    rows = packing.pack(ids.selectExpr("doc_id", *same.split(", ")), 64, group=50).collect()
    assert Counter(r.doc_id for r in rows) == {None: 1000, 2**53 + 1: 1}
    first = next(frame for purpose, frame in written if purpose == "packed")
    sizes = [r["count"] for r in first.groupBy("key").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_local_search_places_each_piece_once(lengths):
    before = packing.best_fit(lengths, 100)
    filled = sum(sum(lengths[i] for i in b) ** 2 for b in before)
    after = packing.local_search([list(b) for b in before], lengths, 100)
    assert sorted(i for b in after for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in after)
    assert len(after) <= len(before)
    assert sum(sum(lengths[i] for i in b) ** 2 for b in after) >= filled


def test_exchanges_empty_a_bin():
    # Two for one: 60 leaves the first bin for 40 + 30 of the last; then all fit in two.
    lengths = [60, 30, 50, 20, 40]
    bins = packing.local_search([[0, 1], [2, 3], [4]], lengths, 100)
    assert len(bins) == 2


@pytest.mark.parametrize("low, high, most", [(400, 900, 1303), (300, 1200, 1460), (500, 1000, 1560)])
def test_exchanges_save_sequences(low, high, most):
    """Where three pieces or so fill a sequence, best fit alone leaves much to gain."""
    lengths = np.random.default_rng(3).integers(low, high + 1, 4000).tolist()
    before = packing.best_fit(lengths, 2048)
    after = packing.local_search(before, lengths, 2048)
    assert sorted(i for b in after for i in b) == list(range(4000))
    assert max(sum(lengths[i] for i in b) for b in after) <= 2048
    assert len(after) <= most < len(before)


def test_search_of_many_equal_and_tiny_pieces():
    rng = np.random.default_rng(4)
    for lengths in ([1] * 4096, [683] * 4096, rng.integers(1, 40, 4096).tolist(),
                    [*rng.integers(1, 30, 2000).tolist(), *[1100] * 2096]):
        after = packing.local_search(packing.best_fit(lengths, 2048), lengths, 2048)
        assert sorted(i for b in after for i in b) == list(range(4096))
        assert max(sum(lengths[i] for i in b) for b in after) <= 2048


def test_a_group_is_searched_through_spark(spark):
    lengths = np.random.default_rng(3).integers(400, 901, 4000).tolist()
    rows = [(k, 0, 0, length, k) for k, length in enumerate(lengths)]
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long"
    found = packing.pack(spark.createDataFrame(rows, ddl), 2048).collect()
    assert check_packing(found, rows, 2048) <= 1303
