"""Token frames, packing and the digest cache against the tokenizer itself."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from editsieve.llm.bpe import PieceEncoder, tokenizer_path
from editsieve.llm.common import scratch_path
from editsieve.llm.packing import best_fit_decreasing, cut_points, lower_bound, pack, packed_documents, pieces
from editsieve.llm.token_cache import cached_counts, read_cache, refresh_cache, token_counts, tokenizer_version
from editsieve.llm.token_frames import FrameReader, read_frames, token_frames, write_frames
from tests.llm.conftest import odd_rows

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t.,'!aBé中3|")), max_size=60))
def test_pieces_equal_whole(text):
    enc = PieceEncoder.of(PATH)
    assert np.frombuffer(enc.ids([text])[0], dtype="<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_generations_of_pieces(plain):
    enc = PieceEncoder(PATH, remembered=5)
    for text in ("one two three four", "five six one two", "seven one, two. three", "one two three four", "<|endoftext|> x"):
        assert np.frombuffer(enc.ids([text])[0], dtype="<u4").tolist() == plain(text)


def test_frames_round_trip(spark, table, plain):
    rows = odd_rows()
    got = [tuple(r) for r in token_frames(spark, table(rows), PATH).orderBy("start").collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc_id, text, *_ in order:
        ids = [*plain(text), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert got == want


def test_frames_single_documents(spark, table):
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(40)]
    manifest = write_frames(table(rows), scratch_path(spark, "frames"), PATH, docs_per_file=8)
    assert manifest.count() > 1
    some = read_frames(manifest, [3, 17, 39]).collect()
    assert sorted(r.doc_id for r in some) == [3, 17, 39]
    path = manifest.first().path
    file = FrameReader(path)
    assert np.frombuffer(file.ids(0), dtype="<u4")[-1] == 2
    with open(path.removeprefix("file://"), "r+b") as f:  # a broken frame is noticed
        f.seek(int(file.starts[1]) + 6)
        f.write(b"\xff\xff")
    with pytest.raises(Exception):
        FrameReader(path).ids(1)


def test_frames_empty(spark, table):
    assert token_frames(spark, table([(1, "x")]).where("doc_id > 5"), PATH).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 24), min_size=1, max_size=9))
def test_bound_holds(lengths):
    """No packing needs fewer bins than the bound, and best fit never overfills."""
    sizes = np.array(lengths)
    bins, offsets, fill = best_fit_decreasing(sizes, 24)
    assert max(fill) <= 24 and sum(fill) == sum(lengths)
    best = [len(lengths)]

    def place(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for k in range(len(room)):
            if room[k] >= lengths[i]:
                place(i + 1, room[:k] + [room[k] - lengths[i]] + room[k + 1:])
        place(i + 1, [*room, 24 - lengths[i]])

    place(0, [])
    assert lower_bound(sizes, 24) <= best[0] <= len(fill)


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
        assert sum(n for _, n in places) <= capacity
    return len(bins)


def test_packing(spark, table, plain):
    rows = odd_rows()
    got = packed_documents(spark, table(rows), PATH).collect()
    check_packing(got, 2048)
    want = []
    for doc_id, text, *_ in rows:
        ids = [*plain(text), 0]
        at = cut_points(len(ids), 2048)
        assert all(b - a == 2048 for a, b in zip(at[1:], [*at[2:], len(ids)]))
        for k, (a, b) in enumerate(zip(at, [*at[1:], len(ids)])):
            want.append((doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert packed_documents(spark, table([(1, "x")]).where("doc_id > 5"), PATH).collect() == []


def test_gaps_are_exchanged(spark, table):
    items = spark.createDataFrame([(i, 0, 0, 3 + i * 7 % 11, i) for i in range(300)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    placed = pack(items, capacity=16, per_part=20, rounds=3).withColumnRenamed("bin", "b").selectExpr("*", "part * 100000 + b AS sequence_id")
    rows = placed.collect()
    assert len(rows) == 300
    alone = pack(items, capacity=16, per_part=20, rounds=0).selectExpr("part * 100000 + bin AS s").distinct().count()
    assert check_packing(rows, 16) <= alone


def test_pieces_of_long_documents(table):
    got = pieces(table([(1, "word " * 9000)]), PATH, capacity=100).collect()
    assert [r.start for r in got] == cut_points(sum(r.length for r in got), 100)


def test_cache(spark, table, plain):
    rows = odd_rows()
    cache = scratch_path(spark, "cache")
    got = token_counts(table(rows), cache, PATH, limit=20).collect()
    want = [(r[0], len((r[1] or "").encode()), len(plain(r[1])), len(plain(r[1])) > 20) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    version = tokenizer_version(PATH)
    stored = read_cache(spark, cache, version).count()
    assert stored == len({r[1] or "" for r in rows})
    refresh_cache(table([*rows, (99, "a new text")]), cache, PATH)
    assert read_cache(spark, cache, version).count() == stored + 1
    assert read_cache(spark, cache, "another version").count() == 0
    assert cached_counts(spark, table(rows).where("doc_id > 1000"), PATH).collect() == []


def test_cache_of_a_model_file(spark, table):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = odd_rows()
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in cached_counts(spark, table(rows), path).collect()}
    assert got == {(r[0], len((r[1] or "").encode())): len(model.encode(r[1] or "")) for r in rows}


def test_cache_appended_twice_gives_one_row_per_document(spark, table):
    rows = odd_rows()
    cache = scratch_path(spark, "cache")
    version = tokenizer_version(PATH)
    first = sorted(map(tuple, token_counts(table(rows), cache, PATH).collect()), key=repr)
    stored = spark.read.parquet(cache)
    stored.write.mode("append").parquet(cache + "-copy")
    spark.read.parquet(cache + "-copy").write.mode("append").parquet(cache)  # every entry stored twice now
    assert spark.read.parquet(cache).count() == 2 * read_cache(spark, cache, version).count()
    again = sorted(map(tuple, token_counts(table(rows), cache, PATH).collect()), key=repr)
    assert again == first and len(again) == len(rows)
