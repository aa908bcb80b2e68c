import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)  # as it is: a special token's string in a text is that token


def plain_best_fit(lengths, capacity):
    """Room left in each sequence, piece by piece."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 50))
def test_steps_are_best_fit_decreasing(lengths, capacity):
    rooms, spans = {}, {}
    counts = Counter(lengths)
    for length, rank, n, each, seq, at in packing.best_fit(counts, capacity):
        for k in range(n):
            spans.setdefault(seq + k // each, []).append((at + k % each * length, length))
            rooms[seq + k // each] = rooms.get(seq + k // each, capacity) - length
    assert sorted(rooms.values()) == plain_best_fit(lengths, capacity)
    assert sorted(x for s in spans.values() for _, x in s) == sorted(lengths)
    for s in spans.values():
        end = 0
        for at, n in sorted(s):
            assert at == end
            end = at + n
        assert end <= capacity


def test_words_one_by_one_give_the_same_ids(spark, tokenizer):
    known = packing.WordIds(PATH)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    odd = "It's THE.END,, don't x&&&y a.!b. É, İstanbul ẖH̱ ﬁ １２3 <|endoftext|> \x1c     é!! 😀.. (x). 'S 're,"
    special = ["one <|endoftext|> two", "a<|endoftext|>,b.<|startoftext|>! <|ENDOFTEXT|>", "x<|endoftext|>\n\t <|endoftext|>."]
    every = [*texts, odd, odd.upper(), *special, "", None]
    raws = [t.encode() if t else t for t in every]
    for t, got in zip(every, known.of(raws)):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want
    assert np.frombuffer(known.of([b"one <|endoftext|> two"])[0], "<u4").tolist() == [637, 49407, 1237]


def test_a_full_memory_drops_its_older_half(monkeypatch):
    whole = packing.WordIds(PATH)
    words = [b" ".join(b"w%dx" % (i * 7 % 400) for i in range(k, k + 30)) for k in range(0, 300, 10)]
    want = whole.of(words)
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    small = packing.WordIds(PATH)
    assert [small.of([w])[0] for w in words] == want
    assert len(small.known) <= 150


def check_packed(rows, docs, tokenizer, capacity):
    by_doc = Counter()
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            by_doc[d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == by_doc
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        end = 0
        for at, n in sorted(s):
            assert at == end
            end = at + n
        assert end <= capacity
    left = sorted(capacity - sum(n for _, n in s) for s in seqs.values())
    assert left == plain_best_fit([r["length"] for r in rows], capacity)


def test_awkward_rows(spark, docs, no_docs, tokenizer):
    parts = packing.pieces(docs, PATH, capacity=64)
    check_packed(packing.pack(parts, 64).collect(), docs.select("doc_id", "text").collect(), tokenizer, 64)
    assert packing.pack(packing.pieces(no_docs, PATH)).count() == 0


def test_whole_table(spark, tokenizer):
    from tidemark.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check_packed(queries.op10_best_fit_packing(spark, sf).collect(), docs, tokenizer, 4096)


def test_ids_come_along(spark, docs):
    for r in packing.pieces(docs, PATH, capacity=50, ids=True).collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_a_word_is_remembered_once_whatever_its_case_and_punctuation():
    known = packing.WordIds(PATH)
    known.of([b"Word, word. WORD; word", "É word,".encode()])
    assert set(known.known) == {b"word", b",", b".", b";", "É".encode()}
    assert packing.REMEMBERED <= 300_000


def test_letters_beyond_ascii_are_parted_from_punctuation_and_pass_the_plain_model(monkeypatch, tokenizer):
    known = packing.WordIds(PATH)
    texts = [b"", "\u00e9lan, \u00c9lan. na\u00efve; word".encode(), None, "\u00e9lan! na\u00efve".encode()]
    want = [np.array(tokenizer.encode((t or b"").decode()).ids, "<u4").tobytes() for t in texts]
    sent, whole = [], known.tokenizer

    class Seen:
        def encode_batch_fast(self, words, **options):
            sent.extend(words)
            return whole.encode_batch_fast(words, **options)

    monkeypatch.setattr(known, "tokenizer", Seen())
    assert known.of(texts) == want
    assert sorted(sent) == ["!", ",", ".", ";"]
    assert sorted(w.decode() for w in known.known) == ["!", ",", ".", ";", "na\u00efve", "word", "\u00c9lan", "\u00e9lan"]


def test_words_used_of_late_stay_in_a_full_memory(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 4)
    known = packing.WordIds(PATH)
    for k in range(6):
        known.of([b"often word%s" % (b"abcdef"[k : k + 1] * 3)])
    assert set(known.known) == {b"often", b"wordddd", b"wordeee", b"wordfff"}


def test_characters_and_edges_of_many_kinds(tokenizer):
    known = packing.WordIds(PATH)
    points = [*range(0x600), *range(0x1E00, 0x2160), *range(0x3000, 0x3100), *range(0xFB00, 0xFB10), 0x1F600]
    texts = [f"{x} a{x} A{x}b, B{x}. {x}, {x}.. \u00e9{x},\u00c9{x}H! 1{x}; <|{x}" for x in map(chr, points)]
    texts += ["a\u0130, b", "3\u00d7. 3\u00f7,", "\u212aelvin", "x\u0301, A\u0301.", "", " \t\r\n\x0b\f", "\x1c", "it's. 'S, don't!"]
    for t, got in zip(texts, known.of([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    for odd in (b"a\xff, b\xc3. \x80,\xe2\x82", b"\xa9, \xc3"):
        want = tokenizer.encode(odd.decode("utf-8", "replace"), add_special_tokens=False).ids
        assert np.frombuffer(known.of([odd])[0], "<u4").tolist() == want
    assert known.of([]) == [] and known.of([None, b" "]) == [b"", b""]


def test_slices_of_a_batch_keep_their_rows(spark, docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 100)
    monkeypatch.setattr(packing, "ROWS", 3)
    parts = packing.pieces(docs.coalesce(1), PATH, capacity=64)
    check_packed(packing.pack(parts, 64).collect(), docs.select("doc_id", "text").collect(), tokenizer, 64)
