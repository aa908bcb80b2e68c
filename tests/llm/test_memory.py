"""What Python workers keep between batches: they outlive their tasks, beside the next stage's JVM."""

import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from tidemark.llm import common, packing, simhash

TEXTS = [f"text {i} of a batch, word{i} and word{i % 7}" for i in range(2500)]


class Frame:
    """Takes what an operator maps, to be run here."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


@pytest.fixture
def released(monkeypatch):
    """Counts how often Arrow's pool was told to return what it holds unused."""
    told = []

    class Pool:
        def release_unused(self):
            told.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    return told


def batches(n):
    for k in range(n):
        yield pa.record_batch([pa.array(range(len(TEXTS))), pa.array([f"{k} {t}".encode() for t in TEXTS])], names=["doc_id", "t"])


@pytest.mark.parametrize(
    "mapped",
    [
        lambda: simhash.fingerprints(Frame(), 3),
        lambda: packing.pieces(Frame(), public_tokenizers.path("word_bpe_49k.json")),
    ],
)
def test_operators_return_memory_after_each_batch(spark, released, mapped):
    seen = 0
    for k, out in enumerate(mapped()(batches(3))):
        seen += out.num_rows
        assert len(released) >= (seen - 1) // len(TEXTS)
    assert seen == 3 * len(TEXTS)
    assert len(released) >= 3


def test_a_batch_is_let_go_before_memory_is_returned(monkeypatch):
    made, held = [], []

    class Pool:
        def release_unused(self):
            held.append(sum(r() is not None for r in made))

    class Batch:
        pass

    def given():
        for _ in range(3):
            b = Batch()
            made.append(weakref.ref(b))
            yield b
            del b

    def run(some):
        for b in some:
            yield b

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    for b in common.by_batch(run)(given()):
        del b
    assert held == [1, 1, 1, 0]  # one at most: the reader's own, until it reads on


def test_texts_are_python_objects_a_few_at_a_time(spark, monkeypatch):
    taken = []

    class Column:
        def __init__(self, values):
            self.values = values

        def slice(self, at, n):
            return Column(self.values[at : at + n])

        def to_pylist(self):
            taken.append(len(self.values))
            return self.values

    class Batch:
        num_rows, columns = len(TEXTS), [None, None]

        def column(self, k):
            return Column([t.encode() for t in TEXTS]) if k else pa.array(range(len(TEXTS)))

    (out,) = simhash.fingerprints(Frame(), 3)([Batch()])
    assert max(taken) == simhash.ROWS and sum(taken) == len(TEXTS)
    assert out.column(0).to_pylist() == list(range(len(TEXTS)))
    found = [fp % (1 << 64) for fp in out.column(1).to_pylist()]
    assert found == [simhash.fingerprint(t.encode(), 3) for t in TEXTS]


def test_known_words_are_not_hashed_for_each_slice(monkeypatch):
    """The hash table is of the slice's few words, not of the many that are remembered."""
    hashed, index_in = [], packing.pc.index_in

    def recorded(values, value_set):
        hashed.append(len(value_set))
        return index_in(values, value_set=value_set)

    known = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    known.words = pa.array([f"remembered{i}".encode() for i in range(1000)], pa.large_binary())
    known.ids = pa.array([f"{i:04}".encode() for i in range(1000)], pa.large_binary())
    monkeypatch.setattr(packing.pc, "index_in", recorded)
    got = known.learn(pa.array([b"remembered7", b"new", b"remembered3"], pa.large_binary()))
    assert hashed == [3]
    assert got[0].as_py() == b"0007" and got[2].as_py() == b"0003"
    assert known.known[:5] == [b"remembered7", b"new", b"remembered3", b"remembered0", b"remembered1"]
    assert len(known.words) == len(known.ids) == 1001


def test_the_tokenizer_is_read_once(monkeypatch):
    """Both ways of a word to its ids share one model in memory."""
    path, made, read = public_tokenizers.path("word_bpe_49k.json"), tokenizers.Tokenizer, []

    class Counted:
        def __new__(cls, model):
            return made(model)

        @staticmethod
        def from_file(path):
            read.append(path)
            return made.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    known = packing.WordIds(path)
    assert read == [path]
    text = "Plain wordsandwords of Größe, then 日本 x<|endoftext|>y and 12.5%!"
    assert np.frombuffer(known.of([text.encode()])[0], "<u4").tolist() == made.from_file(path).encode(text, add_special_tokens=False).ids
