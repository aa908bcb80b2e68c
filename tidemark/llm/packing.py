"""Best-fit packing of tokenised documents into fixed-size sequences.

A document's ids end with id 1; only longer ones than a sequence are cut into
pieces of full length and a last one. Pieces are packed best-fit decreasing:
the longest first, each into the open sequence with the least room that holds
it. Pieces of one length are interchangeable, so the rule is run on the table
of lengths (at most ``capacity`` rows, whatever the corpus): a segment tree
over remaining capacities gives the tightest open room in logarithmic time,
and all sequences with that room take pieces in one step. A step covers a
range of ranks among the pieces of its length; Spark ranks the pieces (bucket
totals first, so a frequent length is ranked by many tasks) and joins them to
their step.

Results at the edges: a null or empty text is the single id 1. Texts of any
length are tokenised whole. Repeated rows are packed each; rows with a null
id too. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, cut

CAPACITY = 4096
END = 1
#: Words a Python worker remembers the ids of (about 50 bytes each); beyond it, those not used the longest are dropped.
REMEMBERED = 300_000
#: Runs of letters that are encoded as one text.
RUNS = 256
#: Rows of a batch that are Python objects at once.
ROWS = 1024
#: Bytes of text that are looked up at once (a longer text alone).
SLICE = 2_000_000
#: Steps that are broadcast; more of them are joined by shuffle.
STEPS_SENT = 200_000
#: Latin letters without İ (whose lower case is not a letter alone): of the tokenizer's rules, lower-casing alone
#: touches a run of them.
RUN = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"

SPACE = b" \t\n\x0b\f\r"
PUNCTUATION = b".,!$%&*#|?;:"
LOWER = bytes(32 if k in SPACE else k + 32 if 65 <= k <= 90 else k for k in range(256))
#: A part begins where what the byte before may end meets what the byte may begin: 1 a word, 2 the punctuation after
#: a letter or digit (a byte from 0x80 on ends a letter, but in the words that ``ODD`` finds).
BEFORE = bytes(1 if k in SPACE else 2 * (chr(k).isalnum() if k < 128 else k < 192) for k in range(256))
AFTER = bytes(0 if k in SPACE else 3 if k in PUNCTUATION else 1 for k in range(256))
#: Bytes that begin other characters than ASCII and U+00C0 to U+027F, which are letters but for × and ÷.
ODD = bytes(k == 0xC2 or k > 0xC9 for k in range(256))
ODD_PAIRS = (b"<|", "×".encode(), "÷".encode(), "İ".encode())


class WordIds:
    """Little-endian uint32 ids of words between ASCII spaces, as bytes.

    The tokenizer never joins characters across a space, so words can be
    looked up one by one. It lower-cases, and it parts punctuation from a
    letter or digit before it, so words are taken with ASCII lower-cased and
    cut before such punctuation. A word that may hold a special token's
    string, or characters beyond the Latin letters, is left to the tokenizer
    as it is. Slices of many texts are parted and looked up as arrays; only
    new words are Python objects.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # runs of lower-case letters between spaces: nothing to normalise or to part, no special tokens; one model in memory
        self.plain = Tokenizer(self.tokenizer.model)
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), letters])
        self.words = self.ids = pa.array([], pa.large_binary())  # those used last come first
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """This Python worker's memory, kept from task to task.

        The operator's own module travels by value with each task, so the
        memory hangs on an installed one.
        """
        import tokenizers

        kept = vars(tokenizers).setdefault("_word_ids_of_worker", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    @property
    def known(self) -> list[bytes]:
        """The words that are remembered."""
        return self.words.to_pylist()

    @staticmethod
    def parts(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts that are looked up, in order, and how many lie before each text and in all.

        ``texts`` are UTF-8.
        """
        raw = b" %s " % b" ".join(texts)
        data, before, after = (np.frombuffer(raw.translate(t), np.uint8) for t in (LOWER, BEFORE, AFTER))
        edge = before[:-1] & after[1:]
        at = np.flatnonzero(edge) + 1
        odd = np.zeros(0, np.int64) if raw.isascii() else np.flatnonzero(np.frombuffer(raw.translate(ODD), bool))
        for pair in ODD_PAIRS:
            if pair in raw:
                odd = np.append(odd, [m.start() for m in re.finditer(re.escape(pair), raw)])
        if len(odd):  # their words stay whole and as they are
            begins = at[edge[at - 1] == 1]
            ends = np.flatnonzero(after[:-1] & before[1:] & 1) + 1
            k = np.unique(np.searchsorted(begins, odd, "right") - 1)
            inside = np.zeros(len(raw), np.int8)
            inside[begins[k]], inside[ends[k]] = 1, -1
            inside = np.cumsum(inside, dtype=np.int8).view(bool)
            data = np.where(inside, np.frombuffer(raw, np.uint8), data)
            at = at[(edge[at - 1] == 1) | ~inside[at]]
        solid = (after & 1).view(bool)
        sizes = np.cumsum(solid, dtype=np.uint32)  # a batch of Spark's has less than 2 GB
        offsets = np.append(sizes[at - 1], sizes[-1]).astype(np.int64)
        bounds = [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]
        starts = np.cumsum([1, *[len(t) + 1 for t in texts]])
        return pa.Array.from_buffers(pa.large_binary(), len(at), bounds), np.searchsorted(at, starts)

    def learn(self, words: pa.Array) -> pa.Array:
        """The ids of distinct ``words``, which are remembered; unknown ones go to the tokenizer together."""
        used = pc.index_in(self.words, value_set=words)  # hashes the fewer: the slice's words
        unused = used.is_null()
        at = np.full(len(words), -1)
        at[used.drop_null().to_numpy()] = np.flatnonzero(~unused.to_numpy(zero_copy_only=False))
        new = at < 0
        ids = pa.concat_arrays([self.ids, self.encode(words.filter(pa.array(new)))])
        ids = ids.take(pa.array(np.where(new, len(self.ids) + np.cumsum(new) - 1, at)))
        self.words = pa.concat_arrays([words, self.words.filter(unused)]).slice(0, REMEMBERED)
        self.ids = pa.concat_arrays([ids, self.ids.filter(unused)]).slice(0, REMEMBERED)
        return ids

    def encode(self, words: pa.Array) -> pa.Array:
        """The ids of new words.

        Runs of Latin letters go to the model lower-cased, in texts of many:
        it parts none of them, and every run ends with a token that closes it,
        so as many closing tokens as runs tell the ids of each.
        """
        letters = pc.match_substring_regex(words.cast(pa.large_string()), RUN)
        runs = words.filter(letters).to_pylist()
        joined = [b" ".join(runs[k : k + RUNS]).decode().lower() for k in range(0, len(runs), RUNS)]
        found = self.plain.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, dtype="<u4"), *[np.array(e.ids, dtype="<u4") for e in found]])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(runs):
            letters, ids, ends = pa.array(np.zeros(len(words), bool)), ids[:0], ends[:0]
        offsets = np.append([0], 4 * ends)
        plain = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        others = [w.decode() for w in words.filter(pc.invert(letters)).to_pylist()]
        got = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        rest = pa.array([np.array(e.ids, dtype="<u4").tobytes() for e in got], pa.large_binary())
        order = np.argsort(~letters.to_numpy(zero_copy_only=False), kind="stable")
        return pa.concat_arrays([plain, rest]).take(pa.array(np.argsort(order)))

    def of(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text."""
        parts, first = self.parts([_utf8(t or b"") for t in texts])
        if not len(parts):
            return [b""] * len(texts)
        coded = parts.dictionary_encode()
        _, offsets, ids = self.learn(coded.dictionary).take(coded.indices).buffers()
        ends = np.frombuffer(offsets, np.int64)[first].tolist()
        ids = memoryview(ids or b"")
        return [bytes(ids[a:b]) for a, b in zip(ends, ends[1:])]


def _utf8(text: bytes) -> bytes:
    """The text, with U+FFFD for bytes that are not UTF-8."""
    return text if text.isascii() else text.decode("utf-8", "replace").encode()


def _slices(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in order, about ``SLICE`` bytes at once."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or b"")
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text", ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``: little-endian uint32 bytes)."""
    end = np.array([END], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds.of_worker(tokenizer)
        for b in batches:
            lists, done = (b.column(1).slice(k, ROWS).to_pylist() for k in range(0, b.num_rows, ROWS)), 0
            for texts in _slices(chain.from_iterable(lists)):
                rows: list[tuple] = []
                for i, blob in enumerate(known.of(texts), done):
                    blob += end
                    for k, at in enumerate(range(0, len(blob), 4 * capacity)):
                        part = blob[at : at + 4 * capacity]
                        rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), *[part] * ids))
                done += len(texts)
                cols = list(zip(*rows))
                out = [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32())]
                out += [pa.array(c, pa.int64()) for c in cols[2:5]] + [pa.array(c, pa.binary()) for c in cols[5:]]
                yield pa.record_batch(out, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return rows.mapInArrow(by_batch(run), schema)


class Tightest:
    """Segment tree over remaining capacities: how many sequences have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def put(self, room: int, present: bool) -> None:
        k = room + self.size
        self.any[k] = present
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def find(self, need: int) -> int | None:
        """The smallest room of at least ``need``."""
        k = need + self.size
        if self.any[k]:
            return need
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first rank, pieces, pieces per sequence, first sequence, offset).

    ``counts`` has the number of pieces of each length. Sequences that were
    filled alike are one range of ids; a step fills a whole range or parts it.
    """
    tree, open_, steps, used = Tightest(capacity), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_.setdefault(room, []).append((first, n))
            tree.put(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.find(length)
            if room is None:
                room, first, n = capacity, used, math.ceil(left / (capacity // length))
                used += n
            else:
                first, n = open_[room].pop()
                if not open_[room]:
                    tree.put(room, False)
            each = room // length
            full = min(n, left // each)
            if full:
                steps.append((length, rank, full * each, each, first, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # the last few go into one more sequence
                steps.append((length, rank, left, left, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            if room < capacity:
                put(room, first + full, n - full)
    return steps


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id, offset``."""
    counts = {int(r[0]): int(r[1]) for r in parts.groupBy("length").count().collect()}  # at most capacity rows
    total = sum(counts.values())
    steps = best_fit(counts, capacity)
    frame = pd.DataFrame(steps, columns=["s_length", "first", "n", "each", "seq", "at"], dtype="int64")
    plan = parts.sparkSession.createDataFrame(
        frame, "s_length long, first long, n long, each long, seq long, at long"
    )
    plan = F.broadcast(plan) if len(steps) <= STEPS_SENT else plan

    buckets = max(1, math.isqrt(total // 8))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in parts.columns]
    dealt = parts.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sizes = sizes.select(F.col("length").alias("b_length"), F.col("_b").alias("b_b"), "_before")
    inside = F.row_number().over(Window.partitionBy("length", "_b").orderBy(*order)) - 1
    ranked = dealt.withColumn("_inside", inside).join(
        sizes, (F.col("length") == F.col("b_length")) & (F.col("_b") == F.col("b_b"))
    )
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_inside"))
    k = F.col("_rank") - F.col("first")
    placed = ranked.join(plan, (F.col("length") == F.col("s_length")) & (k >= 0) & (k < F.col("n")))
    return placed.select(
        *[F.col(f"`{c}`") for c in parts.columns],
        (F.col("seq") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
