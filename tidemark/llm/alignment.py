"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level BPE (A) and a piece BPE with byte
fallback (B). Offsets at which tokens of both end cut them into groups, which
are the components of the overlap graph.

Groups. Every token points to its farthest-right overlapping token (a B token
before an A token with the same end, which ends the chain). The successor of
the successor is taken until nothing changes, so a chain of n tokens is
followed in log n vectorised rounds over all texts of a slice at once; tokens
with one terminal are one group.

Pairs. An A and a B occurrence in one group are linked. A text's links are
kept as distinct id pairs with their numbers, in a table in the shared folder;
tasks count the texts of each pair and Spark adds the counts up. The most
frequent pairs (``SENT`` at most) go to the tasks as a sorted table, the texts'
rarer pairs meet their counts in a join, in which none is frequent.

Results at the edges: a null or empty text, one that is not valid UTF-8, and
one whose tokens do not spell it, has no tokens: zeros and an empty digest.
Texts of any length are encoded whole. Repeated rows count as texts of their
own, rows with a null id too. An empty table gives an empty table; columns
named like a result are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.session import ensure_checkpoint_dir

#: Pairs whose counts are sent to every task, at most.
SENT = 262_144
#: Bytes of text that are aligned at once (a longer text alone).
SLICE = 1_000_000
#: Distinct pairs a task gathers before it hands their counts on.
COUNTED = 2_000_000
#: Larger groups are reduced to distinct ids before their links are listed.
LARGE = 1024
#: Runs of this many bytes without a change between space and other characters go to the slower encoder.
RUN = re.compile(rb"\S{4000}|\s{4000}")
#: Fixed value: how byte-level BPE parts a text before its merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE vocabulary (a tokenizers file).

    Ids rank the merges, so the vocabulary drives tiktoken's encoder, which
    gives the same ids faster; texts with very long runs, for which that
    encoder takes time with the square of the run, go to the file's own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
        symbols = byte_symbols()
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        spelled = {bytes(symbols[c] for c in w): i for w, i in vocab.items()}
        self.fast = tiktoken.Encoding("own", pat_str=PARTS, mergeable_ranks=spelled, special_tokens={})
        self.bytes = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for w, i in spelled.items():
            self.bytes[i] = w

    def __call__(self, text: str, raw: bytes) -> list[int]:
        if RUN.search(raw):
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Ids and token bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            p = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode())

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number (rising with the offset) of every A and every B token, given their end offsets."""
    n = len(a_ends)
    over_b = np.searchsorted(b_ends, a_ends)  # the B token that holds the A token's last byte
    over_a = np.searchsorted(a_ends, b_ends)
    succ = np.concatenate([n + over_b, np.where(a_ends[over_a] > b_ends, over_a, n + np.arange(len(b_ends)))])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            break
        succ = further
    ends = np.zeros(len(succ), dtype=np.int64)
    ends[succ] = 1
    number = (np.cumsum(ends) - 1)[succ]
    return number[:n], number[n:]


def links(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Group, pair (A id * width + B id) and number of links, of all groups."""
    n = int(ga[-1]) + 1 if len(ga) else 0
    p, q = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    first_b = np.cumsum(q) - q
    small = p * q <= LARGE
    mine = small[ga] if n else np.zeros(0, dtype=bool)
    reps = q[ga[mine]]
    at = np.repeat(first_b[ga[mine]] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    out = [(np.repeat(ga[mine], reps), np.repeat(a[mine], reps) * width + b[at], np.ones(len(at), dtype=np.int64))]
    first_a = np.cumsum(p) - p
    for g in np.flatnonzero(~small):
        ai, an = np.unique(a[first_a[g] : first_a[g] + p[g]], return_counts=True)
        bi, bn = np.unique(b[first_b[g] : first_b[g] + q[g]], return_counts=True)
        keys = (ai[:, None] * width + bi[None, :]).ravel()
        out.append((np.full(len(keys), g), keys, (an[:, None] * bn[None, :]).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out))


def summed(doc: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal document and key added up, in order."""
    if not len(key):
        return doc, key, n
    order = np.lexsort((key, doc)) if key.max() >= 1 << 40 else np.argsort(doc << 40 | key, kind="stable")
    doc, key, n = doc[order], key[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(key) != 0)]))
    return doc[new], key[new], np.add.reduceat(n, new)


class Aligner:
    """Both encoders and their tables; one per task."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_len = np.array([len(x) for x in self.a.bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b.bytes], dtype=np.int64)
        va, vb = len(self.a.bytes), len(self.b.bytes)
        self.spelled = [b"%d," % i for i in range(va)] + [b"%d|" % i for i in range(va)]
        self.spelled += [b"%d," % i for i in range(vb)] + [b"%d;" % i for i in range(vb)]

    def encode(self, raws: list[bytes | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text by A and B; none if they do not spell it."""
        texts = [(r or b"").decode("utf-8", "replace") for r in raws]
        out = []
        for raw, text, b in zip(raws, texts, self.b(texts)):
            raw = b" " + (raw or b"")
            a = self.a(" " + text, raw) if text else []
            same = b"".join(map(self.a.bytes.__getitem__, a)) == raw == b"".join(map(self.b.bytes.__getitem__, b))
            out.append((a, b) if same and text else ([], []))
        return out

    def slice(self, raws: list[bytes | None]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, digest, pairs, their links."""
        ids = self.encode(raws)
        n_a, n_b = (np.array([len(x[k]) for x in ids], dtype=np.int64) for k in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(x[k] for x in ids), dtype=np.int64, count=int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
        n_docs, empty = len(ids), np.zeros(0, dtype=np.int64)
        if not len(a):
            return [(0, 0, 0, 0, "", empty, empty)] * n_docs
        ga, gb = groups(np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b]))
        p, q = np.bincount(ga), np.bincount(gb)
        doc_of = np.zeros(len(p), dtype=np.int64)
        doc_of[ga] = np.repeat(np.arange(n_docs), n_a)
        va, vb = len(self.a.bytes), len(self.b.bytes)
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        i, j = np.arange(len(a)), np.arange(len(b))
        end_a, end_b = np.cumsum(p), np.cumsum(q)
        codes[i + (end_b - q)[ga]] = a + va * (i == end_a[ga] - 1)
        codes[j + end_a[gb]] = b + 2 * va + vb * (j == end_b[gb] - 1)
        at, key, n = links(a, b, ga, gb, vb)
        doc, key, n = summed(doc_of[at], key, n)
        ends = np.searchsorted(doc, np.arange(n_docs + 1))
        per = lambda x: np.bincount(doc_of, weights=x, minlength=n_docs).astype(np.int64).tolist()
        n_groups, n_links = per(np.ones(len(p))), per(p * q)
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])
        out = []
        for d in range(n_docs):
            text = b"".join(map(self.spelled.__getitem__, codes[tokens[d] : tokens[d + 1]].tolist()))[:-1]
            digest = hashlib.sha256(text).hexdigest() if text else ""
            mine = slice(ends[d], ends[d + 1])
            out.append((int(n_a[d]), int(n_b[d]), n_groups[d], n_links[d], digest, key[mine], n[mine]))
        return out


SCHEMA = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<long>"
)
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *parts])))


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """One row per text, as ``SCHEMA`` says, read from a table in the shared folder."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row = Aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for b in batches:
            size, ids, texts = 0, [], []
            for k, (i, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), 1):
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
                if size >= SLICE or k == b.num_rows:
                    cols = list(zip(*both.slice(texts)))
                    out = [pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64())]
                    out += [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())]
                    yield pa.record_batch([*out, _lists(list(cols[5])), _lists(list(cols[6]))], names=NAMES)
                    row += len(ids)
                    size, ids, texts = 0, [], []

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    path = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    rows.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n``: how many texts hold each pair linked."""

    def counted(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(key), pa.array(n)], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for b in batches:
            more = b.column(0).flatten().to_numpy(zero_copy_only=False)
            new, k = np.unique(more, return_counts=True)
            _, key, n = summed(np.zeros(len(key) + len(new), dtype=np.int64), np.concatenate([key, new]), np.concatenate([n, k]))
            if len(key) > COUNTED:
                yield counted(key, n)
                key = n = np.zeros(0, dtype=np.int64)
        yield counted(key, n)

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def judged(counts: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: is the count its A id's highest."""
    a = F.floor(F.col("pair") / width).cast("long")
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    # one row per id of A's vocabulary at most
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def most_frequent(counts: DataFrame, room: int = SENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pair, count and best of the most frequent pairs, sorted by pair, and the least grade among them."""
    grade = F.floor(F.log2("n") * 16).cast("int")
    at = 1 << 30
    for g, n in sorted(map(tuple, counts.groupBy(grade).count().collect()), reverse=True):  # a thousand grades at most
        room -= n
        if room < 0:
            break
        at = g
    top = counts.filter(grade >= at).orderBy("pair").toPandas()  # ``room`` rows at most
    return top["pair"].to_numpy(), top["n"].to_numpy(), top["best"].to_numpy(), at


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", sent: int = SENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    rows = aligned(docs, a_path, b_path, text)
    counts = cut(judged(pair_counts(rows), len(Pieces(b_path).bytes)))
    pair, count, best, least = most_frequent(counts, sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("pairs")
            key = lists.flatten().to_numpy(zero_copy_only=False)
            n = b.column("times").flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            at = np.minimum(np.searchsorted(pair, key), max(0, len(pair) - 1))
            known = pair[at] == key if len(pair) else np.zeros(len(key), dtype=bool)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
            won = total(np.where(known, n * best[at], 0) if len(pair) else 0 * n).astype(np.int64)
            sums = total(np.where(known, n * count[at], 0) if len(pair) else 0 * n).astype(np.int64)
            other = np.flatnonzero(~known)
            doc = np.searchsorted(ends, other, side="right") - 1
            to = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b.num_rows))])
            split = lambda x: pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(x[other]))
            kept = [b.column(c) for c in NAMES[:7]]
            yield pa.record_batch([*kept, pa.array(won), pa.array(sums), split(key), split(n)], names=[*NAMES[:7], "won", "sums", "pairs", "times"])

    parts = cut(rows.mapInArrow(run, SCHEMA.replace(" pairs", " won long, sums long, pairs")))
    others = parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    others = others.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    rare = counts.filter(F.floor(F.log2("n") * 16).cast("int") < least)
    found = others.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_won"),
        F.sum(F.col("times") * F.col("n")).alias("more_sums"),
    )
    add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).cast("long")
    return parts.drop("pairs", "times").join(found, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        add("won", "more_won").alias("n_best"),
        add("sums", "more_sums").alias("count_sum"),
        "groups_sha256",
    )
