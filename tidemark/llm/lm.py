"""Language-model scoring: a gated recurrent network with class-factored output.

Counts. Tasks count words; Spark adds the counts up. The most frequent words
(``SENT`` at most, a fixed bound) go to the tasks as a table; counts of rarer
words meet the documents in a join, once per document and word.

Encoding. Texts are split and looked up once, into model ids of 16 bits in the
checkpoint folder; training and scoring read those.

Model. The ``MODEL_WORDS`` most frequent words are predicted by a softmax over
classes (words of equal share) and one over the words of the class. Any other
word is predicted as the class of its shape (last character, length, script),
and within it by its smoothed count among the words of that shape, so every
word has a probability and they add up to one.

Training. Every training document is read once. Documents are dealt by a hash
of id and text to trainers, whose number follows the training tokens alone
(``trainers``), and taken in the order of that hash. So the model depends on
the rows, not on how the input is split into files or tasks; rows equal in id
and text go to one trainer, which streams them. A trainer learns by truncated
backpropagation in numpy, many documents side by side, the state carried from
window to window through whole documents, however long, and reset only where a
document begins; Spark averages the trainers' parameters, weighted by tokens,
in whole numbers, so that the order of the sums does not matter. A small first
round leads the trainers to a common start, the second takes the rest.

Scoring. The state runs through the whole document, however long.

Results at the edges: a null or empty text is the end token alone. Repeated
rows are counted and scored each. Null ids count as the empty text in the
split and are scored like any other. An empty table gives an empty table;
columns of the input named like a result are not read.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

SENT = 65_536
MODEL_WORDS = 1024
CLASSES = 24
HIDDEN = 24
LANES = 256
WINDOW = 32
RATE = 0.1
#: Occurrences of an id in a window from which on its gradients are summed as a product.
OFTEN = 16
#: Tokens that are laid side by side at once, at most (a longer document alone).
CHUNK = 2_000_000
#: Bytes of text that are split at once (a longer text alone).
SLICE = 32 << 20
#: Training tokens in ``TRAINER_TOKENS``, to the power ``TRAINER_GROWTH``, make the number of trainers.
TRAINER_TOKENS = 700_000
TRAINER_GROWTH = 0.75
#: Parameters are averaged as multiples of 2 to this power.
STEP = -30
FIRST_ROUND = 8
END = b""
LAST = b".,!&*%$#|"
SHAPES = 4 * (len(LAST) + 3)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, one after the other, and their number in each text."""
    t = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    split = pc.ascii_split_whitespace(pc.ascii_lower(t))
    n = np.where(pc.binary_length(t).to_numpy() > 0, pc.list_value_length(split).to_numpy(), 0)
    words = split.flatten()
    return words.filter(pc.not_equal(words, "")), n.astype(np.int64)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``SLICE`` bytes of ``t``."""
    size = pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy().astype(np.int64)
    run = np.cumsum(size) // SLICE
    at = np.flatnonzero(np.diff(run, prepend=-1))
    for a, b in zip(at, [*at[1:], len(size)]):
        yield batch.slice(a, b - a)


def shape(word: bytes) -> int:
    """The class of a word outside the model."""
    c = word[-1:]
    k = LAST.find(c) if c else -1
    if k < 0:
        k = len(LAST) + (0 if c.isdigit() else 1 if c.isalpha() else 2)
    return 4 * k + 2 * (not word.isascii()) + (len(word) > 7)


def shapes_of(words: pa.Array) -> np.ndarray:
    """``shape`` of every word of a binary array; none is empty."""
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    words = pa.concat_arrays([words])  # its offsets begin at 0
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[: ends[-1]]
    last, one = data[ends[1:] - 1], np.array([shape(bytes([b])) & ~3 for b in range(128)] + [shape(b"\x80") & ~3] * 128)
    wide = np.maximum.reduceat(data, ends[:-1]) > 127
    return one[last] + 2 * wide + (np.diff(ends) > 7)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, c`` over ``t`` (texts), the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = 0
        for s in itertools.chain.from_iterable(map(slices, batches)):
            n = split_words(s.column("t"))[0].value_counts()
            docs += len(s)
            yield _counted(n.field("values").cast(pa.binary()), n.field("counts"))
        if docs:
            yield _counted(pa.array([END], pa.binary()), pa.array([docs], pa.int64()))

    return rows.select("t").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(words: pa.Array, n: pa.Array) -> pa.RecordBatch:
    return pa.record_batch([words, n], names=["word", "c"])


@dataclass
class Vocabulary:
    """Frequent words by falling count, classes of the first of them, and the shapes of the rest."""

    words: list[bytes]
    counts: np.ndarray
    n_model: int
    first: np.ndarray  # of each class, and the number of model words
    class_of: np.ndarray
    shape_n: np.ndarray
    shape_v: np.ndarray
    total: int
    distinct: int

    @property
    def inputs(self) -> int:
        return self.n_model + SHAPES + 1

    def base_log(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))

    def shape_log(self) -> np.ndarray:
        return np.log10(self.shape_n + 0.5 * (self.shape_v + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    grade = F.floor(F.log2("c") * 16).cast("int")
    words = counts.filter(F.length("word") > 0)
    at, room = 1 << 30, SENT
    for g, n in sorted(map(tuple, words.groupBy(grade).count().collect()), reverse=True):  # a thousand grades at most
        room -= n
        if room < 0:
            break
        at = g
    top = sorted(words.filter(grade >= at).collect(), key=lambda r: (-r["c"], bytes(r["word"])))  # SENT rows at most
    ends = counts.filter(F.length("word") == 0).collect()
    pairs = [(bytes(r["word"]), r["c"]) for r in top]
    model = [(END, ends[0]["c"] if ends else 0), *pairs[: MODEL_WORDS - 1]]
    rest = pairs[MODEL_WORDS - 1 :]
    own = pa.array([w for w, _ in model], pa.binary())

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(SHAPES, dtype=np.int64), np.zeros(SHAPES, dtype=np.int64)
        for b in batches:
            b = b.filter(pc.invert(pc.is_in(b.column(0), value_set=own)))
            of = shapes_of(b.column(0))
            np.add.at(n, of, b.column(1).to_numpy())
            np.add.at(v, of, 1)
        yield pa.record_batch([pa.array(np.arange(SHAPES)), pa.array(n), pa.array(v)], names=["s", "n", "v"])

    n, v = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in counts.mapInArrow(shapes, "s long, n long, v long").groupBy("s").agg(F.sum("n"), F.sum("v")).collect():
        n[r[0]], v[r[0]] = r[1], r[2]
    c = np.array([x for _, x in model + rest], dtype=np.float64)
    share = np.cumsum(np.sqrt(c[: len(model)] + 1))
    class_of = np.minimum((share - share[0]) / share[-1] * CLASSES, CLASSES - 1).astype(np.int64)
    class_of = np.unique(class_of, return_inverse=True)[1]
    first = np.concatenate([np.flatnonzero(np.diff(class_of, prepend=-1)), [len(model)]])
    return Vocabulary([w for w, _ in model + rest], c, len(model), first, class_of, n, v, total, distinct)


# -- the network ------------------------------------------------------------


def start_parameters(v: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; the biases say what the counts say."""
    rng = np.random.default_rng(seed)
    h, k = HIDDEN, len(v.first) - 1
    small = lambda *s: (0.1 * rng.standard_normal(s)).astype(np.float32)
    n_class = np.add.reduceat(v.counts[: v.n_model], v.first[:-1])
    n_out = np.concatenate([n_class, v.shape_n]) + 0.5
    return {
        "E": small(v.inputs, 3 * h),
        "U": small(h, 3 * h) * 2,
        "C": small(h, k + SHAPES),
        "c": np.log(n_out / n_out.sum()).astype(np.float32),
        "W": small(v.n_model, h),
        "w": np.log(v.counts[: v.n_model] + 0.5).astype(np.float32),
    }


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflat(x: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = x[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def softmax(e: np.ndarray, width: int | np.ndarray, own: np.ndarray, slopes: bool) -> np.ndarray:
    """Natural log-probability of each row's own entry, in place.

    ``e`` holds logits, row after row, ``width`` in each (one number, or one per
    row); ``own`` says where each row's own lies. With ``slopes``, ``e`` becomes
    the negative log-probability's gradient.
    """
    even = isinstance(width, int)
    starts = None if even else np.cumsum(width) - width
    rows = e.reshape(-1, width) if even else e
    spread = (lambda a: a[:, None]) if even else (lambda a: np.repeat(a, width))
    if e.min() < -80 or e.max() > 80:  # out of the range of exp
        rows -= spread(rows.max(axis=1) if even else np.maximum.reduceat(e, starts))
    logp = e.take(own)
    np.exp(e, out=e)  # far faster than into another large array
    total = rows @ np.ones(width, dtype=e.dtype) if even else np.add.reduceat(e, starts)
    logp -= np.log(total)
    if slopes:
        rows *= spread(1 / total)
        e[own] -= 1
    return logp


def sums_by_id(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, the most frequent first, and the sum of the rows of each."""
    order = np.argsort(ids, kind="stable")
    ids = ids.take(order)
    at = np.flatnonzero(np.diff(ids.astype(np.int64), prepend=-1))
    n = np.diff(at, append=len(ids))
    falling = np.argsort(-n, kind="stable")
    at, n = at.take(falling), n.take(falling)
    out = np.empty((len(at), rows.shape[1]), dtype=rows.dtype)
    often = int(np.searchsorted(-n, -OFTEN, side="right"))
    one = np.ones(n[0], dtype=rows.dtype)
    for i in range(often):
        np.dot(one[: n[i]], rows.take(order[at[i] : at[i] + n[i]], axis=0), out=out[i])
    left, few = at[often:], -n[often:]
    out[often:] = rows.take(order.take(left), axis=0)
    for k in range(1, -few[0] if len(few) else 0):  # the k-th row of each that has one
        more = int(np.searchsorted(few, -k))
        out[often : often + more] += rows.take(order.take(left[:more] + k), axis=0)
    return ids.take(at).astype(np.int64), out


class Network:
    def __init__(self, v: Vocabulary, p: dict[str, np.ndarray]):
        self.v, self.p = v, {k: x.copy() for k, x in p.items()}
        self.start = v.inputs - 1
        self.n_class = len(v.first) - 1
        self.group = np.concatenate([v.class_of, self.n_class + np.arange(SHAPES)]).astype(np.int16)  # sorted by radix
        self.sums = {k: np.full(x.shape, 1e-3, dtype=np.float32) for k, x in p.items()}

    def forward(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States after each step of ids ``x`` (steps, lanes); a start id resets its lane."""
        n, e, u = HIDDEN, self.p["E"], self.p["U"]
        rows, at = (e, x) if x.size > len(e) else (e.take(x.ravel(), axis=0), np.arange(x.size).reshape(x.shape))
        # each gate's values lie together; with both gates negated and the new state doubled, exp is all they need
        by_gate = np.concatenate([-rows[:, :n], -rows[:, n : 2 * n]])
        gates = by_gate.take(at[:, None] + np.array([[0], [len(rows)]]), axis=0)  # steps, gates, lanes, units
        new = (rows[:, 2 * n :] * 2).take(at, axis=0)
        u_gates, u_new = np.stack([-u[:, :n], -u[:, n : 2 * n]]), u[:, 2 * n :] * 2
        keep = (x != self.start).astype(e.dtype)[:, :, None]
        states, before, hu = (np.empty_like(new) for _ in range(3))
        h, gu, mu = h.astype(e.dtype, copy=False), np.empty_like(gates[0]), np.empty_like(new[0])
        one, two = np.array(1, e.dtype), np.array(-2, e.dtype)
        with np.errstate(over="ignore"):  # 1 / inf is 0
            for h_t, h0, g, m, hu_t, keep_t in zip(states, before, gates, new, hu, keep):
                np.multiply(h, keep_t, out=h0)
                g += np.matmul(h0, u_gates, out=gu)
                np.exp(g, out=g)
                g += one
                np.reciprocal(g, out=g)
                m += np.multiply(g[1], np.dot(h0, u_new, out=hu_t), out=mu)
                np.exp(m, out=m)  # tanh a = 1 - 2 / (exp 2a + 1)
                m += one
                np.divide(two, m, out=m)
                m += one
                h = np.subtract(h0, m, out=h_t)
                h *= g[0]
                h += m
        return states, (before, hu, gates, new)

    def output(self, states: np.ndarray, target: np.ndarray, grad: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Natural log-probability of each target (the class alone outside the model), and the states' gradient."""
        v, p, n, learn = self.v, self.p, HIDDEN, grad is not None
        k = self.group.take(target)
        order = np.argsort(k, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        k, s = k.take(order), np.ones((len(order), n + 1), dtype=states.dtype)  # by group; the last column meets the biases
        s[:, :n] = states.take(order, axis=0)
        e = s @ np.vstack([p["C"], p["c"]])
        logp, back = softmax(e.ravel(), e.shape[1], np.arange(0, e.size, e.shape[1]) + k, learn), None
        if learn:
            g = e.T @ s
            grad["C"], grad["c"] = g[:, :n].T, g[:, n]
            back = e @ p["C"].T
        # the words of all classes, class after class
        ends = np.searchsorted(k, np.arange(self.n_class + 1))
        k = k[: ends[-1]]
        width = np.diff(v.first)[k]
        stops = np.cumsum(width)
        e, w, parts = np.empty(width.sum(), dtype=s.dtype), np.hstack([p["W"], p["w"][:, None]]), []
        for c in np.flatnonzero(np.diff(ends)):
            at, of = slice(ends[c], ends[c + 1]), slice(v.first[c], v.first[c + 1])
            part = e[stops[at.start] - width[at.start] : stops[at.stop - 1]].reshape(at.stop - at.start, -1)
            parts.append((at, of, np.matmul(s[at], w[of].T, out=part)))
        if parts:
            own = stops - width + target.take(order[: len(k)]) - v.first[k]
            logp[: len(k)] += softmax(e, width, own, learn)
        if learn:
            g = np.zeros_like(w)
            for at, of, part in parts:
                np.matmul(part.T, s[at], out=g[of])
                back[at] += part @ p["W"][of]
            grad["W"], grad["w"] = g[:, :n], g[:, n]
        return logp.take(place), back.take(place, axis=0) if learn else None

    def backward(self, x: np.ndarray, tape: tuple, back: np.ndarray, grad: dict) -> None:
        """Through the window's steps; ``back`` is the output's gradient per state."""
        n, (before, hu, gates, new) = HIDDEN, tape
        ut, start = np.ascontiguousarray(self.p["U"].T), x == self.start
        z, r, starts = gates[:, 0], gates[:, 1], start.any(axis=1)
        rest = 1 - z
        by_z = before - new
        by_z *= z
        by_z *= rest
        by_new = new * new
        np.subtract(1, by_new, out=by_new)
        by_new *= rest
        by_hu = by_new * r
        by_r = np.subtract(1, r, out=rest)
        by_r *= by_hu
        by_r *= hu
        by_r *= 0.5  # the tape's products are doubled
        dhu = np.empty((*x.shape, 3 * n), dtype=new.dtype)
        d, dh, dz = np.empty_like(new), np.zeros_like(new[0]), np.empty_like(new[0])
        for t in range(len(x) - 1, -1, -1):
            dt, all_t = np.add(dh, back[t], out=d[t]), dhu[t]
            np.multiply(dt, by_z[t], out=all_t[:, :n])
            np.multiply(dt, by_r[t], out=all_t[:, n : 2 * n])
            np.multiply(dt, by_hu[t], out=all_t[:, 2 * n :])
            np.dot(all_t, ut, out=dh)
            dh += np.multiply(dt, z[t], out=dz)
            if starts[t]:
                dh[start[t]] = 0
        dx = dhu.reshape(-1, 3 * n)
        grad["U"] = (dx.T @ before.reshape(-1, n)).T
        by_new *= d
        dx[:, 2 * n :] = by_new.reshape(-1, n)
        grad["E"] = sums_by_id(x.ravel().astype(np.min_scalar_type(self.v.inputs)), dx)

    def update(self, grad: dict) -> None:
        for k, g in grad.items():
            rows = slice(None)
            if k == "E":
                rows, g = g
            s = self.sums[k][rows] + g * g
            self.sums[k][rows] = s
            self.p[k][rows] -= RATE * g / np.sqrt(s)

    def windows(self, x: np.ndarray, y: np.ndarray, size: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First step, inputs and targets of each window, without the lanes that have ended; of ``size`` ids if more steps."""
        busy = (y >= 0).sum(axis=0)  # falling: see lanes()
        t = 0
        while t < len(x):
            n = int((busy > t).sum())
            to = t + max(WINDOW, size // max(1, n))
            yield t, x[t:to, :n], y[t:to, :n]
            t = to

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """One pass over lanes of ids (steps, lanes); a target below 0 is padding."""
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        for _, xs, ys in self.windows(x, y):
            h = h[: xs.shape[1]]
            states, tape = self.forward(xs, h)
            h = states[-1]
            real = np.flatnonzero(ys >= 0)
            flat_states, targets = states.reshape(-1, HIDDEN), ys.ravel()
            grad: dict = {}
            if len(real) == ys.size:
                full = self.output(flat_states, targets, grad)[1]
            else:
                full = np.zeros_like(flat_states)
                full[real] = self.output(flat_states.take(real, axis=0), targets.take(real), grad)[1]
            self.backward(xs, tape, full.reshape(states.shape), grad)
            self.update(grad)

    def score(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log-probability of every target (steps, lanes), 0 at padding."""
        h, out = np.zeros((x.shape[1], HIDDEN), dtype=np.float32), np.zeros(x.shape, dtype=np.float32)
        for t, xs, ys in self.windows(x, y, WINDOW * LANES):
            states, _ = self.forward(xs, h[: xs.shape[1]])
            h = states[-1]
            real = ys >= 0
            at = np.flatnonzero(real)
            out[t : t + len(xs), : xs.shape[1]][real] = self.output(states.reshape(-1, HIDDEN).take(at, axis=0), ys.ravel().take(at))[0]
        return out


def lanes(docs: list[np.ndarray], start: int, width: int = LANES) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Documents' ids laid into lanes of similar length, the longest first: inputs, targets, (lane, first step) of each."""
    width = max(1, min(width, len(docs), 4 * sum(map(len, docs)) // max(map(len, docs), default=1)))  # padding is bounded
    free, where, parts = [(0, i) for i in range(width)], [(0, 0)] * len(docs), [[] for _ in range(width)]
    for k in sorted(range(len(docs)), key=lambda k: -len(docs[k])):
        n, lane = heapq.heappop(free)
        where[k] = (lane, n)
        parts[lane].append(docs[k])
        heapq.heappush(free, (n + len(docs[k]), lane))
    longest = sorted(range(width), key=lambda i: -sum(map(len, parts[i])))
    parts, to = [parts[i] for i in longest], {lane: i for i, lane in enumerate(longest)}
    where = [(to[lane], n) for lane, n in where]
    steps = max(n for n, _ in free)
    x, y = np.full((steps, width), start, dtype=np.int32), np.full((steps, width), -1, dtype=np.int32)
    for lane, p in enumerate(parts):
        at = 0
        for ids in p:
            x[at + 1 : at + len(ids), lane] = ids[:-1]
            y[at : at + len(ids), lane] = ids
            at += len(ids)
    return x, y, where


# -- the documents ----------------------------------------------------------


def encoded(rows: DataFrame, v: Vocabulary) -> DataFrame:
    """Per row its model ids, the parts of its scores that sent words give, and its other words with their numbers.

    ``rows``: ``doc_id, t, held, h``. ``ids`` are little-endian unsigned 16-bit:
    a model word's number, or ``n_model`` and the shape; the end comes last.
    """
    sent = pa.array(v.words, pa.binary())
    log_c = np.append(np.log10(v.counts + 0.5), 0.0)
    seen_c = np.append(v.counts > 0, False)
    shape_log, none = v.shape_log(), len(v.words)
    sent_shape = np.concatenate([[0], shapes_of(sent.slice(1))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for s in itertools.chain.from_iterable(map(slices, batches)):
            words, n = split_words(s.column("t"))
            words = words.dictionary_encode()
            place = words.indices.to_numpy().astype(np.int64)
            distinct = words.dictionary.cast(pa.binary())
            code = pc.fill_null(pc.index_in(distinct, value_set=sent), none).to_numpy().astype(np.int64)
            unsent = code == none
            of = np.append(sent_shape, 0)[code]
            of[unsent] = shapes_of(distinct.filter(pa.array(unsent)))
            # of each distinct word, and last of the end: model id, score parts
            ids = np.append(np.where(code < v.n_model, code, v.n_model + of), 0).astype("<u2")
            base, seen = log_c[np.append(code, 0)], seen_c[np.append(code, 0)]
            within = np.where(ids < v.n_model, 0.0, base - shape_log[np.append(of, 0)])
            ends = np.cumsum(n + 1)
            starts = ends - n - 1
            full = np.full(int(ends[-1]), len(distinct))
            full[np.delete(np.arange(len(full)), ends - 1)] = place
            per = lambda a: pa.array(np.add.reduceat(a[full], starts))
            # other words: once per document and word
            doc = np.repeat(np.arange(len(s)), n)
            rare = unsent[place]
            pair, times = np.unique(doc[rare] * (len(distinct) + 1) + place[rare], return_counts=True)
            cuts = pa.array(np.searchsorted(pair, np.arange(len(s) + 1) * (len(distinct) + 1)).astype(np.int32))
            other = distinct.take(pa.array(pair % (len(distinct) + 1)))
            flat_ids, at = ids[full], np.concatenate([[0], 2 * ends]).astype(np.int32)
            numbers = np.arange(row, row + len(s))
            row += len(s)
            yield pa.record_batch(
                [
                    pa.array(numbers), s.column("doc_id"), s.column("held"), s.column("h"),
                    pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(at), pa.py_buffer(flat_ids)]),
                    pa.array(n + 1), per(seen.astype(np.int64)), per(base), per(within),
                    pa.ListArray.from_arrays(cuts, other), pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64))),
                ],
                names=ENCODED,
            )

    schema = (
        "row long, doc_id long, held boolean, h long, ids binary, n_tokens long, known long, base double, within double, "
        "words array<binary>, times array<long>"
    )
    return rows.select("doc_id", "t", "held", "h").mapInArrow(run, schema)


ENCODED = ["row", "doc_id", "held", "h", "ids", "n_tokens", "known", "base", "within", "words", "times"]


def _ids(codes: bytes) -> np.ndarray:
    return np.frombuffer(codes, dtype="<u2")


def trainers(n_tokens: int) -> int:
    """How many trainers share so many tokens: fewer than in proportion, so that a trainer's share grows slowly."""
    return max(1, round((n_tokens / TRAINER_TOKENS) ** TRAINER_GROWTH))


def trained(rows: DataFrame, n_tokens: int, v: Vocabulary, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The average of what each trainer makes of ``p`` on its rows (``h``, ``doc_id``, ``ids``; ``n_tokens`` in all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for _, mine in itertools.groupby(docs, key=lambda r: r[0]):
            net, seen, held, size = Network(v, p), 0, [], 0
            for _, codes in itertools.chain(mine, [(None, None)]):
                if codes is not None:
                    held.append(_ids(codes))
                    size += len(held[-1])
                if held and (size >= CHUNK or codes is None):
                    net.train(*lanes(held, net.start)[:2])
                    seen, held, size = seen + size, [], 0
            x = np.rint(np.ldexp(flat(net.p).astype(np.float64), -STEP)).astype(np.int64)
            yield pa.record_batch(
                [pa.array(np.arange(len(x))), pa.array(x), pa.array(np.full(len(x), seen))], names=["i", "x", "n"]
            )

    parts = trainers(n_tokens)
    dealt = rows.select(F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int").alias("trainer"), "ids", "h", "doc_id")
    dealt = dealt.repartitionById(parts, "trainer").sortWithinPartitions("trainer", "h", "doc_id", "ids")
    each = dealt.select("trainer", "ids").mapInArrow(run, "i long, x long, n long")
    weighted = F.sum(F.col("x").cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")).cast("double")
    got = each.groupBy("i").agg((weighted / F.sum("n")).alias("x")).toPandas()  # one row per parameter
    if got.empty:
        return p
    return unflat(np.ldexp(got.sort_values("i")["x"].to_numpy(), STEP), p)


def scored(rows: DataFrame, v: Vocabulary, p: dict[str, np.ndarray]) -> DataFrame:
    """``encoded`` rows with ``model``: what the model gives for all but their unsent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(v, p)
        for held in _chunks(batches):
            docs = [_ids(c) for b in held for c in b.column("ids").to_pylist()]
            x, y, where = lanes(docs, net.start)
            logp = net.score(x, y)
            model = [logp[a : a + len(d), lane].sum(dtype=np.float64) / math.log(10) for (lane, a), d in zip(where, docs)]
            kept = pa.Table.from_batches(held).drop_columns(["ids", "within"]).combine_chunks()
            within = np.concatenate([b.column("within").to_numpy() for b in held])
            yield from kept.append_column("model", pa.array(np.array(model) + within)).to_batches()

    schema = "row long, doc_id long, held boolean, n_tokens long, known long, base double, model double"
    return rows.select("row", "doc_id", "held", "ids", "n_tokens", "known", "base", "within").mapInArrow(run, schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Rows in groups of about ``CHUNK`` tokens."""
    held, n = [], 0
    for b in batches:
        size = np.cumsum(b.column("n_tokens").to_numpy())
        at = 0
        while at < len(b):
            done = size[at - 1] if at else 0
            to = min(int(np.searchsorted(size, done + CHUNK - n)) + 1, len(b))
            held.append(b.slice(at, to - at))
            n, at = n + int(size[to - 1] - done), to
            if n >= CHUNK:
                yield held
                held, n = [], 0
    if held:
        yield held


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    rows = rows.withColumns({"held": held_out(F.col("doc_id")), "h": F.xxhash64("doc_id", "t")})
    counts = cut(word_counts(rows.filter(~F.col("held"))))
    v = vocabulary(counts)
    coded = cut(encoded(rows, v))
    early = F.pmod("h", F.lit(FIRST_ROUND)) == 0
    training = coded.filter(~F.col("held"))
    n_early = training.agg(F.coalesce(F.sum(F.when(early, F.col("n_tokens"))), F.lit(0))).first()[0]
    p = start_parameters(v)
    p = trained(training.filter(early), n_early, v, p)
    p = trained(training.filter(~early), v.total - n_early, v, p)
    others = coded.select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
    others = others.select("row", F.col("x.words").alias("word"), F.col("x.times").alias("k"))
    found = others.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more_known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored(coded, v, p).join(found, "row", "left").select(
        "doc_id",
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(v.total)).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * v.base_log()).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
