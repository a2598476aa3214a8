"""Operator 10, scoring texts with a log-bilinear neural model, beside an add-one unigram base.

Counts cover every training document. Documents are cut into blocks of bounded size; a block sends one row for each
different token, and gets that token's corpus count back, so a token that all documents hold
costs one row a block. Words common enough have codes of their own, the others share ``REST`` codes by a hash. How many
words are named grows with the corpus (``named_limit``), so the model's size has a proven bound, and so do the steps.

The neural model predicts a word from the ``CONTEXT`` tokens before it through a tree of two levels: the
commonest words are classes of their own, the other named words lie in classes of neighbours by count, about the root
of their number in each. With h = sum_i C_i r(context_i), P(word) = softmax(q h)[class] * softmax(v h over the
class)[word]. Both levels are trained in numpy by noise-contrastive estimation on every token of all training
documents, where they lie, with the same noise and batches in a corpus of any size: each task walks its blocks and returns
its rows, which are averaged by how often each was touched. Scoring is normalised by batched matrix products; a token of a shared code has (c + 1) / (N_code + V_code + 1)
of it, which leaves one share for tokens never seen.

Defined results: a null or empty text is its end token; with no training document N = V = 0 and the
base probability is 1; repeated rows count and score each; a null id is kept; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm.common import crc_mod, raw_texts, read_table, stored

#: The end token; it holds white space, so it is no word.
END = b" end"
BLOCK_BYTES = 16 << 20
TOP, REST, CONTEXT, DIM = 64, 8, 2, 24
#: Every training token is a target once over all rounds, in a small corpus as often as it takes for this many visits.
LEAST_VISITS, ROUNDS = 1_000_000, 4
#: Numbers of a model in one row, when tasks return theirs.
CHUNK = 4096


def named_limit(tokens: int) -> int:
    """Most words with codes of their own in a corpus of so many training tokens: 16 times the cube root
    (1,600 in a million, 400,000 in 1.6e13, a model of 80 MB)."""
    return int(16 * tokens ** (1 / 3))


def _blocks(batches, limit: int) -> Iterator[tuple[list, list[bool], list[bytes]]]:
    """Consecutive documents of about ``limit`` bytes: ids, training flags, texts."""
    ids, train, texts, size = [], [], [], 0
    for b in batches:
        for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2).cast(pa.string()))):
            ids.append(i)
            train.append(not h)
            texts.append(t)
            size += len(t) + 64
            if size >= limit:
                yield ids, train, texts
                ids, train, texts, size = [], [], [], 0
    if ids:
        yield ids, train, texts


def _local_codes(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different tokens of some texts, the last being ``END``, the number of tokens of each text, and all tokens as numbers."""
    held = pa.array(texts, pa.binary())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.StringArray.from_buffers(len(held), *held.buffers()[1:])))
    words = parts.flatten()
    full = pc.greater(pc.binary_length(words), 0)  # no words lie before a first space and after a last one
    ends = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))].take(parts.offsets.to_numpy())
    coded = words.filter(full).dictionary_encode()
    tokens = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    body = np.insert(coded.indices.to_numpy().astype(np.int32), ends[1:], len(tokens) - 1)
    return tokens, np.diff(ends) + 1, body


_ENCODED = "block long, token binary, local int, c_train long, ids array<long>, held array<boolean>, sizes array<int>, body binary"


def encode_blocks(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """Rows of two kinds for each block of documents (doc_id, held_out, text): one with the documents as
    numbers of the block's tokens, and one for each different token with its count in training rows."""
    def run(batches):
        part = TaskContext.get().partitionId()
        names = [x.split()[0] for x in _ENCODED.split(", ")]
        types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()),
                 pa.list_(pa.int32()), pa.binary()]
        for n, (ids, train, texts) in enumerate(_blocks(batches, limit)):
            tokens, sizes, body = _local_codes(texts)
            counts = np.bincount(body[np.repeat(np.array(train), sizes)], minlength=len(tokens))
            block, k = part << 32 | n, len(tokens)
            one = [[block], [None], [None], [None], [ids], [[not x for x in train]], [sizes], [body.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, ty) for v, ty in zip(one, types)], names=names)
            for i in range(0, k, 20_000):
                m = min(20_000, k - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), tokens[i:i + m],
                     pa.array(np.arange(i, i + m, dtype=np.int32)), pa.array(counts[i:i + m].astype(np.int64)),
                     *[pa.nulls(m, ty) for ty in types[4:]]], names=names)

    return docs.select("doc_id", "held_out", "t").mapInArrow(run, _ENCODED)


class Vocabulary:
    """Codes: named words by falling count, then ``REST`` shared ones, then the sign before a document's first
    token. ``counts``: of the named words; ``rest``: of the shared codes."""

    def __init__(self, counts: np.ndarray, rest: np.ndarray):
        self.words, self.head = len(counts), min(TOP, len(counts))
        self.start = self.words + REST
        size = max(1, int(np.ceil(np.sqrt(self.words))))
        tail = np.arange(self.words - self.head) // size
        in_tail = int(tail[-1]) + 1 if len(tail) else 0
        self.classes = self.head + in_tail + REST
        self.class_of = np.r_[np.arange(self.head), self.head + tail, self.head + in_tail + np.arange(REST)]
        totals = np.bincount(self.class_of, np.r_[counts, rest], self.classes)
        self.noise = (totals + 1) / (totals + 1).sum()
        self.share = counts / totals[self.class_of[:self.words]]
        #: Words of class k: first[k] to first[k + 1]; none in shared classes.
        self.first = np.searchsorted(self.class_of[:self.words], np.arange(self.classes + 1))
        self.cum = np.r_[0, np.cumsum(counts)].astype(float)
        self.dtype = np.uint16 if self.start < 1 << 16 else np.uint32
        #: A word at or little before each of many steps of ``cum``.
        self.per_count = 4 * max(self.words, 1) / max(self.cum[-1], 1)
        edges = (np.arange(4 * self.words + 1) - 0.5) / self.per_count
        self.guide = np.maximum(np.searchsorted(self.cum, edges, side="right") - 1, 0).astype(np.int32)

    def word_at(self, x: np.ndarray) -> np.ndarray:
        """The word whose part of ``cum`` holds each x (0 to the count of all named words; the last word at that end)."""
        x = np.minimum(x, np.nextafter(self.cum[-1], 0))
        at = self.guide.take((x * self.per_count).astype(np.int64))
        short = np.flatnonzero(self.cum.take(at + 1) <= x)
        while len(short):
            at.reshape(-1)[short] += 1
            short = short[self.cum.take(at.take(short) + 1) <= x.take(short)]
        return at


def _sorted_order(*keys: np.ndarray, below: int) -> np.ndarray:
    """Stable order by the first key, then the next ones; keys are less than ``below``."""
    order = None
    for key in reversed(keys):
        small = key.astype(np.uint16) if below <= 1 << 16 else key  # 16 bits are sorted by digits
        now = np.argsort(small if order is None else small.take(order), kind="stable")
        order = now if order is None else order.take(now)
    return order


def _push(p: np.ndarray, memory: np.ndarray, touched: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float,
          scale: np.ndarray | None = None) -> None:
    """One Adagrad step of the given rows; gradients of repeated rows are summed. With ``scale``, a row of ``grad`` serves
    as many rows in a row as there are for each, times their scale."""
    order = _sorted_order(rows, below=len(p))
    at = rows.take(order)
    first = np.concatenate(([True], at[1:] != at[:-1]))
    cuts = np.flatnonzero(first)
    one, times = at.take(cuts), np.diff(np.append(cuts, len(at)))
    if scale is None:
        own = grad.take(order, 0)
    else:
        own = grad.take(order // (len(rows) // len(grad)), 0)
        own *= scale.take(order)[:, None]
    g, again = own.take(cuts, 0), np.flatnonzero(times > 1)
    if len(again):
        left, even = own.take(np.flatnonzero(~first), 0), own.shape[1] // 2 * 2
        starts = cuts.take(again) - again  # as many firsts lie before, its own aside
        # two columns are summed at once
        g[again, :even] += np.add.reduceat(left[:, :even].view(np.complex64), starts).view(np.float32)
        g[again, even:] += np.add.reduceat(left[:, even:], starts)
    held = memory.take(one, 0)
    held += g * g
    memory[one] = held
    g *= rate
    g /= np.sqrt(held, out=held)
    p[one] = p.take(one, 0) - g
    touched[one] += times


class LogBilinear:
    """Representations r of context tokens, context matrices C, and rows q of classes and v of words in their
    class, whose last column is the bias."""

    def __init__(self, voc: Vocabulary, dim: int = DIM, seed: int = 3):
        r, self.voc, self.dim = np.random.default_rng(seed), voc, dim
        start = {"r": r.normal(0, 0.1, (voc.start + 1, dim)), "C": np.tile(np.eye(dim) * 0.5, (CONTEXT, 1)),
                 "q": np.c_[r.normal(0, 0.1, (voc.classes, dim)), np.log(voc.noise)],
                 "v": np.c_[np.zeros((voc.words, dim)), np.log(voc.share)]}
        self.p = {x: v.astype(np.float32) for x, v in start.items()}
        self.memory, self.touched = {}, {}

    def copy(self) -> LogBilinear:
        """The same model with no steps of its own yet."""
        new = LogBilinear.__new__(LogBilinear)
        new.voc, new.dim, new.p = self.voc, self.dim, {x: v.copy() for x, v in self.p.items()}
        new.memory = {x: np.full_like(v, 1e-6) for x, v in self.p.items()}
        new.touched = {x: np.zeros(len(v), np.float32) for x, v in self.p.items()}
        return new

    def held(self, context: np.ndarray) -> list[np.ndarray]:
        """Representations of the nearest token of each context, of the one before it, and so on."""
        return [self.p["r"].take(context[:, i], 0) for i in range(CONTEXT)]

    def predicted(self, held: list[np.ndarray]) -> np.ndarray:
        """h of each context, with a one for the bias."""
        d = self.dim
        h = np.ones((len(held[0]), d + 1), np.float32)
        h[:, :d] = sum(x @ self.p["C"][i * d:i * d + d] for i, x in enumerate(held))
        return h

    def log_probs(self, context: np.ndarray, target: np.ndarray, size: int = 8192, many: int = 16) -> np.ndarray:
        """Normalised natural log-probability of each target code after its context."""
        voc, out = self.voc, np.empty(len(target))
        # a context is looked up once: its class scores serve all its places, which lie together in this order
        order = _sorted_order(*context.T, below=voc.start + 1)
        context, target = context.take(order, 0), target.take(order)
        new = np.concatenate(([True], (context[1:] != context[:-1]).any(1)))
        for i in range(0, len(order), many * size):
            first = new[i:i + many * size].copy()
            first[::size] = True
            of, t = np.cumsum(first) - 1, target[i:i + many * size]
            h, cls = self.predicted(self.held(context[i:i + many * size][first])), voc.class_of.take(t)
            part = np.empty(len(t))
            for a in range(0, len(t), size):
                one = of[a:a + size] - of[a]
                z = h[of[a]:of[min(a + size, len(t)) - 1] + 1] @ self.p["q"].T
                part[a:a + size] = z[one, cls[a:a + size]] - self._log_sums(z).take(one)
            # words of a class lie together over many places, so that its rows are multiplied once
            inner = np.flatnonzero((t >= voc.head) & (t < voc.words))
            inner = inner.take(_sorted_order(cls.take(inner), below=voc.classes))
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(cls.take(inner)) != 0, [True]))) if len(inner) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                x = inner[a:b]
                lo, hi = voc.first[cls[x[0]]], voc.first[cls[x[0]] + 1]
                z = h.take(of.take(x), 0) @ self.p["v"][lo:hi].T
                part[x] += z[np.arange(len(x)), t.take(x) - lo] - self._log_sums(z)
            out[order[i:i + many * size]] = part
        return out

    @staticmethod
    def _log_sums(z: np.ndarray) -> np.ndarray:
        """Log of the sum of exponentials of each row; ``z`` is used up."""
        most = z.max()
        if most - z.min() < 60:  # one shift serves all rows
            z -= most
            return np.log(np.exp(z, out=z).sum(1)) + most
        own = z.max(1)
        z -= own[:, None]
        return np.log(np.exp(z, out=z).sum(1)) + own

    def train(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator, steps: int = 0, batch: int = 1024,
              k: int = 64, m: int = 8, rate: float = 0.05, places: np.ndarray | None = None) -> None:
        """Noise-contrastive steps on all ``places`` in their order (default: ``steps`` batches drawn evenly): tell the true
        class from k classes of the unigram noise, the same for a whole batch, and the true word from m words of its class."""
        p, voc, d = self.p, self.voc, self.dim
        if places is None:
            places = rng.integers(0, len(target), steps * batch)
        noise_draw, log_noise = np.cumsum(voc.noise), np.log(k * voc.noise).astype(np.float32)
        log_share = np.log(m * voc.share).astype(np.float32)
        for at in range(0, len(places), batch):
            i = places[at:at + batch]
            c, t = context.take(i, 0), target.take(i)
            cls = voc.class_of.take(t)
            w = np.minimum(np.searchsorted(noise_draw, rng.random(k)), voc.classes - 1)
            held = self.held(c)
            h = self.predicted(held)
            own, other = p["q"].take(cls, 0), p["q"][w]
            true = np.einsum("nd,nd->n", h, own) - log_noise[cls]
            up = (_sigmoid(true) - 1) / len(i)
            down = h @ other.T
            down -= log_noise[w]
            down = _sigmoid(down)
            down /= len(i)
            dh = down @ other
            own *= up[:, None]
            dh += own
            steps_of = [("q", np.concatenate((cls, w)), np.concatenate((up[:, None] * h, down.T @ h)), None)]
            inner = np.flatnonzero((t >= voc.head) & (t < voc.words))
            if len(inner):
                of = cls.take(inner)
                lo, hi = voc.first.take(of), voc.first.take(of + 1)
                from_, to = voc.cum[lo][:, None], voc.cum[hi][:, None]
                drawn = voc.word_at(from_ + rng.random((len(inner), m)) * (to - from_))
                rows = np.concatenate((t.take(inner)[:, None], np.clip(drawn, lo[:, None], hi[:, None] - 1)), 1)
                v, mine = p["v"].take(rows, 0), h.take(inner, 0)
                g = _sigmoid(np.einsum("nd,nmd->nm", mine, v) - log_share.take(rows)) / len(i)
                g[:, 0] -= 1 / len(i)
                dh[inner] += np.einsum("nm,nmd->nd", g, v)
                steps_of.append(("v", rows.ravel(), mine, g.ravel()))
            dh = dh[:, :d]
            for j in range(CONTEXT):
                at = slice(j * d, j * d + d)
                steps_of.append(("r", c[:, j], dh @ p["C"][at].T, None))
            steps_of.append(("C", np.arange(CONTEXT * d), np.concatenate([x.T @ dh for x in held]), None))
            for x, rows, grad, scale in steps_of:
                _push(p[x], self.memory[x], self.touched[x], rows, grad, rate, scale)

    def state(self) -> np.ndarray:
        """All rows times how often they were touched, and that number."""
        return np.concatenate([np.c_[self.p[x] * self.touched[x][:, None], self.touched[x]].ravel() for x in sorted(self.p)])

    def load(self, flat: np.ndarray) -> None:
        """Rows from summed states; a row that no task touched stays."""
        at = 0
        for x in sorted(self.p):
            rows, width = self.p[x].shape
            part = flat[at:at + rows * (width + 1)].reshape(rows, width + 1)
            moved = part[:, -1] > 0
            self.p[x][moved] = part[moved, :-1] / part[moved, -1:]
            at += part.size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.negative(x)
    np.exp(np.minimum(y, 30, out=y), out=y)
    y += 1
    return np.reciprocal(y, out=y)


def _contexts(codes: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """Codes of the CONTEXT tokens before each token, nearest first; ``first``: each token's place in its
    document; ``start``: the code before a document."""
    out = np.full((len(codes), CONTEXT), start, np.int32)
    for i in range(CONTEXT):
        held = first > i
        out[held, i] = codes[np.flatnonzero(held) - i - 1]
    return out


def _places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _read_block(sizes: list[int], body: bytes, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, codes and contexts of a block's documents."""
    n, codes = np.array(sizes), np.frombuffer(body, voc.dtype).astype(np.int32)
    return n, codes, _contexts(codes, _places(n), voc.start)


def _summed(states: DataFrame) -> DataFrame:
    """Chunks of states summed over tasks, always in the same order, one chunk in memory at a time."""
    def add(batches):
        now, total = None, None
        for b in batches:
            for chunk, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if chunk != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], names=names)
                    now, total = chunk, 0.0
                total = total + np.frombuffer(values, np.float32).astype(float)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], names=names)

    names = ["chunk", "total"]
    return (states.repartition("chunk").sortWithinPartitions("chunk", "part").select("chunk", "state")
            .mapInArrow(add, "chunk int, total binary"))


def round_places(block: int, taught: np.ndarray, visits: int, step: int) -> np.ndarray:
    """Places that round ``step`` trains on: over all rounds, each of the block's ``taught`` places ``visits`` times."""
    rng = np.random.default_rng([block, len(taught), step if visits == 1 else 0])
    if visits == 1:
        return rng.permutation(taught[step::ROUNDS])
    order = np.concatenate([rng.permutation(taught) for _ in range(visits)])
    return order[len(order) * step // ROUNDS:len(order) * (step + 1) // ROUNDS]


def train_model(coded: DataFrame, voc: Vocabulary, n_all: int) -> LogBilinear:
    """The model fitted on every token of all training documents in ``coded``, ``n_all`` tokens."""
    model = LogBilinear(voc)
    if n_all == 0:
        return model
    visits = max(1, -(-LEAST_VISITS // n_all))

    def learner(now, step: int):
        def learn(batches):
            mine, part = now.value.copy(), TaskContext.get().partitionId()
            rng, seen = np.random.default_rng([step, part]), False
            for b in batches:
                for i in range(b.num_rows):
                    block, held, sizes, body = (b.column(j)[i].as_py() for j in range(4))
                    sizes, codes, context = _read_block(sizes, body, mine.voc)
                    taught = np.flatnonzero(~np.repeat(np.array(held, bool), sizes))
                    if len(taught):
                        seen = True
                        mine.train(context, codes, rng, rate=0.05 * (1 - step / ROUNDS) + 0.005,
                                   places=round_places(block, taught, visits, step))
            if seen:
                flat = mine.state()
                parts = [flat[i:i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                    names=["part", "chunk", "state"])

        return learn

    blocks = coded.select("block", "held", "sizes", "codes")
    for step in range(ROUNDS):
        now = coded.sparkSession.sparkContext.broadcast(model)
        # one model of named_limit rows comes back
        rows = _summed(blocks.mapInArrow(learner(now, step), "part int, chunk int, state binary")).collect()
        rows.sort(key=lambda r: r.chunk)
        model.load(np.concatenate([np.frombuffer(bytes(r.total), float) for r in rows]))
    return model


def _named(counts: DataFrame, limit: int) -> DataFrame:
    """(token, c, code) of the commonest training tokens, at most ``limit``; equal counts are all named or none."""
    seen = counts.where(F.col("c") > 0)
    # one row a different count
    at_least = seen.groupBy("c").agg(F.count(F.lit(1)).alias("k")).select(
        "c", F.sum("k").over(Window.orderBy(F.desc("c"))).alias("words"))
    cut = at_least.where(F.col("words") <= limit).agg(F.min("c")).first()[0]
    code = F.row_number().over(Window.orderBy(F.desc("c"), "token")) - 1  # over at most limit rows
    return seen.where(F.col("c") >= cut if cut is not None else F.lit(False)).withColumn("code", code)


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per document row;
    ``held_out``: condition on documents that teach nothing."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                       F.col(text_col).cast("string").alias("t"))
    raw = stored(encode_blocks(rows), "lm-blocks")
    tokens = raw.where(F.col("token").isNotNull()).select("block", "token", "local", "c_train")
    counts = stored(tokens.groupBy("token").agg(F.sum("c_train").alias("c")), "lm-counts")
    all_tokens = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_all, v_all = int(all_tokens.n or 0), int(all_tokens.v)
    named = stored(_named(counts, named_limit(n_all)), "lm-words")
    own = np.array([r.c for r in named.select("c", "code").orderBy("code").collect()], np.int64)  # at most named_limit
    words = len(own)
    classed = counts.join(named.select("token", "code"), "token", "left").select(
        "token", "c", F.coalesce("code", F.lit(words) + (F.crc32("token") % REST).cast("int")).alias("code"))
    by_code = classed.where(F.col("code") >= words).groupBy("code").agg(
        F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).collect()
    total, kinds = np.zeros(REST), np.zeros(REST)
    for r in by_code:  # one row a shared code
        total[r.code - words], kinds[r.code - words] = r.n, r.v
    voc = Vocabulary(own, total)
    known = tokens.select("block", "token", "local").join(classed, "token").select(
        F.col("block").alias("of"), "local", "c", "code")
    bodies = raw.where(F.col("token").isNull()).select("block", "ids", "held", "sizes", "body")

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's documents with counts and codes: sums by document, and the code of each token."""
        k = right.num_rows
        at = right["local"].to_numpy()
        c, code = np.zeros(k, np.int64), np.zeros(k, np.int64)
        c[at], code[at] = right["c"].to_numpy(), right["code"].to_numpy()
        base = np.log10((c + 1) / (n_all + v_all + 1))
        of = np.maximum(code - words, 0)
        share = np.where(code < words, 0.0, np.log10((c + 1) / (total[of] + kinds[of] + 1)))
        out = []
        for i in range(left.num_rows):
            sizes = np.array(left["sizes"][i].as_py())
            body = np.frombuffer(left["body"][i].as_py(), np.int32)
            starts = np.cumsum(sizes) - sizes
            out.append((left["block"][i].as_py(), left["ids"][i].as_py(), left["held"][i].as_py(), sizes.tolist(),
                        np.add.reduceat((c[body] > 0).astype(np.int64), starts).tolist(),
                        np.add.reduceat(base[body], starts).tolist(), np.add.reduceat(share[body], starts).tolist(),
                        code[body].astype(voc.dtype).tobytes()))
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int64()),
                 pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
        return pa.table([pa.array([o[j] for o in out], ty) for j, ty in enumerate(types)],
                        names=["block", "ids", "held", "sizes", "known", "base", "share", "codes"])

    coded = stored(bodies.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        resolve, "block long, ids array<long>, held array<boolean>, sizes array<int>, known array<long>, "
                 "base array<double>, share array<double>, codes binary"), "lm-coded")
    model = train_model(coded, voc, n_all)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(n)[i].as_py() for n in b.schema.names}
                sizes, codes, context = _read_block(row["sizes"], row["codes"], voc)
                value = shared.value.log_probs(context, codes)
                starts = np.cumsum(sizes) - sizes
                sums = np.add.reduceat(value, starts) / np.log(10) + np.array(row["share"])
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                     pa.array(sizes, pa.int64()), pa.array(row["known"], pa.int64()),
                     pa.array(np.full(n, n_all, np.int64)), pa.array(row["base"], pa.float64()), pa.array(sums)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return coded.drop("block").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")


def op10_log_bilinear(spark, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
