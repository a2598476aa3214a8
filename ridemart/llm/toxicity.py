"""Operator 2, toxicity by weak supervision.

Many voters look at a text: word lists, and words, word beginnings and pieces of very long runs that hold far
more often in documents labelled toxic (mined by one count over the labelled sample). Each pattern has a voter for
one, two, and three or more occurrences, of which at most one fires; a word and its beginning don't both vote, nor
do two patterns that the same documents have. A generative label model estimates by expectation maximisation how
often each voter fires in either class, over labelled and unlabelled texts alike. From what the classes leave
unexplained it estimates which voters go together: those that fire, or are silent, beside each other share their weight. Human labels anchor the classes while the rates are estimated, but the posterior labels come
from the votes alone, and a logistic classifier over the voters and shape features is trained on them and
scores whole texts.

Fitting uses at most ``fit_rows`` labelled and about as many unlabelled documents, chosen by hashes.

Defined results: a null or empty text scores what the classifier gives no vote at all; without usable
labels only the word lists vote; repeated rows are scored alike; a null id can't be a training row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridemart.llm.common import WORDS, chunks, crc_mod, labelled_sample, map_rows, read_table, texts_of

#: Bound on the documents the model is fitted on.
FIT_ROWS = 8000
#: Occurrences from which a voter may fire, longest beginning of a word, letters from which a run is cut into pieces.
LEVELS, BEGINNING, LONG_RUN, PIECE = 3, 8, 40, 5
#: Fixed word lists, one voter each: common insults by language.
LEXICONS = {
    "en": "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb jerk imbecile",
    "de": "idiot dumm arschloch abschaum versager trottel widerlich wertlos ekelhaft",
    "fr": "idiot imbécile connard ordure minable stupide dégoûtant pathétique débile",
    "es": "idiota imbécil estúpido basura asqueroso patético payaso inútil escoria",
}
#: Weight of a silent voter: most only know the words of one language.
SILENCE = 0.5
#: Probability that a human label is right.
LABEL_ACCURACY = 0.98


def normal(text: bytes) -> str:
    """Words of a text, ASCII lower-cased, between single spaces and with one at either end."""
    return " " + b" ".join(text.translate(WORDS).split()).decode() + " "


def word_patterns(text: bytes) -> Counter[str]:
    """Candidate patterns in a text and how often it has them: ' word ', ' begin' of four to eight letters, and every
    piece of five letters of a run too long for a word."""
    out: Counter[str] = Counter()
    for w, n in Counter(normal(text).split(" ")).items():
        if len(w) > LONG_RUN:
            out.update({w[i:i + PIECE]: n for i in range(len(w) - PIECE + 1)})
        elif len(w) > 2:
            out[f" {w} "] += n
            for k in range(4, min(len(w), BEGINNING + 1)):
                out[f" {w[:k]}"] += n
    return out


SHAPES = 4


def shape(text: bytes) -> list[float]:
    """Shouting, marks and length, each from 0 to 1."""
    n = max(1, len(text))
    upper = n - len(text.translate(None, bytes(range(65, 91))))
    return [upper / n, min(1.0, 20 * text.count(b"!") / n), min(1.0, 20 * text.count(b"?") / n),
            min(1.0, np.log1p(len(text)) / 16)]


def mine_patterns(sample: DataFrame, least: int = 4, share: float = 0.02, lift: float = 20.0) -> list[str]:
    """Patterns that ``least`` toxic documents and ``share`` of them have some number of times (up to ``LEVELS``) or more, and that are
    then ``lift`` times commoner in toxic documents. Of those that hold for the same documents one is taken, and of a
    pattern and its beginnings the most telling one."""
    def count(batches):
        found: dict[tuple[str, int], list[int]] = {}
        seen = [0, 0]
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = t.encode()
                sign = zlib.crc32(text)
                seen[y] += 1
                for w, n in word_patterns(text).items():
                    for level in range(1, min(n, LEVELS) + 1):
                        row = found.setdefault((w, level), [0, 0, 0])
                        row[y] += 1
                        row[2] += sign
        rows = [("", 0, seen[0], seen[1], 0)] + [(w, level, *r) for (w, level), r in found.items()]
        for i in range(0, len(rows), 50_000):
            cols = zip(*rows[i:i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), *[pa.int64()] * 3))],
                                             names=["w", "level", "n", "p", "sign"])

    counts = sample.mapInArrow(count, "w string, level int, n long, p long, sign long").groupBy("w", "level").agg(
        *[F.sum(c).alias(c) for c in ("n", "p", "sign")])
    kept = counts.where((F.col("w") == "") | (F.col("p") >= least))
    total = kept.where("w = ''").first()
    if total is None or not total.p:
        return []
    telling = (F.col("p") >= share * total.p) & (F.col("p") / total.p >= lift * (F.col("n") + 0.5) / max(1, total.n))
    one = kept.where((F.col("w") != "") & telling).groupBy("level", "n", "p", "sign").agg(
        F.min(F.struct(F.length("w").alias("size"), "w")).alias("v"))
    worth: dict[str, float] = {}
    for r in one.collect():
        more = r.p * np.log(r.p / total.p / ((r.n + 0.5) / max(1, total.n)))
        worth[r.v.w] = max(worth.get(r.v.w, 0.0), more)
    told: list[str] = []
    for w in sorted(worth, key=lambda w: (-worth[w], w)):
        if not any(w.startswith(x) or x.startswith(w) for x in told):
            told.append(w)
    return sorted(told)


class Voters:
    """Votes of the word lists and patterns, and shape features, for texts."""

    def __init__(self, patterns: list[str]):
        self.texts, self.lists = patterns, sorted(LEXICONS)
        self.width = LEVELS * (len(self.lists) + len(patterns)) + SHAPES
        self.machine = None

    def features(self, texts: list[bytes]) -> np.ndarray:
        if self.machine is None:  # made once in each task
            values: dict[str, list[int]] = {}
            for i, name in enumerate(self.lists):
                for w in LEXICONS[name].split():
                    values.setdefault(f" {w} ", []).append(i)
            for i, w in enumerate(self.texts, len(self.lists)):
                values.setdefault(w, []).append(i)
            self.machine = ahocorasick.Automaton()
            for w, v in values.items():
                self.machine.add_word(w, v)
            self.machine.make_automaton()
        x = np.zeros((len(texts), self.width))
        found = np.zeros(len(self.lists) + len(self.texts), np.int64)
        for row, t in zip(x, texts):
            found[:] = 0
            for _, v in self.machine.iter(normal(t)):
                found[v] += 1
            row[np.flatnonzero(found) * LEVELS + np.minimum(found[found > 0], LEVELS) - 1] = 1.0
            row[-SHAPES:] = shape(t)
        return x

    def __getstate__(self):
        return {**self.__dict__, "machine": None}


class LabelModel:
    """Voters that fire given the class, with weights lowered for voters that fire together. ``silence``: weight of the
    evidence of voters that don't fire, 1 where every voter can judge every text."""

    def __init__(self, silence: float = 1.0):
        self.silence = silence

    def fit(self, votes: np.ndarray, gold: np.ndarray, rounds: int = 10) -> LabelModel:
        """``gold``: 0 or 1 for anchors, -1 for texts without a label."""
        told = gold >= 0
        self.prior = float((gold[told].sum() + 1) / (told.sum() + 2)) if told.any() else 0.1
        lists = votes[:, :LEVELS * len(LEXICONS)].any(1)
        post = np.where(told, np.where(gold == 1, LABEL_ACCURACY, 1 - LABEL_ACCURACY), np.where(lists, 0.9, self.prior / 2))
        # what the classes leave unexplained: on the anchors, or on all rows as first guessed
        known, w = (votes[told], post[told]) if told.any() else (votes, post)
        self._rates(known, w)
        rest = known - (1 - w)[:, None] * self.rate[0] - w[:, None] * self.rate[1]
        spread = np.sqrt((rest ** 2).mean(0)) + 1e-9
        self.correlation = (rest.T @ rest) / len(known) / spread[:, None] / spread
        self.together = np.where(self.correlation > 0.1, self.correlation, 0)
        np.fill_diagonal(self.together, 0)
        for _ in range(rounds):
            post = self.posterior(votes, gold)
            self._rates(votes, post)
        return self

    def _rates(self, votes: np.ndarray, post: np.ndarray) -> None:
        """How often each voter fires in either class."""
        every = votes.mean(0)
        self.rate = [((w[:, None] * votes).sum(0) + 5 * every + 1e-4) / (w.sum() + 5) for w in (1 - post, post)]

    def posterior(self, votes: np.ndarray, gold: np.ndarray | None = None) -> np.ndarray:
        """Probability of class 1 from the votes; with ``gold`` an anchor's label is one more vote."""
        a, b = (np.clip(r, 1e-6, 1 - 1e-6) for r in self.rate)
        silent = 1 - votes
        logit = ((votes * np.log(b / a) / (1 + votes @ self.together)).sum(1)
                 + self.silence * (silent * np.log((1 - b) / (1 - a)) / (1 + silent @ self.together)).sum(1) + np.log(self.prior / (1 - self.prior)))
        if gold is not None:
            sure = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
            logit = logit + np.where(gold == 1, sure, np.where(gold == 0, -sure, 0))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


class ToxicityModel:
    """Voters and the weights of the linear classifier."""

    def __init__(self, voters: Voters, weights: np.ndarray, bias: float):
        self.voters, self.weights, self.bias = voters, weights, bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = self.voters.features(texts) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 1200, rate: float = 0.1, decay: float = 1e-5
               ) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam over the whole sample."""
    w, m, s = np.zeros(x.shape[1] + 1), 0.0, 0.0
    x1 = np.hstack([x, np.ones((len(x), 1))])
    for i in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (p - y) / len(y) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - rate * (1 - i / (rounds + 1)) * (m / (1 - 0.9 ** i)) / (np.sqrt(s / (1 - 0.999 ** i)) + 1e-8)
    return w[:-1], float(w[-1])


def unlabelled_sample(docs: DataFrame, usable, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(y, t) of about ``rows`` usable documents, y -1, chosen by a hash of the id; empty texts tell nothing."""
    able = docs.where(usable & (F.length(F.col(text_col).cast("string")) > 0))
    step = max(1, -(-able.count() // rows))
    return able.where(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(2)), F.lit(step)) == 0).select(
        F.lit(-1).alias("y"), F.col(text_col).cast("string").alias("t"))


def fit_model(docs: DataFrame, labels: DataFrame, usable, label: str = "toxic", fit_rows: int = FIT_ROWS,
              id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    sample = labelled_sample(docs, labels, label, usable, fit_rows, id_col, text_col)
    voters = Voters(mine_patterns(sample))

    def vote(batches):
        for b in batches:
            done = 0
            for texts in chunks(b.column(1).cast(pa.string())):
                x = voters.features(texts)
                bits = np.packbits(x[:, :-SHAPES] > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(texts)).cast(pa.int32()), pa.array([r.tobytes() for r in bits], pa.binary()),
                     pa.array([r.tobytes() for r in x[:, -SHAPES:].astype(np.float32)], pa.binary())], names=["y", "v", "s"])
                done += len(texts)

    both = sample.select(F.col(sample.columns[0]).cast("int").alias("y"), F.col(sample.columns[1]).alias("t")).unionByName(
        unlabelled_sample(docs, usable, fit_rows, id_col, text_col))
    rows = both.mapInArrow(vote, "y int, v binary, s binary").collect()
    rows.sort(key=lambda r: (r.y, bytes(r.v), bytes(r.s)))
    k = voters.width - SHAPES
    if not any(r.y >= 0 for r in rows):  # the word lists alone
        return ToxicityModel(voters, np.r_[np.full(k, 4.0), np.zeros(SHAPES)], -2.0)
    votes = np.unpackbits(np.stack([np.frombuffer(bytes(r.v), np.uint8) for r in rows]), axis=1, count=k).astype(float)
    shapes = np.stack([np.frombuffer(bytes(r.s), np.float32) for r in rows]).astype(float)
    gold = np.array([r.y for r in rows])
    post = LabelModel(SILENCE).fit(votes, gold).posterior(votes)
    weights, bias = fit_linear(np.hstack([votes, shapes]), post)
    return ToxicityModel(voters, weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """(row, score): row holds all columns of ``docs``."""
    def run(batches):
        for rows in batches:
            out = [np.empty(0)]
            for texts in chunks(texts_of(rows, text_col)):
                out.append(model.score(texts))
            yield [pa.array(np.concatenate(out))]

    return map_rows(docs, run, StructType.fromDDL("score double"))


def op2_weak_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_model(docs, read_table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    scored = score_toxicity(docs, model).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))
