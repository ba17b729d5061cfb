"""Language-model scoring with a log-bilinear model, trained in numpy by noise-contrastive estimation.

The model predicts a token's class from the classes of the tokens before it: context vectors, scaled per position, add up to a
prediction vector. The most frequent tokens have classes of their own; the others share classes by shape, within which a token has its
smoothed relative frequency. Classes stand in groups of about equal frequency: the prediction vector's product with a group's vector, plus the group's
bias, is the group's score, and so it is with each class within its group. So the model's probabilities over all training tokens and one unknown token
per shape add up to one. Training needs no normalisation: each true group is told from noise drawn by frequency, and so is each true class from
others of its group. Scoring normalises over all groups, and over all classes of the token's group, with batched matrix products.

Counts cover all training tokens, and so does training: it makes passes over all partitions side by side, each over other positions, until every
position was learned from once, and averages the partitions' parameters by number of positions after each pass. The number of tokens with classes of
their own grows with the square root of the number of distinct tokens.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import isqrt, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rasterweave.llm.common import fold, saved, table, text_bytes

FOLDS = 10
SMOOTH = 0.1
#: Tokens whose counts go to every task; the others' counts are joined.
HEAD = 65_536
#: Tokens with classes of their own: OWN times the square root of the number of distinct tokens, OWN_LEAST at least.
OWN, OWN_LEAST = 2, 1023
SHAPES = 128
CONTEXT = 5
WIDTH = 16
BATCH = 2048
#: Groups drawn as noise for a minibatch, and classes for each of its groups.
NOISE, NOISE_WITHIN = 16, 3
#: Share of the positions that one pass learns from; together the passes learn from each once.
RATE = 1.0
PASSES = round(1 / RATE)
STRETCH = 256
STEP = 0.12
END = b""
FLUSH = 300_000
AVERAGED = 32
#: Tokens of a batch in scoring.
SCORED = 8192


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), then the end."""
    return [*text.lower().split(), END]


def _shape(last: int, before: int) -> int:
    """By how a word ends: a letter, a sentence mark, a digit or something else; and by its last letter, that before the mark or sign if it ends in one."""
    mark = last in b".,;:!?"
    end = 1 if mark else 2 if 48 <= last <= 57 else 0 if 97 <= last <= 122 or last >= 128 else 3
    letter = before if end in (1, 3) else last
    return 32 * end + (letter - 97 if 97 <= letter <= 122 else 26 if 48 <= letter <= 57 else 27 + letter % 4 if letter >= 128 else 31)


#: Shape by the last two bytes, as a little-endian number.
_SHAPES = np.array([_shape(x >> 8, x & 255) for x in range(1 << 16)], dtype=np.int64)


def shapes(words: list[bytes]) -> np.ndarray:
    """0 to SHAPES - 1 for each word; a word of one byte counts as if a space stood before it."""
    return _SHAPES[np.frombuffer(b"".join([w[-2:] if len(w) > 1 else b" " + w for w in words]), dtype="<u2")]


def token_counts(texts: DataFrame) -> DataFrame:
    """word, c over all texts; counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                counts.update(tokens_of(text))
                if len(counts) > FLUSH:
                    yield pack()
                    counts.clear()
        if counts:
            yield pack()

    return texts.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Tokens and classes, these by descending frequency.

    classes, logs: class, and log10(c + SMOOTH), of each of the head's tokens. shapes: the class of each shape. mass: of a shape's class, sum of
    c + SMOOTH with one unknown token; 1 for other classes. bounds: of the groups, ranges of classes.
    """

    numbers: dict[bytes, int]
    classes: np.ndarray
    logs: np.ndarray
    shapes: np.ndarray
    mass: np.ndarray
    frequency: np.ndarray
    bounds: np.ndarray
    tokens: int
    distinct: int

    @property
    def own(self) -> int:
        return len(self.frequency) - len(self.shapes)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number in the head, -1 for others, and its class."""
        number = np.fromiter(map(self.numbers.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        found = self.classes[number] if len(self.classes) else np.zeros(len(words), dtype=np.int64)
        if len(unknown := np.flatnonzero(number < 0)):
            found[unknown] = self.shapes[shapes([words[i] for i in unknown.tolist()])]
        return number, found


def grouped(frequency: np.ndarray) -> np.ndarray:
    """Bounds of groups of classes, by descending frequency: as many as the square root of their number, of equal frequency as far as may be."""
    before = np.cumsum(frequency) - frequency
    group = np.minimum((before / frequency.sum() * isqrt(len(frequency))).astype(np.int64), isqrt(len(frequency)) - 1)
    return np.append(np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))), len(frequency))


def most_frequent(counts: DataFrame, most: int) -> list[Row]:
    """The tokens of the highest counts, most at most, by descending count: all that reach a count which few enough do. The count is found by steps of an eighth of its magnitude, so no task sends its own highest ones to the driver."""
    step = F.floor(F.log2("c") * 8)
    at_step = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.step)  # some hundred rows
    least, total = None, 0
    for r in at_step:
        total += r.n
        if total > most:
            break
        least = r.step
    if least is None:  # more tokens of one magnitude than that
        return counts.orderBy(F.col("c").desc(), "word").limit(most).collect()
    return sorted(counts.where(step >= least).collect(), key=lambda r: (-r.c, bytes(r.word)))


def vocabulary(counts: DataFrame, head: int = HEAD, own: int | None = None) -> Vocabulary:
    total = counts.agg(F.sum("c"), F.count("*")).first()
    top = most_frequent(counts, head)
    words, c = [bytes(r.word) for r in top], [float(r.c) for r in top]
    own = max(1, min(max(OWN_LEAST, OWN * isqrt(total[1])) if own is None else own, len(words)))
    if END not in words[:own]:  # the end has a class of its own whatever its rank
        apart = [*words[: own - 1], END]
    else:
        apart = words[:own]
    apart_numbers = {w: i for i, w in enumerate(apart)}
    own = len(apart)

    def class_of(words: list[bytes]) -> np.ndarray:
        k = np.fromiter(map(apart_numbers.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        rest = np.flatnonzero(k < 0)
        k[rest] = own + shapes([words[i] for i in rest.tolist()])
        return k

    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(class_of(batch.column(0).to_pylist())), batch.column(1)], names=["k", "c"])

    by_class = counts.mapInArrow(shaped, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    mass, frequency = np.full(own + SHAPES, SMOOTH), np.full(own + SHAPES, 0.5)
    for r in by_class:
        mass[r.k] += r.c + SMOOTH * r.v
        frequency[r.k] += r.c
    mass[:own] = 1.0
    order = np.argsort(-frequency, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    if END not in words:
        words, c = [*words, END], [*c, 0.0]
    classes = place[class_of(words)]
    frequency = frequency[order] / frequency.sum()
    return Vocabulary({w: i for i, w in enumerate(words)}, classes, np.log10(np.array(c) + SMOOTH), place[own:], mass[order], frequency, grouped(frequency), int(total[0] or 0), int(total[1]))


Parameters = list[np.ndarray]  # context vectors (one more for before the text), scale per position, vectors and biases of classes, vectors and biases of groups


def initial(frequency: np.ndarray, bounds: np.ndarray) -> Parameters:
    draw = np.random.default_rng(1)
    k, mass = len(frequency), np.add.reduceat(frequency, bounds[:-1])
    small = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
    within = np.log(frequency / np.repeat(mass, np.diff(bounds))).astype(np.float32)
    return [small(k + 1, WIDTH), np.full((CONTEXT, WIDTH), 1 / CONTEXT, np.float32), small(k, WIDTH), within, small(len(mass), WIDTH), np.log(mass).astype(np.float32)]


def by_number(numbers: np.ndarray) -> np.ndarray:
    """Their stable order; numbers of 16 bits, which most are, take numpy's radix sort."""
    return np.argsort(numbers.astype(np.uint16) if len(numbers) and numbers.max() < 1 << 16 else numbers, kind="stable")


def by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct row numbers, and the sum of the values of each."""
    order = by_number(rows)
    own = rows[order]
    begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    return own[begins], np.add.reduceat(values[order], begins, axis=0)


def slopes(true: np.ndarray, false: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the loss by the log odds of the true ones, and of the noise, for a mean over the true ones."""
    n = np.float32(len(true))
    return (-1 / (1 + np.exp(np.clip(true, -30, 30)))) / n, (1 / (1 + np.exp(-np.clip(false, -30, 30)))) / n


def windows(rows: np.ndarray) -> np.ndarray:
    """Each CONTEXT consecutive rows, nearest to the end first."""
    return np.lib.stride_tricks.sliding_window_view(rows, CONTEXT, axis=0).transpose(0, 2, 1)[:, ::-1]


def summed(rows: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Of each CONTEXT consecutive rows, the sum by scale, whose first is for the last row."""
    n = max(len(rows) - CONTEXT + 1, 0)
    out = rows[CONTEXT - 1 :] * scale[0]
    for j in range(1, CONTEXT):
        out += rows[CONTEXT - 1 - j : CONTEXT - 1 - j + n] * scale[j]
    return out


class Trainer:
    """Noise-contrastive estimation by minibatches of stretches of text, with steps scaled per parameter by past gradients."""

    def __init__(self, start: Parameters, frequency: np.ndarray, bounds: np.ndarray, seed: int):
        self.p = [x.astype(np.float32) for x in start]
        self.past = [np.full_like(x, 1e-2) for x in self.p]
        self.draw, self.seen = np.random.default_rng(seed), 0
        self.mass, self.upto, self.bounds = np.add.reduceat(frequency, bounds[:-1]), np.concatenate(([0], np.cumsum(frequency))), bounds
        self.group = np.repeat(np.arange(len(self.mass)), np.diff(bounds))
        self.odds = np.log(NOISE * self.mass).astype(np.float32)
        self.odds_within = np.log(NOISE_WITHIN * frequency / self.mass[self.group]).astype(np.float32)

    def step(self, which: int, rows: np.ndarray, gradient: np.ndarray) -> None:
        gradient = gradient * np.float32(30)
        past = self.past[which][rows] + gradient * gradient
        self.past[which][rows] = past
        self.p[which][rows] -= np.float32(STEP) * gradient / np.sqrt(past)

    def noise(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups by frequency, and classes of every group by their frequency within it."""
        groups = np.searchsorted(self.upto[self.bounds[1:-1]], self.draw.random(NOISE), side="right")
        at = self.upto[self.bounds[:-1], None] + self.draw.random((len(self.mass), NOISE_WITHIN)) * self.mass[:, None]
        within = np.searchsorted(self.upto, at, side="right") - 1
        return groups, np.clip(within, self.bounds[:-1, None], self.bounds[1:, None] - 1)

    def learn(self, flat: np.ndarray, places: np.ndarray) -> None:
        """flat: stretches of classes in a row, each after the CONTEXT classes before it; places: of the classes to predict."""
        e, c, q, b, u, a = self.p
        last = len(flat)
        vectors = e[flat]
        before = windows(vectors[:-1])  # of the CONTEXT tokens before each place from CONTEXT on
        places = places[by_number(self.group[flat[places]])]  # by group
        predicted = summed(vectors[:-1], c)[places - CONTEXT]
        target, (other, within) = flat[places], self.noise()
        group = self.group[target]
        own, begins = np.unique(group, return_index=True)
        # groups
        u_group, u_other = u[group], u[other]
        g_true, g_false = slopes(np.einsum("ij,ij->i", predicted, u_group) + a[group] - self.odds[group], predicted @ u_other.T + (a[other] - self.odds[other]))
        back = g_true[:, None] * u_group + g_false @ u_other
        self.add(4, 5, np.concatenate((group, other)), np.concatenate((g_true[:, None] * predicted, g_false.T @ predicted)), np.concatenate((g_true, g_false.sum(0))))
        # classes within the groups
        q_target, q_within = q[target], q[within][group]
        false = np.einsum("nw,nmw->nm", predicted, q_within) + (b[within] - self.odds_within[within])[group]
        g_true, g_false = slopes(np.einsum("ij,ij->i", predicted, q_target) + b[target] - self.odds_within[target], false)
        back += g_true[:, None] * q_target + np.einsum("nm,nmw->nw", g_false, q_within)
        ends = [*begins[1:].tolist(), len(group)]
        to_noise = np.concatenate([g_false[i:j].T @ predicted[i:j] for i, j in zip(begins.tolist(), ends, strict=True)])
        self.add(2, 3, np.concatenate((target, within[own].ravel())), np.concatenate((g_true[:, None] * predicted, to_noise)), np.concatenate((g_true, np.add.reduceat(g_false, begins, axis=0).ravel())))
        # contexts
        spread = np.zeros((last + CONTEXT, WIDTH), np.float32)
        spread[places] = back
        self.step(1, np.arange(CONTEXT), np.einsum("nw,njw->jw", spread[CONTEXT:last], before))
        to_vectors = summed(spread[1:], c[::-1])  # of the CONTEXT places after each token
        self.step(0, *by_row(flat, to_vectors))
        self.seen += len(places)

    def add(self, vectors: int, biases: int, rows: np.ndarray, to_vectors: np.ndarray, to_biases: np.ndarray) -> None:
        rows, sums = by_row(rows, np.concatenate((to_vectors, to_biases[:, None]), axis=1))
        self.step(vectors, rows, sums[:, :-1])
        self.step(biases, rows, sums[:, -1])


def laid_out(docs: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes of some documents in a row with CONTEXT pads before each, and the places of the tokens."""
    gap = np.full(CONTEXT, pad, dtype=np.int64)
    flat = np.concatenate([x for d in docs for x in (gap, d)])
    return flat, np.flatnonzero(flat != pad)


def trained(texts: DataFrame, vocab: Vocabulary, passes: int = PASSES, rate: float = RATE) -> Parameters:
    """Parameters after passes over all texts; at each pass every partition starts from the last average and learns from a rate of its tokens, in stretches; 1 / rate passes take them all."""
    spark = texts.sparkSession
    sent, now = spark.sparkContext.broadcast(vocab), initial(vocab.frequency, vocab.bounds)
    for turn in range(passes):

        def run(batches: Iterator[pa.RecordBatch], now=now, turn=turn) -> Iterator[pa.RecordBatch]:
            vocab, part = sent.value, TaskContext.get().partitionId()
            trainer, pad, every = Trainer(now, vocab.frequency, vocab.bounds, 1000 * turn + part), len(vocab.frequency), round(1 / rate)
            held, size, at = [], 0, 0

            def learn() -> None:
                """Stretches from all over what is held make a minibatch."""
                order, own = trainer.draw.permutation(len(held)).tolist(), []
                while order:
                    own.append(held[order.pop()])
                    if not order or sum(map(len, own)) >= BATCH:
                        ends = np.cumsum([len(h) for h in own])
                        head = (ends - [len(h) for h in own])[:, None] + np.arange(CONTEXT)
                        is_place = np.ones(ends[-1], dtype=bool)
                        is_place[head.ravel()] = False
                        trainer.learn(np.concatenate(own), np.flatnonzero(is_place))
                        own = []

            for batch in batches:
                for text in text_bytes(batch.column(0)):
                    words = tokens_of(text)
                    classes = vocab.look_up(words)[1]
                    # of the partition's tokens, stretches at a fixed rate; each pass takes others
                    for k in range(at // STRETCH, (at + len(words) - 1) // STRETCH + 1):
                        if k % every == turn % every:
                            a, b = max(0, k * STRETCH - at), min(len(words), (k + 1) * STRETCH - at)
                            seen = classes[max(0, a - CONTEXT) : b]
                            held.append(np.concatenate((np.full(CONTEXT + b - a - len(seen), pad, dtype=np.int64), seen)))
                            size += b - a
                    at += len(words)
                    if size > 100_000:
                        learn()
                        held, size = [], 0
            if held:
                learn()
            flat = np.concatenate([x.ravel() for x in trainer.p]).astype(np.float32)
            if trainer.seen:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([float(trainer.seen)]), pa.array([flat.tobytes()], pa.binary())], names=["part", "weight", "parameters"])

        rows = saved(texts.mapInArrow(run, "part bigint, weight double, parameters binary"), "parameters")
        while rows.count() > 1:  # averages of up to AVERAGED neighbours, again and again: one set of parameters comes to the driver
            rows = saved(rows.withColumn("part", F.floor(F.col("part") / AVERAGED)).groupBy("part").applyInArrow(averaged, rows.schema), "averages")
        if mean := rows.toArrow().to_pylist():
            flat, out, at = np.frombuffer(mean[0]["parameters"], np.float32), [], 0
            for x in now:
                out.append(flat[at : at + x.size].reshape(x.shape))
                at += x.size
            now = out
    return now


def averaged(rows: pa.Table) -> pa.Table:
    """One row: the mean of the parameters by weight."""
    total, weight = 0.0, 0.0
    for w, p in zip(rows.column("weight").to_pylist(), rows.column("parameters").to_pylist(), strict=True):
        total = total + w * np.frombuffer(p, np.float32).astype(np.float64)
        weight += w
    kept = rows.slice(0, 1 if weight else 0)
    if not weight:
        return kept
    return pa.table([kept.column("part"), pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=rows.column_names)


def normalised(true: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Log probability of the true score of each row of scores."""
    with np.errstate(over="ignore", divide="ignore"):
        total = np.log(np.exp(scores) @ np.ones(scores.shape[1], scores.dtype))
    for k in np.flatnonzero(~np.isfinite(total)).tolist():  # beyond what the numbers hold: once more, from the largest score
        total[k] = scores[k].max() + np.log(np.exp(scores[k] - scores[k].max()).sum())
    return true.astype(float) - total


def class_logs(parameters: Parameters, bounds: np.ndarray, flat: np.ndarray, places: np.ndarray) -> np.ndarray:
    """log10 probability of the class at each place, normalised over all groups and all classes of its group. The CONTEXT classes before each place stand in flat."""
    e, c, q, b, u, a = parameters
    out, group_of = np.empty(len(places)), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for i in range(0, len(places), SCORED):
        own = places[i : i + SCORED]
        first, last = own[0] - CONTEXT, own[-1] + 1
        vectors, target = e[flat[first:last]], flat[own]
        group = group_of[target]
        order = by_number(group)  # the rows of a group stand together
        group, target = group[order], target[order]
        predicted = summed(vectors[:-1], c)[(own - own[0])[order]]
        scores = predicted @ u.T + a
        logs = normalised(scores[np.arange(len(own)), group], scores)
        cuts = np.flatnonzero(np.diff(group)) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)], strict=True):
            low, high = bounds[group[first]], bounds[group[first] + 1]
            if high - low > 1:
                scores = predicted[first:last] @ q[low:high].T + b[low:high]
                logs[first:last] += normalised(scores[np.arange(last - first), target[first:last] - low], scores)
        out[i + order] = logs / np.log(10)
    return out


PART_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, tail array<struct<word:binary,n:bigint>>"


def part_scores(docs: DataFrame, vocab: Vocabulary, parameters: Parameters) -> DataFrame:
    """What each document's scores are but for the counts of the tokens in tail, those outside the head."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab, parameters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, parameters = sent.value
        pad, rest = len(vocab.frequency), log10(vocab.tokens + SMOOTH * (vocab.distinct + 1))
        known = vocab.logs > log10(SMOOTH) + 1e-12
        in_shape = np.where(np.isin(np.arange(pad), vocab.shapes), np.log10(vocab.mass), np.nan)

        def settled(rows: pa.RecordBatch, held: list[tuple[np.ndarray, np.ndarray, Counter]]) -> pa.RecordBatch:
            number, own = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            sizes = np.array([len(h[0]) for h in held])
            begins = np.cumsum(sizes) - sizes
            logs = class_logs(parameters, vocab.bounds, *laid_out([h[1] for h in held], pad))
            count = np.where(number >= 0, vocab.logs[number], 0.0)
            shared = ~np.isnan(in_shape[own])
            logs[shared] += (count - in_shape[own])[shared]
            summed = lambda x: pa.array(np.add.reduceat(x, begins))
            tail = pa.StructArray.from_arrays([pa.array([w for h in held for w in h[2]], pa.binary()), pa.array([n for h in held for n in h[2].values()], pa.int64())], names=["word", "n"])
            ends = pa.array(np.cumsum([0, *(len(h[2]) for h in held)]), pa.int32())
            columns = [rows.column(0), rows.column(2), pa.array(sizes), summed(((number >= 0) & known[number]).astype(np.int64)), pa.array(np.add.reduceat(count, begins) - sizes * rest), summed(logs), pa.ListArray.from_arrays(ends, tail)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail"])

        for batch in batches:
            texts, held, size, begin = text_bytes(batch.column(1)), [], 0, 0
            for i, text in enumerate(texts):
                words = tokens_of(text)
                number, own = vocab.look_up(words)
                held.append((number, own, Counter(words[k] for k in np.flatnonzero(number < 0).tolist())))
                size += len(words)
                if size > 50_000 or i + 1 == len(texts):
                    yield settled(batch.slice(begin, len(held)), held)
                    held, size, begin = [], 0, i + 1

    return docs.mapInArrow(run, PART_SCHEMA)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: log10 probabilities of whole texts, by token counts and by the model.

    It learns from the documents outside fold 0 of crc32(id). Null and empty texts are one token, the end; a null id is held out; repeated rows each count and each get
    their row. Without training documents every token is unknown. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), (fold(F.col(id_col), folds) == 0).alias("held_out"))
    learning = rows.where(~F.col("held_out")).select("text")
    counts = saved(token_counts(learning), "counts")
    vocab = vocabulary(counts)
    parts = saved(part_scores(rows, vocab, trained(learning, vocab)).withColumn("row", F.monotonically_increasing_id()), "parts")
    tail = parts.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("n"))
    joined = tail.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more"))
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return parts.drop("tail").join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(vocab.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
