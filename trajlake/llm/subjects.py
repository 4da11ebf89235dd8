"""Subjects of documents, by their sentences (problem 9)."""

from __future__ import annotations

import copy
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.functions.vectors import bind
from trajlake.plans.storage import cut

#: Where a sentence ends: marks before a blank, empty lines, lines that begin a list. One pattern for Java and regex.
END = r"[.!?…]+[\"'”)\]]*(?=\s|$)|\n\s*\n|\n(?=\s*(?:[-*•#>]|\d+[.)]|\[\d+\])\s*)"
_END, _LETTERS = regex.compile(END), regex.compile(r"\p{L}+")
#: Words of a usual sentence, and words from which a stretch without sentence ends is cut into such pieces.
USUAL, LONG = 11, 20


def sentences(text: str | None) -> list[list[str]]:
    """Words (letters only, folded) of each sentence; stretches without marks are cut into pieces of usual length."""
    out = []
    for part in _END.split(text.lower().replace("ß", "ss")) if text else ():
        w = _LETTERS.findall(part)
        if len(w) > LONG:
            n = round(len(w) / USUAL)
            out.extend(x.tolist() for x in np.array_split(np.array(w, object), n))
        elif w:
            out.append(w)
    return out


def sentence_words(text: Column) -> Column:
    """The same in the JVM: the words of all sentences in a row (`words`), and how many each sentence has (`sizes`)."""
    def pieces(w: Column) -> Column:
        n = F.rint(F.size(w) / float(USUAL)).cast("int")
        size, more = F.floor(F.size(w) / n).cast("int"), F.size(w) % n
        cut_up = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(w, i * size + F.least(i, more) + 1, size + F.when(i < more, 1).otherwise(0)))
        return F.when(F.size(w) > LONG, cut_up).otherwise(F.filter(F.array(w), lambda x: F.size(x) > 0))

    folded = F.replace(F.lower(text), F.lit("\u00df"), F.lit("ss"))
    parts = F.transform(F.split(folded, f"(?U){END}"), lambda x: F.regexp_extract_all(x, F.lit(r"(\p{L}+)"), F.lit(1)))
    every = F.flatten(F.transform(parts, lambda w: bind(w, pieces)))
    return bind(every, lambda e: F.struct(F.flatten(e).alias("words"), F.transform(e, F.size).alias("sizes")))


def tokens(documents: DataFrame, doc: str | None, text: str) -> DataFrame:
    """d, words (joined by blanks) and sizes of every document with a sentence, written once and read by all passes."""
    rows = documents.select(*([F.col(f"`{doc}`").alias("d")] if doc else []), F.col(f"`{text}`").alias("t")).filter("t is not null")
    rows = rows.filter("d is not null") if doc else rows
    own = ["d"] if doc else []
    return cut(rows.select(*own, F.inline(F.array(sentence_words(F.col("t"))))).filter("size(sizes) > 0").select(*own, F.array_join("words", " ").alias("words"), "sizes"))


@dataclass
class Model:
    """Averaged word and subword embeddings with an independent logistic output for each subject."""

    subjects: list[str]
    buckets: int = 1 << 15
    size: int = 16
    seed: int = 0
    attention: dict[str, float] | None = None
    unknown: float = 1.0
    embed: np.ndarray = field(init=False)
    out: np.ndarray = field(init=False)
    bias: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.embed = rng.normal(0, 0.1, (self.buckets, self.size)).astype(np.float32)
        self.out = rng.normal(0, 0.5, (self.size, len(self.subjects))).astype(np.float32)
        self.bias = np.full(len(self.subjects), -2.0, np.float32)

    def features(self, word: str) -> list[int]:
        """Places of a word and of its pieces of 3 to 5 letters, the word itself counting as much as all pieces."""
        w = f"<{word}>"
        return [xxhash.xxh32_intdigest(x, 7) % self.buckets for x in (w, *(w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)))]

    def row(self, words: Sequence[str]) -> tuple[list[int], list[float]]:
        """Features and weights of a sentence; the weights sum to 1 unless no word counts."""
        ids: list[int] = []
        weights: list[float] = []
        for w in words:
            a = self.attention.get(w, self.unknown) if self.attention is not None else 1.0
            if a:
                f = self.features(w)
                ids += f
                weights += [a / 2, *[a / 2 / max(1, len(f) - 1)] * (len(f) - 1)]
        total = sum(weights)
        return ids, [x / total for x in weights] if total else []

    def word_scores(self, word: str) -> np.ndarray:
        f = self.features(word)
        e = self.embed[f]
        return (e[0] / 2 + (e[1:].sum(0) / 2 / max(1, len(f) - 1))) @ self.out

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.out, self.bias]


Row = tuple[Sequence[int], Sequence[float], Sequence[float], float]


def packed(rows: Sequence[Row]) -> tuple[np.ndarray, ...]:
    """Rows of features, weights, labels and weight as flat arrays: places, weights, row of each place, labels, weights."""
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    flat = lambda k, kind: np.concatenate([np.asarray(r[k], kind) for r in rows])
    return flat(0, np.int64), flat(1, np.float32), owner, np.stack([np.asarray(r[2], np.float32) for r in rows]), np.array([r[3] for r in rows], np.float32)


def gradients(model: Model, at: np.ndarray, share: np.ndarray, owner: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float, float]:
    """(touched places, their gradients, of the outputs, of the bias, loss, weight) of packed rows."""
    part = lambda index, values, n: np.stack([np.bincount(index, values[:, k], n) for k in range(values.shape[1])], axis=1).astype(np.float32)
    hidden = part(owner, model.embed[at] * share[:, None], len(y))
    p = 1 / (1 + np.exp(-(hidden @ model.out + model.bias)))
    error = (p - y) * w[:, None]
    back = error @ model.out.T
    own, inverse = np.unique(at, return_inverse=True)
    g = part(inverse, back[owner] * share[:, None], len(own))
    loss = -(w[:, None] * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum()
    return own, g, hidden.T @ error, error.sum(0), float(loss), float(w.sum())


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float) -> None:
        self.rate, self.t = rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, params: list[np.ndarray], grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(params, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


class Scorer:
    """Scores sentences of many documents at once; a word's contribution is computed when it is first met."""

    #: Words that a task remembers; it starts anew beyond.
    MOST = 1 << 18

    def __init__(self, model: Model, least: float, mass: float) -> None:
        self.model, self.floor, self.mass = model, float(np.log(least / (1 - least))), mass
        self.reset()

    def reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.words: list[str] = []
        self.z = np.zeros((1024, len(self.model.subjects)), np.float32)
        self.a = np.zeros(1024, np.float32)

    def id(self, word: str) -> int:
        n = self.ids.get(word)
        if n is None:
            n = self.ids[word] = len(self.words)
            self.words.append(word)
            if n == len(self.a):
                self.z, self.a = np.concatenate([self.z, np.zeros_like(self.z)]), np.concatenate([self.a, np.zeros_like(self.a)])
            a = self.model.attention.get(word, self.model.unknown) if self.model.attention is not None else 1.0
            self.a[n] = a
            if a:
                self.z[n] = self.model.word_scores(word) * a
        return n

    def label(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document of each sentence, its subject or -1, sentence of each word, number of each word)."""
        sizes, words = batch.column("sizes"), pc.split_pattern(batch.column("words"), " ").flatten().dictionary_encode()
        count = np.asarray(sizes.flatten()).astype(np.int64)
        doc = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(sizes)))
        own = np.fromiter(map(self.id, words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        at = own[np.asarray(words.indices)] if len(own) else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(count)), count)
        if not len(doc):
            return doc, doc, owner, at
        starts = np.cumsum(count) - count
        total = np.add.reduceat(self.a[at], starts)
        z = np.add.reduceat(self.z[at], starts, axis=0) / np.maximum(total, 1e-9)[:, None] + self.model.bias
        top = z.argmax(axis=1)
        sure = (total >= self.mass) & (z[np.arange(len(top)), top] >= self.floor)
        return doc, np.where(sure, top, -1), owner, at


def _shares(doc: np.ndarray, subject: np.ndarray, docs: int, subjects: int) -> np.ndarray:
    """Sentences of each document by subject."""
    some = subject >= 0
    return np.bincount(doc[some] * subjects + subject[some], minlength=docs * subjects).reshape(docs, subjects)


def _word_context(shared, least: float, mass: float):
    """For each word the subjects of the other sentences of its documents, added up over a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.subjects)
        scorer, held = Scorer(model, least, mass), np.zeros((1024, k + 1))

        def emit() -> pa.RecordBatch:
            n = np.flatnonzero(held[:, k])
            return pa.RecordBatch.from_arrays([pa.array([scorer.words[i] for i in n], pa.string()), *(pa.array(held[n, j]) for j in range(k + 1))], ["word", *(f"s{j}" for j in range(k)), "n"])

        for b in batches:
            doc, subject, owner, at = scorer.label(b)
            if len(doc):
                by_doc = _shares(doc, subject, b.num_rows, k)
                others = by_doc[doc].astype(float)
                has = np.flatnonzero(subject >= 0)
                others[has, subject[has]] -= 1
                sure = others.sum(axis=1)
                use = sure >= 2
                others = np.where(use[:, None], others / np.maximum(sure, 1)[:, None], 0)
                if len(held) < len(scorer.a):
                    held = np.concatenate([held, np.zeros((len(scorer.a) - len(held), k + 1))])
                for j in range(k):
                    held[:, j] += np.bincount(at, others[owner, j], len(held))
                held[:, k] += np.bincount(at, use[owner], len(held))
            if len(scorer.words) > Scorer.MOST:
                yield emit()
                scorer.reset()
                held = np.zeros((1024, k + 1))
        if held.any():
            yield emit()

    return run


_PACKED = ("at", "share", "owner", "labels", "weight")
_KINDS = ("<i8", "<f4", "<i8", "<f4", "<f4")


def _local_steps(shared, steps: int, rate: float):
    """A partition's parameters after some steps from the common ones: of the places it touches, of the outputs, of the bias."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                model = copy.deepcopy(shared.value)
                at, share, owner, y, w = (np.frombuffer(b.column(c)[i].as_py(), k) for c, k in zip(_PACKED, _KINDS))
                y, best = y.reshape(len(w), -1), Adam(model.parameters(), rate)
                for _ in range(steps):
                    own, g, out, bias, _, weight = gradients(model, at, share, owner, y, w)
                    embed = np.zeros_like(model.embed)
                    embed[own] = g
                    best.step(model.parameters(), [x / weight for x in (embed, out, bias)])
                blobs = (own.astype("<i8"), model.embed[own], model.out, model.bias)
                yield pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in blobs), pa.array([weight])], ["own", "embed", "out", "bias", "weight"])

    return run


def train(model: Model, rows: DataFrame, steps: int, rate: float, together: int) -> Model:
    """Fit by Adam: partitions take `together` steps by the gradients of their rows, then their parameters are averaged.

    Each place of the embeddings is averaged over the partitions that touch it, all by the weight of their rows; as many
    rounds as make up `steps` in all. rows: a row of packed arrays for each partition, which returns at most the model's
    size. A single partition needs no averaging and takes all steps at once.
    """
    spark, parts = rows.sparkSession, rows.count()
    rounds = 1 if parts < 2 else max(1, steps // together)
    for n in range(rounds if parts else 0):
        shared = spark.sparkContext.broadcast(model)
        got = rows.mapInArrow(_local_steps(shared, steps // rounds, rate / (1 + n)), "own binary, embed binary, out binary, bias binary, weight double").collect()
        embed, at, total = np.zeros(model.embed.shape), np.zeros(len(model.embed)), sum(p["weight"] for p in got)
        for p in got:
            own = np.frombuffer(p["own"], "<i8")
            embed[own] += np.frombuffer(p["embed"], "<f4").reshape(-1, model.size) * p["weight"]
            at[own] += p["weight"]
        touched = at > 0
        model.embed[touched] = embed[touched] / at[touched, None]
        mean = lambda k, like: (sum(np.frombuffer(p[k], "<f4").reshape(like.shape) * p["weight"] for p in got) / total).astype(np.float32)
        model.out, model.bias = mean("out", model.out), mean("bias", model.bias)
        shared.destroy()
    return model


@dataclass(frozen=True)
class Settings:
    """`least`: probability from which a sentence has its subject. `low`, `high`: a word's largest share of one subject
    in its documents at which it begins to count, and counts fully. `mass`: counting words that a sentence needs.

    `examples` and `lexicon` bound the labelled rows of a fit: examples (taken in hash order) and words of the corpus
    (most frequent first). A word is in the lexicon if it makes up at least `part` of all words, so there are at most
    1/part, and occurs `often` times. A fit's rows lie in partitions of `rows`, which take `together` steps at a time.
    """

    steps: int = 40
    rate: float = 0.1
    least: float = 0.5
    low: float = 0.38
    high: float = 0.62
    mass: float = 0.9
    rounds: int = 2
    examples: int = 20_000
    lexicon: int = 20_000
    part: float = 5e-6
    often: int = 10
    rows: int = 8_000
    together: int = 10


def _row(model: Model, words: Sequence[str], labels: Sequence[float], weight: float) -> Row:
    return (*model.row(words), labels, weight)


def _rows(spark, rows: Sequence[Row], size: int) -> DataFrame:
    """A bounded number of labelled rows, packed in partitions of at most `size`."""
    some = [r for r in rows if len(r[0])]
    n = -(-len(some) // size)
    data = [tuple(bytearray(x.astype(k).tobytes()) for x, k in zip(packed(some[k::n]), _KINDS)) for k in range(n)]
    return cut(spark.createDataFrame(data, ", ".join(f"{c} binary" for c in _PACKED)).repartition(max(1, n)))


def fit_subjects(documents: DataFrame, examples: DataFrame, settings: Settings = Settings(), *, text: str = "text", subject: str = "subject") -> Model:
    """A model of subjects, from few labelled examples and from all documents (with their text, or what `tokens` gives).

    First the sentences of the examples train the embeddings and outputs. Then, `rounds` times, all documents are
    labelled by sentence, and for each of their words the subjects of the *other* sentences in its documents are added
    up. Words that keep to one subject's documents get that label and attention, the others get none, and both train
    the next model together with the examples' sentences, in which now only words with attention count. So words that
    no example has are learned, and words of general remarks are not.
    """
    spark = documents.sparkSession
    some = examples.filter(F.col(text).isNotNull() & F.col(subject).isNotNull()).select(F.col(text).alias("t"), F.col(subject).alias("s")).distinct().orderBy(F.xxhash64("t"), "s").limit(settings.examples).collect()
    names = sorted({r["s"] for r in some})
    model = Model(names)
    if not names:
        return model
    hot = np.eye(len(names))
    label = {n: hot[i] for i, n in enumerate(names)}
    told = [(w, label[r["s"]], 1.0) for r in some for w in sentences(r["t"])]
    train(model, _rows(spark, [_row(model, *x) for x in told], settings.rows), settings.steps, settings.rate, settings.together)
    corpus = (documents if "sizes" in documents.columns else tokens(documents, None, text)).select("words", "sizes")
    cols = [f"s{j}" for j in range(len(names))]
    for r in range(settings.rounds):
        shared = spark.sparkContext.broadcast(model)
        seen = corpus.mapInArrow(_word_context(shared, settings.least, settings.mass if r else 0.0), "word string, " + ", ".join(f"{c} double" for c in [*cols, "n"])).groupBy("word").agg(*(F.sum(c).alias(c) for c in [*cols, "n"]))
        seen = cut(seen.filter(F.col("n") >= 2))
        every = seen.agg(F.sum("n")).first()[0] or 0
        words = seen.filter(F.col("n") >= max(settings.often, settings.part * every)).toArrow()  # at most 1 / part rows
        n = np.asarray(words["n"])
        part = np.stack([np.asarray(words[c]) for c in cols], axis=1) / n[:, None]
        share = dict(zip(words["word"].to_pylist(), zip(part, n.tolist())))
        attention = {w: float(np.clip((v.max() - settings.low) / (settings.high - settings.low), 0, 1)) for w, (v, _) in share.items()}
        model = Model(names, attention=attention, unknown=0.2, seed=r + 1)
        often = sorted(share, key=lambda w: (-share[w][1], w))[:settings.lexicon]
        plain = Model(names)  # words are learned without their attention
        lexicon = [([w], hot[int(share[w][0].argmax())] if attention[w] > 0.5 else np.zeros(len(names)), 3.0 if attention[w] > 0.5 else 1.0) for w in often if attention[w] == 0 or attention[w] > 0.5]
        rows = _rows(spark, [_row(plain, *x) for x in lexicon] + [_row(model, *x) for x in told if any(attention.get(w, 0) > 0.5 for w in x[0])], settings.rows)
        train(model, rows, settings.steps, settings.rate, settings.together)
        shared.destroy()
    return model


def _score(shared, settings: Settings, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.subjects)
        scorer = Scorer(model, settings.least, settings.mass)
        for b in batches:
            ids = b.column("d")
            by_doc = _shares(*scorer.label(b)[:2], b.num_rows, k)
            doc, subject = np.nonzero(by_doc)
            total = by_doc.sum(axis=1)
            if len(doc):
                n = by_doc[doc, subject]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array([model.subjects[j] for j in subject], pa.string()), pa.array(n, pa.int64()), pa.array(n / total[doc])], list(names))
            if len(scorer.words) > Scorer.MOST:
                scorer.reset()

    return run


def score_subjects(documents: DataFrame, model: Model, settings: Settings = Settings(), *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, subject, sentences, share: every subject of every document, with its part of the sentences that have one.

    documents: with their text, or what `tokens` gives. Null and empty texts and documents without id have no rows;
    repeated rows of a document give equal rows once.
    """
    rows = documents if "sizes" in documents.columns else tokens(documents, doc, text)
    kind = rows.schema["d"].dataType.simpleString()
    if not model.subjects:
        return rows.limit(0).select(F.col("d").alias(doc), F.lit("").alias("subject"), F.lit(0).cast("bigint").alias("sentences"), F.lit(0.0).alias("share"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return rows.select("d", "words", "sizes").mapInArrow(_score(shared, settings, [doc, "subject", "sentences", "share"]), f"`{doc}` {kind}, subject string, sentences bigint, share double").dropDuplicates([doc, "subject", "sentences"])
