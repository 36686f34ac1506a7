"""Toxic spans and document scores by a linear-chain conditional random field.

Labels come by document. A word of a toxic sample document counts as labelled toxic if one of its
features (the word, its prefixes and suffixes) is about as telling of toxic documents as any in
that document. The field is fitted to these words, in chains of up to ``CHAIN`` words, by gradient
ascent on the conditional likelihood. Scoring takes all chains of a whole text: marginals give
the offending offsets, and the probability that any word is toxic, calibrated with the number of
words, on documents of all lengths and with the classes at their true shares, gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import BATCH_BYTES, MEMO_SIZE, byte_slices

#: Labelled documents of each class, at most, that the field is fitted to (of so many characters
#: at most) and that it is calibrated on (of any length).
SAMPLE_DOCUMENTS = 1500
SAMPLE_CHARACTERS = 12_000
CHAIN = 64
WIDTH = 1 << 18
ROUNDS = 40
#: Least evidence (likelihood ratio) for a feature to tell toxic documents.
EVIDENCE = 8.0
#: Words of so many sample documents speak for themselves; affixes are judged by rarer words.
COMMON = 20
RESULT = ("score", "predicted", "spans")
_SCRAMBLES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    named = ["w" + word]
    named += [f"p{n}" + word[:n] for n in (3, 4, 5) if len(word) > n]
    return named + [f"s{n}" + word[-n:] for n in (3, 4) if len(word) > n]


def _slots(word: str) -> list[int]:
    return [zlib.crc32(name.encode()) % WIDTH for name in features(word)]


def marginals(
    emissions: np.ndarray,
    real: np.ndarray,
    start: np.ndarray,
    move: np.ndarray,
    transitions: bool = False,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains, one a row, all at once.

    Returns each word's probability of label 1, the log-probability that all words of a chain
    have label 0, and, on request, the expected transitions, summed. ``emissions`` favour label 1 over 0.
    """
    n, length = emissions.shape
    weight = np.exp(np.clip(emissions, -40, 40))
    step = np.exp(move)
    ahead = np.empty((length, n, 2))
    scale = np.ones((length, n))
    now = np.exp(start) * np.stack([np.ones(n), weight[:, 0]], 1)
    for t in range(length):
        if t:
            new = now @ step
            new[:, 1] *= weight[:, t]
            now = np.where(real[:, t, None], new, now)
        scale[t] = now.sum(1)
        now = now / scale[t][:, None]
        ahead[t] = now
    log_total = np.log(scale).sum(0)
    words = real.sum(1)
    all_zero = start[0] + (words - 1) * move[0, 0] - log_total
    expected = np.zeros((2, 2))
    back = np.ones((n, 2))
    toxic = np.empty((n, length))
    for t in range(length - 1, -1, -1):
        both = ahead[t] * back
        toxic[:, t] = both[:, 1] / both.sum(1)
        if t:
            onward = back * np.stack([np.ones(n), weight[:, t]], 1)
            if transitions:
                pair = ahead[t - 1][:, :, None] * step * onward[:, None, :]
                pair *= (real[:, t] / pair.sum((1, 2)))[:, None, None]
                expected += pair.sum(0)
            older = onward @ step.T
            back = np.where(real[:, t, None], older / older.sum(1)[:, None], back)
    return toxic, all_zero, expected


def _padded(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of documents laid out in chains: values, which are real, and a chain's document."""
    chains = -(-sizes // CHAIN)
    document = np.repeat(np.arange(len(sizes)), chains)
    nth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.cumsum(chains) - chains, sizes) + nth // CHAIN
    values = np.zeros((int(chains.sum()), CHAIN), flat.dtype)
    real = np.zeros(values.shape, bool)
    values[row, nth % CHAIN] = flat
    real[row, nth % CHAIN] = True
    return values, real, document


@dataclass
class Model:
    """The fitted field; without both classes in the sample it only knows their share."""

    prior: float
    weights: np.ndarray | None = None
    start: np.ndarray | None = None
    move: np.ndarray | None = None
    calibration: tuple[float, float, float] = (1.0, 0.0, 0.0)
    memo: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def _learn(self, words: list[str]) -> None:
        slots = [_slots(word) for word in words]
        first = np.cumsum([0, *(len(s) for s in slots[:-1])])
        weights = self.weights[np.array([s for some in slots for s in some])]
        self.memo.update(zip(words, np.add.reduceat(weights, first).tolist(), strict=True))

    def documents(
        self, texts: list[str]
    ) -> Iterator[tuple[float, list[tuple[int, int, float]], int]]:
        """(raw log-odds of any toxic word, spans, number of words) of each text."""
        words = [WORD.findall(text.lower()) for text in texts]
        if len(self.memo) > MEMO_SIZE:
            self.memo.clear()
        memo = self.memo
        if missing := [word for word in set().union(*words) if word not in memo]:
            self._learn(missing)
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.fromiter((memo[w] for some in words for w in some), float, int(sizes.sum()))
        values, real, document = _padded(flat, sizes)
        clear = np.zeros(len(texts))
        hits: dict[int, list[tuple[int, float]]] = {}
        if len(values):
            toxic, all_zero, _ = marginals(values, real, self.start, self.move)
            clear = np.bincount(document, np.minimum(all_zero, 0), len(texts))
            first = np.searchsorted(document, document)
            for row, t in np.argwhere((toxic >= 0.5) & real).tolist():
                place = (row - int(first[row])) * CHAIN + t
                hits.setdefault(int(document[row]), []).append((place, float(toxic[row, t])))
        for at, text in enumerate(texts):
            any_toxic = -math.expm1(min(clear[at], -1e-12))
            odds = math.log(any_toxic) - max(clear[at], -700.0)
            yield odds, self._spans(text, hits[at]) if at in hits else [], int(sizes[at])

    @staticmethod
    def _spans(text: str, hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
        # Lower case may be longer than the text: then offsets follow the words of the text itself.
        places = [m.span() for m in WORD.finditer(text)]
        spans: list[tuple[int, int, float]] = []
        before = -2
        for place, chance in hits:
            begin, end = places[min(place, len(places) - 1)]
            if place == before + 1:
                spans[-1] = (spans[-1][0], end, max(spans[-1][2], chance))
            else:
                spans.append((begin, end, chance))
            before = place
        return spans

    def score(self, odds: float, words: int) -> float:
        slope, shift, length = self.calibration
        raw = slope * odds + shift + length * math.log(words) if words else -60.0
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, raw))))


def _evidence(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Likelihood ratio of the features that are likelier in toxic documents."""
    found = {}
    share = n_toxic / (n_toxic + n_clean)
    for name, a in toxic.items():
        b = clean[name]
        if a * n_clean > b * n_toxic:
            both = a + b
            ratio = a * math.log(a / (both * share))
            ratio += b * math.log(b / (both * (1 - share))) if b else 0
            if 2 * ratio >= EVIDENCE:
                found[name] = 2 * ratio
    return found


def _without_copies(words: list[list[str]]) -> list[int]:
    """Places of documents that share none of four minimal word triples with an earlier one.

    Copies of one document would make all of its words look telling.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for place, some in enumerate(words):
        triples = zip(some, some[1:], some[2:], strict=False) if len(some) > 2 else [tuple(some)]
        hashed = np.array([zlib.crc32(" ".join(t).encode()) for t in triples], np.uint64)
        keys = {(k, int((hashed * np.uint64(_SCRAMBLES[k]) & np.uint64(0xFFFFFFFF)).min())) for k in range(4)}
        if not keys & seen:
            kept.append(place)
        seen |= keys
    return kept


def fit(
    texts: list[str],
    labels: list[int],
    rounds: int = ROUNDS,
    of_class: Mapping[int, int] | None = None,
) -> Model:
    """The field of a sample of labelled documents; of copies the first one counts.

    ``of_class`` has the number of documents of each class the sample stands for (``counted``);
    without it the sample's own shares are taken as the true ones.
    """
    model = Model(sum(labels) / len(labels) if labels else 0.0)
    words = [WORD.findall(text.lower()) for text in texts]
    kept = _without_copies(words)
    texts, labels, words = ([a[k] for k in kept] for a in (texts, labels, words))
    n_toxic = sum(labels)
    counts = (Counter(), Counter())
    common = Counter(word for some in words for word in set(some))
    of_word = {w: features(w)[: 1 if n >= COMMON else None] for w, n in common.items()}
    for some, label in zip(words, labels, strict=True):
        counts[label].update({name for word in set(some) for name in of_word[word]})
    if not counts[0] or not counts[1]:
        return model
    telling = _evidence(counts[1], counts[0], n_toxic, len(labels) - n_toxic)
    vocabulary = {word: k for k, word in enumerate(of_word)}
    strength = np.array([max(telling.get(f, 0.0) for f in of_word[w]) for w in vocabulary])
    slots = [_slots(word) for word in vocabulary]
    slot_word = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    slot = np.array([s for some in slots for s in some])

    flat = np.array([vocabulary[w] for some in words for w in some], np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    document = np.repeat(np.arange(len(words)), sizes)
    most = np.zeros(len(words))
    np.maximum.at(most, document, strength[flat])
    gold = np.array(labels)[document] & (strength[flat] >= np.maximum(EVIDENCE, most[document] / 4))
    ids, real, _ = _padded(flat, sizes)
    truth, _, _ = _padded(gold.astype(np.int64), sizes)
    pairs = np.zeros((2, 2))
    inner = real[:, 1:]
    np.add.at(pairs, (truth[:, :-1][inner], truth[:, 1:][inner]), 1)
    firsts = np.bincount(truth[:, 0], minlength=2)

    weights, start, move = np.zeros(WIDTH), np.zeros(2), np.zeros((2, 2))
    model.weights, model.start, model.move = weights, start, move
    used = np.bincount(slot, np.bincount(flat, minlength=len(slots))[slot_word], WIDTH)
    pace = 1 / np.sqrt(np.maximum(used, 1))
    wanted = np.bincount(ids[real], truth[real], len(slots))
    # Ascent with momentum; each feature's pace falls with its frequency.
    moving = [np.zeros(WIDTH), np.zeros(2), np.zeros((2, 2))]
    edge = 1 / math.sqrt(max(len(flat), 1))
    for _ in range(rounds):
        emission = np.bincount(slot_word, weights[slot], len(slots))
        toxic, _, expected = marginals(emission[ids], real, start, move, True)
        open_words = wanted - np.bincount(ids[real], toxic[real], len(slots))
        slopes = (
            np.bincount(slot, open_words[slot_word], WIDTH) - 0.05 * weights,
            firsts - np.array([(1 - toxic[:, 0]).sum(), toxic[:, 0].sum()]) - 0.05 * start,
            pairs - expected - 0.05 * move,
        )
        for held, slope, value, rate in zip(
            moving, slopes, (weights, start, move), (pace, edge, edge), strict=True
        ):
            held *= 0.8
            held += 0.3 * np.clip(slope * rate, -1, 1)
            value += held
    found = [(o, n) for o, _, n in model.documents(list(texts))]
    model.calibration = _calibrate(*np.array(found).T, np.array(labels), of_class)
    model.memo.clear()
    return model


def _weights(labels: np.ndarray, of_class: Mapping[int, int] | None) -> np.ndarray:
    """Weights, 1 on average, by which both classes have the shares they have in ``of_class``."""
    drawn = np.bincount(labels, minlength=2)
    held = np.array([of_class.get(0, 0), of_class.get(1, 0)]) if of_class else drawn
    if not drawn.all() or not held.all():
        return np.ones(len(labels))
    return (held / held.sum() * len(labels) / drawn)[labels]


def _calibrate(
    odds: np.ndarray, words: np.ndarray, labels: np.ndarray, of_class: Mapping[int, int] | None
) -> tuple[float, float, float]:
    """Slope, shift and weight of log(words) of a logistic curve; the slope stays positive.

    The chance of any toxic word adds up over the words, which the third one makes up for. All are
    held back by a small penalty. Texts without a word do not count, their score is fixed.
    """
    some = words > 0
    odds, words, labels = odds[some], words[some], labels[some]
    weights = _weights(labels, of_class)
    middle = float(np.log(words).mean()) if len(words) else 0.0
    inputs = np.stack([odds, np.ones(len(odds)), np.log(words) - middle], 1)
    held, wanted = np.array([1.0, 0.0, 0.0]), np.array([1.0, 0.0, 0.0])

    def loss(at: np.ndarray) -> float:
        raw = inputs @ at
        return weights @ (np.logaddexp(0, raw) - labels * raw) + 0.05 * ((at - wanted) ** 2).sum()

    # Newton steps, halved until they help; a slope that falls below its bound stays there.
    for free in (np.arange(3), np.arange(1, 3)):
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(inputs @ held, -60, 60)))
            down = (inputs.T @ (weights * (labels - p)) - 0.1 * (held - wanted))[free]
            curve = (inputs * (weights * p * (1 - p))[:, None]).T @ inputs + 0.1 * np.eye(3)
            step = np.zeros(3)
            step[free] = np.linalg.solve(curve[np.ix_(free, free)], down)
            now = loss(held)
            while np.abs(step).max() > 1e-9 and loss(held + step) > now:
                step /= 2
            if np.abs(step).max() <= 1e-9:
                break
            held = held + step
        if held[0] >= 0.05:
            break
        held[0] = 0.05
    slope, shift, length = held.tolist()
    return slope, shift - length * middle, length


def _marked(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    return (
        labels.select(
            F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label")
        )
        .where("_id IS NOT NULL AND _label IN (0, 1)")
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )


def _chosen(labels: DataFrame, id_column: str, label_column: str, documents: int) -> DataFrame:
    marked = _marked(labels, id_column, label_column)
    chosen = None
    for label in (0, 1):
        some = marked.where(F.col("_label") == label)
        some = some.orderBy(F.xxhash64("_id"), "_id").limit(documents)
        chosen = some if chosen is None else chosen.unionByName(some)
    return chosen


def counted(
    labels: DataFrame, *, id_column: str = "doc_id", label_column: str = "toxic"
) -> dict[int, int]:
    """The number of labelled ids of each class, of all that ``sample`` draws from."""
    classes = _marked(labels, id_column, label_column).groupBy("_label").count()
    return {r["_label"]: r["count"] for r in classes.collect()}


def sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    documents: int = SAMPLE_DOCUMENTS,
    characters: int = SAMPLE_CHARACTERS,
) -> tuple[list[str], list[int]]:
    """At most ``documents`` labelled texts of each class, those with the smallest hashed ids.

    Ids are chosen from the labels alone; longer texts than ``characters`` are passed over, as
    are ids that are null, repeated labels, and labels other than 0 and 1.
    """
    chosen = _chosen(labels, id_column, label_column, documents)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).where(
        (F.length("_text") > 0) & (F.length("_text") <= characters)
    )
    found = texts.join(F.broadcast(chosen), "_id")  # at most twice ``documents`` ids
    rows = sorted(
        found.select("_id", "_text", "_label").dropDuplicates(["_id"]).collect(),
        key=lambda r: str(r["_id"]),
    )
    return [r["_text"] for r in rows], [r["_label"] for r in rows]


def calibrated(
    model: Model,
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    documents: int = SAMPLE_DOCUMENTS,
    batch_bytes: int = BATCH_BYTES,
) -> Model:
    """``model`` calibrated on at most ``documents`` labelled texts of each class, of any length.

    The ids are those ``sample`` starts from. Their texts are scored whole in Spark tasks; three
    numbers of each reach the driver. Of repeated ids the first text in order counts. Without
    scored texts of both classes the model stays as it is.
    """
    if model.weights is None:
        return model
    chosen = F.broadcast(_chosen(labels, id_column, label_column, documents))
    texts = (
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
        .where(F.length("_text") > 0)
        .join(chosen, "_id")  # at most twice ``documents`` ids
        .groupBy("_id", "_label")
        .agg(F.min("_text").alias("_text"))
        .select("_label", "_text")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = byte_slices(batch.column(1), batch_bytes)
            found = [(o, n) for part in parts for o, _, n in model.documents(part.to_pylist())]
            odds = pa.array([o for o, _ in found], pa.float64())
            words = pa.array([n for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), odds, words], ["label", "odds", "words"])

    rows = texts.mapInArrow(measure, "label int, odds double, words long").where("words > 0").collect()
    if len({r["label"] for r in rows}) < 2:
        return model
    label, odds, words = (np.array([r[k] for r in sorted(rows)]) for k in ("label", "odds", "words"))
    of_class = counted(labels, id_column=id_column, label_column=label_column)
    return replace(model, calibration=_calibrate(odds, words, label, of_class), memo={})


def score(
    docs: DataFrame,
    model: Model,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``score`` (0 to 1), ``predicted``, ``spans``.

    Spans are (begin, end, probability) in characters of the text, words in a row merged. Null
    and empty texts, and texts without a word, have no spans and the lowest score of the model; a
    model without both classes gives every row the share of label 1. Equal texts get equal
    results, other columns are not read, an empty table gives an empty result.
    """
    if id_column in RESULT:
        raise ValueError(f"{id_column!r} is a column of the result")
    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[float] = []
            spans: list[list] = []
            for part in byte_slices(batch.column(1), batch_bytes):
                if model.weights is None:
                    scores += [model.prior] * len(part)
                    spans += [[]] * len(part)
                    continue
                for odds, found, words in model.documents([text or "" for text in part.to_pylist()]):
                    scores.append(model.score(odds, words))
                    spans.append([dict(zip(("begin", "end", "probability"), f)) for f in found])
            values = np.array(scores)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(values),
                    pa.array((values >= 0.5).astype(np.int32)),
                    pa.array(spans, pa.list_(span)),
                ],
                [id_column, *RESULT],
            )

    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        judge,
        f"`{id_column}` {kind}, score double, predicted int,"
        " spans array<struct<begin: int, end: int, probability: double>>",
    )
