"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a window of bytes, one from each end; at each byte their states together give the
probability of each language, and a text's probabilities are the mean over all its bytes. The network is trained here,
in numpy by backpropagation through time, on windows of a bounded sample of labelled texts. Prediction reads whole
texts, cut into windows that start from the zero state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType
from pyspark.sql.window import Window

from touchpath.llm.common import extended, portions, utf8

UNDETERMINED = "und"

# gates rise linearly from 0 to 1 with this slope: a sigmoid without exponentials
_SLOPE = np.float32(0.25)
_letter = regex.compile(r"\p{L}").search


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and settings of the training."""

    texts_per_language: int = 150  # the sample: at most so many labelled texts of each language
    windows_per_text: int = 6  # at evenly spaced places of the text
    window: int = 48
    state: int = 10
    steps: int = 160
    batch: int = 192
    rate: float = 0.02
    seed: int = 7


def _scaled(rng: np.random.Generator, *shape: int) -> np.ndarray:
    return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)


class Direction:
    """One gated recurrent layer. Inputs are bytes, so that its input weights are a row per byte.

    Columns of the weights: update gate, reset gate, candidate.
    """

    def __init__(self, rng: np.random.Generator, state: int):
        self.state = state
        self.parameters = {
            "x": (rng.standard_normal((256, 3 * state)) * 0.3).astype(np.float32),
            "h": _scaled(rng, state, 3 * state),
            "b": np.zeros(3 * state, np.float32),
        }

    def run(self, data: np.ndarray, present: np.ndarray | None = None, keep: bool = False):
        """States after each byte of ``data`` (time, batch); where ``present`` is 0 the state stays zero."""
        n = self.state
        x, h, b = (self.parameters[k] for k in "xhb")
        steps, batch = data.shape
        states = np.zeros((steps + 1, batch, n), np.float32)
        kept = []
        inputs = x + b
        given, own = np.empty((2, batch, 3 * n), np.float32)
        for t in range(steps):
            before, after = states[t], states[t + 1]
            inputs.take(data[t], axis=0, out=given, mode="clip")
            np.matmul(before, h, out=own)
            gates = given[:, : 2 * n] + own[:, : 2 * n]
            gates *= _SLOPE
            gates += 0.5
            np.clip(gates, 0, 1, out=gates)
            update, reset = gates[:, :n], gates[:, n:]
            candidate = own[:, 2 * n :] * reset
            candidate += given[:, 2 * n :]
            np.tanh(candidate, out=candidate)
            np.subtract(before, candidate, out=after)
            after *= update
            after += candidate
            if present is not None:
                after *= present[t][:, None]
            if keep:
                kept.append((update, reset, candidate, own[:, 2 * n :].copy()))
        return states, kept

    def back(self, data: np.ndarray, states: np.ndarray, kept: list, grads: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the parameters, from those of the states after each byte."""
        n, h = self.state, self.parameters["h"]
        out = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        carried = np.zeros_like(grads[0])
        inner = np.empty((len(data[0]), 3 * n), np.float32)
        for t in range(len(data) - 1, -1, -1):
            update, reset, candidate, own = kept[t]
            before = states[t]
            total = grads[t] + carried
            to_candidate = total * (1 - update) * (1 - candidate**2)
            inner[:, :n] = total * (before - candidate) * _SLOPE * ((update > 0) & (update < 1))
            inner[:, n : 2 * n] = to_candidate * own * _SLOPE * ((reset > 0) & (reset < 1))
            inner[:, 2 * n :] = to_candidate
            np.add.at(out["x"], data[t], inner)
            out["b"] += inner.sum(0)
            recurrent = inner.copy()
            recurrent[:, 2 * n :] *= reset
            out["h"] += before.T @ recurrent
            carried = total * update + recurrent @ h.T
        return out


class Network:
    """Both directions and the layer that labels each position."""

    def __init__(self, languages: list[str], state: int, seed: int):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forth, self.back = Direction(rng, state), Direction(rng, state)
        self.top = {"w": _scaled(rng, 2 * state, len(languages)), "b": np.zeros(len(languages), np.float32)}

    def _label(self, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
        n = self.forth.state
        scores = forth @ self.top["w"][:n] + back @ self.top["w"][n:] + self.top["b"]
        np.exp(scores - scores.max(-1, keepdims=True), out=scores)
        scores /= scores.sum(-1, keepdims=True)
        return scores

    def positions(self, data: np.ndarray, present: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (time, batch, language) for ``data`` (time, batch)."""
        forth, _ = self.forth.run(data, present)
        back, _ = self.back.run(data[::-1], None if present is None else present[::-1])
        return self._label(forth[1:], back[:0:-1])

    def step(self, data: np.ndarray, truth: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs of parameter and gradient of the mean cross entropy over all positions."""
        n = self.forth.state
        ahead, kept_ahead = self.forth.run(data, keep=True)
        behind, kept_behind = self.back.run(data[::-1], keep=True)
        forth, back = ahead[1:], behind[:0:-1]
        wrong = self._label(forth, back)
        wrong[:, np.arange(len(truth)), truth] -= 1
        wrong /= data.size
        flat = wrong.reshape(-1, wrong.shape[-1])
        top = {
            "w": np.concatenate([forth.reshape(-1, n).T @ flat, back.reshape(-1, n).T @ flat]),
            "b": flat.sum(0),
        }
        first = self.forth.back(data, ahead, kept_ahead, wrong @ self.top["w"][:n].T)
        second = self.back.back(data[::-1], behind, kept_behind, (wrong @ self.top["w"][n:].T)[::-1])
        pairs = [(self.top[k], top[k]) for k in self.top]
        pairs += [(self.forth.parameters[k], first[k]) for k in first]
        return pairs + [(self.back.parameters[k], second[k]) for k in second]

    def predict(self, texts: list[bytes], window: int = 192, block: int = 1024) -> np.ndarray:
        """Mean probabilities over all bytes of each text; zeros for an empty one."""
        sizes = np.array([len(text) for text in texts], np.int64)
        counts = -(-sizes // window)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        total = np.zeros((len(texts), len(self.languages)))
        # windows of one length side by side: the short last ones come after the full ones
        lengths = np.minimum(sizes[owner] - place * window, window)
        order = np.argsort(-lengths, kind="stable")
        for i in range(0, len(order), block):
            chosen = order[i : i + block]
            longest = int(lengths[chosen[0]])
            data = np.zeros((len(chosen), longest), np.uint8)
            for row, j in enumerate(chosen):
                start = place[j] * window
                piece = texts[owner[j]][start : start + lengths[j]]
                data[row, : len(piece)] = np.frombuffer(piece, np.uint8)
            present = (np.arange(longest)[:, None] < lengths[chosen][None, :]).astype(np.float32)
            whole = bool(present.all())
            found = self.positions(np.ascontiguousarray(data.T), None if whole else present)
            if not whole:
                found *= present[:, :, None]
            np.add.at(total, owner[chosen], found.sum(0))
        return total / np.maximum(sizes, 1)[:, None]


def train(samples: list[tuple[bytes, str]], settings: Training = Training()) -> Network:
    """A network for the languages of ``samples`` (text, language), the same for the same samples in any order."""
    samples = sorted(samples)
    network = Network(sorted({language for _, language in samples}), settings.state, settings.seed)
    number = {language: i for i, language in enumerate(network.languages)}
    windows, truth = [], []
    for text, language in samples:
        room = max(0, len(text) - settings.window)
        for start in sorted({room * i // max(1, settings.windows_per_text - 1) for i in range(settings.windows_per_text)}):
            piece = text[start : start + settings.window]
            if piece:  # short ones are repeated to the length of a window
                windows.append((piece * (settings.window // len(piece) + 1))[: settings.window])
                truth.append(number[language])
    if not windows:
        return network
    data = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), settings.window)
    labels = np.array(truth)
    each = [np.flatnonzero(labels == i) for i in range(len(network.languages))]
    rng = np.random.default_rng(settings.seed)
    moments: list = []
    for step in range(1, settings.steps + 1):
        language = rng.integers(0, len(each), settings.batch)  # languages in equal parts
        chosen = np.array([each[i][rng.integers(len(each[i]))] for i in language])
        pairs = network.step(np.ascontiguousarray(data[chosen].T), labels[chosen])
        moments = moments or [(np.zeros_like(p), np.zeros_like(p)) for p, _ in pairs]
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        for (parameter, gradient), (mean, square) in zip(pairs, moments):  # Adam
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            size = np.sqrt(square / (1 - 0.99**step)) + 1e-6
            parameter -= (rate / (1 - 0.9**step)) * mean / size
    return network


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from the training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(documents: DataFrame, settings: Training = Training()) -> list[tuple[bytes, str]]:
    """Labelled texts for the training: of each language those whose ids hash lowest, ``texts_per_language`` at most.

    The ids are chosen from the narrow columns; only the chosen texts reach the driver. The bound is
    ``texts_per_language`` times the number of languages (the labels' distinct values).
    """
    labelled = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = labelled.where("text is not null").select("doc_id", "lang", place.alias("place"))
    ids = [row.doc_id for row in chosen.where(F.col("place") <= settings.texts_per_language).collect()]
    found = labelled.where(F.col("doc_id").isin(ids)).select("text", "lang")
    most = settings.texts_per_language * (1 + len({row.lang for row in found.select("lang").distinct().collect()}))
    rows = found.where("text is not null").orderBy(F.xxhash64("text")).limit(most).collect() if ids else []
    return [(row.text.encode(), row.lang) for row in rows if _letter(row.text)]


def predict(documents: DataFrame, network: Network) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` after its columns; columns of these names are replaced.

    ``lang_pred`` is the likeliest language over all bytes of the text (the first of equal ones in order of name) and
    ``score`` its mean probability. A text that is null or has no letter gets ``und`` and 0, as all texts do if no
    language was learned. Rows are judged one by one and only by their text. No shuffle.
    """
    plain = documents.drop("lang_pred", "score")
    model = documents.sparkSession.sparkContext.broadcast(network)  # some thousand weights
    names = plain.columns
    at = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.value
        for batch in portions(batches):
            texts = utf8(batch.column(at))
            letters = [bool(network.languages) and _letter(text.decode()) is not None for text in texts]
            found = network.predict([text if ok else b"" for text, ok in zip(texts, letters)])
            labels: list[str] = [UNDETERMINED] * len(texts)
            scores = [0.0] * len(texts)
            for i, ok in enumerate(letters):
                if ok:
                    best = int(found[i].argmax())
                    labels[i], scores[i] = network.languages[best], min(1.0, float(found[i][best]))
            columns = [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    schema = extended(plain.schema, lang_pred=StringType(), score=DoubleType())
    return plain.mapInArrow(work, schema)


def identify(documents: DataFrame, settings: Training = Training()) -> DataFrame:
    """Train on the labelled part of ``documents`` and predict all of it; ``held_out`` marks the other part."""
    network = train(training_sample(documents, settings), settings)
    return predict(documents, network).withColumn("held_out", held_out(F.col("doc_id")))
