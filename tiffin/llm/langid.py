"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into consecutive windows; in each a forward and
a backward gated recurrent layer read the bytes and a softmax labels every
position.  A document's probabilities are the mean over all its positions,
whole texts without exception.  The network is trained in numpy by
backpropagation through time over the windows of a bounded sample.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm import tokens
from tiffin.llm.common import staged, text_or_empty
from tiffin.llm.quality import remainder

#: Bytes of a window and units of each direction.
SPAN = 64
UNITS = 8
#: Documented bound of the training sample: windows a language, one from a document.
SAMPLE_PER_LANGUAGE = 2_000
STEPS, BATCH, RATE = 400, 256, 0.02
PIECE = 1 << 19
UNDETERMINED = "und"


# ---- the network --------------------------------------------------------------------------------
# A direction is a dict: input tables Ez, Er, En (256 x units; row = byte) and recurrent Uz, Ur, Un.

def new_direction(rng: np.random.Generator, units: int) -> dict[str, np.ndarray]:
    out = {f"E{g}": rng.normal(0, 0.3, (256, units)).astype(np.float32) for g in "zrn"}
    return out | {f"U{g}": rng.normal(0, 0.4, (units, units)).astype(np.float32) for g in "zrn"}


def gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid, in place."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0.0, 1.0, out=x)


def run_direction(d: dict[str, np.ndarray], x: np.ndarray, order: range, keep: list | None = None) -> np.ndarray:
    """States (positions, windows, units) for bytes x (positions, windows) read in ``order``.

    ``keep`` collects what backpropagation needs of each position.
    """
    units = d["Uz"].shape[0]
    states = np.empty((x.shape[0], x.shape[1], units), np.float32)
    h = np.zeros((x.shape[1], units), np.float32)
    for t in order:
        z = h @ d["Uz"]
        z += d["Ez"][x[t]]
        gate(z)
        r = h @ d["Ur"]
        r += d["Er"][x[t]]
        gate(r)
        hn = h @ d["Un"]
        n = r * hn
        n += d["En"][x[t]]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((t, h, z, r, hn, n))
        new = states[t]
        np.subtract(h, n, out=new)  # (1 - z) n + z h
        new *= z
        new += n
        h = new
    return states


def back_direction(d: dict[str, np.ndarray], x: np.ndarray, kept: list, grad: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of a direction's parameters from those of its states, through time."""
    out = {k: np.zeros_like(v) for k, v in d.items()}
    inputs = {g: np.zeros(grad.shape, np.float32) for g in "zrn"}
    dh = np.zeros(grad.shape[1:], np.float32)
    for t, h, z, r, hn, n in reversed(kept):
        dh = dh + grad[t]
        dan = dh * (1 - z) * (1 - n * n)
        daz = dh * (h - n) * np.where((z > 0) & (z < 1), np.float32(0.25), np.float32(0))
        dar = dan * hn * np.where((r > 0) & (r < 1), np.float32(0.25), np.float32(0))
        dhn = dan * r
        out["Uz"] += h.T @ daz
        out["Ur"] += h.T @ dar
        out["Un"] += h.T @ dhn
        inputs["z"][t], inputs["r"][t], inputs["n"][t] = daz, dar, dan
        dh = dh * z + daz @ d["Uz"].T + dar @ d["Ur"].T + dhn @ d["Un"].T
    flat = x.ravel()
    for g in "zrn":
        cols = inputs[g].reshape(len(flat), -1)
        for j in range(cols.shape[1]):
            out[f"E{g}"][:, j] = np.bincount(flat, cols[:, j], 256)
    return out


def softmax(a: np.ndarray) -> np.ndarray:
    a -= a.max(axis=-1, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(axis=-1, keepdims=True)
    return a


class Network:
    def __init__(self, languages: list[str], units: int = UNITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = new_direction(rng, units), new_direction(rng, units)
        self.out = {"W": rng.normal(0, 0.3, (2 * units, len(languages))).astype(np.float32),
                    "b": np.zeros(len(languages), np.float32)}

    def parts(self) -> tuple:
        return self.languages, self.forward, self.backward, self.out

    @classmethod
    def of(cls, parts: tuple) -> Network:
        net = cls(parts[0])
        net.languages, net.forward, net.backward, net.out = parts
        return net

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities (positions, windows, languages) of every position of x."""
        n, units = range(x.shape[0]), self.out["W"].shape[0] // 2
        p = run_direction(self.forward, x, n) @ self.out["W"][:units]
        p += run_direction(self.backward, x, n[::-1]) @ self.out["W"][units:]
        p += self.out["b"]
        np.exp(np.clip(p, -40.0, 40.0, out=p), out=p)
        p /= (p @ np.ones((p.shape[2], 1), np.float32))
        return p

    def gradients(self, x: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, list[dict]]:
        """Mean loss over real positions and gradients of the three parameter sets."""
        kept: tuple[list, list] = ([], [])
        fwd = run_direction(self.forward, x, range(x.shape[0]), kept[0])
        bwd = run_direction(self.backward, x, range(x.shape[0])[::-1], kept[1])
        states = np.concatenate((fwd, bwd), axis=2)
        p = softmax(states @ self.out["W"] + self.out["b"])
        chosen = np.take_along_axis(p, np.broadcast_to(label, x.shape)[..., None], axis=2)[..., 0]
        weight = (real / real.sum()).astype(np.float32)
        loss = float(-(np.log(chosen + 1e-9) * weight).sum())
        delta = p * weight[..., None]
        at = np.arange(x.shape[0])[:, None], np.arange(x.shape[1])[None, :], np.broadcast_to(label, x.shape)
        delta[at] -= weight
        flat = states.reshape(-1, states.shape[2])
        out = {"W": flat.T @ delta.reshape(-1, delta.shape[2]), "b": delta.sum(axis=(0, 1))}
        back, units = delta @ self.out["W"].T, fwd.shape[2]
        return loss, [back_direction(self.forward, x, kept[0], back[..., :units]),
                      back_direction(self.backward, x, kept[1], back[..., units:]), out]

    def fit(self, x: np.ndarray, real: np.ndarray, label: np.ndarray, steps=STEPS, batch=BATCH, rate=RATE) -> list[float]:
        """Adam over minibatches of windows (columns of x); the losses."""
        sets, rng, losses = [self.forward, self.backward, self.out], np.random.default_rng(11), []
        m = [{k: np.zeros_like(v) for k, v in s.items()} for s in sets]
        v = [{k: np.zeros_like(a) for k, a in s.items()} for s in sets]
        for step in range(1, steps + 1):
            own = rng.integers(0, x.shape[1], batch)
            loss, grads = self.gradients(x[:, own], real[:, own], label[own])
            losses.append(loss)
            now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for s, g, a, b in zip(sets, grads, m, v):
                for k in s:
                    a[k] += 0.1 * (g[k] - a[k])
                    b[k] += 0.005 * (g[k] * g[k] - b[k])
                    s[k] -= (now * (a[k] / (1 - 0.9 ** step))
                             / (np.sqrt(b[k] / (1 - 0.995 ** step)) + 1e-7)).astype(np.float32)
        return losses

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Mean position probabilities (rows, languages) of whole texts; zeros for empty ones."""
        out = np.zeros((len(texts), len(self.languages)))
        for first, end, data, offsets in tokens.pieces(texts, PIECE):
            # a very long text goes through in blocks of windows, made one after the other
            for x, real, row in window_blocks(data, offsets, 2 * PIECE // SPAN):
                p = self.positions(x)
                p *= real[:, :, None]
                sums = p.sum(axis=0)
                for k in range(out.shape[1]):
                    out[first:end, k] += np.bincount(row, sums[:, k], end - first)
            out[first:end] /= np.maximum(1, np.diff(offsets))[:, None]
        return out


def window_blocks(data: np.ndarray, offsets: np.ndarray, most: int,
                  span: int = SPAN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of at most ``most`` windows: bytes (span, windows) padded by 0, which are real, each window's row.

    A block takes memory for its own windows alone, however long a text is.
    """
    until = np.cumsum(-(-np.diff(offsets) // span))
    for a in range(0, int(until[-1]) if len(until) else 0, most):
        number = np.arange(a, min(a + most, int(until[-1])))
        row = np.searchsorted(until, number, side="right")
        # counted from the end of the row's windows, as `until` holds their ends
        before = until[row] + (-np.diff(offsets)[row] // span)
        start = offsets[row] + (number - before) * span
        real = np.arange(span)[:, None] < np.minimum(span, offsets[row + 1] - start)[None, :]
        at = np.minimum(start[None, :] + np.arange(span)[:, None], len(data) - 1)
        yield np.where(real, data[at], 0).astype(np.intp), real, row


def windows(data: np.ndarray, offsets: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows as one block."""
    return next(window_blocks(data, offsets, max(1, len(data) + len(offsets)), span),
                (np.zeros((span, 0), np.intp), np.zeros((span, 0), bool), np.zeros(0, np.intp)))


# ---- on Spark -----------------------------------------------------------------------------------

def training_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held_out: int,
                     per_language: int) -> DataFrame:
    """(lang, h, body): a stretch of SPAN characters from each of at most ``per_language`` documents a language.

    The language counts give each language's share of a hash range, so only a
    bounded number of candidates is ordered; the place of the stretch is a
    hash as well.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       text.alias("text")).where(
        (remainder(F.col("id"), folds) != held_out) & F.col("lang").isNotNull() & (F.col("text") != ""))
    rows = rows.withColumn("h", F.xxhash64(F.col("id").cast("string"), F.lit(SPAN)))
    many = staged(rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    unit = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    picked = rows.join(many, F.col("lang") == F.col("of")).where(unit * F.col("n") < 1.5 * per_language + 50)
    place = F.pmod(F.xxhash64("h"), F.greatest(F.lit(0), F.length("text") - SPAN) + 1) + 1
    picked = picked.select("lang", "h", F.substring("text", place.cast("int"), F.lit(SPAN)).alias("body"))
    order = Window.partitionBy("lang").orderBy("h", "body")
    return (picked.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
            .select("lang", "h", "body"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        folds: int = 4, held_out: int = 2, per_language: int = SAMPLE_PER_LANGUAGE) -> Network | None:
    """The network trained in one task on the bounded sample; None if no document has a language."""
    sample = staged(training_windows(docs, id_col, text_col, lang_col, folds, held_out, per_language), "lang-sample")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        if rows.num_rows:
            langs = rows["lang"].to_pylist()
            net = Network(sorted(set(langs)))
            data = [b.encode("utf-8", "surrogatepass")[:SPAN] for b in rows["body"].to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(b) for b in data])))
            x, real, row = windows(np.frombuffer(b"".join(data), np.uint8), offsets)
            net.fit(x, real, np.array([net.languages.index(s) for s in langs])[row])
            yield pa.RecordBatch.from_pydict({"net": [pickle.dumps(net.parts())]})
    learned = (sample.repartition(1).sortWithinPartitions("h", "lang", "body").select("lang", "body")
               .mapInArrow(learn, "net binary").collect())
    return Network.of(pickle.loads(bytes(learned[0]["net"]))) if learned else None


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text",
            folds: int = 4, held_out: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, probabilities (map by language).

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no
    letter, or if there is no network.  Other columns are not read.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    if net is None:
        found = rows.select("doc_id", F.lit(False).alias("letter"), F.array().cast("array<double>").alias("p"))
        languages: list[str] = []
    else:
        languages, shared = net.languages, docs.sparkSession.sparkContext.broadcast(net.parts())

        @F.arrow_udf("array<double>")
        def probabilities(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            own = Network.of(shared.value)
            for texts in batches:
                yield pa.array(list(own.documents(texts)), pa.list_(pa.float64()))
        found = rows.select("doc_id", F.col("text").rlike(r"\p{L}").alias("letter"), probabilities("text").alias("p"))
    best = F.array_max("p")
    names = F.array(*[F.lit(x) for x in languages]) if languages else F.array().cast("array<string>")
    sure = F.col("letter") & best.isNotNull()
    return found.select(
        "doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"),
        F.when(sure, F.get(names, F.array_position("p", best).cast("int") - 1)).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(sure, F.least(F.lit(1.0), best)).otherwise(F.lit(0.0)).alias("score"),
        F.map_from_arrays(names, "p").alias("probabilities") if languages
        else F.lit(None).cast("map<string,double>").alias("probabilities"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held_out: int = 2, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Train on the documents outside the held-out fold and predict all of them; see ``fit`` and ``predict``."""
    return predict(docs, fit(docs, id_col, text_col, lang_col, folds, held_out, per_language),
                   id_col, text_col, folds, held_out)
