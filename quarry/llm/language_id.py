"""Language identification with a small convolutional network over bytes, trained in numpy.

Bytes are embedded; filters of several widths slide over a window of ``WINDOW`` bytes; the maximum of each filter
over the window goes through a softmax layer. A text is judged on all its windows, from its first byte to its last:
the probabilities of the windows are averaged by their length.

The network is trained on the driver on a bounded sample: ``TRAIN_WINDOWS`` windows, one from a place that a hash
chooses in each text, of the labelled texts with the smallest hashes of their id. Only text and label are inputs.

A text that is null or has no letter is ``und`` with score 0; so is every text if there is no labelled one. Null
labels are not learned from. Equal texts get equal labels. Other columns pass through in a struct.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, blobs, carried

WINDOW = 256  # bytes
TRAIN_WINDOWS = 12_000  # the bound of the training sample
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
STEPS = 900  # of training, 64 windows each
CHUNK = 64  # windows at once
UNKNOWN = "und"


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zeros; the text that each belongs to; the bytes in each."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    padded = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
    rows = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    sizes = np.full(len(rows), WINDOW, np.int64)
    last = np.cumsum(counts)[counts > 0] - 1
    sizes[last] = [(len(t) - 1) % WINDOW + 1 for t in texts if t]
    return rows, owner, sizes


@dataclass
class ByteNetwork:
    labels: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # widest width * EMBEDDING x all filters; narrower filters end in zeros
    bias: np.ndarray
    out: np.ndarray  # all filters x labels
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], seed: int = 7) -> ByteNetwork:
        random = np.random.default_rng(seed)
        total = FILTERS * len(WIDTHS)
        draw = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
        filters = draw(max(WIDTHS) * EMBEDDING, total, scale=0.2) * cls.mask()
        return cls(
            labels, draw(256, EMBEDDING, scale=0.5), filters, np.zeros(total, np.float32),
            draw(total, len(labels), scale=0.2), np.zeros(len(labels), np.float32),
        )

    @staticmethod
    def mask() -> np.ndarray:
        """Where a filter of its width has weights."""
        places = np.arange(max(WIDTHS) * EMBEDDING) // EMBEDDING
        return (places[:, None] < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)

    def patches(self, rows: np.ndarray) -> np.ndarray:
        """For each window and position the embedded bytes that the widest filter sees."""
        widest = max(WIDTHS)
        padded = np.pad(rows, ((0, 0), (0, widest - 1)))
        embedded = self.embedding[padded].reshape(len(rows), -1)
        step, item = embedded.strides
        seen = np.lib.stride_tricks.as_strided(
            embedded, (len(rows), rows.shape[1], widest * EMBEDDING), (step, item * EMBEDDING, item)
        )
        return seen.reshape(-1, widest * EMBEDDING)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = self.patches(rows)
        return seen, (seen @ self.filters).reshape(len(rows), rows.shape[1], -1)

    def softmax(self, hidden: np.ndarray) -> np.ndarray:
        scores = hidden @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        found = [np.zeros((0, len(self.labels)), np.float32)]
        for at in range(0, len(rows), CHUNK):
            _, responses = self.pooled(rows[at : at + CHUNK])
            found.append(self.softmax(np.maximum(responses.max(axis=1) + self.bias, 0)))
        return np.concatenate(found)

    def train(self, rows: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = 11, rate: float = 0.004):
        """Adam on the cross-entropy; classes weigh alike."""
        random = np.random.default_rng(seed)
        names = ("embedding", "filters", "bias", "out", "out_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        share = np.bincount(target, minlength=len(self.labels))
        weights = (len(target) / np.maximum(share, 1) / max(1, np.count_nonzero(share))).astype(np.float32)
        mask, widest, step = self.mask(), max(WIDTHS), 0
        while step < steps:
            order = random.permutation(len(rows))
            for at in range(0, len(order), CHUNK):
                own, step = order[at : at + CHUNK], step + 1
                batch, n = rows[own], len(own)
                seen, responses = self.pooled(batch)
                best = responses.argmax(axis=1)
                top = np.take_along_axis(responses, best[:, None, :], axis=1)[:, 0] + self.bias
                hidden = np.maximum(top, 0)
                slope = self.softmax(hidden)
                slope[np.arange(n), target[own]] -= 1
                slope *= weights[target[own]][:, None] / n
                back = (slope @ self.out.T) * (top > 0)
                at_best = seen.reshape(n, WINDOW, -1)[np.arange(n)[:, None], best]  # window x filter x patch
                to_patch = (back[:, :, None] * self.filters.T[None]).reshape(n, back.shape[1], widest, EMBEDDING)
                padded = np.pad(batch, ((0, 0), (0, widest - 1)))
                bytes_seen = padded[np.arange(n)[:, None, None], best[:, :, None] + np.arange(widest)]
                to_embedding = np.zeros_like(self.embedding)
                np.add.at(to_embedding, bytes_seen.ravel(), to_patch.reshape(-1, EMBEDDING))
                slopes = {
                    "embedding": to_embedding,
                    "filters": np.einsum("nf,nfp->pf", back, at_best) * mask,
                    "bias": back.sum(axis=0),
                    "out": hidden.T @ slope,
                    "out_bias": slope.sum(axis=0),
                }
                for name, value in slopes.items():
                    first[name] = 0.9 * first[name] + 0.1 * value
                    second[name] = 0.99 * second[name] + 0.01 * value * value
                    scale = rate / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                    setattr(self, name, (getattr(self, name) - scale * first[name] / (1 - 0.9**step)).astype(np.float32))
        return self


def train_network(
    labelled: DataFrame, id_column: str, text_column: str, label_column: str, bound: int = TRAIN_WINDOWS
) -> ByteNetwork | None:
    """A network trained on at most ``bound`` windows of labelled texts; None without any."""
    text, order = F.col(f"`{text_column}`"), F.xxhash64(F.col(f"`{id_column}`"))
    start = F.pmod(F.xxhash64(F.col(f"`{id_column}`"), F.lit("window")), F.greatest(F.length(text) - WINDOW // 2, F.lit(1)))
    labelled = labelled.filter(F.col(f"`{label_column}`").isNotNull())
    # what the tasks send is bounded too: about a half more than the bound, by the hashes
    share = min(1.0, 1.5 * bound / max(1, labelled.count()))
    sample = (
        labelled.filter((F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + 1) & text.rlike(r"\p{L}"))
        .select(order.alias("place"), F.col(f"`{label_column}`").alias("label"), F.substr(text, start + 1, F.lit(WINDOW)).alias("part"))
        .orderBy("place", "label", "part")
        .limit(bound)
        .collect()
    )
    if not sample:
        return None
    labels = sorted({row.label for row in sample})
    rows = np.frombuffer(b"".join(r.part.encode()[:WINDOW].ljust(WINDOW, b"\0") for r in sample), np.uint8)
    target = np.array([labels.index(r.label) for r in sample])
    return ByteNetwork.fresh(labels).train(rows.reshape(-1, WINDOW), target)


def identify(df: DataFrame, network: ByteNetwork | None, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carried`` (the named columns of each row, all by default), ``lang_pred`` and ``score``."""
    carry = df.columns if carry is None else carry
    text = F.col(f"`{text_column}`")
    source = df.select(
        carried(df, carry).alias("carried"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        *([] if text_column in carry else [text.alias(text_column)]),
    )
    kind = source.schema["carried"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            labels, scores = [UNKNOWN] * n, np.zeros(n)
            if network is not None:
                letters = batch.column("letters").to_pylist()
                own = [text if has else b"" for text, has in zip(blobs(batch, text_column), letters, strict=True)]
                rows, owner, sizes = windows(own)
                weighed = network.probabilities(rows) * sizes[:, None]
                sums = np.zeros((n, len(network.labels)))
                np.add.at(sums, owner, weighed)
                total = np.bincount(owner, sizes, n)
                best = sums.argmax(axis=1)
                scores = np.clip(sums[np.arange(n), best] / np.maximum(total, 1), 0, 1)
                labels = [network.labels[b] if t else UNKNOWN for b, t in zip(best, total, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["carried", "lang_pred", "score"],
            )

    return source.transform(arrow_map, run, f"carried {kind}, lang_pred string, score double")


def held_out(id_column: str = "doc_id") -> F.Column:
    """The fold that is not learned from: ids whose CRC-32 (of the id as text) is divisible by 5. A null id is in it."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % 5, F.lit(0)) == 0


def network_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"):
    """The network learned from the labelled documents outside the held-out fold."""
    return train_network(docs.filter(~held_out(id_column)), id_column, text_column, label_column)
