"""A byte-level convolutional network that scores the quality of whole texts, in numpy.

Each byte enters as a learned vector, with a flag that tells whether its word stands again among the
last few words.  Filters slide over the bytes; their responses are max-pooled over overlapping
chunks that cover the whole text, whatever its length; a linear unit scores every chunk, and the
mean over a text's chunks becomes one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.buffers import Words, blocks, text_bytes, words_between_blanks

EMBED = 4
KERNEL = 8
STRIDE = 4
FILTERS = 24
UNIT = 32  # windows pooled together; a chunk is four units and starts every three
CHUNK_UNITS, CHUNK_STEP = 4, 3  # 512 bytes, 128 of them shared with the next chunk
LOOK_BACK = 2

SAMPLE_ROWS = 4000  # labelled rows the network is fitted on, at most
SAMPLE_PIECES = 6  # pieces read from each, spread over its text
PIECE_CHARS = 512


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    kernel: np.ndarray  # KERNEL * (EMBED + 1) x FILTERS
    bias: np.ndarray
    unit: np.ndarray  # FILTERS + 1, the last is the constant

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.bias, self.unit]


def new_network(seed: int = 7) -> Network:
    random = np.random.default_rng(seed)
    return Network(
        random.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        random.normal(0, 0.25, (KERNEL * (EMBED + 1), FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(FILTERS + 1, np.float32),
    )


@dataclass
class Laid:
    """Texts laid out on a grid of STRIDE bytes, each closed by zeros; and their chunks."""

    data: np.ndarray  # bytes with padding
    flag: np.ndarray
    unit_start: np.ndarray  # first window of each unit
    unit_end: np.ndarray  # the window after its last
    chunk_unit: np.ndarray  # chunk x CHUNK_UNITS: its units, the last repeated
    chunk_text: np.ndarray
    texts: int


def lay_out(data: np.ndarray, offsets: np.ndarray) -> Laid:
    texts = len(offsets) - 1
    size = np.diff(offsets)
    words = Words(data, offsets, words_between_blanks(), np.arange(256, dtype=np.uint8))
    key = words.key
    again = np.zeros(len(key), bool)
    for back in range(1, LOOK_BACK + 1):
        again[back:] |= (key[back:] == key[:-back]) & (words.text[back:] == words.text[:-back])
    marks = np.zeros(len(data) + 1, np.int8)
    marks[words.start[again]] += 1
    marks[words.end[again]] -= 1
    # a text takes whole windows and at least KERNEL bytes more, so no window sees two texts
    windows = np.maximum(1, -(-size // STRIDE))
    room = windows * STRIDE + KERNEL
    first = np.cumsum(room) - room
    laid = np.zeros(int(room.sum()) + KERNEL, np.uint8)
    flag = np.zeros(len(laid), np.float32)
    place = np.arange(len(data)) + np.repeat(first - offsets[:-1], size)
    laid[place] = data
    flag[place] = np.cumsum(marks[:-1])
    units = -(-windows // UNIT)
    unit_text = np.repeat(np.arange(texts), units)
    unit_before = np.cumsum(units) - units
    nth = np.arange(len(unit_text)) - unit_before[unit_text]
    unit_start = first[unit_text] // STRIDE + nth * UNIT
    unit_end = np.minimum(unit_start + UNIT, (first // STRIDE + windows)[unit_text])
    chunks = np.maximum(1, -(-(units - CHUNK_UNITS) // CHUNK_STEP) + 1)
    chunk_text = np.repeat(np.arange(texts), chunks)
    nth = np.arange(len(chunk_text)) - (np.cumsum(chunks) - chunks)[chunk_text]
    chunk_unit = nth[:, None] * CHUNK_STEP + np.arange(CHUNK_UNITS)
    chunk_unit = np.minimum(chunk_unit, units[chunk_text][:, None] - 1) + unit_before[chunk_text][:, None]
    return Laid(laid, flag, unit_start, unit_end, chunk_unit, chunk_text, texts)


def _windows(net: Network, laid: Laid) -> np.ndarray:
    """One row for each window: KERNEL bytes, embedded, with their flags."""
    depth = EMBED + 1
    image = np.empty((len(laid.data), depth), np.float32)
    image[:, :EMBED] = net.embed[laid.data]
    image[:, EMBED] = laid.flag
    flat = image.ravel()
    count = (len(laid.data) - KERNEL) // STRIDE + 1
    step = flat.strides[0]
    shape, strides = (count, KERNEL * depth), (STRIDE * depth * step, step)
    return np.lib.stride_tricks.as_strided(flat, shape, strides, writeable=False)


def _by_unit(response: np.ndarray, laid: Laid) -> np.ndarray:
    """Maxima over each unit's own windows, without those between texts."""
    bounds = np.stack([laid.unit_start, laid.unit_end], axis=1).ravel()
    return np.maximum.reduceat(response, bounds, axis=0)[::2]


def _pooled(net: Network, laid: Laid) -> np.ndarray:
    """Max-pooled responses of every chunk."""
    by_unit = _by_unit(_windows(net, laid) @ net.kernel, laid)
    pooled = by_unit[laid.chunk_unit].max(axis=1) + net.bias
    return np.maximum(pooled, 0)


def score(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of every text of a block; an empty text is one chunk of zeros."""
    if len(offsets) < 2:
        return np.zeros(0)
    laid = lay_out(data, offsets)
    logits = _pooled(net, laid) @ net.unit[:-1] + net.unit[-1]
    chunks = np.bincount(laid.chunk_text, minlength=laid.texts)
    mean = np.bincount(laid.chunk_text, logits, minlength=laid.texts) / chunks
    return 1 / (1 + np.exp(-mean.clip(-30, 30)))


def fit(texts: list[bytes], labels: list[int], steps: int = 400, batch: int = 64, rate: float = 0.01) -> Network:
    """Adam on the log loss of whole texts for about ``steps`` batches; both labels weigh the same."""
    net, random = new_network(), np.random.default_rng(11)
    labels = np.asarray(labels, np.float32)
    if not len(labels):
        return net
    share = labels.mean().clip(0.02, 0.98)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    slots = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    turn = 0
    while turn < steps:
        order = random.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            part = [texts[i] for i in chosen]
            offsets = np.r_[0, np.cumsum([len(t) for t in part])].astype(np.int64)
            laid = lay_out(np.frombuffer(b"".join(part), np.uint8), offsets)
            turn += 1
            for p, g, (m, v) in zip(
                net.parameters(), _gradients(net, laid, labels[chosen], weight[chosen]), slots, strict=True
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return net


def _gradients(net: Network, laid: Laid, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    windows = _windows(net, laid)
    response = windows @ net.kernel
    stacked = _by_unit(response, laid)[laid.chunk_unit]
    best = stacked.argmax(axis=1)
    unit = np.take_along_axis(laid.chunk_unit, best, axis=1)
    pooled = np.maximum(stacked.max(axis=1) + net.bias, 0)
    chunks = np.bincount(laid.chunk_text, minlength=laid.texts).astype(np.float32)
    logits = np.bincount(laid.chunk_text, pooled @ net.unit[:-1] + net.unit[-1]) / chunks
    error = weight * (1 / (1 + np.exp(-logits)) - labels) / len(labels)
    chunk_error = (error / chunks)[laid.chunk_text].astype(np.float32)
    d_unit = np.append(pooled.T @ chunk_error, chunk_error.sum()).astype(np.float32)
    d_pooled = chunk_error[:, None] * net.unit[:-1] * (pooled > 0)
    # the window that won each unit, found again for the units that won a chunk
    d_kernel, d_embed = np.zeros_like(net.kernel), np.zeros_like(net.embed)
    for f in range(FILTERS):
        live = np.flatnonzero(d_pooled[:, f])
        units = unit[live, f]
        places = laid.unit_start[units][:, None] + np.arange(UNIT)
        places = np.minimum(places, laid.unit_end[units][:, None] - 1)
        won = places[np.arange(len(live)), response[places, f].argmax(axis=1)]
        d = d_pooled[live, f]
        d_kernel[:, f] = d @ windows[won]
        spread = d[:, None] * net.kernel[:, f].reshape(KERNEL, EMBED + 1)[None, :, :EMBED].reshape(1, -1)
        bytes_seen = laid.data[won[:, None] * STRIDE + np.arange(KERNEL)]
        np.add.at(d_embed, bytes_seen.ravel(), spread.reshape(-1, EMBED))
    return [d_embed, d_kernel, d_pooled.sum(axis=0).astype(np.float32), d_unit]


def held_out(key) -> object:
    """Rows whose labels are never learned: crc32 of the key as text leaves 2 modulo 4."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Fit a network on at most SAMPLE_ROWS labelled rows that are not held out.

    The rows with the smallest hashes of their keys are taken, labels first, so that only their
    texts are read, and of those SAMPLE_PIECES pieces of PIECE_CHARS characters spread over the
    whole text: about 12 MB reach the driver at most.  Rows without label or text are left out.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(SAMPLE_ROWS)
    )
    joined = docs.where(F.col(text).isNotNull()).join(F.broadcast(chosen), F.col(key) == F.col("__key"))
    length = F.char_length(F.col(text))
    far = F.greatest(length - PIECE_CHARS, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_PIECES - 1)),
        lambda i: F.substring(
            F.col(text), (far * i / (SAMPLE_PIECES - 1)).cast("int") + 1, F.lit(PIECE_CHARS)
        ),
    )
    whole = F.when(length <= PIECE_CHARS * SAMPLE_PIECES, F.array(F.col(text))).otherwise(pieces)
    rows = joined.select("__key", "__label", F.concat_ws("\n", whole).alias("piece")).collect()
    rows.sort(key=lambda r: (str(r["__key"]), r["piece"]))
    return fit([r["piece"].encode() for r in rows], [r["__label"] for r in rows])


def quality_scores(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``df`` with ``score``, the probability of label 1, from the whole text of every row.

    Null and empty texts get the network's score of no bytes; repeated rows are all returned; a
    column named score is replaced; an empty table gives an empty result.  Nothing is shuffled.
    """
    df = df.drop("score")
    names = df.columns
    sent = df.sparkSession.sparkContext.broadcast(network)  # a few kilobytes

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for block in blocks(batches, text, 256 * 1024):
            scores = score(net, *text_bytes(block.column(text)))
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(scores.astype(np.float64))], names=[*names, "score"]
            )

    return df.mapInArrow(rate, f"{df.schema.simpleString()[7:-1]}, score double")
