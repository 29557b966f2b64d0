"""Token counts of whole texts, huge ones by overlapping chunks spliced at proven boundaries.

A place between two characters x and y is *stable* when no piece of the vocabulary contains x
directly followed by y.  No merge of pair encoding can then cross it, so the tokens left and right
of it do not depend on each other, and two encodings that both hold some text around it agree from
there on.  A chunk is encoded together with the start of the next one; both cut at the first stable
place after the next one's first character.  Where the overlap holds none, it is widened, up to the
whole next chunk; a text with a chunk that holds none at all is encoded in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.workspace import materialize

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pairs = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ")
        pairs.update(zip(piece, piece[1:], strict=False))
    return model, pairs


def first_stable(text: str, start: int, end: int, pairs: set) -> int | None:
    """The first place p in (start, end) such that no piece holds text[p - 1] and text[p] together."""
    text = text[start:end].replace("▁", " ")
    for p in range(1, len(text)):
        if (text[p - 1], text[p]) not in pairs:
            return start + p
    return None


def count_chunk(model, pairs: set, text: str, length: int, is_first: bool, overlap: int) -> int:
    """Tokens of a chunk between its own splice and that of the next one; -1 if there is no splice.

    ``text`` is the chunk's ``length`` characters followed by those of the next chunk (none after
    the last).  The chunk's own splice is the first stable place after its first character.
    """
    start = 0 if is_first else first_stable(text, 0, min(length, len(text)), pairs)
    end = len(text)
    while end > length:
        reach = min(length + overlap, len(text))
        found = first_stable(text, length, reach, pairs)
        if found is not None:
            end = found
            break
        if reach == len(text):
            return -1
        overlap *= 4
    if start is None:
        return -1
    reach = end if end == len(text) else min(len(text), end + overlap)
    begins = [b for b, _ in model.encode(text[:reach], return_type="offset_mapping")["offsets"]]
    if (start and start not in begins) or (end < reach and end not in begins):
        return -1  # the boundary isn't common to both encodings
    return sum(start <= b < end for b in begins)


def token_counts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    model_path: str | None = None,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``key``, ``n_bytes`` and ``n_tokens`` of every row.

    Texts of up to ``chunk`` characters are encoded whole.  Longer ones become rows of (text hash,
    chunk number, chunk and next chunk), spread over tasks and once for equal texts; their counts
    are added up by text hash.  Null and empty texts have 0 bytes and 0 tokens; repeated rows are
    all returned; other columns are not read.  The counts of long texts are made at once, by a job.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    rows = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_huge = F.char_length("text") > chunk

    def count_whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, _ = _model(path)
        for batch in batches:
            texts = batch.pop("text")
            counts: list[int] = []
            for at in range(0, len(texts), 64):
                part = model.encode(texts.iloc[at : at + 64].tolist(), num_threads=1)
                counts.extend(map(len, part))
            yield batch.assign(n_tokens=counts)

    def count_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, pairs = _model(path)
        for batch in batches:
            counts = [
                count_chunk(model, pairs, t, chunk, n == 0, overlap)
                for t, n in zip(batch["piece"], batch["number"], strict=True)
            ]
            yield pd.DataFrame({"hash": batch["hash"], "number": batch["number"], "n": counts})

    schema = df.select(F.col(key).alias("key")).schema.simpleString()[7:-1]
    small = rows.where(~is_huge).mapInPandas(count_whole, f"{schema}, n_bytes long, n_tokens long")
    huge = rows.where(is_huge).withColumn("hash", F.sha2("text", 256))
    numbers = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / chunk).cast("int"))
    pieces = F.transform(
        numbers,
        lambda i: F.struct(
            i.alias("number"),
            F.substring(F.col("text"), i * chunk + 1, F.lit(2 * chunk)).alias("piece"),
        ),
    )
    chunks = (
        huge.select("hash", F.explode(pieces).alias("c"))
        .select("hash", "c.number", "c.piece")
        .dropDuplicates(["hash", "number"])
    )
    counted = chunks.mapInPandas(count_chunks, "hash string, number int, n long")
    added = counted.groupBy("hash").agg(F.sum("n").alias("n_tokens"), F.min("n").alias("least"))
    added = materialize(added, "huge-texts")  # read twice below, and all that was encoded for it
    spliced = huge.select("key", "n_bytes", "hash").join(added, "hash")
    unspliced = spliced.where("least < 0").select("hash").distinct()
    whole = (
        huge.join(unspliced, "hash", "left_semi")
        .select("key", "n_bytes", "text")
        .mapInPandas(count_whole, f"{schema}, n_bytes long, n_tokens long")
    )
    spliced = spliced.where("least >= 0").select("key", "n_bytes", "n_tokens")
    return small.unionByName(spliced).unionByName(whole).withColumnRenamed("key", key)
