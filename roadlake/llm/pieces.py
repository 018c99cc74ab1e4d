"""SentencePiece encoding and decoding through a table of distinct chunks (operator 3).

If no piece of the model holds a whitespace marker behind another character, no merge crosses the
start of a marked word. A text is then the concatenation of its marked words, each of which is
segmented once per task and kept in a table; the ids are joined back by position. The table holds at
most TABLE_ROWS words and starts anew when it is full, so memory is bounded and results are whole.
Models with pieces that cross a marker are applied to whole texts.

Ids are kept as bytes (little-endian unsigned 32-bit integers). A null text is encoded as an empty
one; repeated rows and further columns are kept; a column named like the result is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import arrays, table

MARK = "▁"
TABLE_ROWS = 100_000
#: Longer words are segmented each time.
TABLE_WORD = 64


def model_bytes(path: str | None = None) -> bytes:
    """The serialized model; without a path, the public 32k model. A vocabulary file has a fixed size."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


class Words(dict):
    """Marked word, without its first marker -> bytes of its ids."""

    def __init__(self, processor):
        super().__init__()
        self.processor = processor
        self[""] = array("I", [processor.piece_to_id(MARK)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.processor.encode(word)).tobytes()
        if len(word) <= TABLE_WORD:
            if len(self) >= TABLE_ROWS:
                lone = self[""]
                self.clear()
                self[""] = lone
            self[word] = ids
        return ids


def crosses_markers(processor) -> bool:
    pieces = (processor.id_to_piece(i) for i in range(processor.vocab_size()))
    return any(MARK in piece.lstrip(MARK) for piece in pieces)


def encoder(model: bytes, bos: bool, eos: bool):
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    start = array("I", [processor.bos_id()] * bos).tobytes()
    stop = array("I", [processor.eos_id()] * eos).tobytes()
    if crosses_markers(processor):
        return lambda text: start + array("I", processor.encode(text)).tobytes() + stop
    words = Words(processor)
    chunks = re.compile(" +[^ ]*").findall

    def encode(text: str) -> bytes:
        if not text:
            return start + stop
        text = " " + text.replace(MARK, " ")
        keys = [c[1:] for c in chunks(text)] if "  " in text else text.split(" ")[1:]
        return b"".join([start, *map(words.__getitem__, keys), stop])

    return encode


def decoder(model: bytes):
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, marked = [], set()
    for i in range(processor.vocab_size()):
        piece = processor.id_to_piece(i)
        if processor.is_control(i):
            pieces.append(b"")
        elif processor.is_byte(i):
            pieces.append(bytes([int(piece[3:5], 16)]))
        else:
            pieces.append(piece.replace(MARK, " ").encode())
            if piece.startswith(MARK):
                marked.add(i)
    skipped = {processor.bos_id(), processor.eos_id()}
    unknown = processor.unk_id()

    def decode(ids: bytes) -> str:
        ids = array("I", ids).tolist()
        first = next((i for i in ids if i not in skipped), None)
        if first is None:
            return ""
        if first in marked and unknown not in ids:
            try:
                return b"".join(map(pieces.__getitem__, ids))[1:].decode()
            except UnicodeDecodeError:
                pass  # byte pieces that are no UTF-8: the library marks them
        return processor.decode(ids)

    return decode


def encode(
    df: DataFrame, text: str = "text", into: str = "ids", model: str | None = None, bos: bool = True, eos: bool = True
) -> DataFrame:
    """``df`` with the ids of every whole text as binary column ``into``."""
    proto = df.sparkSession.sparkContext.broadcast(model_bytes(model))

    @F.arrow_udf(T.BinaryType())
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = encoder(proto.value, bos, eos)
        for batch in texts:
            yield pa.chunked_array(
                [pa.array([run(t or "") for t in part.to_pylist()], pa.binary()) for part in arrays(batch)], pa.binary()
            ).combine_chunks()

    return df.withColumn(into, ids_of(F.col(text)))


def decode(df: DataFrame, ids: str = "ids", into: str = "decoded", model: str | None = None) -> DataFrame:
    """``df`` with the texts of the ids as string column ``into``; null ids give null."""
    proto = df.sparkSession.sparkContext.broadcast(model_bytes(model))

    @F.arrow_udf(T.StringType())
    def text_of(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = decoder(proto.value)
        for batch in values:
            yield pa.chunked_array(
                [pa.array([None if v is None else run(v) for v in part.to_pylist()], pa.string()) for part in arrays(batch)],
                pa.string(),
            ).combine_chunks()

    return df.withColumn(into, text_of(F.col(ids)))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs)).select(
        "doc_id",
        F.expr("bigint(octet_length(ids) / 4)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with their token ids."""
    return encode(docs).withColumn("n_tokens", F.expr("bigint(octet_length(ids) / 4)"))
