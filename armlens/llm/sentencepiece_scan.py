"""SentencePiece encoding and decoding of whole texts by the max-plus parallel scan of ``piece_lattice``.

Every text is cut into chunks of ``chunk_chars`` characters, which yield boundary-state transfer matrices that are
combined and traced back. Chunks of texts that have several are dealt to tasks; a text of one chunk is scanned where it
is read. The result is the model's own encoding, with its pieces' scores summed up.

Defined results: null and empty texts have no pieces; rows that occur twice are encoded twice; extra columns are
ignored; a text through which there is no path (none is known) has null pieces. ``decode`` gives the text back exactly,
unless it holds the model's own mark for blanks (U+2581): it is encoded as a blank, as the library does, and decoded as
one, so ``round_trip`` is false for such a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .piece_lattice import encode_chunked, lattice_of


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceDecoder:
    def __init__(self, path: str):
        model = lattice_of(path).model
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.text = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def decode(self, ids: np.ndarray) -> str:
        out = b"".join(map(self.text.__getitem__, ids.tolist()))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


_DECODERS: dict[str, PieceDecoder] = {}


def _decoder(path: str) -> PieceDecoder:
    if path not in _DECODERS:
        _DECODERS[path] = PieceDecoder(path)
    return _DECODERS[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, model: str | None = None, with_ids: bool = True, chunk_chars: int = 32_768) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, score, round_trip (and ids): a row for each row; ids are little-endian 32-bit."""
    path = model or model_path()
    text_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "n_pieces", "ids_crc32", "score", "round_trip", "ids"][: 5 + with_ids]

    def digest(found: list[tuple[np.ndarray | None, float]], texts: list[str | None], doc_ids: pa.Array) -> pa.RecordBatch:
        found = [(None, None) if ids is None or w == -np.inf else (ids, w) for ids, w in found]
        raw = [None if ids is None else ids.tobytes() for ids, _ in found]
        back = [ids is not None and _decoder(path).decode(ids) == (t or "") for (ids, _), t in zip(found, texts, strict=True)]
        columns = [
            doc_ids, pa.array([None if ids is None else len(ids) for ids, _ in found], pa.int64()), pa.array([None if x is None else zlib.crc32(x) for x in raw], pa.int64()),
            pa.array([w for _, w in found], pa.float64()), pa.array(back, pa.bool_()), pa.array(raw, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns[: 5 + with_ids], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            # The one cell of each text's one matrix, traced at once.
            yield digest(lattice_of(path).encode([(" " + t).replace("▁", " ") if t else "" for t in texts]), texts, batch.column(0))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None if x is None else np.frombuffer(x, "<u4"), w) for x, w in zip(batch.column("ids").to_pylist(), batch.column("weight").to_pylist(), strict=True)]
            yield digest(found, batch.column("text").to_pylist(), batch.column("doc_id"))

    schema = "doc_id long, n_pieces long, ids_crc32 long, score double, round_trip boolean" + (", ids binary" if with_ids else "")
    several = F.coalesce(F.length("text") + 1 > chunk_chars, F.lit(False))
    return docs.where(~several).mapInArrow(run, schema).union(encode_chunked(docs.where(several), path, chunk_chars).mapInArrow(finish, schema))


def decode(encoded: DataFrame, *, model: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_decoder(path).decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
