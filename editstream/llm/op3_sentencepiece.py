"""SentencePiece encoding and decoding with a distinct-chunk table.

Where no piece of the model holds a whitespace marker behind another
character, no merge can cross the boundary before a marker. A text is then cut
before each run of markers, each distinct marked word is segmented once in a
worker (the table outlives batches and tasks of that worker) and ids are
joined back by position. The model's vocabulary is tested for that property
when it is loaded; if it fails, or the model rewrites characters, whole texts
are segmented. The library does all segmenting and decoding, so results are
its own, whole.

The table is emptied when it holds ``most`` chunks: that bounds a worker's
memory and only costs segmenting a word again. A table shared through Spark
would shuffle every word occurrence of the corpus; this one shuffles nothing.

Defined cases: a null text counts as empty (the end id alone); an empty table
gives no rows; repeated rows and ids stay as they are; columns other than
those named are not read.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read_table, slices

MARK = "\u2581"
MOST_CHUNKS = 300_000
LONGEST_KEPT = 64
_TABLES: dict[str, "ChunkTable"] = {}


class ChunkTable:
    """Ids of marked words by the library, each distinct word once."""

    chunks = re.compile(" +[^ ]*")

    def __init__(self, model_path: str, most: int = MOST_CHUNKS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto = model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        norm = proto.normalizer_spec
        self.by_chunk = (
            not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces
            and not norm.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == p.USER_DEFINED or re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces))
        self.lone = {" ": [self.model.piece_to_id(MARK)]}
        self.most, self.ids = most, dict(self.lone)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text and the end id."""
        if not self.by_chunk:
            return self.model.encode(texts, add_eos=True, num_threads=1)
        end = self.model.eos_id()
        cut = [self.chunks.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(self.ids) > self.most:
            self.ids = dict(self.lone)
        missing = [c for c in set(itertools.chain.from_iterable(cut)) if c not in self.ids]
        # The library puts a marker before what it is given: one is in the chunk.
        table = self.ids
        table.update(zip(missing, self.model.encode([c[1:] for c in missing], num_threads=1)))
        out = [[*itertools.chain.from_iterable(map(table.__getitem__, c)), end] for c in cut]
        for c in missing:  # a word kept is short; a long one is rare and not worth its bytes
            if len(c) > LONGEST_KEPT:
                del table[c]
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


def table(model_path: str) -> ChunkTable:
    if model_path not in _TABLES:
        _TABLES[model_path] = ChunkTable(model_path)
    return _TABLES[model_path]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int> (end id last) and the text decoded from those ids."""
    def run(batches):
        import pyarrow as pa

        chunks = table(model_path)
        for batch in slices(batches, "text"):
            ids = chunks.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ids, pa.list_(pa.int32())), pa.array(chunks.decode(ids), pa.string())],
                names=["id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
            .withColumnRenamed("id", id_col))


def op3_chunk_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    coded = encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
