"""SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a run of white space markers and the word after it. No piece of the model has a marker after
another character, so no merge crosses the start of a chunk: each distinct chunk is segmented once and
its ids are put back wherever it stands. The table belongs to a Python worker and is bounded: a table of the whole
corpus, joined back by position, would shuffle one row per word, several times the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.udfs import once

from .tokens import WordTable, once_per_worker, packed_ids, tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_CHUNK = re.compile(f"{MARK}({MARK}*[^{MARK}]*)")


class ChunkCoder:
    """Encodes and decodes as the model does, chunk by chunk."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        kept = "".join(self.model.encode(" ﬁ  b", out_type=str)) == f"{MARK}{MARK}ﬁ{MARK}{MARK}b"
        if not kept or any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError(f"{path}: texts of this model cannot be cut at white space")
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        self.table = WordTable(self._work)

    def _work(self, chunks: list[str]) -> Iterator[tuple[bytes, str]]:
        # The model puts the first marker of each chunk before it again; alone, it has to be named.
        alone = [self.model.piece_to_id(MARK)]
        encoded = [ids or alone for ids in self.model.encode(chunks, num_threads=1)]
        return zip(map(packed_ids, encoded), self.model.decode(encoded, num_threads=1))

    def code(self, text: str) -> tuple[bytes, str]:
        """Little-endian unsigned 32-bit ids with begin and end, and the decoded text."""
        edges = packed_ids([self.begin, self.end])
        if not text:
            return edges, ""
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 in marked or marked[-1] == MARK:
            chunks = _CHUNK.findall(marked)
        else:
            chunks = marked[1:].split(MARK)
        found = self.table.of(chunks)
        return edges[:4] + b"".join([ids for ids, _ in found]) + edges[4:], " ".join([word for _, word in found])


def piece_codes(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit, begin and end included), decoded, one row per row.

    A null text counts as empty and has begin and end only. Repeated rows and null ids stay; other columns are ignored.
    """
    def code(texts: pd.Series) -> pd.DataFrame:
        coder = once_per_worker(("pieces", model), lambda: ChunkCoder(tokenizer_path(model)))
        return pd.DataFrame([coder.code(t) for t in texts], columns=["ids", "decoded"])

    coded = once(F.pandas_udf(code, "ids binary, decoded string"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", coded(text).alias("coded")).select("doc_id", "coded.*")


def piece_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return piece_codes(docs, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
