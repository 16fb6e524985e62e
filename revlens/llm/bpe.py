"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` gives the ids that tiktoken's ``encode_ordinary`` gives for the whole
text; ``decode`` joins the raw bytes of ids (never a lossy text decode).

Long texts are pre-split where no pre-tokenizer match can span the cut, so
memory per call is bounded and the ids are those of the unsplit text:

* between a character that is no white space and an ASCII blank that follows:
  no alternative of the pattern has white space after anything else;
* between an ASCII letter or digit and ASCII punctuation, or between an ASCII
  letter and a digit: every alternative's run ends there.

A white-space run longer than ``RUN`` characters overflows the pattern
engine's stack, so it is cut out by the pattern's own rule (all of it at the
end of the text, all but its last character before other text) and merged as
the single match it is.

Defined results: null text counts as empty; an empty text has no ids and
decodes to empty bytes; rows are independent, so repeated rows and repeated or
null ids give one result row each; an empty table gives an empty result; other
columns are ignored.  One narrow Arrow stage, no shuffle.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revlens.llm.common import text_rows

#: Unicode White_Space (fixed values).
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = 4096
LONG_RUN = re.compile(f"[{SPACE}]{{{RUN},}}")
SAFE = re.compile(
    rf"(?<=[^{SPACE}])(?=[ \t\r\n])|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{{-~])"
    r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoding(path: str):
    """The encoding of a rank file; loaded once per Python worker."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int) -> Iterator[tuple[str, bool]]:
    """Cuts of a text whose ids concatenate to those of the whole, as (piece, is one match)."""
    at = 0
    runs = LONG_RUN.finditer(text) if len(text) > RUN else ()
    for run in runs:
        stop = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((p, False) for p in _safe_pieces(text[at:run.start()], limit))
        yield text[run.start():stop], True
        at = stop
    yield from ((p, False) for p in _safe_pieces(text[at:], limit))


def _safe_pieces(text: str, limit: int) -> Iterator[str]:
    at = 0
    while len(text) - at > limit:
        cut = SAFE.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


def encode_text(enc, text: str, limit: int) -> np.ndarray:
    if len(text) <= min(limit, RUN):
        return enc.encode_to_numpy(text, disallowed_special=())
    parts = [np.asarray(enc._core_bpe.encode_single_piece(p.encode()), dtype=np.uint32) if whole
             else enc.encode_to_numpy(p, disallowed_special=()) for p, whole in pieces(text, limit)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
           piece_chars: int = 65_536) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: ids are little-endian unsigned 32-bit integers
    (``numpy.frombuffer(ids, "<u4")``), without special tokens."""
    rows = text_rows(docs, id_col, text_col)

    def run(batches):
        enc = encoding(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = [encode_text(enc, t, piece_chars) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4", copy=False).tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``: the raw bytes of ``ids``.  Null ids decode to null."""
    cols = [c for c in encoded.columns if c != "decoded"]
    frame = encoded.select(*cols)
    at = cols.index("ids")

    def run(batches):
        enc = encoding(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out = [None if x is None else
                       enc.decode_bytes(np.frombuffer(x, "<u4").tolist())
                       for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())],
                                                 names=[*cols, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.mapInArrow(run, f"{schema}, decoded binary")
