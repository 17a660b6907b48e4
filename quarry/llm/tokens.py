"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library encodes each text by the ranks, each match of the pattern separately, without special tokens.
Texts beyond ``SPLIT_CHARS`` are split first where a match of the pattern surely ends: between a character that is
not white space and a following space or line feed. No match of the pattern goes across such a place (white space
only begins a match or makes one up) and none looks behind it, so the parts' tokens together are the whole text's.
A text without such a place stays in one part. Nothing is cut off.

A run of white space before another character is one match without its last character, and one match at the end of a
text. The library's regular expression gives up on runs of about a million, so runs of ``LONG_RUN`` and more are cut
out of long texts and encoded by the ranks as the match that they are.

Tokens are kept as little-endian unsigned 32-bit integers in one binary value, as training shards store them. Null
texts count as empty and give no tokens; empty tables give empty results; other columns pass through in a struct.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_map, carried, texts

SPLIT_CHARS = 1 << 16
LONG_RUN = 1 << 12
#: The characters that the pattern's \s stands for (Unicode's White_Space).
WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUNS = re.compile(f"{WHITE}{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    """The tokenizer of a rank file; each Python worker builds it once."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, limit: int = SPLIT_CHARS) -> Iterator[str]:
    """The text in parts of about ``limit`` characters that begin and end with matches of the pattern."""
    start = 0
    while len(text) - start > limit:
        at = start + limit
        while at > start and not (text[at] in " \n" and not text[at - 1].isspace()):
            at = max(text.rfind(" ", start, at), text.rfind("\n", start, at), start)
        if at == start:  # none before: the next one after
            at = start + limit
            while at < len(text) and not (text[at] in " \n" and not text[at - 1].isspace()):
                after = [p for p in (text.find(" ", at + 1), text.find("\n", at + 1)) if p >= 0]
                at = min(after, default=len(text))
        yield text[start:at]
        start = at
    yield text[start:]


def pieces(text: str, limit: int = SPLIT_CHARS, runs: re.Pattern = RUNS) -> Iterator[tuple[str, bool]]:
    """The text in parts, and whether each is one match that needs no splitting by the pattern."""
    start = 0
    if len(text) > limit:
        for run in runs.finditer(text):
            # the last character belongs to what follows
            end = run.end() - (run.end() < len(text))
            yield from ((part, False) for part in parts(text[start : run.start()], limit))
            yield text[run.start() : end], True
            start = end
    yield from ((part, False) for part in parts(text[start:], limit))


def encode_text(text: str, tokenizer, limit: int = SPLIT_CHARS, runs: re.Pattern = RUNS) -> bytes:
    packed = []
    for part, whole in pieces(text, limit, runs):
        if whole:
            packed.append(np.array(tokenizer._encode_single_piece(part), "<u4").tobytes())
        else:
            packed.append(tokenizer.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes())
    return b"".join(packed)


def decode_tokens(packed: bytes, tokenizer) -> bytes:
    """The raw bytes of the tokens, which need not be whole characters."""
    return tokenizer.decode_bytes(np.frombuffer(packed, "<u4").tolist())


def encode(df: DataFrame, text_column: str, ranks_path: str, pattern: str, limit: int = SPLIT_CHARS) -> DataFrame:
    """``carried`` (the input's row), ``n_tokens`` and ``ids``."""
    source = df.select(carried(df, df.columns).alias("carried"))
    kind = source.schema["carried"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks_path, pattern)
        for batch in batches:
            packed = [encode_text(text or "", tokenizer, limit) for text in texts(batch, text_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
                names=["carried", "n_tokens", "ids"],
            )

    return source.transform(arrow_map, run, f"carried {kind}, n_tokens long, ids binary")


def decode(df: DataFrame, ids_column: str, ranks_path: str, pattern: str) -> DataFrame:
    """``carried`` (the input's row) and ``decoded``, the bytes of the tokens."""
    source = df.select(carried(df, df.columns).alias("carried"))
    kind = source.schema["carried"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks_path, pattern)
        for batch in batches:
            decoded = [decode_tokens(ids or b"", tokenizer) for ids in texts(batch, ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array(decoded, pa.binary())], names=["carried", "decoded"]
            )

    return source.transform(arrow_map, run, f"carried {kind}, decoded binary")
