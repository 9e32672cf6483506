"""Public tokenizers, loaded once a Python worker. Vocabulary files are read from a given path."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

import numpy as np

VOCABULARIES = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"

#: Fixed value: the splitting pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def share(spark, folder: str = VOCABULARIES, file: str = BYTE_BPE) -> None:
    """Send the vocabulary to executors that may not have the folder; they read it where it is, or else what was sent."""
    if (path := Path(folder) / file).exists():
        spark.sparkContext.addFile(str(path))  # a file is sent once a session


def _find(folder: str, file: str) -> Path:
    path = Path(folder) / file
    if path.exists():
        return path
    from pyspark import SparkFiles

    return Path(SparkFiles.get(file))


@lru_cache(maxsize=4)
def byte_bpe(folder: str = VOCABULARIES, file: str = BYTE_BPE):
    """A byte-level BPE encoding without special tokens."""
    import tiktoken

    with _find(folder, file).open("rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def fallback_table(folder: str = VOCABULARIES, file: str = BYTE_BPE) -> np.ndarray:
    """True for the ids of tokens that are raw bytes of a character cut apart."""
    enc = byte_bpe(folder, file)
    out = np.zeros(enc.n_vocab, dtype=bool)
    for token in enc.token_byte_values():
        try:
            token.decode("utf-8")
        except UnicodeDecodeError:
            out[enc.encode_single_token(token)] = True
    return out


def count(text: str | None, folder: str = VOCABULARIES, file: str = BYTE_BPE) -> int:
    return len(byte_bpe(folder, file).encode_ordinary(text)) if text else 0
