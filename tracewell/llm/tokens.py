"""Token counts under a public tokenizer, exact over whole texts."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_TOKENIZER = "byte_bpe_multi_50k.tiktoken"
# Distinct blank-divided chunks a task remembers.
CHUNK_MEMORY = 300_000

# Texts in which a blank-divided chunk is always counted alone by the tokenizers' pre-token pattern:
# no white space other than blanks and line feeds, no blank next to a line feed or at an end, no runs
# of three line feeds or four blanks.
_UNEVEN = re.compile(r"[^\S \n]|\n | \n|\A[ \n]|[ \n]\Z|\n\n\n|    ")
_THREE, _MARK = "   ", " \x01 "


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Where a named vocabulary file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _encoder(path: str):
    """A function text -> number of tokens for a vocabulary file."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: len(encode(text))
    if path.endswith(".model"):
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(piece.encode(text, num_threads=1))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


class TokenCounter:
    """Counts tokens of texts; repeated chunks between blanks are encoded once.

    The byte-level tokenizers split a text into pre-tokens that never span a
    blank followed by another character, so counts add up over ``" chunk"``.
    Texts with uneven white space, and other tokenizers, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        self.whole = _encoder(path)
        self.by_chunk = path.endswith(".tiktoken")
        self.memory: _Counts = _Counts(self.whole)
        self.feed = self.whole("\n")

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_chunk or _UNEVEN.search(text) or "\x01" in text:
            return self.whole(text)
        if len(self.memory) > CHUNK_MEMORY:
            self.memory = _Counts(self.whole)
        m = self.memory
        get = m.__getitem__
        if _THREE in text:
            text = text.replace(_THREE, _MARK)
        lines = text.split("\n")
        # The first chunk of a line has no blank before it.
        total = (len(lines) - 1) * self.feed
        for line in lines:
            if line:
                head, blank, rest = line.partition(" ")
                total += m.first(head)
                if blank:
                    total += sum(map(get, rest.split(" ")))
        return total


class _Counts(dict):
    """Tokens of ``" chunk"`` by chunk; the empty chunk is a doubled blank and the mark a tripled one."""

    def __init__(self, whole) -> None:
        super().__init__()
        self.whole, self.heads = whole, {}
        self[""] = whole(" ")
        self["\x01"] = whole("  ")

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = self.whole(" " + chunk)
        return n

    def first(self, chunk: str) -> int:
        n = self.heads.get(chunk)
        if n is None:
            if len(self.heads) > CHUNK_MEMORY:
                self.heads.clear()
            n = self.heads[chunk] = self.whole(chunk)
        return n


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what is held per word is bounded by few texts."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        for b in batches:
            n = pa.array([counter.count(t) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], [*b.schema.names[:-1], "n_tokens"])

    return run


def with_token_counts(documents: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None) -> DataFrame:
    """(keep..., n_tokens) of whole texts; a null or empty text has none.  One narrow stage."""
    rows = documents.select(*keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_counter(path or tokenizer_path()), f"{kinds}, n_tokens long")
