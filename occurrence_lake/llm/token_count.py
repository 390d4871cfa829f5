"""Token counts of whole texts.

Texts go to Python in Arrow batches and only lengths come back.  A text is
cut at *safe boundaries* first: a space that follows a character other than
space or U+2581.  No vocabulary piece holds U+2581 after another character
(checked when the model is loaded), so no merge crosses such a cut, and the
encoder's own dummy prefix stands for the removed space.  Equal chunks are
encoded once per batch, and the chunks are handed to the library in batches
of bounded bytes, so a very long text costs no more memory than many short
ones.

Defined results: null or empty text counts 0 bytes and 0 tokens; repeated
rows give repeated results; an empty table gives an empty result; further
columns of the input, of any name, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from occurrence_lake.llm.common import process_cache, ship

#: Bytes of chunks given to the encoder at once, and most chunks remembered.
BATCH_BYTES = 1 << 20
CACHE_CHUNKS = 200_000

_CUT = re.compile("(?<=[^ ▁]) (?=.)", re.S)


def safe_chunks(text: str) -> list[str]:
    """Cut a text at its safe boundaries; the space of a cut goes."""
    if not text:
        return []
    if "  " in text or "▁" in text or text[0] == " " or text[-1] == " ":
        return _CUT.split(text)
    return text.split(" ")


def byte_batches(chunks: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Consecutive batches of at most ``limit`` bytes (or one longer chunk)."""
    batch: list[str] = []
    size = 0
    for c in chunks:
        n = 4 * len(c) if not c.isascii() else len(c)
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(c)
        size += n
    if batch:
        yield batch


def load_piece_model(path: str):
    """The encoder, and whether cuts at single spaces are safe for it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    safe = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.vocab_size()))
    # identity normalisation with a dummy prefix and no white-space removal
    probe = "a  b ½ c"
    pieces = [sp.id_to_piece(i) for i in sp.encode(probe)]
    safe = safe and "".join(pieces) == "▁" + probe.replace(" ", "▁")
    return sp, safe


def count_tokens(texts: list[str | None], sp, safe: bool, known: dict[str, int]) -> list[int]:
    """Tokens of every text; ``known`` remembers the lengths of chunks."""
    cut = [(safe_chunks(t) if safe else [t]) if t else [] for t in texts]
    fresh = list({c for chunks in cut for c in chunks if c not in known})
    local = known
    if len(known) + len(fresh) > CACHE_CHUNKS:
        local = {c: known[c] for chunks in cut for c in chunks if c in known}
        known.clear()
    for batch in byte_batches(fresh):
        local.update(zip(batch, map(len, sp.encode(batch, num_threads=1))))
    out = [sum(map(local.__getitem__, chunks)) for chunks in cut]
    if local is not known and len(local) <= CACHE_CHUNKS:
        known.update(local)
    return out


def text_slices(column: pa.Array, limit: int = 8 * BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text (or one longer row)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``
    (more than ``limit`` tokens).  Map only: no shuffle."""
    id_type = df.schema[id_col].dataType.simpleString()

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        sp, safe, known = process_cache(f"pieces:{model_path}", lambda: (*load_piece_model(model_path), {}))
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = part.column(1)
                n = pa.array(count_tokens(texts.to_pylist(), sp, safe, known), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64()), n, pc.greater(n, limit)],
                    names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        counts, f"id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


ship(__name__)
