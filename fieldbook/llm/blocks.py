"""Blocks of text that share a dictionary, and the compressed rows in which texts travel to it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from fieldbook.llm import textbytes as tb

#: bytes of text that share a dictionary
BLOCK_BYTES = 32 << 20
#: bytes of text in one compressed row
ROW_BYTES = 1 << 20


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Slices of text with their block (by partition, column ``part``, and place in it) and their number in the partition."""
    done = 0
    for seq, batch in enumerate(tb.chunks(batches, "text", ROW_BYTES)):
        yield (batch.column("part")[0].as_py() << 32) | (done // BLOCK_BYTES), seq, batch
        done += int(tb.text_buffer(batch.column("text"))[1][-1])


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, int, int]]:
    """Of rows in order of (block, seq): block, whether these are texts, first and last row; a text row by itself."""
    seqs, of = batch.column("seq").to_numpy(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((np.diff(of) != 0) | (seqs[1:] >= 0)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(seqs)], strict=True):
        if lo < hi:
            yield int(of[lo]), bool(seqs[lo] >= 0), lo, hi
