"""Quality rules: compression bands.

zstandard ratios (raw bytes / compressed bytes) of the whole text and of fixed
chunks are held against bands that depend on the length: text that packs far
better than prose is repetitive, text that hardly packs is noise."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from quarry.llm.common import codes_of, covered, gram_names, id_text, per_slice, words_of

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Bands:
    """Limits: ``whole`` rows are (least bytes, lowest ratio, highest ratio);
    the last row whose byte bound is reached holds, below the first row a text
    is too short to judge. The lowest ratios lie between prose and noise of the
    same length: line-wrapped base64 and random letters with digits stay below
    them at every length, random lower-case words from 2 048 bytes on (shorter
    ones pack like prose). Chunks of ``chunk_bytes`` (a last one under half of
    that is not judged) use one band; the text fails if more than
    ``chunk_share`` of its judged chunks lie outside."""
    whole: tuple = ((256, 1.25, 4.0), (384, 1.3, 4.0), (512, 1.37, 4.0), (768, 1.47, 4.0), (1024, 1.58, 4.5), (2048, 1.75, 4.5),
                    (4096, 1.87, 5.5), (8192, 2.04, 5.5), (16384, 2.15, 7.0))
    chunk_bytes: int = 2048
    chunk: tuple = (1.7, 5.0)
    chunk_share: float = 0.3
    level: int = 3


def verdict(data: bytes, compress, bands: Bands) -> tuple[float, int, int, bool]:
    """(whole ratio, judged chunks, chunks outside, inside the bands)."""
    if not data:
        return 0.0, 0, 0, True
    ratio = len(data) / len(compress(data))
    band = None
    for least, low, high in bands.whole:
        if len(data) >= least:
            band = (low, high)
    size, judged, outside = bands.chunk_bytes, 0, 0
    if len(data) > size:
        for at in range(0, len(data), size):
            piece = data[at:at + size]
            if 2 * len(piece) < size:
                continue
            judged += 1
            r = len(piece) / len(compress(piece))
            outside += not bands.chunk[0] <= r <= bands.chunk[1]
    fine = (band is None or band[0] <= ratio <= band[1]) and outside <= bands.chunk_share * judged
    return ratio, judged, outside, fine


def repeat_words(counts: np.ndarray, codes: np.ndarray, n: int = 8) -> np.ndarray:
    """Per document: words inside n-word windows that occur twice or more in it."""
    total = len(codes)
    doc = np.repeat(np.arange(len(counts)), counts)
    names = gram_names(codes, n)
    if len(names) == 0:
        return np.zeros(len(counts), np.int64)
    inside = np.flatnonzero(doc[:len(names)] == doc[n - 1:n - 1 + len(names)])
    _, group, times = np.unique(names[inside] * len(counts) + doc[inside], return_inverse=True, return_counts=True)
    mask = covered(inside[times[group] > 1], n, total)
    return np.bincount(doc[mask], minlength=len(counts)).astype(np.int64)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("zstd_ratio", pa.float64()),
                    ("n_chunks", pa.int64()), ("n_chunks_outside", pa.int64())])
DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_chunks_outside long")


def rules(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with the counts, the compression ratios and the
    verdict. A null text counts as empty: no words, so ``base_failed``. Repeated
    rows give repeated results; other columns are ignored."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column(1), "")
        counts, flat = words_of(texts)
        repeats = repeat_words(counts, codes_of(flat)[0])
        compress = zstandard.ZstdCompressor(level=bands.level).compress
        chars = np.asarray(pc.utf8_length(texts), dtype=np.int64)
        rows = []
        for data, n, points, rep in zip(texts.cast(pa.binary()).to_pylist(), counts.tolist(), chars.tolist(), repeats.tolist()):
            lines = [x for x in data.split(b"\n") if x.strip()]
            ratio, judged, outside, fine = verdict(data, compress, bands)
            failed = n < 20 or 100 * rep > 30 * n
            rows.append((n, points - (len(data) - len(data.translate(None, SPACES))),
                         len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), rep,
                         failed, fine and not failed, ratio, judged, outside))
        cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(SCHEMA)[1:])]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], schema=SCHEMA)
    return id_text(docs, id_col, text_col).mapInArrow(per_slice(run), DDL)
