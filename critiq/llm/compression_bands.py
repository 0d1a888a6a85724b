"""Quality rules: zstandard compression bands.

A text's compression ratio (bytes over compressed bytes) says how repetitive it
is: copied or templated text compresses far better than prose, random bytes and
encoded data hardly at all. How well plain prose compresses depends on its length,
so the limits do too. The ratio is taken of the whole document and of each
fixed chunk of it (the last may be shorter); a document passes if its own ratio
lies in the band of its length and chunks outside the band of theirs hold at most
``max_bad_share`` of its bytes.

The base rules come first: at least 50 words, and at most half of the words
inside three-word windows that the text repeats.

Defined cases: a null text is an empty one; empty texts have ratio 0, no chunks and
fail the base rules; every row is judged alone, so repeated rows are judged alike;
texts of any length are compressed whole, chunk by chunk; an empty table gives an
empty result; other columns are ignored (``keep_clean`` returns them all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import pieces, text_bytes

#: From so many bytes on: lowest and highest ratio of prose. Short texts gain little
#: and cannot fall far, long ones gain from their own vocabulary. Words of random letters have 1.6 to 1.7 from 1 KB on, of
#: hexadecimal digits 1.9, of decimal digits 2.1; the floors pass below prose, and above each of them as soon as prose is clear of it.
BANDS = (
    (0, 0.0, 4.0),
    (256, 1.20, 4.0),
    (512, 1.30, 4.0),
    (1024, 1.50, 4.5),
    (2048, 1.72, 4.5),
    (4096, 1.80, 5.0),
    (8192, 2.02, 5.0),
    (16384, 2.21, 5.5),
    (65536, 2.25, 6.0),
)
LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_SHARE = 0.2
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunk_bytes long"
)

_SPACE = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur at least twice."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n = len(ids) - window + 1
    key = ids[:n]
    for k in range(1, window):
        if int(key.max()) >= (1 << 62) // len(number):
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : k + n]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(key, twice)
    inside = np.zeros(len(ids), bool)
    for k in range(window):
        inside[k : k + n] |= found
    return int(inside.sum())


def base_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    return (
        len(words),
        len(text.translate(None, _SPACE + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def in_band(ratio: float, n_bytes: int, bands=BANDS) -> bool:
    low, high = next((lo, hi) for at, lo, hi in reversed(bands) if n_bytes >= at)
    return low <= ratio <= high


def compression_verdict(text: bytes, compress, chunk_bytes=CHUNK_BYTES, max_bad_share=MAX_BAD_SHARE, bands=BANDS):
    """(passes, ratio of the whole, bytes in chunks outside their band)."""
    if not text:
        return False, 0.0, 0
    ratio, bad = len(text) / len(compress(text)), 0
    for at in range(0, len(text), chunk_bytes):
        chunk = text[at : at + chunk_bytes]
        if not in_band(len(chunk) / len(compress(chunk)), len(chunk), bands):
            bad += len(chunk)
    return in_band(ratio, len(text), bands) and bad <= max_bad_share * len(text), ratio, bad


def quality_rules(
    documents: DataFrame,
    level: int = LEVEL,
    chunk_bytes: int = CHUNK_BYTES,
    max_bad_share: float = MAX_BAD_SHARE,
    bands=BANDS,
) -> DataFrame:
    """One row (``SCHEMA``) for each row of ``documents`` (doc_id, text). Narrow: no shuffle."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=level).compress
        for batch in pieces(batches):
            rows = []
            for text in text_bytes(batch.column(1)):
                stats = base_stats(text or b"")
                failed = stats[0] < MIN_WORDS or 100 * stats[4] > MAX_REPEAT_PERCENT * stats[0]
                passes, ratio, bad = compression_verdict(text or b"", compress, chunk_bytes, max_bad_share, bands)
                rows.append((*stats, failed, passes and not failed, ratio, bad))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = [f.strip().split()[0] for f in SCHEMA.split(",")]
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, SCHEMA)


def keep_clean(documents: DataFrame, **how) -> DataFrame:
    """The rows of ``documents`` that pass, with all their columns. The verdict comes with
    the row from one pass, so nothing is joined or shuffled and rows without
    or with equal doc_ids are judged each by its own text."""
    options = {"level": LEVEL, "chunk_bytes": CHUNK_BYTES, "max_bad_share": MAX_BAD_SHARE, "bands": BANDS, **how}
    at = documents.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=options["level"]).compress
        for batch in pieces(batches):
            keep = []
            for text in text_bytes(batch.column(at)):
                words = (text or b"").split()
                failed = len(words) < MIN_WORDS or 100 * repeat_words(words) > MAX_REPEAT_PERCENT * len(words)
                keep.append(
                    not failed
                    and compression_verdict(text, compress, options["chunk_bytes"], options["max_bad_share"], options["bands"])[0]
                )
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(clean, documents.schema)
