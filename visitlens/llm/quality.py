"""Quality rules (operator 10): base counts and compression bands.

A text is compressed whole and in fixed chunks by zstandard. Ratios (compressed
over plain bytes) below the lower limit of its length mean repetitive text,
above the upper limit incompressible text. Each row is judged by itself in an
Arrow batch; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, texts_as_bytes

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
#: bytes that begin a character in UTF-8
LEADING = bytes(b for b in range(256) if b & 0xC0 != 0x80)
MOST_REPEATED = 20  # percent of the words


@dataclass(frozen=True)
class Bands:
    """Limits of compression ratios. ``whole``: (bytes from, lowest, highest),
    by length; a text shorter than the first is not judged. ``chunk`` limits
    hold for every full chunk of ``chunk_bytes``; for the rest after the last
    one the highest of its length does, and the chunks' lowest. A text with more than ``bad_share`` of its judged
    bytes in chunks outside is rejected. The highest lie between prose and
    random letters and digits of that length; below 120 bytes zstandard stores
    prose with a number or two as it stands, like random text, so there is none.

    They are those of prose in Latin letters. Other scripts say as much in fewer,
    longer characters and compress less: of a piece (text or chunk) with at least
    ``scripts[i][0]`` bytes a character on average the highest are ``scripts[i][1]``
    (bytes from, highest); below the first length there is none. Random letters and
    digits have one byte a character, so they keep the limits above in whatever
    text they stand as a chunk."""

    whole: tuple[tuple[int, float, float], ...] = (
        (100, 0.40, float("inf")), (120, 0.40, 0.975), (150, 0.40, 0.925), (200, 0.40, 0.88), (300, 0.38, 0.80), (600, 0.38, 0.73),
        (1_000, 0.34, 0.68), (3_000, 0.30, 0.63), (10_000, 0.26, 0.60), (50_000, 0.22, 0.58))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.15, 0.65)
    scripts: tuple[tuple[float, tuple[tuple[int, float], ...]], ...] = (
        (2.2, ((600, 0.97), (3_000, 0.90), (10_000, 0.85))), (1.15, ((300, 0.93), (1_000, 0.84), (3_000, 0.77))))
    bad_share: float = 0.25
    level: int = 3


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        h = (h ^ ids[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    in_order = np.sort(h)
    if not (in_order[1:] == in_order[:-1]).any():
        return 0
    # windows of equal hash: numbered exactly, by what they hold
    seen: dict[tuple, int] = {}
    number = np.fromiter((seen.setdefault(w, len(seen)) for w in zip(*(words[i:] for i in range(window)))), dtype=np.int64, count=n)
    twice = np.flatnonzero(np.bincount(number)[number] > 1)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(marks, twice, 1)
    np.add.at(marks, twice + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    chars = text.decode("utf-8", "replace")
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(chars) - sum(map(chars.count, " \t\n\x0b\x0c\r")), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(words))


def _highest(piece: bytes, latin: float, bands: Bands) -> float:
    """Highest ratio for a piece: ``latin``, unless its script has limits of its own."""
    chars = len(piece) if piece.isascii() else len(piece) - len(piece.translate(None, LEADING))
    for least, limits in bands.scripts:
        if len(piece) >= least * chars:
            return next((high for size, high in reversed(limits) if len(piece) >= size), float("inf"))
    return latin


def _limits(piece: bytes, bands: Bands) -> tuple[float, float] | None:
    """Lowest and highest ratio for a piece; None: too short to judge."""
    found = next(((low, high) for least, low, high in reversed(bands.whole) if len(piece) >= least), None)
    return found and (found[0], _highest(piece, found[1], bands))


def compression(text: bytes, bands: Bands, codec: zstandard.ZstdCompressor) -> tuple[float | None, float, bool]:
    """Ratio of the whole text, share of its judged bytes in chunks outside
    their limits, and whether both pass."""
    if not text:
        return None, 0.0, True
    ratio = len(codec.compress(text)) / len(text)
    judged = bad = 0
    for i in range(0, len(text), bands.chunk_bytes):
        part = text[i:i + bands.chunk_bytes]
        if len(part) == bands.chunk_bytes:
            limits = bands.chunk[0], _highest(part, bands.chunk[1], bands)
        else:
            limits = _limits(part, bands)
            limits = limits and (bands.chunk[0], limits[1])
        if limits:
            judged += len(part)
            x = len(codec.compress(part)) / len(part) if len(part) < len(text) else ratio
            bad += 0 if limits[0] <= x <= limits[1] else len(part)
    share = bad / judged if judged else 0.0
    limits = _limits(text, bands)
    return ratio, share, share <= bands.bad_share and (not limits or limits[0] <= ratio <= limits[1])


def _judge(bands: Bands):
    def run(batches):
        codec = zstandard.ZstdCompressor(level=bands.level)
        for b in batches:
            texts = texts_as_bytes(b)
            counts = list(zip(*map(base_counts, texts))) or [()] * 5
            packed = list(zip(*(compression(t, bands, codec) for t in texts))) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), *(pa.array(c, pa.int64()) for c in counts), pa.array(packed[0], pa.float64()),
                 pa.array(packed[1], pa.float64()), pa.array(packed[2], pa.bool_())],
                names=["_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "bad_chunks", "in_bands"])
    return run


def judge(docs: DataFrame, keep: list[str], bands: Bands = Bands()) -> DataFrame:
    """The columns ``keep`` of ``docs`` (which has text), the base counts, ratio
    (null for an empty text), bad_chunks, base_failed and kept. Null texts are
    empty: no words, so base_failed. Equal texts get equal verdicts."""
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), docs["text"].alias("text"))
    kind = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(_judge(bands), f"_row {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                         "n_repeat_words long, ratio double, bad_chunks double, in_bands boolean")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & F.col("in_bands")).alias("kept"), "ratio", "bad_chunks")
