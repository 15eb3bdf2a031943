"""Language identification (operator 9): interpolated Kneser-Ney character
models, one per language, in sorted hash arrays.

A text becomes a run of lower-case letters with single spaces for all else.
The n-grams of every language are counted by Spark over a bounded sample of
labelled documents, and one table holds, for each n-gram that any language has
seen, the log probability of its last character in every language. It is kept
as arrays sorted by n-gram hash, so a lookup is a binary search; an n-gram
that no language has seen backs off to the next shorter one, weighted by its
context. The language of least cross-entropy per character wins; a text whose
cross-entropy is above what calibration documents of its language and length
reach is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, chunks, stage, texts_as_bytes

ORDER = 3
DISCOUNT = 0.75
FOLDS = 5
UNKNOWN = "und"
#: labelled documents of one language that its model learns from, at most
#: about; and those that set its limits of rejection
LEARN, CALIBRATE = 4000, 2000
#: characters (code points) counted or scored in one numpy pass
PASS_CHARS = 400_000
#: letters up to which a length class goes, the last one aside
LENGTHS = (20, 100, 400)
BANDS = len(LENGTHS) + 1
#: share of a class's calibration documents below the point that sets its limit
QUANTILE = 0.995
#: documents from which a class has a limit of its own; how many make the spread half as sure as it can be
LEAST, FEW = 5, 20

_classes: np.ndarray | None = None


def _letter_classes() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _classes = table
    return _classes


def letter_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' characters, each text led by a space, without spaces in a row;
    where each text starts (and the end); each text's number of letters."""
    raw = [t.decode("utf-8", "replace") for t in texts]
    code = np.frombuffer("".join(["\0" + t for t in raw]).encode("utf-32-le", "replace"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in raw])))
    chars = _letter_classes()[code]
    letter = chars != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first space after a letter
    keep[starts[:-1]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    letters = np.concatenate(([0], np.cumsum(letter)))
    return chars[keep].astype(np.uint64), kept[starts], np.diff(letters[starts])


def gram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """63-bit hash of the ``n`` characters that end at each place from n - 1 on."""
    h = np.zeros(max(0, len(chars) - n + 1), dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + chars[i:i + len(h)] + np.uint64(1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(1)).astype(np.int64)


def _count(order: int):
    """(lang, n, gram, context, suffix, count) of the batches' texts; suffix is
    the gram without its first character, context without its last."""
    def run(batches):
        for b in batches:
            got: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), texts_as_bytes(b)):
                got.setdefault(lang, []).append(text)
            for lang, texts in got.items():
                for part in chunks(texts, len, PASS_CHARS):
                    chars, starts, _ = letter_runs(part)
                    whose = np.repeat(np.arange(len(part)), np.diff(starts))
                    for n in range(1, order + 1):
                        h = gram_hashes(chars, n)
                        inside = whose[n - 1:] == whose[:len(whose) - n + 1]
                        at = np.flatnonzero(inside)
                        grams, first, count = np.unique(h[at], return_index=True, return_counts=True)
                        at = at[first]
                        empty = np.zeros(len(at), dtype=np.int64)
                        context = gram_hashes(chars, n - 1)[at] if n > 1 else empty
                        suffix = gram_hashes(chars, n - 1)[at + 1] if n > 1 else empty
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(at), pa.string()), pa.array([n] * len(at), pa.int32()), pa.array(grams),
                             pa.array(context), pa.array(suffix), pa.array(count)],
                            names=["lang", "n", "gram", "context", "suffix", "count"])
    return run


@dataclass
class Level:
    """N-grams of one length: sorted ``grams`` with a row of log probabilities,
    and sorted ``contexts`` (of the next longer grams) with a row of log
    back-off weights; a column a language."""

    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass
class Model:
    langs: list[str]
    levels: list[Level]  # by length, from 1
    floor: np.ndarray  # log probability of a character never seen
    limits: np.ndarray | None = None  # (length class, language): highest cross-entropy accepted

    def _log_probs(self, chars: np.ndarray, n: int, ends: np.ndarray) -> np.ndarray:
        """Rows of log P(character | n - 1 before it) for the places ``ends``."""
        if n == 0:
            return np.broadcast_to(self.floor, (len(ends), len(self.langs)))
        level = self.levels[n - 1]
        want = np.zeros(len(ends), dtype=np.int64)
        h = gram_hashes(chars, n)[ends - (n - 1)] if len(ends) else want
        at = np.searchsorted(level.grams, h)
        at[at == len(level.grams)] = 0
        known = level.grams[at] == h if len(level.grams) else np.zeros(len(h), dtype=bool)
        if known.all():
            return level.logp[at]
        out = np.empty((len(ends), len(self.langs)), dtype=np.float32)
        out[known] = level.logp[at[known]]
        miss = ~known
        lower = self._log_probs(chars, n - 1, ends[miss])
        if n > 1 and len(level.contexts):
            c = gram_hashes(chars, n - 1)[ends[miss] - (n - 1)]
            at = np.searchsorted(level.contexts, c)
            at[at == len(level.contexts)] = 0
            seen = (level.contexts[at] == c)[:, None]
            lower = lower + np.where(seen, level.backoff[at], np.float32(0))
        out[miss] = lower
        return out

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (rows of languages; infinite without a
        letter) and number of letters of each text."""
        entropy, letters = [], []
        for part in chunks(texts, len, PASS_CHARS):
            chars, starts, n_letters = letter_runs(part)
            whose = np.repeat(np.arange(len(part)), np.diff(starts))
            total = np.zeros((len(part), len(self.langs)))
            order = len(self.levels)
            # all places but each text's leading space; the first ones have shorter contexts
            place = np.arange(len(chars)) - starts[whose]
            for n in range(2, order + 1):
                ends = np.flatnonzero(place == n - 1 if n < order else place >= n - 1)
                lp = self._log_probs(chars, n, ends)
                for k in range(len(self.langs)):
                    total[:, k] += np.bincount(whose[ends], weights=lp[:, k], minlength=len(part))
            scored = np.maximum(np.diff(starts) - 1, 1)
            entropy.append(np.where(n_letters[:, None] > 0, -total / scored[:, None], np.inf))
            letters.append(n_letters)
        if not entropy:
            return np.zeros((0, len(self.langs))), np.zeros(0, dtype=np.int64)
        return np.concatenate(entropy), np.concatenate(letters)


def fit(counts: pd.DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> Model:
    """Interpolated Kneser-Ney from counts (lang, n, gram, context, suffix,
    count): the longest n-grams by their counts, shorter ones by how many
    different n-grams they end."""
    langs = sorted(counts["lang"].unique())
    width, probs, levels = len(langs), {}, []
    column = {x: i for i, x in enumerate(langs)}
    alphabet = counts[counts["n"] == 1]["gram"].nunique() + 1
    floor = np.full(width, -np.log(alphabet), dtype=np.float32)
    for n in range(1, order + 1):
        c = counts[counts["n"] == n]
        if n < order:  # continuation counts: different characters before the gram
            longer = counts[counts["n"] == n + 1]
            c = c.merge(longer.groupby(["lang", "suffix"]).size().rename("mass").reset_index().rename(columns={"suffix": "gram"}),
                        on=["lang", "gram"], how="left").fillna({"mass": 1})
        else:
            c = c.assign(mass=c["count"])
        grams = np.unique(c["gram"])
        info = c.drop_duplicates("gram").set_index("gram").loc[grams]
        mass = np.zeros((len(grams), width))
        mass[np.searchsorted(grams, c["gram"]), c["lang"].map(column)] = c["mass"]
        contexts, group = np.unique(info["context"], return_inverse=True)
        total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, group, mass)
        np.add.at(kinds, group, mass > 0)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if n == 1:
            lower = np.exp(floor)[None, :]
        else:  # every suffix of a gram that was seen was seen itself
            lower = probs[n - 1][np.searchsorted(levels[-1].grams, info["suffix"])]
        p = np.maximum(mass - discount, 0) / np.maximum(total, 1)[group] + weight[group] * lower
        probs[n] = p
        levels.append(Level(grams, np.log(p).astype(np.float32), contexts, np.log(weight).astype(np.float32)))
    floor = floor + levels[0].backoff[0] if len(levels[0].contexts) else floor
    return Model(langs, levels, floor.astype(np.float32))


def fold(doc_id):
    """crc32 of the id as text, modulo the number of folds (a column)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, learn: int = LEARN, calibrate: int = CALIBRATE, order: int = ORDER) -> Model:
    """A model from the rows with text and lang whose fold is not 0.

    A language learns from about ``learn`` of its documents, taken by a hash of
    doc_id, and its limits come from about ``calibrate`` others; with fewer it
    takes all, the last third of hash values for the limits.
    """
    rows = docs.where("text is not null and lang is not null").where(fold(docs["doc_id"]) != 0)
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not have:
        return Model([], [], np.zeros(0, dtype=np.float32), np.zeros((BANDS, 0)))
    draw = (F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30))
    share = {k: min(1.0, (learn + calibrate) / n) for k, n in have.items()}
    upto = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v)])[F.col("lang")]
    split = learn / (learn + calibrate)
    sample = stage(rows.withColumn("_draw", draw / upto).where("_draw < 1").select("lang", "text", "_draw"), "lang-sample")
    counts = (sample.where(F.col("_draw") < split).select("lang", "text")
              .mapInArrow(_count(order), "lang string, n int, gram long, context long, suffix long, count long")
              .groupBy("lang", "n", "gram").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.sum("count").alias("count")))
    table = counts.toPandas()
    if table.empty:
        return Model([], [], np.zeros(0, dtype=np.float32), np.zeros((BANDS, 0)))
    model = fit(table, order)
    held = sample.where(F.col("_draw") >= split).select("lang", "text").mapInArrow(
        _own_entropy(model), "band int, lang int, entropy double").groupBy("band", "lang").agg(
        F.percentile("entropy", F.array(F.lit(0.5), F.lit(QUANTILE))).alias("at"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).collect()
    limits = np.full((BANDS, len(model.langs)), np.nan)
    for band, lang, (median, high), n in held:
        # as far beyond the quantile as that lies beyond the median: the class's own spread, which few
        # documents show the less the fewer they are
        limits[band, lang] = high + (high - median) * (1 + FEW / n)
    # a class with fewer than LEAST calibration documents takes the highest limit of its language, or none; shorter
    # texts scatter more, so none has a lower limit than the longer ones
    for k in range(len(model.langs)):
        top = np.nanmax(limits[:, k]) if not np.isnan(limits[:, k]).all() else np.inf
        limits[:, k] = np.maximum.accumulate(np.where(np.isnan(limits[:, k]), top, limits[:, k])[::-1])[::-1]
    model.limits = limits
    return model


def _band(letters: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, letters, side="left")


def _own_entropy(model: Model):
    """Cross-entropy of each calibration document that gets its own label."""
    place = {x: i for i, x in enumerate(model.langs)}

    def run(batches):
        for b in batches:
            entropy, letters = model.score(texts_as_bytes(b))
            best = entropy.argmin(axis=1)
            own = np.array([place.get(x, -1) for x in b.column("lang").to_pylist()])
            ok = np.flatnonzero((best == own) & (letters > 0))
            yield pa.RecordBatch.from_arrays([pa.array(_band(letters)[ok].astype(np.int32)), pa.array(best[ok].astype(np.int32)),
                                              pa.array(entropy[ok, best[ok]], pa.float64())], names=["band", "lang", "entropy"])
    return run


def _predict(model: Model):
    def run(batches):
        for b in batches:
            texts = texts_as_bytes(b)
            if model.langs:
                entropy, letters = model.score(texts)
                best = entropy.argmin(axis=1)
                least = entropy[np.arange(len(best)), best]
                lang = np.where(letters > 0, np.array(model.langs, dtype=object)[best], UNKNOWN)
                # how far the best language is ahead, over up to 50 characters
                with np.errstate(over="ignore", invalid="ignore"):
                    gap = (entropy - least[:, None]) * np.minimum(np.maximum(letters, 1), 50)[:, None]
                    score = np.where(letters > 0, 1 / np.exp(-np.where(np.isfinite(gap), gap, 0)).sum(axis=1), 0.0)
                rejected = (letters == 0) | (least > model.limits[_band(letters), best])
                entropy_out = pa.array(np.where(letters > 0, least, np.nan), pa.float64(), mask=letters == 0)
            else:
                _, _, letters = letter_runs(texts)
                lang, score, rejected = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
                entropy_out = pa.nulls(len(texts), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()),
                 entropy_out], names=["_row", "lang_pred", "score", "rejected", "cross_entropy"])
    return run


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` (which has text) and lang_pred, score
    (0 to 1: the posterior of the best language over up to 50 characters),
    rejected, cross_entropy (nats per character). Null texts and texts without
    a letter: ``und``, 0, rejected, null. Without any language to learn every
    row is ``und`` and rejected."""
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), docs["text"].alias("text"))
    kind = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(_predict(model), f"_row {kind}, lang_pred string, score double, rejected boolean, cross_entropy double")
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], *[c for c in out.columns if c != "_row"])


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out (fold 0), lang_pred, score, rejected, cross_entropy of
    every row; the model learns from the other folds."""
    arrow_rows(docs.sparkSession)
    out = identify(docs, train(docs), ["doc_id"])
    return out.withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)))
