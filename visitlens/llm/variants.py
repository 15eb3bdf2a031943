"""Spelling variants: near words of a vocabulary by FM-index search schemes.

A word within one edit of another keeps one of its halves whole. So every word
is sought twice: its right half is matched exactly from the closing delimiter
to the left, its left half exactly from the opening delimiter to the right, and
each match is then extended across the other half with one error allowed. Both
directions are backward searches over suffix-rank intervals: the first over the
delimited vocabulary, the second over the vocabulary of mirrored words.

The vocabulary is dealt by half: a word is sought only where the words stand
that begin (or end) with that half, so an index holds a bounded share of the
vocabulary, and a half that very many words share is cut into slices that each
get all of its queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import stage

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: least length and number of occurrences of a word; a form is so many times as frequent
MIN_CHARS, MIN_COUNT, FORM_RATIO = 6, 5, 5
#: one run in so many loses a letter
DROP_ONE_IN = 199
#: index words of a shard, about; queries searched at a time
SHARD_WORDS, QUERIES = 100_000, 20_000
#: symbols of the queries searched at a time, at most (one very long word aside)
AREA = 1 << 20


class RankIndex:
    """FM-index of distinct words: the suffix ranks of the words' text, each
    word between delimiters, and for each symbol the ranks it precedes."""

    def __init__(self, words: list[str]):
        by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        self.word_at = by_word  # the i-th word of the text
        lengths = np.array([len(words[i]) for i in by_word], np.int64)
        points = np.frombuffer("".join(words[i] for i in by_word).encode("utf-32-le"), np.uint32)
        self.alphabet, dense = np.unique(points, return_inverse=True)
        self.n = n = len(points) + len(words) + 1
        stops = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.zeros(n, np.int64)
        letters = np.ones(n, bool)
        letters[stops] = False
        text[letters] = dense + 1
        # delimiters rank by their place: words are sorted, so that is also the order of what follows
        rank = np.empty(n, np.int64)
        rank[stops] = np.arange(len(stops))
        rank[letters] = dense + len(stops)
        reach, longest = 1, int(lengths.max(initial=0)) + 1
        order = np.argsort(rank, kind="stable")
        while reach <= longest:  # twice as many characters compared a round
            nxt = np.full(n, -1, np.int64)
            nxt[:-reach] = rank[reach:]
            key = rank * (n + 1) + nxt + 1
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            if rank[order[-1]] == n - 1:
                break
            reach *= 2
        self.before = text[order - 1]  # the symbol before each suffix, by rank
        places = np.argsort(self.before, kind="stable")
        self.places = self.before[places] * n + places
        self.symbols = len(self.alphabet) + 1

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; one that no indexed word has: -1."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, -1)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes one ``symbol`` longer at the front."""
        base = symbol * self.n
        return np.searchsorted(self.places, base + lo), np.searchsorted(self.places, base + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) for every letter before some suffix of the state's
        interval: read off a short interval, tried one by one for a long one."""
        size = hi - lo
        short = np.flatnonzero(size < self.symbols)
        state = np.repeat(short, size[short])
        offset = np.arange(len(state)) - np.repeat(np.cumsum(size[short]) - size[short], size[short])
        seen = np.unique(state * self.symbols + self.before[lo[state] + offset])
        long_ = np.flatnonzero(size >= self.symbols)
        tried = (long_[:, None] * self.symbols + np.arange(1, self.symbols)).ravel()
        both = np.concatenate([seen[seen % self.symbols > 0], tried])
        return both // self.symbols, both % self.symbols

    def near(self, queries: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for all words that equal a query but for one edit after
        its first ``exact`` symbols. ``queries`` holds code points, a row each,
        in the order in which the search reads them."""
        pattern = self.codes(queries)
        every = np.arange(len(queries))
        pattern = np.concatenate([pattern, np.zeros((len(queries), 2), np.int64)], axis=1)
        # all suffixes that begin with a delimiter
        q, lo, hi = every, np.zeros(len(queries), np.int64), np.full(len(queries), len(self.word_at) + 1)
        edited = []  # (query, place, lo, hi) after the error
        for at in range(int(lengths.max(initial=0)) + 1):
            live = (hi > lo) & (at <= lengths[q])
            q, lo, hi = q[live], lo[live], hi[live]
            if not len(q):
                break
            free = np.flatnonzero(at >= exact[q])
            if len(free):
                fq, flo, fhi = q[free], lo[free], hi[free]
                state, letter = self.branches(flo, fhi)
                blo, bhi = self.extend(letter, flo[state], fhi[state])
                other = (bhi > blo) & (letter != pattern[fq[state], at])
                bq, blo, bhi = fq[state][other], blo[other], bhi[other]
                # one letter more than the query (before another letter: one way for each word)
                edited.append((bq, np.full(len(bq), at), blo, bhi))
                # another letter
                inside = at < lengths[bq]
                edited.append((bq[inside], np.full(inside.sum(), at + 1), blo[inside], bhi[inside]))
                # one letter less (the last of equal ones)
                less = (at < lengths[fq]) & (pattern[fq, at] != pattern[fq, at + 1])
                edited.append((fq[less], np.full(less.sum(), at + 1), flo[less], fhi[less]))
            more = at < lengths[q]
            q, lo, hi = q[more], lo[more], hi[more]
            lo, hi = self.extend(pattern[q, at], lo, hi)
        if not edited:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        q, at, lo, hi = (np.concatenate(x) for x in zip(*edited))
        found = []
        while len(q):
            # beyond the query's end its symbol is the delimiter
            end = at >= lengths[q]
            lo, hi = self.extend(np.where(end, 0, pattern[q, at]), lo, hi)
            hit = end & (hi > lo)
            found.append((q[hit], lo[hit]))
            go = ~end & (hi > lo)
            q, at, lo, hi = q[go], at[go] + 1, lo[go], hi[go]
        q, at = (np.concatenate(x) for x in zip(*found))
        # the first rank that a delimiter precedes is the text's begin, the others are words in order
        return q, self.word_at[at - 1]


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row per word (0 beyond its end), and the lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(lengths.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return out, lengths


def shard_pairs(words: list[str], indexed: np.ndarray, asked: np.ndarray, left: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) numbers of near words among ``words``, those of ``indexed``
    against the queries ``asked``. ``left``: the left half is the exact one;
    else the right one, and words that begin with the query's left half are left
    to that search."""
    if not len(indexed) or not len(asked):
        return
    index = RankIndex([words[i] if not left else words[i][::-1] for i in indexed])
    size = np.array([len(w) for w in words], np.int64)
    asked, a = asked[np.argsort(size[asked], kind="stable")], 0
    while a < len(asked):
        k = QUERIES
        while k > 1 and k * size[asked[min(a + k, len(asked)) - 1]] > AREA:
            k //= 2
        ask = asked[a:a + k]
        a += k
        half = size[ask] // 2
        read, _ = _matrix([words[i] if left else words[i][::-1] for i in ask])
        q, w = index.near(read, size[ask], half if left else size[ask] - half)
        w = indexed[w]
        if not left:
            begin, _ = _matrix([words[i][:h] for i, h in zip(ask, half)])
            other, _ = _matrix([words[i][:h] for i, h in zip(w, half[q])])
            begin = begin[q][:, :other.shape[1]]
            differs = (begin != other).any(axis=1)
            q, w = q[differs], w[differs]
        yield ask[q], w


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n): lower-cased (A-Z only) runs of letters of all texts, one letter
    dropped from the runs that a hash of document and run picks, of at least
    ``min_chars`` code points and ``min_count`` occurrences. A null text has no
    words; a null doc_id counts as empty in the hash; rows count each, repeated
    ones too."""
    # a run only gets shorter, so shorter runs can be passed over at once
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    run, size = F.col("_run"), F.char_length("_run")
    h = F.crc32(F.concat(F.coalesce(F.col("_id"), F.lit("")), F.lit(":"), run))
    at = (h % size).cast("int")
    dropped = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    words = (docs.select(F.col("doc_id").cast("string").alias("_id"), F.explode(runs).alias("_run"))
             .select(F.when(h % drop_one_in == 0, dropped).otherwise(run).alias("word"))
             .where(F.char_length("word") >= min_chars))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _halves(word: Column, min_chars: int) -> Column:
    """The halves under which a word is indexed: those that words one shorter,
    as long and one longer would seek, and whether they are its own."""
    size = F.char_length(word)
    lengths = F.filter(F.array(size - 1, size, size + 1), lambda n: n >= min_chars)
    left = F.transform(lengths, lambda n: F.struct(F.lit(True).alias("left"), F.substring(word, F.lit(1), F.floor(n / 2).cast("int")).alias("half")))
    right = F.transform(lengths, lambda n: F.struct(
        F.lit(False).alias("left"), F.substring(word, (size - F.ceil(n / 2) + 1).cast("int"), F.ceil(n / 2).cast("int")).alias("half")))
    return F.array_distinct(F.concat(left, right))


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS, shard_words: int = SHARD_WORDS, pairs: bool = True) -> DataFrame:
    """(word, near, near_n): every word of ``words`` (word, n; distinct words of
    at least ``min_chars`` >= 2 code points) with each of its near words, those
    that differ by exactly one inserted, deleted or replaced code point.

    With ``pairs`` False one row per word and shard instead, its near words
    counted: (word, n_near, near_n, near), the last two of the most frequent
    one (ties: the least). A word without near words has no row."""
    size = F.char_length("word")
    own = F.array(F.struct(F.lit(True).alias("left"), F.substring(F.col("word"), F.lit(1), F.floor(size / 2).cast("int")).alias("half")),
                  F.struct(F.lit(False).alias("left"), F.substring(F.col("word"), (F.floor(size / 2) + 1).cast("int"), size).alias("half")))
    keyed = (words.select("word", "n", F.explode(_halves(F.col("word"), min_chars)).alias("key"), own.alias("own"))
             .select("word", "n", "key.left", "key.half", F.array_contains("own", F.col("key")).alias("asks")))
    # slices of a half that many words share; one count per half, most of them one slice
    slices = (keyed.groupBy("left", "half").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > shard_words)
              .withColumn("slices", F.ceil(F.col("held") / shard_words).cast("int")).drop("held"))
    dealt = (keyed.join(slices, ["left", "half"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
             .withColumn("home", F.pmod(F.xxhash64("word"), "slices").cast("int")))
    to = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array("home"))
    shards = max(1, math.ceil(keyed.count() / shard_words))
    rows = (dealt.select("word", "n", "left", "half", "asks", "home", F.explode(to).alias("slice"))
            .select(F.pmod(F.xxhash64("left", "half", "slice"), F.lit(shards)).alias("shard"), "word", "n", "left", "asks",
                    F.char_length("half").alias("chars"), (F.col("slice") == F.col("home")).alias("held")))

    def search(table: pa.Table) -> pa.Table:
        out = []
        for left in (True, False):
            part = table.filter(pa.compute.equal(table["left"], left))
            if not part.num_rows:
                continue
            column = part["word"].combine_chunks().dictionary_encode()
            word, words_here = column.indices.to_numpy(), column.dictionary
            names = words_here.to_pylist()
            n = np.zeros(len(names), np.int64)
            n[word] = part["n"].to_numpy()
            half, holds, asks = (part[c].to_numpy(zero_copy_only=False) for c in ("chars", "held", "asks"))
            # the halves under which a word stands here; it may stand elsewhere under others
            reach = int(half.max()) + 1
            stands = np.unique(word[holds].astype(np.int64) * reach + half[holds])
            flags = np.unique(word[holds]), np.unique(word[asks])
            size = np.array([len(x) for x in names], np.int64)
            in_order = np.empty(len(names), np.int64)
            in_order[np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(len(names))
            for q, w in shard_pairs(names, *flags, left):
                own_half = size[q] // 2 if left else size[q] - size[q] // 2
                here = np.isin(w * reach + own_half, stands)
                q, w = q[here], w[here]
                if not len(q):
                    continue
                if pairs:
                    out.append(pa.table([words_here.take(pa.array(q)), words_here.take(pa.array(w)), pa.array(n[w])], ["word", "near", "near_n"]))
                    continue
                order = np.lexsort((in_order[w], -n[w], q))
                q, w = q[order], w[order]
                first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
                counts = np.diff(np.append(first, len(q)))
                out.append(pa.table([words_here.take(pa.array(q[first])), pa.array(counts), pa.array(n[w[first]]), words_here.take(pa.array(w[first]))],
                                    ["word", "n_near", "near_n", "near"]))
        return pa.concat_tables(out) if out else empty

    schema = "word string, near string, near_n long" if pairs else "word string, n_near long, near_n long, near string"
    kinds = {"string": pa.string(), "long": pa.int64()}
    empty = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]).empty_table()
    return rows.groupBy("shard").applyInArrow(search, schema)


def roots(links: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of (word, form) links without cycles, by pointer doubling:
    after ``rounds`` joins paths of up to 2 ** rounds links are followed."""
    found = links.select("word", F.col("form").alias("root"))
    for i in range(rounds):
        found = stage(found, f"variants-roots{i}")
        on = found.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        found = found.join(on, found["root"] == on["_at"], "left").select("word", F.coalesce("_next", "root").alias("root"))
    return found


def variant_groups(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """Per word of the documents' vocabulary: ``word``, ``form`` (its most
    frequent near word, ties by code points, if that is at least ``ratio`` > 1
    times as frequent; else null), ``root`` (the end of the forms' chain; the
    word itself without a form), ``n``, ``n_near`` and ``form_n``. Texts that are
    null, empty or without letters add nothing; an empty table gives no rows."""
    words = stage(vocabulary(docs, min_chars, min_count), "variants-words")
    counted = (near_pairs(words, min_chars, pairs=False).groupBy("word")
               .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")))
    near = counted.select(F.col("word").alias("_word"), "n_near", "best")
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    formed = stage(words.join(near, F.col("word") == F.col("_word"), "left")
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")),
                   "variants-forms")
    links = formed.where("form IS NOT NULL").select("word", "form")
    # counts grow by the ratio from link to link, which bounds a chain's length
    most = formed.agg(F.max("n")).first()[0] or min_count
    longest = max(1, math.floor(math.log(max(most / min_count, 1), ratio)) + 1)
    ends = roots(links, math.ceil(math.log2(longest))).select(F.col("word").alias("_word"), "root")
    return (formed.join(ends, F.col("word") == F.col("_word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
