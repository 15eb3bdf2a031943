"""Document fingerprints (operator 7): SimHash over word pairs.

Every occurrence of a term (two neighbouring words; a text's only word) votes
for the bits of its 64-bit hash, so a term weighs as often as it occurs; a
fingerprint bit is set if more than half of the votes set it. Votes are added
up in packed counters, three bits' counters in one long, by one hash
aggregation per piece of a text, before anything is shuffled. Fingerprints
within a Hamming radius are found through block tables: the 64 bits are cut
into blocks, each table keeps some of them in front, and any two fingerprints
within the radius agree on the front of at least one table.

Everything is DataFrame functions. The next document in doc_id order comes
from a range-partitioned table of keys, not from one global window.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import stage

BITS = 64
RADIUS = 3
BLOCKS = 6
#: terms of a text that one packed aggregation adds up; a counter has 20 bits
PIECE = 1 << 19
SPACE = " \t\n\x0b\x0c\r"
_FIELDS = 22  # counter i holds bits i, i + 22 and i + 44
_MASK = 1 | 1 << _FIELDS | 1 << 2 * _FIELDS


def terms(text: Column) -> Column:
    """Hashes of the text's terms, one for each occurrence."""
    bare = F.btrim(text, F.lit(SPACE))
    words = F.split(bare, r"[\x20\x09-\x0D]+", -1)
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.lit(1), n - 1)), F.slice(words, F.lit(2), n),
                       lambda a, b: F.xxhash64(a, b))
    return F.when(F.length(bare) > 0, pairs).otherwise(F.array().cast("array<long>"))


def _spread(h: Column, i: int) -> Column:
    return F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_MASK))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` (long) for every distinct ``keys`` of ``texts``,
    which has the column text. No word: 0."""
    # outer: a text without terms keeps its row
    rows = texts.select(*keys, F.posexplode_outer(terms(F.col("text"))).alias("pos", "h"))
    rows = rows.withColumn("piece", F.shiftright(F.coalesce("pos", F.lit(0)), PIECE.bit_length() - 1))
    packed = rows.groupBy(*keys, "piece").agg(
        F.count("h").alias("votes"), *[F.sum(_spread(F.col("h"), i)).alias(f"c{i}") for i in range(_FIELDS)])
    field = F.lit((1 << _FIELDS) - 1)
    ones = [F.shiftrightunsigned(f"c{b % _FIELDS}", b // _FIELDS * _FIELDS).bitwiseAND(field) for b in range(BITS)]
    counts = packed.select(*keys, "votes", F.array(*ones).alias("ones"))
    # almost every text is one piece; the pieces of longer ones are added up bit by bit
    whole = counts.groupBy(*keys).agg(F.sum("votes").alias("votes"), F.collect_list("ones").alias("pieces")).withColumn(
        "ones", F.aggregate(F.slice("pieces", F.lit(2), F.size("pieces")), F.col("pieces")[0],
                            lambda a, p: F.zip_with(a, p, lambda x, y: x + y)))
    bit = [F.when(F.col("ones")[b] * 2 > F.col("votes"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long") for b in range(BITS)]
    return whole.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bit).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return (F.lit(BITS) - F.bit_count(a.bitwiseXOR(b))) / float(BITS)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The fronts of the tables: all choices of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, all_: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fp, other): for every distinct ``fp`` of ``queries``, all other distinct
    fingerprints of ``all_`` within ``radius`` bits."""
    front = F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("front"))
                                for i, m in enumerate(block_masks(radius, blocks))]))
    a = queries.select("fp").distinct().select("fp", front.alias("t")).select("fp", "t.*")
    b = all_.select("fp").distinct().select("fp", front.alias("t")).select(F.col("fp").alias("other"), F.col("t.table").alias("_t"), F.col("t.front").alias("_f"))
    far = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    return (a.join(b, (F.col("table") == F.col("_t")) & (F.col("front") == F.col("_f")) & (far <= radius) & (far > 0))
            .select("fp", "other").distinct())


def near_classes(queries: DataFrame, documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, other, distance, n_documents): for every distinct ``fp`` of
    ``queries``, each fingerprint of ``documents`` (one row a document) within
    ``radius`` bits, itself included, and how many documents have that one."""
    pairs = within_radius(queries, documents, radius).union(queries.select("fp", F.col("fp").alias("other")).distinct())
    size = documents.groupBy(F.col("fp").alias("_fp")).agg(F.count("*").alias("n_documents"))
    return pairs.join(size, pairs["other"] == size["_fp"]).select(
        "fp", "other", F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))).alias("distance"), "n_documents")


def next_in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``next``, a struct of ``order``'s values in the row that
    follows (after the last: the first), nulls first."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ordered")
    it = F.struct(*order)
    first = ranged.groupBy("_range").agg(F.min(it).alias("_first"))
    over = Window.orderBy("_range")
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = first.select(F.col("_range").alias("_r"), F.coalesce(F.lead("_first").over(over), F.min("_first").over(whole)).alias("_carried"))
    inside = F.lead(it).over(Window.partitionBy("_range").orderBy(*order))
    return (ranged.withColumn("_inside", inside).join(carried, F.col("_range") == F.col("_r"))
            .withColumn("next", F.coalesce("_inside", "_carried")).drop("_range", "_r", "_inside", "_carried"))


def document_order(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, text) of ``docs``, by key: doc_id, key, copies,
    n_chars, next_id, next_key. Rows equal in doc_id and text count as one
    document, others of one doc_id follow each other by a hash of the text;
    null doc_ids come first, null texts are empty, the first document follows
    the last."""
    text = F.coalesce(docs["text"], F.lit(""))
    keys = (docs.select(docs["doc_id"].alias("doc_id"), F.xxhash64(text).alias("key"), F.length(text).cast("long").alias("n"))
            .groupBy("doc_id", "key").agg(F.count("*").alias("copies"), F.max("n").alias("n_chars")))
    return stage(next_in_order(keys, ["doc_id", "key"]).select(
        "doc_id", "key", "copies", "n_chars", F.col("next.doc_id").alias("next_id"), F.col("next.key").alias("next_key")), "order")


def edited(docs: DataFrame, order: DataFrame) -> DataFrame:
    """doc_id, key, text and ``edited`` of ``document_order``'s documents: the
    text with its last floor(n_chars / 4) characters replaced by the first as
    many (or all) of the next document's."""
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    quarter = F.floor(F.col("n_chars") / 4)
    heads = order.select(F.col("next_id").alias("_n"), F.col("next_key").alias("_nk"), F.col("doc_id").alias("_d"),
                         F.col("key").alias("_k"), quarter.cast("int").alias("_take"), (F.col("n_chars") - quarter).cast("int").alias("_keep"))
    heads = (texts.join(heads, texts["doc_id"].eqNullSafe(heads["_n"]) & (texts["key"] == heads["_nk"]))
             .select("_d", "_k", "_keep", F.substring("text", F.lit(1), F.col("_take")).alias("_head"))
             .groupBy("_d", "_k", "_keep").agg(F.first("_head").alias("_head")))
    rows = texts.join(heads, texts["doc_id"].eqNullSafe(heads["_d"]) & (texts["key"] == heads["_k"]))
    return rows.select("doc_id", "key", "text", F.concat(F.substring("text", F.lit(1), F.col("_keep")), "_head").alias("edited"))


def fingerprint_report(docs: DataFrame, every: int = 50, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any more columns): doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and for rows whose doc_id is divisible by ``every`` n_within,
    the number of other documents (as in ``document_order``) of another text
    within ``radius`` bits, equal fingerprints included (else null). Which they
    are: ``near_links``, joined to this by fingerprint."""
    order = document_order(docs)
    both = edited(docs, order).select(
        "doc_id", "key", F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
                          F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("t"))
    both = fingerprints(both.select("doc_id", "key", "sha", "t.side", "t.text"), ["doc_id", "key", "sha", "side"])
    fps = stage(both.groupBy("doc_id", "key", "sha").agg(
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("efp")), "fingerprints")
    own = order.withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    rows = fps.join(own, fps["doc_id"].eqNullSafe(own["_d"]) & (fps["key"] == own["_k"])).drop("_d", "_k")
    following = fps.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("fp").alias("_next"))
    rows = rows.join(following, rows["next_id"].eqNullSafe(following["_d"]) & (rows["next_key"] == following["_k"])).drop("_d", "_k")
    asked = fps.where(F.col("doc_id") % every == 0)
    found = near_classes(asked, fps, radius).groupBy("fp").agg(F.sum("n_documents").alias("n"))
    # documents of the same text are not counted; they share the fingerprint
    same = fps.groupBy(F.col("fp").alias("_fp"), F.col("key").alias("_k")).agg(F.count("*").alias("_same"))
    same = same.join(found, same["_fp"] == found["fp"]).select("_fp", "_k", (F.col("n") - F.col("_same")).alias("n"))
    rows = rows.join(same, (F.col("fp") == F.col("_fp")) & (F.col("key") == F.col("_k")), "left")
    return rows.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("_next")).alias("near_next"),
        F.when(F.col("doc_id") % every == 0, F.coalesce("n", F.lit(0))).cast("long").alias("n_within"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def near_links(docs: DataFrame, every: int = 50, radius: int = RADIUS) -> DataFrame:
    """fingerprint, other_fingerprint, distance, n_documents (with the other):
    for every fingerprint of a document whose doc_id is divisible by ``every``,
    the fingerprints of all documents within ``radius`` bits, itself at 0. The
    documents of either are those of ``fingerprint_report`` that have it, so
    links between documents follow without a row for each pair of them."""
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    one = texts.groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    fps = stage(fingerprints(one, ["doc_id", "key"]), "fingerprints")
    return near_classes(fps.where(F.col("doc_id") % every == 0), fps, radius).select(
        as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("other")).alias("other_fingerprint"), "distance", "n_documents")
