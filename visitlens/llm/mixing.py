"""Mixing sources to target weights (operator 3) by a splitting tree.

Targets: the sources' weights share all words; a source stops at ``most`` times
its size and the excess goes to the others by weight. A source's documents
stand on a line in a seeded order that is dealt over buckets, so no source is
ordered in one task; the line is passed as often as the target asks, and the
last pass stops inside the document where the target is reached. A block is
one pass of one document. The sources' exact block quotas are split down a
binary tree of output shards by multivariate hypergeometric draws, every shard
takes its disjoint runs of blocks, and rows are shuffled inside the shard.
Everything is DataFrame functions; the tree is a table of ``shards`` rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import n_words, stage

#: weights by place of the source's name, repeating
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SHARDS = 64
SEED = 20240101
UP_TO_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: documents of a source in one bucket of its line, about
BUCKET_ROWS = 2000
#: possible values up to which a draw is made by inversion; tries of a draw by rejection
FEW_VALUES, TRIES = 40, 60
#: fixed values of the ratio of uniforms for log-concave weights: 2 sqrt(2 / e) and 3 - 2 sqrt(3 / e)
RECTANGLE = (2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e))
#: level of the tree whose nodes become tasks of their own; sources placed between copies of the array
SPREAD_LEVEL, RUN = 3, 256


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size, rows) with ``target``.

    Sources in order of their code points, null last, weigh ``weights`` in
    turn. In order of the share at which a source meets its cap, one stops if
    the level that those before it leave is above that share; the first that
    does not sets the level of all the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    named = sizes.withColumn("weight", F.get(turn, (F.row_number().over(by_name) - 1) % len(weights)))
    named = named.withColumn("stop", most * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / F.sum("weight").over(rest))
    stopped = named.withColumn("level", level).withColumn("over", F.col("level") > F.col("stop"))
    open_level = F.min(F.when(~F.col("over"), F.struct("stop", "level"))).over(whole)["level"]
    return stopped.withColumn("target", F.when(F.col("over"), (most * F.col("source_size")).cast("double"))
                              .otherwise(open_level * F.col("weight"))).drop("weight", "stop", "level", "over")


def _uniform(*parts) -> Column:
    """A number in (0, 1) from a seed and keys."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: ln n! of small n; beyond them Stirling's series is exact to a double's last digits
LN_FACTORIAL = [math.lgamma(n + 1) for n in range(32)]


def _ln_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n < len(LN_FACTORIAL), F.get(F.lit(LN_FACTORIAL), n.cast("int"))).otherwise(series)


def _by_inversion(marked: Column, others: Column, drawn: Column, low: Column, high: Column, *key: Column) -> Column:
    """Hypergeometric draw by adding up the weights of all values from ``low`` on."""
    def ratio(k: Column) -> Column:  # weight of k over weight of k - 1
        return (marked - k + 1).cast("double") * (drawn - k + 1) / (k * (others - drawn + k).cast("double"))

    # weights relative to the lowest value, which is kept small so that sums stay finite
    steps = F.when(high > low, F.sequence(low + 1, high))
    weights = F.coalesce(F.aggregate(steps, F.array(F.lit(1e-150)), lambda acc, k: F.concat(
        acc, F.array(F.element_at(acc, -1) * ratio(k)))), F.array(F.lit(1.0)))
    zero = F.struct(F.lit(0.0).alias("mass"), F.lit(0).cast("long").alias("k"))

    def pick(w: Column) -> Column:
        goal = _uniform(F.lit("u"), *key) * F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
        return _let(goal, lambda g: F.aggregate(w, zero, lambda a, x: F.struct(
            (a["mass"] + x).alias("mass"), (a["k"] + F.when(a["mass"] + x < g, 1).otherwise(0)).alias("k")))["k"])

    return F.least(high, low + _let(weights, pick))


def _by_rejection(marked: Column, others: Column, drawn: Column, low: Column, high: Column, *key: Column) -> Column:
    """Hypergeometric draw by ratio of uniforms: points (u, v) are drawn until
    u * u is at most the weight, relative to the mode's, of the value at v / u.
    The number of tries does not grow with the counts; each is a hash of the key
    and its number. Half of all tries or more are accepted, so that none of
    TRIES is has a probability below 1e-18."""
    total = (marked + others).cast("double")
    mean = drawn * marked / total
    spread = F.sqrt(mean * (others / total) * (total - drawn) / F.greatest(total - 1, F.lit(1.0)) + 0.5)
    mode = F.floor((drawn + 1).cast("double") * (marked + 1) / (total + 2)).cast("long")

    def ln_weight(k: Column) -> Column:
        return -(_ln_factorial(k) + _ln_factorial(marked - k) + _ln_factorial(drawn - k) + _ln_factorial(others - drawn + k))

    def draw(c: Column) -> Column:
        def attempt(i: Column) -> Column:
            u, v = _uniform(F.lit("x"), i, *key), _uniform(F.lit("y"), i, *key)
            at = c["middle"] + c["width"] * (v - 0.5) / u
            k = F.floor(at).cast("long")
            inside = (at >= low) & (at < high + 1)
            return F.when(inside, _let(k, lambda z: F.when(2 * F.log(u) <= ln_weight(z) - c["top"], z)))

        return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("long"),
                                      lambda got, i: F.when(got.isNotNull(), got).otherwise(attempt(i))), c["mode"])

    constants = F.struct((mean + 0.5).alias("middle"), (RECTANGLE[0] * spread + RECTANGLE[1]).alias("width"),
                         ln_weight(mode).alias("top"), mode.alias("mode"))
    return _let(constants, draw)


def hypergeometric(marked: Column, others: Column, drawn: Column, *key: Column) -> Column:
    """How many of ``marked`` are among ``drawn`` of ``marked + others``: an exact
    draw, by inversion where few values are possible, else by rejection."""
    low, high = F.greatest(F.lit(0).cast("long"), drawn - others), F.least(marked, drawn)
    given = F.struct(marked.alias("m"), others.alias("o"), drawn.alias("d"), low.alias("low"), high.alias("high"))

    def of(g: Column) -> Column:
        args = (g["m"], g["o"], g["d"], g["low"], g["high"], *key)
        return (F.when(g["high"] <= g["low"], g["low"]).when(g["high"] - g["low"] > FEW_VALUES, _by_rejection(*args))
                .otherwise(_by_inversion(*args)))

    return _let(given, of)


def splitting_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Block quotas (source_no, blocks) -> (shard, quotas array<long>), one row
    per shard, source_no counting from 0 without gaps. Each node halves its
    blocks exactly: source after source draws its part of what the left child
    still lacks. ``shards`` is a power of two. From SPREAD_LEVEL on every node is
    a task's own."""
    node = quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("source_no", "blocks"))), lambda x: x["blocks"]).alias("quotas"))
    node = node.select(F.lit(0).alias("shard"), "quotas")
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    for level in range(shards.bit_length() - 1):
        if level == SPREAD_LEVEL:
            node = node.repartitionById(1 << level, F.col("shard"))
        total = F.aggregate("quotas", zero, lambda a, q: a + q)

        def state(left: Column, lacks: Column, rest: Column) -> Column:
            return F.struct(left.alias("left"), lacks.alias("lacks"), rest.alias("rest"))

        def place(acc: Column, s: Column) -> Column:
            q = s["q"]
            x = hypergeometric(q, acc["rest"] - q, acc["lacks"], F.lit(seed), F.lit(level), F.col("shard"), s["no"])
            return _let(x, lambda x: state(F.concat(acc["left"], F.array(x)), acc["lacks"] - x, acc["rest"] - q))

        # sources in runs, so that arrays are not copied whole for each of them
        numbered = F.transform("quotas", lambda q, i: F.struct(q.alias("q"), i.alias("no")))
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("quotas") - 1) / RUN).cast("int")),
                           lambda i: F.slice(numbered, i * RUN + 1, F.lit(RUN)))

        def place_run(acc: Column, run: Column) -> Column:
            done = F.aggregate(run, state(none, acc["lacks"], acc["rest"]), place)
            return _let(done, lambda d: state(F.concat(acc["left"], d["left"]), d["lacks"], d["rest"]))

        left = F.when(F.size("quotas") > 0, F.aggregate(runs, state(none, F.floor(total / 2), total), place_run)["left"]).otherwise(none)
        # explode keeps the optimizer from drawing anew for the right child
        node = node.select("shard", "quotas", F.explode(F.array(left)).alias("left"))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        node = node.select(F.explode(F.array(F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("quotas")),
                                             F.struct((F.col("shard") * 2 + 1).alias("shard"), right.alias("quotas")))).alias("n")).select("n.*")
    return node


def _keys(docs: DataFrame, seed: int) -> list[Column]:
    """Two hashes of a row's values: ``key``, the row's place in its source's
    order, and ``twin``, which tells rows apart that share it."""
    return [_hash(docs, seed).alias("key"), _hash(docs, seed + 1).alias("twin")]


def _hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[docs[f.name] if f.dataType.typeName() != "map" else F.to_json(docs[f.name])
                                     for f in docs.schema.fields])


def mix_sizes(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, source, key, twin,
    size, source_size, target, passes (whole times it is taken), last_words
    (taken of it once more), place in its source's line, rows there.

    Null source: a source of its own. Null text: size 0, nothing taken. Null
    and repeated doc_ids are rows like any other; which of two wholly equal
    rows comes first makes no difference. An empty table gives no rows.
    """
    sized = stage(docs.select("doc_id", "source", n_words(docs["text"]).alias("size"), *_keys(docs, seed)), "mix-sizes")
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), weights, most)
    # a target is reached to the word
    goal = F.round("target").cast("long")
    per_source = per_source.select(
        "source", "source_size", "target", F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS)).alias("buckets"),
        F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long").alias("full"),
        "rows", goal.alias("goal")).withColumn("rest", F.col("goal") - F.col("full") * F.col("source_size"))
    keyed = sized.join(per_source, sized["source"].eqNullSafe(per_source["source"])).drop(per_source["source"])
    keyed = keyed.withColumn("bucket", F.pmod("key", F.col("buckets")))
    counts = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    line = Window.partitionBy("source").orderBy("bucket")
    starts = counts.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"),
                           (F.sum("w").over(line) - F.col("w")).alias("w0"), (F.sum("n").over(line) - F.col("n")).alias("n0"))
    rows = keyed.join(starts, keyed["source"].eqNullSafe(starts["_s"]) & (keyed["bucket"] == starts["_b"])).drop("_s", "_b")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "twin")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("at", F.col("w0") + ahead).withColumn("place", F.col("n0") + F.row_number().over(inside) - 1)
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("at"))).cast("long")
    return (rows.withColumn("last_words", last)
            .select("doc_id", "source", "key", "twin", "size", "source_size", "target", F.col("full").alias("passes"),
                    "last_words", "place", "rows"))


def mix_blocks(sizes: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixture of ``mix_sizes``' rows: one row per block, with their columns
    and pass_no, words (those that the block takes), block (its number in the
    source's line over all passes), shard and position, which orders the
    shard's blocks after the shuffle. Documents of which nothing is taken are
    left out."""
    blocks = (sizes.where("size > 0 and (passes > 0 or last_words > 0)")
              .withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.col("passes") - F.when(F.col("last_words") > 0, 0).otherwise(1))))
              .withColumn("words", F.when(F.col("pass_no") < F.col("passes"), F.col("size")).otherwise(F.col("last_words")))
              .withColumn("block", F.col("pass_no") * F.col("rows") + F.col("place")))
    # empty documents leave gaps in the line, which quotas must not count: blocks are numbered up to the last one
    quotas = blocks.groupBy("source").agg((F.max("block") + 1).alias("blocks"))
    quotas = quotas.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    tree = splitting_tree(quotas, shards, seed).select("shard", F.posexplode("quotas").alias("source_no", "quota"))
    ends = F.sum("quota").over(Window.partitionBy("source_no").orderBy("shard"))
    lists = (tree.withColumn("end", ends).groupBy("source_no")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends")))
    lists = lists.join(quotas, "source_no").select(F.col("source").alias("_s"), "ends")
    dealt = blocks.join(lists, blocks["source"].eqNullSafe(lists["_s"])).drop("_s")
    block = F.col("block")
    # a shard's run of a source's line ends before the first block that belongs to the next
    dealt = dealt.withColumn("shard", F.aggregate("ends", F.lit(0), lambda a, e: a + F.when(e <= block, 1).otherwise(0))).drop("ends")
    order = F.xxhash64(F.lit(seed), F.lit("shuffle"), F.col("key"), F.col("pass_no"))
    return dealt.withColumn("position", order)


def taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken
    (words of its blocks in the mixture), blocks and shards (how many)."""
    sizes = stage(mix_sizes(docs, weights, most, seed), "mix-line")
    got = (mix_blocks(sizes, shards, seed).groupBy(F.col("source").alias("_s"), F.col("place").alias("_p"))
           .agg(F.sum("words").alias("taken"), F.count("*").alias("blocks"), F.countDistinct("shard").alias("shards")))
    out = sizes.join(got, sizes["source"].eqNullSafe(got["_s"]) & (sizes["place"] == got["_p"]), "left")
    return out.select("doc_id", "size", "source_size", "target",
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("taken", "blocks", "shards")])


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mixture takes them, columns unchanged: a row for every
    block, by shard and shuffled inside it; a block that stops inside its
    document keeps the text up to its last word."""
    names = docs.columns
    key, twin = _keys(docs, seed)
    keyed = docs.select(key.alias("_key"), twin.alias("_twin"), F.struct(*[docs[c] for c in names]).alias("_row"))
    # rows that are equal in every column share their keys; one stands for all, and the mixture has their blocks
    rows = keyed.groupBy("_key", "_twin").agg(F.first("_row").alias("_row"))
    blocks = mix_blocks(stage(mix_sizes(docs, weights, most, seed), "mix-line"), shards, seed).select(
        F.col("key").alias("_key"), F.col("twin").alias("_twin"), F.col("words").alias("_words"), F.col("size").alias("_size"), "shard", "position")
    out = rows.join(blocks, ["_key", "_twin"]).repartitionByRange(F.col("shard"), F.col("position")).sortWithinPartitions("shard", "position")
    text = F.col("_row")["text"]
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(UP_TO_WORD), F.lit(0)), F.lit(1), F.col("_words").cast("int")), "")
    return out.select(*[F.when(F.col("_words") < F.col("_size"), head).otherwise(text).alias(c) if c == "text"
                        else F.col("_row")[c].alias(c) for c in names])
