"""Secret scans (operator 2) by an incremental blob ledger.

Every text version is addressed by the SHA-256 of its bytes. The ledger holds
one row per blob: which rule versions have seen it and the spans they found.
A run scans each distinct blob once, and only with rule versions the ledger
does not list for it; findings are then joined back to every path that holds
the blob. Everything is DataFrame functions: copies collapse by partial
aggregation before the shuffle, spans come from the lengths of the gaps
between matches (running sums over exploded matches, one blob per group).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """One kind of secret: matches of ``pattern`` (leftmost, not overlapping)
    whose group ``group`` has at least ``least`` characters. ``hint``: a string
    that every match holds, to skip texts without it."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    hint: str | None = None
    version: int = 1

    @property
    def tag(self) -> str:
        return f"{self.name}@{self.version}"


# The base kinds, in the order in which equal starts are listed.
# hex asks for its 32 characters in the pattern: a run that is long enough
# matches whole, from its first character, and a shorter one nowhere.
BASE = (
    Rule("assign", r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                   r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{32,}+", least=32),
)
#: kinds beyond the base ones
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", hint="_"),
)
RULES = BASE + EXTRA
#: what ``redact`` replaces: of a private key also its fields and body to the
#: END line, or without one to the end of the base64 lines
# (possessive groups are matched in a loop, however many lines a key has)
_PEM_FIELDS = r"(?:\s*+[A-Za-z]++-[A-Za-z]++:[^\n]*+)*+"
_PEM_END = r"[^-]*+-----END [A-Z ]*PRIVATE KEY-----"
_PEM_RUN = r"(?:\s*+[A-Za-z0-9+/]{16,}+={0,2}+)++(?:\r?\n[A-Za-z0-9+/]{1,15}+={0,2}+(?=\r?\n|$))?"
WHOLE = BASE + (replace(EXTRA[0], pattern=EXTRA[0].pattern + f"(?:{_PEM_FIELDS}(?:{_PEM_END}|{_PEM_RUN}))?", version=3), EXTRA[1])

_FOUND = "array<struct<start:long,rule:string,end:long>>"
_SPAN = "array<struct<start:long,kind:int,end:long>>"


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _hits(rule: Rule, kind: int, todo: Column) -> Column:
    """Array of (kind, position, gap, length, value length) of a rule's matches."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.when(F.size(found) > 0, F.split(text, rule.pattern, -1))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    hits = F.when(F.size(found) > 0, F.transform(
        F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("len"),
                     F.transform(values, F.length).alias("val")),
        lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), m["gap"].alias("gap"),
                              m["len"].alias("len"), m["val"].alias("val"))))
    ok = todo if rule.hint is None else todo & F.contains(text, F.lit(rule.hint))
    return F.when(ok, F.filter(hits, lambda m: m["len"].isNotNull()))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rules array<string>, spans array<struct<start,
    rule, end>>): one per blob of ``docs.text`` that some of ``rules`` have not
    seen, with the spans of just those rules. Start and end count code points,
    end exclusive. A null text is the empty blob."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = docs.select(_blob(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    tags = [r.tag for r in rules]
    if ledger is None:
        blobs = blobs.withColumn("todo", F.array(*map(F.lit, tags)))
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("todo", F.array_except(F.array(*map(F.lit, tags)), F.coalesce("seen", F.array().cast("array<string>"))))
                 .where(F.size("todo") > 0))
    hits = [F.coalesce(_hits(r, k, F.array_contains("todo", r.tag)),
                       F.array().cast("array<struct<kind:int,pos:int,gap:int,len:int,val:int>>"))
            for k, r in enumerate(rules)]
    rows = blobs.select("blob", "todo", F.explode_outer(F.concat(*hits)).alias("m")).select("blob", "todo", "m.*")
    end = F.sum((F.col("gap") + F.col("len")).cast("long")).over(Window.partitionBy("blob", "kind").orderBy("pos"))
    least = F.get(F.array(*[F.lit(r.least) for r in rules]), F.col("kind"))
    span = F.when(F.col("val") >= least, F.struct(
        (F.col("end") - F.col("len")).alias("start"), F.get(F.array(*map(F.lit, tags)), F.col("kind")).alias("rule"), "end"))
    return (rows.withColumn("end", end)
            .groupBy("blob").agg(F.first("todo").alias("rules"), F.collect_list(span).cast(_FOUND).alias("spans")))


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``, what the ledger has of each row's blob for these
    rule versions (empty without any): array<struct<start, kind, end>>, by
    start, then kind, the rule's place in ``rules``. All rows stay, copies and
    equal ids included."""
    tags = F.array(*[F.lit(r.tag) for r in rules])
    listed = F.transform(F.flatten(F.collect_list("spans")), lambda s: F.struct(
        s["start"].alias("start"), (F.array_position(tags, s["rule"]) - 1).cast("int").alias("kind"), s["end"].alias("end")))
    found = (ledger.where(F.size("spans") > 0).groupBy("blob").agg(listed.alias("_spans"))
             .select(F.col("blob").alias("_blob"),
                     F.sort_array(F.array_distinct(F.filter("_spans", lambda s: s["kind"] >= 0))).alias("_spans")))
    return (docs.withColumn("_blob", _blob(F.col("text"))).join(found, "_blob", "left")
            .withColumn("spans", F.coalesce("_spans", F.array().cast(_SPAN))).drop("_blob", "_spans"))


def secret_spans(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the spans of every row. ``ledger``: folder of a ledger that
    earlier runs have left; this run appends what it scanned. Without one, all
    blobs are new and the ledger is a table of this run alone."""
    spark = docs.sparkSession
    if ledger is None:
        return findings(docs, stage(scan(docs, None, rules), "secret-ledger"), rules)
    schema = f"blob binary, rules array<string>, spans {_FOUND}"
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    scan(docs, spark.read.schema(schema).parquet(ledger), rules).write.mode("append").parquet(ledger)
    return findings(docs, spark.read.schema(schema).parquet(ledger), rules)


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = WHOLE) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; spans
    that overlap count as one. Rows without a span, null texts included, stay
    as they are. A column that is named ``spans`` is kept."""
    names = docs.columns
    found = secret_spans(docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), F.col("text")), None, rules)
    merged = F.aggregate("spans", F.array().cast("array<struct<start:long,end:long>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    # the text from each span's end to the next span's start
    kept = F.transform("_merged", lambda s, i: F.substring(
        F.col("text"), (s["end"] + 1).cast("int"),
        (F.coalesce(F.get("_merged", i + 1)["start"], F.length("text").cast("long")) - s["end"]).cast("int")))
    clean = F.concat(F.substring(F.col("text"), F.lit(1), F.col("_merged")[0]["start"].cast("int")), F.lit(mark), F.array_join(kept, mark))
    done = found.withColumn("_merged", F.when(F.size("spans") > 0, merged)).withColumn(
        "_text", F.when(F.col("_merged").isNotNull(), clean).otherwise(F.col("text")))
    return done.select(*[F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in names])


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of ``findings``."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{r.name}") for k, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_listed(base, rules), 256).alias("base_sha256"),
                        _listed(F.col("spans"), rules).alias("spans"))


# --- the same in SQL (DuckDB), written out by itself ---------------------------------

def digest_sql() -> str:
    kinds = [
        (0, "assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        (1, "access", "AKIA[A-Z0-9]+", 0, 16),
        (2, "hex", "[0-9a-f]{32,}", 0, 32),
        (3, "pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
        (4, "github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ]
    parts = " UNION ALL ".join(
        f"SELECT row, {k} AS k, '{name}' AS name, {least} AS least, "
        f"unnest(string_split_regex(text, '{p}')) AS gap, unnest(regexp_extract_all(text, '{p}', 0)) AS hit, "
        f"unnest(regexp_extract_all(text, '{p}', {g})) AS val, unnest(range(1 + len(regexp_extract_all(text, '{p}', 0)))) AS pos "
        f"FROM d WHERE regexp_matches(text, '{p}')" for k, name, p, g, least in kinds)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({parts}),
p AS (SELECT row, k, name, least, hit, val,
             sum(length(gap) + length(coalesce(hit, ''))) OVER (PARTITION BY row, k ORDER BY pos) AS e FROM m),
s AS (SELECT row, k, name || ':' || CAST(e - length(hit) AS BIGINT) || ':' || CAST(e AS BIGINT) AS span, e - length(hit) AS b
      FROM p WHERE hit IS NOT NULL AND length(val) >= least),
g AS (SELECT row, count(*) FILTER (WHERE k = 0) AS n0, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2,
             string_agg(span, ',' ORDER BY b, k) FILTER (WHERE k < 3) AS base, string_agg(span, ',' ORDER BY b, k) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)"""
