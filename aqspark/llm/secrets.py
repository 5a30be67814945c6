"""Secret scan with the corpus-wide frequency of owners.

Each text is scanned once for candidates. The hash of a candidate's value is counted over distinct owners and repositories of the whole
corpus: a value that many owners have is a copied example, a value of few owners that looks random is a live credential. The base kinds (``assign``,
``access``, ``hex``) are always reported, with that verdict. The kinds that only the method can tell from noise (``bearer`` tokens, ``userinfo`` of
addresses, ``prefixed`` keys) are reported if the verdict is live.

Spans are code point offsets, end exclusive, leftmost and without overlap per kind. A null or empty text has none. A null owner or repository counts as one more
owner. Repeated rows keep their own spans; the same repository counts once. Ties sort by kind. Long texts are scanned whole. An empty table gives an empty result. Only
the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aqspark.llm.common import stage

#: kind: pattern, group of the value, least length of the value
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "bearer": (r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]{16,}=*)", 1, 16),
    # from the begin of a run of scheme characters, so that each run is tried once; what precedes its first letter is cut off the span
    "userinfo": (r"(?<![A-Za-z0-9+.-])[0-9+.-]*+[A-Za-z][A-Za-z0-9+.-]*+://[^\s/:@]*+:([^\s/:@]{6,}+)@", 1, 6),
    "prefixed": (r"(?<![A-Za-z0-9])(?:gh[pousr]|sk|pk|rk|xox[abprs]|glpat)[-_]([A-Za-z0-9_-]{16,})", 1, 16),
}
BASE = ("assign", "access", "hex")
#: A value that so many owners have is an example.
COPIED_OWNERS = 3
#: A live value has so many bits of entropy a character at least; six even characters have 2.58.
LIVE_BITS = {"bearer": 3.0, "prefixed": 3.0}
LEAST_BITS = 2.5


def _found(kind: str, order: int) -> Column:
    """Spans of a kind in the column ``text``: structs of start, kind order, end and the hash of the value."""
    pattern, group, least = KINDS[kind]
    regex = F.lit(pattern)
    whole, value = F.regexp_extract_all("text", regex, F.lit(0)), F.regexp_extract_all("text", regex, F.lit(group))
    parts = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    # gaps and matches alternate; the last gap has no match after it
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, kind: int, end: int, value: string>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.coalesce(F.char_length(x["whole"]), F.lit(0))
        start = begin + F.char_length(F.regexp_extract(x["whole"], "^[0-9+.-]*", 0)) if kind == "userinfo" else begin
        one = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.char_length(x["value"]) >= least, F.concat(acc["spans"], F.array(one))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(parts, begin, step, lambda acc: acc["spans"])
    return F.when(F.col("text").rlike(pattern), spans)


def _entropy(value: Column) -> Column:
    """Bits a character, by the shares of the value's different characters."""
    n = F.char_length(value)
    share = lambda c: (n - F.char_length(F.replace(value, c, F.lit("")))) / n
    kinds = F.array_distinct(F.split(value, ""))
    return F.aggregate(F.filter(kinds, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))


def candidates(docs: DataFrame, doc_id: str, text: str, owner: str, repository: str) -> DataFrame:
    """Written table of ``at`` (the row), ``doc_id``, ``owner``, ``repository`` and ``spans`` with the values' hashes."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<start: int, kind: int, end: int, value: string>>")
    found = F.array_sort(F.concat(*[F.coalesce(_found(k, i), none) for i, k in enumerate(KINDS)]))
    bits = F.array(*[F.lit(LIVE_BITS.get(k, LEAST_BITS)) for k in KINDS])
    hashed = F.transform("found", lambda x: F.struct(x["start"], x["kind"], x["end"], F.sha2(x["value"], 256).alias("hash"), (_entropy(x["value"]) >= F.element_at(bits, x["kind"] + 1)).alias("random")))
    return stage(rows.select(F.monotonically_increasing_id().alias("at"), "doc_id", "owner", "repository", found.alias("found")).withColumn("spans", hashed).drop("found"), "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """``hash``, ``owners`` and ``repositories``: distinct ones that have the value. Each step combines in the tasks before it shuffles."""
    one = found.select(F.explode("spans.hash").alias("hash"), "owner", "repository").groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = one.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """``doc_id`` and ``spans``: structs of ``start``, ``kind``, ``end``, ``hash``, ``owners``, ``repositories``, ``live``, sorted."""
    found = candidates(docs, doc_id, text, owner, repository)
    each = found.where(F.size("spans") > 0).select("at", F.explode("spans").alias("x")).select("at", "x.*")
    judged = each.join(ownership(found), "hash").withColumn("live", (F.col("owners") < copied_owners) & F.col("random"))
    shown = judged.where((F.col("kind") < len(BASE)) | F.col("live"))
    per_row = shown.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "hash", "owners", "repositories", "live"))).alias("spans"))
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform("spans", lambda x: x.withField("kind", F.element_at(names, x["kind"] + 1)))
    rows = found.select("at", "doc_id").join(per_row, "at", "left")
    return rows.select("doc_id", F.coalesce(named, F.array().cast("array<struct<start: int, kind: string, end: int, hash: string, owners: long, repositories: long, live: boolean>>")).alias("spans"))
