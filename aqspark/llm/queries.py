"""The operators as queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from aqspark.llm import contamination, elias_fano, exact, filter_audit, licenses, packing, quality, resampling, secrets, sharding, simhash, toxicity, urls
from aqspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver has it; a cluster gets it with ``--py-files``."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_simhash")
def _(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@query(
    "op2_decontamination",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    pos AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    occ AS (SELECT doc_id, i, pos.n AS n, item_id FROM pos JOIN win ON pos.win = win.win AND pos.n = win.n),
    hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY 1),
    ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM occ GROUP BY 1)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id""",
)
def _(spark, d):
    found = contamination.find_passages(table(spark, d, "documents"), table(spark, d, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), contamination.contaminated().alias("contaminated"))


@query("op3_sharding")
def _(spark, d):
    _, shards = sharding.write_shards(table(spark, d, "documents"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return shards.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_toxicity")
def _(spark, d):
    return toxicity.score(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op5_quality")
def _(spark, d):
    """Ratings of documents whose remainder is 0 are held out."""
    docs, rated = table(spark, d, "documents"), quality.grades(table(spark, d, "labels"))
    theta = quality.train(docs, rated.where(toxicity.remainder(F.col("doc_id")) != 0))
    found = quality.predict(docs, theta)
    return found.select("doc_id", (toxicity.remainder(F.col("doc_id")) == 0).alias("held_out"), "expected_grade", "tail", (F.col("tail") >= 0.5).alias("kept"))


@query("op6_token_ids")
def _(spark, d):
    path = elias_fano.write_ids(table(spark, d, "documents"), TOKENIZER, end_id=2)
    return elias_fano.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_secrets")
def _(spark, d):
    found = secrets.scan(table(spark, d, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE))
    spelled = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    live = F.size(F.filter("spans", lambda x: x["live"])).cast("long")
    counted = lambda what: F.array_join(F.transform("spans", lambda x: x[what].cast("string")), ",").alias(what)  # noqa: E731  (of each span)
    return found.select("doc_id", *map(count, secrets.BASE), F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"), live.alias("n_live"), counted("owners"), counted("repositories"))


@query("op8_packing")
def _(spark, d):
    found = packing.pack(table(spark, d, "documents"), TOKENIZER, end_id=1)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query(
    "op9_exact_dedup",
    r"""WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS w FROM documents),
    g AS (SELECT doc_id, w, first_value(doc_id) OVER (PARTITION BY w ORDER BY length(t) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY w) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(w) AS text_sha256 FROM g""",
)
def _(spark, d):
    found = exact.decide(table(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


# ---- URL lists: captures and dated entries derived from the pages ---------------------------------


def captures(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a fetch time in 2024."""
    minutes = F.col("page_id") % 366 * 1440 + F.col("page_id") % 1440
    return table(spark, d, "pages").select("page_id", "url", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("t0"), minutes.cast("int").alias("m")).select(
        "page_id", "url", F.expr("t0 + make_dt_interval(0, 0, m)").alias("fetched_at")
    )


def entries(spark: SparkSession, d: str) -> DataFrame:
    """Dated list entries for the hosts of the pages: listed, taken off, and for some listed again."""
    seen = table(spark, d, "pages").select(urls.host(F.col("url")).alias("host"), "page_id").where("host != ''").groupBy("host").agg(F.min("page_id").alias("k"))
    kind = F.expr("CASE WHEN k % 5 = 0 THEN 'prefix' WHEN k % 5 < 3 THEN 'domain' ELSE 'host' END")
    pattern = F.expr("CASE WHEN k % 5 = 0 THEN concat(host, '/en') ELSE host END")
    listed = seen.select(F.when(F.col("k") % 2 == 0, "ads").otherwise("spam").alias("list"), kind.alias("kind"), pattern.alias("pattern"), "k", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("t0"))
    steps = [("add", "k % 200", "true"), ("remove", "k % 200 + k % 90 + 1", "k % 7 > 0"), ("add", "k % 200 + 150", "k % 3 = 0")]
    parts = [listed.where(cond).select("list", "kind", "pattern", F.lit(action).alias("action"), F.expr(f"t0 + make_dt_interval(CAST({day} AS INT))").alias("dated")) for action, day, cond in steps]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "op10_url_filter",
    r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*([^?#]*)', 1) AS path,
      TIMESTAMP '2024-01-01' + to_minutes((page_id % 366 * 1440 + page_id % 1440)::INT) AS fetched_at FROM pages),
    h AS (SELECT host, min(page_id) AS k FROM p WHERE host <> '' GROUP BY 1),
    l AS (SELECT CASE WHEN k % 2 = 0 THEN 'ads' ELSE 'spam' END AS list, CASE WHEN k % 5 = 0 THEN 'prefix' WHEN k % 5 < 3 THEN 'domain' ELSE 'host' END AS kind,
      CASE WHEN k % 5 = 0 THEN host || '/en' ELSE host END AS pattern, k FROM h),
    e AS (SELECT list, kind, pattern, 1 AS added, k % 200 AS day FROM l UNION ALL SELECT list, kind, pattern, 0, k % 200 + k % 90 + 1 FROM l WHERE k % 7 > 0
      UNION ALL SELECT list, kind, pattern, 1, k % 200 + 150 FROM l WHERE k % 3 = 0),
    o AS (SELECT list, kind, pattern, TIMESTAMP '2024-01-01' + to_days(day::INT) AS dated, min(added) AS added FROM e GROUP BY ALL),
    v AS (SELECT *, lead(dated) OVER (PARTITION BY list, kind, pattern ORDER BY dated) AS valid_to FROM o),
    m AS (SELECT page_id, count(*) AS n_matches, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM p JOIN v ON added = 1 AND dated <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to)
      AND ((kind = 'host' AND host = pattern) OR (kind = 'domain' AND (host = pattern OR ends_with(host, '.' || pattern)))
        OR (kind = 'prefix' AND (host || path = pattern OR starts_with(host || path, pattern || '/')))) GROUP BY 1)
    SELECT p.page_id, host, fetched_at, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(lists, '') AS lists, n_matches IS NOT NULL AS blocked FROM p LEFT JOIN m ON m.page_id = p.page_id""",
)
def _(spark, d):
    found = urls.judge(captures(spark, d), entries(spark, d), "page_id")
    lists = F.array_join(F.array_distinct(F.transform("matches", lambda x: x["list"])), ",")
    return found.select(
        F.col("id").alias("page_id"), "host", "fetched_at", F.coalesce(F.size("matches"), F.lit(0)).cast("long").alias("n_matches"), F.coalesce(lists, F.lit("")).alias("lists"), "blocked"
    )


# ---- licences, resampling, filter audit ------------------------------------------------------------


@query("op11_licenses")
def _(spark, d):
    found = licenses.scan(table(spark, d, "documents"))
    base = F.filter("detections", lambda x: x["kind"] == "base")
    spelled = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["first"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        spelled(base).alias("base_labels"), spelled(F.col("detections")).alias("labels"), "score",
    )


def _crc_table() -> list[int]:
    """What a byte makes of an empty CRC-32 register, by the rule of the reflected polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


_CRC = f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::UBIGINT)),
    lambda a, b: xor(a >> 8, {_crc_table()}[((xor(a, b) & 255) + 1)::BIGINT]::UBIGINT)), 4294967295::UBIGINT)"""


@query(
    "op12_resampling",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), each AS (SELECT doc_id, unnest(ws) AS w FROM d), aim AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
    v AS (SELECT w, {_CRC} % 10000 AS k FROM (SELECT w FROM each UNION SELECT w FROM aim)),
    s AS (SELECT k, count(*) AS s FROM each JOIN v ON each.w = v.w GROUP BY 1), t AS (SELECT k, count(*) AS t FROM aim JOIN v ON aim.w = v.w GROUP BY 1),
    g AS (SELECT s.k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
      FROM s LEFT JOIN t ON s.k = t.k),
    x AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM each JOIN v ON each.w = v.w JOIN g ON g.k = v.k GROUP BY 1),
    y AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN x ON x.doc_id = d.doc_id),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM y WHERE n_features >= 20)
    SELECT y.doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END::BIGINT AS rank FROM y LEFT JOIN r ON r.doc_id = y.doc_id""",
)
def _(spark, d):
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op13_filter_audit",
    r"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
    f AS (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (w.doc_id > first)::INT AS m
      FROM w LEFT JOIN labels ON labels.doc_id = w.doc_id),
    c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS x FROM f GROUP BY 1, 2),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
    o AS (SELECT p.l || q.l || r.l || s.l || u.l AS filter_order, [p.b, q.b, r.b, s.b, u.b] AS bits FROM l p, l q, l r, l s, l u WHERE p.b + q.b + r.b + s.b + u.b = 31 AND (p.b | q.b | r.b | s.b | u.b) = 31),
    k AS (SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS s FROM o, range(1, 6) AS z(step)),
    e AS (SELECT part, filter_order, step, any_value(b) AS b, coalesce(sum(n) FILTER ((m & (s | b)) = 0), 0) AS kept, coalesce(sum(n) FILTER ((m & s) = 0 AND (m & b) > 0), 0) AS removed,
      coalesce(sum(n) FILTER ((m & s) > 0 AND (m & b) > 0), 0) AS redundant, coalesce(sum(n) FILTER (m = b), 0) AS unique_fails,
      coalesce(sum(g) FILTER ((m & s) = 0 AND (m & b) > 0), 0) AS good_lost, coalesce(sum(x) FILTER ((m & s) = 0 AND (m & b) > 0), 0) AS toxic_lost FROM c, k GROUP BY 1, 2, 3)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
      good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM e""",
)
def _(spark, d):
    cells = filter_audit.failures(table(spark, d, "documents"), table(spark, d, "labels"))
    return filter_audit.audit(cells, "ABCDE")
