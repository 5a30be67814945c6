"""Filter interaction audit: what each filter removes in every order, and its Shapley weight, from counts on the subset lattice.

A state is the set of filters applied so far. Documents are counted once by the set of filters they fail; an edge of the lattice adds one filter to a
state and removes the documents that fail it and none of the state. Forward counting gives the orders that reach a state, backward counting those that
leave it; an edge is passed by their product, which weights its removals for Shapley. The steps of each order read the same edges.

With ``k`` filters there are at most ``2**k`` counts, ``k * 2**(k-1)`` edges and ``k * k!`` steps for each part; ``k`` is 8 at most. No text is compared or
shuffled: equal texts meet by their SHA-256, and counts combine in the tasks before each shuffle, so that one text, one id or one part may hold any share.

A null text is empty; a null part is the empty string. A null id is later than every other id: its row repeats a text that any other id has. Rows with the
same id and text don't repeat each other. An id is good (or toxic) if any of its labels is 1; null labels count as 0. Long texts are read whole. An empty table gives no
rows. Columns other than those named are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from aqspark.llm.common import BROADCAST_ROWS, stage

MAX_FILTERS = 8
#: Copies of a label row when labels are too many to be sent to all tasks: the rows of a hot id go to so many tasks.
SALTS = 32
_SPACE = r"[\x20\x09-\x0D]+"


def text_filters() -> dict[str, Column]:
    """Failure conditions of the column ``text``; ``E`` is decided by comparing texts (see ``failures``)."""
    words = F.filter(F.split("text", _SPACE, -1), lambda x: x != "")
    few = F.col("_words") < 200
    dull = 100 * F.col("_distinct") < 50 * F.col("_words")
    capitals = 100 * F.char_length(F.regexp_replace("text", "[^A-Z]+", "")) > 3 * F.char_length("text")
    return {"_words": F.size(words), "_distinct": F.size(F.array_distinct(words)), "A": few, "B": dull, "C": capitals, "D": F.col("text").rlike("[#$%&*|]")}


def _mask(conditions: list[Column]) -> Column:
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return reduce(lambda a, b: a + b, bits).cast("int")


def failures(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part``, ``mask`` (bits of A to E), ``n``, ``good`` and ``toxic``: counted documents by the filters they fail."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    )
    made = text_filters()
    counted = rows.withColumns({k: made[k] for k in ("_words", "_distinct")})
    four = _mask([made[k] for k in "ABCD"])
    narrow = counted.select("doc_id", "part", four.alias("mask"), F.unhex(F.sha2(F.col("text"), 256)).alias("digest"))
    # repeated rows become one; whatever the key, its rows combine in the tasks
    seen = stage(narrow.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "seen")
    marked = _labelled(seen, labels, doc_id)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    group = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), first.alias("first"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("least"))
    # a text has a row for each part and label only; the rows of its smallest id are its first ones
    whole = group.withColumn("all", F.min("first").over(W.partitionBy("digest")))
    firsts = F.when(F.col("first") == F.col("all"), F.col("least.n")).otherwise(F.lit(0))
    split = whole.select("part", "mask", "good", "toxic", F.explode(F.array(F.struct(F.lit(0).alias("e"), firsts.cast("long").alias("n")), F.struct(F.lit(16).alias("e"), (F.col("n") - firsts).cast("long").alias("n")))).alias("x"))
    counts = [F.sum("x.n").alias("n"), *(F.sum(F.when(F.col(c), F.col("x.n")).otherwise(F.lit(0))).alias(c) for c in ("good", "toxic"))]
    return split.where("x.n > 0").groupBy("part", (F.col("mask") + F.col("x.e")).alias("mask")).agg(*counts)


def _labelled(seen: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    """``seen`` with ``good`` and ``toxic``. Labels are broadcast if they are counted few; else each row of an id goes to one of its salted copies."""
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    rated = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("rated")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic")).where("good OR toxic")
    rated = stage(rated, "rated")
    if rated.count() <= BROADCAST_ROWS:
        joined = seen.join(F.broadcast(rated), F.col("doc_id") == F.col("rated"), "left")
    else:
        salted = rated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = seen.withColumn("own", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
        joined = own.join(salted, (F.col("doc_id") == F.col("rated")) & (F.col("own") == F.col("salt")), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return joined.select("digest", "doc_id", "part", "mask", "n", flag("good"), flag("toxic"))


# ---- the lattice ----------------------------------------------------------------------------------


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state from the empty one, and orders from it to the full one."""
    full = (1 << k) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ 1 << i] for i in range(k) if state >> i & 1)
    for state in reversed(range(full)):
        leave[state] = sum(leave[state | 1 << i] for i in range(k) if not state >> i & 1)
    return reach, leave


def edges(k: int) -> list[tuple[int, int, int]]:
    """(state, bit added, orders that pass)."""
    reach, leave = path_counts(k)
    return [(s, 1 << i, reach[s] * leave[s | 1 << i]) for s in range(1 << k) for i in range(k) if not s >> i & 1]


def steps(names: str | list[str]) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before, bit added) of all orders."""
    bit = {name: 1 << i for i, name in enumerate(names)}
    return [("".join(order), i + 1, sum(bit[x] for x in order[:i]), bit[x]) for order in permutations(names) for i, x in enumerate(order)]


def _constant(spark, rows: list[tuple], names: str) -> DataFrame:
    """A table as large as the lattice, whatever the data; kept in the plan itself."""
    spelled = ", ".join(map(str, rows))
    return spark.sql(f"SELECT * FROM VALUES {spelled} AS t({names})")


def audit(cells: DataFrame, names: str | list[str]) -> DataFrame:
    """A row per part, order and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    ``cells``: part, mask (bits in the order of ``names``), n, good, toxic; more than one row of a part and mask add up.
    """
    k, spark = len(names), cells.sparkSession
    if not (1 <= k <= MAX_FILTERS and all(x.isalnum() for x in names)):
        raise ValueError(f"1 to {MAX_FILTERS} filters, named by letters and digits")
    summed = cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    per_part = summed.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 2**k at most

    def total(what: str, hit) -> Column:
        return F.aggregate(F.filter("cells", hit), F.lit(0).cast("long"), lambda a, x: a + x[what])

    each = F.explode(F.expr("array(" + ", ".join(f"named_struct('state', {s}, 'bit', {b}, 'ways', {w}L)" for s, b, w in edges(k)) + ")"))
    state, bit = F.col("state"), F.col("bit")
    fails = lambda x: x["mask"].bitwiseAND(bit) != 0
    passed = lambda x: x["mask"].bitwiseAND(state) == 0
    flows = per_part.select("part", "cells", each.alias("edge")).select("part", "cells", "edge.*").select(
        "part", "state", "bit", "ways",
        total("n", lambda x: x["mask"].bitwiseAND(state.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", lambda x: passed(x) & fails(x)).alias("removed"),
        total("n", lambda x: ~passed(x) & fails(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == bit).alias("unique_fails"),
        total("good", lambda x: passed(x) & fails(x)).alias("good_lost"),
        total("toxic", lambda x: passed(x) & fails(x)).alias("toxic_lost"),
    )
    weighted = flows.withColumn("shapley", F.sum(F.col("removed") * F.col("ways")).over(W.partitionBy("part", "bit")))
    orders = _constant(spark, steps(names), "filter_order, step, state, bit")
    found = weighted.join(F.broadcast(orders), ["state", "bit"])
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
