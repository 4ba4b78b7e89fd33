"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all want the same number of copies, its target over its size. The whole part is taken; the
fractions are rounded dependently: two fractional documents trade words until one of them is integral, with odds that
keep each one's expected copies, so the source's total never moves. Shards round their own documents, the one that stays
fractional in each goes on to the next level of a reduction tree, and the last one of a source is rounded. What that
leaves is settled by turning documents of about that size, as long as a source misses its target by over 0.2 %. Coins are hashes of ids and a seed, so reruns agree.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, last in order; sources
without words have target 0; rows that repeat a doc_id or a text are rounded each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import numbered
from .common import cut

MOST_COPIES = 3
#: Documents of a source that are rounded together.
SHARD = 1024
FAN_IN = 64
#: Rounds of settling at most, and the share of its target that a source may miss unsettled.
SETTLE, NEAR = 10, 0.002
_SCHEMA = "source string, row_id long, size long, base long, fraction double, shard long, copies long, done boolean"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): weighted shares of all words, none above ``most`` times its source.

    Sources are numbered over range partitions. The level (words a unit of weight) rises as sources reach their caps and
    the excess is reshared; a step is one aggregate over the sources, and the last one caps no further source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = numbered(by, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    by = by.select("source", "source_size", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    level, before = 0.0, -1
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        left = F.sum("source_size") - F.sum(F.when(full, F.col("cap")).otherwise(0.0))
        n, rest, free = by.agg(F.count_if(full), left, F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == before or not free:
            break
        level, before = rest / free, n
    return by.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _round(seed: int, last: bool):
    """Round the fractions of one shard; at most one stays, unless this is the ``last`` level."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "row_id"], ascending=[False, True], kind="stable")
        size, part = pdf["size"].to_numpy(float), pdf["fraction"].to_numpy(float).copy()
        coins = np.random.default_rng([seed, int(pdf["row_id"].iloc[0]) & 0x7FFFFFFFFFFFFFFF, len(pdf)]).random(len(pdf) + 1)
        part[(part < 1e-9) | (size == 0)] = 0.0
        part[part > 1 - 1e-9] = 1.0
        open_ = -1
        for i in np.flatnonzero((part > 0) & (part < 1)).tolist():
            if open_ < 0:
                open_ = i
                continue
            j, a, b = open_, size[open_], size[i]
            give, take = min(part[j] * a, (1 - part[i]) * b), min((1 - part[j]) * a, part[i] * b)
            move = -give if coins[i] < take / (give + take) else take
            part[j] += move / a
            part[i] -= move / b
            for k in (i, j):
                part[k] = 0.0 if part[k] < 1e-9 else 1.0 if part[k] > 1 - 1e-9 else part[k]
            here = [k for k in (j, i) if 0 < part[k] < 1]
            open_ = here[0] if here else -1
        if last and open_ >= 0:
            part[open_] = 1.0 if coins[-1] < part[open_] else 0.0
            open_ = -1
        done = (part == 0) | (part == 1)
        return pdf.assign(fraction=part, copies=pdf["base"] + np.where(done, part, 0).astype(np.int64), done=done)

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST_COPIES, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target (its source's), copies, taken (copies times size)."""
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.cast("long").alias("size"), F.col(text_col).isNull().alias("void"))
    # a row's own number, the same in every rerun: its id, and its place among rows of that id
    rows = cut(rows, "sizes")
    twice = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if twice or rows.filter("doc_id is null").limit(1).count():
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("source", "size", "void")))
        rows = rows.withColumn("row_id", F.when((F.col("nth") == 1) & F.col("doc_id").isNotNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "nth")))
    else:
        rows = rows.withColumn("row_id", F.col("doc_id"))
    targets = cut(source_targets(rows, weights, most), "targets")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    full = rows.alias("a").join(targets.alias("b"), same).select("a.doc_id", "a.row_id", "a.source", "a.size", "source_size", "target", wanted.alias("want"))
    full = cut(full.withColumn("base", F.floor(F.col("want") + 1e-9)).withColumn("fraction", F.greatest(F.col("want") - F.col("base"), F.lit(0.0))), "wanted")

    shards = full.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    width = max(1, -(-shards // SHARD))
    # documents of about the same size meet, a source's shards being dealt by a hash
    state = full.select("source", "row_id", "size", "base", "fraction", F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(width)).alias("shard"), F.lit(0).cast("long").alias("copies"), F.lit(False).alias("done"))
    parts, level = [], 0
    while True:
        out = cut(state.groupBy("source", "shard").applyInPandas(_round(seed + level, width == 1), _SCHEMA), "rounded")
        parts.append(out.filter("done").select("source", "row_id", "size", "base", "copies"))
        if width == 1:
            break
        width, level = -(-width // FAN_IN), level + 1
        state = out.filter("not done").withColumn("shard", F.pmod(F.col("shard"), F.lit(width)))
    rounded = parts[0]
    for p in parts[1:]:
        rounded = rounded.unionByName(p)
    settled = []
    for i in range(SETTLE):  # what the last rounding left: a round rewrites the sources that still miss, no others
        gap = cut(_gaps(rounded, targets), "gap")
        if gap.isEmpty():
            break
        settled.append(rounded.alias("a").join(gap.alias("b"), same, "left_anti"))
        rounded = _settle(rounded, gap, most, seed + 1000 + i)
    for p in settled:
        rounded = rounded.unionByName(p)
    out = full.select("doc_id", "row_id", "source", "size", "source_size", "target").join(rounded.select("row_id", "copies"), "row_id")
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_id")


def take(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, each row as many times as the mix takes it; all columns stay, whatever their names.

    Where ids repeat or are null, rows are told apart by a hash of all their columns, and equal rows by their place.
    """
    fresh = lambda name: name + "_" * (1 + max((len(c) for c in docs.columns if c.startswith(name)), default=0))
    key, copies = fresh("key"), fresh("copies")
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    if ids.filter("id is null").isEmpty() and ids.groupBy("id").count().filter("count > 1").isEmpty():
        keyed = docs.withColumn(key, F.col(id_col).cast("long"))
    else:
        keyed = docs.withColumn(key, F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)))))
        keyed = cut(keyed.withColumn(key, F.xxhash64(key, F.row_number().over(Window.partitionBy(key).orderBy(key)))), "keyed")
    taken = cut(mix(keyed, id_col=key, **options).filter("copies > 0").select(F.col("doc_id").alias(key), F.col("copies").cast("int").alias(copies)), "copies")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return keyed.join(taken, key).select(F.explode(F.array_repeat(row, F.col(copies))).alias("row")).select("row.*")


def _gaps(rounded: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, gap): what the sources that miss their target by over ``NEAR`` of it lack."""
    got = rounded.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    both = got.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", (F.col("target") - F.col("got")).alias("gap"), "target")
    return both.filter(F.abs("gap") > F.lit(NEAR) * F.col("target")).select("source", "gap")


def _settle(rounded: DataFrame, gap: DataFrame, most: int, seed: int) -> DataFrame:
    """The rows of the sources in ``gap``, with documents turned towards their targets.

    A wide gap is closed by many small documents, each turned by a coin of the right odds; a narrow one by the document
    whose size is nearest to it without passing it. Documents within their rounding go first, then any with copies to
    give or take, and where no single turn helps the smallest one, for the next rounds to fill up.
    """
    size, wide, more = F.col("size"), F.abs("gap"), F.col("gap") > 0
    rows = rounded.alias("a").join(gap.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "row_id", "size", "copies", "base", "gap")
    able = (size > 0) & F.when(more, F.col("copies") < most).otherwise(F.col("copies") > 0)
    usual = F.when(more, F.col("copies") == F.col("base")).otherwise(F.col("copies") > F.col("base"))
    kind = F.when(usual & (size < 2 * wide), 0).when(size < 2 * wide, 1).otherwise(2)
    over = F.when(kind == 2, size.cast("double")).otherwise(F.greatest(size - wide, F.lit(0.0)) * 4 - size)
    small = able & (size * 8 <= wide)
    pick = rows.groupBy("source").agg(F.first("gap").alias("gap"), F.min_by("row_id", F.when(able, F.struct(kind.alias("k"), over.alias("o"), F.col("row_id")))).alias("one"), F.sum(F.when(small, size).otherwise(0)).alias("sum"))
    pick = cut(pick.select("source", "gap", "one", "sum"), "turn")
    rows = rounded.alias("a").join(pick.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "row_id", "size", "copies", "base", "gap", "one", "sum")
    coin = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    turn = F.when(F.col("sum") >= wide, small & (coin < wide / F.col("sum"))).otherwise(F.col("row_id") == F.col("one"))
    by = F.when(F.coalesce(turn, F.lit(False)), F.when(more, 1).otherwise(-1)).otherwise(0)
    return cut(rows.select("source", "row_id", "size", "base", (F.col("copies") + by).cast("long").alias("copies")), "settled")
