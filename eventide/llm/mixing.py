"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are laid end to end in seeded order and cut into blocks
of equal length. Blocks are seats: they are given to sources by highest
quotients (target / 1, / 3, / 5, ...), then within a source to its shards in
the same way, which gives every shard an integer quota. A shard with quota q
and n blocks takes each block q div n times, and a seeded choice of q mod n
blocks once more. The choice is systematic (every n/r-th block from a seeded
start), so the words that a document gives follow from its place on the line
without listing any block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import WORD, order_rank, stored, table
from eventide.operators.scan import join_on

WEIGHTS = (3, 1, 2)          # fixed weights of the registered query, repeating
SHARE, MOST_REPEATS = 1.5, 2  # fixed: 150 % of all words, at most twice a source
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18


def apportion(parties: DataFrame, groups: Sequence[str], weight: Column, seats: Column, cap: Column,
              order: Sequence, name: str) -> DataFrame:
    """Sainte-Laguë seats (column ``name``) for each row of ``parties``.

    Per group of ``groups``, its ``seats`` go to the largest quotients
    weight / (2k - 1), ties by ``order``; no party gets more than ``cap``.
    A start of round(weight * (seats - n/2) / total) seats is never more than
    a party ends with, and at most n seats remain, of which a party can
    win weight * n / total + 2, so only that many quotients are compared.
    A seat that only full parties could take stays empty.
    """
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    p = parties.withColumns({"_ap_w": weight.cast("double"), "_ap_q": seats.cast("long"), "_ap_c": cap.cast("long")})
    p = p.withColumns({"_ap_total": F.sum("_ap_w").over(w), "_ap_n": F.count(F.lit(1)).over(w)})
    sure = F.floor(F.col("_ap_w") * F.greatest(F.lit(0.0), F.col("_ap_q") - F.col("_ap_n") / 2) / F.col("_ap_total") + 0.5)
    p = p.withColumn("_ap_sure", F.when(F.col("_ap_w") > 0, F.least("_ap_c", sure)).otherwise(F.lit(0)).cast("long"))
    p = p.withColumn("_ap_open", F.col("_ap_q") - F.sum("_ap_sure").over(w))
    more = F.when(F.col("_ap_w") > 0, F.least(F.col("_ap_c") - F.col("_ap_sure"), F.col("_ap_open"),
                                           F.ceil(F.col("_ap_w") * F.col("_ap_n") / F.col("_ap_total")) + 2)).otherwise(F.lit(0))
    # one row for the sure seats of each party (k = 0), one per quotient that may still win
    q = p.withColumn("_ap_k", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), more).cast("long"))))
    quotient = F.when(F.col("_ap_k") > 0, F.col("_ap_w") / (2 * (F.col("_ap_sure") + F.col("_ap_k")) - 1))
    place = F.row_number().over((w if groups else Window.partitionBy(F.lit(0)))
                                .orderBy(F.col("_ap_quotient").desc_nulls_last(), *order, "_ap_k"))
    won = F.when(F.col("_ap_k") == 0, F.col("_ap_sure")).otherwise((F.col("_ap_place") <= F.col("_ap_open")).cast("long"))
    return (q.withColumn("_ap_quotient", quotient).withColumn("_ap_place", place).withColumn("_ap_won", won)
           .groupBy(*parties.columns).agg(F.sum("_ap_won").cast("long").alias(name)))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST_REPEATS) -> DataFrame:
    """One row per source of ``sizes(source, size)``: its size, number of
    documents and target. Sources in code point order (null last) get the
    weights in turn and share ``share`` times all sizes; a target above
    ``most`` times its source's size stops there and the excess is shared anew,
    until none is above. The driver reads two sums per round."""
    src = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                      F.count(F.lit(1)).alias("n_docs"))
    src = order_rank(src, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          (F.col("_rank") % len(weights) + 1).cast("int"))
    src = stored(src.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most))))
    total = src.agg(F.sum("source_size")).first()[0] or 0
    rate, full = None, F.lit(False)
    while True:
        left = src.agg(F.sum(F.when(~full, F.col("weight"))).alias("w"), F.sum(F.when(full, F.col("_cap"))).alias("c"),
                       F.count(F.when(full, 1)).alias("n")).first()
        new = max(0.0, total * share - (left["c"] or 0.0)) / left["w"] if left["w"] else 0.0
        if rate is not None and new == rate:
            break
        rate, full = new, full | (F.col("weight") * F.lit(new) > F.col("_cap"))
    return src.withColumn("target", F.when(full, F.col("_cap")).otherwise(F.col("weight") * F.lit(rate))).drop("_cap", "_rank")


def _extra(x: Column, block: int) -> Column:
    """Words of the first ``x`` words of a shard's line that lie in a block of
    the seeded choice of r out of n blocks with start p."""
    b = F.lit(block)
    k = F.floor(x / b).cast("long")
    upto = lambda j: F.floor((j * F.col("_r") + F.col("_p")) / F.col("_n")).cast("long")
    return b * upto(k) + F.when(upto(k + 1) > upto(k), x - k * b).otherwise(F.lit(0))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS, seed: int = 7,
         block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, row: Column | None = None) -> DataFrame:
    """What the mix takes of every document: ``(id, source, size,
    source_size, target, taken)`` and, for :func:`mixed`, the place of the
    document on its shard's line, the shard's choice and the value of ``row``.

    Null texts have size 0 and are taken 0 times; a null source is a source of
    its own, the last. Equal rows are documents of their own. No other column is read. Shards hold about
    ``shard_words`` words, so a hot source is spread over many; the choice
    depends on ids, texts' sizes and ``seed`` only, so reruns agree.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size.alias("size"),
                        (F.lit(0) if row is None else row).alias("_row"))
    sized = stored(sized)
    src = targets(sized.select("source", "size"), weights, share, most)
    src = src.withColumn("_shards", F.ceil((F.col("source_size") + F.col("n_docs")) / F.lit(shard_words)).cast("long"))
    src = stored(src)
    docs_in = join_on(sized, src, ["source"]).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), "_id"), F.col("_shards")))
    shards = (docs_in.groupBy("source", "shard")
              .agg(F.sum("size").alias("_words"), F.first("target").alias("target"))
              .withColumn("_n", F.ceil(F.col("_words") / block_words).cast("long")))
    shards = stored(shards)
    totals = shards.agg(F.sum("_words")).first()[0] or 0
    seats = round(totals * share / block_words)
    by_source = shards.groupBy("source", "target").agg((F.sum("_n") * most).alias("_cap"))
    by_source = apportion(by_source, [], F.col("target"), F.lit(seats), F.col("_cap"),
                          [F.col("source").asc_nulls_last()], "_seats")
    quota = apportion(join_on(shards.drop("target"), by_source.select("source", "_seats"), ["source"]), ["source"],
                      F.col("_words"), F.col("_seats"), F.col("_n") * most, ["shard"], "_quota")
    quota = quota.select("source", "shard", F.greatest("_n", F.lit(1)).alias("_n"),
                         F.floor(F.col("_quota") / F.greatest("_n", F.lit(1))).alias("_times"),
                         (F.col("_quota") % F.greatest("_n", F.lit(1))).alias("_r"),
                         F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest("_n", F.lit(1))).alias("_p"))
    line = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "_id"), "_id", "size")
    placed = docs_in.withColumn("_to", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("_from", F.col("_to") - F.col("size"))
    out = join_on(placed, quota, ["source", "shard"])
    taken = (F.col("_times") * F.col("size") + _extra(F.col("_to"), block_words) - _extra(F.col("_from"), block_words))
    return out.select(F.col("_id").alias(id_col), "source", "size",
                      "source_size", "target", taken.cast("long").alias("taken"), "_row", "_from", "_times", "_r", "_p", "_n")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          block_words: int = BLOCK_WORDS, **how) -> DataFrame:
    """The mix itself, in the columns of ``docs``: of every document one whole copy per
    full round, and one row with the words of its chosen blocks, joined by single
    spaces. Documents of which nothing is taken go. Other columns, whatever their
    names, come out as they are."""
    names = docs.columns
    planned = plan(docs, id_col, text_col, source_col, block_words=block_words, row=F.monotonically_increasing_id(), **how)
    # columns go by place in a struct, so none can clash with those of the plan
    rows = docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row"))
    planned = planned.filter("taken > 0").select("_row", F.col("size").alias("_size"), "_from", "_times", "_r", "_p", "_n")
    b = F.lit(block_words).cast("long")
    chosen = F.filter(F.sequence(F.floor(F.col("_from") / b), F.floor((F.col("_from") + F.col("_size") - 1) / b)),
                      lambda j: F.floor(((j + 1) * F.col("_r") + F.col("_p")) / F.col("_n")) >
                      F.floor((j * F.col("_r") + F.col("_p")) / F.col("_n")))
    first = lambda j: F.greatest(F.lit(0), j * b - F.col("_from"))
    upto = lambda j: F.least(F.col("_size"), (j + 1) * b - F.col("_from"))
    text = F.col("_doc").getField(text_col).cast("string")
    # the words are bound to a variable, so that they are cut once per text and not per block
    part = F.transform(F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))), lambda words: F.array_join(
        F.transform(chosen, lambda j: F.array_join(F.slice(words, (first(j) + 1).cast("int"), (upto(j) - first(j)).cast("int")), " ")), " "))
    copies = F.concat(F.array_repeat(text, F.col("_times").cast("int")), F.filter(part, lambda t: F.length(t) > 0))
    mixed_rows = rows.join(planned, "_row").withColumn("_copies", copies).withColumn("_copy", F.explode("_copies"))
    return mixed_rows.select(*[F.col("_copy").alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in names])


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "source", "size", "source_size", "target", "taken")
