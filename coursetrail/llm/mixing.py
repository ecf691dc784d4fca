"""Mixing sources by temperature, with DataFrame and SQL functions alone.

Weights. A source with share p of all tokens gets a weight in proportion to p^a. The exponent a, between 0 (all sources
alike) and 1 (as they are), is found by bisection: the largest one whose weights have `entropy` times the
entropy of equal weights, raised to the smallest one that repeats no source more than `repeat` times where the
former would. A repeat limit that no exponent meets leaves 1. The exponent is rounded to six digits.

Budget. Source i gets round(w_i x budget) tokens; the budget is all tokens of the table, or a given number, or
with budget="whole" the smallest that holds every source once in full.

Order. A source's documents are dealt into `blocks` blocks by a hash. Epoch after epoch its
blocks are taken in a new pseudo-random order until the source's budget is met; the document that reaches it is the
last one. A document's place among the tokens of its source tells its block of the mixture, so
that every mixture block holds the sources in proportion to their weights.

Scale. Sums over a source come in two steps, within blocks and over blocks, so that a source with a third of all rows is
dealt over as many tasks as blocks. The number of sources may grow too: the bisection probes many exponents
in one aggregate over the table of sources and brings back a few sums for each.

Defined results: a document's tokens are its words and one for its end, so empty and null texts have one. A null
source is a source like others, as is the empty name. Rows repeated with one id are documents of their own, as
are rows with a null id. An empty table gives an empty result. One source gets weight 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.session import stored

BLOCKS = 4096
PROBES, ROUNDS = 31, 6


def tokens(text: Column) -> Column:
    """Words of a text, and one for its end."""
    words = F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+")
    return (F.size(F.filter(words, lambda w: w != "")) + 1).cast("bigint")


def _number(*parts: Column) -> Column:
    """A pseudo-random number below 2^60 from some values."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def _probed(sources: DataFrame, exponents: list[float], total: int) -> DataFrame:
    """One row of sums for each exponent, by its number k.

    Exponents are data and not text of the plan, so the code that Spark makes is short and the same in every round.
    """
    raised = F.pow(F.col("n") / F.lit(float(total)), F.col("exponent")).alias("raised")
    rows = sources.select("n", F.posexplode(F.lit([float(a) for a in exponents])).alias("k", "exponent")).select("k", "n", raised)
    return rows.groupBy("k").agg(
        F.sum("raised").alias("s"), F.sum(F.col("raised") * F.log("raised")).alias("l"),
        F.max(F.col("raised") / F.col("n")).alias("most"), F.max(F.col("n") / F.col("raised")).alias("whole"))


def _probes(sources: DataFrame, exponents: list[float], budget: int | str, total: int) -> list[tuple[float, float]]:
    """(entropy, most repeats) for each exponent."""
    from math import log

    found = []
    for _, row in sorted((row["k"], row) for row in _probed(sources, exponents, total).collect()):
        tokens_ = row["s"] * row["whole"] if budget == "whole" else budget
        found.append((log(row["s"]) - row["l"] / row["s"], row["most"] / row["s"] * tokens_))
    return found


def exponent(sources: DataFrame, total: int, entropy: float, repeat: float, budget: int | str) -> float:
    """The exponent for sources (n), rounded to six digits; see the module's text."""
    (most, _), = _probes(sources, [0.0], budget, total)

    def bisect(meets, low_side: bool) -> float:
        """Where a condition that holds on one side only changes; an end of 0..1 where it never does."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            step = (high - low) / (PROBES + 1)
            at = [low + step * k for k in range(PROBES + 2)]
            first = next((k for k, x in enumerate(_probes(sources, at, budget, total)) if meets(*x) != low_side), None)
            if first is None:
                return high
            if first == 0:
                return low
            low, high = at[first - 1], at[first]
        return low if low_side else high

    tolerance = 1e-12
    by_entropy = bisect(lambda h, _: h >= entropy * most - tolerance, low_side=True)
    by_repeat = bisect(lambda _, r: r <= repeat + tolerance, low_side=False)
    return round(max(by_entropy, by_repeat), 6)


def mixture(docs: DataFrame, entropy: float = 0.97, repeat: float = 4.0, budget: int | str | None = None, mix_tokens: int = 1 << 20,
            blocks: int = BLOCKS, seed: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """The mixture of docs (doc_id, source, text): one row for each time that a document is in it.

    doc_id, source, n_tokens; epoch, from 0; block; start: tokens of its source before it; mix_block: its block of the mixture,
    of about mix_tokens tokens each. Columns to carry, all of another name, follow; the name `carried` is taken.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    carried = [F.struct(*carry).alias("carried")] if carry else []
    rows = docs.select("doc_id", "source", key.alias("key"), tokens(F.col("text")).alias("n_tokens"), *carried)
    number = _number(F.lit(str(seed)), F.col("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("number", number).withColumn("block", (F.col("number") % blocks).cast("int"))
    # One pass over the texts gives the blocks' sizes; all of the choice is made on these.
    # A file for each core is enough for them, however many parts a shuffle has.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    sizes = stored(rows.groupBy("key", "block").agg(F.sum("n_tokens").alias("n")).coalesce(cores), "mixing-blocks")
    sources = stored(sizes.groupBy("key").agg(F.sum("n").alias("n")), "mixing-sources")
    total = sources.agg(F.sum("n")).first()[0] or 0
    wanted = total if budget is None else budget
    a = exponent(sources, total, entropy, repeat, wanted) if total else 1.0
    raised = F.pow(F.col("n") / F.lit(float(max(total, 1))), F.lit(a))
    every = sources.agg(F.sum(raised).alias("s"), F.max(F.col("n") / raised).alias("whole")).first()
    all_tokens = (every["s"] or 0.0) * (every["whole"] or 0.0) if wanted == "whole" else float(wanted)
    shares = sources.select("key", F.col("n").alias("source_tokens"),
                            F.floor(raised / F.lit(every["s"] or 1.0) * F.lit(all_tokens) + 0.5).alias("share"))
    mix_blocks = max(1, -(-int(all_tokens) // mix_tokens))

    before = W.partitionBy("key", "epoch").orderBy("turn", "block").rowsBetween(W.unboundedPreceding, -1)
    epochs = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("share") / F.col("source_tokens")).cast("int") - 1, F.lit(0))))
    ordered = (sizes.join(shares, "key").withColumn("epoch", epochs)
               .withColumn("turn", _number(F.lit(str(seed)), F.col("epoch").cast("string"), F.col("key"), F.col("block").cast("string")))
               .withColumn("block_start", F.col("epoch") * F.col("source_tokens") + F.coalesce(F.sum("n").over(before), F.lit(0)))
               .where("block_start < share").select("key", "block", "epoch", "block_start", "share"))
    inside = W.partitionBy("key", "block").orderBy("number", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, -1)
    placed = (rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(ordered, ["key", "block"]).withColumn("start", F.col("block_start") + F.col("inner")).where("start < share"))
    mix_block = F.floor(F.col("start").cast("decimal(20,0)") * F.lit(mix_blocks).cast("decimal(18,0)") / F.col("share")).cast("bigint")
    return placed.select("doc_id", "source", "n_tokens", "epoch", "block", "start", mix_block.alias("mix_block"),
                         *(["carried"] if carry else []))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """docs as the mixture holds them: a document's row as often as it is in it, with the columns of docs."""
    carry = tuple(docs.columns)
    return mixture(docs, carry=carry, **settings).select("carried.*")
