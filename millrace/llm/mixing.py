"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, words
from millrace.session import checkpoint

CHUNK_BITS = 16


@dataclass(frozen=True)
class Mix:
    """Weights go to the sources in code-point order, null last, and repeat."""
    weights: tuple[int, ...] = (5, 2, 1)
    most_copies: int = 3
    seed: int = 20


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(counts: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target, rate) from (source, size, n).

    Targets share the total size by weight. What a source cannot take without
    passing ``most_copies`` times its size is shared among the others by weight,
    until none is above. Each round brings two sums to the driver. One task ranks
    the sources, of which there is one row each.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(int(w)) for w in mix.weights]), rank % len(mix.weights))
    sources = checkpoint(
        counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        .select("source", "source_size", weight.cast("long").alias("weight")))
    cap = F.col("source_size") * mix.most_copies
    total, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, weights, before = total or 0, all_weights or 1, None
    # weight * rest / weights > cap, in whole numbers
    above = lambda: F.col("weight").cast("decimal(38,0)") * F.lit(rest) > cap.cast("decimal(38,0)") * F.lit(weights)
    while (rest, weights) != before:
        before = rest, weights
        taken, used = sources.filter(above()).agg(F.sum(cap), F.sum("weight")).first()
        if used == all_weights:
            break
        rest, weights = (total or 0) - (taken or 0), (all_weights or 1) - (used or 0)
    target = F.when(above(), cap.cast("double")).otherwise(
        F.col("weight") * F.lit(float(rest)) / F.lit(float(weights)))
    rate = F.when(F.col("source_size") == 0, 0.0).when(above(), float(mix.most_copies)).otherwise(
        target / F.col("source_size"))
    return sources.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def with_copies(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text",
                source: str = "source", into: str = "mix") -> DataFrame:
    """Adds a struct (size, source_size, target, copies) to each row.

    Within a source rows stand in the order of size and id. Each row's expected
    copies are the source's target divided by its size; their prefix sum plus one
    offset per source, drawn from the seed, crosses an integer once for each copy.
    As equal sizes stand together, the words taken differ from the target by less
    than the longest text. Prefix sums go over sizes, chunks of ids within a size,
    and rows within a chunk, so no task holds a source. A null text has size 0, a
    null source is a source, repeated rows count one by one; ids are integers. A
    column named like ``into`` is replaced.
    """
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()])
    size, chunk, s = (free_name(plain, n) for n in ("size__", "chunk__", "source__"))
    rows = plain.withColumns({
        size: n_words(F.col(f"`{text}`")),
        chunk: F.shiftright(F.col(f"`{id_col}`").cast("long"), CHUNK_BITS),
        s: F.col(f"`{source}`")})
    counts = checkpoint(rows.groupBy(F.col(s).alias("source"), F.col(size).alias("size"), F.col(chunk).alias("chunk"))
                        .agg(F.count("*").alias("n")))
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    upto = lambda keys, order: F.sum("n").over(
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_size.select("source", "size", F.coalesce(upto(["source"], "size"), F.lit(0)).alias("before_size"))
    targets = source_targets(by_size, mix)
    same = lambda a, b, names: [a[n].eqNullSafe(b[n]) for n in names]
    sizes = firsts.join(targets, same(firsts, targets, ["source"])).select(firsts["*"], "source_size", "target", "rate")
    chunks = counts.select("source", "size", "chunk", F.coalesce(upto(["source", "size"], "chunk"), F.lit(0)).alias("before_chunk"))
    known = chunks.join(sizes, same(chunks, sizes, ["source", "size"])).select(
        chunks["*"], (F.col("before_size") + F.col("before_chunk")).alias("before"), "source_size", "target", "rate")
    facts = free_name(plain, "known__")
    known = known.select(F.struct("*").alias(facts))
    k = lambda name: F.col(f"{facts}.{name}")
    joined = rows.join(known, [F.col(s).eqNullSafe(k("source")), F.col(size).eqNullSafe(k("size")),
                               F.col(chunk).eqNullSafe(k("chunk"))])
    place = free_name(plain, "place__")
    ranked = joined.withColumn(place, k("before") + F.row_number().over(
        Window.partitionBy(s, size, chunk).orderBy(F.col(f"`{id_col}`"))))
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col(s))), 1, 3), 16, 10).cast("int") / 4096.0
    crossed = lambda place: F.floor(k("rate") * place + offset)
    return ranked.select(
        *[F.col(f"`{c}`") for c in plain.columns],
        F.struct(F.col(size).alias("size"), k("source_size").alias("source_size"), k("target").alias("target"),
                 (crossed(F.col(place)) - crossed(F.col(place) - 1)).alias("copies")).alias(into))


def mixed(docs: DataFrame, mix: Mix = Mix(), **columns: str) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns it came with."""
    into = free_name(docs, "mix")
    times = F.col(f"`{into}`.copies")
    return with_copies(docs, mix, into=into, **columns).filter(times > 0).withColumn(
        into, F.explode(F.sequence(F.lit(1), times))).drop(into)
