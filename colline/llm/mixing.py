"""Mixing sources to target weights (operator 1) by Pareto order sampling.

Targets.  Every source gets its share of the mix by weight, at most ``cap``
times its own size; what that cuts off is shared again among the others.  With
the sources in the order of cap / weight, the capped ones come first, so one
pass of running sums finds the shares.

Documents.  A source whose target is r times its size gets floor(r) certain
whole copies of every document.  The rest is a sample: a document with the
uniform number u (a keyed hash of its id) has the rank
``(u / (1 - u)) / (l / (1 - l) * preference)``, random odds over inclusion
odds, where l is the share of the source that the sample has to give.  Lowest
ranks go first until the sample has the words it is meant to have; the document
that crosses this size stays if that comes nearer to it.

No sort of a whole source is needed: ranks fall into 4096 cells, the words of
each cell are summed, and the cell in which the size is crossed is cut again
into 4096; only documents of one such cell are sorted.  All steps after the
first pass run on ids, sizes and ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colline.llm.common import save, small_side, word_count

CELLS = 4096
CYCLE = (3, 1, 2)


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """``source, weight``: 3, 1, 2, 3, ... in code point order, null last (one row per source, in one task)."""
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(CYCLE)
    return sources.select("source", F.element_at(F.array(*map(F.lit, CYCLE)), turn + 1).cast("double").alias("weight"))


def source_targets(sources: DataFrame, weights: DataFrame, total: float, cap: float) -> DataFrame:
    """``source, source_size, n_docs, target`` from ``source, source_size, n_docs`` and weights.

    Sources without a weight get none of the mix.  The sources themselves are
    the rows here, so the running sums are over as many rows as there are sources.
    """
    s = sources.join(weights.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    s = s.withColumn("w", F.coalesce("weight", F.lit(0.0))).withColumn("most", F.col("source_size") * F.lit(cap))
    s = s.withColumn("order", F.when(F.col("w") > 0, F.col("most") / F.col("w")).otherwise(F.lit(float("inf"))))
    line = Window.orderBy("order", F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    s = s.withColumn("left", F.sum("source_size").over(everything) * F.lit(total) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    s = s.withColumn("weights", F.sum("w").over(after))
    s = s.withColumn("capped", (F.col("w") > 0) & (F.col("most") * F.col("weights") <= F.col("w") * F.col("left")))
    first = F.min(F.when(~F.col("capped") & (F.col("w") > 0), F.struct("order", F.col("source").isNull(), "source", "left", "weights"))).over(everything)
    s = s.withColumn("open", first)
    share = F.col("w") * F.col("open.left") / F.col("open.weights")
    target = F.when(F.col("w") <= 0, F.lit(0.0)).when(F.col("capped"), F.col("most")).otherwise(share)
    return s.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(id_: Column, seed: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def by_size(low: float = 0.5, high: float = 2.0) -> Column:
    """Preference: a document's size over the mean of its source, within ``low`` and ``high``."""
    mean = F.col("source_size") / F.col("n_docs")
    return F.when(mean > 0, F.least(F.lit(high), F.greatest(F.lit(low), F.col("size") / mean))).otherwise(F.lit(1.0))


def _ranked(sized: DataFrame, plan: DataFrame, seed: str, preference: Column) -> DataFrame:
    """``sized`` (``_id, _th, size, source`` and more) with the source's plan, rank and cells."""
    plan = plan.withColumnRenamed("source", "_source")
    df = sized.join(small_side(plan), F.col("source").eqNullSafe(F.col("_source")), "left")
    u, odds = _uniform(F.col("_id"), seed), F.col("_share") / (F.lit(1.0) - F.col("_share"))
    df = df.withColumn("_u", u).withColumn("_rank", F.col("_u") / (F.lit(1.0) - F.col("_u")) / F.when(odds > 0, odds * preference))
    place = F.col("_rank") / (F.lit(1.0) + F.col("_rank")) * F.lit(float(CELLS))
    df = df.withColumn("_cell", F.floor(place)).withColumn("_sub", F.floor((place - F.floor(place)) * F.lit(float(CELLS))))
    return df.withColumn("_key", F.struct("_rank", F.coalesce("_id", F.lit(-(2**63))).alias("_id"), "size", F.coalesce("_th", F.lit(0)).alias("_th")))


def _crossing(words: DataFrame, cell: str, start: Column) -> DataFrame:
    """The first cell of each source in which the running words exceed the sample's size."""
    line = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = words.withColumn("_run", start + F.sum("_words").over(line))
    over = run.where(F.col("_run") > F.col("_want"))
    return over.groupBy("source").agg(F.min(F.struct(cell, (F.col("_run") - F.col("_words")).alias("_before"))).alias("x"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"),
        word_count(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source"),
    ]


class Mix:
    """The plan of one mix: targets, whole copies and the cut of every source's sample.

    ``weights``: ``None`` for :func:`cyclic_weights`, or a DataFrame ``source,
    weight``.  ``total``: size of the mix over the size of all documents.
    ``cap``: most that a source, and so a document, is repeated.  ``preference``:
    a positive factor on a document's inclusion odds, from ``size``,
    ``source_size`` and ``n_docs``.

    Null texts have size 0, null sources are a source of their own, null ids
    share one random number.  Rows that agree in id and text stay or go by rank
    like others; identical ones at the cut all stay.  An empty table gives an
    empty mix.
    """

    def __init__(
        self, docs: DataFrame, weights: DataFrame | None = None, total: float = 1.5, cap: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
        preference: Column | None = None,
    ):
        self.columns, self.seed = (id_col, text_col, source_col), seed
        self.preference = by_size() if preference is None else preference
        self.sized = save(docs.select(*_sized(docs, *self.columns)), "mix-sizes")
        sources = save(
            self.sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "mix-sources"
        )
        targets = source_targets(sources, cyclic_weights(sources) if weights is None else weights, total, cap)
        copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
        plan = targets.withColumn("_copies", copies.cast("int"))
        plan = plan.withColumn("_want", F.col("target") - F.col("_copies") * F.col("source_size"))
        plan = plan.withColumn("_share", F.when(F.col("source_size") > 0, F.col("_want") / F.col("source_size")).otherwise(F.lit(0.0)))
        plan = save(plan, "mix-plan")

        ranked = _ranked(self.sized, plan, seed, self.preference).where(F.col("_share") > 0)
        words = ranked.groupBy("source", "_want", "_cell").agg(F.sum("size").alias("_words"))
        at = _crossing(words, "_cell", F.lit(0.0)).select(
            F.col("source").alias("_s"), F.col("x._cell").alias("_c"), F.col("x._before").alias("_b")
        )
        at = save(at, "mix-cells")
        inside = ranked.join(small_side(at), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
        words = inside.groupBy("source", "_want", "_c", "_b", "_sub").agg(F.sum("size").alias("_words"))
        sub = _crossing(words.withColumn("_sub0", F.struct("_sub", "_c")), "_sub0", F.col("_b")).select(
            F.col("source").alias("_s2"), F.col("x._sub0._sub").alias("_d"), F.col("x._sub0._c").alias("_c"), F.col("x._before").alias("_b2")
        )
        sub = save(sub, "mix-subcells")
        last = ranked.join(
            small_side(sub), F.col("source").eqNullSafe(F.col("_s2")) & (F.col("_cell") == F.col("_c")) & (F.col("_sub") == F.col("_d"))
        )
        line = Window.partitionBy("source").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = F.col("_b2") + F.sum("size").over(line)
        last = last.withColumn("_run", run).where(
            (F.col("_run") <= F.col("_want"))
            | (
                (F.col("_run") - F.col("size") <= F.col("_want"))
                & (F.col("_run") - F.col("_want") < F.col("_want") - (F.col("_run") - F.col("size")))
            )
        )
        cut = last.groupBy("source").agg(F.max("_key").alias("_last")).withColumnRenamed("source", "_s3")
        marks = plan.join(sub.drop("_b2"), F.col("source").eqNullSafe(F.col("_s2")), "left")
        marks = marks.join(cut, F.col("source").eqNullSafe(F.col("_s3")), "left").drop("_s2", "_s3")
        self.marks = save(marks, "mix-marks")

    def _taken(self, sized: DataFrame) -> DataFrame:
        df = _ranked(sized, self.marks, self.seed, self.preference)
        sampled = F.when(F.col("_share") <= 0, F.lit(False)).when(F.col("_c").isNull(), F.lit(True)).otherwise(
            (F.col("_cell") < F.col("_c"))
            | (
                (F.col("_cell") == F.col("_c"))
                & ((F.col("_sub") < F.col("_d")) | ((F.col("_sub") == F.col("_d")) & F.coalesce(F.col("_key") <= F.col("_last"), F.lit(False))))
            )
        )
        return df.withColumn("copies", F.col("_copies") + sampled.cast("int"))

    def counts(self) -> DataFrame:
        """``doc_id, source, size, source_size, target, copies, taken`` of every document."""
        df = self._taken(self.sized)
        return df.select(
            F.col("_id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
        )

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs``, each row as often as the mix takes it; all columns as they are, no shuffle."""
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        df = self._taken(docs.select(row, *_sized(docs, *self.columns)))
        return df.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
