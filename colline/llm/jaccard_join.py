"""N-gram Jaccard join (operator 12): exact set-similarity links with set-relation skipping.

Every pair of texts whose sets of word shingles have a Jaccard similarity of at
least ``percent`` is found.  Sets are ordered by a global order of shingles
(rare ones first); a similar pair shares a shingle of both prefixes, and the
places of the first shared one bound the overlap.

1. One pass over the texts writes each set's size, a 128-bit fingerprint and a
   hash-chosen sixth of its shingles (more where the prefix needs them).  Equal
   sets are one class from here on.
2. First index, over that sixth: shingles are counted over all classes and
   those that only one class has are places without an entry.  Index lists are
   skipped in blocks: sets of one size that hold the list's shingle at one
   place are one row, and a block stays if some block of its list passes the
   bounds on size and place.  Sets in no such block have no partner; only the
   others are read whole.
3. Second index, over whole sets, built and skipped in the same way.
4. Relations: in every list and size band the set with the shingle at the
   lowest place (it has the fewest rare ones) is compared with the others.
   What is similar is linked, and the difference of the two sets is kept.
5. Answers: what is left open are blocks of one list in different components
   (those of a list's largest component are not compared with each other).  A
   set that has a similar set takes its answer from that set's: the overlap of
   the similar set and the partner, computed once for all its relatives, bounds
   the overlap up to the kept difference, and where the bounds do not decide,
   only the shingles of the difference are looked up in the partner.

Nothing is broadcast but a table of at most 200,000 ids; tables between the
steps are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colline.llm.common import save, small_side
from colline.llm.components import components
from colline.llm.minhash_dedup import shingle_set

PART = 6  # one shingle in so many is in the first index


def prefix_length(n, percent: int):
    """Shingles of a set of size n of which a similar set must share one, for numbers and columns."""
    if isinstance(n, Column):
        return n - F.call_function("div", n * percent + 99, F.lit(100).cast("bigint")) + 1
    return n - (n * percent + 99) // 100 + 1


def chosen_part(shingles: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """(how many are of the chosen part, the chosen ones and as many others, by value, as the prefix lacks)."""
    ours = shingles % np.uint64(PART) == 0
    chosen, lack = shingles[ours], prefix_length(len(shingles), percent) - int(ours.sum())
    return len(chosen), np.concatenate((chosen, shingles[~ours][: max(lack, 0)])) if lack > 0 else chosen


def _sketch(width: int, percent: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("th", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("print", pa.binary()),
            ("u", pa.int32()), ("part", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                sets = [shingle_set(t, width) for t in piece.column(2).to_pylist()]
                parts = [chosen_part(s, percent) for s in sets]
                lists = pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(p) for _, p in parts]), pa.array(np.concatenate([p for _, p in parts]).view(np.int64), pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1), pa.array(range(row, row + len(sets)), pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([u for u, _ in parts], pa.int32()), lists.cast(schema.field(6).type),
                    ],
                    schema=schema,
                )
                row += len(sets)

    return run


def _whole(width: int):
    """``print, part`` with all shingles of a text, for the second index."""
    schema = pa.schema([("print", pa.binary()), ("part", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [shingle_set(t, width) for t in batch.column(0).slice(at, 512).to_pylist()]
                lists = pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(s) for s in sets]), pa.array(np.concatenate(sets).view(np.int64), pa.int64())
                )
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()), lists.cast(schema.field(1).type)], schema=schema)

    return run


def _entries(sets: DataFrame, percent: int, name: str) -> DataFrame:
    """``token, id, n, pos``: the index entries of sets ``id, n, u, part``.

    The order of shingles: those of the chosen part (the first ``u`` of
    ``part``) by the number of sets that have them, then the others by value.
    Shingles of one set only fill places but give no entry.
    """
    tokens = sets.select("id", "n", "u", F.posexplode("part").alias("i", "token"))
    counts = save(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), f"jaccard-{name}-counts")
    rows = tokens.join(counts, "token").withColumn("late", F.col("i") >= F.col("u"))
    own = Window.partitionBy("id")  # a set's own shingles
    shared = F.count(F.when(~F.col("late"), 1)).over(own)
    rank = F.row_number().over(own.orderBy("late", "sets", "token"))
    pos = F.when(F.col("late"), F.col("i") + 1).otherwise(F.col("u") - shared + rank)
    out = rows.select("token", "id", "n", pos.cast("bigint").alias("pos"))
    return save(out.where(F.col("pos") <= prefix_length(F.col("n"), percent)), f"jaccard-{name}-entries")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes and places of a shared shingle leave the similarity possible."""
    na, pa_, nb, pb = (F.col(f"{s}.{c}") for s in (a, b) for c in ("n", "pos"))
    overlap = F.lit(1) + F.least(na - pa_, nb - pb)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (overlap * (100 + percent) >= (na + nb) * percent)


def _partnered(entries: DataFrame, percent: int, name: str) -> DataFrame:
    """The entries in blocks that some block of their list does not rule out."""
    blocks = save(entries.groupBy("token", "n", "pos").agg(F.count(F.lit(1)).alias("size")), f"jaccard-{name}-blocks")
    a, b = blocks.alias("a"), blocks.alias("b")
    other = (F.col("a.n") != F.col("b.n")) | (F.col("a.pos") != F.col("b.pos")) | (F.col("a.size") > 1)
    kept = a.join(b, (F.col("a.token") == F.col("b.token")) & other & _possible("a", "b", percent), "left_semi")
    return save(entries.join(save(kept.drop("size"), f"jaccard-{name}-kept"), ["token", "n", "pos"]), f"jaccard-{name}-partnered")


def _similar(overlap: Column, sizes: Column, percent: int) -> Column:
    return overlap * (100 + percent) >= sizes * percent


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def _sides(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the sizes and shingles of both ends: ``na, xa, nb, xb``."""
    x = sets.select(F.col("id").alias(a), F.col("n").alias("na"), F.col("part").alias("xa"))
    y = sets.select(F.col("id").alias(b), F.col("n").alias("nb"), F.col("part").alias("xb"))
    return pairs.join(x, a).join(y, b)


def _relations(entries: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(tested pairs ``u, v``, relations ``base, id, gone, new`` of similar pairs): the lowest set of
    every list and size band against the band's others."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(log(100 / percent))).cast("int")
    banded = entries.withColumn("band", band)
    lowest = banded.groupBy("token", "band").agg(F.min(F.struct("pos", "id", "n")).alias("c"))
    lowest = lowest.select("token", "band", F.col("c.pos").alias("pos"), F.col("c.id").alias("base"), F.col("c.n").alias("n"))
    lowest = save(lowest, "jaccard-lowest")
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.id") != F.col("b.base"))
    met = banded.alias("a").join(lowest.alias("b"), same & _possible("a", "b", percent)).select(F.col("b.base").alias("base"), F.col("a.id").alias("id"))
    # a pair can meet in both directions; one of them is compared
    one = met.distinct().groupBy(F.least("base", "id").alias("u"), F.greatest("base", "id").alias("v")).agg(F.min(F.struct("base", "id")).alias("p"))
    tested = save(one, "jaccard-relations-tested")
    full = _sides(tested.select("p.base", "p.id"), sets, "base", "id")
    full = full.withColumn("overlap", F.size(F.array_intersect("xa", "xb")))
    near = full.where(_similar(F.col("overlap"), F.col("na") + F.col("nb"), percent))
    kept = near.select("base", "id", F.array_except("xa", "xb").alias("gone"), F.array_except("xb", "xa").alias("new"))
    return tested.select("u", "v"), save(kept, "jaccard-relations")


def _open_pairs(entries: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """``u, v`` of sets in different components whose blocks in some list do not rule each other out."""
    own = entries.join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))
    own = save(own, "jaccard-own")
    blocks = own.groupBy("token", "component", "n", "pos").agg(F.count(F.lit(1)).alias("size"))
    sizes = blocks.groupBy("token", "component").agg(F.sum("size").alias("m"))
    torn = sizes.groupBy("token").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "component")).alias("most")).where("parts > 1")
    blocks = save(blocks.join(torn.select("token", F.col("most.component").alias("largest")), "token"), "jaccard-torn")
    a, b = blocks.where("component != largest").alias("a"), blocks.alias("b")
    apart = (F.col("a.token") == F.col("b.token")) & (F.col("a.component") != F.col("b.component"))
    met = a.join(b, apart & _possible("a", "b", percent)).select(
        "a.token", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in ("component", "n", "pos")]
    )
    met = save(met, "jaccard-open-blocks")
    side = lambda s, out: own.select("token", F.col("id").alias(out), *[F.col(c).alias(f"{s}_{c}") for c in ("component", "n", "pos")])
    for s, out in (("a", "x"), ("b", "y")):
        met = met.join(side(s, out), ["token", f"{s}_component", f"{s}_n", f"{s}_pos"])
    return _pairs(met, "x", "y")


def _derived(pairs: DataFrame, relations: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``u, v`` of the similar ones among ``pairs``, from the answers of similar sets.

    ``id`` takes the closest of its relatives as ``base`` (itself if it has
    none); the overlap of base and partner is computed once per such pair.
    """
    closest = relations.groupBy("id").agg(F.min(F.struct((F.size("gone") + F.size("new")).alias("d"), "base", "gone", "new")).alias("r"))
    closest = save(closest.select("id", "r.base", "r.gone", "r.new"), "jaccard-closest")
    sizes = sets.select("id", "n")
    of = lambda end: closest.select(F.col("id").alias(end), F.col("base").alias(f"{end}_base"))
    known = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left")
    turn = F.col("u_base").isNull() & F.col("v_base").isNotNull()  # the end with a relative is `id`
    asked = known.select(
        F.when(turn, F.col("v")).otherwise(F.col("u")).alias("id"), F.when(turn, F.col("u")).otherwise(F.col("v")).alias("partner"),
        F.when(turn, F.col("v_base")).otherwise(F.coalesce("u_base", "u")).alias("base"),
    )
    asked = save(asked, "jaccard-asked")
    answers = _sides(asked.select("base", "partner").distinct(), sets, "base", "partner")
    answers = save(answers.select("base", "partner", F.col("nb").alias("n_partner"), F.size(F.array_intersect("xa", "xb")).alias("overlap")), "jaccard-answers")
    none = F.array().cast("array<bigint>")
    own = sizes.join(closest, "id", "left").select("id", F.col("n").alias("n_id"), F.coalesce("gone", none).alias("gone"), F.coalesce("new", none).alias("new"))
    rows = asked.join(answers, ["base", "partner"]).join(own, "id")
    both = F.col("n_id") + F.col("n_partner")
    sure = _similar(F.col("overlap") - F.size("gone"), both, percent)
    maybe = _similar(F.col("overlap") + F.size("new"), both, percent)
    rows = save(rows.where(maybe).withColumn("sure", sure), "jaccard-maybe")
    looked = rows.where("not sure").join(sets.select(F.col("id").alias("partner"), "part"), "partner")
    overlap = F.col("overlap") - F.size(F.array_intersect("gone", "part")) + F.size(F.array_intersect("new", "part"))
    found = looked.where(_similar(overlap, both, percent)).select("id", "partner")
    return _pairs(rows.where("sure").select("id", "partner").unionAll(found), "id", "partner")


def similar_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): ``doc_id, n, print`` per input row, ``id, print, doc_id`` per distinct
    set (doc_id its smallest), and ``u, v`` of class ids.

    The links are similar pairs, enough of them to connect every two similar
    sets; pairs within a component that others already connect may be missing.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    sketched = texts.mapInArrow(
        _sketch(width, percent), "doc_id long, th long, row long, n long, print binary, u int, part array<bigint>"
    )
    sketched = save(sketched, "jaccard-sketch")
    classes = save(
        sketched.where("n > 0").groupBy("print").agg(
            F.min(F.struct("row", "doc_id", "th")).alias("rep"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
            F.first("u").alias("u"), F.first("part").alias("part"),
        ).select(F.col("rep.row").alias("id"), "print", "doc_id", "n", "u", "part", F.struct("rep.doc_id", "rep.th").alias("rep")),
        "jaccard-classes",
    )
    first = _partnered(_entries(classes, percent, "first"), percent, "first")
    wanted = classes.join(first.select("id").distinct(), "id").select("id", "print", "n", "rep")
    wanted = save(wanted, "jaccard-wanted")
    at = small_side(wanted.select(F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th")))
    read = texts.join(at, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi")
    read = read.select("text").mapInArrow(_whole(width), "print binary, part array<bigint>").groupBy("print").agg(F.first("part").alias("part"))
    sets = save(wanted.select("id", "print", "n").join(read, "print").select("id", "n", F.col("n").alias("u"), "part"), "jaccard-sets")
    entries = _partnered(_entries(sets, percent, "second"), percent, "second")
    tested, relations = _relations(entries, sets, percent)
    links = relations.select(F.col("base").alias("u"), F.col("id").alias("v"))
    named = save(components(links, "jaccard-related"), "jaccard-related").select(F.col("node").alias("id"), "component")
    pairs = save(_open_pairs(entries, named, percent).join(tested, ["u", "v"], "left_anti"), "jaccard-open")
    more = save(_derived(pairs, relations, sets, percent), "jaccard-derived")
    return sketched.select("doc_id", "n", "print"), classes.select("id", "print", "doc_id"), links.unionAll(more)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Rows are linked if 100 * shared >= percent * united of their sets of
    distinct ``width``-word shingles (whole texts, A-Z lower-cased; fewer words
    are one shingle); ``component_id`` is the smallest doc_id reachable.  Null,
    empty and blank texts have no shingles and are linked with nothing.  Rows
    with equal sets are linked, repeated rows too; a null id names no component
    unless all ids of it are null.  Other columns are not read; an empty table
    gives an empty result.
    """
    rows, classes, links = similar_sets(docs, id_col, text_col, width, percent)
    comps = components(links, "jaccard-all").select(F.col("node").alias("id"), "component")
    named = save(classes.join(comps, "id", "left").select("print", "doc_id", F.coalesce("component", "id").alias("component")), "jaccard-named")
    low = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = save(named.select("print", "component").join(low, "component").select("print", "component_id"), "jaccard-low")
    out = rows.join(named, "print", "left")
    alone = F.col("print").isNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
