"""MinHash near-dedup (operator 10) by a multi-index Hamming join.

1. One pass over the texts gives each document its set of word shingles, an
   exact fingerprint of the set, and a signature of 66 minhash values cut to
   16 bits.  Documents with one fingerprint form a class; only classes go on,
   so a group of copies of any size is one row.
2. Signatures are split into eleven chunks of six places.  Two that differ in
   at most 21 places differ in at most one place of some chunk (pigeonhole).
   The allowed errors are enumerated: a class gets a key for every chunk
   without each one of its places, 66 keys, and two such classes share a key.
   Beyond 21 places a pair is found by most chunks that it has left: at a
   similarity of exactly 0.8 all eleven fail with a chance of 8e-6.
3. In every key one class is linked to the others (no pairs within a group).
   It is the smallest after turning the fingerprints by a number of bytes that
   the key tells, so a family that shares many keys gets many centres.  Pairs
   that pass the bounds on set size, set difference (parity bits of the
   shingles give an exact lower bound) and signature distance are confirmed on
   their full sets.
4. What this leaves open are pairs of classes that share a key with a third
   class but are in different components so far.  In a key of up to 24 classes
   only the members outside its largest component are paired with the members
   of other components.  Keys of more classes stem from passages that many
   texts share; their classes are paired by the rarest fifth of their shingles
   instead (two sets of similarity 0.8 share one of these, and its place bounds
   their overlap), again only across components.  Of these pairs, those not
   tested in step 3 are confirmed in the same way.  So every pair that shares a
   key is in one component, or was
   tested, or shares no rare shingle and so is below 0.8.

Tables between the steps are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save, small_side
from colline.llm.components import components

PLACES, CHUNKS, ERRORS = 66, 11, 1
CHUNK = PLACES // CHUNKS
# Pairs whose signatures differ in more places are not confirmed: at a
# similarity of 0.8 that happens with a chance of 1e-6.
MOST_DIFFERENT = 30
PARITY_BITS = 512  # 64 bytes a class
SMALL_KEY = 24  # classes in a key that are paired directly
WORDS_REMEMBERED = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([xxhash.xxh64_intdigest(b"a", i) | 1 for i in range(PLACES)], dtype=np.uint64)
_SHIFTS = np.array([xxhash.xxh64_intdigest(b"b", i) for i in range(PLACES)], dtype=np.uint64)


class _WordHashes(dict):
    """Hash of a word; bounded memory of one worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return (x ^ (x >> np.uint64(29))) * _MIX


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a whole text.

    A-Z are lower-cased; with fewer words the whole sequence is one shingle;
    without a word the set is empty.
    """
    words = (text or "").encode("utf-8").lower().split()  # both act on exactly the ASCII letters and spaces
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.array([_HASHES[w] for w in words], dtype=np.uint64)
    out = h[: max(1, len(h) - width + 1)].copy()
    for k in range(1, min(width, len(h))):
        out = _scramble(out) + h[k : k + len(out)]
    return np.unique(_scramble(out + np.uint64(min(width, len(h)))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of each minhash value."""
    low = np.full(PLACES, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        low = np.minimum(low, (part[None, :] * _SEEDS[:, None] + _SHIFTS[:, None]).min(axis=1))
    return (low >> np.uint64(8)).astype(np.uint16)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls into each of 512 cells, as bits of 64-bit integers.

    Two sets differ in at least as many shingles as these bits differ.
    """
    cells = np.bincount((shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _sketch(width: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
            ("sig", pa.list_(pa.int32())), ("odd", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, sigs, odds = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, width)
                sizes.append(len(s))
                ids.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s).tolist() if len(s) else None)
                odds.append(parities(s).tolist() if len(s) else None)
            arrays = [batch.column(0), batch.column(1), *[pa.array(c, f.type) for c, f in zip((sizes, ids, sigs, odds), list(schema)[2:])]]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _sets(width: int):
    schema = pa.schema([("set_id", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [shingle_set(t, width) for t in batch.column(0).slice(at, 512).to_pylist()]
                ids = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
                lists = pa.ListArray.from_arrays(
                    np.cumsum([0] + [len(s) for s in sets]), pa.array(np.concatenate(sets).view(np.int64), pa.int64())
                )
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), lists.cast(schema.field(1).type)], schema=schema)

    return run


def _keys(classes: DataFrame) -> DataFrame:
    """``key, set_id``: one row for every chunk and every choice of its places without the allowed errors."""
    choices = F.array(
        *[
            F.struct(F.lit(k).alias("k"), *[F.lit(p).alias(f"p{i}") for i, p in enumerate(places)])
            for k, places in enumerate(
                places
                for c in range(CHUNKS)
                for places in combinations(range(c * CHUNK, (c + 1) * CHUNK), CHUNK - ERRORS)
            )
        ]
    )
    key = F.xxhash64("c.k", *[F.col("sig")[F.col(f"c.p{i}")] for i in range(CHUNK - ERRORS)])
    return classes.select(F.explode(choices).alias("c"), "set_id", "sig").select(key.alias("key"), "set_id")


def _turned(set_id: Column, by: Column) -> Column:
    """A fingerprint of 16 bytes with the first ``by`` bytes moved to the end."""
    return F.concat(F.substr(set_id, (by + 1).cast("int"), F.lit(16)), F.substr(set_id, F.lit(1), by.cast("int")))


def _full_sets(ends: DataFrame, classes: DataFrame, docs: DataFrame, width: int, name: str) -> DataFrame:
    """``set_id, shingles`` of some classes, from the texts of their representatives."""
    wanted = ends.join(classes, "set_id").select("set_id", F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th"))
    wanted = save(wanted, f"dedup-{name}-wanted")
    texts = docs.join(
        small_side(wanted.select("_id", "_th")), F.col("_doc").eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_th")), "left_semi"
    )
    sets = texts.select("_text").mapInArrow(_sets(width), "set_id binary, shingles array<bigint>")
    return save(sets.groupBy("set_id").agg(F.first("shingles").alias("shingles")), f"dedup-{name}-sets")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct ``u, v`` with u < v."""
    return rows.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def _across(members: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
    """``u, v`` from rows ``key, set_id, component, pos, n``: pairs of one key in different
    components.  The members of a key's largest component are not paired with each other."""
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("m", "component")).alias("largest"))
    torn = save(members.join(largest.where("parts > 1").select("key", "largest"), "key"), f"dedup-{name}-torn")
    few = torn.where(F.col("component") != F.col("largest")).select(
        "key", F.col("set_id").alias("x"), F.col("component").alias("cx"), F.col("pos").alias("px"), F.col("n").alias("nx")
    )
    everyone = torn.select("key", F.col("set_id").alias("y"), F.col("component").alias("cy"), F.col("pos").alias("py"), F.col("n").alias("ny"))
    apart = F.col("cx") != F.col("cy")
    pairs = few.join(everyone, ["key"]).where(apart if condition is None else apart & condition)
    return _pairs(pairs, "x", "y")


def _rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``key, set_id, pos, n``: the rarest shingles of each set, as many as a similar set must share one of.

    Rare is what few of these sets have; ``pos`` is the place in the order from rare to frequent.
    """
    tokens = sets.select("set_id", F.explode("shingles").alias("key"))
    often = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("sets"))
    ordered = tokens.join(often, "key").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("x"))
    ordered = ordered.withColumn("n", F.size("x").cast("bigint"))
    length = (F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1).cast("int")
    rare = ordered.select("set_id", "n", F.posexplode(F.slice("x", F.lit(1), length)).alias("pos", "t"))
    return rare.where("t.sets > 1").select(F.col("t.key").alias("key"), "set_id", (F.col("pos") + 1).alias("pos"), "n")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """``u, v`` of the pairs whose full sets are similar enough."""
    side = classes.select("set_id", "n_shingles", "sig", "odd")
    u = side.select(F.col("set_id").alias("u"), F.col("n_shingles").alias("nu"), F.col("sig").alias("su"), F.col("odd").alias("ou"))
    v = side.select(F.col("set_id").alias("v"), F.col("n_shingles").alias("nv"), F.col("sig").alias("sv"), F.col("odd").alias("ov"))
    different = F.size(F.filter(F.zip_with("su", "sv", lambda a, b: a != b), lambda x: x))
    # sets of this similarity differ in at most (100 - percent) / (100 + percent) of the sum of their sizes
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col("ou")[i].bitwiseXOR(F.col("ov")[i])) for i in range(PARITY_BITS // 64)])
    few = apart * (100 + percent) <= (F.col("nu") + F.col("nv")) * (100 - percent)
    near = save(
        pairs.join(u, "u")
        .join(v, "v")
        .where(
            (F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent) & few & (different <= MOST_DIFFERENT)
        )
        .select("u", "v", "nu", "nv"),
        f"dedup-{name}-near",
    )
    ends = near.select(F.col("u").alias("set_id")).unionAll(near.select(F.col("v").alias("set_id"))).distinct()
    sets = _full_sets(ends, classes, docs, width, name)
    su = sets.select(F.col("set_id").alias("u"), F.col("shingles").alias("xu"))
    sv = sets.select(F.col("set_id").alias("v"), F.col("shingles").alias("xv"))
    common = F.size(F.array_intersect("xu", "xv"))
    return near.join(su, "u").join(sv, "v").where(
        common * 100 >= (F.col("nu") + F.col("nv") - common) * percent
    ).select("u", "v")


def similar_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """(documents, components): ``doc_id, th, n_shingles, set_id`` per row, and ``node, component``
    of the classes that have a link to another class."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text_col).alias("_text"))
    sketched = rows.select(F.col("_doc").alias("doc_id"), F.xxhash64("_text").alias("th"), F.col("_text").alias("text")).mapInArrow(
        _sketch(width), "doc_id long, th long, n_shingles long, set_id binary, sig array<int>, odd array<bigint>"
    )
    sketched = save(sketched, "dedup-sketch")
    classes = save(
        sketched.where(F.col("n_shingles") > 0)
        .groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.min("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("odd").alias("odd")),
        "dedup-classes",
    )
    keys = _keys(classes)
    turned = _turned(F.col("set_id"), F.pmod("key", F.lit(16)))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(turned).alias("first")).where("members > 1")
    shared = shared.withColumn("first", _turned(F.col("first"), F.lit(16) - F.pmod("key", F.lit(16))))
    met = save(keys.join(shared, "key"), "dedup-met")
    star = _pairs(met.where(F.col("set_id") != F.col("first")), "first", "set_id")
    star = save(star, "dedup-star")
    links = save(_confirmed(star, classes, rows, width, percent, "star"), "dedup-star-links")
    first = save(components(links, "dedup-first"), "dedup-first")

    # pairs within keys of three or more classes that the stars have not joined
    names = first.select(F.col("node").alias("set_id"), "component")
    own = lambda rows: rows.join(names, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    none = F.lit(0).cast("bigint")
    small = met.where((F.col("members") > 2) & (F.col("members") <= SMALL_KEY) & (F.col("set_id") != F.col("first")))
    small = own(small.select("key", "set_id", none.alias("pos"), none.alias("n")))
    large = met.where(F.col("members") > SMALL_KEY).select("set_id").distinct()
    rare = _rare_shingles(_full_sets(large, classes, rows, width, "large"), percent)
    overlap = F.lit(1) + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    possible = (overlap * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent) & (
        F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent
    )
    crossing = _across(small, "small").unionAll(_across(own(rare), "rare", possible)).distinct()
    crossing = crossing.join(star, ["u", "v"], "left_anti")  # these have been tested
    more = save(_confirmed(crossing, classes, rows, width, percent, "cross"), "dedup-cross-links")
    if more.isEmpty():
        return sketched, first
    joined = first.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return sketched, save(components(joined.unionAll(more), "dedup-all"), "dedup-components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, kept``, one row per input row.

    Documents are linked if 100 * shared >= percent * united of their sets of
    distinct ``width``-word shingles (whole texts, A-Z lower-cased); the
    component is the smallest id reachable and the row with it is kept.  ``th``
    is a hash of the text (with doc_id it names a row).  Null, empty and blank
    texts have no shingles and are linked with nothing: they are components of
    their own.  A row with a null id never names a component unless all ids of
    it are null (then component_id is null and the rows are kept).  Repeated
    rows are copies of each other and all carry the kept id; :func:`deduplicated`
    leaves one of them.  Other columns are not read; an empty table gives an
    empty result.
    """
    named = _named(docs, id_col, text_col, width, percent)
    return named.select("doc_id", "th", "n_shingles", "component_id", "kept")


def _named(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """:func:`near_duplicates` with ``component``, a class of the component (null without shingles)."""
    rows, comps = similar_classes(docs, id_col, text_col, width, percent)
    comps = comps.select(F.col("node").alias("set_id"), "component")
    named = rows.join(comps, "set_id", "left").select(
        "doc_id", "th", "n_shingles", "set_id", F.coalesce("component", "set_id").alias("component")
    )
    named = save(named, "dedup-named")
    low = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = named.join(low, "component", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with one row of every component, all columns as they are.

    Rows that stay: the one with the component's smallest id, among several
    with that id (or with null ids only) the smallest text hash, among
    identical id and text any one.
    """
    found = save(_named(docs, id_col, text_col, width, percent), "dedup-found")
    alone = F.col("component").isNull()
    name = F.struct("component", F.when(alone, F.col("doc_id")).alias("doc_id"), F.when(alone, F.col("th")).alias("th"))
    winners = save(
        found.where("kept").groupBy(name.alias("name")).agg(F.min(F.struct("doc_id", "th")).alias("w")).select(
            F.col("w.doc_id").alias("_wid"), F.col("w.th").alias("_wth")
        ),
        "dedup-winners",
    )
    doc, th = F.col(id_col).cast("bigint"), F.xxhash64(text_col)
    kept = docs.join(small_side(winners), doc.eqNullSafe(F.col("_wid")) & (th == F.col("_wth")), "left_semi")
    repeated = found.groupBy("doc_id", "th").count().where("count > 1").select("doc_id", "th").limit(1)
    return kept if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col])
