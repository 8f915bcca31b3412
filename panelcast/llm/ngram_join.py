"""N-gram Jaccard join: grouped prefix filtering, then verification of members.

A document's set holds its distinct word shingles.  All sets are ordered by one
global order, rarest shingles first.  Two sets that reach the threshold share a
shingle in their prefixes, the first ``n - ceil(t n) + 1`` shingles.  Documents
with the same prefix and size form one group; only groups are indexed and
paired, with filters on size, position, parity bitmaps of 512 bits and number
of shared prefix shingles; all are upper bounds of the overlap.
What passes is expanded to members and verified on the whole sets.

The result asked for is components, so pairs that other links already join are
not built.  A first pass pairs each group with one group of every shared
shingle, and each member with its group's first.  In a hub pass every set of a
shingle (or group) whose sets lie in several components is paired with a few
of them, chosen by hash.  The last pass is exact: groups that share a
shingle and still hold different components are compared by place, size and the
parity bits that all sets of a group agree on; pairs that may link are expanded
to members.  Two groups that share many shingles need to meet at one of them
only, the first in an order of all shingles.  The join's key therefore says
which of a few earlier shingles a group has, and groups that share one of those
don't meet again.  Copies meet as one set.

Frequencies come from a sketch of fixed size over the whole corpus (one count
per hash cell, kept as half-octave classes of one byte).  It only decides the
order, which may be any; results don't depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from . import textcore
from .components import connected_components

SHINGLE = 4
PERCENT = 85  # link when 100 * intersection >= PERCENT * union
SKETCH_BITS = (20, 24)  # cells of the sketch: at most 16 MB broadcast
_BLOCK_BITS = 16  # sketch cells that travel in one row
CHUNK = 1 << 20  # bytes of text hashed at a time (or one longer text)
HUBS = 8  # sets of a shingle that the others are paired with in the hub pass
HUB_ROWS = 256  # pairs of one set that are verified in one place
EARLIER = 3  # earlier shingles of a shingle, whose pairs aren't compared again at it
EARLIEST = 8  # shingles of a group that are searched for them
_PARITY = 8  # longs of a set's parity bitmap: 512 bits
_PARITY_COLUMNS = [f"b{i}" for i in range(_PARITY)]


def _sets(part: textcore.Words, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; short texts are one shingle."""
    rolled = textcore.rolling(part.hashes, width)
    for a, b in zip(part.offsets[:-1], part.offsets[1:]):
        n = b - a
        if n >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif n:
            short = textcore.rolling(part.hashes[a:b], n)
            yield textcore.mix(short + np.uint64(n))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _sketch_blocks(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for part in textcore.words(batch.column(0), lower=True, chunk=CHUNK):
                seen = [s for s in _sets(part, width) if len(s)]
                if seen:
                    at, n = np.unique(np.concatenate(seen) & np.uint64(len(cells) - 1), return_counts=True)
                    cells[at] += n.astype(np.uint32)
        rows = cells.reshape(-1, 1 << _BLOCK_BITS)
        used = np.flatnonzero(rows.any(axis=1))
        planes = [np.ascontiguousarray(rows[i].view(np.uint8).reshape(-1, 4).T).tobytes() for i in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(planes, pa.binary())], names=["block", "cells"]
        )

    return run


def _sum_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << _BLOCK_BITS, dtype=np.int64)
    for data in pdf["cells"]:
        planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
        total += np.ascontiguousarray(planes.T).reshape(-1).view(np.uint32)
    return pd.DataFrame(
        {"block": [pdf["block"].iloc[0]], "classes": [(2 * np.log2(np.maximum(total, 1))).astype(np.uint8).tobytes()]}
    )


def frequency_classes(texts: DataFrame, width: int, bits: int) -> np.ndarray:
    """Half-octave frequency class of each sketch cell: ``2**bits`` bytes at any corpus size."""
    rows = (
        texts.mapInArrow(_sketch_blocks(width, bits), "block int, cells binary")
        .groupBy("block")
        .applyInPandas(_sum_blocks, "block int, classes binary")
        .collect()
    )
    classes = np.zeros((1 << (bits - _BLOCK_BITS), 1 << _BLOCK_BITS), dtype=np.uint8)
    for row in rows:
        classes[row["block"]] = np.frombuffer(row["classes"], dtype=np.uint8)
    return classes.reshape(-1)


def _prefixes(width: int, percent: int, classes):
    """Per document: set size, digest of the set, digest of (prefix, size), prefix, parity bitmap."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("grp", pa.binary()), ("prefix", pa.list_(pa.int64()))]
        + [(c, pa.int64()) for c in _PARITY_COLUMNS]
    )

    def parity(values: np.ndarray) -> np.ndarray:
        """Bit i is the parity of the number of shingles that hash to i."""
        cells = np.bincount((values >> np.uint64(55)).astype(np.int64), minlength=_PARITY * 64) & 1
        return np.packbits(cells.astype(np.uint8)).view(np.int64)

    def digest(*parts: bytes) -> bytes:
        return hashlib.blake2b(b"".join(parts), digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        for batch in batches:
            for part in textcore.words(batch.column(1), lower=True, chunk=CHUNK):
                sizes, sigs, groups, prefixes, bits = [], [], [], [], []
                for values in _sets(part, width):
                    n = len(values)
                    order = (table[values & np.uint64(len(table) - 1)].astype(np.uint64) << np.uint64(56)) | (
                        values >> np.uint64(8)
                    )
                    keep = n - -(-percent * n // 100) + 1 if n else 0
                    prefix = values[np.argsort(order, kind="stable")[:keep]].view(np.int64)
                    sizes.append(n)
                    sigs.append(digest(values.tobytes()))
                    groups.append(digest(n.to_bytes(8, "little"), prefix.tobytes()))
                    prefixes.append(prefix)
                    bits.append(parity(values))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(sigs, pa.binary()),
                        pa.array(groups, pa.binary()),
                        pa.ListArray.from_arrays(
                            np.cumsum([0, *map(len, prefixes)], dtype=np.int32),
                            pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)),
                        ),
                        *[pa.array(column) for column in np.stack(bits).T.copy()],
                    ],
                    schema=schema,
                )

    return run


def _contents(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.words(batch.column(1), lower=True, chunk=CHUNK):
                sets = [values.view(np.int64) for values in _sets(part, width)]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(sets)), lists], names=["id", "shingles"])

    return run


def _pair_filter(percent: int):
    """Bound on the overlap of a pair: columns n1, n2, shared (prefix shingles in common)."""
    need = (F.col("n1") + F.col("n2")) * percent
    rest = F.greatest(F.floor(F.col("n1") * percent / 100), F.floor(F.col("n2") * percent / 100))
    return (F.col("shared") + rest) * (100 + percent) >= need


def _parity_fits(percent: int):
    """Bound on the overlap from parity bitmaps: each bit that differs is a shingle of one set alone."""
    apart = sum((F.bit_count(F.col(f"{c}1").bitwiseXOR(F.col(f"{c}2"))) for c in _PARITY_COLUMNS), F.lit(0))
    total = F.col("n1") + F.col("n2")
    return (total - apart) * (100 + percent) >= 2 * percent * total


def _parity_agreed(percent: int):
    """``_parity_fits`` of two groups, on the bits that don't vary within either (``v*``): it holds for every pair of their sets."""
    apart = F.lit(0)
    for c in _PARITY_COLUMNS:
        varying = F.col(f"v{c}1").bitwiseOR(F.col(f"v{c}2"))
        apart = apart + F.bit_count(F.col(f"{c}1").bitwiseXOR(F.col(f"{c}2")).bitwiseAND(F.bitwise_not(varying)))
    total = F.col("n1") + F.col("n2")
    return (total - apart) * (100 + percent) >= 2 * percent * total


def _place_fits(percent: int):
    """Bound on the overlap of a pair, seen from one shingle that both prefixes share.

    ``pos`` is its place in a prefix, ``rank`` the number of shingles before it
    that other prefixes have too.  A common shingle that stands before it is in
    both prefixes, so there are ``rank`` of them at most in either; all other
    common ones stand at it or after it.  A pair that fails at any shared
    shingle can't reach the threshold.
    """
    sizes = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
    after = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    overlap = F.least("rank1", "rank2") + after
    return sizes & (overlap * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent)


def _with_earlier(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` (a row per group and shingle) with ``seen`` and ``known``, for ``_pairs_apart``.

    All shingles have one order, those of most groups first.  ``known`` has
    a bit for each earlier shingle (``EARLIER`` at most) that a shingle knows of,
    ``seen`` the bits of those that the group is known to have too.  Groups in
    ``repeated`` share their id with another: they have none.
    """
    rows = rows.join(rows.groupBy("token").agg((-F.count("*")).alias("few")), "token")
    first = F.slice(F.sort_array(F.collect_list(F.struct("few", "token"))), 1, EARLIEST)  # of a prefix at most
    first = rows.groupBy("gid").agg(first.alias("first")).join(repeated, "gid", "left_anti")
    rows = rows.join(first, "gid", "left")
    known = rows.groupBy("token", "few").agg(F.min_by("first", F.xxhash64("gid")).alias("known"))
    before = F.filter("known", lambda x: x < F.struct("few", "token"))
    rows = rows.join(known.select("token", F.slice(before, 1, EARLIER).alias("known")), "token")
    each = [(F.get("known", F.lit(i)), 1 << i) for i in range(EARLIER)]
    seen = [F.when(F.array_contains("first", shingle), bit).otherwise(0) for shingle, bit in each]
    known = [F.when(shingle.isNotNull(), bit).otherwise(0) for shingle, bit in each]
    return rows.withColumns({"seen": sum(seen, F.lit(0)), "known": sum(known, F.lit(0))}).drop("few", "first")


def _pairs_apart(sides: DataFrame, percent: int) -> DataFrame:
    """(gid1, gid2) of groups of different components that share a shingle, if they may hold a link; few pairs come twice.

    ``sides`` has a row per group and shingle, with the group's size, components
    (``lo`` to ``hi``), parity bits and earlier shingles (``_with_earlier``).
    The groups of a shingle's largest component (``in_main``) are paired with
    the other groups alone, and groups with an earlier shingle in common there.
    """
    some = ("gid", "n", "pos", "rank", "lo", "hi", "in_main", *_PARITY_COLUMNS, *[f"v{c}" for c in _PARITY_COLUMNS])
    apart = ~((F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2")))
    once = (F.col("gid1") != F.col("gid2")) & (F.col("in_main2") | (F.col("gid1") < F.col("gid2")))
    others = F.filter(F.sequence(F.lit(0), "known"), lambda seen: seen.bitwiseAND(F.col("seen")) == 0)
    return (
        sides.filter(~F.col("in_main")).select("token", F.explode(others).alias("seen"), *[F.col(c).alias(f"{c}1") for c in some])
        .join(sides.select("token", "seen", *[F.col(c).alias(f"{c}2") for c in some]), ["token", "seen"])
        .filter(once & apart & _place_fits(percent) & _parity_agreed(percent))
        .select("gid1", "gid2")
    )


def jaccard_components(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Words are lower-cased A-Z; a text with fewer than ``width`` words is one
    shingle, one without words (or null) has an empty set and no links.
    ``component_id`` is the smallest id reachable by links.  Rows that repeat
    an id are one node: links of any of them count.  A null id can't be named
    in a link: such rows have a null ``component_id``.  Other columns are not
    read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = min(SKETCH_BITS[1], max(SKETCH_BITS[0], int(volume // 6 // 64).bit_length()))
    classes = spark.sparkContext.broadcast(frequency_classes(texts.select("text"), width, bits))
    sets = write_stage(
        texts.mapInArrow(
            _prefixes(width, percent, classes), f"doc_id long, n long, sig binary, grp binary, prefix array<long>, {' long, '.join(_PARITY_COLUMNS)} long"
        ),
        "jaccard-sets",
    )
    usable = sets.filter("n > 0 and doc_id is not null")
    # one node per distinct set (its smallest id), one group per prefix and size
    nodes = write_stage(
        usable.groupBy("grp", "sig", "n", *_PARITY_COLUMNS).agg(F.min("doc_id").alias("id"), F.count("*").alias("docs")),
        "jaccard-nodes",
    )
    groups = usable.groupBy("grp", "n").agg(F.min("doc_id").alias("gid"), F.any_value("prefix").alias("prefix"))
    index = write_stage(groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token")), "jaccard-index")
    several = index.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    within = Window.partitionBy("gid").orderBy("pos")  # a prefix at most
    shared = index.join(several, "token", "left_semi").withColumn("rank", F.row_number().over(within) - 1)
    shared = write_stage(shared, "jaccard-shared")
    members = nodes.join(nodes.groupBy("grp").agg(F.min("id").alias("gid"), F.count("*").alias("size")), "grp")
    members = write_stage(members.select("gid", "id", "n", "size", *_PARITY_COLUMNS), "jaccard-members")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = write_stage(pairs.select("a", "b"), "jaccard-pairs")
        ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
        ids = write_stage(ids, "jaccard-ids")
        contents = write_stage(
            texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_contents(width), "id long, shingles array<long>"),
            "jaccard-contents",
        )
        # a set of many pairs is dealt over several places, its partners by hash
        degree = pairs.groupBy("b").agg(F.floor(F.count("*") / HUB_ROWS).alias("more"))
        x = contents.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        y = contents.select(F.col("id").alias("b"), F.col("shingles").alias("y")).join(degree, "b")
        y = y.select("b", "y", F.explode(F.sequence(F.lit(0).cast("long"), "more")).alias("salt"))
        dealt = pairs.join(degree, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("more") + 1).alias("salt"))
        common = F.size(F.array_intersect("x", "y"))
        both = dealt.join(x, "a").join(y, ["b", "salt"]).select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("total"))
        linked = both.filter(F.col("common") * (100 + percent) >= F.col("total") * percent)
        return write_stage(linked.select("a", "b").distinct(), "jaccard-links")

    # first pass: each group with the least group of each shared shingle, each member with its group's first
    least = shared.groupBy("token").agg(F.min("gid").alias("b"))
    second = [F.col(c).alias(f"{c}2") for c in ("n", "pos", "rank")]
    least = least.join(shared.select("token", F.col("gid").alias("b"), *second), ["token", "b"])
    stars = (
        shared.select("token", F.col("gid").alias("a"), *[F.col(c).alias(f"{c}1") for c in ("n", "pos", "rank")])
        .join(least, "token")
        .filter((F.col("a") > F.col("b")) & _place_fits(percent))
        .groupBy("a", "b", "n1", "n2")
        .agg(F.count("*").alias("shared"))
        .filter(_pair_filter(percent))
        .select("a", "b")
    )
    inside = members.filter("id <> gid").select(F.col("id").alias("a"), F.col("gid").alias("b"))
    links = verified(stars.unionByName(inside).distinct())
    roots = write_stage(connected_components(links), "jaccard-roots")

    def placed(roots: DataFrame) -> DataFrame:
        here = members.select("gid", "id", "n").join(roots, "id", "left")
        return write_stage(here.select("gid", "id", "n", F.coalesce("root", "id").alias("root")), "jaccard-placed")

    def mixed_groups(here: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Prefix rows of the shingles whose groups hold several components, and the groups that do themselves."""
        span = here.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        rows = shared.join(span, "gid")
        mixed = rows.groupBy("token").agg(F.min("lo").alias("a"), F.max("hi").alias("b")).filter("a < b").select("token")
        return rows.join(mixed, "token", "left_semi"), span.filter("lo < hi").select("gid")

    def fitting(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose parity bitmaps allow a link."""
        for side, k in (("a", 1), ("b", 2)):
            facts = members.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}{k}") for c in ("n", *_PARITY_COLUMNS)])
            pairs = pairs.join(facts, side)
        return pairs.filter(_parity_fits(percent)).select("a", "b")

    # hub pass
    here = placed(roots)
    prefixes, torn = mixed_groups(here)
    facts = ("id", "n", "root", "pos", "rank")
    # members of one torn group meet at their group; their prefixes are equal, so sizes and parities decide
    whole = here.join(torn, "gid", "left_semi").select(
        F.lit(True).alias("whole"), F.col("gid").alias("token"), "id", "n", "root", F.lit(0).alias("pos"), F.lit(0).alias("rank"))
    rows = prefixes.select("token", "gid", "pos", "rank").join(here, "gid").select(F.lit(False).alias("whole"), "token", *facts)
    rows = write_stage(rows.unionByName(whole), "jaccard-mixed")
    picks = [F.min(F.struct(F.xxhash64("id", F.lit(i)).alias("h"), *facts)).alias(f"hub{i}") for i in range(HUBS)]
    hubs = rows.groupBy("whole", "token").agg(*picks).select("whole", "token", F.explode(F.array(*[f"hub{i}" for i in range(HUBS)])).alias("hub"))
    hubs = hubs.select("whole", "token", *[F.col(f"hub.{c}").alias(f"{c}2") for c in facts]).distinct()
    near = (
        rows.select("whole", "token", *[F.col(c).alias(f"{c}1") for c in facts])
        .join(hubs, ["whole", "token"])
        .filter((F.col("root1") != F.col("root2")) & _place_fits(percent))
        .select(F.greatest("id1", "id2").alias("a"), F.least("id1", "id2").alias("b"))
        .distinct()
    )
    links = links.unionByName(verified(fitting(near)))
    roots = write_stage(connected_components(links), "jaccard-roots")

    # last pass: pairs of groups, then of their members, that still lie in different components
    here = placed(roots)
    prefixes, torn = mixed_groups(here)
    repeated = nodes.groupBy("grp").agg(F.min("id").alias("gid")).groupBy("gid").agg(F.count("*").alias("c")).filter("c > 1").select("gid")
    prefixes = write_stage(_with_earlier(prefixes, repeated), "jaccard-mixed")
    main = prefixes.filter("lo = hi").groupBy("token", "lo").agg(F.count("*").alias("c"))
    main = main.groupBy("token").agg(F.max(F.struct("c", "lo")).alias("m")).select("token", F.col("m.lo").alias("main"))
    sides = prefixes.join(main, "token", "left").withColumn("in_main", F.coalesce((F.col("lo") == F.col("main")) & (F.col("hi") == F.col("main")), F.lit(False)))
    agreed = [F.bit_and(c).alias(c) for c in _PARITY_COLUMNS] + [F.bit_or(c).bitwiseXOR(F.bit_and(c)).alias(f"v{c}") for c in _PARITY_COLUMNS]
    sides = sides.join(members.groupBy("gid").agg(*agreed), "gid")
    group_pairs = _pairs_apart(sides, percent).distinct()
    group_pairs = write_stage(group_pairs.unionByName(torn.select(F.col("gid").alias("gid1"), F.col("gid").alias("gid2"))), "jaccard-groups")
    rest = (
        group_pairs.join(here.select(F.col("gid").alias("gid1"), F.col("id").alias("id1"), F.col("root").alias("root1")), "gid1")
        .join(here.select(F.col("gid").alias("gid2"), F.col("id").alias("id2"), F.col("root").alias("root2")), "gid2")
        .filter((F.col("root1") != F.col("root2")) & ((F.col("gid1") != F.col("gid2")) | (F.col("id1") < F.col("id2"))))
        .select(F.greatest("id1", "id2").alias("a"), F.least("id1", "id2").alias("b"))
        .distinct()
    )
    rest = fitting(rest)
    linked = links.unionByName(verified(rest))
    roots = write_stage(connected_components(linked), "jaccard-roots")

    found = nodes.join(roots, "id").select("sig", F.col("root"))
    alone = nodes.join(roots, "id", "left_anti").filter("docs > 1").select("sig", F.col("id").alias("root"))
    labels = write_stage(found.unionByName(alone), "jaccard-labels")
    # an id may have several sets; its rows take the least of their components
    out = sets.select("doc_id", "n", "sig").join(labels.groupBy("sig").agg(F.min("root").alias("root")), "sig", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document (the smallest id) of each component, all columns kept.

    Rows with a null id stay.
    """
    dropped = write_stage(
        jaccard_components(docs, width, percent, id_col, text_col)
        .filter("component_id <> doc_id")
        .select(F.col("doc_id").alias("__dropped"))
        .distinct(),
        "jaccard-dropped",
    )
    return docs.join(dropped, docs[id_col].cast("long") == dropped["__dropped"], "left_anti")
