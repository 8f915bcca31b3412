"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, one token each, so that a
re-parameterised question has the same template.  Windows of template tokens
hash-join between documents and benchmark items; for the matches, the values
behind the placeholders are compared along each alignment: the same benchmark
value must always stand for the same document value and the other way round.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_stage

WINDOW = 8  # template tokens
COVERAGE = 0.5  # of an item's windows that a document must contain
BROADCAST_WINDOWS = 1 << 20  # benchmark windows (24 MB) broadcast at most; more are shuffled

# fixed values: unit words and signs, matched only right after a number
UNITS = (
    "mm cm m km in inch inches ft feet yd yard yards mile miles mg g kg t ton tons oz lb lbs pound pounds "
    "ml cl l liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years hz khz mhz ghz w kw v a j kj cal kcal k c f usd eur gbp dollar dollars euro euros "
    "cent cents percent pct mph kmh kb mb gb tb"
).split()

SHORTEST_INSIDE = 4  # tokens; an item of fewer is matched by whole texts only

_NAME, _NUMBER, _UNIT = "\u0002", "\u0003", "\u0004"
_CAPITAL, _POINT = "\u0005", "\u0006"  # a capitalised word that is no name by its place; a separator inside a number


def _typed(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with ``__plain`` and ``__typed``: tokens with one space between, the second with numbers and units as placeholders.

    Capitalised words carry a mark in front: a name's after a lower-case letter
    or a comma and one space, so not at a sentence's start, another elsewhere.
    A number keeps its separators in one token, a unit attached to it is the next one.
    Everything else but letters and digits separates tokens.
    """
    units = "|".join(UNITS)
    clean = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\u0002-\u0006]", " ")
    marked = F.regexp_replace(clean, r"([\p{Ll},] )(\p{Lu}\p{Ll})", f"$1{_NAME}$2")
    marked = F.regexp_replace(marked, r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{M}\p{N}" + _NAME + "])", _CAPITAL)
    digits = F.col("__digits")
    marked = F.when(digits, F.regexp_replace(marked, r"[.,'’](?<=\p{N}[.,'’])(?=\p{N})", _POINT)).otherwise(marked)
    plain = F.trim(F.regexp_replace(F.lower(marked), r"[^\p{L}\p{M}\p{N}" + _NAME + _CAPITAL + _POINT + "]+", " "))
    mark = f"(?=\\p{{N}})(?<![^ ])\\p{{N}}[\\p{{N}}{_POINT}]*+"
    typed = F.regexp_replace("__plain", f"{mark}(?: {_CAPITAL}?)?(?:{units})(?![^ ])", f"{_NUMBER} {_UNIT}")
    typed = F.regexp_replace(typed, f"{mark}(?![^ ])", _NUMBER)
    rows = rows.select(*keep, F.col(text).alias("__text"), F.coalesce(F.col(text).rlike(r"\p{N}"), F.lit(False)).alias("__digits"))
    plain = rows.withColumnRenamed("__text", text).select(*keep, "__digits", plain.alias("__plain"))
    return plain.select(*keep, "__digits", "__plain", F.when(digits, typed).otherwise(F.col("__plain")).alias("__typed"))


def _raw() -> Column:
    """Raw tokens of a row of ``_typed``, attached units apart."""
    number = r"(?=\p{N})(?<![^ ])(\p{N}[\p{N}" + _POINT + "]*+)"
    apart = F.regexp_replace("__plain", f"{number}({'|'.join(UNITS)})(?![^ ])", "$1 $2")
    return F.split(F.translate(F.when(F.col("__digits"), apart).otherwise(F.col("__plain")), _NAME + _CAPITAL, ""), " ")


def _bare(shortest: int) -> Column:
    """Whether ``shortest`` placeholders of the named template stand in a row."""
    one = f"(?:[{_NAME}{_CAPITAL}][^ ]+|[{_NUMBER}{_UNIT}])"
    return F.col("__typed").rlike(f"(?<![^ ]){one}(?: {one}){{{shortest - 1}}}(?![^ ])")


def _tokenised(rows: DataFrame, text: str, keep: list[str], shortest: int) -> DataFrame:
    """``keep`` with the aligned token arrays raw, template and named of a text column, and bare.

    In ``template`` a name is a word with the name's mark, in ``named`` any
    capitalised word.
    """
    template = F.regexp_replace(F.replace("__typed", F.lit(_CAPITAL), F.lit("")), f"{_NAME}[^ ]+", _NAME)
    named = F.regexp_replace("__typed", f"[{_NAME}{_CAPITAL}][^ ]+", _NAME)
    return _typed(rows, text, keep).select(
        *keep,
        _raw().alias("raw"),
        F.split(template, " ").alias("template"),
        F.split(named, " ").alias("named"),
        _bare(shortest).alias("bare"),
    )


def _coded(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` with the token arrays as hashes: c0 of the template, c1 of the named one, cr of the raw tokens.

    d0, d1 and dr have a hash for each two tokens in a row, plain0 and plain1 a 1 for
    each placeholder.  Windows read these arrays by position; slices of arrays of
    texts would copy the whole array for each window.
    """
    def hashes(column: str) -> Column:
        return F.transform(column, lambda t: F.xxhash64(t))

    def places(column: str) -> Column:
        return F.transform(column, lambda t: F.when(t.isin(_NAME, _NUMBER, _UNIT), 1).otherwise(0))

    def pairs(column: str) -> Column:
        two = F.transform(F.sequence(F.lit(0), F.size(column) - 2), lambda i: F.xxhash64(F.get(column, i), F.get(column, i + 1)))
        return F.when(F.size(column) >= 2, two)

    empty, differs = F.element_at("template", 1) == "", F.col("named") != F.col("template")
    coded = rows.select(
        *keep, "bare", F.when(empty, 0).otherwise(F.size("template")).alias("size"), differs.alias("differs"),
        hashes("template").alias("c0"), F.when(differs, hashes("named")).alias("c1"), F.when(F.col("bare"), hashes("raw")).alias("cr"),
        F.when(F.col("bare"), places("template")).alias("plain0"), F.when(F.col("bare"), places("named")).alias("plain1"))
    return coded.select("*", *[pairs(f"c{k}").alias(f"d{k}") for k in ("0", "1", "r")])


def _at(k: str, i: Column, width: int) -> list[Column]:
    """Hashes that make up the window at ``i``: of two tokens each, and of a last single one."""
    return [*(F.get(f"d{k}", i + 2 * j) for j in range(width // 2)), *([F.get(f"c{k}", i + width - 1)] if width % 2 else [])]


def _windows(k: int, width: int, everywhere: bool = True) -> Column:
    """Array of the hashes of all windows of template ``k`` in a row of ``_coded``, none in a shorter or empty text.

    Windows of placeholders alone have the hash of the raw values.
    """
    size = F.col("size")
    fits = (size >= width) if everywhere else (size == width)
    at = F.sequence(F.lit(0), size - width)
    hashes = F.transform(at, lambda i: F.xxhash64(*_at(str(k), i, width)))

    def one(i: Column) -> Column:
        bare = sum((F.get(f"plain{k}", i + j) for j in range(width)), F.lit(0)) == width
        return F.when(bare, F.xxhash64(*_at("r", i, width), F.lit(1))).otherwise(F.xxhash64(*_at(str(k), i, width)))

    found = F.when(F.col("bare"), F.transform(at, one)).otherwise(hashes)
    return F.when((size > 0) & fits, found).otherwise(F.array().cast("array<bigint>"))


def _by_width(k: int, widths: range) -> Column:
    """Windows of the row's own width ``wd``."""
    out = F.array().cast("array<bigint>")
    for width in widths:
        out = F.when(F.col("wd") == width, _windows(k, width)).otherwise(out)
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WINDOW,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, item_windows, matched, exact, coverage) of every leaked item.

    ``matched`` counts the item's distinct windows that the document has at one
    alignment or several with consistent slots, ``exact`` those with the same
    values too.  A slot is consistent when one benchmark value stands for one
    document value; windows that hold another do not count.  Names are typed
    by their place in the sentence, and once more as any capitalised word;
    the figures of a leak are those of the first typing where it suffices.
    Windows of only placeholders match by equal values.  ``coverage`` is the
    share of all windows or, if greater, of those with words.  An item of fewer
    tokens than a window is one shorter window, looked for in all texts; below
    ``SHORTEST_INSIDE`` tokens, in texts of the same length only.  Empty and
    null texts match nothing.  Rows that repeat an id are one document (or
    item): their windows count together, equal ones once.
    Items and documents with a null id are left out (no result could name them).  Empty tables give no rows.
    """
    items = _tokenised(
        benchmark.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")),
        "text", ["item_id"], 1,
    )
    items = items.withColumn("wd", F.least(F.size("template"), F.lit(width)))
    none = F.array().cast("array<bigint>")
    every = range(1, width + 1)
    coded = _coded(items, ["item_id", "wd", "raw", "template", "named"])
    coded = coded.withColumn("w0", _by_width(0, every)).withColumn("w1", F.when(F.col("differs"), _by_width(1, every)).otherwise(none))
    items = write_stage(coded.select("item_id", "wd", "raw", "template", "named", "w0", "w1"), "leak-items")
    worded = F.transform("w0", lambda h, j: F.exists(F.slice("template", j + 1, F.col("wd")), lambda t: ~t.isin(_NAME, _NUMBER, _UNIT)))
    rows = items.select("item_id", "wd", F.size("w0").alias("item_windows"), worded.alias("worded"), F.explode(
        F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"w{k}").alias("w")) for k in (0, 1)))).alias("g"))
    rows = rows.withColumn("item_worded", F.size(F.filter("worded", lambda x: x)))
    known = rows.select("item_id", "wd", "item_windows", "item_worded", "worded", "g.k", F.posexplode("g.w").alias("j", "h"))
    known = write_stage(known.withColumn("worded", F.col("worded")[F.col("j")]), "leak-windows")
    widths = sorted(r["wd"] for r in known.select("wd").distinct().collect())  # at most ``width`` values
    if not widths:
        widths = [width]
    hashes = known.select("h").distinct()
    few = known.count() <= BROADCAST_WINDOWS
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def cut(k: int, wd: int) -> Column:
        return _windows(k, wd, wd >= min(SHORTEST_INSIDE, width))

    places = _coded(_tokenised(texts, "text", ["doc_id"], widths[0]), ["doc_id"])
    plain = [f"p{wd}" for wd in widths]
    places = places.select("*", *(cut(0, wd).alias(f"p{wd}") for wd in widths))
    # of the second template, only the windows that it changes
    changed = [F.when(F.col("differs"), F.zip_with(f"p{wd}", cut(1, wd), lambda a, b: F.when(a != b, b))).otherwise(none) for wd in widths]
    places = places.select("doc_id", F.explode(F.concat(*plain, *changed)).alias("h"))
    # which documents share any window at all: one row per document and hash
    touched = places.join(F.broadcast(hashes) if few else hashes, "h", "left_semi").distinct()
    # distinct windows per item and document, whatever their slots: an upper bound of what can match
    enough = (F.col("n") >= F.col("item_windows") * coverage) | (
        (F.col("item_worded") > 0) & (F.col("n_worded") >= F.col("item_worded") * coverage)
    )
    bound = (
        write_stage(touched, "leak-touched")
        .join(known.select("h", "item_id", "item_windows", "item_worded", "worded", "j").distinct(), "h")
        .groupBy("doc_id", "item_id", "item_windows", "item_worded", "j")
        .agg(F.max("worded").alias("worded"))
        .groupBy("doc_id", "item_id", "item_windows", "item_worded")
        .agg(F.count("*").alias("n"), F.count(F.when(F.col("worded"), 1)).alias("n_worded"))
        .filter(enough)
        .select("doc_id", "item_id", "item_windows", "item_worded")
    )
    bound = write_stage(bound, "leak-candidates")
    # slots: only candidate documents are read again; windows are cut out of their arrays at matched places only
    chosen = write_stage(bound.select("doc_id").distinct(), "leak-documents")
    read = _tokenised(texts.join(chosen, "doc_id", "left_semi"), "text", ["doc_id"], widths[0])
    read = _coded(read, ["doc_id", "raw", "template", "named"]).withColumns({f"{c}1": F.coalesce(f"{c}1", f"{c}0") for c in "cd"})
    groups = [F.struct(F.lit(k).alias("k"), F.lit(wd).alias("wd"), cut(k, wd).alias("w")) for wd in widths for k in (0, 1)]
    read = write_stage(read.select("doc_id", "raw", "template", "named", F.array(*groups).alias("groups")), "leak-read")
    matches = (
        read.select("doc_id", F.explode("groups").alias("g"))
        .select("doc_id", "g.k", "g.wd", F.posexplode("g.w").alias("i", "h"))
        .join(known.select("h", "k", "wd", "item_id", "j", "worded"), ["h", "k", "wd"])
        .join(bound, ["doc_id", "item_id"])
        .select("doc_id", "item_id", "item_windows", "item_worded", "k", "wd", "i", "j", "worded")
    )
    matches = write_stage(matches.distinct(), "leak-matches")
    at = F.collect_set(F.struct("k", "wd", "i")).alias("at")
    found = read.join(matches.groupBy("doc_id").agg(at), "doc_id").select(
        "doc_id",
        F.explode(
            F.transform(
                "at",
                lambda m: F.struct(
                    m["k"].alias("k"),
                    m["wd"].alias("wd"),
                    m["i"].alias("i"),
                    F.slice("raw", m["i"] + 1, m["wd"]).alias("dv"),
                    F.slice(F.when(m["k"] == 1, F.col("named")).otherwise(F.col("template")), m["i"] + 1, m["wd"]).alias("tv"),
                ),
            )
        ).alias("m"),
    )
    last = F.greatest(F.size("template") - F.col("wd"), F.lit(0))
    values = items.select(
        "item_id",
        F.explode(
            F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(j.alias("j"), F.slice("raw", j + 1, F.col("wd")).alias("bv")))
        ).alias("m"),
    ).select("item_id", "m.j", "m.bv")
    place = ["doc_id", "item_id", "k", "shift"]
    pairs = (
        matches.join(found.select("doc_id", "m.k", "m.wd", "m.i", "m.dv", "m.tv"), ["doc_id", "k", "wd", "i"])
        .join(values, ["item_id", "j"])
        .withColumn("shift", F.col("i") - F.col("j"))
        .withColumn("same", F.col("dv") == F.col("bv"))
    )
    pairs = write_stage(pairs.select(*place, "item_windows", "item_worded", "j", "worded", "same", "dv", "bv", "tv"), "leak-pairs")
    slots = (
        pairs.select(*place, "j", F.explode(F.arrays_zip("dv", "bv", "tv")).alias("s"))
        .filter(F.col("s.tv").isin(_NAME, _NUMBER))
        .select(*place, "j", F.col("s.tv").alias("kind"), F.col("s.dv").alias("dv"), F.col("s.bv").alias("bv"))
    )
    # a benchmark value that stands for two others voids the windows of its alignment that hold it
    clashes = slots.groupBy(*place, "kind", "bv").agg(F.min("dv").alias("a"), F.max("dv").alias("b")).filter("a <> b")
    torn = slots.join(clashes.select(*place, "kind", "bv"), [*place, "kind", "bv"], "left_semi").select(*place, "j").distinct()
    held = pairs.join(torn.withColumn("torn", F.lit(True)), [*place, "j"], "left").filter(F.col("torn").isNull() | F.col("same"))
    # the figures are the first template's where it alone names the leak, else those of both
    held = held.groupBy("doc_id", "item_id", "item_windows", "item_worded", "j").agg(
        F.max("same").alias("same"),
        F.max("worded").alias("worded"),
        F.max(F.col("k") == 0).alias("strict"),
        F.max((F.col("k") == 0) & F.col("same")).alias("strict_same"),
    )

    def share(matched: str, worded: str) -> Column:
        of_worded = F.when(F.col("item_worded") > 0, F.col(worded) / F.col("item_worded"))
        return F.greatest(F.col(matched) / F.col("item_windows"), of_worded)

    def count(*flags: str) -> Column:
        return F.count(F.when(F.forall(F.array(*flags), lambda x: x), 1))

    alone = F.col("strict_share") >= coverage
    return (
        held.groupBy("doc_id", "item_id", "item_windows", "item_worded")
        .agg(
            F.count("*").alias("all"), count("same").alias("all_same"), count("worded").alias("all_worded"),
            count("strict").alias("strict"), count("strict_same").alias("strict_same"), count("strict", "worded").alias("strict_worded"),
        )
        .withColumn("strict_share", share("strict", "strict_worded"))
        .select(
            "doc_id", "item_id", F.col("item_windows").cast("long").alias("item_windows"),
            F.when(alone, F.col("strict")).otherwise(F.col("all")).alias("matched"),
            F.when(alone, F.col("strict_same")).otherwise(F.col("all_same")).alias("exact"),
            F.when(alone, F.col("strict_share")).otherwise(share("all", "all_worded")).alias("coverage"),
        )
        .filter(F.col("coverage") >= coverage)
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that :func:`find_leaks` names, all columns kept."""
    id_col = options.get("id_col", "doc_id")
    leaked = write_stage(
        find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("__leaked")).distinct(), "leak-dropped"
    )
    return docs.join(leaked, docs[id_col] == leaked["__leaked"], "left_anti")
