"""Document fingerprints: invertible Bloom lookup sketches, in built-in functions only.

A text's paragraphs (lines, and sentences within lines) are hashed to digests.
Every digest enters one cell in each of three sub-tables; a cell holds a count,
the exclusive-or of its digests and that of their check hashes. Sketches of two
versions subtract cell by cell. Peeling then takes digests out of cells that
hold exactly one, sub-table after sub-table, until nothing is left: the digests
recovered are exactly those in which the versions differ. Where something is
left, the sketch was too small, and a larger one with other hashes is tried.

Cells are rows ``(row, pair, cell)``. All steps of a comparison group by the
document's row, so they share one exchange and each is a hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Ends of paragraphs.
PARAGRAPH = r"\n+|(?<=[.!?])\x20+"
#: Cells in each of the three sub-tables of a document's own fingerprint.
BASE_CELLS = 8
#: Passes over the three sub-tables while peeling.
BASE_PASSES, PASSES = 2, 4
#: Larger sketches tried after the first; each doubles, so the last one has over
#: a hundred cells for every digest.
RETRIES = 6


def digests(text: Column) -> Column:
    """The set of a text's paragraph digests; an empty text has none."""
    parts = F.filter(F.split(text, PARAGRAPH), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _bounds(df: DataFrame, ids: Column) -> list[int]:
    """Ids that exist and cut the ids in about as many ranges as there are shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.agg(F.percentile_approx(ids, [k / n for k in range(1, n + 1)]).alias("cuts"), F.max(ids).alias("top")).first()
    return sorted({*(found["cuts"] or []), found["top"]} - {None})


def _range(ids: Column, bounds: list[int]) -> Column:
    """The number of bounds below an id, by binary search; 0 for null."""
    if not bounds:
        return F.lit(0)
    line = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def step(place: Column, by: Column) -> Column:
        return F.when(F.coalesce(F.get(line, place + by - 1) < ids, F.lit(False)), place + by).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, next)``: each text with that of the next document, descending id.

    After the last document comes the first. Equal ids follow one another by
    text; null ids come last. Texts move once, to ranges of ids; the first
    document of a range also goes, as a look-ahead, to the range before it in
    that order. Ranges hold about as many ids each; documents of one id, and those of
    null ids, share a range.
    """
    ids = F.col(id_col).cast("long")
    bounds = _bounds(df, ids)
    place = _range(ids, bounds)
    rows = df.select(F.col(id_col).alias("id"), ids.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), place.alias("range"))
    if len(bounds) > 1:
        line = F.array(*[F.lit(b).cast("long") for b in bounds])
        ahead = F.get(line, F.col("range")) == F.col("key")
        targets = F.when(ahead, F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("ahead")), F.struct(((F.col("range") + 1) % len(bounds)).alias("range"), F.lit(1).alias("ahead"))))
        targets = F.coalesce(targets, F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("ahead"))))
        rows = rows.select("id", "key", "text", F.inline(targets))
    else:
        rows = rows.withColumn("ahead", F.lit(0))
    order = Window.partitionBy("range").orderBy("ahead", F.desc_nulls_last("key"), "text")
    following = F.lead("text").over(order)
    if len(bounds) < 2:
        following = F.coalesce(following, F.first("text").over(order))
    return rows.withColumn("next", following).where("ahead = 0").select("id", "text", "next")


def _cells(seed: int, size: Column, digest: Column) -> Column:
    """A digest's cells, one in each sub-table of ``size`` (a power of two) cells."""
    return F.array(*[(F.xxhash64(digest, F.lit(3 * seed + k)).bitwiseAND(size - 1) + k * size) for k in range(3)])


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _power(n: Column) -> Column:
    """The least power of two that is not below ``n``."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double")))).cast("long")


SUMS = (F.sum, F.bit_xor, F.bit_xor, F.sum, F.sum)
STATE = ("count", "ids", "checks", "plus", "minus")


def _summed(cells: DataFrame) -> DataFrame:
    """Cells added up, without those that have become empty."""
    return (
        cells.groupBy("row", "pair", "size", "cell")
        .agg(*[f(c).alias(c) for f, c in zip(SUMS, STATE, strict=True)])
        .where((F.col("cell") < 0) | (F.col("count") != 0) | (F.col("ids") != 0) | (F.col("checks") != 0))
    )


def _peeled(cells: DataFrame, seed: int, passes: int) -> DataFrame:
    """Take out what single cells hold, one sub-table at a time.

    A digest has one cell in each sub-table, so no round takes it out twice.
    What is recovered is counted in cell -1.
    """
    zero = F.lit(0).cast("long")
    for step in range(3 * passes):
        own = F.struct("cell", *STATE)
        single = (F.floor(F.col("cell") / F.col("size")) == step % 3) & (F.abs("count") == 1) & (_check(F.col("ids")) == F.col("checks"))
        out = [
            F.struct(F.element_at(_cells(seed, F.col("size"), F.col("ids")), k + 1).alias("cell"), (-F.col("count")).alias("count"), "ids", "checks", zero.alias("plus"), zero.alias("minus"))
            for k in range(3)
        ]
        told = F.struct(
            F.lit(-1).cast("long").alias("cell"), zero.alias("count"), zero.alias("ids"), zero.alias("checks"),
            (F.col("count") == 1).cast("long").alias("plus"), (F.col("count") == -1).cast("long").alias("minus"),
        )
        cells = _summed(cells.select("row", "pair", "size", F.inline(F.when((F.col("cell") >= 0) & single, F.array(own, *out, told)).otherwise(F.array(own)))))
    return cells


def _entries(narrow: DataFrame, seed: int, sizes: list[Column]) -> DataFrame:
    """One row per digest and cell of both comparisons, signed: own text plus, other minus."""
    sides = []
    for pair, (other, size) in enumerate(zip(("edited", "next"), sizes, strict=True)):
        for column, sign in (("own", 1), (other, -1)):
            sides.append(F.transform(column, _entry(pair, sign, size)))
    rows = narrow.select("row", F.inline(F.flatten(F.array(*sides))))
    zero = F.lit(0).cast("long")
    return rows.select("row", "pair", "size", F.explode(_cells(seed, F.col("size"), F.col("ids"))).alias("cell"), "count", "ids", _check(F.col("ids")).alias("checks"), zero.alias("plus"), zero.alias("minus"))


def _entry(pair: int, sign: int, size: Column):
    def row(digest: Column) -> Column:
        return F.struct(F.lit(pair).alias("pair"), size.cast("long").alias("size"), F.lit(sign).cast("long").alias("count"), digest.alias("ids"))

    return row


def _compared(narrow: DataFrame, seed: int, sizes: list[Column], passes: int) -> DataFrame:
    """``(row, pair, left, plus, minus)``: cells left over, digests recovered of either side.

    Pairs in which every cell cancels have no row.
    """
    left = F.sum((F.col("cell") >= 0).cast("long")).alias("left")
    return _peeled(_summed(_entries(narrow, seed, sizes)), seed, passes).groupBy("row", "pair").agg(left, F.sum("plus").alias("plus"), F.sum("minus").alias("minus"))


def _tables(narrow: DataFrame) -> DataFrame:
    """``(row, own_cells, edited_cells)``: base sketches of both texts as strings."""
    sides = [F.transform(c, _entry(k, 1, F.lit(BASE_CELLS))) for k, c in enumerate(("own", "edited"))]
    rows = narrow.select("row", F.inline(F.flatten(F.array(*sides))))
    rows = rows.select("row", "pair", F.explode(_cells(0, F.col("size"), F.col("ids"))).alias("cell"), "count", "ids", _check(F.col("ids")).alias("checks"))
    cells = rows.groupBy("row", "pair", "cell").agg(F.sum("count").alias("count"), F.bit_xor("ids").alias("ids"), F.bit_xor("checks").alias("checks"))
    told = F.concat_ws(":", F.col("cell"), F.col("count"), F.lower(F.hex("ids")), F.lower(F.hex("checks")))
    lists = cells.groupBy("row").agg(*[F.array_sort(F.collect_list(F.when(F.col("pair") == k, F.struct("cell", told.alias("told"))))).alias(c) for k, c in enumerate(("own_cells", "edited_cells"))])
    return lists.select("row", *[F.array_join(f"{c}.told", ";").alias(c) for c in ("own_cells", "edited_cells")])


def versions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, n_chars, edited_sha256, own, edited, next)``, written: digests of
    every text, of its edited text and of the next document's text.

    The edited text has its last floor(n_chars/2) code points replaced by the
    first as many (or all) of the next text.
    """
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("left(next, cast(floor(length(text) / 2) as int))"))
    rows = with_next(df, id_col, text_col).select("id", "text", "next", edited.alias("edit"))
    return written(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "id", F.length("text").cast("long").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"), digests(F.col("edit")).alias("edited"), digests(F.col("next")).alias("next"),
        ),
        "fingerprint-digests",
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    ``fingerprint`` lists the base sketch's cells as ``cell:count:digests:checks``;
    equal texts have equal ones, an empty text has the empty one. Likeness is the
    share of common digests among all, from the numbers that peeling recovers; two
    texts without paragraphs are alike (1.0). Null texts are empty ones. Repeated
    rows stay repeated; one document alone is its own next; an empty table gives an
    empty result. A very long text is one row of digests, eight bytes a paragraph.
    """
    narrow = versions(df, id_col, text_col)
    sizes = [F.lit(BASE_CELLS), F.lit(BASE_CELLS)]
    results, waiting = [], narrow
    for attempt in range(RETRIES + 1):
        found = written(_compared(waiting.repartition("row"), attempt, sizes, PASSES if attempt else BASE_PASSES), "fingerprint-pairs")
        results.append((found.where("left = 0") if attempt < RETRIES else found).select("row", "pair", "left", "plus", "minus"))
        again = found.where("left > 0").groupBy("row").agg(*[F.max(F.col("pair") == k).alias(f"again{k}") for k in (0, 1)])
        if attempt == RETRIES or again.isEmpty():
            break
        kept = narrow.join(again, "row")
        waiting = kept.select("row", "own", F.when(F.col("again0"), F.col("edited")).otherwise(F.col("own")).alias("edited"), F.when(F.col("again1"), F.col("next")).otherwise(F.col("own")).alias("next"))
        both = [F.size("own") + F.size(c) for c in ("edited", "next")]
        sizes = [_power(F.ceil(n * (1 << attempt) / 2)) for n in both]
    pairs = results[0]
    for more in results[1:]:
        pairs = pairs.unionByName(more)
    wide = pairs.groupBy("row").agg(*[F.sum(F.when(F.col("pair") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("left", "plus", "minus")])
    likeness = []
    for k, other in enumerate(("edited", "next")):
        plus, minus = F.coalesce(f"plus{k}", F.lit(0)), F.coalesce(f"minus{k}", F.lit(0))
        union = F.size("own") + minus
        exact = F.size(F.array_intersect("own", other)) / F.size(F.array_union("own", other))
        near = F.when(F.coalesce(f"left{k}", F.lit(0)) > 0, exact).when(union == 0, F.lit(1.0)).otherwise((F.size("own") - plus) / union)
        likeness.append(near.cast("double").alias(f"near_{other}"))
    return (
        narrow.join(_tables(narrow.repartition("row")), "row", "left")
        .join(wide, "row", "left")
        .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.coalesce("own_cells", F.lit("")).alias("fingerprint"), F.coalesce("edited_cells", F.lit("")).alias("edited_fingerprint"), *likeness)
    )
