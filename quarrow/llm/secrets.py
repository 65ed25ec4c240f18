"""Secret scans with corpus-wide ownership frequency, in built-in functions only.

Patterns give candidate spans. Every candidate's value is hashed, and hashes are
aggregated by distinct repositories and owners over the whole corpus: a value
that many owners share is a copied example, one that a single owner has looks
live. Base spans are always reported; spans of the wider patterns are added
where ownership does not say that they are copied examples.

Positions come from the texts between matches: a match starts after all earlier
matches and all gaps up to it, which is a running sum per document and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# The base kinds' patterns, with the group that holds the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Formats of issued keys, and long strings that mix cases and digits.
ISSUED = r"gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{32,}"

#: Kind, pattern, group of the value, least length of the value, base.
KINDS = (
    ("assign", ASSIGN, 2, 6, True),
    ("access", ACCESS, 0, 20, True),
    ("hex", HEX, 0, 24, True),
    ("issued", ISSUED, 0, 1, False),
    ("opaque", OPAQUE, 0, 32, False),
)
#: From so many owners on a value is a copied example.
EXAMPLE_OWNERS = 3


def _candidate(kind: int, least: int):
    """The row of a candidate, from its match, value and gap."""

    def row(m: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            m["n"].alias("n"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["match"]).alias("length"),
            (F.length(m["value"]) >= least).alias("good"),
            F.xxhash64(m["value"]).alias("value"),
        )

    return row


def _candidates(text: Column) -> Column:
    """All matches of all kinds: kind, number, gap before, length, whether it holds, hash."""
    kinds = []
    for k, (_, pattern, group, least, _) in enumerate(KINDS):
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        numbers = F.sequence(F.lit(1), F.size(matches))
        rows = F.arrays_zip(numbers.alias("n"), matches.alias("match"), values.alias("value"), gaps.alias("gap"))
        kinds.append(F.when(text.rlike(pattern), F.transform(rows, _candidate(k, least))))
    empty = F.array().cast("array<struct<kind:int,n:int,gap:int,length:int,good:boolean,value:bigint>>")
    return F.flatten(F.array(*[F.coalesce(kind, empty) for kind in kinds]))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``(id_col, spans)`` with one row per input row.

    ``spans`` is an array of ``(start, kind_order, kind, end, base, value,
    owners, repositories, verdict)`` ordered by start, then kind; offsets in code
    points, ends exclusive; ``value`` is the hash of the candidate's value;
    ``verdict`` is ``live`` (one owner), ``shared`` (fewer than ``EXAMPLE_OWNERS``)
    or ``example``. Null and empty texts have no spans; a null owner is an owner
    of its own. Repeated rows stay repeated and count once for ownership.
    """
    owner = F.coalesce(F.concat(F.lit("0"), F.col(owner_col).cast("string")), F.lit("1"))
    repository = F.xxhash64(*[F.col(c).isNull() for c in repository_cols], *[F.col(c) for c in repository_cols])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(
        df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), owner.alias("owner"), repository.alias("repository"), _candidates(text).alias("found")),
        "secret-candidates",
    )
    end = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    spans = (
        rows.where(F.size("found") > 0)
        .select("row", F.inline("found"))
        .select("row", "kind", "value", "good", "length", end.alias("end"))
        .where("good")
        .select("row", (F.col("end") - F.col("length")).alias("start"), "kind", "end", "value")
    )
    owned = (
        rows.where(F.size("found") > 0)
        .select("owner", "repository", F.inline("found"))
        .where("good")
        .groupBy("value", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("value")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    owned = written(owned, "secret-owners")
    verdict = F.when(F.col("owners") == 1, "live").when(F.col("owners") < EXAMPLE_OWNERS, "shared").otherwise("example")
    name = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("kind") + 1)
    base = F.col("kind") < sum(k[4] for k in KINDS)
    judged = (
        spans.join(owned, "value")
        .withColumn("verdict", verdict)
        .where(base | (F.col("verdict") != "example"))
        .select("row", F.struct("start", F.col("kind").alias("kind_order"), name.alias("kind"), "end", base.alias("base"), "value", "owners", "repositories", "verdict").alias("span"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )
    none = F.array().cast(judged.schema["spans"].dataType)
    return rows.select("row", "id").join(judged, "row", "left").select(F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(df: DataFrame) -> DataFrame:
    """Counts and digest of base spans, and all spans, of every document."""
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return scan(df).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter(spans, lambda s: s["verdict"] == "example")).cast("long").alias("n_example"),
    )
