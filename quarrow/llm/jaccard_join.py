"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents of one shingle set are one node. Sets that share too few shingles with
any other, over all documents, drop out first (:mod:`.liveness`). The others'
shingles are put in a global order, rare ones first, by exact counts. Two sets
that are similar enough share at least l shingles within prefixes that are l - 1
longer than the shortest sound ones; every node chooses the l for which the
estimated cost of its candidates is least, and a pair has to share the smaller
of both numbers before its sets are compared.

Only components are asked for, so pairs within a component already known are
never compared: rounds compare every node of a prefix shingle with one hub, and
join what is similar, until the pairs that remain between components are few;
then all of those are compared. Index rows of shingles whose nodes are all in one
component go after each round. No link between components is lost, and a group
of thousands of near copies costs a few comparisons for each member.

Very long texts are cut into words a segment at a time; what is held whole is
one document's set, eight bytes for each shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, dropped, id_and_text, quoted, written
from .liveness import marks, sets_that_share
from .words import SEGMENT, distinct, mixed, shingles, word_hashes

#: Marks of sets that may have a similar one; of fixed size. Where it fills up, it
#: lets sets through that are then dropped by a join.
MARKS = 1 << 23
#: Most shared prefix shingles that a node may ask for.
MOST_MATCHES = 6
#: Cost of comparing two sets, for each shingle, in units of one index entry.
COMPARE = 1 / 16
#: Words of 64 bits in a set's signature.
WORDS = 8
#: Star rounds at most, and remaining pairs for each index entry that end them; so
#: does a round that leaves more than half of the pairs.
ROUNDS, PAIRS_LEFT = 6, 4


class Similarity:
    """Sizes and overlaps at a threshold, in exact arithmetic."""

    def __init__(self, threshold: Fraction, width: int):
        self.threshold, self.width = threshold, width
        self.num, self.den = threshold.numerator, threshold.denominator

    def least_overlap(self, size: np.ndarray) -> np.ndarray:
        """Shingles that a set of this size shares with any set similar to it."""
        return -(-size * self.num // self.den)

    def sizes_fit(self, a: str, b: str) -> Column:
        """Whether sets of these sizes can be similar."""
        return (F.col(a) * self.den >= F.col(b) * self.num) & (F.col(b) * self.den >= F.col(a) * self.num)

    def need(self, a: str, b: str) -> Column:
        """Shingles that sets of these sizes share if they are similar."""
        return F.expr(f"(({a} + {b}) * {self.num} + {self.num + self.den - 1}) div {self.num + self.den}")

    def slack(self, a: str, b: str, pa: str, pb: str) -> Column:
        """Shingles that sets of these sizes have from a shared one on, at these places, beyond the overlap they need.

        Below zero, so many shared shingles have to lie before it.
        """
        return (F.least(F.col(a) - F.col(pa), F.col(b) - F.col(pb)) - self.need(a, b)).cast("int")


def _sets(block: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*shingles(*word_hashes(block.column(1)), width))


def _hashes(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each set, which stand for it."""
    out = []
    for salt in (0x51, 0xA7):
        line = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h + np.uint64(salt)))])
        out.append(mixed(line[first[1:]] - line[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
    return out


def _signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bits at places that a set's shingles say: two signatures differ in no more bits than the sets in shingles."""
    out = np.zeros((len(first) - 1, WORDS), np.uint64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    np.bitwise_or.at(out, (owner, (h >> np.uint64(6)).astype(np.int64) % WORDS), np.uint64(1) << (h & np.uint64(63)))
    return out.view(np.int64)


def _candidates(data: DataFrame, like: Similarity) -> DataFrame:
    """``(f1, f2)`` of the sets that share enough shingles with others, over all rows of ``data``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for block in blocks(batches, limit=SEGMENT):
            h, first = _sets(block, like.width)
            yield h, first, _hashes(h, first)

    n_bytes = data.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return written(sets_that_share(data, sets, like.least_overlap, n_bytes).distinct(), "join-candidates")


def _rows(data: DataFrame, width: int, marked: np.ndarray) -> DataFrame:
    """``(id, size, f1, f2, task, shingles, bits)`` of every row; f1 and f2 stand for the set.

    ``shingles`` and their signature are there for marked sets, once in a task each.
    """
    shared = data.sparkSession.sparkContext.broadcast(marked)  # MARKS bits, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), set()
        for block in blocks(batches, limit=SEGMENT):
            h, first = _sets(block, width)
            sizes = np.diff(first)
            f1, f2 = _hashes(h, first)
            at = f1 % MARKS
            wanted = (shared.value[at >> 3] >> (at & 7) & 1).astype(bool) & (sizes > 0)
            for k in np.flatnonzero(wanted).tolist():
                key = (f1[k], f2[k])
                wanted[k] = key not in seen
                seen.add(key)
            ends = np.concatenate([[0], np.cumsum(np.where(wanted, sizes, 0))]).astype(np.int32)
            kept = h[np.repeat(wanted, sizes)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(kept.view(np.int64)), mask=pa.array(~wanted))
            places = np.concatenate([[0], np.cumsum(np.where(wanted, WORDS, 0))]).astype(np.int32)
            bits = _signatures(kept, np.concatenate([[0], np.cumsum(sizes[wanted])]))
            signed = pa.ListArray.from_arrays(pa.array(places), pa.array(bits.ravel()), mask=pa.array(~wanted))
            columns = [block.column(0), pa.array(sizes), pa.array(f1, mask=sizes == 0), pa.array(f2, mask=sizes == 0), pa.array(np.full(len(sizes), task, np.int32)), lists, signed]
            yield pa.record_batch(columns, names=["id", "size", "f1", "f2", "task", "shingles", "bits"])

    return data.mapInArrow(run, f"id {data.schema['id'].dataType.simpleString()}, size long, f1 long, f2 long, task int, shingles array<long>, bits array<long>")


def _index(sets: DataFrame, like: Similarity) -> DataFrame:
    """``(node, size, matches, common, place, rank, token)``: prefixes of ``sets (node, size, shingles)``, by exact counts.

    ``place`` counts from the set's rarest shingle on; those that no other node
    has come first and need no row. ``rank`` counts the rows of the node, and
    ``common`` is their number.
    """
    spread = sets.select("node", F.col("size").cast("int").alias("size"), F.explode("shingles").alias("token"))
    counts = spread.groupBy("token").agg(F.count("*").cast("int").alias("held")).where("held > 1")
    shared = spread.join(counts, "token").groupBy("node").agg(F.first("size").alias("size"), F.collect_list(F.struct("held", "token")).alias("shared"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, lists = [batch.column(k) for k in range(3)]
            flat = lists.flatten()
            held, token = [flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            at, places, matches = _prefixes(held, token, lengths, size.to_numpy().astype(np.int64), like)
            owner = np.repeat(np.arange(len(lengths)), lengths)[at]
            alone = size.to_numpy() - lengths
            common = np.bincount(owner, minlength=len(lengths))
            columns = [node.take(pa.array(owner)), size.take(pa.array(owner)), pa.array(matches[owner].astype(np.int16)), *[pa.array(c.astype(np.int32)) for c in (common[owner], places, places - alone[owner])], pa.array(token[at])]
            yield pa.record_batch(columns, names=["node", "size", "matches", "common", "place", "rank", "token"])

    return shared.mapInArrow(run, "node long, size int, matches short, common int, place int, rank int, token long")


def _prefixes(held: np.ndarray, token: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, like: Similarity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which shared shingles are in their sets' prefixes, their places, and the matches that each set asks for.

    ``lengths``: how many of ``held`` (counts) and ``token`` are each set's.
    """
    first = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((token, held, owner))
    sums = np.concatenate([[0.0], np.cumsum(held[order].astype(np.float64))])
    alone, least = sizes - lengths, like.least_overlap(sizes)
    best = np.full(len(sizes), np.inf)
    matches = np.ones(len(sizes), dtype=np.int64)
    for asked in range(1, MOST_MATCHES + 1):
        inside = np.clip(sizes - least + asked - alone, 0, lengths)
        estimate = np.where(least >= asked, (sums[first[:-1] + inside] - sums[first[:-1]]) * (1 + COMPARE * sizes / asked), np.inf)
        better = estimate < best
        best[better], matches[better] = estimate[better], asked
    place = np.arange(len(order)) - np.repeat(first[:-1], lengths) + alone[owner]
    inside = (place < (sizes - least + matches)[owner]) & (lengths >= least)[owner]
    return order[inside], place[inside], matches


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: the least node it reaches.

    Every node points to its least neighbour, pointers are followed to their
    ends, and edges between different ends make the next, smaller graph.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    graph, known = written(both, "graph"), None
    while not graph.isEmpty():
        pointer = written(graph.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "pointers", release=False)
        while True:
            on = pointer.select(F.col("a").alias("root"), F.col("root").alias("next"))
            jumped = written(pointer.join(on, "root", "left").select("a", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")), "pointers", release=False)
            moved = not jumped.where("moved").isEmpty()
            dropped(pointer)
            pointer = jumped.select("a", "root")
            if not moved:
                break
        a, b = pointer.select("a", F.col("root").alias("ra")), pointer.select(F.col("a").alias("b"), F.col("root").alias("rb"))
        smaller = written(graph.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "graph", release=False)
        dropped(graph)
        graph = smaller
        if known is None:
            known = pointer.select(F.col("a").alias("node"), "root")
        else:
            on = pointer.select(F.col("a").alias("root"), F.col("root").alias("next"))
            known = written(known.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots", release=False)
    return known if known is not None else both.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _relabelled(labels: DataFrame, roots: DataFrame) -> DataFrame:
    on = roots.select(F.col("node").alias("component"), "root")
    moved = labels.join(on, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return written(moved, "labels", release=False)


def _similar(pairs: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Those pairs ``(a, b)`` whose whole sets are similar enough, written.

    Only the sets of nodes in pairs move; where those are few, no other is even shuffled.
    """
    nodes = written(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "join-needed", release=False)
    chosen = written(sets.select("node", "shingles").join(nodes, "node"), "join-chosen", release=False)
    a, b = chosen.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), chosen.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    found = written(pairs.join(b, "b").join(a, "a").where(both * like.den >= union * like.num).select("a", "b"), "join-edges")
    dropped(nodes)
    dropped(chosen)
    return found


def _asked(pairs: DataFrame, every: bool) -> DataFrame:
    """Distinct pairs that share as many prefix shingles as the smaller number asks for.

    Where ``every`` shared one is there, those up to the last and all that follows
    have to reach the overlap, too.
    """
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("asked").alias("asked"), F.min("slack").alias("slack")).where("shared >= asked")
    return (counted.where("shared - 1 + slack >= 0") if every else counted).select("a", "b")


def clusters(df: DataFrame, width: int = 3, threshold: Fraction = Fraction(9, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every row.

    Two rows link when their sets of ``width``-word shingles have a Jaccard
    similarity of ``threshold`` or more; ``component_id`` is the smallest id
    reachable by links, itself included. Rows without words or text have no
    shingles and link with nothing; their component is their own id. Rows with
    equal texts link, whatever their ids; null ids are ignored unless a component
    has no other. Repeated rows stay repeated, an empty table gives an empty result;
    extra columns are dropped.
    """
    like = Similarity(threshold, width)
    data = id_and_text(df, id_col, text_col)
    candidates = _candidates(data, like)
    rows = written(_rows(data, width, marks(candidates, MARKS)), "join-rows", release=False)
    classes = rows.where("f1 is not null").groupBy("f1", "f2").agg(F.first("size").alias("size"), F.min("id").alias("least"), F.min(F.expr("if(shingles is null, null, task)")).alias("task"))
    classes = written(classes.join(candidates.withColumn("near", F.lit(True)), ["f1", "f2"], "left").withColumn("node", F.monotonically_increasing_id()), "join-classes")
    dropped(candidates)
    nodes = classes.where("near").select("node", "f1", "f2", "task")
    sets = written(rows.where("shingles is not null").join(nodes, ["f1", "f2", "task"]).select("node", "size", "shingles", "bits"), "join-sets")
    found = _components_of(sets, like)
    best = classes.where("near").select("node", "least").join(found, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    best = found.join(best, "component").select("node", "component_id")
    named = classes.join(best, "node", "left").select("f1", "f2", F.coalesce("component_id", "least").alias("component_id"))
    named = rows.where("f1 is not null").select("id", "size", "f1", "f2").join(named, ["f1", "f2"]).select("id", "size", "component_id")
    every = named.union(rows.where("f1 is null").select("id", "size", F.col("id").alias("component_id")))
    return every.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def _tokens(live: DataFrame, step: int) -> DataFrame:
    """``(token, all, held, major, hub)`` of shingles whose nodes are in several components.

    ``all`` rows of which ``held`` are of the ``major`` component, and a hub.
    """
    # A set most of whose shingles are shared is the middle of its group; later rounds take other components by chance.
    chance = F.xxhash64("component", F.lit(step)) if step else F.lit(0).cast("long")
    hub = F.max(F.struct(chance.alias("by"), "common", "node", "size", "matches", "place", "rank"))
    if not step:  # every node is a component
        return live.groupBy("token").agg(F.count("*").alias("all"), F.lit(1).cast("long").alias("held"), F.max("component").alias("major"), hub.alias("hub")).where("all > 1")
    open_ = live.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("token")
    groups = live.join(open_, "token").groupBy("token", "component").agg(F.count("*").alias("n"), hub.alias("hub"))
    tokens = groups.groupBy("token").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("major"), F.max("hub").alias("hub"))
    return tokens.select("token", "all", F.col("major.n").alias("held"), F.col("major.component").alias("major"), "hub")


def _components_of(sets: DataFrame, like: Similarity) -> DataFrame:
    """``(node, component)`` of nodes with a similar one (others may be missing), from ``sets (node, size, shingles, bits)``."""
    live = written(_index(sets, like).withColumn("component", F.col("node")), "join-index")
    labels = written(live.select("node", F.col("node").alias("component")).distinct(), "labels", release=False)
    before = None
    for step in range(ROUNDS + 1):
        tokens = written(_tokens(live, step), "join-tokens", release=False)
        left = tokens.agg(F.sum((F.col("all") - F.col("held")) * F.col("all")), F.sum("all")).first()
        if left[0] is None:
            break
        last = step == ROUNDS or left[0] <= PAIRS_LEFT * left[1] or (before is not None and 2 * left[0] > before)
        before = left[0]
        active = written(live.join(tokens.select("token", "major", "hub"), "token"), "join-active", release=False)
        dropped(tokens)
        dropped(live)
        pairs = _across(active, sets, like) if last else _with_hubs(active, like)
        pairs = written(_asked(pairs, last), "join-pairs")
        edges = _similar(pairs, sets, like)
        ends = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        others = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        joined = edges.join(ends, "a").join(others, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        moved = _relabelled(labels, components(joined))
        dropped(pairs)
        dropped(edges)
        dropped(labels)
        labels = moved
        if not last:
            live = written(active.drop("component", "major", "hub").join(labels, "node"), "join-index")
        dropped(active)
        if last:
            break
    return labels


def _fits(like: Similarity) -> tuple[Column, Column]:
    """Whether sizes and places of a pair's shared shingle let it be similar, and the slack they leave."""
    slack = like.slack("na", "nb", "pa", "pb")
    return like.sizes_fit("na", "nb") & (F.least("ra", "rb") + slack >= 0), slack


def _side(side: str) -> list[Column]:
    """A node's columns in a pair."""
    return [F.col(c).alias(n + side) for c, n in (("node", ""), ("size", "n"), ("matches", "m"), ("place", "p"), ("rank", "r"), ("component", "c"))]


def _with_hubs(active: DataFrame, like: Similarity) -> DataFrame:
    """``(a, b, asked, slack)`` of every node with the hubs of its shingles."""
    fits, slack = _fits(like)
    hub = [F.col(f"hub.{c}").alias(n + "a") for c, n in (("node", ""), ("size", "n"), ("matches", "m"), ("place", "p"), ("rank", "r"))]
    pairs = active.select("token", *_side("b"), *hub).where("a <> b").where(fits)
    return pairs.select("a", "b", F.least("ma", "mb").alias("asked"), slack.alias("slack"))


def _across(active: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """``(a, b, asked, slack)`` of all pairs between components that share a shingle, by sizes, places and signatures.

    One node of each pair is outside of the shingle's major component.
    """
    signed = active.drop("hub").join(sets.select("node", "bits"), "node")
    a = signed.where("component <> major").select("token", "major", *_side("a"), F.col("bits").alias("sa"))
    b = signed.select("token", *_side("b"), F.col("bits").alias("sb"))
    fits, slack = _fits(like)
    differ = sum((F.bit_count(F.get("sa", k).bitwiseXOR(F.get("sb", k))) for k in range(WORDS)), F.lit(0))
    near = differ <= F.col("na") + F.col("nb") - 2 * like.need("na", "nb")
    pairs = a.join(b, "token").where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("major")) | (F.col("a") < F.col("b"))) & fits & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("ma", "mb").alias("asked"), slack.alias("slack"))


def one_of_each(df: DataFrame, width: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, of which one in each group of near copies stays.

    The one with the smallest id stays (of equal ids, any one). Rows without
    words are in no group and stay.
    """
    names = df.columns
    base = written(df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(quoted(c)) for c in names]).alias("document")), "join-documents")
    found = written(clusters(base.select("row", F.col(f"document.{quoted(text_col)}").alias("text")), width, threshold, "row", "text"), "join-found")
    numbered = base.select("row", F.col(f"document.{quoted(id_col)}").alias("id")).join(found, "row")
    first = numbered.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row")).alias("first"), F.count("*").alias("held"))
    found, first = found.select("row", "component_id"), first.where("held > 1").select("component_id", F.col("first.row").alias("stays"))
    gone = written(found.join(first, "component_id").where("row <> stays").select("row"), "join-gone")  # fewer than stay, mostly
    return base.join(gone, "row", "left_anti").select("document.*")


#: Components by comparing every pair that shares a shingle, for an engine without this module and small tables.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
), tokens AS (
  SELECT doc_id, unnest(s) AS token FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN both_ways e ON r.b = e.a) SELECT a, min(b) AS least FROM r GROUP BY a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least AS component_id FROM sets s JOIN reach ON reach.a = s.doc_id
"""
