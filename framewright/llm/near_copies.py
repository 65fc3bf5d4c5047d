"""Near-copies by SimHash and MinHash candidates, verified by exact Jaccard
similarity of word shingles.

Candidates are texts whose 64-bit SimHashes differ in three bits at most, found
by the Golay keys of ``simhash``, and those that share a band of a MinHash
signature: at similarity 0.8 two SimHashes differ in some ten bits, far beyond
these keys, while a pair meets in one of BANDS bands of DEEP values with
probability 0.9996.  Each candidate pair is verified on its whole sets of
shingles.  First each node is compared with one node of its fingerprint, those
of linked fingerprints, and one node of its bands.  What is apart still within
a band meets by its rarest shingles alone: sets that are alike have one of them
in common, so nothing is lost.  Of these pairs only those are made whose
sketches, parities of 1,024 cells of a set's shingles, let them be alike: the
cells that differ are never more than the shingles that do, so here too nothing
is lost.  Where these are FEW pairs for each node, all are verified at once.
Else, as only components are wanted, rounds come first in which each node is
compared with a few others that share such shingles and aren't linked to it;
what these link needs no pairs of its own, and all pairs of the rest are
verified at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm import simhash
from framewright.llm._components import components
from framewright.llm._shared import forget, stored, tidy
from framewright.llm._text import Words, grams, mix, words_of

SHINGLE = 5
LEAST = 0.8
BANDS = 20
DEEP = 5
ROUNDS = 6  # at most, before all pairs that are left
PARTNERS = 3  # of a node in a round
MANY = 200  # places for each row of the prefixes at which pairs may meet, up to which they are looked for
FEW = 30  # pairs for each node, up to which all are verified at once
CELLS = 16  # words of 64 cells of a sketch

_RNG = np.random.Generator(np.random.PCG64(823))
_TIMES = _RNG.integers(1, 2**63, BANDS * DEEP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 2**63, BANDS * DEEP, dtype=np.uint64)


def shingles(words: Words, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first): the sorted distinct shingles of each row and where each
    row's begin.  A text of fewer words is one shingle, without words too."""
    rows, n = words.high - words.low, np.diff(words.first)
    found = grams(words.hash, shingle)
    start = np.flatnonzero(words.row[: len(found)] == words.row[shingle - 1 : shingle - 1 + len(found)])
    row, h = words.row[start], found[start]
    few = np.flatnonzero(n < shingle)
    whole = np.zeros(len(few), np.uint64)
    for j in range(shingle - 1):
        more = n[few] > j
        whole[more] = mix(whole[more], words.hash[words.first[few[more]] + j])
    row, h = np.concatenate([row, few]), np.concatenate([h, whole])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return h[new], np.searchsorted(row[new], np.arange(rows + 1))


def node_ids(words: Words, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's set of shingles."""
    return mix(np.add.reduceat(mix(h, h), first[:-1]), np.diff(first).astype(np.uint64))


def signatures(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, bands, fp): a row per row; texts with equal sets of
    shingles are one node; fp is a text's SimHash."""

    def run(batches):
        for batch in batches:
            for words in words_of(batch.column(1), lower=True):
                h, first = shingles(words, shingle)
                at = first[:-1]
                node = node_ids(words, h, first)
                bands = np.zeros((len(at), BANDS), np.uint64)
                for i in range(BANDS * DEEP):
                    bands[:, i // DEEP] = mix(bands[:, i // DEEP], np.minimum.reduceat(h * _TIMES[i] + _PLUS[i], at))
                bands = mix(bands, np.arange(BANDS, dtype=np.uint64)[None, :])
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel().view(np.int64)))
                prints = np.array([simhash.fingerprint(t) for t in batch.column(1).slice(words.low, len(at)).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.low, len(at)), pa.array(node.view(np.int64)), keys, pa.array(prints.view(np.int64))], names=["doc_id", "node", "bands", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(run), "doc_id long, node long, bands array<long>, fp long")


def with_node(docs: DataFrame, shingle: int, text_col: str) -> DataFrame:
    """The rows of docs, and each one's node as ``__node``."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            nodes = [node_ids(words, *shingles(words, shingle)) for words in words_of(batch.column(place), lower=True)]
            yield batch.append_column("__node", pa.array(np.concatenate(nodes).view(np.int64) if nodes else np.zeros(0, np.int64)))

    return docs.mapInArrow(tidy(run), T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))


def sketches(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(rows, CELLS): of each row's sorted shingles the parities of how many
    fall into each cell.  Those of two sets differ by the shingles that only one
    of them has, so in as many cells at most."""
    word = np.repeat(np.arange(len(first) - 1) * CELLS, np.diff(first)) + (h >> np.uint64(60)).astype(np.int64)
    start = np.flatnonzero(np.diff(word, prepend=-1))
    found = np.zeros((len(first) - 1) * CELLS, np.uint64)
    if len(h):
        found[word[start]] = np.bitwise_xor.reduceat(np.uint64(1) << (h >> np.uint64(54) & np.uint64(63)), start)
    return found.reshape(-1, CELLS)


def _may(nx: str, ny: str, sx: str, sy: str, least: float) -> F.Column:
    """Whether sizes and sketches of two sets let their similarity be ``least``."""
    sizes = F.least(nx, ny) >= F.lit(least) * F.greatest(nx, ny) - 1e-9
    differ = sum((F.bit_count(F.col(sx)[i].bitwiseXOR(F.col(sy)[i])) for i in range(1, CELLS)), F.bit_count(F.col(sx)[0].bitwiseXOR(F.col(sy)[0])))
    return sizes & (differ <= F.lit((1 - least) / (1 + least)) * (F.col(nx) + F.col(ny)) + 1e-6)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, shingles, sketch) of texts (node, t)."""

    def run(batches):
        for batch in batches:
            for words in words_of(batch.column(1), lower=True):
                h, first = shingles(words, shingle)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))
                cells = sketches(h, first)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * CELLS), pa.array(cells.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.low, words.high - words.low), pa.array(np.diff(first).astype(np.int32)), lists, cells], names=["node", "n", "shingles", "sketch"])

    return texts.mapInArrow(tidy(run), "node long, n int, shingles array<long>, sketch array<long>")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is ``least`` or more."""
    size = F.col("na") + F.col("nb")
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        .where(F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb"))
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        .withColumn("m", F.size(F.array_intersect("x", "y")))
    )
    return both.where(F.col("m") >= F.lit(least) * (size - F.col("m")) - 1e-9).select("a", "b")


def _apart(keys: DataFrame, roots: DataFrame) -> DataFrame:
    """(k, node, root) of the bands whose nodes aren't all linked yet."""
    placed = keys.select("k", "node").join(roots, "node", "left").select("k", "node", F.coalesce("root", "node").alias("root"))
    bands = placed.groupBy("k").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("k")
    return placed.join(bands, "k", "left_semi")


def _by_print(marks: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes by op8's method: each node of a fingerprint and its
    first one, and the first ones of fingerprints that differ in three bits at
    most."""
    held = marks.select("fp", "node").distinct()
    first = stored(held.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    links = simhash.links(first.select("fp"))
    ends = [first.select(F.col("fp").alias(x), F.col("first").alias(f"f{x}")) for x in "ab"]
    met = links.join(ends[0], "a").join(ends[1], "b").select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b"))
    return held.join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b")).union(met).where("a <> b").distinct()


def _prefixes(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(node, n, s, w, left, short) of the nodes' rarest shingles: with
    shingles in one order, the rarest first, of sets that are alike the first
    1 - ``least`` of the larger one and the first (1 - least) / (1 + least) of
    the smaller one (short) have one in common, and from the first such on both
    have as many left as it takes.  Shingles that the same nodes hold, as those
    of a passage are, stand next to each other in that order and are one kind s,
    of which a node's first ones hold w."""
    dense = stored(nodes.select("node").join(sets, "node"), "dense")
    each = dense.select("node", F.explode("shingles").alias("s"))
    shared = each.groupBy("s").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("who")).where("c > 1")
    ranked = each.join(shared, "s").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("c", "who"))).alias("held"))
    ranked = dense.select("node", "n").join(ranked, "node").withColumn("u", F.col("n") - F.size("held"))

    def length(share: float) -> F.Column:
        return F.greatest(F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1 - F.col("u"), F.lit(0)).cast("int")

    rows = ranked.select("node", "n", "u", length(2 * least / (1 + least)).alias("few"), F.posexplode(F.slice("held", F.lit(1), length(least))).alias("i", "e"))
    rows = rows.groupBy("node", "n", "u", "few", "e").agg(F.min("i").alias("i"), F.count("*").alias("w"))
    return stored(rows.select("node", "n", F.xxhash64("e.c", "e.who").alias("s"), "w", (F.col("n") - F.col("u") - F.col("i")).alias("left"), (F.col("i") < F.col("few")).alias("short")), "prefixes")


def _some(rows: DataFrame, turn: int, least: float) -> DataFrame:
    """Pairs (a, b): for each node of rows (s, node, root, n, w, sketch) up to
    PARTNERS of other roots that it may be like.  Each shingle of a kind offers a
    node of one root, and one of another to that root's nodes, drawn anew each
    turn; a node takes those that come with most of its shingles."""
    rows = rows.select("s", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))).alias("j"), "node", "root", "n", "sketch")
    me = F.struct(F.xxhash64(F.lit(turn), "s", "j", "root").alias("of"), F.xxhash64(F.lit(turn), "s", "j", "node").alias("at"), "node", "root", "n", "sketch")
    ends = rows.groupBy("s", "j").agg(F.min(me).alias("lo"), F.max(me).alias("hi"))
    met = rows.join(ends, ["s", "j"]).withColumn("o", F.when(F.col("root") != F.col("lo.root"), F.col("lo")).otherwise(F.col("hi")))
    met = met.where((F.col("root") != F.col("o.root")) & _may("n", "o.n", "sketch", "o.sketch", least))
    met = met.groupBy("node", F.col("o.node").alias("other")).agg(F.count("*").alias("c"))
    best = met.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", F.xxhash64(F.lit(turn), "node", "other").alias("at"), "other")), False), 1, PARTNERS).alias("x"))
    best = best.select("node", F.explode("x.other").alias("other"))
    return best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots (node, root, sketch), each replaced by the least that a link leads to."""
    ends = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("v")), "a").join(roots.select(F.col("node").alias("b"), F.col("root").alias("w")), "b")
    least = ends.select(F.explode(F.array(F.struct("v", "w"), F.struct(F.col("w").alias("v"), F.col("v").alias("w")))).alias("e")).select("e.*").groupBy("v").agg(F.min("w").alias("m")).where("m < v")
    for _ in range(2):  # and on from there
        roots = roots.join(least.withColumnRenamed("v", "root"), "root", "left").select("node", F.coalesce("m", "root").alias("root"), "sketch")
    return stored(roots, "roots")


def _met(rows: DataFrame, least: float) -> DataFrame:
    """All pairs (a, b) of different roots whose prefixes and sketches let them
    be alike."""
    x, y = (rows.select("s", *[F.col(c).alias(f"{c}{e}") for c in ("node", "n", "root", "left", "short", "sketch")]) for e in "xy")
    sizes = (F.struct("nx", "nodex") < F.struct("ny", "nodey")) & (F.col("rootx") != F.col("rooty"))
    enough = F.least("leftx", "lefty") >= F.lit(least / (1 + least)) * (F.col("nx") + F.col("ny")) - 1e-9  # from there on
    pairs = x.where("shortx").join(y, "s").where(sizes & enough & _may("nx", "ny", "sketchx", "sketchy", least))
    return pairs.select(F.least("nodex", "nodey").alias("a"), F.greatest("nodex", "nodey").alias("b")).distinct()


def _rest(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between nodes (node, root) that join all components which
    pairs of similarity ``least`` or more make."""
    spark, links = nodes.sparkSession, None
    roots = stored(nodes.join(sets.select("node", "sketch"), "node"), "roots")
    held, last = _prefixes(roots, sets, least), False
    for turn in range(ROUNDS + 1):
        last |= turn == ROUNDS
        before, held = held, stored(held.join(roots, "node"), "prefixes")
        apart = held.groupBy("s").agg(F.min("root").alias("r"), F.max("root").alias("z")).where("r < z").select("s")
        rows = stored(held.join(apart, "s", "left_semi"), "prefixes")
        forget(spark, before, held)
        ends = rows.groupBy("s", "root").agg(F.count("*").cast("double").alias("c"), F.count_if("short").alias("few"))
        ends = ends.groupBy("s").agg(F.sum("c").alias("c"), F.sum("few").alias("few"), F.sum(F.col("c") * F.col("few")).alias("own"))
        n, left = ends.agg(F.sum("c"), F.sum(F.col("c") * F.col("few") - F.col("own"))).first()
        if last or left is None or left <= MANY * n:
            pairs = stored(_met(rows, least), "pairs")
            if last or pairs.count() <= FEW * rows.select("node").distinct().count():
                found = _alike(pairs, sets, least)
                return links.union(found) if links is not None else found
            forget(spark, pairs)
        found = stored(_alike(_some(rows, turn, least), sets, least), "links")
        links = links.union(found) if links is not None else found
        last = found.isEmpty()
        before, roots = roots, _merged(roots, found)
        forget(spark, before)
        held = rows.drop("root", "sketch")
        held.stored_at = rows.stored_at


def _groups(docs: DataFrame, least: float, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of each row, and (node, root, least, component_id)."""
    marks = stored(signatures(docs, shingle, id_col, text_col), "signatures")
    nodes = marks.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))
    keys = nodes.select("node", F.explode("bands").alias("k"))
    met = keys.groupBy("k").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("k", "a")
    keys = stored(keys.join(met, "k"), "bands")
    printed = stored(_by_print(marks), "printed")
    wanted = keys.select("node").union(printed.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    wanted = stored(wanted.join(nodes.select("node", "least"), "node"), "wanted")
    texts = with_node(docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")), shingle, "t")
    texts = texts.join(wanted, (F.col("__node") == F.col("node")) & F.col("i").eqNullSafe(F.col("least"))).groupBy("node").agg(F.first("t").alias("t"))
    sets = stored(_sets(texts, shingle), "shingles")
    pairs = keys.groupBy(F.col("node").alias("b")).agg(F.min("a").alias("a")).where("a <> b").select("a", "b")
    links = stored(_alike(printed.union(pairs).distinct(), sets, least), "links")
    apart = _apart(keys, components(links)).select("node", "root").distinct()
    roots = components(stored(links.union(_rest(apart, sets, least)), "links"))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least_id = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.select("doc_id", "node"), named.join(least_id, "root")


def near_copies(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id (least document id
    reachable over pairs of similarity ``least`` or more).  Texts without
    words, null ones too, are copies of each other; a null id takes part."""
    marks, nodes = _groups(docs, least, shingle, id_col, text_col)
    return marks.join(nodes.select("node", "component_id"), "node").select("doc_id", "component_id")


def representatives(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` with one row of each component: of
    least id, if any has one, and of those that share it the one whose columns
    come first.  Rows are told apart by their texts, so of rows that share an
    id each stays or goes by its own."""
    marks, nodes = _groups(docs, least, shingle, id_col, text_col)
    first = nodes.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("x")).select("x.node", "x.least")
    mine = F.col("doc_id").eqNullSafe(F.col("least"))
    kept = stored(marks.join(first, "node").where(mine).groupBy("node").agg(F.first("least").alias("least"), F.count("*").alias("n")), "kept")

    names = docs.columns
    rows = with_node(docs, shingle, text_col)
    rows = rows.join(kept.withColumnsRenamed({"node": "__node", "least": "__least", "n": "__n"}), "__node").where(F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__least")))
    columns = [F.col(f"`{c}`") for c in names]
    again = rows.where("__n > 1").groupBy("__node").agg(F.min(F.struct(*columns)).alias("x")).select("x.*")
    return rows.where("__n = 1").select(*columns).union(again)
