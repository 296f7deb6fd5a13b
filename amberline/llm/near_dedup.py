"""Near-duplicates: fast similarity sketches, banding, exact verification, components.

A document's set holds its distinct word shingles.  Documents with equal sets are one node.  The sketch of Dahlgaard,
Knudsen and Thorup fills its bins in rounds: in round i every element throws the value i + v_i(x) into a random bin (from
round t on, into bin i - t), bins keep their least value, and rounds go on until no bin is empty.  Every coordinate is filled, and two
sketches agree in a share of coordinates that is sharply concentrated at the Jaccard similarity.

Bands of coordinates give buckets.  Each node is first compared with the most central node of all its buckets, its hub, so that a group
of near copies costs a comparison per member.  Then rounds with more and more pivots of each bucket go on until the bucket is one
component or all its members have been pivots.  A pair meets in the first bucket where it can; only members of different components are compared, and only
where what is known of both leaves room for a link: their sizes, their sketches and how their sets differ from that of a common hub.
For the last, the members of buckets that are not one component yet are compared with their hubs once more, and the shingles in which a member differs
from its hub are counted over all members of that hub.  Those that no other member has are certain to tell it apart from each of
them, so that many edits of a text are ruled out without being compared with each other.  Links are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import vec
from .common import NO_ID, checkpointed, doc_key, free_shuffles, map_arrow, small_side, text_mark

SHINGLE = 5
PERCENT = 85
#: 32 bands of 6: a pair at similarity 0.85 is in no common bucket with probability (1 - 0.85 ** 6) ** 32 = 3e-7.
BANDS, ROWS = 32, 6
#: Coordinates of a sketch, a multiple of 64; the bands use the first ones.  Kept are four bits of each, and one bit of each for comparing inside
#: buckets.  A pair is left out if its sketches agree so little that this is five standard deviations below the threshold (one linked pair in 3 million).
COORDINATES = 768
DEVIATIONS = 5
BLOCK_ROWS = 2_048
#: At most so many pairs (of six longs) are broadcast to the texts; more are joined by a shuffle.
SMALL_PAIRS = 100_000
#: Links that are written into one file between the steps that find components.
LINKS_A_FILE = 200_000
#: Pivots of a bucket in the first round after the hubs, and how many times as many each further round takes.
PIVOTS, PIVOT_GROWTH = 4, 64


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole word sequence of a text with fewer words."""
    buf = vec.LOWER[buf]
    starts, ends, firsts = vec.word_spans(buf, offsets)
    sums = vec.Sums(vec.word_codes(buf, starts, ends))
    windows = sums.grams(k)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(windows[a:b - k + 1]))
        else:
            out.append(sums.slices(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Sketch matrix (texts by t); rows of empty sets stay at the largest value."""
    empty = np.uint64(2**64 - 1)
    table = np.full(len(sets) * t, empty, dtype=np.uint64)
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    x = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    for i in range(2 * t):
        if not len(x):
            break
        h = vec.mix(x + vec.U64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = (h >> vec.U64(11)) | vec.U64(i << 53)  # the round leads: up to 2048 of them
        where = row * t + ((h & vec.U64(1023)).astype(np.int64) * 8191 + (h >> vec.U64(40)).astype(np.int64)) % t if i < t else row * t + (i - t)
        np.minimum.at(table, where, value)
        # each round takes on only the texts that still have an empty bin
        todo = (table.reshape(len(sets), t) == empty).any(axis=1)
        go = todo[row]
        x, row = x[go], row[go]
    return table.reshape(len(sets), t)


def _describe(bands: int, rows: int, k: int):
    t = max(COORDINATES, -(-bands * rows // 64) * 64)
    longs = t // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                nodes, sizes, band_lists, marks, packed = [], [], [], [], []
                for first, end, buf, offsets in vec.blocks(part.column("text")):
                    sets = shingle_sets(buf, offsets, k)
                    matrix = sketches(sets, t)
                    sizes.append(np.array([len(s) for s in sets], dtype=np.int64))
                    nodes.append(np.array([int(vec.mix(s).sum(dtype=np.uint64)) * 31 + len(s) & 2**64 - 1 for s in sets], dtype=np.uint64))
                    hashed = matrix[:, :bands * rows].reshape(len(sets) * bands, rows) * vec.powers(vec.BASES[0], rows + 1)[0][1:rows + 1]
                    number = np.tile(np.arange(bands, dtype=np.uint64), len(sets))
                    band_lists.append(vec.mix(vec.mix(hashed.sum(axis=1, dtype=np.uint64)) + number).reshape(len(sets), bands))
                    mixed = vec.mix(matrix)
                    packed.append(np.packbits((mixed >> vec.U64(63)).astype(np.uint8), axis=1).view(np.int64).reshape(len(sets), longs))
                    nibbles = (mixed & vec.U64(15)).astype(np.uint8)
                    marks += [r.tobytes() for r in nibbles[:, ::2] << 4 | nibbles[:, 1::2]]
                n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
                flat = np.concatenate(band_lists).ravel().view(np.int64) if band_lists else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands), pa.array(flat))
                node = np.concatenate(nodes) if nodes else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("mark"), pa.array(vec.mix(node).view(np.int64)), pa.array(n), lists,
                                                  pa.array(marks, pa.binary()), *[pa.array(np.concatenate([p[:, i] for p in packed]) if packed else [], pa.int64())
                                                                                  for i in range(longs)]],
                                                 names=["doc", "mark", "node", "n", "bands", "sketch", *[f"s{i}" for i in range(longs)]])

    return run


def _sketch_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in ("sketch", "p_sketch"))
            n, m = (np.asarray(batch.column(c)) for c in ("n", "p_n"))
            unlike = a ^ b
            t = 2 * unlike.shape[1]
            agree = ((unlike < 16).sum(axis=1) + ((unlike & 15) == 0).sum(axis=1)) / max(1, t)
            near = (agree - 1 / 16) * 16 / 15  # four bits agree by chance once in 16
            at = percent / 100 + (1 - percent / 100) / 16
            least = percent / 100 - DEVIATIONS * (at * (1 - at) / max(1, t)) ** 0.5 * 16 / 15
            ok = (near >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            kept = batch.select(["node", "doc", "mark", "pivot", "p_doc", "p_mark"]).append_column("near", pa.array(near))
            yield kept.filter(pa.array(ok))

    return run


def _set_pairs(batch: pa.RecordBatch, k: int, held: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, set of the node, set of the pivot); the last pivot's set is kept."""
    pivots, texts = batch.column("pivot").to_numpy(), batch.column("p_text")
    for first, _, buf, offsets in vec.blocks(batch.column("text")):
        for i, own in enumerate(shingle_sets(buf, offsets, k), first):
            if held.get("pivot") != pivots[i]:
                _, _, p_buf, p_offsets = next(vec.blocks(texts.slice(i, 1)))
                held["pivot"], held["set"] = pivots[i], shingle_sets(p_buf, p_offsets, k)[0]
            yield i, own, held["set"]


def _verifier(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            both, either = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for i, own, other in _set_pairs(batch, k, held):
                both[i] = len(np.intersect1d(own, other, assume_unique=True))
                either[i] = len(own) + len(other) - both[i]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("pivot"), pa.array(both), pa.array(either)],
                                             names=["node", "pivot", "both", "either"])

    return run


def _differ(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            node, pivot = (batch.column(c).to_numpy() for c in ("node", "pivot"))
            for i, own, other in _set_pairs(batch, k, held):
                unlike = np.setxor1d(own, other, assume_unique=True).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unlike), node[i])), pa.array(np.full(len(unlike), pivot[i])), pa.array(unlike)],
                                                 names=["node", "pivot", "unlike"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b); the label is the smallest node reachable.

    Alternating large-star and small-star steps: groupings with partial minima and joins, a few of them even for long chains.
    They end when a step changes nothing, which a count and a sum of hashes tell.  There are never more edges than links, so their
    files can be few from the start; those of finished steps are deleted.
    """
    parts = 1 + links.count() // LINKS_A_FILE
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = checkpointed(small.coalesce(parts))
        free_shuffles(edges)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of ``docs``.

    Linked are documents with 100 * intersection >= ``percent`` * union of their shingle sets, and documents with equal sets; null and
    empty texts, or texts without words, have empty sets and are linked with nothing.  component_id is the smallest id reachable, itself included, kept
    says that it is the row's own.  Rows with a null id are compared like others, sort last, and show the null id as their
    component if all of it has null ids.  Rows with the same id are judged by their own texts.  Empty table: no rows; other
    columns do not matter.  Nodes are 64-bit hashes of whole sets.
    """
    out = _judged(docs, percent, shingle, bands, rows, key, text)
    component = F.coalesce("component", "doc")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), F.col("n").alias("n_shingles"),
                      F.when(component != NO_ID, component).alias("component_id"), (component == F.col("doc")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, broadcast_rows: int, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                         key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: exactly one row of each component, the first by id, mark of the text and the other columns.

    A null id sorts last and is told apart by the text like any other; rows with the same id are judged by their own texts, and of rows
    with the same id and text one stays.  Rows without words are nobody's copies and all stay.  Up to ``broadcast_rows`` pairs of id and mark
    of dropped or repeated rows are broadcast.
    """
    judged = _judged(docs, percent, shingle, bands, rows, key, text).where("n > 0")
    first = (F.col("doc") == F.col("component")) & (F.col("mark") == F.col("c_mark"))
    known = checkpointed(judged.groupBy("doc", "mark").agg(F.max(first).alias("kept"), F.count("*").alias("copies")).where("not kept or copies > 1"))
    names = docs.columns
    places = [f"c{i}" for i in range(len(names))]
    marked = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(names, places)], doc_key(key).alias("_doc"), text_mark(text).alias("_mark"))
    back = [F.col(p).alias(c) for c, p in zip(names, places)]
    found = known.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "kept")
    out = marked.join(small_side(found.drop("kept"), broadcast_rows), ["_doc", "_mark"], "left_anti").select(back)
    repeated = found.where("kept").drop("kept")
    if repeated.isEmpty():
        return out
    one = (marked.join(small_side(repeated, broadcast_rows), ["_doc", "_mark"]).groupBy("_doc", "_mark")
           .agg(F.min(F.struct(*places)).alias("row")).select("row.*"))
    return out.unionByName(one.select(back))


def _judged(docs: DataFrame, percent: int, shingle: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """(doc, mark, n, component, c_mark) of each row; the last two are those of the component's first row, null without words."""
    base = docs.select(doc_key(key).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    described = checkpointed(map_arrow(base, _describe(bands, rows, shingle),
                                       "doc long, mark long, node long, n long, bands array<long>, sketch binary, "
                                       + ", ".join(f"s{i} long" for i in range(max(COORDINATES // 64, -(-bands * rows // 64))))))
    filled = described.where("n > 0")
    # documents with equal sets, repeated rows among them, are one node, compared by the text of the first
    facts = [c for c in described.columns if c not in ("doc", "mark", "node")]
    nodes = checkpointed(filled.groupBy("node").agg(F.min(F.struct("doc", "mark")).alias("first"), *[F.first(c).alias(c) for c in facts])
                         .select("node", "first.*", *facts))
    label = link_nodes(base, nodes, percent, shingle)
    classes = nodes.select("node", "doc", "mark")
    small = classes.join(label, "node").groupBy("label").agg(F.min(F.struct("doc", "mark")).alias("least"))
    linked = checkpointed(label.join(small, "label").select("node", "least"))
    least = F.coalesce("least", F.struct("doc", "mark"))
    class_of = classes.join(linked, "node", "left").select("node", least["doc"].alias("component"), least["mark"].alias("c_mark"))
    return described.select("doc", "mark", "node", "n").join(class_of, "node", "left").drop("node")


def link_nodes(base: DataFrame, nodes: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(node, label) of the nodes that have a link."""
    packed = [c for c in nodes.columns if c[0] == "s" and c[1:].isdigit()]
    facts = nodes.select("node", "doc", "mark", "n", "sketch", *packed)
    # one bit of a coordinate differs with probability (1 - J) / 2
    t, differ = 64 * len(packed), (1 - percent / 100) / 2
    most = int(t * differ + DEVIATIONS * (t * differ * (1 - differ)) ** 0.5)
    members = nodes.select("node", F.explode("bands").alias("band"))
    crowded = members.groupBy("band").agg(F.count("*").alias("c"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    members = checkpointed(members.join(crowded.select("band", "c"), "band"))
    central = members.groupBy("node").agg(F.sum("c").alias("weight"))
    rank = F.shiftleft(F.least(F.col("weight"), F.lit((1 << 38) - 1)), 24) + F.col("node").bitwiseAND(F.lit((1 << 24) - 1))
    members = checkpointed(members.join(central, "node").select("band", "node", rank.alias("rank")))
    if members.isEmpty():
        return members.select("node", F.col("node").alias("label"))
    # first each node with the most central pivot of all its buckets: nearly all links are found here
    best = members.groupBy("band").agg(F.max_by("node", "rank").alias("pivot"), F.max("rank").alias("p_rank"))
    first = (members.join(best, "band").where("node <> pivot").groupBy("node").agg(F.max_by("pivot", "p_rank").alias("pivot")))
    tested = checkpointed(compared(base, located(facts, first), shingle))
    linked = F.col("both") * 100 >= F.col("either") * percent
    links = tested.where(linked).select("node", "pivot")
    label = checkpointed(components(links.select(F.col("node").alias("a"), F.col("pivot").alias("b"))))
    known = tested.select("node", F.col("pivot").alias("hub"), (F.col("both") / F.col("either")).alias("near"), (F.col("either") - F.col("both")).alias("unlike"))
    tested = tested.select("node", "pivot")
    done, pivots = 0, PIVOTS
    while True:
        # buckets that are not one component yet, and have had fewer pivots than members
        here = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = here.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c")).where(f"lo <> hi and c > {done}")
        here = checkpointed(here.join(mixed.select("band"), "band"))
        if here.isEmpty():
            return label
        if not done:
            own = apart_from_hubs(base, facts, here.select("node").distinct().join(known, "node"), shingle)
            here = checkpointed(here.join(nodes.select("node", "n", "bands", *packed), "node").join(own, "node", "left"))
        free_shuffles(here)
        order = W.partitionBy("band").orderBy(F.desc("rank"), "node")
        chosen = (here.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots).where(F.col("place") > done)
                  .select(*[F.col(c).alias(f"p_{c}") for c in ("band", "node", "n", *packed, "hub", "near", "own", "shared", "label")]))
        chosen = chosen.join(chosen.groupBy("p_node").agg(F.collect_set("p_band").alias("p_bands")), "p_node")
        # 1 - Jaccard is a metric: nodes are not linked if their similarities to one hub differ by more than 1 - threshold
        apart = F.abs(F.col("near") - F.col("p_near")) > 1 - percent / 100 + 1e-9
        # what two sets differ from a hub by, they differ by from each other, but for what they have both
        least = F.col("own") + F.col("p_own") + F.abs(F.col("shared") - F.col("p_shared"))
        apart = (F.col("hub") == F.col("p_hub")) & (apart | (least * (100 + percent) > (F.col("n") + F.col("p_n")) * (100 - percent)))
        sizes = F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent
        unlike = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"p_{c}"))) for c in packed), F.lit(0))
        first_meeting = F.array_min(F.array_intersect("bands", "p_bands")) == F.col("band")
        pairs = (here.join(chosen, (F.col("band") == F.col("p_band")) & (F.col("label") != F.col("p_label")) & sizes
                           & ~F.coalesce(apart, F.lit(False)) & (unlike <= most) & first_meeting)
                 .select(F.greatest("node", "p_node").alias("node"), F.least("node", "p_node").alias("pivot")).distinct())
        old = tested.select(F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot"))
        pairs = checkpointed(pairs.join(old, ["node", "pivot"], "left_anti"))
        free_shuffles(pairs)
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            near = checkpointed(map_arrow(located(facts, pairs, ["n", "sketch"]), _sketch_filter(percent),
                                          "node long, doc long, mark long, pivot long, p_doc long, p_mark long, near double"))
            # the likely links first: most of the other pairs are in one component then
            likely = F.col("near") >= percent / 100 - 0.02
            found = checkpointed(compared(base, near.where(likely), shingle).where(linked).select("node", "pivot"))
            if not found.isEmpty():
                links = links.unionByName(found)
                label = checkpointed(components(links.select(F.col("node").alias("a"), F.col("pivot").alias("b"))))
            free_shuffles(members)
            found = checkpointed(compared(base, _apart(near.where(~likely), label), shingle).where(linked).select("node", "pivot"))
            if not found.isEmpty():
                links = links.unionByName(found)
                label = checkpointed(components(links.select(F.col("node").alias("a"), F.col("pivot").alias("b"))))
            free_shuffles(members)
        members = here.drop("label")
        free_shuffles(members)
        done, pivots = pivots, pivots * PIVOT_GROWTH


def apart_from_hubs(base: DataFrame, facts: DataFrame, known: DataFrame, shingle: int) -> DataFrame:
    """(node, hub, near, own, shared): of the shingles in which a node differs from its hub, how many no other of these nodes with that hub differs by."""
    unlike = beside(base, located(facts, known.select("node", F.col("hub").alias("pivot"))))
    unlike = map_arrow(unlike, _differ(shingle), "node long, pivot long, unlike long")
    own = (unlike.groupBy("pivot", "unlike").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
           .groupBy("node").agg(F.count("*").alias("own")))
    own_count = F.coalesce("own", F.lit(0).cast("long"))
    return checkpointed(known.join(own, "node", "left").select("node", "hub", "near", own_count.alias("own"), (F.col("unlike") - own_count).alias("shared")))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    ends = label.select(F.col("node").alias("pivot"), F.col("label").alias("p_label"))
    both = pairs.join(label, "node", "left").join(ends, "pivot", "left")
    return both.where(F.coalesce("label", "node") != F.coalesce("p_label", "pivot")).drop("label", "p_label")


def located(facts: DataFrame, pairs: DataFrame, more: list[str] | None = None) -> DataFrame:
    """The pairs (node, pivot) with the document and text mark of both, and further facts."""
    own = ["doc", "mark", *(more or [])]
    pivot = facts.select(F.col("node").alias("pivot"), *[F.col(c).alias(f"p_{c}") for c in own])
    return pairs.join(facts.select("node", *own), "node").join(pivot, "pivot").select("node", *own, "pivot", *[f"p_{c}" for c in own])


def beside(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, pivot, text, p_text) of located pairs, those of one pivot side by side; rows of ``base`` with one id and text count once."""
    near = checkpointed(pairs.select("node", "doc", "mark", "pivot", "p_doc", "p_mark"))
    few = near.limit(SMALL_PAIRS + 1).count() <= SMALL_PAIRS

    def texts(doc: str, mark: str, text: str) -> DataFrame:
        wanted = near.select(F.col(doc).alias("doc"), F.col(mark).alias("mark")).distinct()
        found = base.join(F.broadcast(wanted) if few else wanted, ["doc", "mark"], "left_semi").dropDuplicates(["doc", "mark"])
        return found.select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("text").alias(text))

    with_text = texts("doc", "mark", "text").join(F.broadcast(near) if few else near, ["doc", "mark"])
    return (with_text.select("node", "text", "pivot", "p_doc", "p_mark").join(texts("p_doc", "p_mark", "p_text"), ["p_doc", "p_mark"])
            .select("node", "pivot", "text", "p_text"))


def compared(base: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """(node, pivot, both, either): sizes of intersection and union of the full sets of located pairs."""
    return map_arrow(beside(base, pairs), _verifier(shingle), "node long, pivot long, both long, either long")
