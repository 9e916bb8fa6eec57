"""N-gram Jaccard join by chosen paths.

A document is the set of its word shingles. Each set is embedded as 128 tokens
(place, least hash of the shingles that fall there), so that two sets agree in a
share of tokens equal to their similarity. A recursion brings similar sets
together: at a node, different places are drawn, the same for all sets of the
node, and each set goes to one child node for each drawn place, named by its
token there. Nodes with few sets are compared by brute force. In a large node
all sets are compared with some of them; those like one are linked and leave, the
others are split again, until no large node is left. Every node draws a place at
least. The root draws as many as the target recall asks for; below it the draws
make a pair at the threshold share more than one child of a node on average, so
that its chance to stay together doesn't go to zero with the depth.

What the recursion links are candidates, joined into groups; within a group all
sets are then compared exactly, block by block. So a pair that the recursion
misses is still found if others connect it, and no false pair remains.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm import words as W
from tributary.llm.common import keyed, maybe_member, membership, row_keys, written
from tributary.llm.components import components

SHINGLE, SIMILARITY, RECALL, SEED = 5, 0.8, 0.999, 7
PLACES = 128
#: Nodes of up to so many sets are compared by brute force.
SMALL_NODE = 1024
#: An estimate from the tokens' low bytes has a standard deviation of 0.035 at 0.8; candidates are taken from this on.
CANDIDATE = 0.68
#: In a large node, a set this like the pivot leaves. What is like such a set is like the pivot too (Jaccard
#: distance is a metric), so everything from LINKED on is linked with the pivot, and no pair is lost.
LEAVES, LINKED = 0.8, 0.45
#: Pivots of a large node, so that its large groups leave at once and aren't drawn again and again.
PIVOTS = 8
#: Places drawn in a large node under the root, and, on average, in one further down. At 0.8 a pair shares 1.13 children
#: of the latter, and a set of the former stays with it with probability 0.86 at any depth; sets less like each other
#: than 0.7 share less than one, so that the recursion ends.
FIRST_DRAW, DRAW = 4, 1.41
#: Levels of large nodes that the target recall is kept for.
DEPTH = 16
#: Of an exact comparison: sets and bytes of a block.
BLOCK_SETS, BLOCK_BYTES = 512, 4 << 20

_U = np.uint64
_I64 = pa.int64()


# --- sets and tokens --------------------------------------------------------------------------------------


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, with their rows.

    Words are runs of letters, digits and non-ASCII characters, in small letters. A row of fewer than
    ``n`` words has one shingle of all its words; one without words has none."""
    data, offsets = W.utf8(column)
    found = W.split(W.lower(data), offsets, W.NOT_WORD)
    h, at = W.windows(found, n)
    row = found.row[at]
    first = found.per_row()
    for r in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n)):
        whole = np.zeros(1, _U)
        for k in range(first[r], first[r + 1]):
            whole = W.mix(whole + found.hash[k:k + 1])
        h, row = np.append(h, whole), np.append(row, r)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[fresh], row[fresh]


def tokens(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """The embedding, rows x PLACES: the top bits of a hash are its place, the least one there is kept; an
    empty place takes over another's token, chosen by its number alone."""
    place = (h >> _U(57)).astype(np.int64)
    least = np.ones(len(h), bool)
    least[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    out = np.zeros((rows, PLACES), np.uint32)
    full = np.zeros((rows, PLACES), bool)
    out[row[least], place[least]] = ((W.mix(h[least]) >> _U(32))).astype(np.uint32)
    full[row[least], place[least]] = True
    r, c = np.nonzero(~full & full.any(axis=1)[:, None])
    start, step = c.copy(), 0
    while len(r):
        step += 1
        other = (W.mix((start * 1_000_003 + step).astype(_U)) % _U(PLACES)).astype(np.int64)
        if step > 40:  # sets with hardly any token: walk on
            other = (start + step) % PLACES
        hit = full[r, other]
        out[r[hit], c[hit]] = out[r[hit], other[hit]]
        r, c, start = r[~hit], c[~hit], start[~hit]
    return out


def set_ids(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each row's set (equal sets, equal hashes), and its size."""
    size = np.bincount(row, minlength=rows)
    sums = np.concatenate(([_U(0)], np.cumsum(W.mix(h), dtype=_U)))
    bounds = np.searchsorted(row, np.arange(rows + 1))
    return W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(_U)), size


EMBEDDED = "doc_id long, text_hash long, sid long, size int, nodes array<long>"


def _embed(draws: int, seed: int):
    """Of each document the id and size of its set, and the nodes it goes to from the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            h, row = shingle_sets(batch.column("text"))
            sid, size = set_ids(h, row, rows)
            embedded = tokens(h, row, rows)
            root = np.full(rows, W.mix(np.array([seed * 1000], _U))[0])
            owner, nodes = children(root, embedded, draws, seed)
            bounds = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(sid.view(np.int64), mask=size == 0),
                pa.array(size.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(nodes.view(np.int64)))],
                names=["doc_id", "text_hash", "sid", "size", "nodes"])
    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, row = shingle_sets(batch.column("text"))
        embedded = tokens(h, row, batch.num_rows)
        yield pa.RecordBatch.from_arrays([
            batch.column("sid"), pa.array([t.tobytes() for t in embedded], pa.binary()),
            pa.array([t.tobytes() for t in embedded.astype(np.uint8)], pa.binary())], names=["sid", "tokens", "code"])


# --- recursion --------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PLACES)


def _pivot_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each row PIVOTS set ids and low bytes of their tokens; a node with fewer pivots repeats its last."""
    lists = [(x + x[-1:] * PIVOTS)[:PIVOTS] for x in column.to_pylist()]
    sid = np.array([[p["pivot"] for p in x] for x in lists], np.int64)
    return sid, np.frombuffer(b"".join(p["code"] for x in lists for p in x), np.uint8).reshape(-1, PIVOTS, PLACES)


def children(node: np.ndarray, embedded: np.ndarray, draws: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (ascending) and the child nodes they go to: ``draws`` different places on average, one less or more if
    that isn't whole, never none. Places and their number follow from the node, so are alike for all its sets."""
    salts = W.mix(np.arange(PLACES, dtype=_U) + _U(seed << 32))
    draw = W.mix(node[:, None] ^ salts[None, :])
    whole = min(max(1, int(draws)), PLACES)
    more = W.mix(node + _U(seed)) < _U(int(2.0 ** 64 * max(0.0, draws - whole)))
    most = min(whole + 1, PLACES)
    places = np.sort(np.argpartition(draw, most - 1, axis=1)[:, :most], axis=1) if len(node) else np.zeros((0, most), int)
    # the last place by its draw is the one that some nodes leave out
    last = np.take_along_axis(draw, places, axis=1).argmax(axis=1) if len(node) else np.zeros(0, int)
    taken = more[:, None] | (np.arange(most)[None, :] != last[:, None]) if most > whole else np.ones(places.shape, bool)
    row, k = np.nonzero(taken)
    place = places[row, k]
    child = W.mix(draw[row, place] + W.mix(embedded[row, place].astype(_U) + salts[place]))
    return row, child


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of token rows, from the low byte of each token."""
    match = (a.astype(np.uint8) == b.astype(np.uint8)).mean(axis=-1)
    return (match - 1 / 256) / (1 - 1 / 256)


STEP = "node long, sid long, other long, tied long"


def _pivot_step(draws: float, seed: int):
    """Rows of large nodes with their pivots: links (node null) and, of the sets that stay, child nodes. ``tied`` is
    the least pivot that the set is linked with. Pivots that a set is linked with are linked with one another through
    the least of them, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            embedded, (pivots, codes) = _matrix(batch.column("tokens")), _pivot_codes(batch.column("pivots"))
            sid = batch.column("sid").to_numpy()
            like = alike(embedded[:, None, :], codes)
            own = (sid[:, None] == pivots).any(axis=1)
            near = (like >= LINKED) | (sid[:, None] == pivots)
            link = near.any(axis=1)
            least = np.where(near, pivots, np.iinfo(np.int64).max).min(axis=1)
            pairs = np.unique(np.stack([pivots[near], np.repeat(least, PIVOTS).reshape(near.shape)[near]], axis=1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            some = link & ~own
            a, b = np.append(sid[some], pairs[:, 0]), np.append(least[some], pairs[:, 1])
            none = pa.nulls(len(a), _I64)
            names = ["node", "sid", "other", "tied"]
            yield pa.RecordBatch.from_arrays([none, pa.array(a), pa.array(b), none], names=names)
            stay = np.flatnonzero((like < LEAVES).all(axis=1) & ~own)
            node = batch.column("node").to_numpy().view(_U)[stay]
            row, child = children(W.mix(node), embedded[stay], draws, seed)
            row = stay[row]
            yield pa.RecordBatch.from_arrays([
                pa.array(child.view(np.int64)), pa.array(sid[row]), pa.nulls(len(row), _I64),
                pa.array(least[row], mask=~link[row])], names=names)
    return run


def _stars(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, first of its component) that connect what a symmetric matrix connects."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label, len(linked)).min(axis=1, initial=len(linked))
        least = np.minimum(label, least)
        least = least[least]
        if (least == label).all():
            break
        label = least
    some = np.flatnonzero(label != np.arange(len(linked)))
    return some, label[some]


def _brute_force(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows hold the sets of a small node, all compared; links that connect the similar ones."""
    for batch in batches:
        a, b = [], []
        for members in batch.column("members").to_pylist():
            sid = np.array([m["sid"] for m in members])
            code = np.frombuffer(b"".join(m["code"] for m in members), np.uint8).reshape(-1, PLACES)
            near = np.stack([alike(code, row) for row in code]) >= CANDIDATE
            i, j = _stars(near)
            a += sid[i].tolist()
            b += sid[j].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, _I64), pa.array(b, _I64)], names=["a", "b"])


def _nodes(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``members`` (node, sid, tied) the nodes that others share: the sets of each small one as a list (sids), and
    the large ones (node, pivots: PIVOTS of its sets or fewer, ascending). Both written.

    Nodes whose sets are all linked with one and the same pivot are in one group already, and go. Lists are made of
    small nodes only, so they are bounded; of large nodes there is at most one for every ``SMALL_NODE`` members."""
    tied = [F.count("*").alias("n"), F.count("tied").alias("ties"), F.min("tied").alias("least"), F.max("tied").alias("most")]
    open_ = "n > 1 and (ties < n or least != most)"
    pivots = [F.min(F.struct(F.xxhash64(F.lit(k), "node", "sid").alias("h"), "sid"))["sid"] for k in range(PIVOTS)]
    large = written(members.groupBy("node").agg(*tied, F.array_sort(F.array_distinct(F.array(*pivots))).alias("pivots"))
                    .where(F.col("n") > SMALL_NODE).select("node", "pivots", F.expr(open_).alias("open")), "path-large")
    small = members.join(large.select("node"), "node", "left_anti").groupBy("node").agg(
        *tied, F.sort_array(F.collect_set("sid")).alias("sids")).where(open_).where("size(sids) > 1").select("sids")
    return written(small.distinct(), "path-small"), large.where("open").select("node", "pivots")


def candidate_links(lists: DataFrame, large: DataFrame, members: DataFrame, sets: DataFrame, seed: int) -> DataFrame:
    """Links (a, b) that connect all similar pairs, with the recall of the draws.

    ``lists`` and ``large`` are the nodes under the roots (as ``_nodes`` gives them), ``members`` the rows (node, sid) of
    the large ones at least, ``sets`` the tokens of all their sets. What is compared of the pivots' tokens goes to the
    table of large nodes, so that each row of a large node is joined once by its node and once by its set."""
    found, small, draws = [], [lists], FIRST_DRAW
    while not large.isEmpty():
        pivots = (large.select("node", F.explode("pivots").alias("pivot"))
                  .join(sets.select(F.col("sid").alias("pivot"), "code"), "pivot")
                  .groupBy("node").agg(F.collect_list(F.struct("pivot", "code")).alias("pivots")))
        rows = members.select("node", "sid").join(pivots, "node").join(sets.select("sid", "tokens"), "sid")
        step = written(rows.select("node", "sid", "tokens", "pivots")
                       .mapInArrow(_pivot_step(draws, seed + 1), STEP), "path-step")
        found.append(step.where("node is null").select(F.col("sid").alias("a"), F.col("other").alias("b")))
        members = step.where("node is not null").select("node", "sid", "tied")
        lists, large = _nodes(members)
        small.append(lists)
        draws = DRAW
    lists = small[0]
    for x in small[1:]:
        lists = lists.union(x)
    # draws bring the same sets together again and again: each list is compared once
    lists = lists.distinct().withColumn("list", F.xxhash64("sids"))
    groups = (lists.select("list", F.explode("sids").alias("sid")).join(sets.select("sid", "code"), "sid")
              .groupBy("list").agg(F.collect_list(F.struct("sid", "code")).alias("members")).select("members"))
    links = groups.mapInArrow(_brute_force, "a long, b long")
    for x in found:
        links = links.union(x)
    return links


# --- exact comparison -------------------------------------------------------------------------------------


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, row = shingle_sets(batch.column("text"))
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([
            batch.column("sid"), pa.array([h[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())],
            names=["sid", "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shared members of every two sets: products of their incidence matrix, taken in pieces."""
    out = np.zeros((len(sets), len(sets)), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(times), -1)
    rank[shared] = np.arange(len(shared))
    column = rank[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    piece = 4096
    for lo in range(0, len(shared), piece):
        i, j = np.searchsorted(column, (lo, lo + piece))
        part = np.zeros((len(sets), piece), np.float32)
        part[owner[i:j], column[i:j] - lo] = 1
        out += (part @ part.T).astype(np.int64)
    return out


VERIFIED = "sid long, copies long, texts long, other long"


def _verify(similarity: float):
    """Of each pair of blocks: for each set the links it has there, and links that connect them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, copies, texts, other = [], [], [], []
            for i, j, members in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "members"))):
                members = [m for m in members if m["block"] in (i, j)]
                sets = [np.frombuffer(m["shingles"], _U) for m in members]
                size = np.array([len(s) for s in sets])
                both = overlaps(sets)
                link = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
                block = np.array([m["block"] for m in members])
                np.fill_diagonal(link, False)
                if i != j:
                    link &= block[:, None] != block[None, :]
                own = np.array([m["sid"] for m in members])
                n = np.array([m["copies"] for m in members])
                some = np.flatnonzero(link.any(axis=1))
                sid += own[some].tolist()
                copies += (link[some] @ n).tolist()
                texts += link[some].sum(axis=1).tolist()
                other += [None] * len(some)
                a, b = _stars(link)
                sid += own[a].tolist()
                copies += [0] * len(a)
                texts += [0] * len(a)
                other += own[b].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, _I64) for x in (sid, copies, texts, other)],
                                             names=["sid", "copies", "texts", "other"])
    return run


def verified_links(groups: DataFrame, sets: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Exact links within the candidate ``groups`` (node, root): rows of VERIFIED, written.

    A group is cut into blocks of bounded sets and bytes, and each two blocks meet in one row, so that
    no task holds more than two blocks however large the group."""
    members = groups.withColumnRenamed("node", "sid").join(sets.select("sid", "size", "copies"), "sid")
    shape = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(
        F.sum(F.col("size").cast("long") * 8) / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = members.join(shape, "root").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    hashed = texts.mapInArrow(_sets, "sid long, shingles binary")
    pairs = placed.join(hashed, "sid").select(
        "root", "sid", "copies", "block", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k"))
    met = pairs.groupBy("root", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j")).agg(
        F.collect_list(F.struct("sid", "copies", "block", "shingles")).alias("members"))
    return written(met.where("size(members) > 1").select("i", "j", "members")
                   .mapInArrow(_verify(similarity), VERIFIED), "links-verified")


# --- the join ---------------------------------------------------------------------------------------------


def draws_for(recall: float, similarity: float = SIMILARITY) -> int:
    """Places the root draws so that a pair at ``similarity`` meets in a small node, or is linked on its way, with
    this probability, with large nodes on DEPTH levels, averaged over the spread of the share of tokens it agrees in."""
    spread = math.sqrt(similarity * (1 - similarity) / PLACES)
    z = np.linspace(-3.5, 3.5, 71)
    weight = np.exp(-z * z / 2) / np.exp(-z * z / 2).sum()
    agree = np.clip(similarity + z * spread, 0.05, 0.999)
    lost = np.zeros_like(agree)
    for _ in range(DEPTH - 1):  # of a pair in a node: no child keeps it
        out = 1 - agree + agree * lost
        lost = out * (1 - (DRAW - 1) + (DRAW - 1) * out)
    lost = (1 - agree + agree * lost) ** FIRST_DRAW
    k = 1
    while k < PLACES and (weight * (1 - agree + agree * lost) ** k).sum() > 1 - recall:
        k += 1
    return k


def jaccard_classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                    seed: int = SEED) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id, text; other columns are ignored).

    Returns one row for each row: doc_id, text_hash (of the text, so that (doc_id, text_hash) names the
    row), size (its shingles), class_id (the least doc_id that its links reach, null only if all ids are null), class_hash (of
    the document that stays for the class: least doc_id, then least text_hash), n_links (other
    rows whose shingle sets are at least ``similarity`` like its own) and n_texts (distinct other sets among
    them). Rows with equal sets are links of each other, but compared once for all. A text without words (null
    or empty) has no links and is a class of its own id. An empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))
                       .alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    embedded = written(rows.mapInArrow(_embed(draws_for(recall, similarity), seed), EMBEDDED), "embedded")
    sets = written(embedded.where("sid is not null").groupBy("sid").agg(
        F.count("*").alias("copies"), F.first("size").alias("size"), F.min("text_hash").alias("text_hash"),
        F.first("nodes").alias("nodes")), "sets")
    members = sets.select(F.explode("nodes").alias("node"), "sid", F.lit(None).cast("long").alias("tied"))
    lists, large = _nodes(members)
    members = written(members.select("node", "sid").join(large, "node", "left_semi"), "path-nodes")
    # from here on only sets that share a node with another matter; one text for each of them
    wanted = lists.select(F.explode("sids").alias("sid")).union(members.select("sid")).distinct().join(
        sets.select("sid", "text_hash"), "sid")
    wanted = written(wanted, "wanted")
    some = rows.select("text_hash", "text").where(maybe_member(membership(wanted, "text_hash"), F.col("text_hash")))
    texts = some.groupBy("text_hash").agg(F.first("text").alias("text")).join(wanted, "text_hash").select("sid", "text")
    texts = written(texts, "wanted-texts")
    embeddings = written(texts.mapInArrow(_tokens, "sid long, tokens binary, code binary"), "tokens")
    groups = written(components(candidate_links(lists, large, members, embeddings, seed)), "candidate-groups")
    verified = verified_links(groups, sets, texts, similarity)
    near = verified.groupBy("sid").agg(F.sum("copies").alias("near"), F.sum("texts").alias("texts"))
    roots = components(verified.where("other is not null").select(F.col("sid").alias("a"), F.col("other").alias("b")))
    known = sets.select("sid", "copies").join(near, "sid", "left").join(
        roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", F.coalesce("root", "sid").alias("root"),
        (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_texts"))
    placed = written(embedded.drop("nodes").join(known, "sid", "left"), "placed")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = placed.where("sid is not null").groupBy("root").agg(F.min(key).alias("kept"))
    return placed.join(kept, "root", "left").select(
        "doc_id", "text_hash", "size",
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("class_id"),
        F.when(F.col("sid").isNull(), F.col("text_hash")).otherwise(F.col("kept.text_hash")).alias("class_hash"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"))


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs``, all columns as they are, with one row of each near-duplicate class: the one with the least
    doc_id, then the least hash of its text. Of rows equal in both, one stays. Texts without words stay."""
    classes = written(keyed(jaccard_classes(docs, similarity)), "classes")
    rows, keys = row_keys(docs)
    own = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    listed = classes.where("size > 0").groupBy(*keys).agg(F.max(own).alias("first"), F.count("*").alias("times"))
    # what isn't listed here stays as it is: the only row of its key, and first in its class
    listed = written(listed.where("not first or times > 1"), "not-alone")
    test = maybe_member(membership(listed, "row_hash"), F.col("row_hash"))
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("row_hash"))
    some = rows.where(test).join(listed, keys, "left").withColumn("turn", turn)
    some = some.where(F.col("first").isNull() | (F.col("first") & (F.col("turn") == 1)))
    return rows.where(~test).select("row.*").union(some.select("row.*"))
