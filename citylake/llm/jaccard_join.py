"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Documents are linked if the Jaccard similarity of their sets of ``SHINGLE``-word shingles is
at least ``SIMILARITY``. A text of fewer words is one shingle; a text without words has no
link. Copies (equal shingle sets) are one node from the start.

1. Each node gets a MinHash signature, read as ``TREES`` paths of ``PATH`` values, the keys of as many
   prefix tries. The deepest trie nodes are the equal paths; a shorter prefix's node is made from the
   nodes one value deeper, so a large group goes up as one row a tree (``_level``). A trie node links
   its children to the smallest node below it (a combined minimum and a join, never all pairs).
2. Prefixes start at the full path and are shortened by one value a round until the recall reaches
   ``TARGET_RECALL``, as estimated from the pairs met so far: a pair whose signatures agree in a
   share s of their values would be met with probability 1 - (1 - s^length)^trees, so it stands for
   one over that many links (``recall``). One more pair at the threshold keeps small tables careful. At
   ``prefix_length`` values every pair at the threshold is met with that probability, whatever the
   table holds, and shortening ends. Connected components of the links are the candidate groups.
3. Every pair inside a candidate group is verified exactly on the shingle sets. Groups are
   dealt in tiles of about ``TILE`` nodes; a task holds two tiles, whatever the group's size,
   and returns one count per node and a spanning forest of the verified links, not pairs.
4. Components of verified links are the classes.

Result: one row per document: doc_id, class_id (smallest doc_id of the class), n_links (other
documents with at least that similarity, copies counted) and n_copies (documents with the
same shingle set). Defined results: null or empty texts have class_id = doc_id and no
links; repeated rows count as copies; a null doc_id is never the smallest; extra columns are
ignored; an empty table gives an empty result. Rows that share a doc_id, or have none, are told apart by their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm import common
from citylake.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
TREES = 32
PATH = 8
TARGET_RECALL = 0.9999
#: Nodes of a large group in a tile, and of small groups together in a pack, about.
TILE = 256
PACK = 64

#: Stands for a null doc_id where the smallest comes first.
_LAST = (1 << 63) - 1


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, path: int = PATH, target: float = TARGET_RECALL) -> int:
    """The longest shared prefix that reaches the target recall for pairs at the threshold: the last round's."""
    length = path
    while length > 1 and 1 - (1 - similarity**length) ** trees < target:
        length -= 1
    return length


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    t = common.Tokens(texts)
    grams = common.gram_hash(t.hash, size)
    out = []
    for a, b in zip(t.starts.tolist(), t.ends.tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(common.gram_hash(t.hash[a:b], b - a) ^ np.uint64(b - a) if b > a else np.empty(0, np.uint64))
    return out


def _digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def met(similarity: np.ndarray | float, length: int, trees: int) -> np.ndarray | float:
    """The chance that a pair shares a prefix of that length in some tree."""
    return 1 - (1 - np.asarray(similarity, np.float64) ** length) ** trees


def recall(agreeing: dict[int, int], values: int, length: int, trees: int, similarity: float) -> float:
    """The share of links that prefixes of this length meet, from the pairs met and the values (of ``values``) they agree in."""
    n = np.array(list(agreeing.values()), np.float64)
    s = np.array(list(agreeing), np.float64) / values
    n, s = n[s >= similarity], s[s >= similarity]
    found = n.sum()
    missed = (n * (1 / met(s, length, trees) - 1)).sum() + (1 / float(met(similarity, length, trees)) - 1)
    return float(found / (found + missed)) if found else 0.0


def _signatures(trees: int, path: int):
    rng = np.random.default_rng(7)
    factor = (rng.integers(1, 1 << 32, trees * path, np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
    offset = rng.integers(0, 1 << 32, trees * path, np.uint64).astype(np.uint32)[:, None]

    def of(shingles: np.ndarray) -> bytes:
        """The paths of all trees, two bytes a value."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(trees * path, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 2048):
            h = x[None, at : at + 2048] * factor
            h += offset
            np.minimum(low, h.min(axis=1), out=low)
        return common.mix(low.astype(np.uint64)).astype(">u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in common.chunked(batches):
            sets = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(map(_digest, sets), pa.binary()), pa.array([of(s) if len(s) else None for s in sets], pa.binary())],
                ["id", "digest", "paths"],
            )

    return run


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many values of two signatures are equal, counted over a batch's pairs."""
    for batch in batches:
        one, other = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in batch.columns)
        values, n = np.unique((one == other).sum(axis=1), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.int32()), pa.array(n, pa.int64())], ["agreeing", "n"])


def _level(below: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The trie nodes (tree, prefix, head: the smallest node below) of a length, and links from the children's heads to theirs."""
    prefix = F.substring("prefix", 1, 2 * length)
    nodes = common.written(
        below.groupBy("tree", prefix.alias("prefix")).agg(F.min("head").alias("head"), F.count(F.lit(1)).alias("children")), f"trie-{length}"
    )
    parents = nodes.where("children > 1").select("tree", "prefix", F.col("head").alias("b"))
    links = below.select("tree", prefix.alias("prefix"), F.col("head").alias("a")).join(parents, ["tree", "prefix"]).where("a <> b")
    return nodes.drop("children"), common.written(links.groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("heads")), "trie-links")


def candidates(nodes: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, target: float = TARGET_RECALL, path: int = PATH) -> tuple[DataFrame, int]:
    """Links (a, b) whose components are the candidate groups of ``nodes`` (node, paths), and the length of the last round.

    A node has one link to its smallest head of a round; its other heads (one a tree at most) hang on that one too.
    """
    paths = nodes.select("node", "paths")
    level = paths.select(
        F.col("node").alias("head"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring(F.col("paths"), t * (2 * path) + 1, F.lit(2 * path)))).alias("tree", "prefix"),
    )
    links: DataFrame | None = None
    agreeing: dict[int, int] = {}
    last = prefix_length(similarity, trees, path, target)
    for length in range(path, last - 1, -1):
        level, hung = _level(level, length)
        top = F.element_at("heads", 1)
        stars = hung.select("a", top.alias("b")).union(hung.select(F.explode(F.expr("slice(heads, 2, size(heads))")).alias("a"), top.alias("b")).distinct())
        links = stars if links is None else links.union(stars)
        if length > last:
            one = paths.select(F.col("node").alias("a"), F.col("paths").alias("one"))
            other = paths.select(F.col("node").alias("b"), F.col("paths").alias("other"))
            pairs = hung.select("a", top.alias("b")).join(one, "a").join(other, "b").select("one", "other")
            seen = pairs.mapInArrow(_agreement, "agreeing int, n long").groupBy("agreeing").agg(F.sum("n").alias("n"))
            for r in seen.collect():  # a row per number of agreeing values
                agreeing[r["agreeing"]] = agreeing.get(r["agreeing"], 0) + r["n"]
            if recall(agreeing, trees * path, length, trees, similarity) >= target:
                break
    return links, length


def _member_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the nodes' first documents (digest told apart if doc_ids repeat)."""
    for batch in batches:
        rest = batch.select(["node", "digest"]).to_pylist()
        at = 0
        for _, texts in common.chunked(iter([batch.select(["node", "text"])])):
            sets = shingle_sets(texts)
            keep = [k for k, s in enumerate(sets) if _digest(s) == rest[at + k]["digest"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([rest[at + k]["node"] for k in keep], pa.int64()), pa.array([sets[k].tobytes() for k in keep], pa.binary())],
                ["node", "shingles"],
            )
            at += len(texts)


def _verify(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        """Exact similarities between the two tiles of a group (or inside one)."""
        nodes = table["node"].to_numpy()
        _, keep = np.unique(nodes, return_index=True)  # a node whose row was repeated counts once
        nodes = nodes[keep]
        copies = table["copies"].to_numpy()[keep]
        side = table["side"].to_numpy()[keep]
        raw = table["shingles"].to_pylist()
        sets = [np.frombuffer(raw[k], np.uint64) for k in keep]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = n[column] > 1
        owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common_n = np.zeros((len(sets), len(sets)), np.float64)
        last = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, last, 8192):
            a, b = np.searchsorted(column, (at, at + 8192))
            x = np.zeros((len(sets), min(8192, last - at)), np.float32)
            x[owner[a:b], column[a:b] - at] = 1
            common_n += x @ x.T
        union = sizes[:, None] + sizes[None, :] - common_n
        linked = common_n >= similarity * union - 1e-9
        np.fill_diagonal(linked, False)
        if len(np.unique(side)) > 1:
            linked &= side[:, None] != side[None, :]
        elif table["first_tile"][0].as_py() != table["second_tile"][0].as_py():
            linked[:] = False
        degree = linked @ copies
        has = np.flatnonzero(degree)
        a, b = [], []
        seen = np.zeros(len(nodes), bool)
        for root in has.tolist():
            if seen[root]:
                continue
            seen[root] = True
            front = np.array([root])
            while len(front):
                reach = linked[front] & ~seen
                new = np.flatnonzero(reach.any(axis=0))
                seen[new] = True
                a += nodes[new].tolist()
                b += nodes[front[reach[:, new].argmax(axis=0)]].tolist()
                front = new
        return pa.table({
            "node": pa.array([*nodes[has].tolist(), *a], pa.int64()),
            "other": pa.array([*[None] * len(has), *b], pa.int64()),
            "links": pa.array([*degree[has].tolist(), *[0] * len(a)], pa.int64()),
        })

    return run


def join(docs: DataFrame, similarity: float = SIMILARITY, trees: int = TREES, target: float = TARGET_RECALL, tile: int = TILE) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every document."""
    found = _classes(docs, similarity, trees, target, tile)
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def _row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two numbers by which rows with equal doc_id and text, and no others, are one: a null doc_id comes last."""
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST)), F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _classes(docs: DataFrame, similarity: float, trees: int, target: float, tile: int) -> DataFrame:
    """The columns of ``join``, and stays: whether the row is (a copy by id and text of) the one that stands for its class."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    texts = docs.select(F.struct(doc_id.alias("doc_id"), _row_key(doc_id, text)[1].alias("hash")).alias("id"), text.alias("text"))
    schema = "id struct<doc_id: long, hash: long>, digest binary, paths binary"
    signed = common.written(texts.mapInArrow(_signatures(trees, PATH), schema).select("id.*", "digest", "paths"), "signatures")
    row = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("key"), "hash")
    nodes = common.written(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.min(row).alias("own"), F.count(F.lit(1)).alias("copies"), F.first("paths").alias("paths"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    groups = components(candidates(nodes, similarity, trees, target)[0])

    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    tiles = F.ceil(F.col("size") / F.lit(tile))
    sizes = common.written(sizes.withColumn("tiles", tiles.cast("long")), "groups")
    small = sizes.where("tiles = 1").agg(F.sum("size")).first()[0] or 0
    packs = common.slices_for(small, PACK)
    # Small groups share a pack; a large group is dealt over its tiles, two of which meet in a task.
    own = F.pmod(F.xxhash64("node"), F.col("tiles"))
    members = groups.join(sizes, "label").select(
        "node",
        F.when(F.col("tiles") == 1, -1 - F.pmod(F.xxhash64("label"), F.lit(packs))).otherwise(F.col("label")).alias("pack"),
        "tiles",
        own.alias("tile"),
    )
    member_nodes = nodes.select("node", "own", "digest", "copies").join(members, "node")
    member_nodes = common.written(member_nodes, "members")
    # A node meets the rows that have its first row's doc_id and text: one, however often a doc_id (or none) occurs.
    sets = (
        texts.select(F.coalesce("id.doc_id", F.lit(_LAST)).alias("key"), F.col("id.hash").alias("hash"), "text")
        .join(member_nodes.select("own.key", "own.hash", "node", "digest").hint("merge"), ["key", "hash"])
        .select("node", "digest", "text")
        .mapInArrow(_member_sets, "node long, shingles binary")
    )
    dealt = (
        sets.join(member_nodes.select("node", "copies", "pack", "tiles", "tile"), "node")
        .withColumn("against", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select(
            "node", "copies", "shingles", "pack", F.col("tile").alias("side"),
            F.least("tile", "against").alias("first_tile"), F.greatest("tile", "against").alias("second_tile"),
        )
    )
    checked = common.written(
        dealt.groupBy("pack", "first_tile", "second_tile").applyInArrow(_verify(similarity), "node long, other long, links long"),
        "links",
    )
    classes = components(checked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = checked.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    labelled = nodes.select("node", "digest", "first_doc", "own", "copies").join(classes, "node", "left").join(links, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    first = labelled.groupBy("label").agg(F.min("first_doc").alias("class_id"), F.min("own").alias("stays"))
    final = common.written(
        labelled.join(first, "label").select("digest", "class_id", "stays", F.coalesce("links", F.lit(0)).alias("links"), "copies"), "classes"
    )
    return signed.select("doc_id", "hash", "digest").join(final, "digest", "left").select(
        "hash",
        F.coalesce(F.col("stays") == row, F.lit(True)).alias("stays"),
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest doc_id (null last), then text hash.

    Rows are told apart by doc_id and text: rows with equal doc_id and text are one document, of which one row stays;
    rows that share a doc_id, or have none, but differ in text each have a verdict of their own. Texts without words are
    classes of their own.
    """
    found = common.written(_classes(docs, SIMILARITY, TREES, TARGET_RECALL, TILE).where("stays").select("doc_id", "hash"), "classes-by-document")
    key, mark = _row_key(F.col("doc_id"), F.col("text"))
    null = F.col("doc_id").isNull()
    keys = ["__doc_key", "__doc_null", "__text_hash"]
    first = found.select(F.coalesce("doc_id", F.lit(_LAST)).alias(keys[0]), null.alias(keys[1]), F.col("hash").alias(keys[2]))
    # One shuffle of the texts serves the semi-join and the repeated rows; the join is planned alike at every size.
    stay = docs.select("*", key.alias(keys[0]), null.alias(keys[1]), mark.alias(keys[2])).join(first.hint("merge"), keys, "left_semi")
    return stay.dropDuplicates(keys).drop(*keys)


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Classes and link counts of all documents."""
    return join(common.documents(spark, sf_dir))


def reference_links(rows: list[tuple[int, str | None]], similarity: float = SIMILARITY) -> dict[int, set[int]]:
    """Brute force for tests: the linked doc_ids of each doc_id."""
    sets = {d: set(zip(*(w[i:] for i in range(SHINGLE)))) if len(w := common.words(t)) >= SHINGLE else {tuple(w)} - {()} for d, t in rows}
    out: dict[int, set[int]] = {d: set() for d, _ in rows}
    by: dict[tuple, list[int]] = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    for d, s in sets.items():
        n: dict[int, int] = {}
        for x in s:
            for e in by[x]:
                n[e] = n.get(e, 0) + 1
        out[d] = {e for e, k in n.items() if e != d and k >= similarity * (len(s) + len(sets[e]) - k) - 1e-9}
    return out


#: The same links by comparing all pairs that share a shingle, in DuckDB SQL (doc_ids are unique in documents).
OP1_SQL = f"""
WITH RECURSIVE texts AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + {SHINGLE} - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE} + 2, 2))) AS k FROM texts WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b, c = x.n AND c = y.n AS same
  FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE c >= {SIMILARITY} * (x.n + y.n - c) - 1e-9
),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT doc_id, least(doc_id, coalesce(first, doc_id)) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links, (1 + coalesce(n_same, 0))::BIGINT AS n_copies
FROM texts
LEFT JOIN (SELECT a AS doc_id, min(b) AS first FROM reached GROUP BY a) USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links, count_if(same) AS n_same FROM links GROUP BY a) USING (doc_id)
"""
