"""Near-duplicate classes: fast similarity sketching, banding, exact verification.

A text's set is its distinct 5-word shingles (words lower-cased A-Z); a shorter text is
one shingle, its whole word sequence. Texts are linked when 100 * intersection >= 75 *
union; classes are the connected components of the links.

1. Sketch. Round i of 2t rounds hashes every shingle into one of t bins with a value in
   [i, i + 1) and each bin keeps its minimum; in the last t rounds all shingles go to bin
   i - t, so every coordinate is filled. A text leaves after the first round that has
   filled all its bins, so a long text needs one or two rounds. The minima behave like t
   draws without replacement, which concentrates better than independent hashes.
2. Texts with equal sets (a 128-bit digest) are one class at once; only its smallest id
   goes on, so copies never meet each other again.
3. Banding: ``BANDS`` bands of ``ROWS`` coordinates. At similarity 0.75 a pair shares no
   band with probability (1 - 0.75^4)^32 = 5e-6.
4. Star pass: the smallest id of a band bucket is its centre. Each text tries one centre,
   the one that it shares most bands with, and these pairs are verified on their full
   shingle sets. Linked texts are merged, which settles most buckets.
5. Rest pass: a bucket that still holds several classes compares its members across
   classes, in blocks of bounded size. Pairs whose sketch estimate is at least
   ``MIN_ESTIMATE`` (a pair at 0.75 falls below it with probability under 1e-6) are
   verified on their full sets there, in the first band they share, and only links that
   join two classes leave the task. So every link between candidates is found up to
   connectivity, and no bucket is expanded into its pairs.
6. Components by repeated minimum over links, each round written to shared storage.

Defined cases: null text, or a text without words, has an empty set, is linked with
nothing and is its own component; repeated rows share the component of their id; a null
id forms rows of its own (component null, kept); an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, Words, broadcast_if_small, free_names, map_texts, mix, read_table, save, window_hashes

WIDTH = 5
PERCENT = 75
COORDS = 128
ROWS = 4
BANDS = COORDS // ROWS
MIN_ESTIMATE = 0.55
BLOCK = 1024                # members of a bucket in a block of the rest pass
BLOCK_SHINGLES = 1 << 20    # and about so many shingles


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of text d are
    ``hashes[first[d]:first[d + 1]]``."""
    words = Words(texts)
    h = words.hashes(lower=True)
    valid = words.left() >= width
    doc = words.doc_of_word()
    value, owner = window_hashes(h, width)[valid], doc[valid]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    whole = [int(mix(window_hashes(h[words.first[d]:words.first[d + 1]], int(words.counts[d]))[:1],
                     100 + int(words.counts[d]))[0]) for d in short]
    value = np.concatenate([value, np.array(whole, dtype=np.uint64)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketches(values: np.ndarray, first: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """(texts, coords) fast similarity sketch; rows of empty sets are all ones bits."""
    n = len(first) - 1
    out = np.full((n, coords), ~np.uint64(0), dtype=np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(first))
    shift, low = np.uint64(64 - (coords - 1).bit_length()), np.uint64((1 << 48) - 1)
    for i in range(2 * coords):
        if not len(values):
            break
        x = mix(values, 1000 + i)
        coordinate = (x >> shift).astype(np.int64) if i < coords else np.full(len(x), i - coords)
        np.minimum.at(flat, owner * coords + coordinate, (np.uint64(i) << np.uint64(48)) | (x & low))
        todo = (out == ~np.uint64(0)).any(axis=1)[owner]
        if not todo.all():
            values, owner = values[todo], owner[todo]
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _sketch_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, sketch): set size, set digest, band keys and one
    byte per coordinate."""
    schema = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary"

    def make():
        def f(batch, texts):
            values, first = shingle_sets(texts)
            n = np.diff(first)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(values, seed))]) for seed in (11, 12)]
            d1, d2 = (_signed(mix(s[first[1:]] - s[first[:-1]], 13) ^ mix(n.astype(np.uint64), 14)) for s in sums)
            sketch = sketches(values, first)
            keys = np.zeros((len(texts), BANDS), dtype=np.uint64)
            for r in range(ROWS):
                keys = mix(keys ^ sketch[:, r::ROWS], 20 + r)
            keys = mix(keys ^ np.arange(BANDS, dtype=np.uint64), 30)
            small = (mix(sketch, 40) >> np.uint64(56)).astype(np.uint8)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(texts) * BANDS + 1, BANDS), pa.int32()),
                                             pa.array(_signed(keys).reshape(-1)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(d1), pa.array(d2), bands,
                 pa.array([r.tobytes() for r in small], pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"])
        return f
    return map_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                     "text", make, schema)


def _packed_texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, packed) for the given ids: the lower-cased text, compressed for the shuffle."""
    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .join(broadcast_if_small(ids), "doc_id", "left_semi")

    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def f(batch, texts):
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pack.compress(t.lower()) for t in texts], pa.binary())],
                ["doc_id", "packed"])
        return f
    return map_texts(wanted, "text", make, "doc_id long, packed binary").dropDuplicates(["doc_id"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted distinct arrays reach the similarity."""
    n = len(a) + len(b)
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
    return 100 * common >= PERCENT * (n - common)


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose full shingle sets reach the similarity."""
    ids = save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "near-wanted")
    texts = save(_packed_texts(docs, ids, id_col, text_col), "near-texts")
    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("ta")), "a") \
        .join(texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep, at = np.zeros(len(left), dtype=bool), 0
            while at < len(left):
                # bounded runs of pairs, each distinct text of a run decoded once
                to, seen, size = at, {}, 0
                while to < len(left) and (size < CHUNK_BYTES or to == at):
                    for t in (left[to], right[to]):
                        if t not in seen:
                            seen[t] = len(seen)
                            size += 4 * len(t)
                    to += 1
                values, first = shingle_sets([unpack.decompress(t) for t in seen])
                for k in range(at, to):
                    i, j = seen[left[k]], seen[right[k]]
                    keep[k] = linked(values[first[i]:first[i + 1]], values[first[j]:first[j + 1]])
                at = to
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
    return joined.mapInArrow(run, "a long, b long")


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id reachable. Each
    round hangs every id on its smallest neighbour and then on that one's root, so long
    paths shrink by halves; rounds are written to shared storage."""
    edges = save(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), f"{name}-edges")
    ids = edges.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    tree = save(ids.withColumn("component", F.col("id")), f"{name}-0")
    step = 0
    while True:
        step += 1
        # edges between current classes; each class takes its smallest neighbouring class
        u = tree.select(F.col("id").alias("u"), F.col("component").alias("cu"))
        v = tree.select(F.col("id").alias("v"), F.col("component").alias("cv"))
        edges = save(edges.join(u, "u").join(v, "v").where("cu <> cv")
                     .select(F.greatest("cu", "cv").alias("u"), F.least("cu", "cv").alias("v")).distinct(),
                     f"{name}-edges-{step}")
        if edges.isEmpty():
            return tree
        up = edges.groupBy("u").agg(F.min("v").alias("p1"))
        hop = up.select(F.col("u").alias("p1"), F.col("p1").alias("p2"))
        up = up.join(hop, "p1", "left").select(F.col("u").alias("component"), F.coalesce("p2", "p1").alias("up"))
        tree = save(tree.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component")),
                    f"{name}-{step}")


def _rest_links(buckets: DataFrame) -> DataFrame:
    """Links (a, b) across classes inside the given buckets (key, band, id, component,
    n_shingles, bands, sketch, packed), in blocks of bounded size. Sketches choose the
    pairs, full sets decide, and only links that join two classes of a block come out."""
    sized = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    rows = buckets.join(sized.select("key", blocks.cast("int").alias("blocks")), "key") \
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # block x meets block y in the task of (x, y), x <= y
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda o: F.struct(F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y")))
    rows = rows.withColumn("cell", F.explode(meet)).select(
        "key", "band", "id", "component", "n_shingles", "bands", "sketch", "packed", "block", "cell.x", "cell.y")

    def compare(table: pa.Table) -> pa.Table:
        band = table.column("band")[0].as_py()
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        ids, comp, n, block = (table.column(c).to_numpy() for c in ("id", "component", "n_shingles", "block"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), COORDS)
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)
        unpack = zstandard.ZstdDecompressor()
        values, first = shingle_sets([unpack.decompress(t) for t in table.column("packed").to_pylist()])
        root = np.unique(comp, return_inverse=True)[1]
        out = []
        for i in np.flatnonzero(block == x):
            other = (root != root[i]) & (block == y)
            if x == y:
                other &= ids > ids[i]
            other &= (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i]))
            near = np.flatnonzero(other)
            # a pair belongs to the first band that it shares
            near = near[(bands[near] == bands[i]).argmax(axis=1) == band]
            same = (sketch[near] == sketch[i]).sum(axis=1)
            order = np.argsort(-same, kind="stable")
            for j in near[order][same[order] >= MIN_ESTIMATE * COORDS]:
                if root[j] != root[i] and linked(values[first[i]:first[i + 1]], values[first[j]:first[j + 1]]):
                    out.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})
    return rows.groupBy("key", "x", "y").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per input row."""
    rows = save(_sketch_rows(docs, id_col, text_col), "near-sketches")
    classes = rows.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = save(classes, "near-classes")
    key = ["d1", "d2", "n_shingles"]
    reps = save(rows.join(classes, key).where("doc_id = rep").dropDuplicates(["rep"])
                .select("rep", "n_shingles", "bands", "sketch"), "near-reps")
    exploded = reps.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    centres = exploded.groupBy("key").agg(F.min(F.struct("id", "n")).alias("centre"), F.count(F.lit(1)).alias("members")) \
        .where("members > 1").select("key", F.col("centre.id").alias("b"), F.col("centre.n").alias("nb"))
    shared = save(exploded.join(centres, "key").select("key", "band", "id", "n", "b", "nb"), "near-shared")
    # each text tries one centre, the one that it shares most bands with
    tries = shared.where("id <> b").where(f"100 * least(n, nb) >= {PERCENT} * greatest(n, nb)") \
        .groupBy("id", "b").agg(F.count(F.lit(1)).alias("bands"))
    star = save(tries.groupBy(F.col("id").alias("a")).agg(F.max(F.struct("bands", (-F.col("b")).alias("first"))).alias("best"))
                .select("a", (-F.col("best.first")).alias("b")), "near-star")
    links = save(verified(star, docs, id_col, text_col), "near-links")
    tree = components(links, "near-star-components")
    # buckets that still hold several classes
    placed = shared.select("key", "band", "id").join(tree, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo < hi").select("key")
    members = save(placed.join(mixed, "key", "left_semi"), "near-open")
    texts = save(_packed_texts(docs, save(members.select(F.col("id").alias("doc_id")).distinct(), "near-open-ids"),
                               id_col, text_col), "near-open-texts").withColumnRenamed("doc_id", "id")
    open_rows = members.join(reps.withColumnRenamed("rep", "id"), "id").join(texts, "id")
    more = save(_rest_links(open_rows), "near-more-links")
    tree = components(links.unionByName(more), "near-components")
    top = classes.join(tree, F.col("rep") == F.col("id"), "left") \
        .select(*key, F.coalesce("component", "rep").alias("component"))
    out = rows.join(top, key, "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one of smallest id. The
    texts are tested against the narrow table of dropped ids, they don't move."""
    decided = near_duplicates(docs, id_col, text_col)
    name, = free_names(docs, "_gone")
    gone = broadcast_if_small(save(decided.where("not kept").select(F.col("doc_id").alias(name)).distinct(), "near-gone"))
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM texts WHERE len(w) > 0) t),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= 75 * (a.n + b.n - common)),
links AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""
