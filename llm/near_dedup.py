"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification, components.

A document's set holds its distinct 5-word shingles. Two permutations make all signature
coordinates: the first scatters the shingles over a ring of 2^32 places, the second ranks the
places; coordinate k is the least rank after a circular shift by k steps. ``BANDS`` x ``ROWS``
coordinates give the band keys: at a Jaccard similarity of 0.85 a pair shares none with a chance of
4e-7. A lower threshold takes as many more bands as that chance needs. What shares a key is compared:

* equal sets are one class from the start, represented by its smallest id;
* keys of at most ``SMALL`` classes give all their pairs;
* larger keys give a star around the class that shares most keys with others. Keys with the same
  centre are one family. Where the verified star leaves a family in several components, blocks of
  it are compared block against block in tasks, each block with its own component left out of the
  comparisons with itself; a task returns the links of a spanning forest, never all pairs.

Candidates pass bounds first (set sizes, then equal coordinates, far below what the threshold can give) and
are then confirmed on full sets of 64-bit shingle hashes.

Defined results: a null or empty text or one without words has an empty set and no links; fewer
than five words are one shingle; rows of one id are one document, so what is linked with one of
them is linked with all; a null id is in no component (``component_id`` null, ``kept`` true); other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.common import in_tasks, slices, stored, table, words_of

WORDS, PERCENT = 5, 85
BANDS, ROWS = 20, 4
COORDINATES = BANDS * ROWS
#: Greatest chance that a pair at the threshold shares no band.
MISS = 4e-7
SMALL = 16
BLOCK_ROWS, BLOCK_BYTES = 2048, 32 << 20
STRIDE = np.uint32(0x9E3779B1)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"
#: Bits of the mark list of wanted ids, whatever their number; 8 MB.
MARK_BITS, MARK_BLOCK = 26, 1 << 20


def bands_for(percent: int) -> int:
    """Bands of ``ROWS`` coordinates that a threshold of ``percent`` needs."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def least_equal(percent: int, coordinates: int) -> int:
    """Equal coordinates below which a pair cannot be alike: more than six deviations under the threshold."""
    share = percent / 100
    return int(share * coordinates - 6.7 * math.sqrt(coordinates * share * (1 - share)))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    import xxhash

    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        whole = (hashes * _FACTORS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        return _mix64(np.array([whole], dtype=np.uint64))
    n = len(words) - WORDS + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        total += hashes[k : k + n] * _FACTORS[k]
    return np.unique(_mix64(total))


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Least rank of each of the shifted places, by coordinate."""
    place = (shingles >> np.uint64(32)).astype(np.uint32)
    place = (place ^ (place >> np.uint32(15))) * np.uint32(0x2C1B3C6D)  # the first permutation
    place ^= place >> np.uint32(12)
    least = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    shifts = (np.arange(coordinates, dtype=np.uint32) * STRIDE)[:, None]
    for start in range(0, len(place), 2048):
        rank = place[None, start : start + 2048] + shifts
        rank ^= rank >> np.uint32(16)  # the second permutation
        rank *= np.uint32(0x85EBCA6B)
        rank ^= rank >> np.uint32(13)
        rank *= np.uint32(0xC2B2AE35)
        rank ^= rank >> np.uint32(16)
        np.minimum(least, rank.min(1), out=least)
    return least


def sign_batches(batches: Iterator, bands: int = BANDS) -> Iterator:
    import xxhash

    salt = np.arange(1, bands + 1, dtype=np.uint64) * _FACTORS[0]
    for batch in batches:
        for part in slices(batch):
            sets = [shingle_set(t) for t in part["text"].to_pylist()]
            signatures = np.stack([signature(s, bands * ROWS) for s in sets]).astype(np.uint64).reshape(len(sets), bands, ROWS)
            keys = np.zeros((len(sets), bands), dtype=np.uint64) + salt
            for r in range(ROWS):
                keys = _mix64(keys + signatures[:, :, r] * _FACTORS[r + 1])
            some = np.array([len(s) > 0 for s in sets])
            columns = [
                part["doc_id"],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([list(k) if ok else None for k, ok in zip(keys.view(np.int64), some)], pa.list_(pa.int64())),
                pa.array([s.astype("<u2").tobytes() if ok else None for s, ok in zip(signatures & np.uint64(0xFFFF), some)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands", "signature"])


def mark_of(ids: np.ndarray) -> np.ndarray:
    return (_mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def mark_batches(batches: Iterator) -> Iterator:
    """Marks of ids as a list of bits, in blocks; only blocks that have any."""
    marks = np.zeros(1 << MARK_BITS, dtype=bool)
    for batch in batches:
        marks[mark_of(batch["rep"].to_numpy(zero_copy_only=False))] = True
    for block, part in enumerate(marks.reshape(-1, MARK_BLOCK)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(part).tobytes()], pa.binary())], ["block", "marks"])


def add_marks(group: pa.Table) -> pa.Table:
    both = np.bitwise_or.reduce(np.stack([np.frombuffer(m, np.uint8) for m in group["marks"].to_pylist()]))
    return pa.table({"block": group["block"][:1], "marks": pa.array([both.tobytes()], pa.binary())})


def set_batches(batches: Iterator, marks: np.ndarray) -> Iterator:
    """Sets of the documents whose id is marked."""
    for batch in batches:
        for part in slices(batch):
            at = mark_of(part["doc_id"].to_numpy(zero_copy_only=False))
            part = part.filter(pa.array(marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1))
            sets = [shingle_set(t).tobytes() for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sets, pa.binary())], ["rep", "shingles"])


def similar_batches(batches: Iterator, coordinates: int, least: int) -> Iterator:
    """Pairs with ``least`` equal coordinates."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u2").reshape(-1, coordinates) for c in ("signature_a", "signature_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(1) >= least))


def confirm_batches(batches: Iterator, percent: int) -> Iterator:
    """Pairs whose full sets are alike."""
    for batch in batches:
        for part in slices(batch):
            alike = []
            for a, b in zip(part["shingles_a"].to_pylist(), part["shingles_b"].to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * common >= percent * (len(x) + len(y) - common))
            yield part.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    tokens = np.intersect1d(flat[0], flat[1])
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    kept = []
    for f, r in zip(flat, rows):
        where = np.searchsorted(tokens, f)
        hit = (where < len(tokens)) & (tokens[np.minimum(where, max(len(tokens) - 1, 0))] == f) if len(tokens) else np.zeros(len(f), bool)
        order = np.argsort(where[hit], kind="stable")
        kept.append((where[hit][order], r[hit][order]))
    for start in range(0, len(tokens), 4096):
        sides = []
        for (where, r), n in zip(kept, out.shape):
            lo, hi = np.searchsorted(where, [start, start + 4096])
            side = np.zeros((n, min(4096, len(tokens) - start)), dtype=np.float32)
            side[r[lo:hi], where[lo:hi] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def forest(a: np.ndarray, b: np.ndarray, start: dict) -> list[tuple]:
    """Those of the links ``a[i], b[i]`` that join what ``start`` (node -> component) and earlier ones left apart."""
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for x, y in zip(a, b):
        p, q = root(start[x]), root(start[y])
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def compare_blocks(group: pa.Table, percent: int = PERCENT) -> pa.Table:
    """Links between two blocks of a family, or inside one, that join different components."""
    sides = [group.filter(pa.compute.equal(group["side"], s)) for s in (0, 1)]
    within = sides[1].num_rows == 0
    ids = [np.array(s["rep"].to_pylist(), dtype=np.int64) for s in sides]
    sets = [[np.frombuffer(x, np.uint64) for x in s["shingles"].to_pylist()] for s in sides]
    parts = [np.array(s["component"].to_pylist(), dtype=np.int64) for s in sides]
    second = 0 if within else 1
    links: list[tuple] = []
    start = dict(zip(np.concatenate(ids).tolist(), np.concatenate(parts).tolist()))
    common = common_counts(sets[0], sets[second])
    n = [np.array([len(s) for s in x], dtype=np.float32) for x in (sets[0], sets[second])]
    for i in range(len(ids[0])):
        alike = np.nonzero(100 * common[i] >= percent * (n[0][i] + n[1] - common[i]))[0]
        other = alike[parts[second][alike] != parts[0][i]]
        links += forest(np.full(len(other), ids[0][i]).tolist(), ids[second][other].tolist(), start) if len(other) else []
    links = forest([x for x, _ in links], [y for _, y in links], start)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def near_pairs(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of distinct pairs ``a, b`` those that set sizes and coordinates leave possible."""
    sides = [classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"signature_{s}")) for s in "ab"]
    near = pairs.join(sides[0], "a").join(sides[1], "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    coordinates = bands_for(percent) * ROWS
    call = in_tasks("llm.near_dedup", "similar_batches", coordinates, least_equal(percent, coordinates))
    return near.select("a", "b", "signature_a", "signature_b").mapInArrow(call, "a long, b long")


def wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rep, shingles`` of the ids ``rep``, worked out from their texts.

    A list of ``2 ** MARK_BITS`` bits, the same size for any corpus, tells the tasks that read the
    documents which ids may be wanted; only those go on to the join that decides.
    """
    task = lambda name, *args: in_tasks("llm.near_dedup", name, *args)
    kind = "block int, marks binary"
    blocks = wanted.select("rep").coalesce(8).mapInArrow(task("mark_batches"), kind)
    marks = np.zeros((1 << MARK_BITS) // 8, dtype=np.uint8)
    for row in blocks.groupBy("block").applyInArrow(task("add_marks"), kind).toLocalIterator():
        at = row["block"] * MARK_BLOCK // 8
        marks[at : at + MARK_BLOCK // 8] = np.frombuffer(row["marks"], np.uint8)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    found = rows.mapInArrow(task("set_batches", marks), "rep long, shingles binary").where(F.octet_length("shingles") > 0)
    return found.join(wanted.select("rep"), "rep", "left_semi").dropDuplicates(["rep", "shingles"])


def confirmed(near: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs ``a, b`` those whose full sets are alike."""
    whole = [sets.select(F.col("rep").alias(s), F.col("shingles").alias(f"shingles_{s}")) for s in "ab"]
    both = near.join(whole[0], "a").join(whole[1], "b").select("a", "b", "shingles_a", "shingles_b")
    return both.mapInArrow(in_tasks("llm.near_dedup", "confirm_batches", percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all linked nodes: the smallest node that each can reach.

    Rounds of least neighbour and pointer jump, each stored; their number grows with the logarithm
    of the longest path.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen"))
        least = labels.join(seen, "node").select("node", F.col("component").alias("before"), F.least("component", "seen").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = least.join(jump, "component", "left").select("node", "before", F.least("component", "further").alias("component"))
        after = stored(after, "labels")
        labels = after.select("node", "component")
        if after.where("before <> component").isEmpty():
            return labels


def family_links(family: DataFrame, labels: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links inside families (``centre, rep``) between different components, block against block."""
    part = family.join(labels, family["rep"] == labels["node"], "left").select("centre", "rep", F.coalesce("component", "rep").alias("component"))
    centre = labels.select(F.col("node").alias("centre"), F.col("component").alias("core"))
    part = part.join(centre, "centre", "left").withColumn("core", F.coalesce("core", "centre") == F.col("component"))
    part = part.join(sets, "rep").select("*", F.octet_length("shingles").alias("bytes"))
    part = stored(part, "families")
    size = lambda c: F.greatest(F.ceil(F.sum(F.when(c, 1).otherwise(0)) / BLOCK_ROWS), F.ceil(F.sum(F.when(c, F.col("bytes")).otherwise(0)) / BLOCK_BYTES))
    sizes = part.groupBy("centre").agg(size(~F.col("core")).cast("int").alias("rest"), size(F.col("core")).cast("int").alias("cores"))
    sizes = sizes.where("rest > 0")
    rows = part.join(sizes, "centre")
    own = F.when(F.col("core"), F.col("rest") + F.pmod(F.xxhash64("rep"), F.col("cores"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("rest"))).cast("int")
    rows = rows.withColumn("own", own)
    # a block of the rest meets every block, itself included; blocks of the core meet those of the rest
    others = F.when(F.col("core"), F.sequence(F.lit(0), F.col("rest") - 1)).otherwise(F.sequence(F.lit(0), F.col("rest") + F.col("cores") - 1))
    rows = rows.withColumn("other", F.explode(others))
    rows = rows.select("centre", "rep", "component", "shingles", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    return rows.groupBy("centre", "one", "two").applyInArrow(in_tasks("llm.near_dedup", "compare_blocks", percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; alike from ``percent`` of common shingles on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(rows.mapInArrow(in_tasks("llm.near_dedup", "sign_batches", bands_for(percent)), SIGNED), "signed")
    known = signed.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "bands", "signature"), "doc_id").alias("of"))
    classes = stored(classes.select("digest", "rep", F.col("of.n_shingles").alias("n"), "of.bands", "of.signature"), "classes")

    keyed = classes.select("rep", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    keyed = stored(keyed.join(shared, "key"), "keys")
    small = keyed.where(f"members <= {SMALL}")
    pairs = small.select("key", F.col("rep").alias("a")).join(small.select("key", F.col("rep").alias("b")), "key").where("a < b").select("a", "b")

    large = keyed.where(f"members > {SMALL}")
    weight = large.groupBy("rep").agg(F.sum("members").alias("weight"))
    centres = large.join(weight, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("centre"))
    family = stored(large.join(centres, "key").select("centre", "rep").distinct(), "family")
    star = family.where("centre <> rep").select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b"))

    reps = classes.select("rep", "n", "signature")
    near = stored(near_pairs(pairs.union(star).distinct(), reps, percent), "near-pairs")
    wanted = near.select(F.col("a").alias("rep")).union(near.select("b")).union(family.select("rep")).distinct()
    sets = stored(wanted_sets(rows, wanted), "sets")
    links = stored(confirmed(near, sets, percent), "links")
    # rows of one id that differ are one document
    same = classes.join(known.select("doc_id", "digest").distinct(), "digest").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a <> b")
    repeated = known.select("doc_id", "digest").distinct().groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    same = same.join(repeated.select(F.col("doc_id").alias("b")), "b", "left_semi").select("a", "b")
    links = links.unionByName(same)
    labels = components(links)
    if not family.isEmpty():
        labels = components(links.unionByName(family_links(family, labels, sets, percent)))
    out = signed.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left").join(labels, F.col("rep") == labels["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, and every row without an id."""
    kept = near_duplicates(docs, percent).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    place = "place"
    while place in docs.columns:
        place += "_"
    known = docs.join(kept, docs["doc_id"].cast("long") == kept["id"], "left_semi")
    order = Window.partitionBy(F.col("doc_id").cast("long")).orderBy("text")
    known = known.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)
    return known.unionByName(docs.where("doc_id IS NULL"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
