"""Near duplicates: MinHash bands propose, odd sketches screen, full shingle sets decide.

1. One pass gives each document its number of distinct shingles, two hashes of the set,
   BANDS band keys of ROWS MinHash values each, and an odd sketch: every one of the
   SAMPLES MinHash values flips one of BITS parity bits. Two sketches differ in a number
   of bits that tells their similarity (``estimate``) within a few hundredths.
2. Documents with the same set form a class; only its smallest id goes on.
3. Every band bucket links its members to its smallest one (a star, never all pairs).
   Pairs whose sizes or sketches rule the threshold out are dropped; the others are joined
   with both texts and decided on the full sets.
4. Links give components. Buckets that still hold several components are searched again:
   members outside the bucket's main component against all of it, in tiles of bounded
   size. First each proposes its few nearest partners. Then every pair that the sketches
   allow is compared inside the tile by the LOW smallest hashes of both sets: all of a set
   up to that size, so that only true links leave the task, one to each component. Larger
   sets are estimated and decided on the full sets as before. Pairs inside one component
   need no link, so afterwards no two documents that share a bucket can be linked and yet
   lie apart.

A pair at exactly the threshold shares no bucket with probability (1 - 0.8^5)^32 = 3e-6;
the sketch screen is five standard deviations wide.

Defined results: null or wordless texts have an empty set and are linked with nothing;
texts shorter than a shingle are one shingle; rows of one id count as one document; rows
without an id are linked with nothing, have a null component and are kept; extra columns
are ignored by ``near_duplicates`` and kept by ``deduplicated``; an empty table gives no rows.
``deduplicated`` decides by id and text: of rows that share both one stays, whichever, and where
one id stands on several texts each text stays or goes by its own component. Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import row_key, saved, ship, table
from anemoi.llm.components import components
from anemoi.llm.wordhash import mixed, word_hashes

BANDS, ROWS = 32, 5
SAMPLES = 256                  # MinHash values in the sketch; the first BANDS * ROWS make the bands
BITS = 1024
TILE_A, TILE_B = 1000, 4000    # sketches compared in one task
NEAREST = 4
LOW = 1024                     # smallest hashes of a set that a tile compares
_BLOCK = 1 << 15               # shingles hashed at once

_RNG = np.random.Generator(np.random.PCG64(11))
_MUL = _RNG.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_PLACE = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    total = words[:len(words) - width + 1] * _PLACE[0]
    for j in range(1, width):
        total = total + words[j:len(words) - width + 1 + j] * _PLACE[j]
    return np.unique(mixed(total, width))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """SAMPLES MinHash values (uint32) of each nonempty set, one row per set."""
    out = np.empty((len(sets), SAMPLES), dtype=np.uint32)
    i = 0
    while i < len(sets):
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= _BLOCK):
            n += len(sets[j])
            j += 1
        x = (np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32)
        at = np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        for k in range(SAMPLES):
            low = None
            for b in range(0, len(x), _BLOCK * 4):     # only a single long set has several parts
                part = x[b:b + _BLOCK * 4] * _MUL[k] + _ADD[k]
                got = np.minimum.reduceat(part, at) if len(x) <= _BLOCK * 4 else part.min(keepdims=True)
                low = got if low is None else np.minimum(low, got)
            out[i:j, k] = low
        i = j
    return out


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of BITS bits for each row of MinHash values, as uint64 words."""
    n = len(values)
    h = mixed(values.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)), 3)
    bit = (h % np.uint64(BITS)).astype(np.int64)
    flips = np.zeros((n, BITS), dtype=np.uint8)
    for k in range(SAMPLES):
        flips[np.arange(n), bit[:, k]] ^= 1
    return np.packbits(flips, axis=1, bitorder="little").view(np.uint64)


def estimate(differing) -> np.ndarray:
    """Similarity at so many differing bits: 1 - (expected flips) / (2 SAMPLES)."""
    x = np.minimum(np.asarray(differing, dtype=float), BITS / 2 - 1)
    return 1 + BITS / (4 * SAMPLES) * np.log(1 - 2 * x / BITS)


def most_differing(threshold: float) -> int:
    """Differing bits that the screen allows: five standard deviations below the threshold."""
    low = threshold - 5 * (threshold * (1 - threshold) / SAMPLES) ** 0.5 - 0.02
    return int(np.flatnonzero(estimate(np.arange(BITS // 2)) >= low)[-1]) if low > 0 else BITS


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k_text (the text's hash), n_shingles, c1, c2 (the set's hashes), bands, sketch."""
    schema = "doc_id long, k_text long, n_shingles long, c1 long, c2 long, bands array<long>, sketch binary"

    def sign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words, off = word_hashes(part.column(1), lower=True)
                sets = [shingles(words[off[i]:off[i + 1]], width) for i in range(part.num_rows)]
                full = [i for i, s in enumerate(sets) if len(s)]
                mins = minhashes([sets[i] for i in full])
                keys = np.zeros((len(full), BANDS), dtype=np.uint64)
                for b in range(BANDS):
                    k = np.full(len(full), b, dtype=np.uint64)
                    for r in range(ROWS):
                        k = mixed(k ^ mins[:, b * ROWS + r].astype(np.uint64), r)
                    keys[:, b] = k
                odd = odd_sketches(mins)
                bands, sketch = [None] * len(sets), [None] * len(sets)
                for j, i in enumerate(full):
                    bands[i], sketch[i] = keys[j].view(np.int64), odd[j].tobytes()
                c = [np.array([mixed(s, 20 + f).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                     for f in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(c[0]), pa.array(c[1]),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "k_text", "n_shingles", "c1", "c2", "bands", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       row_key(id_col, text_col)[1]).mapInArrow(sign, schema)


def _screened(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and sketches allow the threshold."""
    limit = most_differing(percent / 100)

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        p, q = (np.frombuffer(b"".join(s), dtype=np.uint64).reshape(len(s), -1) for s in (x, y))
        return pd.Series(np.bitwise_count(p ^ q).sum(axis=1) <= limit)

    side = lambda s: reps.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"),
                                 F.col("sketch").alias(f"s_{s}"))
    p = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return p.where(sizes).where(near("s_a", "s_b")).select("a", "b").distinct()


def _decided(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) with ``linked``, from the full sets of both texts."""
    def decide(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                linked, last = [], (None, None)
                wa, oa = word_hashes(part.column(2), lower=True)
                tb = part.column(3)
                for i in range(part.num_rows):
                    t = tb[i].as_py()
                    if t != last[0]:       # rows come sorted by b: a hub's set is made once
                        w, _ = word_hashes(pa.array([t], pa.string()), lower=True)
                        last = (t, shingles(w, width))
                    s = shingles(wa[oa[i]:oa[i + 1]], width)
                    both = len(np.intersect1d(s, last[1], assume_unique=True))
                    linked.append(both > 0 and 100 * both >= percent * (len(s) + len(last[1]) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(linked, pa.bool_())],
                                                 names=["a", "b", "linked"])

    side = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"t_{s}"))
    # skewed hubs are split by adaptive execution: their text repeats, not their pairs
    p = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b")
    return p.mapInArrow(decide, "a long, b long, linked boolean")


def lowest(texts: DataFrame, width: int) -> DataFrame:
    """node, c1, low: the LOW smallest hashes of each text's set, and the set's hash."""
    def low(batches):
        for batch in batches:
            words, off = word_hashes(batch.column(1), lower=True)
            sets = [shingles(words[off[i]:off[i + 1]], width) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(mixed(x, 21).sum(dtype=np.uint64).view(np.int64)) for x in sets], pa.int64()),
                 pa.array([x[:LOW].tobytes() for x in sets], pa.binary())], names=["node", "c1", "low"])

    return texts.select(F.col("doc_id").alias("node"), "text").mapInArrow(low, "node long, c1 long, low binary")


def partners(x: np.ndarray, n: int, lows: list[np.ndarray], sizes: np.ndarray, comps: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets (by their lowest hashes and sizes) may be linked with ``x`` of ``n`` shingles.

    Sets up to LOW are compared in full: one true link to each component is enough.
    Larger ones are kept where the estimate from the lowest hashes allows it.
    """
    whole = sizes <= LOW if n <= LOW else np.zeros(len(sizes), dtype=bool)
    out = []
    full = np.flatnonzero(whole)
    if len(full):
        flat = np.concatenate([lows[i] for i in full])
        at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
        both = np.add.reduceat((x[at] == flat).astype(np.int64), np.cumsum([0] + [len(lows[i]) for i in full[:-1]]))
        true = full[100 * both >= percent * (n + sizes[full] - both)]
        out.append(true[np.unique(comps[true], return_index=True)[1]])
    floor = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / LOW) ** 0.5
    for i in np.flatnonzero(~whole):
        seen, times = np.unique(np.concatenate([x, lows[i]]), return_counts=True)
        if (times[:LOW] == 2).mean() >= floor:
            out.append(np.array([i]))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _proposals(members: DataFrame, limit: int, percent: int, nearest: int | None) -> DataFrame:
    """Pairs of different components in one bucket that may be linked.

    ``members``: bk, node, comp, n_shingles, sketch, low. Members outside the bucket's main
    component (side a) meet all members (side b) in tiles; only passing pairs leave a task:
    the ``nearest`` by their sketches, or all that their lowest hashes (``partners``) allow.
    """
    per = members.groupBy("bk", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("bk").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n_all"),
                                 F.max("n").alias("n_main"))
    m = members.join(main, "bk")
    tiles_a = F.ceil((F.col("n_all") - F.col("n_main")) / TILE_A).cast("int")
    tiles_b = F.ceil(F.col("n_all") / TILE_B).cast("int")
    tile = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    a = m.where("comp <> main").withColumn("ta", tile(tiles_a)).withColumn(
        "tb", F.explode(F.sequence(F.lit(0), tiles_b - 1))).withColumn("side", F.lit(True))
    b = m.withColumn("tb", tile(tiles_b)).withColumn(
        "ta", F.explode(F.sequence(F.lit(0), tiles_a - 1))).withColumn("side", F.lit(False))

    def meet(nodes, comps, sizes, sides, sketches, lows) -> np.ndarray:
        """Passing pairs of one tile."""
        x, y = np.flatnonzero(sides), np.flatnonzero(~sides)
        got = []
        for i in x:
            bits = np.bitwise_count(sketches[y] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            ok = np.flatnonzero((bits <= limit) & (comps[y] != comps[i])
                                & (100 * np.minimum(sizes[y], sizes[i]) >= percent * np.maximum(sizes[y], sizes[i])))
            if nearest is None and len(ok):
                ok = ok[partners(lows[i], sizes[i], [lows[k] for k in y[ok]], sizes[y[ok]], comps[y[ok]], percent)]
            elif len(ok) > (nearest or 0):
                ok = ok[np.argsort(bits[ok], kind="stable")[:nearest]]
            if len(ok):
                got.append(np.column_stack([np.full(len(ok), nodes[i]), nodes[y[ok]]]))
        return np.concatenate(got) if got else np.zeros((0, 2), dtype=np.int64)

    def compare(batches):
        """Tiles come whole and one after another; the last of a batch waits for the next."""
        held = None
        for batch in _and_none(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held is None or not len(held):
                continue
            keys = np.column_stack([held.column(c).to_numpy() for c in ("bk", "ta", "tb")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            whole = len(held) if batch is None else (cuts[-1] if len(cuts) else 0)
            if whole:
                part = held.slice(0, whole)
                nodes, comps, sizes = (part.column(c).to_numpy() for c in ("node", "comp", "n_shingles"))
                sides = part.column("side").to_numpy()
                sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), dtype=np.uint64).reshape(whole, -1)
                lows = [np.frombuffer(x, dtype=np.uint64) for x in part.column("low").to_pylist()]
                edges = [0, *cuts[cuts < whole].tolist(), whole]
                got = np.concatenate([meet(nodes[i:j], comps[i:j], sizes[i:j], sides[i:j], sketches[i:j], lows[i:j])
                                      for i, j in zip(edges, edges[1:])])
                got = np.sort(got, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])
                held = held.slice(whole)

    cols = ["bk", "ta", "tb", "side", "node", "comp", "n_shingles", "sketch", "low"]
    tiles = a.select(cols).unionAll(b.select(cols)).repartition("bk", "ta", "tb").sortWithinPartitions("bk", "ta", "tb")
    return tiles.mapInArrow(compare, "a long, b long").distinct()


def _and_none(batches):
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return _judged(docs, width, percent, id_col, text_col).drop("k_text")


def _judged(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with the hash of each row's text."""
    ship(docs.sparkSession)
    sig = saved(signatures(docs, width, id_col, text_col), "signatures")
    full = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = saved(full.groupBy("c1", "c2").agg(F.min("doc_id").alias("node")), "classes")
    reps = saved(full.join(classes.select("c1", "c2", F.col("node").alias("doc_id")).distinct(), ["c1", "c2", "doc_id"])
                 .withColumnRenamed("doc_id", "node").dropDuplicates(["node", "c1", "c2"]), "reps")
    bands = reps.select("node", F.explode("bands").alias("bk"))
    hubs = (bands.groupBy("bk").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
            .where("hub <> top").select("bk", "hub"))
    # members of buckets with company; everything after reads this table, not all bands
    bands = saved(bands.join(hubs, "bk"), "buckets")
    stars = _screened(bands.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(),
                      reps, percent)
    stars = saved(stars, "stars")
    ids = bands.select(F.col("node").alias("doc_id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = saved(texts.join(ids, "doc_id", "left_semi").distinct(), "texts")
    tried = saved(_decided(stars, texts, width, percent), "decided")
    labels = components(tried.where("linked"))

    limit = most_differing(percent / 100)
    for nearest in (NEAREST, None):
        m = (bands.select("bk", "node").join(labels, "node", "left")
             .select("bk", "node", F.coalesce("comp", "node").alias("comp")))
        mixed_up = m.groupBy("bk").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bk")
        m = m.join(mixed_up, "bk").join(reps.select("node", "c1", "n_shingles", "sketch"), "node")
        if nearest is None:
            nodes = m.select(F.col("node").alias("doc_id")).distinct()
            low = saved(lowest(texts.join(nodes, "doc_id", "left_semi"), width), "lowest")
            m = m.join(low, ["node", "c1"])
        else:
            m = m.withColumn("low", F.lit(b""))
        m = saved(m, "members")
        if m.isEmpty():
            break
        pairs = saved(_proposals(m, limit, percent, nearest).join(
            tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            # the nearest were all tried before: partners beyond them are left to the next round
            continue
        more = saved(_decided(pairs, texts, width, percent), "decided")
        tried = tried.unionAll(more)
        if not more.where("linked").isEmpty():
            labels = components(tried.where("linked"))

    node = (sig.join(classes, ["c1", "c2"], "left").join(labels, "node", "left"))
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "node", "doc_id"))
    return (node.withColumn("component_id", comp)
            .select("doc_id", "k_text", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, with all its columns, for each text with the smallest id of its component."""
    key = ["k_id", "k_text"]
    judged = _judged(docs, width, percent, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k_id"), "k_text", "kept")
    judged = saved(judged.groupBy(key).agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR n > 1"),
                   "judged")
    rows = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col))
    once = rows.join(judged.select(key), key, "left_anti")
    repeated = rows.join(judged.where("kept").select(key), key, "left_semi").dropDuplicates(key)
    return once.unionByName(repeated).select("row.*")


def op8_near_dup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def oracle(width: int) -> str:
    return r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + WIDTH - 1), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - WIDTH + 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""".replace("WIDTH", str(width))


ORACLE = oracle(4)
