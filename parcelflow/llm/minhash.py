"""Near-duplicate components: MinHash banding, sequential Bayesian pruning, exact verification.

1. Each document becomes its set of word shingles, hashed to 64 bits, and a MinHash sketch. Documents of one set are one
   class, a node of the graph.
2. Bands deal the classes into buckets. Each bucket's smallest node is its hub; (hub, member) pairs are as many as members.
3. Pairs are compared by batches of the signature. After each batch a pair is dropped if the posterior probability that
   its similarity reaches the threshold is below MISS. Survivors are verified on the full shingle sets.
4. Verified links make components. In buckets that still hold several components, pairs across components are compared
   in blocks of bounded size inside tasks: once, in the first band they share, by the same sequential test, and survivors
   on their full sets. The hub's component, as a rule nearly all of a crowded bucket, is not compared with itself, so its
   members are copied only for each block of the others. A link found there joins its components at once, so what leaves a
   task is at most a link for each member. So no link between candidates is lost, and no bucket's pairs are ever rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, drop_rows, gives_back, id_text, key_filter, maybe_in, row_hash, shared_table, with_plain_names
from .components import connected_components
from .textbytes import NOT_SPACE, U64, buffers, mix, slices, words

SHINGLE = 5
#: Probability that banding misses a pair at the threshold, and that the sequential test drops it in one batch.
BAND_MISS, MISS = 1e-5, 1e-6
MOST_HASHES, BATCH = 352, 32
#: Members of a bucket, and shingles of theirs, that one side of a block holds.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20

_rng = np.random.Generator(np.random.PCG64(7))
_MUL = _rng.integers(0, 1 << 31, MOST_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, MOST_HASHES, dtype=np.uint32)
_WORD_KEYS = _rng.integers(0, 1 << 63, max(SHINGLE, 16), dtype=U64) * U64(2) + U64(1)


def band_plan(threshold: float) -> tuple[int, int]:
    """(rows, bands): as many rows as MOST_HASHES allow while a pair at the threshold is missed with BAND_MISS at most."""
    found = (1, 1)
    for rows in range(1, 16):
        bands = math.ceil(math.log(BAND_MISS) / math.log1p(-(threshold**rows)))
        if rows * bands <= MOST_HASHES:
            found = (rows, bands)
    return found


def least_matches(threshold: float, hashes: int) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): with fewer, P(similarity >= threshold | matches) < MISS under a uniform prior.

    Signatures keep 8 bits, so different values agree with probability 1/256. The posterior tail of Beta(m + 1, n - m + 1)
    at t is the binomial probability of at most m successes in n + 1 trials.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        total, m = 0.0, -1
        while True:
            m += 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
            if total >= MISS:
                break
        out.append((n, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs of signature rows that pass every batch."""
    alive, seen, matches = np.arange(len(left)), 0, np.zeros(len(left), np.int32)
    for n, least in needed:
        matches = matches + (left[alive, seen:n] == right[alive, seen:n]).sum(1, dtype=np.int32)
        keep = matches >= least
        alive, matches, seen = alive[keep], matches[keep], n
        if not len(alive):
            break
    return alive


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    data, offsets = buffers(column)
    for i, j in slices(offsets):
        w = words(data, offsets[i : j + 1], NOT_SPACE)
        n = max(0, len(w.key) - size + 1)
        total = np.zeros(n, U64)
        for k in range(size):
            total += w.key[k : k + n] * _WORD_KEYS[k]
        key = mix(total)
        for d in range(j - i):
            a, b = int(w.first[d]), int(w.first[d + 1])
            if b - a >= size:
                yield np.unique(key[a : b - size + 1])
            elif b > a:  # fewer words: the whole sequence, apart from any full shingle
                yield mix(np.array([(w.key[a:b] * _WORD_KEYS[: b - a]).sum(dtype=U64) + U64(b - a)]))
            else:
                yield np.zeros(0, U64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two full sets have 100 * intersection >= percent * union; empty ones never have."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def sketch(docs: DataFrame, threshold: float, size: int = SHINGLE) -> DataFrame:
    """(doc_id, row, n_shingles, k1, k2: a 128-bit key of the set, signature binary, bands array<long>)."""
    rows, bands = band_plan(threshold)
    hashes = rows * bands
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _MUL[:hashes, None], _ADD[:hashes, None]
        place = np.arange(bands, dtype=U64) * U64(0xD6E8FEB86659FD93)
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            n, k1, k2, low = [], [], [], np.full((batch.num_rows, hashes), 0xFFFFFFFF, np.uint32)
            for d, key in enumerate(shingle_sets(batch.column(2), size)):
                n.append(len(key))
                k1.append(int(key.sum(dtype=U64)))
                k2.append(int(mix(key ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)))
                x = (key ^ (key >> U64(32))).astype(np.uint32)
                for i in range(0, len(x), 512):
                    np.minimum(low[d], (mul * x[None, i : i + 512] + add).min(1), out=low[d])
            wide = low.reshape(-1, bands, rows).astype(U64)
            key = np.zeros(wide.shape[:2], U64)
            for k in range(rows):
                key = mix(key + wide[:, :, k] * _WORD_KEYS[k])
            key = mix(key + place).view(np.int64)
            byte = ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
            some = np.array(n) > 0
            at = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(np.array(k1, U64).view(np.int64)), pa.array(np.array(k2, U64).view(np.int64)),
                 pa.array([r.tobytes() for r in byte], pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(key[some].ravel()))], schema=schema)

    of_row = id_text(docs).select("doc_id", row_hash("doc_id", "text").alias("row"), "text")
    return of_row.mapInArrow(gives_back(run), "doc_id long, row long, n_shingles long, k1 long, k2 long, signature binary, bands array<long>")


def banded(classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, band, key) of the bands whose key may be in keys."""
    test = key_filter(keys)
    if test is None:
        return classes.select("node", F.posexplode("bands").alias("band", "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            n = lists.value_lengths().to_numpy().astype(np.int64)
            key = lists.flatten().to_numpy()
            ok = np.flatnonzero(test(key))
            of = np.repeat(np.arange(len(n)), n)[ok]
            band = ok - (np.cumsum(n) - n)[of]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(band.astype(np.int32)), pa.array(key[ok])], ["node", "band", "key"])

    return bounded_batches(classes).select("node", "bands").mapInArrow(gives_back(run), "node long, band int, key long")


def prune(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that the sequential test leaves."""
    rows, bands = band_plan(threshold)
    needed = least_matches(threshold, rows * bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).take(pa.array(survivors(left, right, needed)))

    s = signatures.select("node", "signature")
    both = pairs.join(s.toDF("b", "sig_b"), "b").join(s.toDF("a", "sig_a"), "a")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(gives_back(run), "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                text_a = pc.dictionary_encode(part.column("text_a"))  # a hub comes with many members
                left = list(shingle_sets(text_a.dictionary, size))
                ok = []
                for k, right in zip(text_a.indices.to_pylist(), shingle_sets(part.column("text_b"), size)):
                    ok.append(similar(left[k], right, percent))
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(gives_back(run), "a long, b long")


def blocks(members: DataFrame, block: int) -> DataFrame:
    """members with i, j, side, same, once for each block they meet in; (key, i, j) is a block, and its pairs are those of
    different sides, or all if same.

    members: (key, n_main, w_main: members and shingles of the bucket's main component, n_other, w_other: of all others,
    main: whether this one is of the main one, node, ...). Either kind is cut into blocks by a hash of the node.
    """
    many = lambda n, w: F.greatest(F.ceil(F.col(n) / block), F.ceil(F.col(w) / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    one = lambda i, j, side, same: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"), same.alias("same"))
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    of_main = F.transform(each("others"), lambda o: one(F.col("own"), o, F.lit(0), F.lit(False)))
    with_main = F.transform(each("mains"), lambda m: one(m, F.col("own"), F.lit(1), F.lit(False)))
    with_others = F.transform(each("others"), lambda o: one(F.col("mains") + F.least(o, "own"), F.greatest(o, "own"), F.col("own"), o == F.col("own")))
    dealt = members.withColumns({"mains": many("n_main", "w_main"), "others": many("n_other", "w_other")}).withColumn("own", own)
    dealt = dealt.withColumn("met", F.explode(F.when(F.col("main"), of_main).otherwise(F.concat(with_main, with_others))))
    return dealt.select(*members.columns, "met.*")


def across(members: DataFrame, percent: int, size: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) that join different components of a bucket, as many as joining them takes.

    members: as blocks() takes them, with band, component, signature, bands and text.
    """
    rows, bands = band_plan(percent / 100)
    needed = least_matches(percent / 100, rows * bands)
    dealt = blocks(members, block).select("key", "i", "j", "side", "same", "band", "node", "component", "signature", "bands", "text")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(table: pa.Table) -> pa.RecordBatch:
        key, i, j, side, same, band, ids, comp = (table.column(c).to_numpy() for c in ("key", "i", "j", "side", "same", "band", "node", "component"))
        n = len(ids)
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(n, -1)
        keys = pc.list_flatten(table.column("bands").combine_chunks()).to_numpy().reshape(n, -1)
        texts = pc.dictionary_encode(table.column("text").combine_chunks())
        sets, text = list(shingle_sets(texts.dictionary, size)), texts.indices.to_numpy()
        _, comp = np.unique(comp, return_inverse=True)
        root = np.arange(int(comp.max()) + 1)
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        left_in_group = np.repeat(np.append(new[1:], n), np.diff(np.append(new, n))) - np.arange(n) - 1
        earlier = np.arange(keys.shape[1])
        links, lag = [], 1
        at = np.flatnonzero(left_in_group > 0)
        while len(at):
            for k in range(0, len(at), 8192):
                a = at[k : k + 8192]
                b = a + lag
                ok = (root[comp[a]] != root[comp[b]]) & (same[a] | (side[a] != side[b]))
                a, b = a[ok], b[ok]
                ok = ~((keys[a] == keys[b]) & (earlier < band[a][:, None])).any(1)
                a, b = a[ok], b[ok]
                for x in survivors(sig[a], sig[b], needed).tolist() if len(a) else ():
                    r, q = root[comp[a[x]]], root[comp[b[x]]]
                    if r != q and similar(sets[text[a[x]]], sets[text[b[x]]], percent):
                        root[root == q] = r
                        links.append((ids[a[x]], ids[b[x]]))
            lag += 1
            at = at[left_in_group[at] >= lag]
        return pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            last = np.flatnonzero((k != k[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if held:
                h = held[-1]
                if any(h.column(c)[h.num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in ("key", "i", "j")):
                    yield compare(pa.Table.from_batches(held))
                    held = []
            if cut:
                yield compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(gives_back(run), "a long, b long").distinct()


def _near_rows(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """near_components, with row_hash() of each row as row."""
    threshold = percent / 100
    made = shared_table(sketch(docs, threshold, size), "sketch")
    rows = made.count()
    usable = made.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = usable.groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    classes = classes.select("k1", "k2", "n_shingles", "rep.doc_id", "rep.row", "signature", "bands", F.monotonically_increasing_id().alias("node"))
    classes = shared_table(classes, "classes", rows, 10_000)

    keys = classes.select("node", F.explode("bands").alias("key")).groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
    keys = shared_table(keys.where("n > 1").select("key", "hub"), "keys", rows * band_plan(threshold)[1] // 2, 500_000)
    dealt = shared_table(banded(classes, keys.select("key")).join(keys, "key"), "buckets", rows * band_plan(threshold)[1], 500_000)
    wanted = shared_table(classes.join(dealt.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "row"), "candidates", rows)
    texts = id_text(docs).where(F.col("doc_id").isNotNull()).withColumn("row", row_hash("doc_id", "text"))
    texts = maybe_in(texts, "row", wanted.select("row")).where("maybe").join(wanted, ["doc_id", "row"])
    texts = shared_table(texts.dropDuplicates(["node"]).select("node", "text"), "texts")

    pairs = dealt.where("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = shared_table(verify(prune(pairs, classes, threshold).distinct(), texts, percent, size), "verified")
    found = connected_components(links)

    named = dealt.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(found.toDF("hub", "main"), "hub", "left").withColumn("main", F.col("component") == F.coalesce("main", "hub"))
    named = named.join(classes.select("node", "n_shingles"), "node")
    mixed = named.groupBy("key").agg(
        F.count_if("main").alias("n_main"), F.sum(F.when(F.col("main"), F.col("n_shingles"))).alias("w_main"),
        F.count_if(~F.col("main")).alias("n_other"), F.sum(F.when(~F.col("main"), F.col("n_shingles"))).alias("w_other"),
    ).where("n_other > 0")
    members = named.join(mixed, "key").select("key", "n_main", "w_main", "n_other", "w_other", "main", "band", "node", "component")
    members = members.join(classes.select("node", "signature", "bands"), "node").join(texts, "node")
    more = shared_table(across(members, percent, size), "verified")
    if more.take(1):
        found = connected_components(shared_table(links.union(more), "verified", rows))

    # a class has one row here, so the join that meets every copy is the last one and can split a large class
    of_class = classes.select("k1", "k2", "n_shingles", F.col("doc_id").alias("class_id"), "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of_class.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of_class = shared_table(of_class.join(least, "component").drop("component", "node"), "resolved", rows)
    out = made.select("doc_id", "row", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "row", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class_id")


def near_components(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, class_id (smallest id with the same set).

    Words are lower-cased (A-Z) runs of non-white-space. A text of fewer than `size` words has one shingle, its words;
    null, empty and blank texts have none, are linked with nothing and stay. Very long texts are read whole. Rows of one id
    with different sets are judged apart, equal rows alike: a component is that of a row's set. A row with a null id is
    linked with nothing, has a null component and stays. Only doc_id and text are read. An empty table gives an empty
    result.
    """
    return _near_rows(docs, percent, size).drop("row")


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with one document, the smallest id, of each component; same columns, which may have any name. Rows are told
    apart by id and text, so one id with several texts loses only those whose component has a smaller id; all else as
    stated in near_components."""
    gone = _near_rows(docs, percent, SHINGLE).where(~F.col("kept")).select("doc_id", "row")
    gone = shared_table(gone, "gone", docs.count())
    return with_plain_names(docs, ["doc_id", "text"], lambda rows: drop_rows(rows, gone))
